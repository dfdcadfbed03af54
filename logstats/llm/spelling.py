"""Spelling variants: words one edit away from a much more frequent word.

Words come from runs of Latin letters of whole texts, counted by Spark. Two words are near if
they differ by one inserted, deleted or replaced code point. Near words are found with bitsets
per (position, letter) over words: a word is matched against all words of a bitset at once, by a
recurrence over its letters that tracks the words matched without an error, those matched with
one replaced letter, and those matched with one letter more, for which positions are
shifted by one.

A bitset spans a bucket of words. An edit touches only one half of a word, so near words
have the first or the last half in common, and buckets are made of words with one of
these in common and of one length or one more; within a bucket, the other half is matched.
A pair is found in one bucket only, so nothing has to be compared with what was found before.
A bucket of more than ``BLOCK`` words is cut into blocks, and each block of words to match
meets each block of bitsets, so no task holds more than two blocks of a bucket.

A word's form is its near word of largest count, if that is at least twice its own. Counts at
least double along a chain of forms, which bounds its length by the largest count, and its end
is found by doubling steps.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logstats.llm.common import read_table, shuffles_removed
from logstats.scratch import checkpointed

# Words have that many code points and occurrences at least.
LEAST_LENGTH, LEAST_COUNT = 5, 3
# Fixed value: one in so many runs of a document loses a letter.
MISSPELT = 97
# A form occurs at least so many times as often as its variant.
FORM_RATIO = 2
# At most so many words of a bucket are in one task's bitsets.
BLOCK = 1 << 16
# Counts of a task are handed on at so many words.
HELD_WORDS = 1 << 20

# A-Z as a-z, a-z and U+00C0 to U+00FF as they are, all else as blanks, in Latin-1.
_RUNS = bytes(
    code + 32 if 0x41 <= code <= 0x5A else code if 0x61 <= code <= 0x7A or code >= 0xC0 else 0x20
    for code in range(256)
)


def runs(text: str | None) -> list[bytes]:
    """The lower-cased runs of a text, in Latin-1."""
    # What Latin-1 has not becomes a question mark, which is no letter either.
    return (text or "").encode("latin-1", "replace").translate(_RUNS).split()


def misspelt(run: bytes, prefix_crc: int) -> bytes:
    """The run, without one letter if its checksum after the document's says so."""
    check = zlib.crc32(run if run.isascii() else run.decode("latin-1").encode(), prefix_crc)
    if check % MISSPELT:
        return run
    at = check % len(run)
    return run[:at] + run[at + 1 :]


def word_counts(docs: DataFrame) -> DataFrame:
    """``word`` and ``n`` of the vocabulary of all texts; a null doc_id is written as nothing."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: Counter[bytes] = Counter()

        def counted() -> pd.DataFrame:
            words = [word.decode("latin-1") for word in total]
            return pd.DataFrame({"word": words, "n": np.fromiter(total.values(), dtype=np.int64, count=len(total))})

        for batch in batches:
            for doc_id, text in zip(batch["doc_id"], batch["text"], strict=True):
                prefix = zlib.crc32(f"{doc_id}:".encode())
                for run, n in Counter(runs(text)).items():
                    word = misspelt(run, prefix)
                    if len(word) >= LEAST_LENGTH:
                        total[word] += n
                if len(total) > HELD_WORDS:
                    yield counted()
                    total.clear()
        if total:
            yield counted()

    rows = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc_id"), "text")
    counted = rows.mapInPandas(count, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= LEAST_COUNT)


def bucket_rows(words: DataFrame, block: int = BLOCK) -> DataFrame:
    """Words by bucket: ``key``, ``size`` of the words to match, ``first`` half or not, ``part``
    (a pair of blocks), ``word``, ``n``, and whether it is to be ``matched`` and to be ``held``
    in bitsets.

    A bucket of one word, and one without words to match, is left out.
    """
    length = F.length("word")

    def halves(size, matched):
        """Both buckets that a word is in among the words of ``size`` and one more."""
        half = F.floor(size / 2).cast("int")
        first = F.struct(size.alias("size"), F.lit(True).alias("first"), F.expr("word").substr(F.lit(1), half).alias("key"), F.lit(matched).alias("matched"))
        rest = size - half
        last = F.struct(size.alias("size"), F.lit(False).alias("first"), F.expr("word").substr(length - rest + 1, rest).alias("key"), F.lit(matched).alias("matched"))
        return [first, last]

    own, shorter = F.array(*halves(length, True)), F.array(*halves(length - 1, False))
    buckets = F.when(length > LEAST_LENGTH, F.concat(own, shorter)).otherwise(own)
    rows = words.select("word", "n", F.explode(buckets).alias("b")).select("b.*", "word", "n")
    of = ["size", "first", "key"]
    sizes = rows.groupBy(*of).agg(F.count(F.lit(1)).alias("_n"), F.max("matched").alias("_any"))
    sizes = sizes.filter("_n > 1 AND _any").select(*of, F.ceil(F.col("_n") / block).cast("int").alias("_blocks"))
    rows = rows.join(sizes, of)
    mine = F.pmod(F.xxhash64("word"), F.col("_blocks")).cast("int")
    every = F.sequence(F.lit(0), F.col("_blocks") - 1)
    pair = lambda i: F.struct((mine * F.col("_blocks") + i).alias("part"), (i == mine).alias("held"), F.lit(True).alias("matched"))
    held = lambda i: F.struct((i * F.col("_blocks") + mine).alias("part"), F.lit(True).alias("held"), F.lit(False).alias("matched"))
    # Part q * blocks + h: words of block q are matched against the bitsets of block h.
    as_held = F.transform(every, held)
    as_both = F.concat(F.transform(every, pair), F.transform(F.filter(every, lambda i: i != mine), held))
    parts = F.when(F.col("matched"), as_both).otherwise(as_held)
    return rows.select(*of, "word", "n", F.explode(parts).alias("p")).select(*of, "p.*", "word", "n")


def _bitset(places: list[int], n: int) -> int:
    if n <= 2048:
        bits = 0
        for at in places:
            bits |= 1 << at
        return bits
    mask = np.zeros(n, dtype=bool)
    mask[places] = True
    return int.from_bytes(np.packbits(mask, bitorder="little").tobytes(), "little")


def _places(bits: int, n: int) -> list[int]:
    if n <= 2048:
        found = []
        while bits:
            low = bits & -bits
            found.append(low.bit_length() - 1)
            bits ^= low
        return found
    data = np.frombuffer(bits.to_bytes((n + 7) // 8, "little"), dtype=np.uint8)
    return np.flatnonzero(np.unpackbits(data, bitorder="little")).tolist()


class PositionIndex:
    """Bitsets per (position, letter) over words, and over those of each length."""

    def __init__(self, words: list[str]):
        self.n = len(words)
        self.all = (1 << self.n) - 1
        positions: dict[int, dict[str, list[int]]] = defaultdict(lambda: defaultdict(list))
        lengths: dict[int, list[int]] = defaultdict(list)
        for at, word in enumerate(words):
            lengths[len(word)].append(at)
            for position, letter in enumerate(word):
                positions[position][letter].append(at)
        self.letters = {
            position: {letter: _bitset(places, self.n) for letter, places in by_letter.items()}
            for position, by_letter in positions.items()
        }
        self.lengths = {length: _bitset(places, self.n) for length, places in lengths.items()}

    def near(self, word: str) -> tuple[int, int, int]:
        """Bitsets of the words equal to ``word``, with one letter replaced, and with one more."""
        exact, replaced, longer = self.all, 0, self.all
        here = self.letters.get(0, {})
        for position, letter in enumerate(word):
            shifted = self.letters.get(position + 1, {})
            same = here.get(letter, 0)
            replaced = replaced & same | exact & ~same
            exact &= same
            longer = longer & shifted.get(letter, 0) | exact
            here = shifted
        same_length = self.lengths.get(len(word), 0)
        return exact, replaced & same_length, longer & self.lengths.get(len(word) + 1, 0)


def _near_in_bucket(size: int, first: bool, rows: list[tuple]) -> Iterator[tuple[str, int, int, str]]:
    """Per word: how many near words this bucket has for it, and the best one with its count."""
    half = size // 2

    def other(word: str) -> str:
        """What words of this bucket do not have in common."""
        return word[half:] if first else word[: len(word) - (size - half)]

    held = [(word, n) for word, n, _, is_held in rows if is_held]
    index = PositionIndex([other(word) for word, _ in held])
    for word, n, matched, _ in rows:
        if not matched:
            continue
        exact, replaced, longer = index.near(other(word))
        if not first:
            # Those with the first half in common too are found in its bucket.
            longer &= ~exact
        found = [held[at] for at in _places(replaced | longer, index.n)]
        if found:
            best = min((-m, near) for near, m in found)
            yield word, len(found), -best[0], best[1]
        for at in _places(longer, index.n) if longer else ():
            yield held[at][0], 1, n, word


def near_words(words: DataFrame, block: int = BLOCK) -> DataFrame:
    """``word``, ``n_near``, and of its near words the most frequent, ``near``, with ``near_n``.

    Words without a near word are not there. Of near words with equal counts it is the
    smallest in code-point order.
    """
    of = ["size", "first", "key", "part"]

    def match(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        columns = ["word", "n_near", "near_n", "near"]
        group, rows = None, []
        for batch in batches:
            found = []
            for *key, word, n, matched, held in batch[[*of, "word", "n", "matched", "held"]].itertuples(index=False):
                if key != group:
                    if rows:
                        found.extend(_near_in_bucket(group[0], group[1], rows))
                    group, rows = key, []
                rows.append((word, n, matched, held))
            if found:
                yield pd.DataFrame(found, columns=columns)
        found = list(_near_in_bucket(group[0], group[1], rows)) if rows else []
        if found:
            yield pd.DataFrame(found, columns=columns)

    grouped = bucket_rows(words, block).repartition(*of).sortWithinPartitions(*of)
    found = grouped.mapInPandas(match, "word string, n_near long, near_n long, near string")
    best = F.min(F.struct((-F.col("near_n")).alias("m"), "near"))
    return (
        found.groupBy("word")
        .agg(F.sum("n_near").alias("n_near"), best.alias("b"))
        .select("word", "n_near", (-F.col("b.m")).alias("near_n"), F.col("b.near").alias("near"))
    )


def roots(forms: DataFrame, largest: int) -> DataFrame:
    """``word`` and ``root`` of the words with a ``form``, at the end of their chain of forms.

    After each step a word knows the word twice as many forms away.
    """
    longest = max(1.0, math.log(max(largest, 1), FORM_RATIO))
    jumps = forms.select("word", F.col("form").alias("root"))
    for _ in range(math.ceil(math.log2(longest)) + 1):
        further = jumps.select(F.col("word").alias("_at"), F.col("root").alias("_further"))
        jumps = checkpointed(
            jumps.join(further, F.col("root") == F.col("_at"), "left").select(
                "word", F.coalesce("_further", "root").alias("root")
            )
        )
    return jumps


def spelling_variants(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """Per word of ``docs`` (``doc_id``, ``text``): ``word``, ``n``, ``n_near``, ``form``, ``form_n``, ``root``.

    A null or empty text has no words; a row that repeats counts again. A word without a
    form has null there and is its own root. Other columns of ``docs`` are not read. An empty
    table gives an empty table.
    """
    with shuffles_removed(docs.sparkSession):
        words = checkpointed(word_counts(docs))
        near = near_words(words, block)
        form = F.when(F.col("near_n") >= FORM_RATIO * F.col("n"), F.col("near"))
        formed = checkpointed(
            words.join(near, "word", "left").select(
                "word",
                "n",
                F.coalesce("n_near", F.lit(0)).alias("n_near"),
                form.alias("form"),
                F.when(form.isNotNull(), F.col("near_n")).alias("form_n"),
            )
        )
        largest = words.agg(F.max("n")).head()[0] or 0
        ends = roots(formed.filter("form IS NOT NULL").select("word", "form"), largest)
    return formed.join(ends, "word", "left").withColumn("root", F.coalesce("root", "word"))


def op11_position_bitsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(read_table(spark, sf_dir, "documents"))


# The checksum is the usual one, reflected, byte by byte with a table. Near words share what
# is left of them without one letter: a shorter word is what is left of a longer one,
# and words of one length are left with the same at one place.
ORACLE = """
WITH RECURSIVE crc_table AS (
    SELECT list(list_reduce(list_prepend(i::UBIGINT, list_transform(range(8), lambda k: 0::UBIGINT)),
           lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::UBIGINT) ELSE c >> 1 END) ORDER BY i) AS t
    FROM range(256) AS r(i)
), runs AS (
    SELECT doc_id, translate(r, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run
    FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\\x{00C0}-\\x{00FF}]+')) AS r FROM documents)
), per_doc AS (
    SELECT doc_id, run, count(*) AS n FROM runs GROUP BY ALL
), checked AS (
    SELECT run, n, xor(list_reduce(list_prepend(4294967295::UBIGINT, list_transform(range(strlen(h) // 2),
               lambda i: ((strpos('0123456789ABCDEF', substr(h, 2 * i + 1, 1)) - 1) * 16
                       + strpos('0123456789ABCDEF', substr(h, 2 * i + 2, 1)) - 1)::UBIGINT)),
           lambda c, b: xor(c >> 8, t[(1 + (xor(c, b) & 255))::BIGINT])), 4294967295::UBIGINT)::BIGINT AS h
    FROM (SELECT run, n, hex(encode(coalesce(doc_id::VARCHAR, '') || ':' || run)) AS h FROM per_doc), crc_table
), written AS (
    SELECT CASE WHEN h % 97 = 0
                THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n
    FROM checked
), words AS (
    SELECT word, sum(n)::BIGINT AS n FROM written WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3
), cut AS (
    SELECT word, n, i, substr(word, 1, i) || substr(word, i + 2) AS rest
    FROM (SELECT word, n, unnest(range(length(word))) AS i FROM words)
), near AS (
    SELECT DISTINCT a.word, a.n, b.word AS near, b.n AS near_n FROM cut a JOIN words b ON a.rest = b.word
    UNION
    SELECT DISTINCT b.word, b.n, a.word AS near, a.n AS near_n FROM cut a JOIN words b ON a.rest = b.word
    UNION
    SELECT a.word, a.n, b.word AS near, b.n AS near_n FROM cut a JOIN cut b ON a.rest = b.rest AND a.i = b.i
    WHERE a.word <> b.word
), best AS (
    SELECT word, n, near, near_n, count(*) OVER (PARTITION BY word) AS n_near,
           row_number() OVER (PARTITION BY word ORDER BY near_n DESC, encode(near)) AS place
    FROM near
), formed AS (
    SELECT w.word, w.n, coalesce(b.n_near, 0)::BIGINT AS n_near,
           CASE WHEN b.near_n >= 2 * w.n THEN b.near END AS form,
           CASE WHEN b.near_n >= 2 * w.n THEN b.near_n END AS form_n
    FROM words w LEFT JOIN best b ON w.word = b.word AND b.place = 1
), chain AS (
    SELECT word, word AS at, form AS next FROM formed
    UNION ALL
    SELECT c.word, f.word, f.form FROM chain c JOIN formed f ON c.next = f.word
)
SELECT f.word, f.n, f.n_near, f.form, f.form_n, c.at AS root
FROM formed f JOIN chain c ON f.word = c.word AND c.next IS NULL
"""
