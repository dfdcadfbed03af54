"""Benchmark decontamination by SimHash of item-sized windows.

An item's window in a document is as many words long as the item. Windows and items have a
64-bit SimHash of their words. Items are entered with every value at up to
``RADIUS // BLOCKS`` bits from each of the fingerprint's blocks; two fingerprints that are at
most ``RADIUS`` bits apart agree that closely in one block at least, so a window that looks its
blocks up meets every item within the radius. A similar window may be further away, the more so
if it is altered at one end, where a changed word costs only one shingle. So windows also meet
the items whose rarest shingles they hold: as many as leave too few others for the similarity.
All these candidates are verified by the exact similarity of their five-word shingles, weighted
by how often they occur, and none that is similar enough is missed.

A window whose shingles are all foreign to the benchmark has similarity 0 with every item, so
only windows are cut in which an item's shingle lies where the item has it. All documents
are searched for such shingles, over their whole texts.

Only DataFrame functions are used. The benchmark's tables are broadcast if they are small, and
joined by shuffles otherwise.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from logstats.llm.common import ascii_lower, read_table, small, unused, words_of
from logstats.scratch import checkpointed

WIDTH = 5
SIMILARITY = 0.75
BITS = 64
BLOCKS = 5
# With one changed word, the cosine of the words of texts this similar is about 0.95 or more,
# which is 6.5 bits of 64 on average. With a changed end it is about 0.88 and 10 bits, and some
# texts are over 14 apart; rare shingles find those.
RADIUS = 14


def lower_words(text: Column) -> Column:
    return words_of(ascii_lower(text))


def _shingles(hashes: str, width: int) -> Column:
    """Hashes of all runs of ``width`` words, from the words' hashes."""
    words = F.col(hashes)

    def run(i: Column) -> Column:
        return F.xxhash64(*(F.get(words, i + k) for k in range(width)))

    return F.when(
        F.size(words) >= width, F.transform(F.sequence(F.lit(0), F.size(words) - width), run)
    )


def shingled(rows: DataFrame, keys: Sequence[str], words: str, width: int) -> DataFrame:
    """``keys``, ``at`` and ``shingle`` for each run of ``width`` words."""
    hashed = rows.select(*keys, F.transform(words, lambda w: F.xxhash64(w)).alias("_hashes"))
    return hashed.select(*keys, F.posexplode(_shingles("_hashes", width)).alias("at", "shingle"))


def fingerprints(rows: DataFrame, key: str, words: str) -> DataFrame:
    """``key`` and ``print``, the SimHash of its words, each counted as often as it occurs."""
    hashes = rows.select(key, F.explode(words).alias("_word")).select(
        key, F.xxhash64("_word").alias("_hash")
    )
    sums = [
        F.sum(F.shiftright("_hash", bit).bitwiseAND(1) * 2 - 1).alias(f"_s{bit}") for bit in range(BITS)
    ]
    value = F.lit(0).cast("long")
    for bit in range(BITS):
        one = F.shiftleft(F.lit(1).cast("long"), bit)
        value = value.bitwiseOR(F.when(F.col(f"_s{bit}") > 0, one).otherwise(F.lit(0).cast("long")))
    return hashes.groupBy(key).agg(*sums).select(key, value.alias("print"))


def _block_bounds() -> list[tuple[int, int]]:
    """First bit and width of each block."""
    edges = [BITS * i // BLOCKS for i in range(BLOCKS + 1)]
    return [(low, high - low) for low, high in zip(edges, edges[1:], strict=False)]


def _blocks(value: Column) -> Column:
    return F.array(
        *(
            F.struct(
                F.lit(i).alias("block"),
                F.shiftrightunsigned(value, low).bitwiseAND((1 << width) - 1).alias("part"),
            )
            for i, (low, width) in enumerate(_block_bounds())
        )
    )


def _near_blocks(value: Column) -> Column:
    """All block values within the radius of a block."""

    def of_block(i: int, low: int, width: int) -> Column:
        part = F.shiftrightunsigned(value, low).bitwiseAND((1 << width) - 1)
        masks = [
            sum(1 << bit for bit in bits)
            for radius in range(RADIUS // BLOCKS + 1)
            for bits in combinations(range(width), radius)
        ]
        flips = F.array(*(F.lit(mask).cast("long") for mask in masks))

        def flipped(mask: Column) -> Column:
            return F.struct(F.lit(i).alias("block"), part.bitwiseXOR(mask).alias("part"))

        return F.transform(flips, flipped)

    bounds = enumerate(_block_bounds())
    return F.flatten(F.array(*(of_block(i, low, width) for i, (low, width) in bounds)))


def _aligned_windows(docs: DataFrame, items: DataFrame) -> DataFrame:
    """``row_key`` and the distinct ``start`` and ``length`` of windows aligned with an item."""
    found = None
    widths = [row["width"] for row in items.select("width").distinct().orderBy("width").collect()]
    for width in widths:  # at most WIDTH of them
        of_items = shingled(items.filter(F.col("width") == width), ["length"], "words", width)
        of_items = small(of_items.withColumnRenamed("at", "_offset").distinct())
        # Rows with the same key are the same text: its words are hashed once.
        of_docs = shingled(docs, ["row_key", "n_words"], "words", width)
        last = F.greatest(F.col("n_words") - F.col("length"), F.lit(0))
        start = F.least(F.greatest(F.col("at") - F.col("_offset"), F.lit(0)), last)
        aligned = of_docs.join(of_items, "shingle").select("row_key", start.alias("start"), "length")
        found = aligned if found is None else found.unionByName(aligned)
    return found.distinct()


def _weights(rows: DataFrame, key: str, n: str) -> DataFrame:
    """``key``, ``shingle`` and its number of occurrences ``n``, for rows with ``words``."""
    parts = [
        shingled(rows.filter(F.least(F.size("words"), F.lit(WIDTH)) == width), [key], "words", width)
        for width in range(1, WIDTH + 1)
    ]
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    return found.groupBy(key, "shingle").agg(F.count(F.lit(1)).alias(n))


def _rare_shingles(of_texts: DataFrame, similarity: float) -> DataFrame:
    """``text_id`` and ``shingle``: of each text its rarest ones, at least one of which is in
    whatever is similar enough. The others weigh less than ``similarity`` of the text together."""
    spread = of_texts.groupBy("shingle").agg(F.count(F.lit(1)).alias("_texts"))
    whole = Window.partitionBy("text_id")
    before = whole.orderBy("_texts", "shingle").rowsBetween(Window.unboundedPreceding, -1)
    left = F.sum("m").over(whole) - F.coalesce(F.sum("m").over(before), F.lit(0))
    weighed = of_texts.join(spread, "shingle").withColumns(
        {"_left": left, "_least": F.sum("m").over(whole) * similarity - 1e-6}
    )
    return weighed.filter("_left >= _least").select("text_id", "shingle")


def keyed(docs: DataFrame) -> DataFrame:
    """``docs`` with ``row_key``; rows with equal doc_id and text have the same."""
    return docs.withColumn("row_key", F.xxhash64("doc_id", "text"))


def find_leaks(
    docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY
) -> DataFrame:
    """``doc_id``, ``row_key``, ``item_id``, ``start``, ``similarity`` of items in documents.

    One row for each document and item, of the window that is most like the item, the first
    of equally like ones; ``start`` counts words from 0. A text shorter than the item is
    one window. Texts and items that are null or without words leak nothing. Repeated
    documents give one row, and items with equal texts are found together. Empty tables
    give an empty table.
    """
    items = benchmark.select("item_id", lower_words(F.col("text")).alias("words"))
    items = items.withColumn("length", F.size("words")).filter("length > 0")
    items = checkpointed(items.withColumn("width", F.least("length", F.lit(WIDTH))))
    rows = keyed(docs.select("doc_id", "text"))
    if items.isEmpty():
        return rows.select(
            "doc_id", "row_key", F.lit(None).cast("long").alias("item_id"),
            F.lit(None).cast("int").alias("start"), F.lit(None).cast("double").alias("similarity"),
        ).filter("false")
    # Items with equal words are one text.
    texts = items.groupBy("words", "length", "width").agg(F.min("item_id").alias("text_id"))
    texts = checkpointed(texts.withColumn("text_id", F.monotonically_increasing_id()))

    worded = rows.select("row_key", lower_words(F.col("text")).alias("words"))
    worded = worded.select("row_key", "words", F.size("words").alias("n_words"))
    windows = checkpointed(_aligned_windows(worded, texts))
    spans = F.sort_array(F.collect_set(F.struct("start", "length"))).alias("spans")
    by_row = small(windows.groupBy("row_key").agg(spans))
    hit = rows.join(by_row, "row_key")
    hit = hit.select("doc_id", "row_key", "spans", lower_words(F.col("text")).alias("_all"))
    cut = F.transform(
        "spans",
        lambda s: F.struct(
            s["start"].alias("start"), F.slice(F.col("_all"), s["start"] + 1, s["length"]).alias("words")
        ),
    )
    placed = hit.select("doc_id", "row_key", F.explode(cut).alias("w"))
    placed = placed.select("doc_id", "row_key", "w.start", "w.words").withColumn(
        "window", F.sha1(F.array_join("words", " "))
    )
    placed = checkpointed(placed.distinct())

    # Windows with equal words are one, however many documents hold them.
    distinct = checkpointed(placed.groupBy("window").agg(F.first("words").alias("words")))
    prints = fingerprints(distinct, "window", "words")
    looked_up = prints.select("window", "print", F.explode(_blocks(F.col("print"))).alias("b"))
    entered = fingerprints(texts, "text_id", "words").select(
        "text_id", F.col("print").alias("_print"), F.explode(_near_blocks(F.col("print"))).alias("b")
    )
    entered = small(entered.select("text_id", "_print", "b.block", "b.part"))
    apart = F.bit_count(F.col("print").bitwiseXOR(F.col("_print")))
    candidates = (
        looked_up.select("window", "print", "b.block", "b.part")
        .join(entered, ["block", "part"])
        .filter(apart <= RADIUS)
        .select("window", "text_id")
    )
    of_windows = checkpointed(_weights(distinct, "window", "n"))
    of_texts = checkpointed(_weights(texts, "text_id", "m"))
    rare = small(_rare_shingles(of_texts, similarity))
    sharing = of_windows.join(rare, "shingle").select("window", "text_id")
    candidates = candidates.unionByName(sharing).distinct()
    common = (
        candidates.join(of_windows, "window")
        .join(small(of_texts), ["text_id", "shingle"])
        .groupBy("window", "text_id")
        .agg(F.sum(F.least("n", "m")).alias("common"))
    )
    totals = of_windows.groupBy("window").agg(F.sum("n").alias("in_window"))
    sizes = small(of_texts.groupBy("text_id").agg(F.sum("m").alias("in_text")))
    alike = F.col("common") / (F.col("in_window") + F.col("in_text") - F.col("common"))
    verified = (
        common.join(totals, "window")
        .join(sizes, "text_id")
        .select("window", "text_id", alike.alias("similarity"))
        .filter(F.col("similarity") >= similarity)
    )
    named = items.join(texts.select("words", "text_id"), "words").select("item_id", "text_id")
    best = F.max(F.struct("similarity", (-F.col("start")).alias("back"))).alias("best")
    return (
        placed.select("doc_id", "row_key", "start", "window")
        .join(small(verified), "window")
        .join(small(named), "text_id")
        .groupBy("doc_id", "row_key", "item_id")
        .agg(best)
        .select(
            "doc_id", "row_key", "item_id",
            (-F.col("best.back")).cast("int").alias("start"), "best.similarity",
        )
    )


def drop_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that hold no item; a removed row's repetitions go with it."""
    key, of_key, of_id = (unused(name, docs) for name in ("_row_key", "_of_key", "_of_id"))
    named = [F.col("row_key").alias(of_key), F.col("doc_id").alias(of_id)]
    leaks = small(find_leaks(docs, benchmark).select(*named).distinct())
    same = (F.col(key) == F.col(of_key)) & F.col("doc_id").eqNullSafe(F.col(of_id))
    return docs.withColumn(key, F.xxhash64("doc_id", "text")).join(leaks, same, "left_anti").drop(key)


def op5_simhash_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = (read_table(spark, sf_dir, name) for name in ("documents", "benchmark"))
    return find_leaks(docs, items).select("doc_id", "item_id", "start", "similarity")


# All aligned windows are compared exactly, without fingerprints; items have five words or more.
ORACLE = r"""
WITH d AS (
  SELECT doc_id, w, len(w) AS n FROM (
    SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
             'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents)
), i AS (
  SELECT item_id, w, len(w) AS l FROM (
    SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
             'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM benchmark) WHERE len(w) >= 5
), ds AS (
  SELECT doc_id, n, p, array_to_string(w[p:p + 4], ' ') AS s
  FROM (SELECT *, unnest(range(1, n - 3)) AS p FROM d WHERE n >= 5)
), xs AS (
  SELECT item_id, l, o, array_to_string(w[o:o + 4], ' ') AS s
  FROM (SELECT *, unnest(range(1, l - 3)) AS o FROM i)
), aligned AS (
  SELECT DISTINCT doc_id, l, least(greatest(p - o, 0), greatest(n - l, 0)) AS start
  FROM ds JOIN xs USING (s)
), win AS (
  SELECT doc_id, l, start, array_to_string(c[q:q + 4], ' ') AS s, count(*) AS c
  FROM (SELECT *, unnest(range(1, len(c) - 3)) AS q FROM (
          SELECT a.doc_id, a.l, a.start, d.w[a.start + 1:a.start + a.l] AS c FROM aligned a JOIN d USING (doc_id)))
  GROUP BY ALL
), ic AS (
  SELECT item_id, s, count(*) AS c FROM xs GROUP BY ALL
), common AS (
  SELECT doc_id, win.l, start, item_id, sum(least(win.c, ic.c)) AS n_both FROM win JOIN ic USING (s) GROUP BY ALL
), wt AS (
  SELECT doc_id, l, start, sum(c) AS t FROM win GROUP BY ALL
), it AS (
  SELECT item_id, sum(c) AS t FROM ic GROUP BY ALL
), sims AS (
  SELECT doc_id, item_id, start, n_both::DOUBLE / (wt.t + it.t - n_both)::DOUBLE AS similarity
  FROM common JOIN wt USING (doc_id, l, start) JOIN it USING (item_id)
)
SELECT doc_id, item_id, start::INT AS start, similarity FROM sims WHERE similarity >= 0.75
QUALIFY row_number() OVER (PARTITION BY doc_id, item_id ORDER BY similarity DESC, start) = 1
"""
