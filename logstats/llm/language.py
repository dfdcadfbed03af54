"""Language identification by rank-order profiles of character n-grams.

A language's profile is its most frequent n-grams over all documents to learn from, in
order. A document's own most frequent n-grams are ranked alike, and the distance to a
language is the sum over them of how far out of place each one is there; an n-gram that the
profile does not have is as far out as can be. The nearest language is predicted.

N-grams are of 1 to 3 characters, inside words that have one blank at either end. They are
coded as integers and counted with numpy, a document at a time, over the whole text. Counts
for the profiles are summed up by Spark; what comes to the driver are the profiles.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from logstats.llm.common import read_table, unused
from logstats.scratch import checkpointed

PROFILE_GRAMS = 400
DOCUMENT_GRAMS = 400
UNKNOWN = "und"
# Texts are counted together for the profiles up to so many characters.
BLOCK_CHARS = 1_000_000
_BITS = 21


class Letters:
    """Which code points are letters; built once in each Python worker."""

    _table: np.ndarray | None = None

    @classmethod
    def table(cls) -> np.ndarray:
        if cls._table is None:
            kinds = (unicodedata.category(chr(i))[0] == "L" for i in range(0x110000))
            cls._table = np.fromiter(kinds, dtype=bool, count=0x110000)
        return cls._table


def letter_run(text: str | None) -> np.ndarray:
    """Lower-cased letters as code points + 1, words apart by a single 1 and 1 at both ends.

    Empty if the text is null or has no letter.
    """
    if not text:
        return np.empty(0, dtype=np.uint64)
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    is_letter = Letters.table()[points]
    if not is_letter.any():
        return np.empty(0, dtype=np.uint64)
    run = np.zeros(len(points) + 2, dtype=np.uint64)
    run[1:-1] = np.where(is_letter, points, 0)
    keep = run > 0
    keep[1:] |= run[:-1] > 0
    keep[:-1] |= run[1:] > 0
    run = run[keep]
    doubled = np.zeros(len(run), dtype=bool)
    doubled[1:] = (run[1:] == 0) & (run[:-1] == 0)
    return run[~doubled] + np.uint64(1)


def gram_codes(run: np.ndarray) -> np.ndarray:
    """All n-grams of a run, as integers; none holds a blank inside."""
    if len(run) == 0:
        return run
    bits = np.uint64(_BITS)
    pairs = (run[:-1] << bits) | run[1:]
    triples = ((pairs[:-1] << bits) | run[2:])[run[1:-1] > 1]
    return np.concatenate([run[run > 1], pairs, triples])


def top_grams(run: np.ndarray, most: int = DOCUMENT_GRAMS) -> np.ndarray:
    """The most frequent n-grams in order; equally frequent ones by their code."""
    codes, counts = np.unique(gram_codes(run), return_counts=True)
    return codes[np.argsort(-counts, kind="stable")[:most]]


@dataclass
class Profiles:
    """Rank of each known n-gram in each language; ``worst`` where it has none."""

    languages: list[str]
    codes: np.ndarray
    ranks: np.ndarray
    worst: int

    @classmethod
    def of(cls, ranked_grams: dict[str, list[int]], worst: int = PROFILE_GRAMS) -> Profiles:
        languages = sorted(ranked_grams)
        listed = [np.array(ranked_grams[name], dtype=np.uint64) for name in languages]
        codes = np.unique(np.concatenate(listed)) if listed else np.empty(0, dtype=np.uint64)
        ranks = np.full((len(languages), len(codes)), worst, dtype=np.int64)
        for row, grams in zip(ranks, listed, strict=True):
            row[np.searchsorted(codes, grams)] = np.arange(len(grams))
        return cls(languages, codes, ranks, worst)

    def predict(self, text: str | None) -> tuple[str, float]:
        """The nearest language and 1 - its distance as a share of the largest possible;
        the first by name of equally near ones."""
        run = letter_run(text)
        if len(run) == 0 or not self.languages:
            return UNKNOWN, 0.0
        grams = top_grams(run)
        at = np.minimum(np.searchsorted(self.codes, grams), len(self.codes) - 1)
        known = self.codes[at] == grams
        place = np.arange(len(grams))[known]
        off = np.minimum(np.abs(self.ranks[:, at[known]] - place), self.worst)
        off[self.ranks[:, at[known]] == self.worst] = self.worst
        distance = off.sum(axis=1) + self.worst * int((~known).sum())
        best = int(np.argmin(distance))
        return self.languages[best], 1.0 - float(distance[best]) / (self.worst * len(grams))


def _count_blocks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Counts of the n-grams of each language, for blocks of texts."""

    def counted(language: str, runs: list[np.ndarray]) -> pd.DataFrame:
        codes, counts = np.unique(gram_codes(np.concatenate(runs)), return_counts=True)
        return pd.DataFrame({"lang": language, "gram": codes.astype(np.int64), "n": counts})

    held: dict[str, list[np.ndarray]] = {}
    sizes: dict[str, int] = {}
    for batch in batches:
        for language, text in zip(batch["lang"], batch["text"], strict=True):
            run = letter_run(text)
            if len(run):
                held.setdefault(language, []).append(run)
                sizes[language] = sizes.get(language, 0) + len(run)
                if sizes[language] >= BLOCK_CHARS:
                    yield counted(language, held.pop(language))
                    sizes[language] = 0
    for language, runs in held.items():
        yield counted(language, runs)


def learn_profiles(examples: DataFrame, most: int = PROFILE_GRAMS) -> Profiles:
    """Profiles from all rows of ``lang`` and ``text``; rows without a language are left out."""
    counts = (
        examples.filter("lang IS NOT NULL AND text IS NOT NULL")
        .select("lang", "text")
        .mapInPandas(_count_blocks, "lang string, gram long, n long")
        .groupBy("lang", "gram")
        .agg(F.sum("n").alias("n"))
    )
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    top = counts.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= most)
    grams: dict[str, list[int]] = {}
    for row in checkpointed(top).orderBy("lang", "rank").collect():
        grams.setdefault(row["lang"], []).append(row["gram"])
    return Profiles.of(grams, most)


def prediction(profiles: Profiles, text: str = "text") -> Column:
    """A struct of ``lang_pred`` and ``score`` for a column of texts."""

    @F.pandas_udf("lang_pred string, score double")
    def predict(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame(map(profiles.predict, texts), columns=["lang_pred", "score"])

    return predict(text)


def add_language(docs: DataFrame, profiles: Profiles, text: str = "text") -> DataFrame:
    """Every row with ``lang_pred`` and ``score``; columns of these names are replaced.

    A null text, one without letters, and any text if no language was learned is ``und``
    with score 0. Equal texts get equal answers.
    """
    answer = unused("_language", docs)
    return (
        docs.withColumn(answer, prediction(profiles, text))
        .drop("lang_pred", "score")
        .withColumns({name: F.col(f"{answer}.{name}") for name in ("lang_pred", "score")})
        .drop(answer)
    )


def held_out(doc_id: Column) -> Column:
    """A quarter of the documents by id, not learned from; never one without id."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def identify(docs: DataFrame) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score`` by profiles learned from its own labels."""
    return add_language(docs, learn_profiles(docs.filter(~held_out(F.col("doc_id")))))


def keep_told(docs: DataFrame, least: float) -> DataFrame:
    """The rows of ``docs`` whose language is told with a score of ``least`` or more, as they
    are; profiles are learned from their own labels."""
    profiles = learn_profiles(docs.filter(~held_out(F.col("doc_id"))))
    answer = unused("_language", docs)
    told = docs.withColumn(answer, prediction(profiles))
    return told.filter((F.col(answer)["lang_pred"] != UNKNOWN) & (F.col(answer)["score"] >= least)).drop(answer)


def op6_rank_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return identify(docs.select("doc_id", "lang", "text")).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score"
    )
