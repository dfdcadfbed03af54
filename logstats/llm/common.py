"""What several operators share: words, ranks over all rows, and checked broadcasts."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from logstats.scratch import checkpointed

# Fixed value: a word is a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
# The letters that lower-casing touches.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# A table of at most so many rows and bytes may be broadcast.
BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 64 << 20


def ascii_lower(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def words_of(text: Column) -> Column:
    """The words of a text in order; none for null."""
    return F.coalesce(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), F.array())


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def unused(name: str, *frames: DataFrame) -> str:
    """A column name like ``name`` that none of the frames has."""
    taken = {column.lower() for frame in frames for column in frame.columns}
    while name.lower() in taken:
        name += "_"
    return name


def _bytes_of(name: str, kind: str) -> Column:
    column = F.col(f"`{name}`")
    text = column if kind in ("string", "binary") else F.to_json(F.struct(column))
    return F.coalesce(F.octet_length(text), F.lit(0))


def small(table: DataFrame, limit: int = BROADCAST_ROWS, most_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """A checkpointed table, marked for broadcast only if it has at most ``limit`` rows and
    its columns of no fixed width at most ``most_bytes``."""
    kept = checkpointed(table)
    if kept.limit(limit + 1).count() > limit:
        return kept
    wide = [both for both in kept.dtypes if both[1].startswith(("string", "binary", "array", "map", "struct"))]
    if wide:
        size = kept.agg(F.sum(sum((_bytes_of(*both) for both in wide), F.lit(0)))).head()[0]
        if (size or 0) > most_bytes:
            return kept
    return F.broadcast(kept)


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Within this, the shuffle files of a query go once it has ended.

    A chain of checkpointed steps needs none of them again, and would otherwise keep those
    of all steps until the driver collects its garbage.
    """
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


@contextmanager
def small_batches(spark: SparkSession, rows: int = 2000) -> Iterator[None]:
    """Within this, tasks get and give at most so many rows at a time in Python.

    For steps that make much of each row, such as arrays of all its shingles.
    """
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def ranked(rows: DataFrame, order: Sequence[Column], at: str) -> DataFrame:
    """Every row with its place, from 0, among all rows in ``order``.

    Rows are range-partitioned and sorted, which bounds every task because the caller's
    order ends in something that tells rows apart; rows equal in all of it are the only
    ones with an arbitrary order. A row's place is its place in its partition, taken from
    the row id, plus the rows of the partitions before. The sorted rows are checkpointed,
    since a second evaluation might sample other range bounds. The counts have one row for
    each partition, which bounds their window and their broadcast.
    """
    part, of, start = (unused(name, rows) for name in ("_part", "_of", "_start"))
    sorted_rows = (
        rows.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn(at, F.monotonically_increasing_id())
    )
    placed = checkpointed(sorted_rows).withColumn(part, F.shiftright(at, 33))
    before = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    counts = placed.groupBy(part).agg(F.count(F.lit(1)).alias("_rows"))
    starts = counts.select(
        F.col(part).alias(of), F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias(start)
    )
    within = F.col(at).bitwiseAND((1 << 33) - 1)
    return (
        placed.join(F.broadcast(starts), F.col(part) == F.col(of))
        .withColumn(at, within + F.col(start))
        .drop(part, of, start)
    )
