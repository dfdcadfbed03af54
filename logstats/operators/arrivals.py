"""Whole-row dedup against all that was loaded before.

The digests of loaded rows are kept in a bucketed table. A load is dealt out by digest like the
table's buckets, so what was loaded before is read where it lies and never shuffled, however
large it has grown; only the new rows move. Each load appends its own files to the buckets.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logstats.operators.cleaning import row_digest

DIGEST = "row_digest"


def open_digests(spark: SparkSession, table: str, path: str, buckets: int) -> None:
    """Make the table of digests known to the session; its files lie at ``path``.

    The number of ``buckets`` is fixed by the first load, and must be the same in every session.
    """
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} ({DIGEST} STRING) USING parquet "
        f"CLUSTERED BY ({DIGEST}) INTO {int(buckets)} BUCKETS LOCATION '{path}'"
    )


def new_rows(log: DataFrame, table: str) -> DataFrame:
    """Rows of ``log``, once each, that no load before had, with their ``row_digest``."""
    spark = log.sparkSession
    digested = log.withColumn(DIGEST, row_digest(log.columns)).dropDuplicates([DIGEST])
    # The side that was loaded before is never the one to move.
    before = spark.table(table).select(F.col(DIGEST).alias("_loaded"))
    return digested.join(before.hint("merge"), F.col(DIGEST) == F.col("_loaded"), "left_anti")


def add_digests(loaded: DataFrame, table: str, buckets: int) -> None:
    """Append the digests of rows that have been written; one file for each bucket."""
    digests = loaded.select(DIGEST).repartition(buckets, DIGEST)
    digests.write.mode("append").insertInto(table)
