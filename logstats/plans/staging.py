"""Staged logs that later analyses read without shuffling or reading them whole.

**By machine.** A prepared log as a bucketed table: all rows of a machine are in one bucket, a
bucket is one file, and a file is sorted by machine and time. A cut of it needs neither an
exchange nor a sort, however often it is made with other settings. Machines with more rows
than a task may get are not put into buckets: their rows are cut into chunks first, and the
chunks are the groups that a second table is bucketed and sorted by.

**By day.** Rows in one folder for each day, so that a range of days reads only its folders.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logstats.operators import exams
from logstats.operators.catalog import add_roles, code_roles
from logstats.operators.cleaning import filter_dates, usable_rows
from logstats.operators.groups import CHUNK, SplitRows, split_groups
from logstats.scratch import checkpointed, remove_path
from logstats.settings import DEFAULTS, ORDER, UNIT, Settings

DAY = "msg_date"
# At most so many codes, of a few hundred bytes each, are sent to every task.
BROADCAST_CODES = 100_000
# Fixed value: the session setting under which a bucket of one file is known to be sorted.
_SORTED_BUCKETS = "spark.sql.legacy.bucketedTableScan.outputOrdering"


@dataclass(frozen=True)
class MachineTables:
    """Names of the bucketed tables: rows of bounded machines, and of large ones by chunk."""

    rows: str
    hot: str | None
    path: str


def _write_buckets(
    rows: DataFrame, table: str, path: str, buckets: int, keys: Sequence[str], order: Sequence[str]
) -> None:
    # As many partitions as buckets, dealt out alike, make one file for each bucket.
    writer = rows.repartition(buckets, *keys).write.bucketBy(buckets, *keys)
    writer.sortBy(*order).option("path", path).saveAsTable(table)


def stage_by_machine(
    log: DataFrame,
    code_actions: DataFrame,
    name: str,
    path: str,
    buckets: int | None = None,
    settings: Settings = DEFAULTS,
) -> MachineTables:
    """Write a prepared log as tables ``name`` and, for large machines, ``name_hot``.

    Rows that cannot be part of a cut are left out. There are as many ``buckets`` as shuffle
    partitions unless told otherwise. Files go below ``path``, which must be new.
    """
    spark = log.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = usable_rows(add_roles(log, code_actions)).select(*log.columns)
    sizes = exams.log_bounded(log, code_actions, settings)
    split = split_groups(rows, UNIT, ORDER, settings.max_group_rows, sizes)
    order = [*UNIT, *ORDER]
    _write_buckets(split.rows, name, f"{path}/rows", buckets, exams.TASK_KEYS, order)
    if split.hot is None:
        return MachineTables(name, None, path)
    keys = [*UNIT, CHUNK]
    _write_buckets(split.hot, f"{name}_hot", f"{path}/hot", buckets, keys, [*keys, *ORDER])
    return MachineTables(name, f"{name}_hot", path)


def drop_tables(spark: SparkSession, tables: MachineTables) -> None:
    for name in filter(None, (tables.rows, tables.hot)):
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    remove_path(spark, tables.path)


@contextmanager
def sorted_buckets(spark: SparkSession) -> Iterator[None]:
    """Within this, plans that are made take the order of bucket files as given.

    A bucket must be one file, as ``stage_by_machine`` writes it. A frame is planned when it
    is first run.
    """
    before = spark.conf.get(_SORTED_BUCKETS)
    spark.conf.set(_SORTED_BUCKETS, "true")
    try:
        yield
    finally:
        spark.conf.set(_SORTED_BUCKETS, before)


def staged_cut(
    spark: SparkSession,
    tables: MachineTables,
    code_actions: DataFrame,
    settings: Settings = DEFAULTS,
) -> DataFrame:
    """``cut_exams`` of a staged log, without an exchange of its rows; run it within
    ``sorted_buckets`` to have no sort either.

    Codes with a role are counted, and broadcast up to ``BROADCAST_CODES``. Beyond that
    the log may have to be dealt out by code.
    """
    hot = None if tables.hot is None else spark.table(tables.hot)
    roles = checkpointed(code_roles(code_actions))
    if roles.limit(BROADCAST_CODES + 1).count() <= BROADCAST_CODES:
        roles = F.broadcast(roles)
    return exams.cut_split(SplitRows(spark.table(tables.rows), hot), roles, settings)


def stage_by_day(log: DataFrame, path: str) -> None:
    """Write rows into a folder for each day.

    Rows are dealt out by day, so that a day has few files; a large day is split, and small
    ones share a task, by their sizes at run time. Rows without a day have a folder, too.
    """
    log.hint("rebalance", F.col(DAY)).write.partitionBy(DAY).parquet(path)


def read_days(
    like: DataFrame, path: str, first: str | None = None, last: str | None = None
) -> DataFrame:
    """Rows of the days ``first`` to ``last`` of a staged log, from their folders only.

    ``like`` is a frame with the columns that were staged. The day stays text.
    """
    schema = like.schema
    rows = like.sparkSession.read.schema(schema).parquet(path).select(*schema.names)
    return filter_dates(rows, first, last)
