"""Cleaning: columns, filters, null and duplicate removal, and the typed log."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logstats.functions import parse_tick
from logstats.settings import CONFIG, ORDER, SOFTWARE_REV, UNIT, check_mode

# Log columns the analysis reads; a row without any of these cannot be used.
NEEDED = ("tar_systemid", "msg_code", "time_seq")

# Names in an exam record and the log columns they come from.
RECORD_SOURCES = {
    "system_id": "tar_systemid",
    "sw_rev": "software_rev",
    "config": "config",
    "file_name": "inputfilename",
    "log_local_ts": "msg_time",
    "log_message_ts": "msg_datetime",
    "code": "msg_code",
    "time_seq": "time_seq",
    "source": "msg_source",
    "msg_text": "msg_text",
    "msg_date": "msg_date",
}


def drop_columns(rows: DataFrame, *names: str) -> DataFrame:
    return rows.drop(*names)


def filter_dates(
    log: DataFrame, first: str | None, last: str | None, mode: str = "intended"
) -> DataFrame:
    """Rows of the days ``first`` to ``last``, both included; None leaves that end open.

    A row without a day is kept only if both ends are open; literal keeps all rows.
    """
    check_mode(mode)
    if mode == "literal":
        return log
    if first is not None:
        log = log.filter(F.col("msg_date") >= first)
    return log if last is None else log.filter(F.col("msg_date") <= last)


def filter_systems(
    log: DataFrame,
    systems: DataFrame,
    mode: str = "intended",
    log_key: str = "tar_systemid",
) -> DataFrame:
    """Rows of listed systems; a system listed twice does not double its rows.

    Literal keeps all rows. A short list is broadcast by its size, a long one is merged.
    """
    check_mode(mode)
    if mode == "literal":
        return log
    return log.join(systems, F.col(log_key) == F.col("sysid"), "left_semi")


def dedup_rows(rows: DataFrame) -> DataFrame:
    """Whole-row duplicates removed; copies collapse on the map side already."""
    return rows.dropDuplicates()


def drop_incomplete(
    rows: DataFrame, needed: Sequence[str] = NEEDED, all_columns: bool = False
) -> DataFrame:
    """Rows without a null in ``needed``, or without any null at all."""
    return rows.dropna(how="any", subset=None if all_columns else list(needed))


def add_constants(
    log: DataFrame, config: str = CONFIG, software_rev: str = SOFTWARE_REV
) -> DataFrame:
    return log.withColumns({"config": F.lit(config), "software_rev": F.lit(software_rev)})


def distinct_units(log: DataFrame) -> DataFrame:
    return log.select("tar_systemid", "software_rev", "config").distinct()


def clean_log(log: DataFrame, all_columns: bool = False) -> DataFrame:
    """Complete rows, once each, without the ``dummy`` column.

    Null removal needs no shuffle and looks at one row only, so it runs before the
    single deduplication; the result is that of dedup, null removal, column drop and
    a second dedup.
    """
    complete = drop_incomplete(log, all_columns=all_columns)
    return dedup_rows(drop_columns(complete, "dummy"))


def row_digest(columns: Sequence[str]) -> Column:
    """A digest of all columns by name; a null differs from every text, and so does a value
    that stands in another column."""
    marked = [
        F.coalesce(F.concat(F.lit("="), F.col(name).cast("string")), F.lit("-"))
        for name in sorted(columns)
    ]
    lengths = [F.length(value).cast("string") for value in marked]
    return F.sha2(F.concat_ws("|", *lengths, *marked), 256)


def staged_log(log: DataFrame, all_columns: bool = False) -> DataFrame:
    """``clean_log`` with only the columns that ``prepare_log`` reads, and ``row_digest``.

    Rows are the same if their digests are, so the shuffle of the dedup carries a digest in
    place of the columns that nothing reads. A null ``dummy`` counts as a null of its row.
    """
    complete = drop_columns(drop_incomplete(log, all_columns=all_columns), "dummy")
    used = [name for name in (*RECORD_SOURCES.values(), "seq_num") if name in complete.columns]
    digest = row_digest(complete.columns).alias("row_digest")
    return complete.select(*dict.fromkeys(used), digest).dropDuplicates(["row_digest"])


def prepare_log(log: DataFrame) -> DataFrame:
    """Cleaned log rows under their record names, typed and with a total order.

    ``seq_num`` breaks ties of equal ticks. It may be missing or repeat, so a hash of
    the whole row comes last and also tells exams with equal start ticks apart.
    """
    record = {name: F.col(source) for name, source in RECORD_SOURCES.items()}
    digest = F.col("row_digest") if "row_digest" in log.columns else row_digest(log.columns)
    keys = {
        "tick": parse_tick(F.col("time_seq")),
        "seq": F.col("seq_num").try_cast("bigint"),
        "event_key": F.xxhash64(digest),
    }
    return log.select(*(value.alias(name) for name, value in {**record, **keys}.items()))


def usable_rows(log: DataFrame) -> DataFrame:
    """Rows that belong to a machine and carry a tick."""
    present = F.col("tick").isNotNull()
    for name in UNIT:
        present = present & F.col(name).isNotNull()
    return log.filter(present)


def dedup_events(events: DataFrame, copies: str | None = None) -> DataFrame:
    """One row per system, revision, code and time, across exams.

    The row of the earliest exam stays. The limit per key is applied before the
    shuffle as well, so a large group of copies does not reach one task. With a name for
    ``copies``, the row has the number of rows it stands for, and copies are not cut before.
    """
    key = Window.partitionBy("system_id", "sw_rev", "code", "time_seq")
    order = key.orderBy("exam_start", *ORDER, "exam_id")
    if copies is not None:
        events = events.withColumn(copies, F.count(F.lit(1)).over(key))
    return events.withColumn("_nth", F.row_number().over(order)).filter("_nth = 1").drop("_nth")


def drop_blank_exam(events: DataFrame) -> DataFrame:
    return events.filter(F.col("exam_id") != "")
