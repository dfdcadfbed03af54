"""Cutting a machine's log into exams with running windows.

In time order, a start code opens an exam unless a service code came less than
``service_gap_s`` before it; then it is a service start, which throws the open exam
away. An exam ends with its first stop code (kept), with its first row later than
``max_exam_s`` after the start (not kept), or when the next exam starts. An exam that
reaches none of these is dropped.

All windows share one partitioning and order, so the log is shuffled and sorted once.
Looking ahead is a lead that skips nulls, which is one pass; a frame that ends at the last
row would be evaluated anew for each row. Where a task would get more than ``max_group_rows`` rows
of one machine, they are scanned in chunks: each chunk is summed up in one row, the few
summary rows of a machine are scanned in order, and what a chunk needs to know about its
neighbours is joined back.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logstats.operators.catalog import add_roles
from logstats.operators.cleaning import usable_rows
from logstats.operators.groups import (
    CHUNK,
    Bounded,
    GroupSizes,
    SplitRows,
    group_sizes,
    split_groups,
)
from logstats.schemas import EXAM_RECORD
from logstats.settings import DEFAULTS, EXAM, ORDER, UNIT, Settings

STOPPED, TIMED_OUT, SUPERSEDED = "stopped", "timed_out", "superseded"
OPEN, DISCARDED, SERVICE = "open_at_end", "discarded_by_service", "service"
CLOSED = (STOPPED, TIMED_OUT, SUPERSEDED)

# One task scans the rows of a system. The later dedup and sums are per system and more, and
# need no further shuffle, also where other keys are constants that Spark folds away.
TASK_KEYS = ("system_id",)

_FIRST, _THIS, _PREVIOUS = Window.unboundedPreceding, Window.currentRow, -1


def _no(condition: Column) -> Column:
    """The condition with null taken as false."""
    return F.coalesce(condition, F.lit(False))


def _is_real(tick: Column, last_service: Column, settings: Settings) -> Column:
    return last_service.isNull() | (tick - last_service >= settings.service_gap_s)


def _within_limit(tick: Column, start_tick: Column, settings: Settings) -> Column:
    return tick <= start_tick + settings.max_exam_s


def _with_start_id(rows: DataFrame) -> DataFrame:
    """Start rows with the id their exam will have; hashed for start rows only."""
    key = F.concat_ws("-", *UNIT, "time_seq", F.col("event_key").cast("string"))
    return rows.withColumn("_start_id", F.when(F.col("is_start"), F.md5(key)))


def _next_known(name: str) -> Column:
    """The first value after the row that is not null; over an ordered window."""
    return F.expr(f"lead({name}) IGNORE NULLS")


def _is_stop() -> Column:
    return F.col("is_monitored") & F.col("is_stop")


def _chunk_summaries(hot: DataFrame, *more: Column) -> DataFrame:
    """One row per chunk: its services and starts, what it does to an open exam, and ``more``
    aggregates of its rows."""
    steps = Window.partitionBy(*UNIT, CHUNK).orderBy(*ORDER)
    up_to = steps.rowsBetween(_FIRST, _THIS)
    tick = F.col("tick")
    here = F.struct("_row", "tick", "_service", "_start_id")
    scanned = (
        hot.withColumns(
            {
                "_row": F.row_number().over(steps),
                "_service": F.max(F.when(F.col("is_service"), tick)).over(up_to),
            }
        )
        .withColumn("_start_here", F.when(F.col("is_start"), here))
        .withColumn("_start_row", F.max(F.when(F.col("is_start"), F.col("_row"))).over(up_to))
    )
    before_starts = F.col("_start_row").isNull()
    return scanned.groupBy(*UNIT, CHUNK).agg(
        F.max("_service").alias("service"),
        F.min("_start_here").alias("first_start"),
        F.max("_start_here").alias("last_start"),
        F.max(F.when(_is_stop(), F.col("_start_row"))).alias("stopped_start"),
        F.min(F.when(before_starts & _is_stop(), tick)).alias("first_stop"),
        F.max(F.when(before_starts & F.col("is_monitored"), tick)).alias("last_monitored"),
        *more,
    )


def _chunk_carries(hot: DataFrame, settings: Settings) -> DataFrame:
    return _carries_of(_chunk_summaries(hot), settings)


def _carries_of(summaries: DataFrame, settings: Settings) -> DataFrame:
    """What each chunk inherits: last service, open start, whether it stopped, how it ends."""
    steps = Window.partitionBy(*UNIT).orderBy(CHUNK)
    before = steps.rowsBetween(_FIRST, _PREVIOUS)
    first, last, opened = F.col("first_start"), F.col("last_start"), F.col("_opened")

    def real(start: Column) -> Column:
        service = F.coalesce(start["_service"], F.col("carry_service"))
        return _is_real(start["tick"], service, settings)

    left_open = F.struct(
        last["tick"].alias("tick"),
        real(last).alias("real"),
        last["_start_id"].alias("start_id"),
        F.col(CHUNK).alias("chunk"),
        _no(F.col("stopped_start") == last["_row"]).alias("stopped"),
    )
    carried = (
        summaries.withColumn("carry_service", F.max("service").over(before))
        .withColumn("_left_open", F.when(last.isNotNull(), left_open))
        .withColumn("_opened", F.last("_left_open", ignorenulls=True).over(before))
        .withColumn(
            "_stop_chunk",
            F.max(F.when(F.col("first_stop").isNotNull(), F.col(CHUNK))).over(before),
        )
    )
    ending = (
        F.when(_within_limit(F.col("first_stop"), opened["tick"], settings), STOPPED)
        .when(~_within_limit(F.col("last_monitored"), opened["tick"], settings), TIMED_OUT)
        .when(first.isNotNull() & real(first), SUPERSEDED)
        .when(first.isNotNull(), DISCARDED)
    )
    stopped = opened["stopped"] | _no(F.col("_stop_chunk") > opened["chunk"])
    return carried.withColumn("_ending", ending).select(
        *UNIT,
        CHUNK,
        "carry_service",
        opened["tick"].alias("carry_tick"),
        opened["real"].alias("carry_real"),
        opened["start_id"].alias("carry_id"),
        stopped.alias("carry_stopped"),
        _next_known("_ending").over(steps).alias("carry_ending"),
    )


def _scan(
    rows: DataFrame,
    keys: Sequence[str],
    carried: bool,
    settings: Settings,
    keep_limit: bool = False,
) -> DataFrame:
    steps = Window.partitionBy(*keys).orderBy(*ORDER)
    up_to, before = steps.rowsBetween(_FIRST, _THIS), steps.rowsBetween(_FIRST, _PREVIOUS)
    tick, row, is_start = F.col("tick"), F.col("_row"), F.col("is_start")

    def inherit(value: Column, name: str) -> Column:
        return F.coalesce(value, F.col(name)) if carried else value

    last_service = F.max(F.when(F.col("is_service"), tick)).over(up_to)
    numbered = rows.withColumns(
        {"_row": F.row_number().over(steps), "_service": inherit(last_service, "carry_service")}
    ).withColumn("_real", _is_real(tick, F.col("_service"), settings))

    # The running maximum of this mark gives the row of the last start and, in its lowest
    # bit, whether that start is real. A start carried into the chunk has row 0.
    mark = row * 2 + F.col("_real").cast("int")
    last_mark = F.max(F.when(is_start, mark)).over(up_to)
    if carried:
        last_mark = F.coalesce(last_mark, F.col("carry_real").cast("int"))
    last_id = F.last(F.when(is_start, F.col("_start_id")), ignorenulls=True).over(up_to)
    started = numbered.withColumns(
        {
            "_mark": last_mark,
            "exam_start": inherit(F.max(F.when(is_start, tick)).over(up_to), "carry_tick"),
            "exam_id": inherit(last_id, "carry_id"),
            "_last_stop": F.max(F.when(_is_stop(), row)).over(before),
        }
    )

    # A row outside a real exam has no part in what follows, unless it is a start. A stop
    # before a row within the limit was within the limit, too.
    start_row = F.shiftright("_mark", 1)
    in_real = _no(F.col("_mark").bitwiseAND(1) == 1)
    stopped = _no(F.col("_last_stop") >= start_row)
    if carried:
        stopped = stopped | ((start_row == 0) & _no(F.col("carry_stopped")))
    in_limit = F.col("is_monitored") & in_real
    in_limit = in_limit & _within_limit(tick, F.col("exam_start"), settings)
    candidates = started.filter(is_start | (F.col("is_monitored") & in_real & ~stopped))
    candidates = candidates.withColumn("_in_limit", in_limit)

    stops = F.col("_in_limit") & F.col("is_stop")
    event = (
        F.when(is_start, F.when(F.col("_real"), SUPERSEDED).otherwise(DISCARDED))
        .when(stops, STOPPED)
        .when(~F.col("_in_limit"), TIMED_OUT)
    )
    ending = inherit(_next_known("_event").over(steps), "carry_ending")
    outcome = (
        F.when(is_start & ~F.col("_real"), SERVICE)
        .when(stops, STOPPED)
        .otherwise(F.coalesce("_ending", F.lit(OPEN)))
    )
    cut = (
        candidates.withColumn("_event", event)
        .withColumn("_ending", ending)
        .withColumn("outcome", outcome)
        .withColumn("kept", F.col("_in_limit") & F.col("outcome").isin(*CLOSED))
    )
    if keep_limit:
        cut = cut.withColumn("in_limit", F.col("_in_limit"))
    return cut.drop(
        *("_start_id", "_row", "_service", "_real", "_mark", "_last_stop"),
        *("_in_limit", "_event", "_ending", CHUNK),
        *("carry_service", "carry_tick", "carry_real", "carry_id"),
        *("carry_stopped", "carry_ending"),
    )


def log_bounded(
    log: DataFrame, code_actions: DataFrame, settings: Settings = DEFAULTS
) -> GroupSizes:
    """Which machines have more rows to scan than a task may get; see ``groups``."""
    usable = usable_rows(add_roles(log.select(*UNIT, "code", "tick"), code_actions))
    return group_sizes(usable, TASK_KEYS, settings.max_group_rows)


def cut_exams(
    log: DataFrame,
    code_actions: DataFrame,
    settings: Settings = DEFAULTS,
    bounded: Bounded = None,
) -> DataFrame:
    """Rows that start an exam or may belong to one, with ``exam_id``, ``exam_start``,
    the ``outcome`` of their exam and whether they are ``kept``.

    ``log`` has the columns of ``prepare_log``; what else it has is passed on.
    """
    relevant = add_roles(log, code_actions)
    rows = _with_start_id(usable_rows(relevant))
    if bounded is None:
        bounded = log_bounded(log, code_actions, settings)
    split = split_groups(rows, UNIT, ORDER, settings.max_group_rows, bounded)
    return _scan_split(SplitRows(split.rows.repartition(*TASK_KEYS), split.hot), settings)


def cut_split(split: SplitRows, roles: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """``cut_exams`` of usable rows that lie by machine, and by chunk, already.

    ``roles`` are the ``code_roles``; broadcast, they leave the rows where they are.
    """
    parts = (
        None if part is None else _with_start_id(part.join(roles, "code"))
        for part in (split.rows, split.hot)
    )
    return _scan_split(SplitRows(*parts), settings)


def _scan_split(split: SplitRows, settings: Settings) -> DataFrame:
    whole = _scan(split.rows, UNIT, False, settings)
    if split.hot is None:
        return whole
    keys = [*UNIT, CHUNK]
    inherited = split.hot.join(_chunk_carries(split.hot, settings), keys)
    return whole.unionByName(_scan(inherited, keys, True, settings))


def exam_segments(
    log: DataFrame,
    code_actions: DataFrame,
    settings: Settings = DEFAULTS,
    bounded: Bounded = None,
) -> DataFrame:
    """One row per start with the outcome of what it started."""
    return (
        cut_exams(log, code_actions, settings, bounded)
        .filter("is_start")
        .select(*EXAM, F.col("event_key").alias("start_event"), "exam_start", "outcome")
    )


def service_starts(
    log: DataFrame,
    code_actions: DataFrame,
    settings: Settings = DEFAULTS,
    bounded: Bounded = None,
) -> DataFrame:
    """Start rows that a service code came shortly before."""
    segments = exam_segments(log, code_actions, settings, bounded)
    return segments.filter(F.col("outcome") == SERVICE).drop("outcome")


def exam_events(
    log: DataFrame,
    code_actions: DataFrame,
    settings: Settings = DEFAULTS,
    bounded: Bounded = None,
) -> DataFrame:
    """The kept rows as exam records without level and weight, with their order columns.

    A record column the log does not have is null.
    """
    return kept_records(cut_exams(log, code_actions, settings, bounded))


def kept_records(cut: DataFrame) -> DataFrame:
    """The kept rows of a cut as exam records; see ``exam_events``."""
    kept = cut.filter("kept")
    # Columns that hold their own name.
    kept = kept.withColumns({name: F.lit(name) for name in ("psd", "coil", "scan")})
    later = ("mebef_level", "mebef_wt")
    missing = [name for name in EXAM_RECORD if name not in (*kept.columns, *later)]
    kept = kept.withColumns({name: F.lit(None).cast("string") for name in missing})
    record = [name for name in EXAM_RECORD if name not in later]
    return kept.select(*record, *ORDER, "exam_start")


def exam_summary(events: DataFrame) -> DataFrame:
    """Per exam its first and last tick and number of rows."""
    return events.groupBy(*EXAM).agg(
        F.min("tick").alias("exam_first"),
        F.max("tick").alias("exam_last"),
        F.count(F.lit(1)).alias("num_rows"),
    )
