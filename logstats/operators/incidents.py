"""Shutdowns and crashes: flags per row, sums per exam and per machine."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from logstats.functions import code_flag
from logstats.operators.groups import Bounded, add_group_stats, group_sizes, join_groups
from logstats.settings import DEFAULTS, EXAM, ORDER, UNIT, Settings, check_mode


def incident_flags(events: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """0/1 columns for shutdown and crash rows, their sum, and ``ip_st`` for either."""
    shutdown = code_flag(F.col("code"), settings.shutdown_codes)
    crash = code_flag(F.col("code"), settings.crash_codes)
    return events.withColumns(
        {
            "actual_num_shutdowns": shutdown,
            "actual_num_crashes": crash,
            "sum_shutdown_crashes": shutdown + crash,
            "ip_st": F.when(shutdown + crash > 0, 1).otherwise(0),
        }
    )


def exam_incidents(
    flagged: DataFrame, bounded: Bounded = None, settings: Settings = DEFAULTS
) -> DataFrame:
    """``sum_ipst``: interruptions of the row's exam."""
    sums = {"sum_ipst": F.sum("ip_st")}
    return add_group_stats(flagged, EXAM, sums, bounded, settings.max_group_rows)


def subtraction_rule(rows: DataFrame) -> DataFrame:
    """``num_shutdowns_day``: interruptions of the exam, one less on shutdown rows."""
    less = F.when(F.col("actual_num_shutdowns") > 0, F.col("sum_ipst") - 1)
    return rows.withColumn("num_shutdowns_day", less.otherwise(F.col("sum_ipst")))


def total_shutdowns(
    rows: DataFrame,
    mode: str = "intended",
    bounded: Bounded = None,
    settings: Settings = DEFAULTS,
) -> DataFrame:
    """``num_shutdowns`` of the row's machine.

    Intended: an exam counts once, with its interruptions less one if it was shut down.
    Literal: ``num_shutdowns_day`` is summed over rows, so long exams count repeatedly.
    """
    check_mode(mode)
    if mode == "literal":
        sums = {"num_shutdowns": F.sum("num_shutdowns_day")}
        return add_group_stats(rows, UNIT, sums, bounded, settings.max_group_rows)
    if bounded is None:
        bounded = group_sizes(rows, UNIT, settings.max_group_rows)
    # Each row bears its own interruption, and an exam's first shutdown row one less.
    nth = Window.partitionBy(*EXAM, "actual_num_shutdowns").orderBy(*ORDER)
    first_shutdown = (F.col("actual_num_shutdowns") > 0) & (F.row_number().over(nth) == 1)
    if bounded:
        less = F.when(first_shutdown, 1).otherwise(0)
        share = rows.withColumn("_share", F.col("ip_st") - less)
        return add_group_stats(share, UNIT, {"num_shutdowns": F.sum("_share")}, True).drop("_share")
    rows = rows.drop("num_shutdowns")
    exams = rows.groupBy(*EXAM).agg(
        (F.sum("ip_st") - F.max("actual_num_shutdowns")).alias("_interruptions")
    )
    machines = exams.groupBy(*UNIT).agg(F.sum("_interruptions").alias("num_shutdowns"))
    return join_groups(rows, machines, UNIT)


def shutdown_crash_counts(
    events: DataFrame,
    settings: Settings = DEFAULTS,
    frame: str = "row",
    mode: str = "intended",
    bounded: Bounded = None,
) -> DataFrame:
    """Shutdown and crash rows counted over the row itself or over its exam and day.

    Literal counts every row whatever its code.
    """
    check_mode(mode)
    if frame not in ("row", "exam_day"):
        raise ValueError("frame must be 'row' or 'exam_day'")
    if mode == "literal":
        shutdown = crash = F.lit(1).cast("bigint")
    else:
        shutdown = code_flag(F.col("code"), settings.shutdown_codes).cast("bigint")
        crash = code_flag(F.col("code"), settings.crash_codes).cast("bigint")
    counts = {"actual_num_shutdowns": shutdown, "actual_num_crashes": crash}
    if frame == "row":
        return events.withColumns(counts)
    keys = (*UNIT, "day", "exam_id")
    sums = {name: F.sum(count) for name, count in counts.items()}
    return add_group_stats(events, keys, sums, bounded, settings.max_group_rows)
