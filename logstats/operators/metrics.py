"""Durations, interruption rates and diagnostic counts.

Row-level operators take and return rows, as the step-by-step analysis does. The
report in ``logstats.plans`` gets the same numbers from two aggregations.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logstats.functions import count_rows_where, event_day, ipte_rate
from logstats.operators.groups import (
    Bounded,
    GroupSizes,
    add_group_stats,
    group_sizes,
    join_groups,
    lagged,
    running_total,
)
from logstats.settings import DEFAULTS, EXAM, ORDER, UNIT, Settings, check_mode


# The base-two logarithm of the registers of a sketch; 2^14 have a standard error of 0.8 percent.
SKETCH_LG_K = 14


def add_day(events: DataFrame) -> DataFrame:
    return events.withColumn("day", event_day(F.col("tick")))


def exam_duration(
    events: DataFrame, bounded: Bounded = None, settings: Settings = DEFAULTS
) -> DataFrame:
    """Last and first tick of the row's exam and the seconds between them."""
    ends = {"exam_dur_max": F.max("tick"), "exam_dur_min": F.min("tick")}
    timed = add_group_stats(events, EXAM, ends, bounded, settings.max_group_rows)
    return timed.withColumn("exam_dur_sec", F.col("exam_dur_max") - F.col("exam_dur_min"))


def exams_short(timed: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    return timed.filter(F.col("exam_dur_sec") < settings.min_exam_s)


def exams_long(timed: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    return timed.filter(F.col("exam_dur_sec") >= settings.min_exam_s)


def rank_duration(
    timed: DataFrame, bounded: Bounded = None, settings: Settings = DEFAULTS
) -> DataFrame:
    """Rows that rank first by duration in their exam, ties included.

    These are the rows with the exam's largest duration, found without sorting it.
    """
    longest = {"_longest": F.max("exam_dur_sec")}
    ranked = add_group_stats(timed, EXAM, longest, bounded, settings.max_group_rows)
    first = F.col("exam_dur_sec").eqNullSafe(F.col("_longest"))
    return ranked.filter(first).drop("_longest").withColumn("rank_val", F.lit(1))


def time_lag(
    events: DataFrame, settings: Settings = DEFAULTS, bounded: Bounded = None
) -> DataFrame:
    """Tick of the row before in the same exam."""
    max_rows = settings.max_group_rows
    return lagged(events, EXAM, ORDER, "tick", "time_seq_lag", max_rows, bounded)


def _nth_row() -> Column:
    return F.row_number().over(Window.partitionBy(*UNIT).orderBy(*ORDER))


def first_rows(rows: DataFrame) -> DataFrame:
    """The first row of each machine; cut down on the map side before the shuffle."""
    return rows.withColumn("_nth", _nth_row()).filter("_nth = 1").drop("_nth")


def _with_machine_sums(
    rows: DataFrame,
    of_exam: Mapping[str, Column],
    of_machine: Mapping[str, Column],
    bounded: Bounded,
    max_rows: int,
) -> DataFrame:
    """First row of each machine with aggregates over its exams.

    ``of_exam`` are aggregates of an exam's rows, ``of_machine`` aggregates of those.
    """
    if bounded is None:
        bounded = group_sizes(rows, UNIT, max_rows)
    if not bounded:
        exams = rows.groupBy(*EXAM).agg(*(value.alias(name) for name, value in of_exam.items()))
        sums = [value.alias(name) for name, value in of_machine.items()]
        return join_groups(first_rows(rows), exams.groupBy(*UNIT).agg(*sums), UNIT)
    # A window per exam marks one row of it, and one per machine sums those rows up.
    first_of_exam = F.row_number().over(Window.partitionBy(*EXAM).orderBy(*ORDER)) == 1
    marked = rows.withColumn("_first", first_of_exam)
    exam, machine = Window.partitionBy(*EXAM), Window.partitionBy(*UNIT)
    marked = marked.withColumns({name: value.over(exam) for name, value in of_exam.items()})
    once = {name: F.when(F.col("_first"), F.col(name)) for name in of_exam}
    marked = marked.withColumns(once)
    marked = marked.withColumns({name: v.over(machine) for name, v in of_machine.items()})
    helpers = [name for name in of_exam if name not in of_machine]
    return first_rows(marked).drop("_first", *helpers)


def _exam_count(settings: Settings) -> tuple[Column, Column]:
    """What an exam counts, and the sum of that: its rows of the exam code, or one."""
    coded = count_rows_where(F.col("code") == settings.exam_code)
    counts = {"code": coded, "segment": F.max(F.lit(1).cast("bigint"))}
    return counts[settings.num_exams_by], F.sum("_exams")


def ipte_and_weighted(
    rows: DataFrame, settings: Settings = DEFAULTS, bounded: Bounded = None
) -> DataFrame:
    """What ``ipte`` and ``ipte_weighted`` give, on one row per machine, in one pass.

    An exam's count, least incidents and largest weight are one state, and a machine's sums
    of them another, so the rows are not gone over once for each rate and joined.
    """
    count, total = _exam_count(settings)
    of_exam = {"_exams": count, "_least": F.min("num_shutdowns"), "_weight": F.max("mebef_wt")}
    of_machine = {
        "num_exams": total,
        "num_sev1": F.min("_least"),
        "sum_max_wt_all_exams": F.sum("_weight"),
    }
    counted = _with_machine_sums(rows, of_exam, of_machine, bounded, settings.max_group_rows)
    rates = {"ipte_severity": "num_sev1", "ipte_weighted": "sum_max_wt_all_exams"}
    return counted.withColumns(
        {name: ipte_rate(F.col(of), F.col("num_exams")) for name, of in rates.items()}
    )


def ipte(
    rows: DataFrame,
    settings: Settings = DEFAULTS,
    mode: str = "intended",
    bounded: Bounded = None,
) -> DataFrame:
    """First row per machine with its exams, severity-one incidents and their rate.

    Literal looks at that row alone, so every machine has one exam.
    """
    check_mode(mode)
    if mode == "literal":
        one = F.lit(1).cast("bigint")
        counted = first_rows(rows).withColumns(
            {"num_exams": one, "num_sev1": F.col("num_shutdowns")}
        )
    else:
        count, total = _exam_count(settings)
        of_exam = {"_exams": count, "_least": F.min("num_shutdowns")}
        of_machine = {"num_exams": total, "num_sev1": F.min("_least")}
        counted = _with_machine_sums(
            rows, of_exam, of_machine, bounded, settings.max_group_rows
        )
    return counted.withColumn("ipte_severity", ipte_rate(F.col("num_sev1"), F.col("num_exams")))


def ipte_weighted(
    rows: DataFrame,
    settings: Settings = DEFAULTS,
    mode: str = "intended",
    bounded: Bounded = None,
) -> DataFrame:
    """First row per machine with the sum of its exams' largest weights and their rate."""
    check_mode(mode)
    if mode == "literal":
        counted = first_rows(rows).withColumns(
            {"_total": F.lit(1), "sum_max_wt_all_exams": F.col("mebef_wt")}
        )
    else:
        count, total = _exam_count(settings)
        of_exam = {"_exams": count, "_weight": F.max("mebef_wt")}
        of_machine = {"_total": total, "sum_max_wt_all_exams": F.sum("_weight")}
        counted = _with_machine_sums(
            rows, of_exam, of_machine, bounded, settings.max_group_rows
        )
    rate = ipte_rate(F.col("sum_max_wt_all_exams"), F.col("_total"))
    return counted.withColumn("ipte_weighted", rate).drop("_total")


def additional_stats(
    rows: DataFrame,
    settings: Settings = DEFAULTS,
    mode: str = "intended",
    bounded: Bounded = None,
) -> DataFrame:
    """Resets of the row's machine and its last and first tick.

    Literal has all three as the number of the machine's rows up to the row's tick.
    """
    check_mode(mode)
    names = ("num_tps_resets", "time_seq_min", "time_seq_max")
    max_rows = settings.max_group_rows
    if bounded is None:
        bounded = group_sizes(rows, UNIT, max_rows)
    if mode == "intended":
        resets = count_rows_where(F.col("code") == settings.reset_code)
        stats = dict(zip(names, (resets, F.min("tick"), F.max("tick"))))
        return add_group_stats(rows, UNIT, stats, bounded)
    if bounded:
        up_to = Window.partitionBy(*UNIT).orderBy("tick")  # equal ticks included
        counted = rows.withColumn("_count", F.count(F.lit(1)).over(up_to))
    else:
        keys = (*UNIT, "tick")
        sizes = bounded if isinstance(bounded, GroupSizes) else None
        per_tick = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
        counts = running_total(per_tick, UNIT, ("tick",), "_n", "_count", max_rows, sizes)
        counted = join_groups(rows, counts.drop("_n"), keys)
    return counted.withColumns({name: F.col("_count") for name in names}).drop("_count")


def top_row_per_machine(rows: DataFrame) -> DataFrame:
    """The row with the highest severity rate per machine."""
    steps = Window.partitionBy(*UNIT).orderBy(
        F.desc("ipte_severity"), F.desc("system_id"), *ORDER
    )
    return rows.withColumn("row_num", F.row_number().over(steps)).filter("row_num = 1")


def run_metrics(events: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Shutdown rows, crash rows and rows of weight 1, in one pass."""
    return events.agg(
        count_rows_where(F.col("code").isin(*settings.shutdown_codes)).alias("shutdown_rows"),
        count_rows_where(F.col("code").isin(*settings.crash_codes)).alias("crash_rows"),
        count_rows_where(F.col("mebef_wt") == 1.0).alias("weight_one_rows"),
    )


def distinct_counts(events: DataFrame) -> DataFrame:
    """Distinct exams and systems; pairs are made distinct before either is counted."""
    pairs = events.select("system_id", "exam_id").distinct()
    return pairs.agg(
        F.count_distinct("exam_id").alias("num_exams"),
        F.count_distinct("system_id").alias("num_systems"),
    )


def daily_sketches(events: DataFrame, lg_k: int = SKETCH_LG_K) -> DataFrame:
    """Per ``day`` a sketch of its exams and one of its systems, of a few kilobytes each.

    Sketches of any days can be put together, which counts of days cannot: an exam or a
    system is on several of them.
    """
    return add_day(events).groupBy("day").agg(
        F.hll_sketch_agg("exam_id", lg_k).alias("exams"),
        F.hll_sketch_agg("system_id", lg_k).alias("systems"),
    )


def period_distinct_counts(sketches: DataFrame) -> DataFrame:
    """About how many exams and systems there are on the days of these sketches."""
    return sketches.agg(
        F.coalesce(F.hll_sketch_estimate(F.hll_union_agg("exams")), F.lit(0)).alias("num_exams"),
        F.coalesce(F.hll_sketch_estimate(F.hll_union_agg("systems")), F.lit(0)).alias("num_systems"),
    )


def sketch_error(lg_k: int = SKETCH_LG_K) -> float:
    """Three standard errors of an estimate, as a share of the count."""
    return 3 * 1.04 / math.sqrt(1 << lg_k)


def duration_stats(events: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Rows and exams below, from, and regardless of the least duration."""
    exams = events.groupBy(*EXAM).agg(
        (F.max("tick") - F.min("tick")).alias("_seconds"), F.count(F.lit(1)).alias("_rows")
    )
    short = F.col("_seconds") < settings.min_exam_s
    return exams.agg(
        F.coalesce(F.sum(F.when(short, F.col("_rows"))), F.lit(0)).alias("short_rows"),
        F.coalesce(F.sum(F.when(~short, F.col("_rows"))), F.lit(0)).alias("long_rows"),
        F.coalesce(F.sum("_rows"), F.lit(0)).alias("all_rows"),
        count_rows_where(short).alias("short_exams"),
        count_rows_where(~short).alias("long_exams"),
        F.count(F.lit(1)).alias("all_exams"),
    )


def fleet_shutdowns(rows: DataFrame) -> DataFrame:
    return rows.agg(F.sum("num_shutdowns").alias("fleet_shutdowns"))


def sum_by_key(rows: DataFrame, key: str) -> DataFrame:
    """Sums of all numeric columns per value of ``key``, as ``sum_<column>``."""
    numeric = [
        field.name for field in rows.schema.fields if isinstance(field.dataType, T.NumericType)
    ]
    return rows.groupBy(key).agg(*(F.sum(name).alias(f"sum_{name}") for name in numeric))


def cumulative_ipte(report: DataFrame) -> DataFrame:
    """Machines with shutdowns, shutdowns and exams of the fleet, and their rate."""
    totals = report.agg(
        count_rows_where(F.col("num_shutdowns") > 0).alias("num_sys"),
        F.sum("num_shutdowns").alias("cum_shutdowns"),
        F.sum("num_exams").alias("cum_exams"),
    )
    return totals.withColumn(
        "cum_ipte", ipte_rate(F.col("cum_shutdowns"), F.col("cum_exams"))
    )


def stage_counts(*counts: DataFrame) -> DataFrame:
    """(stage, n) from one-row frames whose columns are stage names."""
    parts = [frame.unpivot([], list(frame.columns), "stage", "n") for frame in counts]
    return functools.reduce(DataFrame.unionByName, parts)
