"""The machine report as one plan over a prepared log."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logstats.functions import code_flag, count_rows_where, ipte_rate
from logstats.operators import catalog, cleaning, exams, incidents, metrics
from logstats.operators.groups import Bounded, group_sizes, join_groups
from logstats.scratch import checkpointed
from logstats.schemas import MACHINE_REPORT
from logstats.settings import DEFAULTS, EXAM, ORDER, UNIT, Settings, check_mode


def final_events(
    log: DataFrame,
    code_actions: DataFrame,
    level_weights: DataFrame,
    settings: Settings = DEFAULTS,
    bounded: Bounded = None,
    copies: str | None = None,
) -> DataFrame:
    """Exam records with level and weight, once per system, revision, code and time.

    With a name for ``copies``, a record has the number of records it stands for.
    """
    cut = exams.exam_events(log, code_actions, settings, bounded)
    events = cleaning.dedup_events(cut, copies)
    events = catalog.attach_level(cleaning.drop_blank_exam(events), code_actions)
    return catalog.attach_weight(events, level_weights)


def _exam_totals(events: DataFrame, settings: Settings, *more: Column) -> DataFrame:
    """Sums of every exam, and whether it is ``long``."""
    shutdown = code_flag(F.col("code"), settings.shutdown_codes)
    either = code_flag(F.col("code"), (*settings.shutdown_codes, *settings.crash_codes))
    totals = events.groupBy(*EXAM).agg(
        F.min("tick").alias("first_tick"),
        F.max("tick").alias("last_tick"),
        F.count(F.lit(1)).alias("rows"),
        F.sum(either).alias("interruptions"),
        F.sum(shutdown).alias("shutdown_rows"),
        F.max("mebef_wt").alias("weight"),
        count_rows_where(F.col("code") == settings.exam_code).alias("coded"),
        count_rows_where(F.col("code") == settings.reset_code).alias("resets"),
        *more,
    )
    seconds = F.col("last_tick") - F.col("first_tick")
    return totals.withColumn("long", seconds >= settings.min_exam_s)


def _first_row(mode: str) -> list[Column]:
    """What the literal mode needs of an exam besides its sums."""
    return [] if mode == "intended" else [F.min(F.struct(*ORDER, "mebef_wt")).alias("first_row")]


def _machine_sums(settings: Settings, mode: str) -> list[Column]:
    """Aggregates of a machine over its long exams, for all its exams are there."""

    def of_long(value: Column | str) -> Column:
        return F.when(F.col("long"), F.col(value) if isinstance(value, str) else value)

    if mode == "literal":
        by_row = F.col("rows") * F.col("interruptions") - F.col("shutdown_rows")
        return [
            F.sum(of_long(by_row)).alias("num_shutdowns"),
            F.min(of_long("first_row")).alias("first_row"),
        ]
    less = F.when(F.col("shutdown_rows") > 0, 1).otherwise(0)
    num_exams = {"code": F.sum(of_long("coded")), "segment": F.count_if("long")}
    return [
        F.sum(of_long(F.col("interruptions") - less)).alias("num_shutdowns"),
        F.sum(of_long("weight")).alias("weight"),
        F.sum(of_long("resets")).alias("num_tps_resets"),
        num_exams[settings.num_exams_by].alias("num_exams"),
        F.max(of_long("last_tick")).alias("time_seq_max"),
        F.min(of_long("first_tick")).alias("time_seq_min"),
    ]


def _totals(sums: DataFrame, mode: str) -> DataFrame:
    """Literal has the first row's weight, and one for all counts."""
    if mode == "intended":
        return sums
    counts = ("num_tps_resets", "num_exams", "time_seq_max", "time_seq_min")
    weight = F.col("first_row.mebef_wt")
    return sums.withColumn("weight", weight).withColumns({name: F.lit(1) for name in counts})


def _rated(machines: DataFrame) -> DataFrame:
    return machines.withColumns(
        {
            "ipte_weighted": ipte_rate(F.col("weight"), F.col("num_exams")),
            "ipte_severity": ipte_rate(F.col("num_shutdowns"), F.col("num_exams")),
        }
    )


def _report_columns() -> list[Column]:
    return [F.col(field.name).cast(field.dataType) for field in MACHINE_REPORT.fields]


def _as_report(machines: DataFrame) -> DataFrame:
    return _rated(machines).select(*_report_columns())


def machine_report(
    log: DataFrame,
    code_actions: DataFrame,
    level_weights: DataFrame,
    settings: Settings = DEFAULTS,
    mode: str = "intended",
    bounded: Bounded = None,
) -> DataFrame:
    """One row per machine that has an exam of at least ``min_exam_s``.

    Everything after the cut is summed per exam and then per machine with partial
    aggregation, so neither a long exam nor a busy machine is gathered in one task.
    """
    events = final_events(log, code_actions, level_weights, settings, bounded)
    return report_from_events(events, settings, mode)


def report_from_events(
    events: DataFrame, settings: Settings = DEFAULTS, mode: str = "intended"
) -> DataFrame:
    """``machine_report`` from ``final_events``."""
    check_mode(mode)
    long = _exam_totals(events, settings, *_first_row(mode)).filter("long")
    sums = long.groupBy(*UNIT).agg(*_machine_sums(settings, mode))
    return _as_report(_totals(sums, mode))


# Counts of a run by stage, in the order in which they are reported.
RUN_COUNTS = (
    "in_exams", "num_exams", "num_systems", "shutdown_rows", "crash_rows", "weight_one_rows",
    "short_rows", "long_rows", "all_rows", "short_exams", "long_exams", "all_exams",
)


def counted_machines(events: DataFrame, settings: Settings, mode: str, copies: str) -> DataFrame:
    """A row for every machine with an exam, long or not: the report's columns, and for each of
    ``RUN_COUNTS`` the machine's share as ``count_<name>``.

    The shares are part of the rows, so their sums are right however often a task ran.
    ``events`` are ``final_events`` with ``copies``.
    """
    check_mode(mode)
    crashes = code_flag(F.col("code"), settings.crash_codes)
    more = [
        F.sum(copies).alias("copies"),
        F.sum(crashes).alias("crash_rows"),
        count_rows_where(F.col("mebef_wt") == 1.0).alias("weight_one_rows"),
    ]
    short = ~F.col("long")
    shares = {
        "in_exams": F.sum("copies"),
        "num_exams": F.count(F.lit(1)),
        "shutdown_rows": F.sum("shutdown_rows"),
        "crash_rows": F.sum("crash_rows"),
        "weight_one_rows": F.sum("weight_one_rows"),
        "short_rows": F.sum(F.when(short, F.col("rows")).otherwise(0)),
        "long_rows": F.sum(F.when(short, 0).otherwise(F.col("rows"))),
        "all_rows": F.sum("rows"),
        "short_exams": count_rows_where(short),
        "long_exams": count_rows_where(F.col("long")),
        "all_exams": F.count(F.lit(1)),
    }
    sums = (
        _exam_totals(events, settings, *_first_row(mode), *more)
        .groupBy(*UNIT)
        .agg(*_machine_sums(settings, mode), *(share.alias(f"count_{name}") for name, share in shares.items()))
    )
    # A system counts with the first of its revisions and configurations.
    units = Window.partitionBy("system_id").orderBy("sw_rev", "config")
    first = F.when(F.row_number().over(units) == 1, 1).otherwise(0)
    rated = _rated(_totals(sums, mode).withColumn("count_num_systems", first))
    return rated.select(*_report_columns(), *(f"count_{name}" for name in RUN_COUNTS))


def report_of_counted(machines: DataFrame) -> DataFrame:
    """The report from ``counted_machines``: those with a long exam."""
    return machines.filter("count_long_exams > 0").select(*MACHINE_REPORT.names)


def _rows_with_sums(events: DataFrame, settings: Settings, mode: str) -> DataFrame:
    """Rows of long exams with all sums of the steps, for machines of any size.

    The rows are summed once per exam and the exams once per machine, and both are joined
    back; the rows are checkpointed once, because they are used twice.
    """
    flagged = checkpointed(incidents.incident_flags(metrics.add_day(events), settings))
    shutdown = F.col("actual_num_shutdowns")
    exam_sums = flagged.groupBy(*EXAM).agg(
        F.max("tick").alias("exam_dur_max"),
        F.min("tick").alias("exam_dur_min"),
        F.sum("ip_st").alias("sum_ipst"),
        F.max(shutdown).alias("_shut"),
        F.sum(shutdown).alias("_shut_rows"),
        F.count(F.lit(1)).alias("_rows"),
        F.max("mebef_wt").alias("_weight"),
        count_rows_where(F.col("code") == settings.exam_code).alias("_coded"),
        count_rows_where(F.col("code") == settings.reset_code).alias("_resets"),
    )
    duration = F.col("exam_dur_max") - F.col("exam_dur_min")
    exam_sums = metrics.exams_long(exam_sums.withColumn("exam_dur_sec", duration), settings)
    per_exam = {
        "intended": F.col("sum_ipst") - F.col("_shut"),
        "literal": F.col("_rows") * F.col("sum_ipst") - F.col("_shut_rows"),
    }
    num_exams = {"code": F.sum("_coded"), "segment": F.count(F.lit(1))}[settings.num_exams_by]
    machine_sums = exam_sums.groupBy(*UNIT).agg(
        F.sum(per_exam[mode]).alias("num_shutdowns"),
        F.sum("_weight").alias("sum_max_wt_all_exams"),
        F.sum("_resets").alias("num_tps_resets"),
        F.min("exam_dur_min").alias("time_seq_min"),
        F.max("exam_dur_max").alias("time_seq_max"),
        num_exams.alias("num_exams"),
    )
    shown = ("exam_dur_max", "exam_dur_min", "exam_dur_sec", "sum_ipst")
    rows = join_groups(flagged, exam_sums.select(*EXAM, *shown), EXAM)
    return join_groups(rows.filter("exam_dur_sec IS NOT NULL"), machine_sums, UNIT)


def _large_stepwise(events: DataFrame, settings: Settings, mode: str) -> DataFrame:
    rows = metrics.first_rows(_rows_with_sums(events, settings, mode))
    if mode == "literal":
        counts = ("num_exams", "num_tps_resets", "time_seq_min", "time_seq_max")
        rows = rows.withColumns({name: F.lit(1) for name in counts})
        rows = rows.withColumn("sum_max_wt_all_exams", F.col("mebef_wt"))
    rates = {"ipte_severity": "num_shutdowns", "ipte_weighted": "sum_max_wt_all_exams"}
    return rows.withColumns(
        {name: ipte_rate(F.col(of), F.col("num_exams")) for name, of in rates.items()}
    )


def stepwise_report(
    events: DataFrame,
    settings: Settings = DEFAULTS,
    mode: str = "intended",
    bounded: Bounded = None,
) -> DataFrame:
    """The same report from ``final_events``, through the row-level operators.

    Beyond the bound of a task the steps' sums are taken together; see ``_rows_with_sums``.
    """
    check_mode(mode)
    if bounded is None:
        bounded = group_sizes(events, UNIT, settings.max_group_rows)
    if not bounded:
        rows = _large_stepwise(events, settings, mode)
        return rows.select(*(F.col(f.name).cast(f.dataType) for f in MACHINE_REPORT.fields))
    rows = metrics.exam_duration(metrics.add_day(events), bounded)
    rows = metrics.exams_long(rows, settings)
    rows = rows.withColumns({"mebef_wt_new": F.col("mebef_wt"), "code_new": F.col("code")})
    rows = incidents.exam_incidents(incidents.incident_flags(rows, settings), bounded)
    rows = incidents.total_shutdowns(incidents.subtraction_rule(rows), mode, bounded)
    if mode == "literal":
        rows = metrics.ipte(rows, settings, mode)
        rows = metrics.ipte_weighted(rows, settings, mode)
        rows = metrics.additional_stats(rows, settings, mode, bounded=True)
    else:
        # The totals of a machine come before its first row is taken.
        rows = metrics.additional_stats(rows, settings, mode, bounded)
        rows = metrics.ipte_and_weighted(rows, settings, bounded)
    top = metrics.top_row_per_machine(rows)
    return top.select(*(F.col(f.name).cast(f.dataType) for f in MACHINE_REPORT.fields))


def report_stage_counts(
    log: DataFrame, events: DataFrame, settings: Settings = DEFAULTS
) -> DataFrame:
    """Rows after each stage, each group of stages counted in one aggregation.

    ``log`` is the log as read, ``events`` are exam records before their dedup.
    """
    complete = F.lit(True)
    for name in cleaning.NEEDED:
        complete = complete & F.col(name).isNotNull()
    digest = cleaning.row_digest(log.columns).alias("_digest")
    copies = log.select(*cleaning.NEEDED, digest).groupBy("_digest", *cleaning.NEEDED)
    copies = copies.agg(F.count(F.lit(1)).alias("_n"))
    of_log = copies.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("read"),
        F.count(F.lit(1)).alias("deduplicated"),
        count_rows_where(complete).alias("complete"),
    )
    # One row per event, as ``dedup_events`` leaves it, with the number of its copies.
    survivor = F.struct("exam_start", *ORDER, "exam_id", "config")
    unique = events.groupBy("system_id", "sw_rev", "code", "time_seq").agg(
        F.count(F.lit(1)).alias("_n"), F.min(survivor).alias("_row")
    )
    of_exams = unique.groupBy("system_id", "sw_rev", "_row.config", "_row.exam_id").agg(
        F.sum("_n").alias("_n"),
        F.count(F.lit(1)).alias("_unique"),
        (F.max("_row.tick") - F.min("_row.tick")).alias("_seconds"),
    )
    long = F.when(F.col("_seconds") >= settings.min_exam_s, F.col("_unique"))
    of_events = of_exams.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("in_exams"),
        F.coalesce(F.sum("_unique"), F.lit(0)).alias("events_deduplicated"),
        F.coalesce(F.sum(long), F.lit(0)).alias("in_long_exams"),
    )
    return metrics.stage_counts(of_log, of_events)
