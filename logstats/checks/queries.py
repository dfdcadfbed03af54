"""One query per operator over the sample tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logstats import schemas, sources
from logstats.checks import views
from logstats.checks.views import SETTINGS
from logstats.functions import event_day, ipte_rate, parse_tick, sevone
from logstats.operators import arrivals, catalog, cleaning, exams, incidents, metrics, resume
from logstats.operators.groups import Bounded, running_total
from logstats.plans import (
    final_events,
    machine_report,
    report_stage_counts,
    run_report,
    stepwise_report,
)
from logstats.plans import staging
from logstats.scratch import checkpointed, remove_path, scratch_folder, scratch_path
from logstats.settings import EXAM, UNIT, Settings

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# The same rules with groups of a few rows, so that machines are cut into chunks.
CHUNKED = replace(SETTINGS, max_group_rows=20)

FIRST_DAY, LAST_DAY = "2024-01-05", "2024-01-20"
PLACE = ("system_id", "exam_id", "event_key")


def query(name: str) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[name] = function
        return function

    return register


def rounded(name: str) -> Column:
    return F.round(name, 6).alias(name)


# Frames the queries start from. Each checks the size of its groups once, on the log.


def _inputs(
    spark: SparkSession, sf_dir: str, settings: Settings = SETTINGS
) -> tuple[DataFrame, DataFrame, Settings, Bounded]:
    log, codes = views.event_log(spark, sf_dir), views.code_actions(spark)
    return log, codes, settings, exams.log_bounded(log, codes, settings)


@dataclass(frozen=True)
class Sized:
    """Rows and whether their groups are bounded."""

    rows: DataFrame
    bounded: Bounded

    def then(self, step: Callable[..., DataFrame], *args: object) -> Sized:
        return Sized(step(self.rows, *args), self.bounded)

    def then_grouped(self, step: Callable[..., DataFrame], *args: object) -> Sized:
        return Sized(step(self.rows, *args, bounded=self.bounded), self.bounded)


def _cut(spark: SparkSession, sf_dir: str, settings: Settings = SETTINGS) -> Sized:
    log, codes, settings, bounded = _inputs(spark, sf_dir, settings)
    return Sized(exams.exam_events(log, codes, settings, bounded), bounded)


def _final(spark: SparkSession, sf_dir: str, settings: Settings = SETTINGS) -> Sized:
    log, codes, settings, bounded = _inputs(spark, sf_dir, settings)
    weights = views.level_weights(spark)
    return Sized(final_events(log, codes, weights, settings, bounded), bounded)


def _timed(spark: SparkSession, sf_dir: str) -> Sized:
    return _final(spark, sf_dir).then(metrics.add_day).then_grouped(metrics.exam_duration)


def _long(spark: SparkSession, sf_dir: str) -> Sized:
    return _timed(spark, sf_dir).then(metrics.exams_long, SETTINGS)


def _flagged(spark: SparkSession, sf_dir: str) -> Sized:
    return _long(spark, sf_dir).then(incidents.incident_flags, SETTINGS)


def _ruled(spark: SparkSession, sf_dir: str) -> Sized:
    summed = _flagged(spark, sf_dir).then_grouped(incidents.exam_incidents)
    return summed.then(incidents.subtraction_rule)


def _totalled(spark: SparkSession, sf_dir: str, mode: str = "intended") -> Sized:
    return _ruled(spark, sf_dir).then_grouped(incidents.total_shutdowns, mode)


def _report(spark: SparkSession, sf_dir: str, mode: str = "intended") -> DataFrame:
    codes, weights = views.code_actions(spark), views.level_weights(spark)
    return machine_report(views.event_log(spark, sf_dir), codes, weights, SETTINGS, mode)


def _rounded_report(report: DataFrame) -> DataFrame:
    return report.withColumns(
        {name: F.round(name, 6) for name in ("ipte_weighted", "ipte_severity")}
    )


def _written(frame: DataFrame, folder: str, name: str, **options: object) -> str:
    """The frame as CSV in a folder, blanks kept."""
    path = f"{folder}/{name}"
    blanks = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    frame.write.options(**blanks, **options).csv(path)
    return path


# Sources and sinks: files are written, read back, and removed.


@query("scan_machine_log")
def scan_machine_log(spark, sf_dir):
    with scratch_folder(spark, "files") as folder:
        path = _written(views.raw_log(spark, sf_dir), folder, "machine_log", quote="~")
        return checkpointed(sources.read_machine_log(spark, path))


@query("scan_system_list")
def scan_system_list(spark, sf_dir):
    with scratch_folder(spark, "files") as folder:
        path = _written(views.all_systems(spark, sf_dir), folder, "system_list")
        return checkpointed(sources.read_system_list(spark, path))


@query("scan_level_weights")
def scan_level_weights(spark, sf_dir):
    with scratch_folder(spark, "files") as folder:
        weights = views.part_level_weights(spark, sf_dir)
        path = _written(weights, folder, "level_weights", header=True)
        return checkpointed(sources.read_level_weights(spark, path))


@query("scan_code_actions")
def scan_code_actions(spark, sf_dir):
    with scratch_folder(spark, "files") as folder:
        codes = views.part_code_actions(spark, sf_dir)
        path = _written(codes, folder, "code_actions", header=True)
        return checkpointed(sources.read_code_actions(spark, path))


@query("report_roundtrip")
def report_roundtrip(spark, sf_dir):
    with scratch_folder(spark, "files") as folder:
        written = sources.write_report(_report(spark, sf_dir), f"{folder}/report", "_2024-01-31")
        return checkpointed(_rounded_report(sources.read_report(spark, written)))


def _job(
    spark: SparkSession, sf_dir: str, folder: str, log: DataFrame | None = None, **options: object
) -> DataFrame:
    log = views.raw_log(spark, sf_dir) if log is None else log
    return run_report(
        spark,
        log_path=_written(log, folder, "machine_log", quote="~"),
        level_weights_path=_written(views.level_weights(spark), folder, "weights", header=True),
        code_actions_path=_written(views.code_actions(spark), folder, "codes", header=True),
        report_path=f"{folder}/report",
        system_list_path=_written(views.customer_systems(spark, sf_dir), folder, "systems"),
        start_date=FIRST_DAY,
        end_date=LAST_DAY,
        **options,
    )


@query("run_report")
def run_report_from_files(spark, sf_dir):
    with scratch_folder(spark, "files") as folder:
        totals = _job(spark, sf_dir, folder, settings=SETTINGS)
        return checkpointed(totals.withColumn("cum_ipte", F.round("cum_ipte", 6)))


@query("run_report_chunked")
def run_report_chunked(spark, sf_dir):
    with scratch_folder(spark, "files") as folder:
        totals = _job(spark, sf_dir, folder, settings=CHUNKED)
        return checkpointed(totals.withColumn("cum_ipte", F.round("cum_ipte", 6)))


@query("run_diagnostics")
def run_diagnostics(spark, sf_dir):
    with scratch_folder(spark, "files") as folder:
        _job(spark, sf_dir, folder, settings=SETTINGS, metrics_path=f"{folder}/metrics")
        written = spark.read.schema("stage string, n bigint").csv(f"{folder}/metrics.csv", header=True)
        return checkpointed(written)


@query("run_diagnostics_chunked")
def run_diagnostics_chunked(spark, sf_dir):
    with scratch_folder(spark, "files") as folder:
        _job(spark, sf_dir, folder, settings=CHUNKED, metrics_path=f"{folder}/metrics")
        written = spark.read.schema("stage string, n bigint").csv(f"{folder}/metrics.csv", header=True)
        return checkpointed(written)


@query("run_report_literal")
def run_report_literal(spark, sf_dir):
    """Some rows have nothing in ``dummy``, which the literal job drops them for."""
    dummy = F.when(F.col("seq_num").cast("bigint") % 13 != 0, F.col("dummy"))
    log = views.raw_log(spark, sf_dir).withColumn("dummy", dummy)
    with scratch_folder(spark, "files") as folder:
        totals = _job(spark, sf_dir, folder, log, settings=SETTINGS, mode="literal")
        return checkpointed(totals.withColumn("cum_ipte", F.round("cum_ipte", 6)))


# Cleaning.


@query("quarantine_counts")
def quarantine_counts(spark, sf_dir):
    """Lines of a log of which some lack fields, have one more, or a quote that is not closed."""
    names, key = schemas.MACHINE_LOG.names, F.col("seq_num").cast("bigint")
    whole, cut = (F.to_csv(F.struct(*some), {"quote": "~"}) for some in (names, names[:-2]))
    line = (
        F.when(key % 23 == 0, F.concat(F.lit("~"), whole))
        .when(key % 13 == 0, cut)
        .when(key % 19 == 0, F.concat(whole, F.lit(",more")))
        .otherwise(whole)
    )
    with scratch_folder(spark, "files") as folder:
        views.raw_log(spark, sf_dir).select(line).write.text(f"{folder}/log")
        lines = checkpointed(sources.read_machine_log_lines(spark, f"{folder}/log"))
    good = sources.good_rows(lines).select(F.lit("good").alias("fault"))
    faults = good.unionByName(sources.quarantined(lines).select("fault"))
    return faults.groupBy("fault").agg(F.count(F.lit(1)).alias("n"))


@query("report_published")
def report_published(spark, sf_dir):
    """The report of a stamp, published twice."""
    with scratch_folder(spark, "files") as folder:
        report = checkpointed(_report(spark, sf_dir))
        for rows in (report.limit(1), report):
            written = sources.publish_report(rows, f"{folder}/report", "_2024-01-31")
        return checkpointed(_rounded_report(sources.read_report(spark, written)))


@query("dedup_rows_by_load")
def dedup_rows_by_load(spark, sf_dir):
    """Three loads, of which the second and third bring rows again; what each adds."""
    key, log = F.col("seq_num").cast("bigint"), views.raw_log(spark, sf_dir)
    path, buckets = scratch_path(spark, "digests"), 8
    table = f"digests_{path.rpartition('-')[2]}"
    loads = (log.filter(key % 3 == 0), log.filter(key % 3 < 2), log)
    with scratch_folder(spark, "loads") as folder:
        arrivals.open_digests(spark, table, path, buckets)
        for n, load in enumerate(loads):
            arrivals.new_rows(load, table).write.parquet(f"{folder}/{n}")
            arrivals.add_digests(spark.read.parquet(f"{folder}/{n}"), table, buckets)
        loaded = spark.read.parquet(*(f"{folder}/{n}" for n in range(len(loads))))
        result = checkpointed(loaded.drop(arrivals.DIGEST))
    spark.sql(f"DROP TABLE {table}")
    remove_path(spark, path)
    return result


@query("drop_columns")
def drop_columns(spark, sf_dir):
    return cleaning.drop_columns(views.raw_log(spark, sf_dir), "dummy", "tarfilename")


@query("filter_dates")
def filter_dates(spark, sf_dir):
    log = cleaning.filter_dates(views.event_log(spark, sf_dir), FIRST_DAY, LAST_DAY)
    return log.select("system_id", "event_key", "msg_date")


@query("filter_dates_open")
def filter_dates_open(spark, sf_dir):
    log = views.event_log(spark, sf_dir)
    early = cleaning.filter_dates(log, None, FIRST_DAY).withColumn("part", F.lit("early"))
    late = cleaning.filter_dates(log, LAST_DAY, None).withColumn("part", F.lit("late"))
    return early.unionByName(late).select("part", "system_id", "event_key", "msg_date")


@query("filter_dates_literal")
def filter_dates_literal(spark, sf_dir):
    log = views.event_log(spark, sf_dir)
    kept = cleaning.filter_dates(log, FIRST_DAY, LAST_DAY, "literal")
    return kept.select("system_id", "event_key", "msg_date")


@query("filter_systems")
def filter_systems(spark, sf_dir):
    listed = views.customer_systems(spark, sf_dir)
    log = cleaning.filter_systems(views.raw_log(spark, sf_dir), listed)
    return log.select("tar_systemid", "seq_num", "msg_code")


@query("filter_systems_literal")
def filter_systems_literal(spark, sf_dir):
    listed = views.customer_systems(spark, sf_dir)
    log = cleaning.filter_systems(views.raw_log(spark, sf_dir), listed, "literal")
    return log.select("tar_systemid", "seq_num", "msg_code")


@query("dedup_rows")
def dedup_rows(spark, sf_dir):
    return cleaning.dedup_rows(views.raw_log(spark, sf_dir))


@query("drop_incomplete")
def drop_incomplete(spark, sf_dir):
    log = cleaning.drop_incomplete(views.raw_log(spark, sf_dir))
    return log.select("tar_systemid", "seq_num", "msg_code", "tag")


@query("drop_incomplete_literal")
def drop_incomplete_literal(spark, sf_dir):
    log = cleaning.drop_incomplete(views.raw_log(spark, sf_dir), all_columns=True)
    return log.select("tar_systemid", "seq_num", "msg_code", "tag")


@query("clean_log")
def clean_log(spark, sf_dir):
    return cleaning.clean_log(views.raw_log(spark, sf_dir))


@query("add_constants")
def add_constants(spark, sf_dir):
    log = cleaning.add_constants(views.raw_log(spark, sf_dir))
    return log.select("tar_systemid", "seq_num", "config", "software_rev")


@query("distinct_units")
def distinct_units(spark, sf_dir):
    return cleaning.distinct_units(cleaning.add_constants(views.raw_log(spark, sf_dir)))


@query("prepare_log")
def prepare_log(spark, sf_dir):
    log = cleaning.add_constants(cleaning.clean_log(views.raw_log(spark, sf_dir)))
    return cleaning.prepare_log(log).drop("event_key")


@query("dedup_events")
def dedup_events(spark, sf_dir):
    cut = _cut(spark, sf_dir).rows
    later = {"exam_start": F.col("exam_start") + 1, "exam_id": F.lit("copy")}
    copies = cut.filter(F.col("event_key") % 10 == 0).withColumns(later)
    return cleaning.dedup_events(cut.unionByName(copies)).select(*PLACE, "code", "time_seq")


@query("drop_blank_exam")
def drop_blank_exam(spark, sf_dir):
    blank = F.when(F.col("event_key") % 10 == 0, "").otherwise(F.col("exam_id"))
    cut = _cut(spark, sf_dir).rows.withColumn("exam_id", blank)
    return cleaning.drop_blank_exam(cut).select(*PLACE)


# Code tables.


@query("code_categories")
def code_categories(spark, sf_dir):
    return catalog.code_categories(views.part_code_actions(spark, sf_dir))


@query("code_catalog")
def code_catalog(spark, sf_dir):
    packed = catalog.code_catalog(views.part_code_actions(spark, sf_dir))
    return packed.select("category", F.array_join("error_codes", ",").alias("error_codes"))


@query("code_catalog_blocks")
def code_catalog_blocks(spark, sf_dir):
    packed = catalog.code_catalog_blocks(views.part_code_actions(spark, sf_dir), 50)
    codes = F.array_join("error_codes", ",").alias("error_codes")
    return packed.select("category", "block", codes)


@query("code_roles")
def code_roles(spark, sf_dir):
    return catalog.code_roles(views.part_code_actions(spark, sf_dir))


@query("attach_level")
def attach_level(spark, sf_dir):
    known = views.code_actions(spark).filter("error_code <> 'MON'")
    return catalog.attach_level(_cut(spark, sf_dir).rows, known).select(*PLACE, "code", "mebef_level")


@query("attach_weight")
def attach_weight(spark, sf_dir):
    known = views.level_weights(spark).filter("level <> 'L2'")
    events = catalog.attach_level(_cut(spark, sf_dir).rows, views.code_actions(spark))
    return catalog.attach_weight(events, known).select(*PLACE, "mebef_level", "mebef_wt")


# Exam cutting.


@query("parse_ticks")
def parse_ticks(spark, sf_dir):
    log = views.tick_texts(spark, sf_dir)
    ticks = log.select("seq_num", "time_seq", parse_tick(F.col("time_seq")).alias("tick"))
    return ticks.filter("tick is not null")


@query("service_starts")
def service_starts(spark, sf_dir):
    log, codes = views.event_log(spark, sf_dir), views.code_actions(spark)
    return exams.service_starts(log, codes, SETTINGS)


@query("exam_segments")
def exam_segments(spark, sf_dir):
    log, codes = views.event_log(spark, sf_dir), views.code_actions(spark)
    return exams.exam_segments(log, codes, SETTINGS)


@query("exam_events")
def exam_events(spark, sf_dir):
    return _cut(spark, sf_dir).rows.drop("tick", "seq")


@query("exam_records")
def exam_records(spark, sf_dir):
    return _final(spark, sf_dir).rows.drop("tick", "seq", "exam_start")


@query("exam_summary")
def exam_summary(spark, sf_dir):
    return exams.exam_summary(_cut(spark, sf_dir).rows)


# Scalars.


@query("event_day")
def day_of_event(spark, sf_dir):
    log = views.event_log(spark, sf_dir)
    return log.select("event_key", event_day(F.col("tick")).alias("day"))


@query("incident_flags")
def incident_flags(spark, sf_dir):
    flags = ("actual_num_shutdowns", "actual_num_crashes", "sum_shutdown_crashes", "ip_st")
    return _flagged(spark, sf_dir).rows.select(*PLACE, "code", *flags)


@query("subtraction_rule")
def subtraction_rule(spark, sf_dir):
    return _ruled(spark, sf_dir).rows.select(*PLACE, "sum_ipst", "num_shutdowns_day")


def _sevone(spark: SparkSession, sf_dir: str, mode: str) -> DataFrame:
    exam_sums = _flagged(spark, sf_dir).rows.groupBy(*EXAM).agg(
        F.sum("ip_st").alias("sum_ipst"), F.sum("actual_num_shutdowns").alias("shutdowns")
    )
    value = sevone(F.col("sum_ipst"), F.col("shutdowns"), mode)
    return exam_sums.withColumn("sevone", value)


@query("sevone")
def sevone_intended(spark, sf_dir):
    return _sevone(spark, sf_dir, "intended")


@query("sevone_literal")
def sevone_literal(spark, sf_dir):
    return _sevone(spark, sf_dir, "literal")


@query("ipte_rate")
def rate_per_system(spark, sf_dir):
    counts = views.event_log(spark, sf_dir).groupBy("system_id").agg(
        F.count_if(F.col("code") == "CRASH").alias("crashes"),
        F.count_if(F.col("code") == "START").alias("starts"),
    )
    return counts.withColumn("rate", F.round(ipte_rate(F.col("crashes"), F.col("starts")), 6))


# Windows.


@query("exam_duration")
def exam_duration(spark, sf_dir):
    timed = _timed(spark, sf_dir).rows
    return timed.select(*PLACE, "day", "exam_dur_max", "exam_dur_min", "exam_dur_sec")


@query("exams_long")
def exams_long(spark, sf_dir):
    return _long(spark, sf_dir).rows.select(*PLACE, "exam_dur_sec")


@query("exams_short")
def exams_short(spark, sf_dir):
    return metrics.exams_short(_timed(spark, sf_dir).rows, SETTINGS).select(*PLACE, "exam_dur_sec")


@query("rank_duration")
def rank_duration(spark, sf_dir):
    # Duration up to the row's own tick, so that not all rows of an exam tie.
    so_far = F.floor((F.col("tick") - F.col("exam_dur_min")) / 3600).cast("double")
    timed = _timed(spark, sf_dir).then(DataFrame.withColumn, "exam_dur_sec", so_far)
    ranked = timed.then_grouped(metrics.rank_duration)
    return ranked.rows.select(*PLACE, "exam_dur_sec", "rank_val")


@query("time_lag")
def time_lag(spark, sf_dir):
    lagged = _cut(spark, sf_dir).then_grouped(metrics.time_lag, SETTINGS)
    return lagged.rows.select(*PLACE, "tick", "time_seq_lag")


@query("exam_incidents")
def exam_incidents(spark, sf_dir):
    summed = _flagged(spark, sf_dir).then_grouped(incidents.exam_incidents)
    return summed.rows.select(*PLACE, "ip_st", "sum_ipst")


@query("total_shutdowns")
def total_shutdowns(spark, sf_dir):
    return _totalled(spark, sf_dir).rows.select(*PLACE, "num_shutdowns_day", "num_shutdowns")


@query("total_shutdowns_literal")
def total_shutdowns_literal(spark, sf_dir):
    rows = _totalled(spark, sf_dir, "literal").rows
    return rows.select(*PLACE, "num_shutdowns_day", "num_shutdowns")


@query("shutdown_crash_counts")
def shutdown_crash_counts(spark, sf_dir):
    rows = incidents.shutdown_crash_counts(_long(spark, sf_dir).rows, SETTINGS)
    return rows.select(*PLACE, "day", "actual_num_shutdowns", "actual_num_crashes")


@query("shutdown_crash_counts_exam_day")
def shutdown_crash_counts_exam_day(spark, sf_dir):
    counts = incidents.shutdown_crash_counts
    rows = _long(spark, sf_dir).then_grouped(counts, SETTINGS, "exam_day").rows
    return rows.select(*PLACE, "day", "actual_num_shutdowns", "actual_num_crashes")


@query("shutdown_crash_counts_literal")
def shutdown_crash_counts_literal(spark, sf_dir):
    rows = incidents.shutdown_crash_counts(_long(spark, sf_dir).rows, SETTINGS, mode="literal")
    return rows.select(*PLACE, "day", "actual_num_shutdowns", "actual_num_crashes")


def _ipte(spark: SparkSession, sf_dir: str, mode: str) -> DataFrame:
    rows = _totalled(spark, sf_dir, mode).then_grouped(metrics.ipte, SETTINGS, mode).rows
    names = ("event_key", "num_exams", "num_sev1")
    return rows.select(*UNIT, *names, rounded("ipte_severity"))


@query("ipte")
def ipte(spark, sf_dir):
    return _ipte(spark, sf_dir, "intended")


@query("ipte_literal")
def ipte_literal(spark, sf_dir):
    return _ipte(spark, sf_dir, "literal")


def _ipte_weighted(spark: SparkSession, sf_dir: str, mode: str) -> DataFrame:
    rows = _long(spark, sf_dir).then_grouped(metrics.ipte_weighted, SETTINGS, mode).rows
    names = (rounded("sum_max_wt_all_exams"), rounded("ipte_weighted"))
    return rows.select(*UNIT, "event_key", *names)


@query("ipte_weighted")
def ipte_weighted(spark, sf_dir):
    return _ipte_weighted(spark, sf_dir, "intended")


@query("ipte_weighted_literal")
def ipte_weighted_literal(spark, sf_dir):
    return _ipte_weighted(spark, sf_dir, "literal")


@query("additional_stats")
def additional_stats(spark, sf_dir):
    rows = _long(spark, sf_dir).then_grouped(metrics.additional_stats, SETTINGS).rows
    return rows.select(*PLACE, "num_tps_resets", "time_seq_min", "time_seq_max")


@query("additional_stats_literal")
def additional_stats_literal(spark, sf_dir):
    stats = metrics.additional_stats
    rows = _long(spark, sf_dir).then_grouped(stats, SETTINGS, "literal").rows
    return rows.select(*PLACE, "num_tps_resets", "time_seq_min", "time_seq_max")


@query("top_row_per_machine")
def top_row_per_machine(spark, sf_dir):
    # A rate that differs from row to row, so that there is something to choose.
    timed = _timed(spark, sf_dir).rows
    rated = timed.withColumn("ipte_severity", F.floor(F.col("exam_dur_sec") / 3600))
    top = metrics.top_row_per_machine(rated)
    return top.select(*UNIT, "event_key", "ipte_severity", "row_num")


# Machines cut into chunks: the same rows as without.


@query("exam_segments_chunked")
def exam_segments_chunked(spark, sf_dir):
    log, codes = views.event_log(spark, sf_dir), views.code_actions(spark)
    return exams.exam_segments(log, codes, CHUNKED)


@query("exam_events_chunked")
def exam_events_chunked(spark, sf_dir):
    return _cut(spark, sf_dir, CHUNKED).rows.drop("tick", "seq")


@query("machine_report_chunked")
def machine_report_chunked(spark, sf_dir):
    log, codes = views.event_log(spark, sf_dir), views.code_actions(spark)
    return _rounded_report(machine_report(log, codes, views.level_weights(spark), CHUNKED))


@query("time_lag_chunked")
def time_lag_chunked(spark, sf_dir):
    cut = _cut(spark, sf_dir, CHUNKED)
    lagged = Sized(checkpointed(cut.rows), cut.bounded).then_grouped(metrics.time_lag, CHUNKED)
    return lagged.rows.select(*PLACE, "tick", "time_seq_lag")


@query("additional_stats_literal_chunked")
def additional_stats_literal_chunked(spark, sf_dir):
    long = _long(spark, sf_dir).rows
    rows = metrics.additional_stats(checkpointed(long), CHUNKED, "literal")
    return rows.select(*PLACE, "num_tps_resets", "time_seq_min", "time_seq_max")


@query("stepwise_report_chunked")
def report_by_steps_chunked(spark, sf_dir):
    return _rounded_report(_final(spark, sf_dir, CHUNKED).then_grouped(stepwise_report, CHUNKED).rows)


# Days in parts that follow one another, each cut with the state that the one before left.
PERIODS = ("2024-01-08", "2024-01-20", "2024-02-01")


def _period_rows(spark: SparkSession, sf_dir: str, settings: Settings, folder: str) -> DataFrame:
    """Decided rows of all periods, and after the last one those still open."""
    log, codes = views.event_log(spark, sf_dir), views.code_actions(spark)
    state, first = None, ""
    for end in PERIODS:
        part = log.filter((F.col("msg_date") >= first) & (F.col("msg_date") < end))
        period = resume.cut_next(part, codes, state, settings)
        period.rows.write.mode("append").parquet(f"{folder}/rows")
        resume.write_state(period.state, f"{folder}/{end}")
        state, first = resume.read_state(spark, f"{folder}/{end}"), end
    open_at_end = state.pending.drop("in_limit")
    return spark.read.parquet(f"{folder}/rows").unionByName(open_at_end)


def _segments_by_period(spark: SparkSession, sf_dir: str, settings: Settings) -> DataFrame:
    with scratch_folder(spark, "periods") as folder:
        return checkpointed(resume.segments_of(_period_rows(spark, sf_dir, settings, folder)))


@query("exam_segments_by_period")
def exam_segments_by_period(spark, sf_dir):
    return _segments_by_period(spark, sf_dir, SETTINGS)


@query("exam_segments_by_period_chunked")
def exam_segments_by_period_chunked(spark, sf_dir):
    return _segments_by_period(spark, sf_dir, replace(SETTINGS, max_group_rows=7))


@query("exam_events_by_period")
def exam_events_by_period(spark, sf_dir):
    with scratch_folder(spark, "periods") as folder:
        records = exams.kept_records(_period_rows(spark, sf_dir, SETTINGS, folder))
        return checkpointed(records.drop("tick", "seq"))


@query("late_rows")
def late_rows(spark, sf_dir):
    """Rows of a first period that come again with the second one."""
    log, codes = views.event_log(spark, sf_dir), views.code_actions(spark)
    first = log.filter(F.col("msg_date") < LAST_DAY)
    again = log.filter((F.col("msg_date") >= LAST_DAY) | (F.col("event_key") % 7 == 0))
    state = resume.cut_next(first, codes, None, SETTINGS).state
    return resume.late_rows(again, codes, state).select("system_id", "event_key")


def _staged_events(spark: SparkSession, sf_dir: str, settings: Settings) -> DataFrame:
    log, codes = views.event_log(spark, sf_dir), views.code_actions(spark)
    path = scratch_path(spark, "by-machine")
    name = f"staged_{path.rpartition('-')[2]}"
    tables = staging.stage_by_machine(log, codes, name, path, None, settings)
    try:
        with staging.sorted_buckets(spark):
            cut = staging.staged_cut(spark, tables, codes, settings)
            return checkpointed(exams.kept_records(cut).drop("tick", "seq"))
    finally:
        staging.drop_tables(spark, tables)


@query("exam_events_staged")
def exam_events_staged(spark, sf_dir):
    return _staged_events(spark, sf_dir, SETTINGS)


@query("exam_events_staged_chunked")
def exam_events_staged_chunked(spark, sf_dir):
    return _staged_events(spark, sf_dir, CHUNKED)


@query("report_of_staged_days")
def report_of_staged_days(spark, sf_dir):
    """The report of some days of a log that is staged by day."""
    codes, weights = views.code_actions(spark), views.level_weights(spark)
    log = views.event_log(spark, sf_dir)
    with scratch_folder(spark, "by-day") as folder:
        staging.stage_by_day(log, f"{folder}/log")
        days = staging.read_days(log, f"{folder}/log", FIRST_DAY, LAST_DAY)
        return checkpointed(_rounded_report(machine_report(days, codes, weights, SETTINGS)))


@query("running_total_nulls")
def running_total_nulls(spark, sf_dir):
    """Values of some rows and keys of some machines are null."""
    value = F.when(F.col("event_key") % 3 != 0, F.col("event_key") % 7)
    machine = F.when(F.col("event_key") % 5 != 0, F.col("system_id"))
    log = views.event_log(spark, sf_dir).select(
        machine.alias("machine"), "tick", "event_key", value.alias("value")
    )
    return running_total(log, ["machine"], ["tick", "event_key"], "value", "total", 7)


# Aggregations.


@query("stage_counts")
def stage_counts(spark, sf_dir):
    return report_stage_counts(
        views.raw_log(spark, sf_dir), _cut(spark, sf_dir).rows, SETTINGS
    )


@query("run_metrics")
def run_metrics(spark, sf_dir):
    return metrics.run_metrics(_final(spark, sf_dir).rows, SETTINGS)


@query("distinct_counts")
def distinct_counts(spark, sf_dir):
    return metrics.distinct_counts(_final(spark, sf_dir).rows)


@query("distinct_counts_by_sketch")
def distinct_counts_by_sketch(spark, sf_dir):
    """Exact counts of some days, and whether those from the days' sketches are near."""
    days = F.col("day").between(FIRST_DAY.replace("-", ""), LAST_DAY.replace("-", ""))
    events = checkpointed(_final(spark, sf_dir).rows)
    exact = metrics.distinct_counts(metrics.add_day(events).filter(days))
    about = metrics.period_distinct_counts(metrics.daily_sketches(events).filter(days))
    names = ("num_exams", "num_systems")
    about = about.select(*(F.col(name).alias(f"about_{name}") for name in names))
    error = metrics.sketch_error()
    near = {f"near_{n}": F.abs(F.col(f"about_{n}") - F.col(n)) <= error * F.col(n) for n in names}
    # One row each, put together.
    both = exact.unionByName(about, allowMissingColumns=True)
    both = both.agg(*(F.max(name).alias(name) for name in both.columns))
    return both.select(*names, *(value.alias(name) for name, value in near.items()))


@query("duration_stats")
def duration_stats(spark, sf_dir):
    return metrics.duration_stats(_final(spark, sf_dir).rows, SETTINGS)


@query("fleet_shutdowns")
def fleet_shutdowns(spark, sf_dir):
    return metrics.fleet_shutdowns(_totalled(spark, sf_dir).rows)


@query("fleet_shutdowns_literal")
def fleet_shutdowns_literal(spark, sf_dir):
    return metrics.fleet_shutdowns(_totalled(spark, sf_dir, "literal").rows)


@query("sum_by_key")
def sum_by_key(spark, sf_dir):
    names = ("num_exams", "num_shutdowns", "num_tps_resets")
    sums = metrics.sum_by_key(_report(spark, sf_dir).select(*names), "num_exams")
    return sums.select("num_exams", *(f"sum_{name}" for name in names))


# Whole analyses.


@query("machine_report")
def report(spark, sf_dir):
    return _rounded_report(_report(spark, sf_dir))


@query("machine_report_literal")
def report_literal(spark, sf_dir):
    return _rounded_report(_report(spark, sf_dir, "literal"))


@query("stepwise_report")
def report_by_steps(spark, sf_dir):
    return _rounded_report(_final(spark, sf_dir).then_grouped(stepwise_report, SETTINGS).rows)


@query("stepwise_report_literal")
def report_by_steps_literal(spark, sf_dir):
    steps = _final(spark, sf_dir).then_grouped(stepwise_report, SETTINGS, "literal")
    return _rounded_report(steps.rows)


@query("cumulative_ipte")
def cumulative_ipte(spark, sf_dir):
    totals = metrics.cumulative_ipte(_report(spark, sf_dir))
    return totals.withColumn("cum_ipte", F.round("cum_ipte", 6))
