"""The job from input files to the written report and diagnostics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from logstats import sources
from logstats.operators import catalog, cleaning, exams, metrics
from logstats.plans.report import (
    RUN_COUNTS,
    counted_machines,
    final_events,
    report_from_events,
    report_of_counted,
)
from logstats.scratch import scratch_folder
from logstats.settings import CONFIG, DEFAULTS, SOFTWARE_REV, Settings, check_mode


def read_log(
    spark: SparkSession,
    log_path: str,
    *,
    system_list_path: str | None = None,
    start_date: str | None = None,
    end_date: str | None = None,
    config: str = CONFIG,
    software_rev: str = SOFTWARE_REV,
    mode: str = "intended",
) -> DataFrame:
    """The log of the listed systems and days; literal ignores both filters.

    Either end of the days may be left open.
    """
    check_mode(mode)
    log = sources.read_machine_log(spark, log_path)
    if system_list_path is not None:
        listed = sources.read_system_list(spark, system_list_path)
        log = cleaning.filter_systems(log, listed, mode)
    log = cleaning.filter_dates(log, start_date, end_date, mode)
    return cleaning.add_constants(log, config, software_rev)


def _observed(rows: DataFrame, **sums: Column) -> tuple[DataFrame, Observation]:
    """The rows, and what is seen of them while they are written."""
    observation = Observation()
    return rows.observe(observation, *(value.alias(name) for name, value in sums.items())), observation


def run_report(
    spark: SparkSession,
    *,
    log_path: str,
    level_weights_path: str,
    code_actions_path: str,
    report_path: str,
    stamp: str = "",
    files: int | None = 1,
    metrics_path: str | None = None,
    all_columns: bool | None = None,
    settings: Settings = DEFAULTS,
    mode: str = "intended",
    **log_options: str | None,
) -> DataFrame:
    """Write the machine report, and diagnostics to ``metrics_path``; return fleet totals.

    The files are read once: rows that play a part, in the columns in use and once each,
    are staged as Parquet in the session's shared folder, whatever their number. Machine
    sizes are counted there. ``all_columns`` drops rows with any null; it is what the
    literal mode does unless told otherwise. The totals are computed from the written report.

    Diagnostics (stage, n) are observed while the staged rows and the machines are written,
    each by the tasks of a last stage, whose results count once; nothing is read again for them.
    """
    check_mode(mode)
    if all_columns is None:
        all_columns = mode == "literal"
    codes = sources.read_code_actions(spark, code_actions_path)
    weights = sources.read_level_weights(spark, level_weights_path)
    log = read_log(spark, log_path, mode=mode, **log_options)
    log = catalog.keep_known_codes(log, codes)
    with scratch_folder(spark, "staged-log") as folder:
        staged, seen = _observed(cleaning.staged_log(log, all_columns), staged=F.count(F.lit(1)))
        staged.write.parquet(f"{folder}/log")
        prepared = cleaning.prepare_log(spark.read.parquet(f"{folder}/log"))
        sizes = exams.log_bounded(prepared, codes, settings)
        if metrics_path is None:
            events = final_events(prepared, codes, weights, settings, sizes)
            report = report_from_events(events, settings, mode)
        else:
            events = final_events(prepared, codes, weights, settings, sizes, "copies")
            sums = {name: F.sum(f"count_{name}") for name in RUN_COUNTS}
            machines, counted = _observed(counted_machines(events, settings, mode, "copies"), **sums)
            machines.write.parquet(f"{folder}/machines")
            counts = [(name, n or 0) for name, n in {**seen.get, **counted.get}.items()]
            diagnostics = spark.createDataFrame(counts, "stage string, n bigint")
            diagnostics.repartition(1).write.csv(f"{metrics_path}{stamp}.csv", header=True)
            report = report_of_counted(spark.read.parquet(f"{folder}/machines"))
        written = sources.write_report(report, report_path, stamp, files)
    return metrics.cumulative_ipte(sources.read_report(spark, written))
