"""The job's path from files: one read, one dedup, one cut, whatever the size of a machine."""

import re
from dataclasses import replace

import pytest
from conftest import TESTDATA
from pyspark.sql import functions as F
from test_plans import final_plan
from test_sources import LOG, job_files

from logstats import scratch, sources
from logstats.__main__ import arguments
from logstats.checks import views
from logstats.operators import cleaning, exams, groups
from logstats.plans import job, machine_report, report, run_report
from logstats.settings import Settings

SMALL = Settings(max_group_rows=2)


@pytest.mark.parametrize("settings", [Settings(), SMALL])
def test_files_are_read_once(spark, tmp_path, monkeypatch, settings):
    rows = spark.sparkContext.accumulator(0)
    read = sources.read_machine_log

    def counted(session, path):
        def count(value):
            rows.add(1)
            return True

        # Not deterministic, so that Spark neither repeats nor moves it.
        mark = F.udf(count, "boolean").asNondeterministic()
        return read(session, path).filter(mark("dummy"))

    monkeypatch.setattr(job.sources, "read_machine_log", counted)
    files = job_files(tmp_path)
    lines = len((tmp_path / "log_path.csv").read_text().splitlines())
    totals = run_report(spark, report_path=str(tmp_path / "r"), settings=settings, **files)
    assert totals.first().cum_shutdowns == 1
    assert rows.value == lines


def test_job_shuffles_a_digest_and_cuts_once(spark, tmp_path):
    files = job_files(tmp_path)
    codes = sources.read_code_actions(spark, files["code_actions_path"])
    weights = sources.read_level_weights(spark, files["level_weights_path"])
    staged = cleaning.staged_log(job.read_log(spark, files["log_path"]))
    plan = final_plan(staged)
    assert re.findall(r"\bExchange (\w+)\(([^)]*)\)", plan) == [("hashpartitioning", "row_digest, 8")]
    assert plan.count("Scan csv") == 1
    staged.write.parquet(str(tmp_path / "staged"))
    prepared = cleaning.prepare_log(spark.read.parquet(str(tmp_path / "staged")))
    sizes = exams.log_bounded(prepared, codes)
    plan = final_plan(machine_report(prepared, codes, weights, bounded=sizes))
    shuffles = [keys for _, keys in re.findall(r"\bExchange (\w+)\(([^)]*)\)", plan)]
    assert [keys for keys in shuffles if not keys.startswith(("error_code", "level"))] == ["system_id, 8"]


def test_staged_log_is_the_clean_log(spark):
    if not TESTDATA.exists():
        pytest.skip("sample tables not there")
    log = cleaning.add_constants(views.raw_log(spark, str(TESTDATA / "sf0.001")))
    one = cleaning.prepare_log(cleaning.staged_log(log))
    two = cleaning.prepare_log(cleaning.clean_log(log))
    assert one.exceptAll(two).isEmpty() and two.exceptAll(one).isEmpty()


def test_rows_that_swap_a_null_have_two_keys(spark):
    rows = [("s", "START", "1", None, "a"), ("s", "START", "1", "a", None)]
    names = "tar_systemid string, msg_code string, time_seq string, tag string, tar_date string"
    log = spark.createDataFrame(rows, names)
    digests = log.select(cleaning.row_digest(log.columns).alias("d")).distinct()
    assert digests.count() == 2
    other = log.select(cleaning.row_digest(log.columns[::-1]).alias("d"))
    assert other.exceptAll(digests).isEmpty()


def test_open_ends_of_days(spark):
    days = spark.createDataFrame([("2016-01-01",), ("2016-01-02",), (None,)], "msg_date string")
    early = cleaning.filter_dates(days, None, "2016-01-01").collect()
    late = cleaning.filter_dates(days, "2016-01-02", None).collect()
    assert [r[0] for r in early] == ["2016-01-01"] and [r[0] for r in late] == ["2016-01-02"]
    assert cleaning.filter_dates(days, None, None).count() == 3


def test_job_with_one_day_bound_and_metrics(spark, tmp_path):
    files = job_files(tmp_path)
    run_report(
        spark, report_path=str(tmp_path / "r"), metrics_path=str(tmp_path / "m"), files=None,
        start_date="2016-01-01", **files,
    )
    found = spark.read.schema("stage string, n long").csv(str(tmp_path / "m.csv"), header=True)
    counts = {r["stage"]: r["n"] for r in found.collect()}
    assert counts["staged"] == len(LOG) and counts["shutdown_rows"] == 1 and counts["all_exams"] >= 1


def test_literal_job_drops_rows_with_any_null(spark, tmp_path, monkeypatch):
    seen = []
    stage = cleaning.staged_log
    monkeypatch.setattr(job.cleaning, "staged_log", lambda log, all_columns: seen.append(all_columns) or stage(log))
    files = job_files(tmp_path)
    run_report(spark, report_path=str(tmp_path / "a"), mode="literal", **files)
    run_report(spark, report_path=str(tmp_path / "b"), **files)
    run_report(spark, report_path=str(tmp_path / "c"), mode="literal", all_columns=False, **files)
    assert seen == [True, False, False]


def test_arguments():
    needed = ["--log-path", "l", "--level-weights-path", "w", "--code-actions-path", "c", "--report-path", "r"]
    found = arguments([*needed, "--files", "0", "--start-date", "2016-01-01", "--all-columns"])
    assert found["files"] is None and found["start_date"] == "2016-01-01" and found["all_columns"] is True
    assert arguments(needed)["all_columns"] is None and arguments(needed)["mode"] == "intended"
    with pytest.raises(SystemExit):
        arguments(needed[:-2])


def test_steps_checkpoint_once_beyond_the_bound(spark, monkeypatch):
    if not TESTDATA.exists():
        pytest.skip("sample tables not there")
    log, codes = views.event_log(spark, str(TESTDATA / "sf0.001")), views.code_actions(spark)
    events = report.final_events(log, codes, views.level_weights(spark), views.SETTINGS).checkpoint()
    calls = []
    monkeypatch.setattr(report, "checkpointed", lambda rows: calls.append(1) or scratch.checkpointed(rows))
    settings = replace(views.SETTINGS, max_group_rows=5)
    large = report.stepwise_report(events, settings, bounded=False)
    whole = report.stepwise_report(events, views.SETTINGS, bounded=True)
    assert len(calls) == 1
    assert {r["system_id"] for r in large.collect()} == {r["system_id"] for r in whole.collect()}


def test_sizes_count_usable_rows_only(spark):
    codes = spark.createDataFrame([("A", "x", "Start", "L")], "error_code string, description string, action string, level string")
    rows = [(None, "R", "C", "A", 1.0)] * 5 + [("s", "R", "C", "A", None)] * 5 + [("s", "R", "C", "A", 1.0)]
    log = spark.createDataFrame(rows, "system_id string, sw_rev string, config string, code string, tick double")
    assert exams.log_bounded(log, codes, SMALL)
    twice = log.unionByName(log.filter("system_id = 's' AND tick IS NOT NULL"))
    assert not exams.log_bounded(twice, codes, Settings(max_group_rows=1))


def test_running_total_carries_over_nulls_and_null_keys(spark):
    values = [None, None, 1, None, 2, None, None, 3]
    rows = [(key, i, v) for key in ("a", None) for i, v in enumerate(values)]
    frame = spark.createDataFrame(rows, "k string, t int, v int")
    expected = [None, None, 1, 1, 3, 3, 3, 6]
    for max_rows in (100, 3, 1):
        found = groups.running_total(frame, ["k"], ["t"], "v", "total", max_rows).collect()
        for key in ("a", None):
            totals = sorted((r["t"], r["total"]) for r in found if r["k"] == key)
            assert [total for _, total in totals] == expected


def test_chunks_have_exact_sizes(spark):
    frame = spark.range(1000).selectExpr("'a' k", "1.0D t", "id n")
    hot = groups.split_groups(frame, ["k"], ["t", "n"], 70).hot
    sizes = [r["count"] for r in hot.groupBy(groups.CHUNK).count().orderBy(groups.CHUNK).collect()]
    assert sizes == [70] * 14 + [20]


def test_a_null_dummy_drops_the_row_where_all_columns_count(spark):
    names = "dummy string, tar_systemid string, msg_code string, time_seq string, seq_num string"
    rows = [("d", "s", "A", "1", "1"), (None, "s", "A", "2", "2"), ("e", "s", "A", "1", "1")]
    log = cleaning.add_constants(spark.createDataFrame(rows, names))
    for all_columns, expected in ((True, 1), (False, 2)):
        assert cleaning.clean_log(log, all_columns).count() == expected
        assert cleaning.staged_log(log, all_columns).count() == expected
