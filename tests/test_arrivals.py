"""Malformed lines, loads that come later, reports published again, and sketches of days."""

import re

import pytest
from pyspark.sql import functions as F
from test_plans import final_plan
from test_sources import WIDTH, line

from logstats import schemas, sources
from logstats.operators import arrivals, metrics
from logstats.plans import report as report_plans


def test_malformed_lines_are_told_apart(spark, tmp_path):
    lines = {
        # A quote in the last field that is not closed ends with the line.
        "good": [
            line(), line(msg_text="~a, b~"), line(msg_text="~~", tag=""), ",".join([""] * WIDTH),
            ",".join(["x"] * (WIDTH - 1)) + ",~x,y",
        ],
        "short": ["x", ",".join(["x"] * (WIDTH - 1)), ",".join(["~a,b~"] * (WIDTH - 1))],
        "long": [line() + ",", line(msg_text="~a, b~") + ",y"],
        "quote": ["~" + line(), line(msg_text="~a")],
    }
    (tmp_path / "log.csv").write_text("\n".join(text for texts in lines.values() for text in texts))
    read = sources.read_machine_log_lines(spark, str(tmp_path / "log.csv")).checkpoint()
    found = [tuple(r) for r in sources.quarantined(read).collect()]
    expected = [(fault, text) for fault, texts in lines.items() for text in texts if fault != "good"]
    assert sorted(found) == sorted(expected)
    good = sources.good_rows(read)
    assert good.columns == schemas.MACHINE_LOG.names and good.count() == len(lines["good"])


def test_later_loads_leave_the_digests_where_they_are(spark, tmp_path):
    path = str(tmp_path / "digests")
    arrivals.open_digests(spark, "digests_test", path, 4)
    log = spark.range(60).selectExpr("string(id % 40) AS a", "IF(id % 2 = 0, 'x', NULL) AS b")
    first = arrivals.new_rows(log.filter("a < '3'"), "digests_test").checkpoint()
    arrivals.add_digests(first, "digests_test", 4)
    second = arrivals.new_rows(log, "digests_test").checkpoint()
    arrivals.add_digests(second, "digests_test", 4)
    assert arrivals.new_rows(log, "digests_test").isEmpty()
    both = first.unionByName(second).drop(arrivals.DIGEST)
    assert sorted(map(str, both.collect())) == sorted(map(str, log.distinct().collect()))
    # Another session finds what was loaded by the folder.
    spark.sql("DROP TABLE digests_test")
    arrivals.open_digests(spark, "digests_again", path, 4)
    load = arrivals.new_rows(log, "digests_again")
    plan = final_plan(load)
    assert load.isEmpty()
    scan = plan.index("FileScan parquet spark_catalog.default.digests_again")
    # Between the join and the table there is no exchange.
    assert "Bucketed: true" in plan[scan:]
    assert not re.search(r"Exchange", plan[plan.index("SortMergeJoin") : scan].rpartition("Sort [")[2])
    spark.sql("DROP TABLE digests_again")


def test_a_report_is_published_once_for_its_stamp(spark, tmp_path, monkeypatch):
    data = [("1", 1.5, None, 2, 3, 4, 10.25, 5.0), ("2", 0.0, 1.0, 0, 0, 1, 7.0, 6.0)]
    report = spark.createDataFrame(data, schemas.MACHINE_REPORT)
    for rows in (report.limit(1), report):
        written = sources.publish_report(rows, str(tmp_path / "out"), "_s")
    assert sorted(map(tuple, sources.read_report(spark, written).collect())) == data
    broken = report.withColumn("ipte_weighted", F.raise_error(F.lit("lost")).cast("double"))
    with pytest.raises(Exception, match="lost"):
        sources.publish_report(broken, str(tmp_path / "out"), "_s")
    with pytest.raises(Exception, match="lost"):
        sources.publish_report(broken, str(tmp_path / "out"), "_t")
    assert sorted(map(tuple, sources.read_report(spark, written).collect())) == data
    assert [p.name for p in tmp_path.glob("out*")] == ["out_s.csv"]


def test_sketches_of_days_add_up(spark):
    events = spark.range(30_000).selectExpr(
        "string(id % 9000) AS exam_id", "string(id % 300) AS system_id", "86400.0D * (id % 7) AS tick"
    )
    sketches = metrics.daily_sketches(events).checkpoint()
    assert sketches.count() == 7
    about = metrics.period_distinct_counts(sketches).head()
    assert about["num_exams"] == pytest.approx(9000, rel=metrics.sketch_error())
    assert about["num_systems"] == pytest.approx(300, rel=metrics.sketch_error())
    assert tuple(metrics.period_distinct_counts(sketches.limit(0)).head()) == (0, 0)


def test_rates_are_taken_in_one_pass(spark):
    names = "system_id string, sw_rev string, config string, exam_id string, code string, mebef_wt double, " \
        "num_shutdowns long, tick double, seq long, event_key long, num_tps_resets long"
    rows = [(str(i % 3), "R", "C", f"{i % 3}-{i % 5}", "A", float(i % 4), i % 3, float(i), i, i, 0) for i in range(60)]
    frame = spark.createDataFrame(rows, names)
    settings = report_plans.DEFAULTS
    for bounded in (True, False):
        both = metrics.ipte_and_weighted(frame, settings, bounded).drop("mebef_wt")
        severity = {r["system_id"]: r for r in metrics.ipte(frame, settings, "intended", bounded).collect()}
        weighted = {r["system_id"]: r for r in metrics.ipte_weighted(frame, settings, "intended", bounded).collect()}
        for row in both.collect():
            one, two = severity[row["system_id"]], weighted[row["system_id"]]
            assert (row["num_exams"], row["num_sev1"]) == (one["num_exams"], one["num_sev1"])
            assert row["ipte_severity"] == one["ipte_severity"]
            assert row["ipte_weighted"] == two["ipte_weighted"]
            assert row["sum_max_wt_all_exams"] == two["sum_max_wt_all_exams"]
