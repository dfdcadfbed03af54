"""Row-level operators: the way for bounded groups and the way beyond give the same."""

import pytest
from helpers import code_frame, log_frame, random_log
from pyspark.sql import functions as F

from logstats.functions import event_day, ipte_rate, parse_tick, sevone
from logstats.operators import cleaning, incidents, metrics
from logstats.plans import final_events, machine_report, stepwise_report
from logstats.settings import Settings

SETTINGS = Settings(
    service_gap_s=3.0,
    max_exam_s=40.0,
    min_exam_s=4.0,
    exam_code="START",
    reset_code="MON",
    shutdown_codes=("MON",),
    crash_codes=("SVCMON", "STOP"),
    max_group_rows=50,
)


WEIGHTS = [("L1", "0.1"), ("L2", "1"), ("L3", "x")]


@pytest.fixture(scope="module")
def events(spark):
    log = log_frame(spark, random_log(11, 12, 1500, 400, hot=600))
    weights = spark.createDataFrame(WEIGHTS, "level string, wt string")
    records = final_events(log, code_frame(spark), weights, SETTINGS)
    return records.checkpoint()


@pytest.fixture(scope="module")
def ruled(events):
    rows = metrics.exam_duration(metrics.add_day(events), True)
    rows = incidents.exam_incidents(incidents.incident_flags(rows, SETTINGS), True)
    return incidents.subtraction_rule(rows).checkpoint()


OPERATORS = {
    "exam_duration": lambda rows, how: metrics.exam_duration(rows, how),
    "rank_duration": lambda rows, how: metrics.rank_duration(
        rows.withColumn("exam_dur_sec", F.col("tick") % 7), how
    ),
    "time_lag": lambda rows, how: metrics.time_lag(rows, SETTINGS, how),
    "exam_incidents": lambda rows, how: incidents.exam_incidents(rows, how),
    "total_shutdowns": lambda rows, how: incidents.total_shutdowns(rows, bounded=how),
    "total_shutdowns_literal": lambda rows, how: incidents.total_shutdowns(rows, "literal", how),
    "shutdown_crash_counts": lambda rows, how: incidents.shutdown_crash_counts(
        rows, SETTINGS, "exam_day", bounded=how
    ),
    "ipte": lambda rows, how: metrics.ipte(
        incidents.total_shutdowns(rows, bounded=True), SETTINGS, bounded=how
    ),
    "ipte_by_segment": lambda rows, how: metrics.ipte(
        incidents.total_shutdowns(rows, bounded=True),
        Settings(num_exams_by="segment"),
        bounded=how,
    ),
    "ipte_weighted": lambda rows, how: metrics.ipte_weighted(rows, SETTINGS, bounded=how).withColumns(
        {name: F.round(name, 6) for name in ("ipte_weighted", "sum_max_wt_all_exams")}
    ),
    "additional_stats": lambda rows, how: metrics.additional_stats(rows, SETTINGS, bounded=how),
    "additional_stats_literal": lambda rows, how: metrics.additional_stats(
        rows, SETTINGS, "literal", how
    ),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_both_ways_agree(ruled, name):
    operator = OPERATORS[name]
    whole, split = operator(ruled, True), operator(ruled, False)
    split = split.select(*whole.columns)
    assert whole.count() > 0
    assert whole.exceptAll(split).isEmpty() and split.exceptAll(whole).isEmpty()


def same(left, right):
    def rows(frame):
        rounded = [
            tuple(round(v, 6) if isinstance(v, float) else v for v in row)
            for row in frame.collect()
        ]
        return sorted(rounded, key=str)

    return rows(left) == rows(right)


@pytest.mark.parametrize("mode", ["intended", "literal"])
def test_report_is_the_stepwise_report(spark, events, mode):
    """The two aggregations against the row-level chain, with and without large groups."""
    log = log_frame(spark, random_log(11, 12, 1500, 400, hot=600))
    weights = spark.createDataFrame(WEIGHTS, "level string, wt string")
    report = machine_report(log, code_frame(spark), weights, SETTINGS, mode)
    assert report.count() > 12
    assert same(report, stepwise_report(events, SETTINGS, mode, bounded=True))
    assert same(report, stepwise_report(events, SETTINGS, mode, bounded=False))


def test_dedup_keeps_the_earliest_exam(spark):
    data = [
        ("1", "R", "C", "A", "10", "e2", 9.0, 10.0, 1, 1),
        ("1", "R", "C", "A", "10", "e1", 8.0, 10.0, 2, 2),
        ("1", "R", "D", "A", "10", "e3", 8.5, 10.0, 3, 3),
        ("1", "R", "C", "B", "10", "e2", 9.0, 10.0, 4, 4),
    ]
    schema = "system_id string, sw_rev string, config string, code string, time_seq string, " \
        "exam_id string, exam_start double, tick double, seq bigint, event_key bigint"
    kept = cleaning.dedup_events(spark.createDataFrame(data, schema)).collect()
    assert {row.event_key for row in kept} == {2, 4}


@pytest.mark.parametrize(
    ("text", "value"),
    [
        (" 2 ", 2.0), ("1e3", 1000.0), ("-1.5", -1.5), ("0", 0.0), ("", None), ("bad", None),
        ("nan", None), ("inf", None), ("-Infinity", None), ("1.5d", None), ("2F", None),
        ("0x10", None), ("1_0", None), (None, None),
    ],
)
def test_parse_tick(spark, text, value):
    frame = spark.createDataFrame([(text,)], "t string")
    assert frame.select(parse_tick(F.col("t"))).first()[0] == value


def test_scalars(spark):
    frame = spark.createDataFrame([(0.0, 3, 2), (86399.9, 3, 1), (-1.0, 0, 0)], "t double, s int, n int")
    for zone in ("UTC", "America/New_York"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        days = [row[0] for row in frame.select(event_day(F.col("t"))).collect()]
        assert days == ["19700101", "19700101", "19691231"]
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    seven = [row[0] for row in frame.select(sevone(F.col("s"), F.col("n"))).collect()]
    assert seven == [2, 3, 0]
    literal = frame.select(sevone(F.col("s"), F.col("n"), "literal")).collect()
    assert [row[0] for row in literal] == [3, 3, 0]
    rates = [row[0] for row in frame.select(ipte_rate(F.col("s"), F.col("n"))).collect()]
    assert rates == [1500.0, 3000.0, None]
    with pytest.raises(ValueError):
        sevone(F.col("s"), F.col("n"), "other")
