"""Shape of the physical plans: shuffles, pushdown, pruning, no Python in the tasks."""

import re

import pytest
from conftest import TESTDATA

from logstats.checks import views
from logstats.checks.queries import QUERIES
from logstats.operators import catalog, cleaning

SF_DIR = str(TESTDATA / "sf0.001")
pytestmark = pytest.mark.skipif(not TESTDATA.exists(), reason="sample tables not there")

ROW_LEVEL = [
    "exam_segments",
    "exam_events",
    "exam_records",
    "exam_duration",
    "rank_duration",
    "time_lag",
    "exam_incidents",
    "total_shutdowns",
    "ipte",
    "ipte_weighted",
    "additional_stats",
    "top_row_per_machine",
    "machine_report",
    "machine_report_literal",
]


def final_plan(frame):
    frame.collect()
    text = frame._jdf.queryExecution().executedPlan().toString()
    return re.sub(r"#\d+L?", "", text.split("== Initial Plan ==")[0])


@pytest.mark.parametrize("name", ROW_LEVEL)
def test_log_is_shuffled_and_scanned_once(spark, name):
    plan = final_plan(QUERIES[name](spark, SF_DIR))
    shuffles = re.findall(r"\bExchange (\w+)\(([^)]*)\)", plan)
    of_log = [keys for _, keys in shuffles if not keys.startswith(("error_code", "level"))]
    assert of_log == ["system_id, 8"]
    assert plan.count("Scan parquet") == 1
    assert "SortMergeJoin" not in plan and "CartesianProduct" not in plan


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_in_tasks(spark, name):
    plan = QUERIES[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|InPandas|InArrow|NestedLoop|Cartesian", plan)


def test_filters_and_columns_reach_the_scan(spark, tmp_path):
    views.raw_log(spark, SF_DIR).write.parquet(str(tmp_path / "log"))
    log = spark.read.parquet(str(tmp_path / "log"))
    days = cleaning.filter_dates(log, "2024-01-05", "2024-01-06").select("tar_systemid")
    plan = final_plan(days)
    assert "GreaterThanOrEqual(msg_date,2024-01-05)" in plan
    assert "ReadSchema: struct<tar_systemid:string,msg_date:string>" in plan


def test_report_reads_only_its_columns(spark):
    plan = final_plan(QUERIES["machine_report"](spark, SF_DIR))
    assert "props" not in plan


def test_code_tables_are_joined_by_broadcast_when_small(spark):
    log = views.event_log(spark, SF_DIR)
    plan = final_plan(catalog.add_roles(log, views.code_actions(spark)))
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "1")
    try:
        plan = final_plan(catalog.add_roles(log, views.code_actions(spark)))
        assert "BroadcastHashJoin" not in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def test_copies_are_cut_before_the_shuffle(spark):
    texts = ("system_id", "sw_rev", "config", "code", "time_seq", "exam_id")
    events = spark.range(100).selectExpr(
        *(f"string(id % 2) AS {name}" for name in texts),
        *("1.0D exam_start", "5.0D tick", "id seq", "id event_key"),
    )
    frame = cleaning.dedup_events(events.repartition(4))
    plan = final_plan(frame)
    assert plan.count("WindowGroupLimit") == 2
    assert frame.count() == 2
