"""Plans over staged logs: no shuffle, no sort, no other day."""

import re

import pytest
from conftest import TESTDATA
from helpers import SCHEMA, code_frame, random_log
from pyspark.sql import functions as F
from test_plans import final_plan

from logstats.checks import views
from logstats.operators import exams
from logstats.plans import staging
from logstats.settings import Settings

SETTINGS = Settings(service_gap_s=6, max_exam_s=30, max_group_rows=100)


def _kept(rows):
    return sorted((r["event_key"], r["exam_id"], r["outcome"]) for r in rows.filter("kept").collect())


@pytest.mark.parametrize("hot", [0, 400])
def test_a_staged_log_is_cut_without_exchange_and_sort(spark, tmp_path, hot):
    log = spark.createDataFrame(random_log(3, 8, 300, 200, hot), SCHEMA).checkpoint()
    codes = code_frame(spark)
    tables = staging.stage_by_machine(log, codes, f"staged_test_{hot}", str(tmp_path / "t"), 4, SETTINGS)
    assert (tables.hot is not None) == (hot > 0)
    with staging.sorted_buckets(spark):
        cut = staging.staged_cut(spark, tables, codes, SETTINGS)
        plan = final_plan(cut)
        rows = final_plan(staging.staged_cut(spark, staging.MachineTables(tables.rows, None, ""), codes, SETTINGS))
    assert _kept(cut) == _kept(exams.cut_exams(log, codes, SETTINGS, None))
    # What is left are the code table's aggregation and, with chunks, that of their summaries.
    exchanges = [keys for _, keys in re.findall(r"\bExchange (\w+)\(([^)]*)\)", rows)]
    assert all(keys.startswith("error_code") for keys in exchanges)
    assert not re.search(r"\bSort \[", rows) and rows.count("Window") > 2
    if not hot:
        assert not re.search(r"\bSort \[", plan)
    staging.drop_tables(spark, tables)
    assert not spark.catalog.tableExists(tables.rows) and not (tmp_path / "t").exists()


@pytest.mark.skipif(not TESTDATA.exists(), reason="sample tables not there")
def test_a_range_of_days_reads_its_folders_only(spark, tmp_path):
    log = views.event_log(spark, str(TESTDATA / "sf0.001"))
    days = log.unionByName(log.limit(3).withColumn("msg_date", F.lit(None).cast("string")))
    staging.stage_by_day(days, str(tmp_path / "log"))
    folders = [p.name for p in (tmp_path / "log").glob("msg_date=*")]
    assert len(folders) > 25
    some = staging.read_days(log, str(tmp_path / "log"), "2024-01-05", "2024-01-06")
    plan = final_plan(some.select("system_id"))
    assert re.search(r"PartitionFilters: \[[^\]]*msg_date", plan)
    assert some.count() == log.filter("msg_date IN ('2024-01-05', '2024-01-06')").count()
    assert some.columns == log.columns and some.schema["msg_date"].dataType.simpleString() == "string"
    assert staging.read_days(log, str(tmp_path / "log")).count() == days.count()
