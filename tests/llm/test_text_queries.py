"""The registered text queries and the pipeline on the sample tables."""

from __future__ import annotations

from collections import Counter

import duckdb
import pytest
from conftest import TESTDATA
from pyspark.sql import functions as F

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from logstats.llm.jaccard_join import link_documents
from logstats.llm.registry import ORACLES, QUERIES

SF_DIR = TESTDATA / "sf0.001"
pytestmark = pytest.mark.skipif(not SF_DIR.exists(), reason="sample tables not there")


def test_everything_is_registered():
    assert {f"op{n}_" for n in range(1, 14)} == {name.split("_")[0] + "_" for name in QUERIES}
    assert {*QUERIES, "pipeline"} <= set(queries()) and set(ORACLES) <= set(oracle_sql())
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language", "near_copies", "leaks", "mix", "shard"]


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    database = duckdb.connect()
    for path in SF_DIR.glob("*.parquet"):
        database.execute(f"CREATE VIEW {path.stem} AS FROM '{path}'")
    frame = QUERIES[name](spark, str(SF_DIR))
    names = sorted(frame.columns)
    result = database.execute(ORACLES[name])
    places = [[column[0] for column in result.description].index(n) for n in names]
    expected = Counter(tuple(row[p] for p in places) for row in result.fetchall())
    assert Counter(tuple(row) for row in frame.select(*names).collect()) == expected


def test_held_out_languages_are_told(spark):
    docs = spark.read.parquet(f"{TESTDATA}/sf0.01/documents.parquet").select("doc_id", "lang")
    found = QUERIES["op6_rank_order"](spark, f"{TESTDATA}/sf0.01").filter("held_out")
    right = found.join(docs, "doc_id").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")))
    assert right.head()[0] > 0.97


def test_pipeline_stages_do_their_part(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    told = stages["language"](spark, docs, str(SF_DIR))
    assert told.columns == docs.columns and told.count() == docs.count()
    linked = link_documents(told)
    groups = linked.select("component_id").distinct().count()
    once = stages["near_copies"](spark, told, str(SF_DIR)).checkpoint()
    assert once.columns == docs.columns and once.count() == groups
    clean = stages["leaks"](spark, once, str(SF_DIR)).checkpoint()
    leaking = QUERIES["op5_simhash_leaks"](spark, str(SF_DIR)).select("doc_id").distinct()
    assert clean.exceptAll(once.join(leaking, "doc_id", "left_anti")).isEmpty()
    assert clean.count() == once.join(leaking, "doc_id", "left_anti").count()
    result = corpus_pipeline.run(spark, str(SF_DIR)).cache()
    taken = Counter(r["doc_id"] for r in result.collect())
    assert set(taken) <= {r["doc_id"] for r in clean.collect()} and max(taken.values()) <= 3
    sizes = [r["count"] for r in result.groupBy("shard").count().collect()]
    assert max(sizes) - min(sizes) <= 1


@pytest.mark.parametrize("name", [name for name, _ in corpus_pipeline.STAGES])
def test_stages_take_empty_tables_and_other_columns(spark, name):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").limit(0)
    docs = docs.withColumns({"row_key": F.lit(1), "score": F.lit("x")})
    found = dict(corpus_pipeline.STAGES)[name](spark, docs, str(SF_DIR))
    assert found.count() == 0 and set(docs.columns) <= set(found.columns)
