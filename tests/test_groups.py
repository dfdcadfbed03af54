import pytest
from pyspark.sql import functions as F

from logstats.operators import groups


def rows(spark, hot):
    """Keys 'a' with ``hot`` rows of one tick, 'b' and null with few."""
    data = [("a", 1.0, n) for n in range(hot)] + [("b", float(n), n) for n in range(5)]
    return spark.createDataFrame(data + [(None, 2.0, 1), (None, 1.0, 2)], "k string, t double, n int")


@pytest.mark.parametrize("max_rows", [1000, 10, 1])
def test_running_total_and_lag(spark, max_rows):
    frame = rows(spark, 100)
    totals = groups.running_total(frame, ["k"], ["t", "n"], "n", "total", max_rows)
    found = {(r.k, r.n): r.total for r in totals.collect()}
    assert len(found) == 107
    assert all(found["a", n] == n * (n + 1) // 2 for n in range(100))
    assert all(found["b", n] == n * (n + 1) // 2 for n in range(5))
    assert found[None, 2] == 2 and found[None, 1] == 3
    lags = groups.lagged(frame, ["k"], ["t", "n"], "n", "before", max_rows)
    found = {(r.k, r.n): r.before for r in lags.collect()}
    assert found["a", 0] is None and found["b", 0] is None and found[None, 2] is None
    assert all(found["a", n] == n - 1 for n in range(1, 100))
    assert found[None, 1] == 2


def test_chunks_are_bounded_and_in_order(spark):
    split = groups.split_groups(rows(spark, 5000), ["k"], ["t", "n"], 500)
    sizes = split.hot.groupBy("k", groups.CHUNK).agg(
        F.count("*").alias("n"), F.min("n").alias("first"), F.max("n").alias("last")
    )
    hot = sizes.orderBy(groups.CHUNK).collect()
    assert {r["k"] for r in hot} == {"a"}
    assert len(hot) > 5 and max(r["n"] for r in hot) <= 500
    assert all(a["last"] < b["first"] for a, b in zip(hot, hot[1:]))
    assert sum(r["n"] for r in hot) == 5000 and split.rows.count() == 7


def test_nothing_to_cut(spark):
    frame = rows(spark, 10)
    split = groups.split_groups(frame, ["k"], ["t", "n"], 500)
    assert split.hot is None and split.rows is frame


@pytest.mark.parametrize("bounded", [True, False, None])
def test_group_stats_keep_null_keys(spark, bounded):
    sums = {"total": F.sum("n"), "n_rows": F.count("*")}
    stats = groups.add_group_stats(rows(spark, 3), ["k"], sums, bounded)
    assert {(r.k, r.total, r.n_rows) for r in stats.collect()} == {
        ("a", 3, 3), ("b", 10, 5), (None, 3, 2)
    }


def test_chunks_are_placed_without_a_shuffle_of_all_rows(spark):
    # As for rows that Spark takes to be too many for a broadcast.
    threshold = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(threshold)
    spark.conf.set(threshold, "-1")
    rows = spark.range(100).withColumnRenamed("id", "place")
    chunks = groups._chunked(rows, ["place"], 7)
    assert {(r["place"], r[groups.CHUNK]) for r in chunks.collect()} == {(i, i // 7) for i in range(100)}
    chunks = groups._chunked(rows, ["place"], 7)
    plan = chunks._jdf.queryExecution().executedPlan().toString()
    spark.conf.set(threshold, before)
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
