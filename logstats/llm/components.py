"""Connected components of a graph whose edges are a DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logstats.scratch import checkpointed


def _stars(edges: DataFrame, of_smaller: bool) -> DataFrame:
    """Hang the neighbours of every node on the least of them.

    The large star moves a node's larger neighbours, the small star its smaller ones and
    itself. The least neighbour is a partial aggregation and comes back by a join, so a
    node with very many neighbours is not one task's work.
    """
    if of_smaller:
        pairs = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        least = pairs.groupBy("u").agg(F.min("v").alias("m"))
        moved = pairs.join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))
        moved = moved.unionByName(least.select(F.col("u").alias("a"), F.col("m").alias("b")))
    else:
        pairs = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
            edges.select(F.col("b").alias("u"), F.col("a").alias("v"))
        )
        least = pairs.groupBy("u").agg(F.min("v").alias("_v")).select("u", F.least("u", "_v").alias("m"))
        moved = pairs.filter("v > u").join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    return moved.filter("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``component``, its least reachable node, for all nodes of ``a``, ``b``.

    Large and small stars alternate until every node hangs on the least of its component,
    which takes about log(nodes) rounds. Each round is checkpointed.
    """
    edges = checkpointed(edges.filter("a <> b").select("a", "b").distinct())
    state = None
    while True:
        edges = checkpointed(_stars(_stars(edges, of_smaller=False), of_smaller=True))
        found = edges.agg(
            F.count(F.lit(1)), F.expr("bit_xor(xxhash64(a, b))"), F.expr("count_if(a < b)")
        ).head()
        if tuple(found) == state:
            break
        state = tuple(found)
    hung = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return hung.unionByName(roots)
