"""Mixing sources to target weights by systematic sampling.

Every source gets a share of all words. A document of a source is expected to be taken
``target / source size`` times. In the order of their sizes, the expected copies of a
source's documents are summed up from the left, one random offset is added, and a document
is emitted once for each whole number its sum crosses. Since all documents of a source
have the same expectation, the sum at a document is its place in the source times that
number: an exact product instead of a running sum of fractions. Neighbours have like sizes,
so the words taken miss the target by about the size of one document at most.

Only DataFrame functions are used. The rows are sorted once over all partitions, whatever
the size of a source.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from logstats.llm.common import ranked, read_table, small, unused, word_count

WEIGHTS = (1.0, 2.0, 3.0)
MOST_COPIES = 3
SEED = "mix-1"


def source_targets(
    sources: DataFrame, weights: Sequence[float] = WEIGHTS, most: int = MOST_COPIES
) -> DataFrame:
    """``source``, ``source_size`` and ``n_docs`` with ``first`` (documents of the sources
    before, in code point order, null last) and ``target``.

    Sources take the weights in turn and share all words. A target stops at ``most`` times
    its source's size, and what is above is shared again by weight. Targets are then
    min(cap, level * weight). In the order of cap per weight, putting a source at its cap
    raises the level left for the rest as long as it is capped, and lowers it from then on:
    the level is the largest of these. There is one row for each source, so
    one window over all of them is small work. Sources without words have target 0.
    """
    by_name = Window.orderBy(F.col("source").isNull(), "source")
    before = by_name.rowsBetween(Window.unboundedPreceding, -1)
    turn = (F.row_number().over(by_name) - 1) % len(weights)
    table = sources.select(
        "*",
        F.element_at(F.array(*(F.lit(float(w)) for w in weights)), (turn + 1).cast("int")).alias(
            "weight"
        ),
        F.coalesce(F.sum("n_docs").over(before), F.lit(0)).alias("first"),
        (F.lit(most) * F.col("source_size")).alias("cap"),
    )
    by_cap = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").isNull(), "source")
    from_here = by_cap.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    capped_before = F.coalesce(
        F.sum("cap").over(by_cap.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
    )
    everything = Window.partitionBy()
    level = (F.sum("source_size").over(everything) - capped_before) / F.sum("weight").over(
        from_here
    )
    return (
        table.withColumn("_level", level)
        .withColumn("_level", F.max("_level").over(everything))
        .withColumn("target", F.least(F.col("cap").cast("double"), F.col("_level") * F.col("weight")))
        .select("source", "source_size", "n_docs", "first", "target")
    )


def _offset(source: Column, seed: str) -> Column:
    """One number from 0 to below 1 for each source, the same in every run."""
    text = F.concat(F.lit(seed), F.lit(":"), F.coalesce(source, F.lit("")))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("double") / 4294967296.0


def take_copies(
    docs: DataFrame,
    size: Column,
    weights: Sequence[float] = WEIGHTS,
    most: int = MOST_COPIES,
    seed: str = SEED,
) -> DataFrame:
    """Every row of ``docs`` with ``mix_size``, ``mix_source_size``, ``mix_target`` and
    ``mix_copies``, how often the mix takes it (0 to ``most``).

    ``docs`` has ``doc_id`` and ``source``; a null source is a source. A null size counts
    as 0. Repeated rows are documents of their own. Rows equal in source, size and
    doc_id are interchangeable but for columns not looked at; which of them is taken more
    often is then open. Columns named like the four added are replaced. An empty table
    gives an empty table.
    """
    at, of, first = (unused(name, docs) for name in ("_at", "_source", "_first"))
    rows = docs.withColumn("mix_size", F.coalesce(size, F.lit(0)).cast("long"))
    rows = rows.drop("mix_source_size", "mix_target", "mix_copies")
    order = [F.col("source").isNull(), F.col("source"), F.col("mix_size"), F.col("doc_id")]
    placed = ranked(rows, order, at)
    sources = placed.groupBy("source").agg(
        F.sum("mix_size").alias("source_size"), F.count(F.lit(1)).alias("n_docs")
    )
    targets = source_targets(sources, weights, most)
    targets = small(
        targets.select(
            F.col("source").alias(of),
            F.col("source_size").alias("mix_source_size"),
            F.col("first").alias(first),
            F.col("target").alias("mix_target"),
        )
    )
    joined = placed.join(targets, F.col("source").eqNullSafe(F.col(of)))
    expected = F.when(
        F.col("mix_source_size") > 0, F.col("mix_target") / F.col("mix_source_size")
    ).otherwise(F.lit(0.0))
    place = (F.col(at) - F.col(first)).cast("double")
    offset = _offset(F.col("source"), seed)
    crossed = F.floor((place + 1.0) * expected + offset) - F.floor(place * expected + offset)
    return joined.withColumn("mix_copies", F.least(crossed, F.lit(most))).drop(at, of, first)


def mix_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: the rows of ``docs``, each as often as it is taken.

    Rows are carried whole in one column, so no name in ``docs`` clashes with one used here.
    """
    size = word_count(F.col("text")).alias("size")
    whole = docs.select("doc_id", "source", size, F.struct("*").alias("whole"))
    taken = take_copies(whole, F.col("size"), **options).filter("mix_copies > 0")
    times = F.explode(F.sequence(F.lit(1), F.col("mix_copies").cast("int")))
    return taken.select("whole", times.alias("copy")).select("whole.*")


def op2_systematic_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    narrow = docs.select("doc_id", "source", word_count(F.col("text")).alias("size"))
    return take_copies(narrow, F.col("size")).select(
        "doc_id",
        "size",
        F.col("mix_source_size").alias("source_size"),
        F.col("mix_target").alias("target"),
        (F.col("mix_copies") * F.col("size")).cast("long").alias("taken"),
    )


ORACLE = r"""
WITH d AS (
  SELECT doc_id, source,
         coalesce(length(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size
  FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size, count(*) AS n_docs FROM d GROUP BY source
), w AS (
  SELECT *, [1.0, 2.0, 3.0][((row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 + 1)::INT]::DOUBLE
              AS weight, 3 * source_size AS cap
  FROM s
), l AS (
  SELECT *, (sum(source_size) OVER ()
             - coalesce(sum(cap) OVER (ORDER BY cap / weight, source IS NULL, source
                        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
            / sum(weight) OVER (ORDER BY cap / weight, source IS NULL, source
                        ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS lvl
  FROM w
), t AS (
  SELECT source, source_size,
         least(cap::DOUBLE,
               max(lvl) OVER () * weight) AS target
  FROM l
), r AS (
  SELECT d.doc_id, d.size, t.source_size, t.target,
         (row_number() OVER (PARTITION BY d.source ORDER BY d.size, d.doc_id) - 1)::DOUBLE AS place,
         CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0.0 END AS expected,
         ('0x' || substr(md5('mix-1:' || coalesce(d.source, '')), 1, 8))::BIGINT::DOUBLE / 4294967296.0 AS u
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
       (least(floor((place + 1.0) * expected + u) - floor(place * expected + u), 3) * size)::BIGINT AS taken
FROM r
"""
