"""Documents to training shards: language, near copies, benchmark leaks, mix, shards."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from logstats.llm.common import read_table
from logstats.llm.decontamination import drop_leaks
from logstats.llm.jaccard_join import drop_near_copies
from logstats.llm.language import keep_told
from logstats.llm.mixing import mix_documents
from logstats.llm.sharding import document_dimensions, shard_documents
from logstats.scratch import remove_path, scratch_path

# A text that shares so little with every language's profile is no text in any of them.
LEAST_SCORE = 0.05


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that could be told; ``lang`` stays as it was given."""
    return keep_told(docs, LEAST_SCORE)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return drop_near_copies(docs)


def leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return drop_leaks(docs, read_table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mix_documents(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their shard and slot."""
    return shard_documents(docs, document_dimensions())


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", language),
    ("near_copies", near_copies),
    ("leaks", leaks),
    ("mix", mix),
    ("shard", shard),
]
# Language profiles and the curve are not SQL; the pipeline is tested against its parts.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each is written as Parquet and read by the next.

    What a stage wrote is deleted once the next one is written; the last one stays, since
    the caller reads it.
    """
    docs, before = read_table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before is not None:
            remove_path(spark, before)
        before = path
    return docs
