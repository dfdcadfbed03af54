"""Sharding along a Hilbert curve.

Metadata columns are quantised, each into the same number of bins with about equally many
rows; a row's bins are a cell of a grid. Rows are sorted by the place of their cell on a
Hilbert curve, and the sorted rows are cut into runs whose counts differ by one at most.
Neighbours on the curve are neighbours in every dimension, so each shard covers a small
range of each column and a reader can skip shards by any of them.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from logstats.llm.common import ranked, read_table, small, unused

BITS = 4
SHARDS = 8


def hilbert_index(cells: Sequence[np.ndarray], bits: int = BITS) -> np.ndarray:
    """Place on the Hilbert curve of cells given by their coordinates, 0 to 2**bits - 1.

    The published transform between axes and transposed index: undo the excess work from
    the highest bit down, then Gray-encode, then read the bits across the dimensions.
    """
    x = [np.asarray(cell).astype(np.int64) for cell in cells]
    for high in range(bits - 1, 0, -1):
        q, p = 1 << high, (1 << high) - 1
        for i in range(len(x)):
            is_set = (x[i] & q) != 0
            swap = np.where(is_set, 0, (x[0] ^ x[i]) & p)
            x[0] = np.where(is_set, x[0] ^ p, x[0] ^ swap)
            x[i] = x[i] ^ swap if i else x[0]
    for i in range(1, len(x)):
        x[i] = x[i] ^ x[i - 1]
    flip = np.zeros_like(x[0])
    for high in range(bits - 1, 0, -1):
        flip = np.where((x[-1] & (1 << high)) != 0, flip ^ ((1 << high) - 1), flip)
    index = np.zeros_like(x[0])
    for bit in range(bits - 1, -1, -1):
        for axis in x:
            index = (index << 1) | (((axis ^ flip) >> bit) & 1)
    return index


def _curve(cells: Sequence[str], bits: int) -> Column:
    @F.pandas_udf("long")
    def place(*columns: pd.Series) -> pd.Series:
        return pd.Series(hilbert_index([column.to_numpy() for column in columns], bits))

    return place(*(F.col(name) for name in cells))


def add_bins(rows: DataFrame, dimension: Column, name: str, bits: int = BITS) -> DataFrame:
    """``rows`` with the bin of ``dimension``: equal values share a bin, bins are in the
    order of the values (nulls first) and hold about equally many rows.

    Rows are counted per value; the window runs over distinct values, one row each.
    """
    value = unused("_value", rows)
    rows = rows.withColumn(value, dimension)
    of = unused("_of", rows)
    counts = rows.groupBy(F.col(value).alias(of)).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy(of).rowsBetween(Window.unboundedPreceding, -1)
    share = F.coalesce(F.sum("_n").over(before), F.lit(0)) / F.sum("_n").over(Window.partitionBy())
    bins = counts.select(of, F.floor(share * (1 << bits)).cast("long").alias(name))
    return rows.join(small(bins), F.col(value).eqNullSafe(F.col(of))).drop(value, of)


def shard_documents(
    docs: DataFrame,
    dimensions: Mapping[str, Column],
    shards: int = SHARDS,
    bits: int = BITS,
) -> DataFrame:
    """Every row of ``docs`` with ``shard`` and ``slot``, its place in the shard from 0.

    Rows are ordered by curve index, CRC-32 of the text and doc_id; equal texts with equal
    metadata lie side by side. Nulls are values like others. Rows equal in all of these
    take neighbouring slots in any order. Counts per shard differ by one at most; with
    fewer rows than shards some stay empty, and an empty table gives an empty table. Columns
    named ``shard`` or ``slot`` are replaced.
    """
    names = [unused(f"_bin{i}", docs) for i in range(len(dimensions))]
    rows = docs
    for name, dimension in zip(names, dimensions.values(), strict=True):
        rows = add_bins(rows, dimension, name, bits)
    curve, at = unused("_curve", docs), unused("_at", docs)
    rows = rows.withColumn(curve, _curve(names, bits)).drop(*names)
    crc = F.coalesce("text_crc32", F.lit(-1)) if "text_crc32" in docs.columns else F.crc32("text")
    placed = ranked(rows, [F.col(curve), crc, F.col("doc_id")], at)
    total = F.lit(max(placed.count(), 1)).cast("long")
    shard = F.floor(F.col(at) * shards / total)
    first = F.ceil(F.col("shard") * total / F.lit(shards))
    return (
        placed.withColumn("shard", shard.cast("int"))
        .withColumn("slot", (F.col(at) - first).cast("long"))
        .drop(curve, at)
    )


def document_dimensions() -> dict[str, Column]:
    """Source, language, and the power of two below the number of UTF-8 bytes."""
    size = F.coalesce(F.octet_length("text"), F.lit(0)) + 1
    return {"source": F.col("source"), "lang": F.col("lang"), "size": F.floor(F.log2(size))}


def op4_hilbert_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select(
        "doc_id",
        "source",
        "lang",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32("text").alias("text_crc32"),
    )
    dimensions = {
        "source": F.col("source"),
        "lang": F.col("lang"),
        "size": F.floor(F.log2("size")),
    }
    return shard_documents(docs, dimensions).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
