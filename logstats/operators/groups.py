"""Work per group without ever putting a large group into one task.

A window evaluates a whole group in one task. That is the cheapest way as long as groups
are bounded: it adds no shuffle to rows that are partitioned already. ``group_sizes``
finds the groups that are not. Beyond the bound, ``add_group_stats`` aggregates partially and
joins, and ``split_groups`` cuts an ordered group into chunks that are scanned on their own.

The row-level operators take ``bounded``: the ``GroupSizes`` of a caller who has counted, true
or false from one who knows, or None to let them count their own rows. Neither exams nor
machines have more rows later than in the log, so one count serves a whole analysis.
Rows are used twice beyond the bound; a caller with a chain of operators checkpoints once.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logstats.scratch import checkpointed
from logstats.settings import MAX_GROUP_ROWS

CHUNK = "_chunk"


def join_groups(rows: DataFrame, groups: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left join on ``keys`` where a null key meets a null key.

    There is no broadcast hint: Spark broadcasts ``groups`` when it is small and
    otherwise merges, where a hot key on the row side is split at run time.
    """
    renamed = groups.withColumnsRenamed({key: f"_g_{key}" for key in keys})
    condition = [F.col(key).eqNullSafe(F.col(f"_g_{key}")) for key in keys]
    return rows.join(renamed, condition, "left").drop(*(f"_g_{key}" for key in keys))


@dataclass(frozen=True)
class GroupSizes:
    """The groups of ``keys`` with more than the allowed rows; true if there are none."""

    keys: tuple[str, ...]
    large: DataFrame | None

    def __bool__(self) -> bool:
        return self.large is None


Bounded = bool | GroupSizes | None


def group_sizes(
    rows: DataFrame, keys: Sequence[str], max_rows: int = MAX_GROUP_ROWS
) -> GroupSizes:
    """Count groups: one pass over the key columns with map-side counts, for the largest.

    Only where that is beyond the bound are the large groups listed, and checkpointed, so
    that nobody counts again.
    """
    sizes = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    if (sizes.agg(F.max("_n")).head()[0] or 0) <= max_rows:
        return GroupSizes(tuple(keys), None)
    large = checkpointed(sizes.filter(F.col("_n") > max_rows).select(*keys))
    return GroupSizes(tuple(keys), large)


def groups_bounded(
    rows: DataFrame, keys: Sequence[str], max_rows: int = MAX_GROUP_ROWS
) -> bool:
    """Whether no group has more than ``max_rows`` rows."""
    return bool(group_sizes(rows, keys, max_rows))


def add_group_stats(
    rows: DataFrame,
    keys: Sequence[str],
    stats: Mapping[str, Column],
    bounded: Bounded = None,
    max_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """Every row with aggregates of its group.

    Groups that are not bounded are aggregated partially and joined back.
    """
    rows = rows.drop(*stats)
    if bounded is None:
        bounded = group_sizes(rows, keys, max_rows)
    if bounded:
        group = Window.partitionBy(*keys)
        return rows.select("*", *(stat.over(group).alias(name) for name, stat in stats.items()))
    aggregates = [stat.alias(name) for name, stat in stats.items()]
    return join_groups(rows, rows.groupBy(*keys).agg(*aggregates), keys)


@dataclass(frozen=True)
class SplitRows:
    """Rows of bounded groups, and those of large groups with their chunk, or None."""

    rows: DataFrame
    hot: DataFrame | None


def _of_groups(rows: DataFrame, groups: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Semi or anti join where a null key meets a null key; no broadcast hint."""
    renamed = groups.select(*(F.col(key).alias(f"_g_{key}") for key in keys))
    return rows.join(renamed, [F.col(key).eqNullSafe(F.col(f"_g_{key}")) for key in keys], how)


def _chunked(rows: DataFrame, order: Sequence[str], max_rows: int) -> DataFrame:
    """``rows`` in checkpointed chunks of exactly ``max_rows`` rows that follow one another.

    Rows are range-partitioned and sorted; a row's place among all is its place in its
    partition plus the rows of those before. Chunks are cut by that place, so their size
    does not rest on how well the range bounds were sampled. The counts have one row for each
    partition, which bounds their broadcast; without it, all rows would be shuffled once more.
    """
    placed = checkpointed(
        rows.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_place", F.monotonically_increasing_id())
    ).withColumn("_part", F.shiftright("_place", 33))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    counts = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    starts = counts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    place = F.col("_place").bitwiseAND((1 << 33) - 1) + F.col("_start")
    chunk = F.floor(place / F.lit(max_rows)).cast("int")
    return placed.join(F.broadcast(starts), "_part").withColumn(CHUNK, chunk).drop("_place", "_part", "_start")


def split_groups(
    rows: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    max_rows: int = MAX_GROUP_ROWS,
    bounded: Bounded = None,
) -> SplitRows:
    """Cut large groups into chunks that follow one another in ``order``.

    Which groups are large the caller says with ``GroupSizes`` of ``keys`` or some of them;
    otherwise they are counted. The order must be total: then a chunk is bounded even if all
    rows share one tick. Rows with a null key are a group like others.
    """
    if not isinstance(bounded, GroupSizes):
        bounded = GroupSizes((), None) if bounded else group_sizes(rows, keys, max_rows)
    if bounded:
        return SplitRows(rows, None)
    shared = bounded.keys
    hot = _of_groups(rows, bounded.large, shared, "left_semi")
    rest = _of_groups(rows, bounded.large, shared, "left_anti")
    return SplitRows(rest, _chunked(hot, [*keys, *order], max_rows))


def running_total(
    rows: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: str,
    result: str,
    max_rows: int = MAX_GROUP_ROWS,
    bounded: Bounded = None,
) -> DataFrame:
    """Sum of ``value`` from the start of the group up to and with each row.

    Nulls add nothing; the sum is null until there is a value.
    """
    split = split_groups(rows, keys, order, max_rows, bounded=bounded)

    def totals(part: DataFrame, part_keys: Sequence[str]) -> DataFrame:
        steps = Window.partitionBy(*part_keys).orderBy(*order)
        up_to = steps.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        return part.withColumn(result, F.sum(value).over(up_to))

    whole = totals(split.rows, keys)
    if split.hot is None:
        return whole
    chunk_keys = [*keys, CHUNK]
    earlier = Window.partitionBy(*keys).orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        split.hot.groupBy(*chunk_keys)
        .agg(F.sum(value).alias("_total"))
        .select(*chunk_keys, F.sum("_total").over(earlier).alias("_carried"))
    )
    chunks = (
        join_groups(totals(split.hot, chunk_keys), carried, chunk_keys)
        .withColumn("_both", F.col(result) + F.col("_carried"))
        .withColumn(result, F.coalesce("_both", result, "_carried"))
    )
    return whole.unionByName(chunks.drop("_carried", "_both", CHUNK))


def lagged(
    rows: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: str,
    result: str,
    max_rows: int = MAX_GROUP_ROWS,
    bounded: Bounded = None,
) -> DataFrame:
    """``value`` of the row before, in the order of the group."""
    split = split_groups(rows, keys, order, max_rows, bounded=bounded)
    before = F.lag(value).over(Window.partitionBy(*keys).orderBy(*order))
    whole = split.rows.withColumn(result, before)
    if split.hot is None:
        return whole
    chunk_keys = [*keys, CHUNK]
    steps = Window.partitionBy(*chunk_keys).orderBy(*order)
    chunk_steps = Window.partitionBy(*keys).orderBy(CHUNK)
    carried = (
        split.hot.groupBy(*chunk_keys)
        .agg(F.max_by(F.struct(value), F.struct(*order)).alias("_last"))
        .select(*chunk_keys, F.lag("_last").over(chunk_steps).getField(value).alias("_carried"))
    )
    first = F.row_number().over(steps) == 1
    chunks = join_groups(split.hot, carried, chunk_keys).withColumn(
        result, F.when(first, F.col("_carried")).otherwise(F.lag(value).over(steps))
    )
    return whole.unionByName(chunks.drop("_carried", CHUNK))
