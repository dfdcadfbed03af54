"""Exact top-k search in binary codes by incremental multi-index hashing.

A vector's code is the signs of its components, cut into segments of about log2(rows) bits, and
there is one index for each segment. Round r of a query looks up, in every index, the values
that differ from the query's segment in exactly r bits. After round r, every code that is
nearer than ``segments * (r + 1)`` has been found: were it not, it would differ in r + 1 bits
or more in all segments. A query is done once its k-th distance is below that.

The codes are dealt into blocks of bounded size by their hash, and a task has the indexes of one
block. Open queries go to every block, packed many to a row. Probes and candidates are made and
judged inside the task, some at a time; only the k best codes of a block for a query leave it.
So no table of probes is moved, sorted or broadcast, and what a task holds does not grow.

Equal codes are searched once: a code stands for its k smallest ids, which is all that a
top-k list, ordered by distance and id, can take from it. So neither the candidates nor
the answers grow with copies of a vector.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from logstats.llm.common import read_table, small_batches
from logstats.scratch import checkpointed

# Bits of a segment, at least and at most.
NARROWEST, WIDEST = 4, 16
# Codes of a block, about, and the blocks that few codes make.
BLOCK_CODES, FEWEST_BLOCKS = 1 << 16, 12
# Open queries in a row, about, and such rows that a task takes at a time.
ROW_QUERIES, ROWS_AT_ONCE = 1 << 12, 16
# Probes or candidates that a task has at a time, about.
AT_ONCE = 1 << 17
TOP = 10
QUERY_STEP = 50


def segment_bits(rows: int) -> int:
    return min(max(round(math.log2(max(rows, 1))), NARROWEST), WIDEST)


def segment_widths(rows: int, width: int) -> list[int]:
    """Bits of each segment of a code of ``width`` bits; no two differ by more than one."""
    segments = max(1, -(-width // segment_bits(rows)))
    return [width * (i + 1) // segments - width * i // segments for i in range(segments)]


def sign_codes(rows: DataFrame, vector: str, width: int) -> DataFrame:
    """``rows`` with ``code``, the signs of ``vector`` as bits of whole 64-bit words; null vectors are left out.

    A bit is set for a component above 0. Missing components and NaN count as 0.
    """
    words = max(1, -(-width // 64))
    step = max(1, AT_ONCE // width)

    @F.arrow_udf("binary")
    def signs(vectors: pa.Array) -> pa.Array:
        bits = np.zeros((len(vectors), words * 64), dtype=bool)
        for start in range(0, len(vectors), step):
            part = vectors.slice(start, step)
            sizes = pc.fill_null(pc.list_value_length(part), 0).to_numpy(zero_copy_only=False)
            above = pc.fill_null(pc.greater(part.flatten(), 0), False).to_numpy(zero_copy_only=False)
            row = np.repeat(np.arange(start, start + len(part)), sizes)
            at = np.arange(len(above)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            used = at < width
            bits[row[used], at[used]] = above[used]
        packed = pa.py_buffer(np.packbits(bits, axis=1, bitorder="little"))
        return pa.Array.from_buffers(pa.binary(words * 8), len(vectors), [None, packed]).cast(pa.binary())

    return rows.filter(F.col(vector).isNotNull()).withColumn("code", signs(vector))


def _words(codes: pa.Array) -> np.ndarray:
    """Codes of one length as rows of 64-bit words."""
    size = len(codes[0].as_buffer())
    fixed = codes.cast(pa.binary(size))
    words = np.frombuffer(fixed.buffers()[1], dtype="<u8").reshape(-1, size // 8)
    return words[fixed.offset : fixed.offset + len(fixed)]


def _values(words: np.ndarray, widths: Sequence[int]) -> list[np.ndarray]:
    """The value of each segment of each code."""
    bits = np.unpackbits(np.ascontiguousarray(words).view(np.uint8), axis=1, bitorder="little")
    ends = np.cumsum(widths)
    return [
        bits[:, end - width : end].astype(np.int64) @ (1 << np.arange(width, dtype=np.int64))
        for end, width in zip(ends, widths, strict=True)
    ]


class Block:
    """The indexes of some codes, which are numbered by their smallest id, null ids first."""

    def __init__(self, held: pa.StructArray, widths: Sequence[int], at_once: int):
        first = pc.list_element(held.field("ids"), 0)
        order = pc.array_sort_indices(pc.struct_field(first, "id"), null_placement="at_start")
        self.ids = held.field("ids").take(order)
        self.widths, self.at_once = widths, at_once
        words = _words(held.field("code").take(order))
        self.parts = []
        for value, width in zip(_values(words, widths), widths, strict=True):
            number = np.argsort(value, kind="stable")
            lengths = np.bincount(value, minlength=1 << width)
            starts = np.cumsum(lengths) - lengths
            # Words in the order of the index: candidates of a value lie side by side.
            self.parts.append((number, starts, lengths, [np.ascontiguousarray(w) for w in words[number].T]))

    def probes(
        self, starts: np.ndarray, lengths: np.ndarray, values: np.ndarray, flips: np.ndarray
    ) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Query, first place and length of the lists that probes meet in one index."""
        step = max(1, self.at_once // max(len(flips), 1))
        for begin in range(0, len(values) if len(flips) else 0, step):
            probed = (values[begin : begin + step, None] ^ flips).ravel()
            length = lengths[probed]
            met = np.flatnonzero(length)
            query, first, length = begin + met // len(flips), starts[probed[met]], length[met]
            ends = np.cumsum(length)
            cut = 0
            while cut < len(met):
                before = ends[cut] - length[cut]
                stop = max(cut + 1, int(np.searchsorted(ends, before + self.at_once, "right")))
                yield query[cut:stop], first[cut:stop], length[cut:stop]
                cut = stop

    def nearest(self, asked: pa.StructArray, flips: dict[int, np.ndarray], k: int) -> pa.RecordBatch:
        """For each query the k best codes that its probes meet, none beyond its bound."""
        words = _words(asked.field("query"))
        bound = asked.field("bound").to_numpy(zero_copy_only=False).astype(np.int64)
        codes, span = len(self.ids), 64 * words.shape[1] + 1
        best = np.zeros(0, dtype=np.int64)
        found, size = [], 0

        def settled() -> np.ndarray:
            """The k best so far; a query's bound comes down to the last of them."""
            keys = np.unique(np.concatenate([best, *found]))
            query = keys // (span * codes)
            begins = np.flatnonzero(np.diff(query, prepend=-1))
            nth = np.arange(len(keys)) - np.repeat(begins, np.diff(begins, append=len(keys)))
            last = nth == k - 1
            bound[query[last]] = np.minimum(bound[query[last]], keys[last] // codes % span)
            return keys[nth < k]

        for (number, starts, lengths, held), values, width in zip(
            self.parts, _values(words, self.widths), self.widths, strict=True
        ):
            for query, first, length in self.probes(starts, lengths, values, flips[width]):
                ends = np.cumsum(length)
                probe = np.repeat(np.arange(len(length)), length)
                place = np.arange(ends[-1]) + (first - ends + length)[probe]
                distance = sum(
                    np.bitwise_count(word[place] ^ wanted[query][probe]).astype(np.int32)
                    for word, wanted in zip(held, words.T, strict=True)
                )
                near = np.flatnonzero(distance <= bound[query].astype(np.int32)[probe])
                owner = query[probe[near]]
                found.append((owner * span + distance[near]) * codes + number[place[near]])
                size += len(near)
                if size > self.at_once:
                    best = settled()
                    found, size = [], 0
        best = settled()
        query, rest = np.divmod(best, span * codes)
        distance, code = np.divmod(rest, codes)
        columns = [asked.field("query").take(pa.array(query)), pa.array(distance, pa.int32())]
        return pa.RecordBatch.from_arrays([*columns, self.ids.take(pa.array(code))], ["query", "distance", "ids"])


def _blocks(codes: DataFrame, blocks: int, ids: str) -> DataFrame:
    """``block`` and ``held``: the codes, many to a row, dealt by their hash."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in batch["block"].unique():
                part = batch.filter(pc.equal(batch["block"], block)).select(["code", "ids"]).to_struct_array()
                held = pa.ListArray.from_arrays(pa.array([0, len(part)], pa.int32()), part)
                yield pa.RecordBatch.from_arrays([pa.array([block.as_py()], pa.int32()), held], ["block", "held"])

    block = F.pmod(F.xxhash64("code"), F.lit(blocks)).cast("int")
    dealt = codes.select(block.alias("block"), "code", "ids").repartitionById(blocks, F.col("block"))
    return checkpointed(dealt.mapInArrow(pack, f"block int, held array<struct<code:binary,ids:{ids}>>"))


def _seeker(
    widths: Sequence[int], radius: int, k: int, at_once: int
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Looks up queries in the codes of their block, whose rows come before them."""
    flips = {
        width: np.array([sum(1 << bit for bit in bits) for bits in combinations(range(width), radius)], dtype=np.int64)
        for width in set(widths)
    }

    def seek(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held, block = None, [], None
        for batch in batches:
            for at in range(batch.num_rows):
                if batch["block"][at].as_py() != number:
                    number, held, block = batch["block"][at].as_py(), [], None
                asked = batch["asked"][at]
                if not asked.is_valid:
                    held.append(batch["held"][at].values)
                elif held:
                    block = block or Block(pa.concat_arrays(held), widths, at_once)
                    yield block.nearest(asked.values, flips, k)

    return seek


def _kth_distance(best: Column, k: int) -> Column:
    """Distance of the k-th row among the hits; null if they stand for fewer rows."""

    def rows_within(hit: Column) -> Column:
        near = F.filter(best, lambda other: other["distance"] <= hit["distance"])
        return F.aggregate(near, F.lit(0), lambda n, other: n + F.size(other["ids"]))

    enough = F.filter(best, lambda hit: rows_within(hit) >= k)
    return F.array_min(F.transform(enough, lambda hit: hit["distance"]))


def top_k(rows: DataFrame, queries: DataFrame, widths: Sequence[int], k: int = TOP) -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``neighbor_id``, ``distance`` for all queries.

    ``rows`` and ``queries`` have ``id`` and ``code``, whose segments have ``widths`` bits; a query that
    is among the rows finds itself. Equally near rows come by id, null ids first; repeated rows count
    as rows. With fewer than k rows all are returned. No rows or no queries give an empty table.
    """
    spark = rows.sparkSession
    by_id = Window.partitionBy("code").orderBy("id")
    kept = rows.select("id", "code").withColumn("_nth", F.row_number().over(by_id))
    ids = F.sort_array(F.collect_list(F.struct("id"))).alias("ids")
    codes = checkpointed(kept.filter(F.col("_nth") <= k).groupBy("code").agg(ids))
    total = codes.select(F.explode("ids")).limit(k).count()
    blocks = max(FEWEST_BLOCKS, -(-codes.count() // BLOCK_CODES))
    ids_type = "array<struct<id:bigint>>"
    index = _blocks(codes, blocks, ids_type)

    wanted = queries.select(F.col("code").alias("query")).distinct()
    hit_type = f"struct<distance:int,ids:{ids_type}>"
    open_queries = checkpointed(wanted.withColumn("best", F.array().cast(f"array<{hit_type}>")))
    done = open_queries.filter("false")
    order = Window.partitionBy("query").orderBy(F.col("hit.distance").asc_nulls_last(), "hit.ids")
    for radius in range(max(widths) + 1):
        waiting = open_queries.count() if total else 0
        if not waiting:
            break
        kth = _kth_distance(F.col("best"), total)
        bound = F.coalesce(kth, F.lit(sum(widths))).alias("bound")
        row = F.pmod(F.xxhash64("query"), F.lit(-(-waiting // ROW_QUERIES))).alias("_row")
        asked = F.collect_list(F.struct("query", "bound")).alias("asked")
        packed = open_queries.select("query", bound).groupBy(row).agg(asked)
        everywhere = packed.select(F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), "asked")
        found = (
            index.unionByName(everywhere, allowMissingColumns=True)
            .repartitionById(blocks, F.col("block"))
            .sortWithinPartitions("block", F.col("asked").isNotNull())
            .mapInArrow(_seeker(widths, radius, k, AT_ONCE), f"query binary, distance int, ids {ids_type}")
            .select("query", F.struct("distance", "ids").alias("hit"))
        )
        # A query without hits stays as a row with none.
        held = open_queries.select("query", F.explode_outer("best").alias("hit"))
        # A code that k others precede in distance and smallest id has no row in the answer.
        nearest = (
            found.unionByName(held)
            .distinct()
            .withColumn("_nth", F.row_number().over(order))
            .filter(F.col("_nth") <= k)
            .groupBy("query")
            .agg(F.sort_array(F.collect_list("hit")).alias("best"))
        )
        covered = F.lit(len(widths) * (radius + 1))
        settled = F.coalesce(_kth_distance(F.col("best"), total) < covered, F.lit(False))
        with small_batches(spark, ROWS_AT_ONCE):
            merged = checkpointed(nearest.withColumn("_done", settled))
        done = done.unionByName(merged.filter("_done").drop("_done"))
        open_queries = merged.filter("NOT _done").drop("_done")
    hits = done.unionByName(open_queries).select("query", F.explode("best").alias("hit"))
    members = hits.select("query", "hit.distance", F.explode("hit.ids").alias("member"))
    nth = F.row_number().over(Window.partitionBy("query").orderBy("distance", "member.id"))
    answers = members.withColumn("rank", nth).filter(F.col("rank") <= k)
    named = queries.select(F.col("id").alias("query_id"), F.col("code").alias("query"))
    # Spark cannot know how many answers there are, and might broadcast them whatever their number.
    return named.join(answers.hint("merge"), "query").select(
        "query_id", "rank", F.col("member.id").alias("neighbor_id"), "distance"
    )


def search(rows: DataFrame, queries: DataFrame, vector: str, k: int = TOP) -> DataFrame:
    """``top_k`` of vectors, for frames with ``id`` and ``vector``."""
    size = rows.agg(F.count(F.lit(1)).alias("n"), F.max(F.size(vector)).alias("width")).head()
    width = max(size["width"] or 0, 1)
    coded = checkpointed(sign_codes(rows, vector, width).select("id", "code"))
    asked = checkpointed(sign_codes(queries, vector, width).select("id", "code"))
    return top_k(coded, asked, segment_widths(size["n"], width), k)


def op3_hamming_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), "embedding")
    return search(rows, rows.filter(F.col("id") % QUERY_STEP == 0), "embedding")


ORACLE = """
WITH r AS (
  SELECT vec_id, list_transform(embedding, lambda x: (x > 0)::INT) AS bits
  FROM embeddings WHERE embedding IS NOT NULL
), d AS (
  SELECT q.vec_id AS query_id, r.vec_id AS neighbor_id,
         list_sum(list_transform(list_zip(q.bits, r.bits), lambda z: (z[1] <> z[2])::INT))::INT AS distance
  FROM r AS q, r WHERE q.vec_id % 50 = 0
)
SELECT * FROM (
  SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY distance, neighbor_id)::INT AS rank,
         neighbor_id, distance
  FROM d
) WHERE rank <= 10
"""
