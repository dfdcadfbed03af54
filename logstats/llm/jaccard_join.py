"""Near-duplicate documents: an exact Jaccard join of shingle sets, light and heavy ones apart.

Two documents link when their sets of five-word shingles have a Jaccard similarity of
``THRESHOLD`` percent or more. Documents with equal sets are one class, and one of them stands
for it.

In any fixed order of shingles, sets of n shingles that are similar share their first two
common shingles within the first ``n - ceil(0.75 n) + 2`` of each, and the first one within one
less. So sets are found by keys:

- **small sets** enumerate all two-element subsets of that prefix. A key that two sets share
  means two common shingles, which sets of common phrases seldom share by chance.
- **large sets** have too many subsets; they are entered in and scan the inverted lists of
  the single shingles of their prefix, and so are small sets that may be similar to a large
  one.

The boundary minimises the estimated cost of both, from counts over all documents: a key costs
one, and so do ``COMPARISONS_PER_KEY`` comparisons between members of its list. Both costs are
taken from the keys that begin with a shingle in one slot of ``COST_SLOTS``, each of which is
counted over the whole corpus. The boundary has no upper end.
The order is rare shingles first, by a table of fixed size with the order of magnitude of the
frequency; any other order gives the same links, so the table may be as rough as it needs to be.

Lists with the same members are one. Within a list, all members are compared with one of them
only, the one that reaches the furthest beyond its size; that joins groups of near copies with a
comparison for each member. That one leaves the list, and so do those that sizes and positions
allow no link with another component. Once few comparisons are left, or this no longer
lowers them by half, all remaining members of a list that are in different components and whose
sizes and positions allow a link are compared, large lists in blocks. Pairs inside a component
are never needed, and no pair across components is left out, so the components are exact.

Pairs that share a key by chance grow faster than the corpus. So before the shingles of a pair
travel, the parities of both sets are compared: a bit for each shingle or two, flipped by each
shingle that falls on it. Bits that differ are no more than shingles of one set only, so a pair
with more of them than a link allows is none, and all other pairs are compared whole.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from logstats.llm.common import read_table, shuffles_removed, small, small_batches, unused
from logstats.llm.components import components
from logstats.llm.shingles import mixed, shingle_sets
from logstats.scratch import checkpointed

THRESHOLD = 75
# Frequencies are kept for so many slots, which bounds the table that every task gets.
SLOT_BITS = 22
SLOTS_PER_BLOCK = 1 << 14
# So many comparisons of two entries of a list cost as much as one entry.
COMPARISONS_PER_KEY = 20.0
# Costs are taken from the keys that begin with a shingle in one of so many slots, a power of two.
COST_SLOTS = 16
# Sizes are cut in bands by this factor, a little more than sizes of a link may differ by.
BAND = 1.34
# Most rounds of comparing with one member before all pairs across components are compared,
# and the number of such pairs for each list entry that makes further rounds needless.
STAR_ROUNDS = 6
PAIRS_PER_ENTRY = 20.0
# Members of larger lists are compared block by block.
BLOCK = 2048

_SLOTS = np.uint64((1 << SLOT_BITS) - 1)


def least_overlap(n: int) -> int:
    """The fewest shingles that a set of n shares with one it links to."""
    return -(-THRESHOLD * n // 100)


def _counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Per batch: how often frequent shingles occur."""
    for batch in batches:
        sets = [s for s in shingle_sets(batch["text"]) if len(s) > 2]
        if not sets:
            continue
        tokens, counts = np.unique(np.concatenate(sets), return_counts=True)
        frequent = counts > 1
        yield pd.DataFrame({"token": tokens[frequent].astype(np.int64), "n": counts[frequent]})


def _frequency_classes(slots: DataFrame) -> np.ndarray:
    """The order of magnitude of ``n`` for each slot ``at``, in one byte each.

    Tasks pack blocks of slots; what comes to the driver are the bytes, whatever the corpus.
    """

    def pack(rows: pd.DataFrame) -> pd.DataFrame:
        packed = np.zeros(SLOTS_PER_BLOCK, dtype=np.uint8)
        packed[rows["at"].to_numpy() % SLOTS_PER_BLOCK] = np.log2(rows["n"].to_numpy())
        return pd.DataFrame({"block": [int(rows["at"].iloc[0]) // SLOTS_PER_BLOCK], "packed": [packed.tobytes()]})

    blocks = slots.groupBy((F.col("at") / SLOTS_PER_BLOCK).cast("int").alias("_block"))
    classes = np.zeros((1 << SLOT_BITS) // SLOTS_PER_BLOCK, dtype=f"V{SLOTS_PER_BLOCK}")
    for row in blocks.applyInPandas(pack, "block int, packed binary").collect():
        classes[row["block"]] = np.void(bytes(row["packed"]))
    return classes.view(np.uint8)


def survey(docs: DataFrame) -> np.ndarray:
    """Frequency class by slot; shingles of one slot share the class of the most frequent."""
    counts = docs.select("text").mapInPandas(_counted, "token long, n long")
    counts = counts.groupBy("token").agg(F.sum("n").alias("n"))
    slot = F.col("token").bitwiseAND(int(_SLOTS)).cast("int")
    return _frequency_classes(counts.groupBy(slot.alias("at")).agg(F.max("n").alias("n")))


def prefix(one: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """The rarest shingles of a sorted set, among which any two sets that link have their first
    two common ones. Sets of one or two link with equal sets only and have none."""
    n = len(one)
    if n < 3:
        return one[:0]
    order = np.argsort(classes[(one & _SLOTS).astype(np.int64)], kind="stable")
    return one[order[: n - least_overlap(n) + 2]]


def _digest(one: np.ndarray) -> tuple[int, int]:
    data = hashlib.blake2b(one.tobytes(), digest_size=16).digest()
    return tuple(np.frombuffer(data, dtype=np.int64).tolist())


def parity(one: np.ndarray) -> np.ndarray:
    """A set's parities in words of 64 bits: bit i is odd where shingles with i as their last bits
    are. The bits are a power of two, as many as the set has shingles or more, and 64 at least."""
    bits = 64 << max(0, (len(one) - 1).bit_length() - 6)
    odd = np.bincount((one & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.int64)


def hashed_sets(docs: DataFrame, classes: np.ndarray) -> DataFrame:
    """Per row ``node`` (its number), ``doc_id``, ``row_key``, ``n``, the set's digest, prefix and ``parity``."""

    def hashed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sets = list(shingle_sets(batch.pop("text")))
            h1, h2 = zip(*map(_digest, sets), strict=True) if sets else ((), ())
            rarest = [prefix(one, classes).view(np.int64) for one in sets]
            yield batch.assign(
                n=[len(one) for one in sets],
                h1=np.array(h1, dtype=np.int64),
                h2=np.array(h2, dtype=np.int64),
                prefix=rarest,
                parity=list(map(parity, sets)),
            )

    # The id as text, for pandas turns numbers with nulls among them into floats.
    doc_id, row_key = F.col("doc_id").cast("string"), F.xxhash64("doc_id", "text")
    rows = docs.select(doc_id.alias("doc_id"), row_key.alias("row_key"), "text")
    schema = "doc_id string, row_key long, n long, h1 long, h2 long, prefix array<long>, parity array<long>"
    sets = rows.mapInPandas(hashed, schema).withColumn("doc_id", F.col("doc_id").cast("long"))
    return checkpointed(sets.withColumn("node", F.monotonically_increasing_id()))


def _token_sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """``node`` and its ``tokens`` for the wanted nodes, hashed again from their texts.

    ``wanted`` has ``row_key``, ``node``, the digest, and how many ``rows`` have that key. Rows
    that repeat are reduced to one before they are hashed.
    """

    def hashed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sets = list(shingle_sets(batch.pop("text")))
            batch["tokens"] = [one.view(np.int64) for one in sets]
            digests = list(map(_digest, sets))
            same = [d == (a, b) for d, a, b in zip(digests, batch["h1"], batch["h2"], strict=True)]
            if any(same):
                yield batch.loc[same, ["node", "tokens"]]

    rows = docs.select(F.xxhash64("doc_id", "text").alias("row_key"), "text")
    texts = rows.join(small(wanted), "row_key")
    once = texts.filter("rows > 1").dropDuplicates(["node"])
    texts = texts.filter("rows = 1").unionByName(once).select("node", "h1", "h2", "text")
    return checkpointed(texts.mapInPandas(hashed, "node long, tokens array<long>"))


def _folded(words: str, other: str) -> Column:
    """Parities in as many words as the other set's, if they are twice as many."""
    size = F.size(other)
    halves = F.slice(F.col(words), 1, size), F.slice(F.col(words), size + 1, size)
    half = F.zip_with(*halves, lambda x, y: x.bitwiseXOR(y))
    return F.when(F.size(words) > size, half).otherwise(F.col(words))


def _not_apart(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs whose parities allow a link; all that link are among them.

    With s shingles in both sets together and d in one only, a link has
    ``(100 - THRESHOLD) * s >= (100 + THRESHOLD) * d``. Parities of sets that may link are as
    long or one is twice as long, and that one is folded.
    """
    for side in ("a", "b"):
        own = (F.col(name).alias(f"_{name}_{side}") for name in ("n", "parity"))
        pairs = pairs.join(sets.select(F.col("node").alias(side), *own), side)
    flips = F.zip_with(
        _folded("_parity_a", "_parity_b"), _folded("_parity_b", "_parity_a"), lambda x, y: F.bit_count(x.bitwiseXOR(y))
    )
    apart = F.aggregate(flips, F.lit(0), lambda total, n: total + n)
    both = F.col("_n_a") + F.col("_n_b")
    return pairs.filter(both * (100 - THRESHOLD) >= apart * (100 + THRESHOLD)).select("a", "b")


def _linked(pairs: DataFrame, tokens: DataFrame) -> DataFrame:
    """The pairs that are similar. A set travels once for each of its pairs on one side."""
    right = tokens.select(F.col("node").alias("b"), F.col("tokens").alias("_right"))
    left = tokens.select(F.col("node").alias("a"), F.col("tokens").alias("_left"))
    common = F.size(F.array_intersect("_left", "_right"))
    both = F.size("_left") + F.size("_right") - F.col("_common")
    return (
        pairs.join(right, "b")
        .join(left, "a")
        .withColumn("_common", common)
        .filter(F.col("_common") * 100 >= both * THRESHOLD)
        .select("a", "b")
    )


def _within_reach(n: str, most: str, other_n: str, other_most: str) -> Column:
    return (F.col(n) <= F.col(other_most)) & (F.col(other_n) <= F.col(most))


def _subsets(of: str, first: Callable[[Column], Column] | None = None) -> Column:
    """``key`` of the two-element subsets of an array, or of those that begin with an element
    whose place ``first`` picks."""

    def beginning(i: Column) -> Column:
        token, others = F.get(F.col(of), i), F.slice(F.col(of), i + 2, F.size(of))
        return F.transform(others, lambda other: F.struct(F.lit(0).alias("at"), F.xxhash64(token, other).alias("key")))

    places = F.sequence(F.lit(0), F.size(of) - 1)
    return F.flatten(F.transform(places if first is None else first(places), beginning))


def _singles(of: str) -> Column:
    """``at`` and ``key`` of all elements but the last."""
    front = F.slice(F.col(of), 1, F.size(of) - 1)
    return F.transform(front, lambda token, i: F.struct(i.alias("at"), token.alias("key")))


def _costs(keys: DataFrame) -> dict[int, float]:
    """By size bin, what all keys and their comparisons cost, from the ``key``s of one slot."""
    by_bin = keys.groupBy("key", "bin").agg(F.count(F.lit(1)).alias("n"))
    times = by_bin.groupBy("key").agg(F.sum("n").alias("_times"))
    each = 1 + (F.col("_times") - 1) / COMPARISONS_PER_KEY
    costs = by_bin.join(times, "key").groupBy("bin").agg(F.sum(F.col("n") * each).alias("cost"))
    return {row["bin"]: COST_SLOTS * row["cost"] for row in costs.collect()}


def choose_boundary(once: DataFrame) -> tuple[int, list[tuple[int, float, float]]]:
    """The size up to which sets count as small, and per size bin (its last size) both costs.

    There are eight bins for each doubling of the size, so few rows come to the driver. A key
    costs one at least; where all subsets up to a size cost more by that alone than
    the lists do, the boundary lies below, and nothing more is counted.
    """
    binned = once.withColumn("bin", F.floor(F.log2("n") * 8).cast("int"))

    def in_slot(token: Column) -> Column:
        return token.bitwiseAND(COST_SLOTS - 1) == 0

    singles = F.filter(F.slice(F.col("prefix"), 1, F.size("prefix") - 1), in_slot)
    by_lists = _costs(binned.select("bin", F.explode(singles).alias("key")))
    length = F.size("prefix")
    sizes = binned.groupBy("bin").agg(
        F.max("n").alias("n"), F.sum(length - 1).alias("keys"), F.sum(length * (length - 1) / 2).alias("subsets")
    )
    costs = [
        (row["bin"], row["n"], row["subsets"], max(by_lists.get(row["bin"], 0.0), float(row["keys"])))
        for row in sizes.orderBy("bin").collect()
    ]
    more = np.cumsum([subsets - scan for _, _, subsets, scan in costs])
    possible = [at for (at, *_), least in zip(costs, more, strict=True) if least <= 0]
    if not possible:
        return 0, [(size, subsets, scan) for _, size, subsets, scan in costs]

    def sampled(places: Column) -> Column:
        return F.filter(places, lambda i: in_slot(F.get(F.col("prefix"), i)))

    asked = binned.filter(F.col("bin") <= possible[-1])
    keys = asked.select("bin", F.explode(_subsets("prefix", sampled)).alias("_k")).select("bin", "_k.key")
    by_subsets = _costs(keys)
    costs = [(size, max(by_subsets.get(at, 0.0), subsets), scan) for at, size, subsets, scan in costs]
    total = best = sum(scan for _, _, scan in costs)
    boundary = 0
    for size, subsets, scan in costs:
        total += subsets - scan
        if total <= best:
            best, boundary = total, size
    return boundary, costs


def _distinct_sets(sets: DataFrame) -> DataFrame:
    """One row for equal sets of three or more; the others leave before their keys are made rows."""
    narrow = sets.filter("n > 2").select("node", "h1", "h2")
    reps = narrow.groupBy("h1", "h2").agg(F.min("node").alias("_rep"))
    copies = narrow.join(reps, ["h1", "h2"]).filter("node <> _rep").select("node")
    return sets.filter("n > 2").join(small(copies), "node", "left_anti").select("node", "n", "prefix")


def _inverted_lists(once: DataFrame, boundary: int) -> DataFrame:
    """Entries ``list``, ``node``, ``n``, ``most`` of the lists that could hold a link.

    A list is a key and a band of sizes; a set is in its band's and the next, and so meets
    all sets of a size it can link to. ``most`` is the largest such size: the shingles
    before the key in the order are not common to a pair whose first common one it is. Of two
    sets in one list one must be as large as the other and still reach it, so a list
    needs an entry that reaches its own size.
    """
    none = F.slice(_singles("prefix"), 1, 0)
    light = F.when(F.col("n") <= boundary, _subsets("prefix")).otherwise(none)
    meets_large = F.col("n") * 100 >= THRESHOLD * (boundary + 1)
    heavy = F.when((F.col("n") > boundary) | meets_large, _singles("prefix")).otherwise(none)
    entries = once.select("node", "n", F.explode(F.concat(light, heavy)).alias("_k"))
    most = F.floor((F.col("n") * 100 - F.col("_k.at") * (100 + THRESHOLD)) / THRESHOLD)
    entries = entries.select("node", "n", F.col("_k.key").alias("key"), most.alias("most"))
    # Most entries are alone with their key; a window moves them once.
    of_key = Window.partitionBy("key")
    shared = entries.withColumn("_n", F.count(F.lit(1)).over(of_key)).withColumn(
        "_reach", F.max(F.col("most") - F.col("n")).over(of_key)
    )
    lists = shared.filter("_n > 1 AND _reach >= 0")
    band = F.floor(F.log("n") / math.log(BAND)).cast("int")
    return lists.select(
        "key", "node", "n", "most", F.explode(F.array(band, band + 1)).alias("_band")
    ).select(F.xxhash64("key", "_band").alias("list"), "node", "n", "most")


def _merged(lists: DataFrame) -> DataFrame:
    """Lists with the same members as one, where each member has its largest ``most``.

    Near copies share many keys, and so many lists with the same members. A list's new id is
    a hash of its members; a collision would only put more sets in one list. Lists without
    a second member, or without one that reaches its own size, hold no link.
    """
    lists = checkpointed(lists)
    members = lists.groupBy("list").agg(
        F.count(F.lit(1)).alias("_n"),
        F.bit_xor(F.xxhash64("node")).alias("_members"),
        F.max(F.col("most") - F.col("n")).alias("_reach"),
    )
    merged = members.filter("_n > 1 AND _reach >= 0").select("list", F.xxhash64("_n", "_members").alias("_merged"))
    by_list = lists.join(merged, "list").groupBy(F.col("_merged").alias("list"), "node")
    return by_list.agg(F.min("n").alias("n"), F.max("most").alias("most"))


def _live(lists: DataFrame, labels: DataFrame | None, turn: int) -> DataFrame:
    """Entries that sizes and positions allow a link with another component of their list, with
    the list's size and the one to compare with.

    That one is the entry that reaches the furthest beyond its size: it has the fewest
    shingles of its own, as the text that the others are copies of.
    """
    if labels is None:
        entries = lists.withColumn("comp", F.col("node"))
    else:
        comp = F.coalesce("component", "node").alias("comp")
        entries = lists.join(labels, "node", "left").select("list", "node", "n", "most", comp)
    entries = checkpointed(entries)
    # The furthest reach and the least size of a list, and those of its other components.
    comps = entries.groupBy("list", "comp").agg(F.max("most").alias("most"), F.min("n").alias("n"))
    best = comps.groupBy("list").agg(
        F.max(F.struct("most", "comp")).alias("_far"), F.min(F.struct("n", "comp")).alias("_low")
    )
    others = comps.join(best, "list").groupBy("list").agg(
        F.max("_far").alias("_far"),
        F.max("_low").alias("_low"),
        F.max(F.when(F.col("comp") != F.col("_far.comp"), F.col("most"))).alias("_next_far"),
        F.min(F.when(F.col("comp") != F.col("_low.comp"), F.col("n"))).alias("_next_low"),
    )
    others = others.filter("_next_far IS NOT NULL")
    far = F.when(F.col("comp") == F.col("_far.comp"), F.col("_next_far")).otherwise(F.col("_far.most"))
    low = F.when(F.col("comp") == F.col("_low.comp"), F.col("_next_low")).otherwise(F.col("_low.n"))
    met = entries.join(others, "list").filter((F.col("n") <= far) & (low <= F.col("most")))
    met = checkpointed(met.select("list", "node", "n", "most", "comp"))
    one = F.struct("node", "n", "most", "comp")
    reach = F.struct(F.col("most") - F.col("n"), F.xxhash64("node", F.lit(turn)))
    stats = met.groupBy("list").agg(F.max_by(one, reach).alias("pivot"), F.count(F.lit(1)).alias("size"))
    return checkpointed(met.join(stats, "list"))


def _pairs_left(live: DataFrame) -> float:
    """How many pairs of entries are of one list but different components."""
    comps = live.groupBy("list", "comp").agg(F.count(F.lit(1)).cast("double").alias("_n"), F.max("size").alias("_of"))
    return comps.agg(F.sum(F.col("_n") * (F.col("_of") - F.col("_n")) / 2)).head()[0] or 0.0


def _across(live: DataFrame) -> DataFrame:
    """``a``, ``b`` of one list but different components, where sizes and positions allow a link."""
    blocks = F.ceil(F.col("size") / BLOCK)
    one = live.select(
        "list",
        F.pmod(F.xxhash64("node"), blocks).alias("block"),
        *(F.col(name).alias(f"_{name}") for name in ("node", "n", "most", "comp")),
    )
    other = live.select("list", "node", "n", "most", "comp", F.explode(F.sequence(F.lit(0), blocks - 1)).alias("block"))
    near = (F.col("_comp") < F.col("comp")) & _within_reach("_n", "_most", "n", "most")
    same = (one["list"] == other["list"]) & (one["block"] == other["block"])
    return one.join(other, same & near).select(
        F.least("node", "_node").alias("a"), F.greatest("node", "_node").alias("b")
    )


class _Verifier:
    """Compares pairs, each pair and each text once, and whole only where parities allow a link."""

    def __init__(self, docs: DataFrame, sets: DataFrame):
        self.docs = docs
        self.sketches = sets.select("node", "n", "parity")
        times = sets.groupBy("row_key").agg(F.count(F.lit(1)).alias("rows"))
        self.places = sets.select("node", "row_key", "h1", "h2").join(times, "row_key")
        self.tokens: DataFrame | None = None
        self.tested: DataFrame | None = None

    def links(self, pairs: DataFrame) -> DataFrame:
        pairs = pairs.distinct()
        if self.tested is not None:
            pairs = pairs.join(self.tested, ["a", "b"], "left_anti")
        tested = pairs = checkpointed(pairs)
        nodes = small(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct())
        pairs = checkpointed(_not_apart(pairs, self.sketches.join(nodes, "node", "left_semi")))
        nodes = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
        if self.tokens is not None:
            nodes = nodes.join(self.tokens.select("node"), "node", "left_anti")
        fetched = _token_sets(self.docs, self.places.join(nodes, "node", "left_semi"))
        self.tokens = fetched if self.tokens is None else self.tokens.unionByName(fetched)
        self.tested = tested if self.tested is None else self.tested.unionByName(tested)
        asked = small(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct())
        return checkpointed(_linked(pairs, self.tokens.join(asked, "node", "left_semi")))


def similar_components(docs: DataFrame, sets: DataFrame, boundary: int | None = None) -> DataFrame:
    """``node`` and ``component`` of all classes that link with another one; the boundary is
    chosen by cost where none is given."""
    once = _distinct_sets(sets)
    if boundary is None:
        boundary, _ = choose_boundary(once)
    verifier = _Verifier(docs, sets)
    live = _live(_merged(_inverted_lists(once, boundary)), None, 0)
    links, labels, before = None, None, math.inf
    entries = live.count()
    for turn in range(1, STAR_ROUNDS + 1):
        near = _within_reach("n", "most", "pivot.n", "pivot.most")
        stars = live.filter(near & (F.col("comp") != F.col("pivot.comp")))
        pairs = stars.select(
            F.least("node", "pivot.node").alias("a"), F.greatest("node", "pivot.node").alias("b")
        )
        found = verifier.links(pairs)
        links = found if links is None else links.unionByName(found)
        labels = checkpointed(components(links))
        # The one that all were compared with has met its list.
        others = live.filter(F.col("node") != F.col("pivot.node"))
        live = _live(others.select("list", "node", "n", "most"), labels, turn)
        left = _pairs_left(live)
        if left <= PAIRS_PER_ENTRY * entries or left > before / 2:
            break
        before = left
    rest = verifier.links(_across(live))
    return labels if rest.isEmpty() else components(links.unionByName(rest))


def link_documents(docs: DataFrame, boundary: int | None = None) -> DataFrame:
    """Per row of ``docs``: ``doc_id``, ``row_key``, ``n_shingles``, ``component_id``, ``kept``.

    ``component_id`` is the smallest doc_id reachable by links. A null or empty text, or one
    of white space, has no shingles, links with nothing and is its own component. Repeated
    rows are documents with equal texts. ``boundary`` overrules the one by cost. A null doc_id counts only where a component has
    no other. ``kept`` marks one row of each component, of the smallest doc_id, and every row
    without shingles. An empty table gives an empty table.
    """
    docs = docs.select("doc_id", "text")
    with shuffles_removed(docs.sparkSession), small_batches(docs.sparkSession):
        sets = hashed_sets(docs, survey(docs))
        labels = checkpointed(similar_components(docs, sets, boundary))
    least = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "node"))
    equal = sets.filter("n > 0").groupBy("h1", "h2").agg(
        F.min("node").alias("_rep"), least.alias("_least")
    )
    equal = equal.join(labels, F.col("_rep") == F.col("node"), "left").select(
        "h1", "h2", "_least", F.coalesce("component", "_rep").alias("_comp")
    )
    equal = checkpointed(equal)
    best = equal.groupBy("_comp").agg(F.min("_least").alias("_best"))
    equal = equal.join(best, "_comp").select("h1", "h2", "_best")
    narrow = sets.select("doc_id", "row_key", F.col("n").alias("n_shingles"), "h1", "h2", "node")
    linked = narrow.filter("n_shingles > 0").join(equal, ["h1", "h2"]).select(
        "doc_id",
        "row_key",
        "n_shingles",
        F.col("_best.doc_id").alias("component_id"),
        (F.col("node") == F.col("_best.node")).alias("kept"),
    )
    empty = narrow.filter("n_shingles = 0").select(
        "doc_id", "row_key", "n_shingles", F.col("doc_id").alias("component_id"), F.lit(True).alias("kept")
    )
    return linked.unionByName(empty)


def drop_near_copies(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each component; see ``link_documents``.

    Rows are told apart by their doc_id and key, so that keys of different documents may
    collide. Rows that repeat one that stays are reduced to one; the others that go are
    removed by an anti join, broadcast only if they are few.
    """
    key, of_key, of_id = (unused(name, docs) for name in ("_row_key", "_of_key", "_of_id"))
    linked = checkpointed(link_documents(docs))
    fate = linked.groupBy("doc_id", "row_key").agg(
        F.max("kept").alias("_kept"), F.count(F.lit(1)).alias("_n"), F.max("n_shingles").alias("_size")
    )
    named = [F.col("row_key").alias(of_key), F.col("doc_id").alias(of_id)]
    gone = small(fate.filter("NOT _kept").select(*named))
    repeated = small(fate.filter("_kept AND _n > 1 AND _size > 0").select(*named))
    same = (F.col(key) == F.col(of_key)) & F.col("doc_id").eqNullSafe(F.col(of_id))
    rows = docs.withColumn(key, F.xxhash64("doc_id", "text")).join(gone, same, "left_anti")
    once = rows.join(repeated, same, "left_semi").dropDuplicates(["doc_id", key])
    return rows.join(repeated, same, "left_anti").unionByName(once).drop(key)


def op9_size_aware_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    linked = link_documents(read_table(spark, sf_dir, "documents"))
    return linked.select("doc_id", "n_shingles", "component_id")
