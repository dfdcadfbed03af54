"""Ranked lexical search: the best documents for each item, by branch and bound in FP-trees.

A document is restricted to the terms that items have. Its terms, the ones in most documents
first, are a path in a tree; documents whose paths begin alike share them. A node knows, for all
documents below it, the largest occurrence count of each term and the smallest length factor
m, and so bounds their scores for an item from above, since a score grows with the counts
and falls with m. A depth-first search keeps, per item, the best scores so far and leaves out
the nodes below which nothing can enter them. All items go down the tree together, each as
long as its bound allows.

Two passes of Spark tasks do it. The first writes the restricted vectors, with the counts over
all documents that weights and m are made of. In the second a task builds a tree of each
``TREE_DOCUMENTS`` documents, searches it with the scores it has found before, and hands on its best for
each item; the best of these are the best of all. Items go in blocks of about ``BLOCK_ITEMS``, and
each block is a pass of its own.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from logstats.llm.common import read_table
from logstats.scratch import checkpointed

# Fixed values of the score.
TOP, SCALE, FLOOR, SLOPE, SATURATION = 20, 1_000_000_000, 75, 25, 12
BLOCK_ITEMS = 512
TREE_DOCUMENTS = 8192
# So few distinct documents are scored one by one.
LEAF_DOCUMENTS = 16
# Sums below this are exact in double precision, in any order.
_EXACT = 1 << 53

# Digits, letters and all bytes of other characters make terms.
_TERMS = bytes(
    code + 32 if 0x41 <= code <= 0x5A
    else code if 0x30 <= code <= 0x39 or 0x61 <= code <= 0x7A or code >= 0x80
    else 0x20
    for code in range(256)
)


def terms_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_TERMS).split()


@dataclass
class Items:
    """A block of items: their terms numbered, and how often each item has each."""

    ids: list
    vocabulary: dict[bytes, int]
    terms: list[Counter]

    @classmethod
    def of(cls, rows: list) -> Items:
        counts = [Counter(terms_of(row["text"])) for row in rows]
        known = sorted(set().union(*counts)) if counts else []
        vocabulary = {term: i for i, term in enumerate(known)}
        return cls([row["item_id"] for row in rows], vocabulary, [Counter({vocabulary[t]: n for t, n in c.items()}) for c in counts])


_VECTOR = "kind int, doc_id string, a long, b long, terms binary, tfs binary"
_DOCUMENT, _TERM, _TOTAL = 0, 1, 2


def restricted_vectors(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """Three kinds of rows from one pass over the texts, checkpointed.

    A document with some of the terms: ``doc_id``, its number of all terms (``a``), and
    ``terms`` and ``tfs`` as 32-bit integers. For each task, a term (``a``) and the documents with it
    (``b``), and the documents with any term (``a``) and all their terms (``b``).
    """

    def vectors(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        columns = ["kind", "doc_id", "a", "b", "terms", "tfs"]
        having = np.zeros(len(vocabulary), dtype=np.int64)
        documents = occurrences = 0
        for batch in batches:
            out = []
            for doc_id, text in zip(batch["doc_id"], batch["text"], strict=True):
                terms = terms_of(text)
                documents += bool(terms)
                occurrences += len(terms)
                found = Counter(map(vocabulary.get, terms))
                found.pop(None, None)
                if found:
                    own = np.fromiter(found, dtype=np.int32, count=len(found))
                    tfs = np.fromiter(found.values(), dtype=np.int32, count=len(found))
                    having[own] += 1
                    out.append((_DOCUMENT, doc_id, len(terms), 0, own.tobytes(), tfs.tobytes()))
            if out:
                yield pd.DataFrame(out, columns=columns)
        counts = [(_TERM, None, int(term), int(having[term]), None, None) for term in np.flatnonzero(having)]
        yield pd.DataFrame([*counts, (_TOTAL, None, documents, occurrences, None, None)], columns=columns)

    rows = docs.select(F.col("doc_id").cast("string").alias("doc_id"), "text")
    return checkpointed(rows.mapInPandas(vectors, _VECTOR))


@dataclass
class Scoring:
    """Weights of a block's items from counts over all documents; terms numbered by ``df``,
    the most frequent first."""

    documents: int
    occurrences: int
    place: np.ndarray
    weights: np.ndarray

    @classmethod
    def of(cls, items: Items, vectors: DataFrame) -> Scoring:
        """Comes to the driver: a row for each term of the block."""
        total = vectors.filter(F.col("kind") == _TOTAL).agg(F.sum("a"), F.sum("b")).head()
        documents, occurrences = total[0] or 0, total[1] or 0
        df = np.zeros(len(items.vocabulary), dtype=np.int64)
        for row in vectors.filter(F.col("kind") == _TERM).groupBy("a").agg(F.sum("b").alias("n")).collect():
            df[row["a"]] = row["n"]
        place = np.empty(len(df), dtype=np.int64)
        place[np.argsort(-df, kind="stable")] = np.arange(len(df))
        idf = [math.floor(1000 * math.log((2 * documents + 2) / (2 * int(n) + 1))) for n in df]
        weights = np.zeros((len(df), len(items.terms)))
        largest = 0
        for item, terms in enumerate(items.terms):
            for term, times in terms.items():
                weights[place[term], item] = idf[term] * times
            largest = max(largest, sum(abs(idf[term]) * times for term, times in terms.items()) * (SCALE // 1000))
        return cls(documents, occurrences, place, weights if largest < _EXACT else weights.astype(np.int64))

    def length_factor(self, n: int) -> int:
        return FLOOR + SLOPE * n * self.documents // self.occurrences

    def contributions(self, tfs: np.ndarray, m: int) -> np.ndarray:
        """What each term adds, before its weight."""
        return (SCALE * tfs) // (1000 * tfs + SATURATION * m)


@dataclass
class Document:
    """One vector, and the ids of the documents that have it; more than ``TOP`` are never needed."""

    path: tuple[int, ...]
    tfs: np.ndarray
    m: int
    ids: list

    def __lt__(self, other: Document) -> bool:
        return self.path < other.path


def _order(doc_id: int | None) -> tuple[bool, int]:
    return doc_id is None, doc_id or 0


def read_documents(rows: Iterator[tuple], scoring: Scoring) -> list[Document]:
    """Distinct vectors in the order of their paths, with the smallest ids of each."""
    found: dict[tuple, Document] = {}
    for doc_id, n, terms, tfs in rows:
        places = scoring.place[np.frombuffer(terms, dtype=np.int32)]
        order = np.argsort(places)
        counts = np.frombuffer(tfs, dtype=np.int32)[order].astype(np.int64)
        path = tuple(places[order].tolist())
        key = (path, counts.tobytes(), m := scoring.length_factor(n))
        if key not in found:
            found[key] = Document(path, counts, m, [])
        found[key].ids.append(None if doc_id is None else int(doc_id))
    for document in found.values():
        document.ids = heapq.nsmallest(TOP, document.ids, key=_order)
    return sorted(found.values())


@dataclass
class Node:
    """The documents ``[low, high)`` in path order, whose first ``depth`` terms are the same."""

    low: int
    high: int
    terms: np.ndarray
    most: np.ndarray
    least_m: int
    children: list[Node]


def _merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """All terms of some vectors and the largest count of each."""
    terms = np.concatenate([part[0] for part in parts])
    counts = np.concatenate([part[1] for part in parts])
    order = np.argsort(terms, kind="stable")
    terms, counts = terms[order], counts[order]
    first = np.flatnonzero(np.diff(terms, prepend=-1))
    return terms[first], np.maximum.reduceat(counts, first)


def build_tree(documents: list[Document]) -> Node:
    """The tree of documents in path order; chains of nodes with one child are one node."""
    common = [0]
    for one, other in zip(documents, documents[1:], strict=False):
        at, most = 0, min(len(one.path), len(other.path))
        while at < most and one.path[at] == other.path[at]:
            at += 1
        common.append(at)

    def node(low: int, high: int, children: list[Node]) -> Node:
        if children:
            parts = [(child.terms, child.most) for child in children]
            least = min(child.least_m for child in children)
        else:
            own = documents[low:high]
            parts = [(np.array(one.path, dtype=np.int64), one.tfs) for one in own]
            least = min(one.m for one in own)
        return Node(low, high, *_merged(parts), least, children)

    # Nodes that are still open, by where they begin and how long a path they share.
    open_: list[tuple[int, int, list[Node]]] = [(0, 0, [])]

    def close(high: int) -> Node:
        low, _, children = open_.pop()
        return node(low, high, children if high - low > LEAF_DOCUMENTS else [])

    for at in range(1, len(documents) + 1):
        depth = common[at] if at < len(documents) else 0
        done = Node(at - 1, at, np.array(documents[at - 1].path, dtype=np.int64), documents[at - 1].tfs, documents[at - 1].m, [])
        while open_[-1][1] > depth:
            low, _, children = open_[-1]
            children.append(done)
            done = close(at)
        if open_[-1][1] == depth:
            open_[-1][2].append(done)
        else:
            open_.append((done.low, depth, [done]))
    return close(len(documents))


class Best:
    """The best ``TOP`` documents of each item so far."""

    def __init__(self, items: int):
        self.heaps: list[list[tuple]] = [[] for _ in range(items)]
        self.least = np.ones(items)

    def offer(self, item: int, score: int, ids: list) -> None:
        heap = self.heaps[item]
        for doc_id in ids:
            null, value = _order(doc_id)
            entry = (score, not null, -value)
            if len(heap) < TOP:
                heapq.heappush(heap, entry)
            elif entry > heap[0]:
                heapq.heapreplace(heap, entry)
            else:
                break
        if len(heap) == TOP:
            self.least[item] = heap[0][0]


def search(documents: list[Document], scoring: Scoring, best: Best) -> None:
    """Depth first, children with the largest bounds first."""
    weights = scoring.weights

    def bounds(node: Node, items: np.ndarray) -> np.ndarray:
        gains = scoring.contributions(node.most, node.least_m).astype(weights.dtype)
        # A term of weight zero or less raises no bound.
        return gains @ np.maximum(weights[np.ix_(node.terms, items)], 0)

    root = build_tree(documents)
    every = np.arange(weights.shape[1])
    stack = [(root, every, bounds(root, every))]
    while stack:
        node, items, bound = stack.pop()
        alive = bound >= best.least[items]
        items = items[alive]
        if len(items) == 0:
            continue
        if not node.children:
            for one in documents[node.low : node.high]:
                gains = scoring.contributions(one.tfs, one.m).astype(weights.dtype)
                scores = gains @ weights[np.ix_(list(one.path), items)]
                for at in np.flatnonzero(scores >= best.least[items]).tolist():
                    best.offer(int(items[at]), int(scores[at]), one.ids)
            continue
        below = [(child, items, bounds(child, items)) for child in node.children]
        stack.extend(sorted(below, key=lambda entry: entry[2].sum()))


def best_of_tasks(vectors: DataFrame, items: Items, scoring: Scoring) -> DataFrame:
    """``item`` (its place in the block), ``doc_id`` and ``score``, the best of each task."""

    def searched(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        best, held = Best(len(items.ids)), []
        for batch in batches:
            held.extend(batch[["doc_id", "a", "terms", "tfs"]].itertuples(index=False))
            while len(held) >= TREE_DOCUMENTS:
                search(read_documents(held[:TREE_DOCUMENTS], scoring), scoring, best)
                held = held[TREE_DOCUMENTS:]
        if held:
            search(read_documents(held, scoring), scoring, best)
        rows = [
            (item, str(-value) if known else None, score)
            for item, heap in enumerate(best.heaps)
            for score, known, value in heap
        ]
        if rows:
            yield pd.DataFrame(rows, columns=["item", "doc_id", "score"])

    documents = vectors.filter(F.col("kind") == _DOCUMENT).select("doc_id", "a", "terms", "tfs")
    return documents.mapInPandas(searched, "item int, doc_id string, score long")


def rank_documents(docs: DataFrame, items: DataFrame) -> DataFrame:
    """Per item (``item_id``, ``text``) its best documents: ``item_id``, ``rank``, ``doc_id``, ``score``.

    Of equal scores the smaller doc_id comes first, a null one last; rows that repeat are
    documents of their own. Items that repeat are one; an item without terms, and one that no document
    has a term of, has no rows. A null text has no terms. Other columns are not read, and empty
    tables give an empty table.
    """
    spark = docs.sparkSession
    docs, items = docs.select("doc_id", "text"), items.select("item_id", "text").distinct()
    types = {"doc_id": docs.schema["doc_id"].dataType, "item_id": items.schema["item_id"].dataType}
    blocks = max(1, math.ceil(items.count() / BLOCK_ITEMS))
    of_block = F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))
    found = None
    for block in range(blocks):
        rows = Items.of(items.filter(of_block == block).orderBy("item_id", "text").collect())
        vectors = restricted_vectors(docs, rows.vocabulary)
        best = best_of_tasks(vectors, rows, Scoring.of(rows, vectors))
        ids = spark.createDataFrame([(i, None if v is None else str(v)) for i, v in enumerate(rows.ids)], "item int, item_id string")
        order = Window.partitionBy("item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
        top = (
            best.withColumn("doc_id", F.col("doc_id").cast(types["doc_id"]))
            .withColumn("rank", F.row_number().over(order))
            .filter(F.col("rank") <= TOP)
            .join(F.broadcast(ids), "item")
            .select(F.col("item_id").cast(types["item_id"]), "rank", "doc_id", "score")
        )
        found = top if found is None else found.unionByName(top)
    return found


def op13_fp_tree_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rank_documents(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


ORACLE = """
WITH doc_terms AS (
    SELECT d, doc_id, translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term
    FROM (SELECT row_number() OVER () AS d, doc_id,
                 unnest(regexp_extract_all(text, '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS t
          FROM documents)
), item_terms AS (
    SELECT item_id, term, count(*)::BIGINT AS times FROM (
        SELECT item_id, translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term
        FROM (SELECT item_id, unnest(regexp_extract_all(text, '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS t
              FROM (SELECT DISTINCT item_id, text FROM benchmark)))
    GROUP BY ALL
), lengths AS (
    SELECT d, doc_id, count(*)::BIGINT AS n FROM doc_terms GROUP BY ALL
), totals AS (
    SELECT count(*)::BIGINT AS all_n, sum(n)::BIGINT AS all_l FROM lengths
), tfs AS (
    SELECT d, term, count(*)::BIGINT AS tf FROM doc_terms SEMI JOIN item_terms USING (term) GROUP BY ALL
), weights AS (
    SELECT term, floor(1000 * ln((2 * all_n + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
    FROM tfs, totals GROUP BY term, all_n
), scores AS (
    SELECT i.item_id, l.doc_id,
           sum(i.times * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * all_n) // all_l))))::BIGINT AS score
    FROM item_terms i JOIN tfs USING (term) JOIN weights USING (term) JOIN lengths l USING (d), totals
    GROUP BY i.item_id, l.d, l.doc_id
), placed AS (
    SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST)::INT AS rank,
           doc_id, score
    FROM scores WHERE score > 0
)
SELECT * FROM placed WHERE rank <= 20
"""
