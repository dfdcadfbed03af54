"""Spelling variants, pieces by chunk table, and ranked search against brute force."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

from logstats.llm import pieces, ranking, spelling

MODEL = public_tokenizers.path("piece_bpe_32k.model")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
# Names that the operators use inside, as columns of the caller.
CLASHES = ("word", "n", "form", "root", "chunk", "ids", "key", "_key", "_packed", "_answers", "kind", "item",
           "rank", "score", "n_tokens", "near", "size", "first", "part", "a", "b", "answers", "_at", "n_near")
LONG = " ".join(f"lang{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}e" for i in range(40_000))
ODD = [
    (1, "Lettre lettre lettra colour color", "fr", "a", 5),
    (1, "Lettre lettre lettra colour color", "fr", "a", 5),
    (2, "lettre lettres colour Colours color", None, "b", 5),
    (3, None, None, None, None),
    (4, "", "en", "a", 0),
    (5, " \t\n\n  ", "de", None, 3),
    (None, "lettre éclair éclairs Éclair", "fr", "b", 9),
    (None, None, None, None, None),
    (6, LONG, "en", "a", 1),
    (7, "12345 !!! 678 ▁▁ x▁", "en", "c", 2),
    (9, "one\x00two \U0001f600 three  four\n five", "fr", "c", 2),
    (10, "x" * 30_000, "en", "c", 2),
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, DOCS)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


def lower(text):
    return text.translate({i: i + 32 for i in range(65, 91)})


# Spelling.


def near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_variants(rows):
    words = Counter()
    for doc_id, text, *_ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = lower(run)
            check = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if check % 97 == 0:
                at = check % len(run)
                run = run[:at] + run[at + 1 :]
            words[run] += 1
    words = {w: n for w, n in words.items() if len(w) >= 5 and n >= 3}
    out, forms = {}, {}
    for word, n in words.items():
        found = [w for w in words if near(word, w)]
        best = min(found, key=lambda w: (-words[w], w), default=None)
        form = best if best is not None and words[best] >= 2 * n else None
        forms[word] = form
        out[word] = (n, len(found), form, words[form] if form else None)
    rows = set()
    for word, values in out.items():
        root = word
        while forms[root]:
            root = forms[root]
        rows.add((word, *values, root))
    return rows


def random_words(seed):
    """Words a few edits away from few others, in counts that make chains of forms."""
    rng = np.random.default_rng(seed)
    letters = list("aeilrsté")
    base = ["".join(rng.choice(letters, int(rng.integers(5, 9)))) for _ in range(12)]
    words = Counter()
    for word in base:
        for _ in range(14):
            chars, times = list(word), int(2 ** rng.integers(1, 7))
            words["".join(chars)] += 60
            for _ in range(int(rng.integers(1, 4))):
                at = int(rng.integers(len(chars)))
                kind = rng.integers(3)
                chars[at : at + (kind != 0)] = [] if kind == 1 else [rng.choice(letters)]
                words["".join(chars)] += times
    texts = list(words.elements())
    rng.shuffle(texts)
    return [(i, " ".join(texts[i::40]), None, None, 0) for i in range(40)]


@pytest.mark.parametrize("block", [spelling.BLOCK, 3])
def test_variants_equal_brute_force(spark, block):
    rows = random_words(block % 7) + ODD
    found = spelling.spelling_variants(spark.createDataFrame(rows, DOCS), block)
    found = found.select("word", "n", "n_near", "form", "form_n", "root").collect()
    expected = brute_variants(rows)
    assert len(found) == len(expected) and set(map(tuple, found)) == expected
    assert sum(form is not None and form != root for _, _, _, form, _, root in expected) > 5


def test_bitsets_of_many_words_tell_near_ones():
    rng = np.random.default_rng(3)
    words = sorted({"".join(rng.choice(list("abc"), int(rng.integers(1, 9)))) for _ in range(6000)})
    assert len(words) > 2048
    index = spelling.PositionIndex(words)
    for word in words[::97]:
        exact, replaced, longer = index.near(word)
        tell = lambda bits: {words[at] for at in spelling._places(bits, index.n)}
        assert word in tell(exact) and all(w.startswith(word) for w in tell(exact))
        assert tell(replaced | longer) == {w for w in words if len(w) >= len(word) and near(word, w)}


def test_variants_of_empty_tables_and_clashing_columns(odd, none):
    assert spelling.spelling_variants(none).count() == 0
    more = odd.withColumns({name: F.lit("lettre") for name in CLASHES})
    assert spelling.spelling_variants(more).exceptAll(spelling.spelling_variants(odd)).isEmpty()


# Pieces.


def brute_pieces(text):
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    ids = library.encode(text or "", add_eos=True)
    hashed = (hashlib.sha256(data.encode()).hexdigest() for data in (" ".join(map(str, ids)), library.decode(ids)))
    return len(ids), *hashed


def random_texts(seed):
    rng = np.random.default_rng(seed)
    parts = [" ", "  ", "\n", "\n\n", "▁", "\t", "the", "ing", "é", "\U0001f600", "Aa", ".", "12", "\x00", "ß", "中文"]
    return ["".join(rng.choice(parts, int(rng.integers(0, 30)))) for _ in range(300)]


@pytest.mark.parametrize("head", [pieces.HEAD_CHUNKS, 20, 0])
def test_pieces_equal_the_library(spark, monkeypatch, head):
    monkeypatch.setattr(pieces, "PART_BYTES", 200)
    rows = ODD + [(100 + i, text, None, None, 0) for i, text in enumerate(random_texts(head))]
    found = pieces.encode_documents(spark.createDataFrame(rows, DOCS), MODEL, head).collect()
    expected = Counter((doc_id, *brute_pieces(text)) for doc_id, text, *_ in rows)
    assert Counter((r["doc_id"], r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in found) == expected


def test_pieces_of_empty_tables_and_clashing_columns(odd, none):
    assert pieces.encode_documents(none, MODEL).count() == 0
    more = odd.withColumns({name: F.lit("x") for name in CLASHES})
    found = pieces.encode_documents(more, MODEL, 3).collect()
    assert all(r["_key"] == r["_packed"] == r["_answers"] == r["ids"] == "x" for r in found)
    assert Counter(r["n_tokens"] for r in found) == Counter(brute_pieces(text)[0] for _, text, *_ in ODD)


def test_the_head_is_bounded_and_holds_the_most_frequent(spark):
    counts = [("a", 9), ("b", 9), ("c", 5), ("d", 4), ("e", 4), ("f", 1), ("g" * 99, 50)]
    table = spark.createDataFrame([(c, n, b"\x01\x00") for c, n in counts], "chunk string, n long, ids binary")
    for most, expected in ((9, set("abcdef")), (5, set("abcde")), (4, set("abc")), (2, set("ab")), (1, set()), (0, set())):
        assert set(pieces.Head.of(table, np.uint16, most).chunks.to_pylist()) == expected


# Ranked search.


def brute_ranking(docs, items):
    pattern = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
    found = [(doc_id, Counter(pattern.findall(lower(text or "")))) for doc_id, text, *_ in docs]
    found = [(doc_id, tfs) for doc_id, tfs in found if tfs]
    n_docs, total = len(found), sum(sum(tfs.values()) for _, tfs in found)
    df = Counter(term for _, tfs in found for term in tfs)
    rows = set()
    for item_id, text in items:
        terms, scores = Counter(pattern.findall(lower(text or ""))), []
        for doc_id, tfs in found:
            m = 100 - 25 + (25 * sum(tfs.values()) * n_docs) // total
            score = 0
            for term, times in terms.items():
                weight = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[term] + 1)))
                score += times * weight * ((10**9 * tfs[term]) // (1000 * tfs[term] + 12 * m))
            if score > 0:
                scores.append((-score, doc_id is None, doc_id or 0))
        for rank, (score, null, doc_id) in enumerate(sorted(scores)[:20], 1):
            rows.add((item_id, rank, None if null else doc_id, -score))
    return rows


def random_documents(seed, size=900):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(size):
        length = int(rng.integers(1, 40))
        words = [f"T{int(x)}" for x in rng.zipf(1.4, length) if x < 200]
        # Copies, also with the doc_id of the first.
        rows.append(rows[-1] if rows and i % 5 == 0 else (int(rng.integers(10**6)), "; ".join(words), None, None, 0))
    return rows


@pytest.mark.parametrize("trees, leaves, block", [(8192, 16, 512), (100, 1, 3)])
def test_ranking_equals_brute_force(spark, monkeypatch, trees, leaves, block):
    monkeypatch.setattr(ranking, "BLOCK_ITEMS", block)
    docs = random_documents(trees) + ODD
    items = [(i, text) for i, (_, text, *_) in enumerate(random_documents(7, 12))]
    items += [(50, "lettre, COLOR t1 t1"), (51, None), (52, ""), (53, "nowhere"), (None, "colour t9"), (50, "lettre, COLOR t1 t1")]
    monkeypatch.setattr(ranking, "TREE_DOCUMENTS", trees)
    monkeypatch.setattr(ranking, "LEAF_DOCUMENTS", leaves)
    frames = spark.createDataFrame(docs, DOCS).repartition(3), spark.createDataFrame(items, "item_id int, text string")
    found = [tuple(r) for r in ranking.rank_documents(*frames).collect()]
    expected = brute_ranking(docs, list(dict.fromkeys(items)))
    assert len(found) == len(expected) and set(found) == expected


def test_ranking_leaves_out_what_cannot_enter(monkeypatch):
    """The search reaches few leaves once the best are known, and finds the same."""
    rng = np.random.default_rng(1)
    vocabulary = {f"t{i}".encode(): i for i in range(30)}
    items = ranking.Items([1], vocabulary, [Counter({27: 1, 28: 2, 29: 1})])
    df = np.arange(30, 0, -1) * 20
    weights = np.zeros((30, 1))
    weights[[27, 28, 29], 0] = 2000, 4000, 2000
    scoring = ranking.Scoring(1000, 20_000, np.arange(30), weights)
    rows = []
    for i in range(1000):
        terms = np.flatnonzero(rng.random(30) < df / 620).astype(np.int32)
        tfs = rng.integers(1, 4, len(terms)).astype(np.int32)
        rows.append((str(i), int(tfs.sum()) + 1, terms.tobytes(), tfs.tobytes()))
    documents = ranking.read_documents(rows, scoring)
    offered = []
    offer = ranking.Best.offer
    monkeypatch.setattr(ranking.Best, "offer", lambda self, item, score, ids: offered.append(score) or offer(self, item, score, ids))
    best = ranking.Best(1)
    ranking.search(documents, scoring, best)
    scores = []
    for one in documents:
        gains = scoring.contributions(one.tfs, one.m)
        scores += [int(gains @ weights[list(one.path), 0])] * len(one.ids)
    assert sorted((s for s, *_ in best.heaps[0]), reverse=True) == sorted((s for s in scores if s > 0), reverse=True)[:20]
    assert len(items.ids) == 1 and len(offered) < len(documents) / 4


def test_ranking_of_empty_tables_and_clashing_columns(spark, odd, none):
    items = spark.createDataFrame([(1, "lettre colour")], "item_id long, text string")
    assert ranking.rank_documents(none, items).count() == 0
    assert ranking.rank_documents(odd, items.limit(0)).count() == 0
    more = odd.withColumns({name: F.lit("x") for name in CLASHES})
    found = ranking.rank_documents(more, items.withColumns({name: F.lit("y") for name in CLASHES}))
    assert set(map(tuple, found.collect())) == brute_ranking(ODD, [(1, "lettre colour")])


def test_documents_and_nodes_bound_scores():
    groups = defaultdict(list)
    rows = [(1, "a b"), (2, "a b c"), (3, "a c"), (4, "b")]
    for doc_id, text in rows:
        groups[tuple(text.split())].append(doc_id)
    scoring = ranking.Scoring(4, 8, np.arange(3), np.ones((3, 1)))
    vocabulary = {"a": 0, "b": 1, "c": 2}
    vectors = [
        (str(i), len(t.split()), np.array([vocabulary[w] for w in t.split()], dtype=np.int32).tobytes(),
         np.ones(len(t.split()), dtype=np.int32).tobytes())
        for i, t in rows
    ]
    documents = ranking.read_documents(vectors, scoring)
    tree = ranking.build_tree(documents)
    assert [d.path for d in documents] == [(0, 1), (0, 1, 2), (0, 2), (1,)]
    assert tree.terms.tolist() == [0, 1, 2] and tree.most.tolist() == [1, 1, 1]
    assert tree.least_m == min(d.m for d in documents)


def test_texts_decode_as_their_chunks_or_by_the_library():
    model = pieces.Model.of(MODEL)
    for text in random_texts(5):
        marked = pieces.marked(text)
        ids = np.array(model.library.encode(text), dtype=model.id_type)
        by_chunks, by_library = (pieces.Rendering(model, exact).of(marked, ids) for exact in (True, False))
        assert by_chunks == by_library == (len(ids) + 1, by_chunks[1], model.library.decode(ids.tolist()).encode())
