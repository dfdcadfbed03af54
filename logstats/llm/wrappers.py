"""Main text of web pages by wrapper induction.

Pages of a host come from a few templates. Their trees of block elements, with siblings of one
kind taken together, are aligned by simple tree matching: two trees match if their roots do,
and their children are matched in order so that most nodes match in all. Aligned trees are
merged into one that counts, for each node, the pages it is on, and where on how many pages
the same text stands there. Text that most of a node's pages have there, and most in one place
from the start or the end of the page, is template; a node whose text varies is a slot.

Only texts on pages of most different contents come into question, counted over all pages
before trees are made: pages with the same longest block count as one, so that near copies do
not make their common paragraphs template, however many they are.

The content is the lowest node that holds all varying text of the host that is no aside. A page's main
text is what the page has below the node aligned with it, without asides (menus, adverts,
forms and the like, known by element, role or name), and without template text. What is an
aside by its name only, or a form, is none if it holds most of the host's varying text. A page that
has no such node, or a host with a single page, is judged by its own tree alone.

Merging trees is associative: each task merges the pages it reads host by host, and only the
merged trees are shuffled, first into parts of a host, then per host. They hold no texts but those
in question, and so stay small. Pages are read once for each of the three steps, and never
shuffled as long as the hosts' trees are few. Trees have a bounded depth, see ``dom``.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logstats.llm.common import read_table, small, unused
from logstats.llm.dom import WEAK, Node, blocks_below, parse
from logstats.llm.urls import url_parts
from logstats.scratch import checkpointed

# Fewer pages, or different contents, say nothing about what is template.
LEAST_PAGES = 4
# Share of a host's pages that have a text, for it to be template.
SHARED = 0.5
# Share of a tree's varying text below a child, for most of the content to be there.
MOST_TEXT = 0.7
# Trees a task holds at a time, and parts that a host's trees are first merged in.
HELD_TREES = 2000
PARTS = 64
# Trees are broadcast up to so many hosts.
BROADCAST_HOSTS = 20_000
# Blocks of running text; content is not looked for below one.
TEXT_BLOCKS = frozenset("p h1 h2 h3 h4 h5 h6 li dd dt td th pre blockquote figcaption address".split())

# A tree is a list: signature, pages, characters, {text key: [pages, characters, {place: pages}]},
# children.
SIGNATURE, PAGES, CHARS, TEXTS, CHILDREN = range(5)
# A rule has a last element at its root: signatures that are asides by name but hold the text.
HOLDING = 5


def text_key(text: str) -> int:
    """64 bits of a text's digest, signed."""
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), signed=True)


def _kinds(nodes: list[Node]) -> list[list[Node]]:
    """The children of some nodes, those of one kind together; asides are left out."""
    kinds: dict[str, list[Node]] = {}
    for node in nodes:
        for child in node.children:
            if not child.aside:
                kinds.setdefault(child.signature, []).append(child)
    return list(kinds.values())


def placed_blocks(root: Node) -> list[tuple[int, str, int, int]]:
    """All blocks that are in no aside: number, text, and place from the start and from the end.

    Asides by name only may turn out to be some or not, so blocks outside of them are numbered
    without them.
    """
    found, left = [], [(root, False)]
    while left:
        node, weak = left.pop()
        if not node.aside:
            weak = weak or node.weak
            found += ((at, weak, text) for at, text in node.blocks)
            left += ((child, weak) for child in node.children)
    found.sort()
    placed = []
    total, plain = len(found), sum(not weak for _, weak, _ in found)
    before = 0
    for i, (at, weak, text) in enumerate(found):
        placed.append((at, text, i, total - 1 - i) if weak else (at, text, before, plain - 1 - before))
        before += not weak
    return placed


def page_tree(nodes: list[Node], known: set[int] | None = None, places: dict | None = None) -> list:
    """The tree of one page from all its nodes of one kind; asides are left out.

    Of ``known`` texts it says where they stand; of all, if that is not given.
    """
    if places is None:
        places = {at: (f"s{start}", f"e{end}") for at, _, start, end in placed_blocks(nodes[0])}
    chars: dict[int, int] = {}
    texts: dict[str, list] = {}
    for node in nodes:
        for at, text in node.blocks:
            key = text_key(text)
            chars[key] = len(text)
            if known is None or key in known:
                texts.setdefault(str(key), [1, len(text), {}])[2].update(dict.fromkeys(places.get(at, ()), 1))
    below = [page_tree(kind, known, places) for kind in _kinds(nodes)]
    return [nodes[0].signature, 1, sum(chars.values()), texts, below]


def _match(left: list, right: list, known: dict | None = None) -> tuple[int, list[tuple[int, int]]]:
    """Nodes matched below two matching roots, and the matched pairs of children.

    ``known`` keeps what was found for pairs of nodes below.
    """
    known = {} if known is None else known
    if (id(left), id(right)) in known:
        return known[id(left), id(right)]
    rows, columns = left[CHILDREN], right[CHILDREN]
    best = [[0] * (len(columns) + 1) for _ in range(len(rows) + 1)]
    for i, one in enumerate(rows):
        for j, other in enumerate(columns):
            weight = 0
            if one[SIGNATURE] == other[SIGNATURE]:
                weight = 1 + _match(one, other, known)[0]
            best[i + 1][j + 1] = max(best[i][j + 1], best[i + 1][j], best[i][j] + weight)
    pairs, i, j = [], len(rows), len(columns)
    while i and j:
        if best[i][j] == best[i - 1][j]:
            i -= 1
        elif best[i][j] == best[i][j - 1]:
            j -= 1
        else:
            i, j = i - 1, j - 1
            pairs.append((i, j))
    known[id(left), id(right)] = best[-1][-1], pairs[::-1]
    return known[id(left), id(right)]


def merge(left: list, right: list, known: dict | None = None) -> list:
    """One tree of both; ``left`` is changed. Unmatched children keep their place."""
    known = {} if known is None else known
    matched = _match(left, right, known)[1]
    left[PAGES] += right[PAGES]
    left[CHARS] += right[CHARS]
    for key, (pages, chars, places) in right[TEXTS].items():
        counts = left[TEXTS].setdefault(key, [0, 0, {}])
        counts[0] += pages
        counts[1] += chars
        for place, times in places.items():
            counts[2][place] = counts[2].get(place, 0) + times
    merged, i, j = [], 0, 0
    for a, b in [*matched, (len(left[CHILDREN]), len(right[CHILDREN]))]:
        merged += left[CHILDREN][i:a] + right[CHILDREN][j:b]
        if a < len(left[CHILDREN]):
            merged.append(merge(left[CHILDREN][a], right[CHILDREN][b], known))
        i, j = a + 1, b + 1
    left[CHILDREN] = merged
    return left


def _shared(node: list) -> dict:
    if node[PAGES] < LEAST_PAGES:
        return {}
    most = SHARED * node[PAGES]
    return {key: counts for key, counts in node[TEXTS].items() if max(counts[2].values(), default=0) > most}


def _slot_chars(node: list) -> int:
    own = node[CHARS] - sum(chars for _, chars, _ in _shared(node).values())
    return own + sum(_slot_chars(child) for child in node[CHILDREN])


def _all_chars(node: list) -> int:
    return node[CHARS] + sum(_all_chars(child) for child in node[CHILDREN])


def _holding(tree: list) -> set[str]:
    """Signatures of asides by name that hold more than half of the varying text."""
    chars_of = _slot_chars if _slot_chars(tree) else _all_chars
    chars: dict[str, int] = {}

    def add(node: list, above: frozenset[str]) -> None:
        name = node[SIGNATURE]
        if name.startswith(WEAK) and name not in above:
            chars[name] = chars.get(name, 0) + chars_of(node)
            above = above | {name}
        for child in node[CHILDREN]:
            add(child, above)

    add(tree, frozenset())
    total = chars_of(tree)
    return {name for name, count in chars.items() if 2 * count > total}


def _without_asides(tree: list, holding: set[str]) -> list:
    below = [
        _without_asides(child, holding)
        for child in tree[CHILDREN]
        if not child[SIGNATURE].startswith(WEAK) or child[SIGNATURE] in holding
    ]
    return [*tree[:CHILDREN], below]


def _lowest(node: list, share: float) -> list:
    """The lowest node of a tree that has so much of the varying text, child by child."""
    while node[CHILDREN]:
        total = _slot_chars(node)
        chars, i = max((_slot_chars(child), -i) for i, child in enumerate(node[CHILDREN]))
        below = node[CHILDREN][-i]
        kind = below[SIGNATURE].removeprefix(WEAK).partition(".")[0]
        if chars == 0 or chars < share * total or kind in TEXT_BLOCKS:
            break
        node = below
    return node


def wrapper(tree: list) -> list:
    """What extraction needs of a host's tree: signature, whether it is the content, the
    template texts, and the children, of all nodes.

    If most text where the bulk of the content lies is the same on most pages, these are copies
    of one page and no text there is template.
    """
    holding = _holding(tree)
    tree = _without_asides(tree, holding)
    content, bulk = _lowest(tree, 1.0), _lowest(tree, MOST_TEXT)
    varies = 2 * _slot_chars(bulk) >= _all_chars(bulk)

    def plain(node: list, inside: bool, in_bulk: bool) -> list:
        inside, in_bulk = inside or node is content, in_bulk or node is bulk
        shared = sorted(_shared(node)) if inside and (varies or not in_bulk) else []
        children = [plain(child, inside, in_bulk) for child in node[CHILDREN]]
        return [node[SIGNATURE], int(node is content), 0, shared, children]

    return [*plain(tree, False, False), sorted(holding)]


def _settle(root: Node, rule: list) -> None:
    """Make asides by name asides, except where the rule says that they hold the text."""
    left = [root]
    while left:
        node = left.pop()
        node.aside = node.aside or (node.weak and node.signature not in rule[HOLDING])
        left += node.children


def _outline(nodes: list[Node]) -> list:
    """The tree of one page without its texts, and its nodes after the children."""
    return [nodes[0].signature, 1, 0, {}, [_outline(kind) for kind in _kinds(nodes)], nodes]


def _content_nodes(rule: list, root: Node, dropped: set[int]) -> list[Node]:
    """The page's nodes aligned with the content, collecting template blocks on the way."""
    found: list[Node] = []
    known: dict = {}
    left = [(rule, _outline([root]))]
    while left:
        part, page = left.pop()
        nodes, shared = page[-1], set(part[TEXTS])
        if shared:
            dropped.update(at for node in nodes for at, text in node.blocks if str(text_key(text)) in shared)
        if part[PAGES]:
            found += nodes
        left += ((part[CHILDREN][i], page[CHILDREN][j]) for i, j in _match(part, page, known)[1])
    return found


def main_text(page: str | None, rule: list | None) -> str:
    """The main text of a page, its blocks apart by line ends."""
    if not page:
        return ""
    dropped: set[int] = set()
    blocks = []
    if rule:
        root = parse(page)
        _settle(root, rule)
        content = _content_nodes(rule, root, dropped)
        blocks = [text for at, text in blocks_below(content) if at not in dropped]
    if not blocks:
        root = parse(page)
        rule = wrapper(page_tree([root]))
        _settle(root, rule)
        blocks = [text for _, text in blocks_below(_content_nodes(rule, root, set()))]
    return "\n".join(blocks)


def _page_texts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Per page, its distinct texts and the one that stands for its content; and that it is a page."""
    for batch in batches:
        rows = []
        for host, page in zip(batch["host"], batch["page"], strict=True):
            texts = {text for _, text, _, _ in placed_blocks(parse(page))} if page else ()
            if texts:
                content = text_key(max(texts, key=lambda text: (len(text), text)))
                rows.append((host, content, None))
                rows += ((host, content, text_key(text)) for text in texts)
        if rows:
            hosts, contents, texts = zip(*rows, strict=True)
            # Not by way of floats, which have no room for the keys.
            yield pd.DataFrame({"host": hosts, "content": contents, "text": pd.array(texts, dtype="Int64")})


def shared_texts(pages: DataFrame) -> DataFrame:
    """``host`` and the keys of ``texts`` on pages of most of its different contents.

    Of a host with under ``LEAST_PAGES`` contents there are none. A page has no more texts
    than blocks and each text is on most contents, so there are at most twice as many of
    them as blocks on a page, and the array is bounded by the pages' size.
    """
    rows = pages.select(F.xxhash64("host").alias("host"), "page")
    found = rows.mapInPandas(_page_texts, "host long, content long, text long").distinct()
    counts = checkpointed(
        found.groupBy("host", "text").agg(F.count(F.lit(1)).alias("n")).filter("n > 2 OR text IS NULL")
    )
    totals = counts.filter("text IS NULL").select("host", F.col("n").alias("total"))
    most = (F.col("n") > SHARED * F.col("total")) & (F.col("total") >= LEAST_PAGES)
    shared = counts.filter("text IS NOT NULL").join(totals, "host").filter(most)
    return shared.groupBy("host").agg(F.sort_array(F.collect_list("text")).alias("texts"))


def _host_trees(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Merge the pages of a task host by host."""
    held: dict[str, list] = {}
    for batch in batches:
        for host, page, texts in zip(batch["host"], batch["page"], batch["texts"], strict=True):
            if not page:
                continue
            tree = page_tree([parse(page)], set() if texts is None else set(texts.tolist()))
            held[host] = merge(held[host], tree) if host in held else tree
            if len(held) >= HELD_TREES:
                yield _tree_rows(held)
                held = {}
    if held:
        yield _tree_rows(held)


def _tree_rows(held: dict[str, list]) -> pd.DataFrame:
    trees = [json.dumps(tree) for tree in held.values()]
    return pd.DataFrame({"host": list(held), "tree": trees})


def _merge_sorted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Merge trees that come sorted by host and part, one group at a time."""
    key, tree = None, None
    for batch in batches:
        rows = []
        for host, part, text in zip(batch["host"], batch["part"], batch["tree"], strict=True):
            if (host, part) == key:
                tree = merge(tree, json.loads(text))
            else:
                if key:
                    rows.append((key[0], json.dumps(tree)))
                key, tree = (host, part), json.loads(text)
        if rows:
            yield pd.DataFrame(rows, columns=["host", "tree"])
    if key:
        yield pd.DataFrame([(key[0], json.dumps(tree))], columns=["host", "tree"])


def _merged(trees: DataFrame, parts: int) -> DataFrame:
    part = F.pmod(F.xxhash64("tree"), F.lit(parts)).alias("part")
    sorted_trees = (
        trees.select("host", "tree", part)
        .repartition("host", "part")
        .sortWithinPartitions("host", "part", "tree")
    )
    return sorted_trees.mapInPandas(_merge_sorted, "host string, tree string")


def host_wrappers(pages: DataFrame) -> DataFrame:
    """``host`` and its ``rule``, from ``host`` and ``page``; one row for each host."""
    shared = small(shared_texts(pages).withColumnRenamed("host", "of"), BROADCAST_HOSTS)
    known = pages.join(shared, F.xxhash64("host") == F.col("of"), "left").select("host", "page", "texts")
    trees = known.mapInPandas(_host_trees, "host string, tree string")
    trees = _merged(checkpointed(_merged(trees, PARTS)), 1)

    @F.pandas_udf("string")
    def rules(texts: pd.Series) -> pd.Series:
        found = [json.dumps(wrapper(json.loads(text))) for text in texts]
        return pd.Series(found, index=texts.index, dtype=object)

    return trees.select("host", rules("tree").alias("rule"))


def extract_main_text(pages: DataFrame, page: str = "html", url: str = "url") -> DataFrame:
    """Every row of ``pages`` with ``text`` and ``n_chars``.

    Null and empty pages, and those without text, have an empty text. Pages without a host
    are taken as one host's. Repeated pages get equal texts. An empty table stays empty.
    """
    pages = pages.drop("text", "n_chars")
    host, raw, of, wanted = (unused(name, pages) for name in ("_host", "_url", "_of", "_rule"))
    rows = pages.withColumn(raw, F.col(url))
    rows = rows.withColumn(host, url_parts(F.col(raw))[0]).drop(raw)
    rules = host_wrappers(rows.select(F.col(host).alias("host"), F.col(page).alias("page")))
    rules = small(rules.select(F.col("host").alias(of), F.col("rule").alias(wanted)), BROADCAST_HOSTS)

    @F.pandas_udf("string")
    def text_of(texts: pd.Series, rules_of: pd.Series) -> pd.Series:
        known: dict[str, list] = {}

        def extract(text: str | None, rule: str | None) -> str:
            if rule is not None and rule not in known:
                known[rule] = json.loads(rule)
            return main_text(text, known.get(rule))

        found = [extract(*both) for both in zip(texts, rules_of, strict=True)]
        return pd.Series(found, index=texts.index, dtype=object)

    joined = rows.join(rules, F.col(host) == F.col(of), "left")
    return (
        joined.withColumn("text", text_of(page, wanted))
        .withColumn("n_chars", F.length("text").cast("long"))
        .drop(host, of, wanted)
    )


def op1_wrapper_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return extract_main_text(pages).select("page_id", "url", "text", "n_chars")
