"""A small tolerant HTML parser: blocks of text in a tree of block elements.

Pages may be nested to any depth: nothing here calls itself, and what lies below
``MOST_LEVELS`` is kept as blocks of the last level's nodes.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from dataclasses import dataclass, field

# Fixed values of the markup language.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby "
    "s samp small span strike strong sub sup time tt u var wbr "
    "math maction menclose merror mfenced mfrac mi mmultiscripts mn mo mover mpadded mphantom mprescripts mroot "
    "mrow ms mspace msqrt mstyle msub msubsup msup mtable mtd mtext mtr munder munderover none semantics".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# Anything else ends an open head, whose end tag may be left out.
IN_HEAD = frozenset("base link meta noscript script style template title".split())
RAW = frozenset("annotation annotation-xml iframe noscript script style template textarea title".split())
HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))
# Elements that end an open paragraph; any block does, so this is all blocks.
REPEATED = {
    "li": ("ul", "ol", "menu"),
    "dt": ("dl",),
    "dd": ("dl",),
    "tr": ("table", "tbody", "thead", "tfoot"),
    "td": ("tr",),
    "th": ("tr",),
    "option": ("select",),
}
ALSO_ENDS = {"dt": ("dd",), "dd": ("dt",), "td": ("th",), "th": ("td",)}
# What is never an article's text: by element, by role, and by words of class or id.
ASIDE = frozenset(
    "annotation annotation-xml aside audio button canvas dialog fieldset footer form head iframe input menu nav noscript "
    "object script select style svg template textarea title video".split()
)
ASIDE_ROLES = frozenset(
    "alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search toolbar".split()
)
ASIDE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising aside banner breadcrumb breadcrumbs comment comments "
    "consent cookie cookies disqus dropdown footer gdpr login masthead menu menus modal nav navbar "
    "navigation newsletter notice notices notification overlay pager pagination popup promo promotion "
    "recommended related replies reply share sharing sidebar signup skip social sponsor sponsored "
    "subscribe toolbar widget".split()
)
# Inside an article a name counts only if all of it says so: listed words, and these for parts of a page.
PART_WORDS = frozenset(
    "area article bar block bottom box button buttons container content entry footer form header inner item items "
    "left line links list main outer page panel post reader right row section site thread title top user wrap "
    "wrapper".split()
)
# These words and elements mark a page's head, or an article's own.
HEADER_WORDS = frozenset(("header",))
# Begins the signature of a node that is an aside unless it holds the host's text.
WEAK = "~"

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(?:[!?][^>]*)(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^<>\"']++|\"[^\"]*\"|'[^']*')*+|[^<>]*)>",
    re.DOTALL,
)
_CLASS = re.compile(r"(?:^|\s)(class|id|role|hidden)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")

# Levels of a page's tree that are told apart.
MOST_LEVELS = 100


@dataclass
class Node:
    tag: str
    label: str = ""
    aside: bool = False
    # An aside by a word or as a form only, which may as well be wrapped round the content.
    weak: bool = False
    in_article: bool = False
    children: list[Node] = field(default_factory=list)
    # Own blocks of text: their place in the page and the text.
    blocks: list[tuple[int, str]] = field(default_factory=list)

    @property
    def signature(self) -> str:
        name = f"{self.tag}.{self.label}" if self.label else self.tag
        return WEAK + name if self.weak else name


def _names_aside(names: list[list[str]], in_article: bool) -> bool:
    """Whether the words of the names of an element mark it as an aside."""
    if in_article:
        return any(
            not ASIDE_WORDS.isdisjoint(words) and all(w in ASIDE_WORDS or w in PART_WORDS or w.isdigit() for w in words)
            for words in names
        )
    return any(not ASIDE_WORDS.isdisjoint(words) or not HEADER_WORDS.isdisjoint(words) for words in names)


def _element(tag: str, attributes: str, parent: Node) -> Node:
    names: list[list[str]] = []
    label, roles, hidden = "", (), False
    if attributes:
        for name, *values in _CLASS.findall(attributes):
            value = next((v for v in values if v), "")
            kind = name.lower()
            if kind == "role":
                roles = value.lower().split()
            elif kind == "hidden":
                hidden = True
            else:
                # The id of a heading or paragraph is an anchor made of what it says.
                if kind == "class" or tag not in HEADINGS and tag != "p":
                    names += ([word.lower() for word in _WORD.findall(name)] for name in value.split())
                if kind == "class" and value.strip():
                    label = re.sub(r"\d+", "", value.split()[0].lower())
    in_article = parent.in_article or tag in ("article", "main") or "main" in roles
    aside = (
        hidden
        or (tag in ASIDE and tag != "form")
        or (tag == "header" and not in_article)
        or not ASIDE_ROLES.isdisjoint(roles)
    )
    named = bool(names) and _names_aside(names, in_article)
    weak = tag == "form" or (named and tag not in ("html", "body", "article", "main"))
    return Node(tag, label, aside, weak and not aside, in_article)


def _clear_wrappers(root: Node) -> None:
    """What holds a main element, or all articles of the page, is no aside by its name."""
    nodes = [root]
    for node in nodes:
        nodes += node.children
    if not any(node.weak for node in nodes):
        return
    mains, articles = {}, {}
    for node in reversed(nodes):
        mains[id(node)] = (node.tag == "main") + sum(mains[id(child)] for child in node.children)
        articles[id(node)] = (node.tag == "article") + sum(articles[id(child)] for child in node.children)
    for node in nodes:
        if mains[id(node)] or 0 < articles[id(node)] == articles[id(root)]:
            node.weak = False


def _fold(root: Node) -> None:
    """Give the nodes of the last level that is told apart all blocks below them."""
    level = [root]
    for _ in range(MOST_LEVELS):
        level = [child for node in level for child in node.children]
        if not level:
            return
    for node in level:
        node.blocks = blocks_below([node])
        node.children = []


def parse(text: str) -> Node:
    """The tree of a page. Character references are decoded and each run of white space in a
    block becomes one space; unfinished tags at the end are dropped."""
    root = Node("#page")
    stack = [root]
    held: list[str] = []
    links: list[bool] = []
    in_link = 0
    order = 0
    linked_lists: dict[int, list[int]] = {}
    open_tags: Counter[str] = Counter()
    open_lists: list[Node] = []

    def flush() -> None:
        nonlocal order
        if held:
            words = html.unescape("".join(held)).split()
            held.clear()
            if words:
                stack[-1].blocks.append((order, " ".join(words)))
                order += 1
                only_links = bool(links) and all(links)
                for node in open_lists:
                    counts = linked_lists.setdefault(id(node), [0, 0])
                    counts[0] += 1
                    counts[1] += only_links
            links.clear()

    def close(node: Node) -> None:
        open_tags[node.tag] -= 1
        if open_lists and open_lists[-1] is node:
            open_lists.pop()
        counts = linked_lists.get(id(node))
        # A list of links only is a menu, whatever it is called.
        if counts and counts[0] >= 3 and counts[0] == counts[1] and not node.in_article:
            node.aside = True

    def pop_to(depth: int) -> None:
        flush()
        while len(stack) > depth:
            close(stack.pop())

    at = 0
    while at < len(text):
        match = _TOKEN.search(text, at)
        plain = text[at : match.start()] if match else text[at:]
        if not match:
            cut = re.search(r"<[a-zA-Z/!?][^>]*\Z", plain)
            plain = plain[: cut.start()] if cut else plain
        if plain:
            if stack[-1].tag == "head" and not plain.isspace():
                pop_to(len(stack) - 1)
            held.append(plain)
            if not plain.isspace():
                links.append(in_link > 0)
        if not match:
            break
        at = match.end()
        closing, tag, attributes = match.group(1), (match.group(2) or "").lower(), match.group(3)
        if not tag:
            continue
        if tag in INLINE:
            if tag == "a":
                in_link = 0 if closing else 1
            elif tag == "br":
                held.append(" ")
            continue
        if closing:
            if open_tags[tag]:
                pop_to(next(i for i in range(len(stack) - 1, 0, -1) if stack[i].tag == tag))
            else:
                flush()
            in_link = 0
            continue
        flush()
        if stack[-1].tag == "p":
            pop_to(len(stack) - 1)
        if tag in REPEATED:
            ends = (tag, *ALSO_ENDS.get(tag, ()))
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag in ends:
                    pop_to(i)
                    break
                if stack[i].tag in REPEATED[tag]:
                    break
        if open_tags["head"] and tag not in IN_HEAD:
            heads = (i for i, open_one in enumerate(stack) if open_one.tag == "head")
            pop_to(next(heads, len(stack)))
        node = _element(tag, attributes, stack[-1])
        stack[-1].children.append(node)
        if tag in RAW:
            end = re.compile(rf"</{tag}(?=[\s/>])", re.I).search(text, at)
            at = text.find(">", end.end()) + 1 if end else len(text)
            at = at or len(text)
        elif tag not in VOID and not attributes.endswith("/"):
            stack.append(node)
            open_tags[tag] += 1
            if tag in ("ul", "ol"):
                open_lists.append(node)
    pop_to(1)
    flush()
    _clear_wrappers(root)
    _fold(root)
    return root


def blocks_below(nodes: list[Node]) -> list[tuple[int, str]]:
    """All blocks of text below some nodes that are no asides, in page order."""
    found, left = [], list(nodes)
    while left:
        node = left.pop()
        if not node.aside:
            found += node.blocks
            left += node.children
    return sorted(found)
