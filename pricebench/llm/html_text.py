"""Main text of web pages by composite text density.

A page becomes a small tree. Elements that are never part of an article (scripts, menus, forms, reader
comments and the like) are left out of it. For every node the composite density is its characters per
tag, corrected by how many of both belong to links; the densities of a node's children sum up to its
density sum. The node with the largest sum is where the text is, and the lowest density on the path from
the body to it is the threshold that its siblings have to reach to be taken in as well.
"""

import html
import math
import re

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Element names of HTML by what they mean for text, and names that mark what is no article.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title iframe xmp noembed noframes".split())
DROPPED = frozenset(
    "head script style noscript template iframe object embed applet svg math canvas audio video map "
    "nav aside footer form button select textarea input label fieldset dialog menu noembed noframes xmp".split()
)
BLOCKS = frozenset(
    "address article aside blockquote body br caption center dd details dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre section "
    "summary table tbody td tfoot th thead tr ul".split()
)
CLOSES = {
    "li": ("li", frozenset("ul ol menu dir".split())),
    "dt": ("dt dd", frozenset(["dl"])),
    "dd": ("dt dd", frozenset(["dl"])),
    "tr": ("tr td th", frozenset(["table"])),
    "td": ("td th", frozenset("tr table".split())),
    "th": ("td th", frozenset("tr table".split())),
    "option": ("option", frozenset(["select"])),
}
ENDS_PARAGRAPH = BLOCKS - frozenset("br body html caption option optgroup td th tr tbody thead tfoot legend".split())
BARRIERS = frozenset("td th table caption button object html".split())
MARKED = frozenset(
    "nav navbar navigation menu menubar submenu breadcrumb breadcrumbs footer foot colophon sidebar rail widget widgets ad ads "
    "adv advert adverts advertisement advertising adsense banner sponsor sponsored promo promotion cookie cookies "
    "consent gdpr notice notices notification alert popup modal overlay newsletter subscribe subscription signup "
    "social share sharing sharebar related recommended recommendations comment comments commentlist disqus replies "
    "respond discussion search searchbox login toolbar pagination pager skip copyright disclaimer".split()
)
MARKED_OUTSIDE = frozenset("header masthead topbar".split())  # in an article these hold its title
STATES = frozenset("has with no without is not js".split())  # "has-sidebar" says what a wrapper holds
ROLES = frozenset(
    "navigation banner contentinfo complementary search dialog alert alertdialog form menu menubar toolbar".split()
)
MARKUP = re.compile(
    r"<!--(?:>|->|.*?--!?>|.*\Z)"
    r"|<(/?)([A-Za-z][^\s/>]*)([^>\"']*(?:(?:\"[^\"]*\"|'[^']*')[^>\"']*)*)>"
    r"|<(/?)([A-Za-z][^\s/>]*)([^>]*)(?:>|\Z)"
    r"|<[!?/][^>]*(?:>|\Z)",
    re.S,
)
MARKS = re.compile(r"""(class|id|role|style|hidden|aria-hidden)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)
PARTS = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+")


class Node:
    __slots__ = ("name", "parent", "parts", "dropped", "chars", "linked", "tags", "links", "density", "total", "inside")

    def __init__(self, name: str, parent: "Node | None"):
        self.name, self.parent, self.parts = name, parent, []
        self.dropped = False
        self.inside = parent is not None and (parent.inside or parent.name in ("article", "main"))


def _marked(name: str, attributes: str, inside: bool) -> bool:
    """Does the element say of itself that it is no article text?"""
    if name in DROPPED or name == "header" and not inside:
        return True
    if name in ("html", "body", "article", "main") or not attributes.strip():
        return False
    for key, value in MARKS.findall(attributes):
        key, value = key.lower(), value.strip("\"'")
        if key == "hidden" or key == "aria-hidden" and value.lower() == "true":
            return True
        if key == "role" and value.lower() in ROLES:
            return True
        if key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
            return True
        if key in ("class", "id"):
            for token in value.split():
                words = [w.lower() for w in PARTS.findall(token)]
                if words and words[0] in STATES:
                    continue
                if not MARKED.isdisjoint(words) or not inside and not MARKED_OUTSIDE.isdisjoint(words):
                    return True
    return False


def parse(page: str) -> Node:
    """The tree of a page; unclosed and stray tags are handled as browsers do in the common cases."""
    root = at = Node("html", None)
    position = 0
    for found in iter(lambda: MARKUP.search(page, position), None):
        if found.start() > position:
            at.parts.append(page[position : found.start()])
        position = found.end()
        name = (found[2] or found[5] or "").lower()
        if not name:
            continue
        if found[1] or found[4]:
            at = _closed(at, name)
            continue
        attributes = found[3] or found[6] or ""
        at = _make_room(at, name)
        if name in ("html", "body") and at is root:
            at = root if name == "html" else _child(root, "body")
            continue
        node = _child(at, name)
        node.dropped = _marked(name, attributes, node.inside)
        if name in RAW:
            end = re.compile(rf"</{name}[\s/>]", re.I).search(page, position)
            node.parts.append(page[position : end.start() if end else len(page)])
            position = len(page) if not end else (page.find(">", end.start()) + 1 or len(page))
        elif name not in VOID:
            at = node
    if position < len(page):
        at.parts.append(page[position:])
    return root


def _child(parent: Node, name: str) -> Node:
    node = Node(name, parent)
    parent.parts.append(node)
    return node


def _make_room(at: Node, name: str) -> Node:
    """Close what a start tag closes without saying so."""
    if name in ENDS_PARAGRAPH:
        above = at
        while above is not None and above.name not in BARRIERS:
            if above.name == "p":
                return above.parent
            above = above.parent
    if name in CLOSES:
        ended, border = CLOSES[name]
        above = at
        while above is not None and above.name not in border:
            if above.name in ended.split():
                at = above.parent
            above = above.parent
    return at


def _closed(at: Node, name: str) -> Node:
    above = at
    while above is not None:
        if above.name == name:
            return above.parent or above
        if name not in BLOCKS and above.name in BLOCKS:
            break  # an inline end tag does not close blocks
        above = above.parent
    return at


def in_order(root: Node) -> list[Node]:
    """All nodes, parents before children, without recursion."""
    found, todo = [], [root]
    while todo:
        node = todo.pop()
        found.append(node)
        todo.extend(p for p in reversed(node.parts) if isinstance(p, Node))
    return found


def prune(root: Node) -> None:
    """Take out what is marked, unless it wraps the article itself."""
    nodes = in_order(root)
    holds = set()
    for node in nodes:
        if node.name in ("article", "main", "h1"):
            above = node.parent
            while above is not None and id(above) not in holds:
                holds.add(id(above))
                above = above.parent
    for node in nodes:
        removable = ("nav", "footer", "aside", "header", "script", "style", "head")
        node.parts = [
            p
            for p in node.parts
            if not (isinstance(p, Node) and p.dropped and (id(p) not in holds or p.name in removable))
        ]


def weigh(nodes: list[Node]) -> None:
    """Characters, tags and their link shares, then composite density and density sum of each node."""
    for node in reversed(nodes):
        own = sum(len("".join(p.split())) for p in node.parts if isinstance(p, str))
        below = [p for p in node.parts if isinstance(p, Node)]
        node.chars = own + sum(p.chars for p in below)
        node.tags = len(below) + sum(p.tags for p in below)
        if node.name == "a":
            node.linked, node.links = node.chars, node.tags + 1
        else:
            node.linked = sum(p.linked for p in below)
            node.links = sum(p.links for p in below)
    whole = nodes[0]
    page_share = whole.linked / max(whole.chars, 1)
    for node in reversed(nodes):
        chars, tags = node.chars, max(node.tags, 1)
        if not chars:
            node.density = node.total = 0.0
            continue
        base = math.log(chars / max(chars - node.linked, 1) * node.linked + page_share * chars + math.e)
        ratio = chars / max(node.linked, 1) * tags / max(node.links, 1)
        node.density = chars / tags * max(math.log(ratio), 0.0) / base if ratio > 1 else 0.0
        below = [p for p in node.parts if isinstance(p, Node)]
        text = sum(len("".join(p.split())) for p in node.parts if isinstance(p, str))
        node.total = sum(p.density for p in below) + text  # its own text counts as one more leaf


def chosen(root: Node) -> list[Node]:
    """The subtrees that make up the main text, in page order."""
    nodes = in_order(root)
    weigh(nodes)
    best = max(nodes, key=lambda n: n.total)
    if not best.chars:
        return []
    path = [best]
    while path[-1].parent is not None and path[-1].name != "body":
        path.append(path[-1].parent)
    threshold = min(n.density for n in path)
    kept = [best]
    for node in path[1:]:
        others = [p for p in node.parts if isinstance(p, Node) and p not in path]
        kept += [p for p in others if p.chars and (p.density >= threshold and p.linked * 3 < p.chars or p.name == "h1")]
    # A correction: if the best subtree is a part of an article, the whole outermost one is taken.
    around = [n for n in path if n.name in ("article", "main")]
    if around:
        inside = {id(n) for n in in_order(around[-1])}
        kept = [around[-1], *[n for n in kept if id(n) not in inside]]
    ranks = {id(n): i for i, n in enumerate(nodes)}
    return sorted(kept, key=lambda n: ranks[id(n)])


def blocks(root: Node) -> list[str]:
    """The text of each block below a node, entities decoded, white space as single spaces."""
    found: list[str] = []
    open_text: list[str] = []

    def flush() -> None:
        text = " ".join(html.unescape("".join(open_text)).split())
        open_text.clear()
        if text:
            found.append(text)

    todo: list = [root]
    while todo:
        part = todo.pop()
        if part is None:
            flush()
        elif isinstance(part, str):
            open_text.append(part)
        else:
            if part.name in BLOCKS:
                flush()
                todo.append(None)
            todo.extend(reversed(part.parts))
    flush()
    return found


def main_text(page: str | None) -> str:
    """The article of a page; empty for null, empty and textless pages."""
    root = parse(page or "")
    prune(root)
    return " ".join(text for node in chosen(root) for text in blocks(node))


def extract_pages(pages: DataFrame) -> DataFrame:
    """One row per row of ``pages`` (page_id, url, html): the main text and its length in characters.

    Null and empty pages and pages without text give an empty text. Repeated rows are extracted each for
    themselves; an empty table gives no rows. Other columns are not read.
    """

    @F.pandas_udf("string")
    def extracted(found: pd.Series) -> pd.Series:
        return pd.Series([main_text(h) for h in found], dtype="object")

    texts = pages.select("page_id", "url", extracted("html").alias("text"))
    return texts.withColumn("n_chars", F.length("text").cast("bigint"))
