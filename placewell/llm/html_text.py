"""Main text of a page by tree scoring.

Paragraphs pass points for length and commas to their ancestors, fewer with each level;
a container's points are discounted by the share of its text that lies in links. The
best container is kept with those of its siblings that read like text.

Elements that never hold an article are left out by their kind. A class or id that
speaks of something else counts against an element, but does not decide: what holds an
article element or most of the page's points stays. Articles inside an article are
comments if that has a text of its own.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placewell.llm.workers import lean

MARKUP = re.compile(
    r"<!--.*?(?:--!?>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*+)(?:>|\Z)|<[!?/][^>]*+(?:>|\Z)", re.S)
ATTRIBUTE = re.compile(
    r"(class|id|role|style|hidden|aria-hidden)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?(?=[\s/>]|\Z)", re.I)

# Element names.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
DROPPED = frozenset("""script style noscript template textarea title xmp iframe noembed noframes svg canvas
    math head nav header footer aside form button select object audio video map menu dialog""".split())
BLOCKS = frozenset("""html body main article section div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd blockquote pre
    table thead tbody tfoot tr td th caption figure figcaption address details summary hgroup center
    fieldset nav header footer aside form hr menu dialog search""".split())
PARAGRAPHS = frozenset("p li dd td th pre blockquote div section article main body html figcaption".split())
NEVER_BY_NAME = frozenset("html body main".split())
BOILERPLATE = frozenset("""nav navbar navigation menu sidebar footer header masthead breadcrumb breadcrumbs ad ads
    advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent notice
    popup modal overlay newsletter subscribe subscription signup share sharing social related recommended
    recommendations pagination pager skip login toolbar copyright legal disclaimer alert widget""".split())
REMARKS = frozenset("comment comments discussion disqus replies reply respond".split())
ROLES = frozenset("""navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar
    toolbar""".split())
# An open element that a starting one closes, and where the search for it stops.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"thead", "tbody", "tr"}, {"table"}), "tfoot": ({"thead", "tbody", "tr"}, {"table"}),
    "option": ({"option"}, {"select"}),
}
SCOPES = frozenset("table td th caption html button object".split())
SCOPED = frozenset("p li b i a span em strong".split())  # their end tags do not reach beyond a scope
MOST = 0.5  # of the page's points: what holds so many is no boilerplate, whatever its name
LEVELS = 40  # that points are passed up; beyond them a share is nothing
KEPT, NAMED, REMARK, DROPPED_BY_KIND = range(4)


class Node:
    """``closes``: the outermost open element that a starting one of each kind closes here."""

    __slots__ = ("name", "up", "parts", "points", "size", "linked", "dropped", "doubt", "open_p", "closes", "inside",
                 "articles")

    def __init__(self, name: str, up: Node | None, doubt: int) -> None:
        self.name, self.up, self.doubt = name, up, doubt
        self.dropped = doubt == DROPPED_BY_KIND or up is not None and up.dropped
        self.parts: list = []
        self.points = 0.0
        self.size = self.linked = self.articles = 0
        self.open_p = self if name == "p" else None if up is None or name in SCOPES else up.open_p
        self.inside = (up.inside if up is not None else frozenset()) | (
            {name} if up is not None and name in ("html", "body") else frozenset())
        self.closes = up.closes if up is not None else {}
        if name in CLOSING:
            self.closes = dict(self.closes)
            for kind, (closed, stop) in CLOSES.items():
                if name in stop:
                    self.closes[kind] = None
                elif name in closed and self.closes.get(kind) is None:
                    self.closes[kind] = self


CLOSING = frozenset(n for closed, stop in CLOSES.values() for n in closed | stop)


def doubt(name: str, attributes: str) -> int:
    """What speaks against an element: its kind, or only a name it was given."""
    if name in DROPPED:
        return DROPPED_BY_KIND
    if not attributes or name in NEVER_BY_NAME:
        return KEPT
    most = KEPT
    for found in ATTRIBUTE.finditer(attributes):
        kind = found[1].lower()
        value = (found[2] or found[3] or found[4] or "").lower()
        if kind == "hidden" or kind == "aria-hidden" and value == "true":
            return DROPPED_BY_KIND
        if kind == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
            return DROPPED_BY_KIND
        if kind == "role" and value.strip() in ROLES:
            return DROPPED_BY_KIND
        if kind in ("class", "id"):
            for label in value.split():
                words = re.split(r"[-_:]+", label)
                if words[0] in ("has", "with", "no", "without"):
                    continue
                for names, level in ((REMARKS, REMARK), (BOILERPLATE, NAMED)):
                    if words[0] in names or words[-1] in names:
                        most = max(most, level)
    return most


class Builder:
    """The open elements of a page while it is read."""

    def __init__(self) -> None:
        self.root = self.top = Node("html", None, KEPT)
        self.all: Counter = Counter()  # open names
        self.scopes: list[Counter] = [Counter()]  # and those since each open scope began

    def start(self, name: str, attributes: str) -> None:
        node = Node(name, self.top, doubt(name, attributes))
        self.top.parts.append(node)
        self.top = node
        self.all[name] += 1
        if name in SCOPES:
            self.scopes.append(Counter())
        self.scopes[-1][name] += 1

    def close(self, node: Node) -> None:
        """Close the element and all that are open in it."""
        while True:
            last = self.top
            self.all[last.name] -= 1
            self.scopes[-1][last.name] -= 1
            if last.name in SCOPES:
                self.scopes.pop()
            self.top = last.up
            if last is node:
                return

    def end(self, name: str) -> None:
        if (self.scopes[-1] if name in SCOPED else self.all)[name] > 0:
            node = self.top
            while node.name != name:
                node = node.up
            self.close(node)


def parse(source: str) -> Node:
    """The tree of a page; markup that is left open ends with its container."""
    tree = Builder()
    at, raw = 0, None
    end = len(source)
    while at < end:
        if raw is not None:  # text up to the end tag, whatever it holds
            found = raw_end(raw).search(source, at)
            at, raw = (found.end() if found else end), None
            tree.close(tree.top)
            continue
        found = MARKUP.search(source, at)
        if found is None or found.start() > at:
            text = source[at:found.start() if found else end]
            tree.top.parts.append(html.unescape(text) if "&" in text else text)
        if found is None:
            break
        at = found.end()
        name = found[2] or found[5]
        if not name or not found[0].endswith(">"):
            continue
        name = name.lower()
        if found[1] or found[4]:
            tree.end(name)
            continue
        if name in tree.top.inside:
            continue
        if name in BLOCKS and tree.top.open_p is not None:
            tree.close(tree.top.open_p)
        if name in CLOSES and tree.top.closes.get(name) is not None:
            tree.close(tree.top.closes[name])
        if name in VOID:
            tree.top.parts.append(Node(name, tree.top, KEPT))
            continue
        attributes = found[3] or found[6] or ""
        tree.start(name, attributes)
        if name in RAW:
            raw = name
        elif attributes.endswith("/") and name not in BLOCKS:
            tree.close(tree.top)
    return tree.root


@lru_cache(maxsize=32)
def raw_end(name: str) -> re.Pattern:
    return re.compile(rf"</{re.escape(name)}(?=[\s/>])[^>]*>?", re.I)


def path(node: Node | None) -> Iterator[Node]:
    while node is not None and node.up is not None:
        yield node
        node = node.up


def paragraph_points(node: Node) -> float:
    text = direct_text(node) if node.name in PARAGRAPHS else ""
    return (1 + sum(text.count(c) for c in ",،、，") + min(len(text) / 100, 3.0)) * (1 - density(node)) if text else 0.0


def prune(root: Node) -> None:
    """Drop what its name and its place in the page say is no part of the article."""
    nodes = measured(root)
    # Points of all paragraphs inside each node, whole; articles inside each node.
    whole = {id(n): paragraph_points(n) for n in nodes}
    for node in reversed(nodes):
        if node.up is not None:
            whole[id(node.up)] += whole[id(node)]
            node.up.articles += node.articles + (node.name in ("article", "main"))
    first = next((n for n in nodes if n.name in ("article", "main")), None)
    opening = {id(n) for n in path(first)} if first else set()
    total = whole[id(root)]
    gone = sum(whole[id(n)] for n in nodes if n.doubt == REMARK and id(n) not in opening)
    least = MOST * max(total - gone, 0.0)
    for node in nodes:
        if node.doubt == REMARK:
            node.dropped = id(node) not in opening and (first is not None or whole[id(node)] < MOST * total)
        elif node.doubt == NAMED and node.name != "article":
            node.dropped = not node.articles and whole[id(node)] < least
    remarks_in_articles(nodes, whole)
    for node in nodes:  # from the top down
        node.dropped = node.dropped or node.up is not None and node.up.dropped
        node.size = node.linked = 0


def remarks_in_articles(nodes: list[Node], whole: dict[int, float]) -> None:
    """Articles in an article that has a longer text of its own, and what only holds such."""
    outer: dict[int, Node | None] = {}
    inner: dict[int, list[Node]] = {}
    for node in nodes:
        above = outer.get(id(node.up)) if node.up is not None else None
        if node.name == "article" and above is not None:
            inner.setdefault(id(above), []).append(node)
        outer[id(node)] = node if node.name == "article" and above is None else above
    lost: dict[int, float] = {}
    for node in nodes:
        found = inner.get(id(node), [])
        if found and whole[id(node)] - sum(whole[id(n)] for n in found) >= max(whole[id(n)] for n in found):
            for n in found:
                n.dropped = True
                for above in path(n.up):
                    if above is node:
                        break
                    lost[id(above)] = lost.get(id(above), 0.0) + whole[id(n)]
    for node in nodes:
        if lost.get(id(node), 0.0) > 0.7 * whole[id(node)]:
            node.dropped = True


def walk(root: Node) -> Iterator[Node]:
    """Nodes in page order, dropped ones left out."""
    waiting = [root]
    while waiting:
        node = waiting.pop()
        yield node
        waiting.extend(p for p in reversed(node.parts) if isinstance(p, Node) and not p.dropped)


def measured(root: Node) -> list[Node]:
    """The nodes in page order, with their text sizes and link sizes."""
    nodes = list(walk(root))
    for node in reversed(nodes):
        own = " ".join(p for p in node.parts if isinstance(p, str)).split()
        node.size += sum(map(len, own)) + max(len(own) - 1, 0)
        if node.name == "a":
            node.linked = node.size
        if node.up is not None:
            node.up.size += node.size
            node.up.linked += node.linked
    return nodes


def score(root: Node) -> list[Node]:
    """Points of all nodes; the nodes in page order."""
    nodes = measured(root)
    for node in nodes:
        points = paragraph_points(node)
        if not points:
            continue
        share = 1.0
        above = node.up if node.name not in ("body", "html", "main", "article") else node
        for _ in range(LEVELS):
            if above is None:
                break
            above.points += points * share
            share /= 2
            above = above.up
    return nodes


def direct_text(node: Node) -> str:
    """Text of a node and its inline elements, without that of blocks inside."""
    out, waiting = [], [node]
    while waiting:
        part = waiting.pop()
        if isinstance(part, str):
            out.append(part)
        elif part is node or not part.dropped and part.name not in BLOCKS:
            out.append(" " if part.name == "br" else "")
            waiting.extend(reversed(part.parts))
    return " ".join("".join(out).split())


def density(node: Node) -> float:
    return node.linked / node.size if node.size else 0.0


def best_nodes(root: Node) -> list[Node]:
    """The best container and the siblings that are kept, in page order."""
    prune(root)
    nodes = score(root)
    best = max(nodes, key=lambda n: n.points * (1 - density(n)) + (5 if n.name in ("article", "main") and n.size else 0))
    if not best.size:
        return []
    for above in path(best):  # an article is kept whole
        if above.name == "article":
            best = above
    if best.up is None:
        return [best]
    least = max(10.0, 0.2 * best.points * (1 - density(best)))
    kept = []
    for part in best.up.parts:
        if not isinstance(part, Node) or part.dropped:
            continue
        text_like = part.name in ("p", "h1", "h2", "h3", "h4", "h5", "h6", "blockquote", "pre", "ul", "ol") and \
            best.name not in ("article", "main") and density(part) < 0.25 and part.size
        if part is best or part.points * (1 - density(part)) >= least or text_like or \
                part.name == "article" and best.name == "article" and part.size:
            kept.append(part)
    return kept


def blocks(nodes: list[Node]) -> Iterator[str]:
    """Texts of blocks in page order, white space folded."""
    held: list[str] = []
    waiting: list = []

    def close() -> str:
        text = " ".join("".join(held).split())
        held.clear()
        return text

    for node in reversed(nodes):
        waiting.append(node)
    while waiting:
        part = waiting.pop()
        if part is None:
            if text := close():
                yield text
        elif isinstance(part, str):
            held.append(part)
        elif part.dropped:
            continue
        elif part.name in BLOCKS:
            if text := close():
                yield text
            waiting.append(None)
            waiting.extend(reversed(part.parts))
        else:
            if part.name == "br":
                held.append(" ")
            waiting.extend(reversed(part.parts))
    if text := close():
        yield text


def main_text(source: str | None) -> str:
    """Blocks of the article, joined by newlines; empty if there is none."""
    return "\n".join(blocks(best_nodes(parse(source)))) if source else ""


def extract(
    pages: DataFrame, html_column: str = "html", text_column: str = "text"
) -> DataFrame:
    """``pages`` without the html, with the main text and its number of code points, ``n_chars``.

    Null, empty and text-free pages give an empty text. Pages cut off in the middle of a
    tag lose that tag only. Whole pages are read. Repeated rows stay. Columns of the names
    ``text`` and ``n_chars`` are replaced, all others are returned. No rows give no rows.
    """
    rest = [c for c in pages.columns if c not in (html_column, text_column, "n_chars")]
    source = pages.select(*[F.col(f"`{c.replace('`', '``')}`") for c in rest], F.col(html_column).alias("_html"))
    fields = [f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in source.schema if f.name != "_html"]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(x.as_py()) for x in batch.column("_html")]
            columns = [batch.column(c) for c in rest]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                [*rest, text_column, "n_chars"])

    return source.mapInArrow(lean(read), ", ".join([*fields, f"`{text_column}` string", "n_chars bigint"]))
