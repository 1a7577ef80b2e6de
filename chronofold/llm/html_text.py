"""Operator 7: main text of web pages by composite text density.

A page becomes a tree, without the elements that the HTML standard sets aside for menus, footers, sidebars, controls and
scripts. Every other node gets a density, its characters for each tag adjusted by the share of links, and the sum of its
children's densities. The node of the largest sum among those as dense as the path from the densest node to the body
holds the article. Article and main elements are further candidates, weighed by their plain text against that node.
Class names and ids are a prior: an element of such a name stays if its plain text outweighs that of the rest by far.
"""

from __future__ import annotations

import html
import math
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronofold.llm.common import map_slices, read_table

#: Fixed values of the HTML standard: elements without content, with raw text, and those that start a new block.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe noembed noframes xmp template".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup hr html legend li main menu nav ol p pre search section summary table tbody td tfoot th thead tr ul caption".split()
)
#: Starting one of these ends an open paragraph.
ENDS_P = BLOCK - frozenset("html body caption dd dt legend tbody td tfoot th thead tr".split()) | frozenset(("dd", "dt", "table"))
#: End tags that reach beyond a table cell, and the lists whose items don't end those of a list around them.
TABLES, LISTS = frozenset("table tr tbody thead tfoot".split()), frozenset("ul ol menu dir".split())
#: Elements that aren't article text.
DROPPED = frozenset("head script style noscript template iframe object embed svg math canvas audio video map nav footer aside button select option textarea input dialog menu search title".split())
#: Those that are none unless they hold most of the page's text.
FRAMES = frozenset(("form", "header"))
#: Words of names of boilerplate, and words that may stand beside them. A name counts if it has one of the former and no others.
MARKS = frozenset(
    "ad ads advert adverts advertisement advertising adbox adslot sponsor sponsored promo promotion banner sidebar nav navbar navigation menu menubar "
    "breadcrumb breadcrumbs footer header masthead cookie cookies consent notice notices popup modal newsletter subscribe subscription signup login "
    "share sharing social related recommended comment comments disqus respond pagination pager complementary contentinfo search skip".split()
)
BESIDE = frozenset("area bar block bottom box container content inner item left link links list main page primary right secondary section site slot top unit widget wrap wrapper".split())
WHOLE = frozenset(("article", "main"))
HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))
#: How many times the plain text of the rest a named element must have to stay; how much a candidate's own text counts for.
PRIOR, CANDIDATE = 3.0, 2.0
#: Links, and their share of the text, from which an element outside an article is a menu.
MENU_LINKS, MENU_SHARE = 3, 0.8

_OPEN = re.compile(r"<(?:!--(?:>|->|.*?(?:--!?>|\Z))|(/?)([a-zA-Z][^\s/>]*+)|(?:[!?]|/[^>])[^>]*+(?:>|\Z)|/>)", re.DOTALL)
#: The rest of a tag. As in the standard, quotes count after an equals sign only, and a tag without an end takes the rest of the page.
_REST = re.compile(r"((?:[^>=]++|=\s*+(?:\"[^\"]*+(?:\"|\Z)|'[^']*+(?:'|\Z))?+)*+)(>|\Z)", re.DOTALL)
_NAMES = re.compile(r"(?<![^\s\"'])(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.IGNORECASE)
_HIDDEN = re.compile(r"(?:^|\s)hidden(?=[\s=/]|$)")
_QUOTED = re.compile(r"\"[^\"]*\"|'[^']*'")
_WORD = re.compile(r"[A-Za-z][a-z]*|[A-Z]+|[0-9]+")


class Node:
    """An element. p, item, term, cell and row are the open elements that a new one of their kind ends; open counts the
    open elements of each tag inside the same table cell."""

    __slots__ = ("tag", "parent", "children", "dropped", "inside", "named", "chars", "links", "tags", "link_tags", "density", "total", "p", "item", "term", "cell", "row", "open")

    def __init__(self, tag: str, parent: Node | None, dropped: bool = False, named: bool = False) -> None:
        self.tag, self.parent, self.dropped, self.named = tag, parent, dropped, named
        self.children: list[Node | str] = []
        self.chars = self.links = self.tags = self.link_tags = 0
        self.density = self.total = 0.0
        above = parent or self
        self.inside = parent is not None and (parent.inside or tag in WHOLE)
        if parent is None:
            self.p = self.item = self.term = self.cell = self.row = None
        else:
            self.p = self if tag == "p" else None if tag in BLOCK else above.p
            self.item = self if tag == "li" else None if tag in LISTS or tag == "table" else above.item
            self.term = self if tag in ("dt", "dd") else None if tag in ("dl", "table") else above.term
            self.cell = self if tag in ("td", "th") else None if tag in ("tr", "table") else above.cell
            self.row = self if tag == "tr" else None if tag == "table" else above.row
        self.open: dict[str, int] = {} if parent is None or parent.tag in ("td", "th", "table") else parent.open

    @property
    def plain(self) -> int:
        return self.chars - self.links


def is_boilerplate(tag: str, attributes: str) -> bool:
    """Whether an element is never article text."""
    return tag in DROPPED or "hidden" in attributes and _HIDDEN.search(_QUOTED.sub("", attributes)) is not None


def is_named(tag: str, attributes: str, inside: bool) -> bool:
    """Whether names speak of boilerplate. Ids of headings and inside articles are those of links to them."""
    if tag in ("html", "body") or tag in WHOLE or "=" not in attributes:
        return False
    for name, *values in _NAMES.findall(attributes):
        if name.lower() == "id" and (inside or tag in HEADINGS):
            continue
        for part in "".join(values).split():
            words = {w.lower() for w in _WORD.findall(part)}
            if words & MARKS and words <= MARKS | BESIDE:
                return True
    return False


def parse(page: str) -> Node:
    """The tree, with implied ends of paragraphs, items and cells; end tags that match nothing are ignored.

    Time is linear: each character is read once, and each element is opened and closed once.
    """
    root = Node("#root", None)
    here, at, size = root, 0, len(page)
    open_tables: dict[str, int] = {}

    def close(node: Node) -> None:
        nonlocal here
        while here is not node.parent:
            here.open[here.tag] = here.open.get(here.tag, 0) - 1
            if here.tag in TABLES:
                open_tables[here.tag] -= 1
            here = here.parent

    while at < size:
        m = _OPEN.search(page, at)
        if m is None:
            here.children.append(page[at:])
            break
        if m.start() > at:
            here.children.append(page[at : m.start()])
        at = m.end()
        if m[2] is None:
            continue
        tag = m[2].lower()
        rest = _REST.match(page, at)
        at = rest.end()
        if not rest[2]:
            break  # the page ends inside a tag
        if m[1]:
            if tag in ("html", "body"):
                continue  # what follows belongs to the body all the same
            if (open_tables if tag in TABLES else here.open).get(tag, 0) > 0:
                node = here
                while node.tag != tag:
                    node = node.parent
                close(node)
            continue
        if tag in ENDS_P and here.p is not None:
            close(here.p)
        ended = here.item if tag == "li" else here.term if tag in ("dt", "dd") else here.cell if tag in ("td", "th") else (here.row or here.cell) if tag == "tr" else None
        if ended is not None:
            close(ended)
        attributes = rest[1]
        dropped = here.dropped or is_boilerplate(tag, attributes)
        child = Node(tag, here, dropped, not dropped and is_named(tag, attributes, here.inside))
        here.children.append(child)
        if tag in VOID or attributes.endswith("/") and tag not in BLOCK and tag not in RAW:
            continue
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}(?=[\s/>]|\Z)[^>]*+>?", re.IGNORECASE).search(page, at)
            at = end.end() if end else size
            continue
        child.open[tag] = child.open.get(tag, 0) + 1
        if tag in TABLES:
            open_tables[tag] = open_tables.get(tag, 0) + 1
        here = child
    return root


def count(root: Node) -> tuple[list[Node], Node]:
    """Characters, links and tags of all kept nodes, children before parents, and the body."""
    order, todo, body = [], [root], root
    while todo:
        node = todo.pop()
        if node.dropped:
            continue
        if node.tag == "body" and body is root:
            body = node
        order.append(node)
        todo.extend(c for c in node.children if not isinstance(c, str))
    order.reverse()
    for node in order:
        node.chars = node.links = node.tags = node.link_tags = 0
        for c in node.children:
            if isinstance(c, str):
                node.chars += len(c) - c.count(" ") - c.count("\n")
            elif not c.dropped:
                node.tags += c.tags + 1
                node.link_tags += c.link_tags + (c.tag == "a")
                node.links += c.links if c.tag != "a" else c.chars
                node.chars += c.chars
    return order, body


def prune(order: list[Node], body: Node) -> bool:
    """Drops the frames, named elements and menus that weigh little against the rest of the page; whether any went."""
    went, whole = False, max(1, body.plain)
    for node in reversed(order):  # parents first
        if node is body or node.tag in ("#root", "html") or node.parent.dropped:
            node.dropped = node.dropped or node.parent is not None and node.parent.dropped
            continue
        few = node.plain < PRIOR * (whole - node.plain)
        frame = node.tag in FRAMES and not (node.tag == "header" and node.inside) and 2 * node.plain < whole
        menu = not node.inside and node.tag in BLOCK and node.link_tags >= MENU_LINKS and node.links >= MENU_SHARE * node.chars and 2 * node.chars < body.chars
        if frame or menu or node.named and few:
            node.dropped = went = True
    return went


def measure(order: list[Node], body: Node) -> None:
    """The composite density of each node, and the sum of its children's."""
    whole, linked = max(1, body.chars), body.links
    for node in order:
        if node.chars:
            plain = max(1, node.plain)
            base = math.log(node.chars / plain * node.links + linked / whole * node.chars + math.e)
            value = node.chars / max(1, node.links) * (max(1, node.tags) / max(1, node.link_tags))
            node.density = node.chars / max(1, node.tags) * (math.log(max(value, 1.0)) / base)
        node.total = sum(c.density for c in node.children if not isinstance(c, str) and not c.dropped)


def densest_subtree(order: list[Node], body: Node) -> Node | None:
    """The subtree of the largest density sum among nodes as dense as the path from the densest one to the body.

    Only elements that can hold paragraphs count: a long bold sentence isn't the article of its paragraph.
    """
    inside = [n for n in order if n.chars and (n is body or n.tag in BLOCK and n.tag != "p" and n.tag != "html" and n.tag not in HEADINGS)]
    if not inside:
        return None
    densest = max(inside, key=lambda n: n.total)
    threshold, node = densest.density, densest
    while node is not None and node is not body:
        node = node.parent
        if node is not None:
            threshold = min(threshold, node.density)
    best = max((n for n in inside if n.density >= threshold), key=lambda n: n.total, default=densest)
    return best if best.total > 0 else max(inside, key=lambda n: n.density)


def article(root: Node) -> Node | None:
    """The subtree that holds the article, or None."""
    order, body = count(root)
    if prune(order, body):
        order, body = count(root)
    measure(order, body)
    best = densest_subtree(order, body)
    if best is None:
        return None
    # An article or main element is the outermost of its kind. It competes by plain text, also where it lies around or
    # inside the densest subtree; elsewhere the densest subtree counts in full.
    wholes = [n for n in order if n.tag in WHOLE and n.chars and not (n.parent is not None and n.parent.inside)]
    around = set()
    node = best
    while node is not None:
        around.add(node)
        node = node.parent
    rival = max(wholes, key=lambda n: (n in around, n.plain), default=None)
    if rival is not None and (rival in around or CANDIDATE * max(rival.plain, rival.chars // 2) >= best.plain):
        return rival
    # Headings right above the text belong to it.
    while best is not body and best.parent is not None and best.parent is not root:
        heads = sum(c.chars for c in best.parent.children if not isinstance(c, str) and not c.dropped and c.tag in HEADINGS)
        if not heads and best.parent.chars > best.chars or best.parent.chars - best.chars > heads:
            break
        best = best.parent
    return best


def blocks(top: Node) -> list[str]:
    """Text of the subtree by blocks, in page order, with references decoded and white space made single."""
    out: list[str] = []
    words: list[str] = []

    def end() -> None:
        if text := " ".join("".join(words).split()):
            out.append(text)
        words.clear()

    todo: list[Node | str | None] = [top]
    while todo:
        x = todo.pop()
        if x is None:
            end()
        elif isinstance(x, str):
            words.append(html.unescape(x) if "&" in x else x)
        elif not x.dropped:
            if x.tag == "br":
                words.append(" ")
            elif x.tag in BLOCK:
                end()
                todo.append(None)
                todo.extend(reversed(x.children))
            else:
                todo.extend(reversed(x.children))
    end()
    return out


def main_text(page: str | None) -> str:
    if not page:
        return ""
    top = article(parse(page))
    return "\n\n".join(blocks(top)) if top else ""


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text, n_chars for each row. Null or textless pages give an empty text; repeated rows stay.

    Very long pages are read whole, in time proportional to their length. Of equally dense subtrees the one that ends
    first is taken. Other columns, whatever their names, aren't read.
    """

    def make():  # noqa: ANN202
        def step(columns: list[list]) -> list[list]:
            texts = [main_text(h) for h in columns[2]]
            return [columns[0], columns[1], texts, list(map(len, texts))]

        return step

    rows = pages.select(F.col(id_col).cast("bigint"), F.col(url_col).cast("string"), F.col(html_col).cast("string"))
    return map_slices(rows, "page_id bigint, url string, text string, n_chars bigint", make, text=2)


def op7_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(read_table(spark, sf_dir, "pages"))
