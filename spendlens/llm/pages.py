"""Main text of web pages by composite text density."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendlens.llm.common import column

# HTML element names and the words by which pages name their boilerplate.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template iframe textarea title svg xmp".split())
INLINE = frozenset("""
    a abbr acronym b bdi bdo big br cite code data del dfn em font i ins kbd label mark q rp rt ruby s
    samp small span strike strong sub sup time tt u var wbr img
""".split())
DROPPED = frozenset("""
    head nav footer aside form script style noscript template iframe textarea title svg button select
    option dialog menu canvas object audio video map xmp
""".split())
KEPT = frozenset("html body article main".split())
BOILERPLATE = frozenset("""
    ad ads adbox adslot advert adverts advertisement alert banner breadcrumb breadcrumbs comment
    comments consent contentinfo complementary cookie cookies dialog disclaimer discussion disqus foot
    footer gdpr login masthead menu modal nav navbar navigation newsletter notice notification overlay
    pager pagination popup promo promoted promotion recommended related replies reply respond search
    share sharing sidebar signup skip social sponsor sponsored subscribe toolbar widget
""".split())
CLOSES = {  # an opening tag ends an open element of these names, up to the nearest of SCOPE
    **dict.fromkeys("""address article aside blockquote center details div dl fieldset figure footer form
        h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul""".split(), ("p",)),
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"),
    "td": ("td", "th"), "th": ("td", "th"), "option": ("option",),
}
SCOPE = frozenset("html body article section div main td th table ul ol dl blockquote form aside nav".split())

TAG = re.compile(
    r"""<!--.*?(?:--!?>|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*"|'[^']*')*+|[^>]*)>""",
    re.S)
CUT = re.compile(r"<!--.*\Z|<[a-zA-Z/!?][^<>]*\Z", re.S)  # a page that ends inside a tag
NAMED = re.compile(r"""(?:^|\s)(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
HIDDEN = re.compile(
    r"""(?:^|\s)hidden(?:\s|=|/|$)|aria-hidden\s*=\s*["']?true|display\s*:\s*none""", re.I)
PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


class Node:
    """An element that is not inline; ``items`` are its texts and child nodes in page order.

    All that lies inside a dropped node is dropped too.
    """

    __slots__ = ("tag", "parent", "items", "dropped", "chars", "tags", "link_chars", "link_tags",
                 "density", "total", "named", "plain", "holds")

    def __init__(self, tag: str, parent: Node | None, dropped: bool = False, named: int = 0):
        self.tag, self.parent, self.dropped, self.named = tag, parent, dropped, named
        self.plain, self.holds = 0, False
        self.items: list[str | Node] = []
        self.chars = self.tags = self.link_chars = self.link_tags = 0
        self.density = self.total = 0.0


def is_boilerplate(tag: str, attributes: str, in_article: bool) -> bool:
    if tag in DROPPED:
        return True
    if tag == "header" and not in_article:
        return True
    if not attributes or tag in KEPT:
        return False
    if HIDDEN.search(attributes):
        return True
    return False


def boilerplate_name(attributes: str, in_article: bool) -> int:
    """2 if all words of a class, an id or a role are boilerplate, 1 if only some are, else 0."""
    found = 0
    for m in NAMED.finditer(attributes):
        for token in (m[1] or m[2] or m[3] or "").split():
            words = [part.lower() in BOILERPLATE or (part.lower() == "header" and not in_article)
                     for part in PART.findall(token)]
            if words and all(words):
                return 2
            found = max(found, int(any(words)))
    return found


def settle(nodes: list[Node]) -> None:
    """Drop what is named as boilerplate, with all inside it, unless it holds an article or main.

    Names that match in part drop nothing; they are forgotten where the element holds an article or
    most of the page's text outside links.
    """
    for node in reversed(nodes):
        node.plain += node.chars - node.link_chars
        if node.parent is not None and not node.dropped:
            node.parent.plain += node.plain
            if node.named < 2 or node.holds:
                node.parent.holds |= node.holds or (node.tag in ("article", "main") and not node.named)
    for node in nodes:
        inside = node.parent is not None and node.parent.dropped
        if node.tag in KEPT or node.holds or (node.named == 1 and 2 * node.plain > nodes[0].plain):
            node.named = 0
        node.dropped = node.dropped or inside or node.named == 2


def parse(page: str) -> list[Node]:
    """All nodes in page order, the root first; tolerant of missing and stray end tags.

    Inline elements are transparent: their text belongs to the node around them, and links are
    counted there. Boilerplate is built as well, but counts for none of its ancestors.
    """
    root = Node("html", None)
    nodes, stack, links, at = [root], [root], 0, 0
    opened = Counter()  # names on the stack
    last = page.rfind(">")

    def pop(depth: int) -> None:
        opened.subtract(n.tag for n in stack[depth:])
        del stack[depth:]

    def add(text: str) -> None:
        node = stack[-1]
        if "&" in text:
            text = unescape(text)
        node.items.append(text)
        size = len("".join(text.split()))
        node.chars += size
        if links:
            node.link_chars += size

    while at <= last and (m := TAG.search(page, at)):
        if m.start() > at:
            add(page[at:m.start()])
        at = m.end()
        if not m[2]:
            continue
        tag, attributes = m[2].lower(), m[3]
        if m[1]:
            if tag == "a":
                links = max(0, links - 1)
            elif tag == "br":
                stack[-1].items.append(" ")
            if opened[tag] > 0:
                depth = len(stack) - 1
                while stack[depth].tag != tag:
                    depth -= 1
                pop(depth)
                links = 0 if tag not in INLINE else links
            continue
        if tag in CLOSES:
            for depth in range(len(stack) - 1, 0, -1):
                name = stack[depth].tag
                if name in CLOSES[tag]:
                    pop(depth)
                    break
                if name in SCOPE:
                    break
        if tag in ("html", "body"):
            continue
        in_article = opened["article"] + opened["main"] > 0
        dropped = stack[-1].dropped or is_boilerplate(tag, attributes, in_article)
        named = boilerplate_name(attributes, in_article) if attributes else 0
        if tag in RAW:
            end = re.compile(f"</{tag}[^a-zA-Z]", re.I).search(page, at)
            at = end.start() if end else len(page)
            continue
        if tag == "a":
            links += 1
            stack[-1].link_tags += 1
            stack[-1].tags += 1
        if tag == "br" or tag == "wbr" or tag in VOID:
            stack[-1].items.append(" " if tag != "wbr" else "")
            continue
        if tag in INLINE and (not (dropped or named == 2) or stack[-1].dropped):
            continue
        node = Node(tag, stack[-1], dropped, named)
        stack[-1].items.append(node)
        nodes.append(node)
        stack.append(node)
        opened[tag] += 1
    if at < len(page):
        add(CUT.sub("", page[at:]))
    settle(nodes)
    return nodes


def weigh(nodes: list[Node]) -> None:
    """Composite text density of every node, and the sum of its children's densities.

    The density is characters per tag, times a logarithm that falls as more of the characters and
    tags belong to links. A node without child nodes counts as its own only child.
    """
    for node in reversed(nodes[1:]):
        if not node.dropped:
            parent = node.parent
            parent.chars += node.chars
            parent.tags += node.tags + 1
            parent.link_chars += node.link_chars
            parent.link_tags += node.link_tags
    body = nodes[0]
    link_share = body.link_chars / max(1, body.chars)
    for node in nodes:
        c, lc = node.chars, node.link_chars
        if not c or node.dropped:
            continue
        t, lt = max(1, node.tags), max(1, node.link_tags)
        base = math.log(c / max(1, c - lc) * lc + link_share * c + math.e)
        node.density = c / t * max(0.0, math.log(max(1.0, c / max(1, lc) * t / lt) + 1e-9) / math.log(base)
                                   if base > 1 + 1e-9 else math.log(max(1.0, c / max(1, lc) * t / lt) + 1))
    for node in nodes[1:]:
        if not node.dropped:
            if node.named:
                node.density /= 2
            node.parent.total += node.density
    for node in nodes:
        if not any(isinstance(item, Node) and not item.dropped for item in node.items):
            node.total = node.density


def blocks(top: Node, least: float = 0.0) -> Iterator[str]:
    """Texts of the blocks under a node in page order, white space made single.

    Nodes with a name that is boilerplate in part stay if their density reaches ``least``.
    """
    buffer: list[str] = []
    work: list[str | Node | None] = [top]
    while work:
        item = work.pop()
        if isinstance(item, str):
            buffer.append(item)
            continue
        if item is None or item.tag not in INLINE:
            if text := " ".join("".join(buffer).split()):
                yield text
            buffer = []
        if item is not None and not item.dropped and (item is top or not item.named or item.density >= least):
            work.append(None)
            work.extend(reversed(item.items))
    if text := " ".join("".join(buffer).split()):
        yield text


def main_text(page: str) -> str:
    """The text of the subtree with the largest density sum, one line per block.

    It rises to the article or main element around it if the rest of that is not mostly links. The
    smallest density on the path from there to the body is the threshold: subtrees of any name that
    stand beside the path belong to the text if they reach it. Beside the node itself, unless that
    is directly in the body, those that are not mostly links belong to it also below the threshold.
    """
    nodes = parse(page)
    weigh(nodes)
    best = nodes[0]
    for node in nodes:
        if not node.dropped and node.total > best.total:
            best = node
    path, node = [best], best.parent
    while node is not None:
        path.append(node)
        node = node.parent
    rise = 0
    for depth, node in enumerate(path):
        if node.tag in ("article", "main") and 2 * (node.link_chars - best.link_chars) <= node.chars - best.chars:
            rise = depth
    path = path[rise:]
    threshold = min(n.density for n in path)
    chosen = [path[0]]
    for child, parent in zip(path, path[1:]):
        near = child is path[0] and parent.parent is not None and child.tag not in ("article", "main")
        beside = [n for n in parent.items if isinstance(n, Node) and not n.dropped
                  and (n is child or n.density >= threshold > 0 or near and not n.named and 2 * n.link_chars < n.chars)]
        at = beside.index(child)
        chosen = beside[:at] + chosen + beside[at + 1:]
    return "\n".join(text for top in chosen for text in blocks(top, threshold))


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url",
            html_col: str = "html") -> DataFrame:
    """One row per input row: page_id, url, text, n_chars.

    A null or empty page, and one of boilerplate alone, gives an empty text. Repeated rows give
    equal texts, an empty table gives no rows, and other columns are not read.
    """
    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            texts = [main_text(page.as_py()) for page in part.column(2)]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    rows = pages.select(column(id_col).alias("page_id"), column(url_col).alias("url"),
                        F.coalesce(column(html_col), F.lit("")).alias("html"))
    kinds = [rows.schema[c].dataType.simpleString() for c in ("page_id", "url")]
    return rows.mapInArrow(batches, f"page_id {kinds[0]}, url {kinds[1]}, text string, n_chars long")
