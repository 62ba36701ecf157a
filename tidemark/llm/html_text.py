"""Main text of HTML pages, without what a site repeats.

A page is parsed into elements, and every block's subtree (its tags and text) is
hashed, over the whole body and before any other rule: containers, text blocks
and what is no content by its kind alike. Spark counts how many of the host's
pages hold each hash, and on a second reading the subtrees that recur on many of
them are deleted. Then what is no content by its kind (navigation, headers and
footers of the page, sidebars, forms, scripts, styles) is left out, and so are
containers whose id, class or role is made of nothing but words for such parts
(notices, adverts, reader comments): "cookie-notice" is, "related-work" and
"notice-period" are not, and headings, paragraphs and cells are never judged so.
The articles that still hold text, else the main elements, else the page are its
content.

Pages of a host with equal content count as one, so that an article published
many times stays whole; for the same reason an element that holds an article or
main element is never deleted as a whole. Cells are judged by their row. A
paragraph that stands directly in the body stays.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.common import keep, ready
from tidemark.llm.urlrules import host_of

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style template noscript iframe textarea title svg math object canvas".split())
#: Elements that are no content, whatever they hold.
DROP = frozenset("head script style template noscript iframe textarea title svg math object canvas nav footer aside form button select input dialog menu".split())
BLOCK = frozenset("address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html li main nav ol p pre section summary table tbody td tfoot th thead tr ul".split())
CELLS = frozenset("td th".split())
KEPT = frozenset("html body article main".split())
#: Elements that marks can drop; a heading's id is made of its words, so text blocks are none.
CONTAINERS = frozenset("div section ul ol dl table details fieldset center span figure".split())
#: Words in a container's id, class or role that mark it as no content, if all others are PLAIN.
MARKS = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies disclaimer disqus footer header masthead menu nav navbar navigation newsletter notice notices pagination popup promo promoted related replies reply share sharing sidebar social sponsor sponsored subscribe subscription toolbar widget".split()
)
PLAIN = frozenset("area article bar bottom box buttons container content extra floating global group inner item items layout left links list lower main modal outer overlay page panel post primary right secondary section site slot sticky strip top unit upper wrap wrapper zone".split())
#: By start tag: open elements that it ends, and those beyond which it ends none.
_LIST, _TERMS, _ROW, _CELL, _CHOICE = (("li",), ("ul", "ol")), (("dt", "dd"), ("dl",)), (("tr", "td", "th"), ("table",)), (("td", "th"), ("table", "tr")), (("option",), ("select",))
ENDS = {"li": _LIST, "dt": _TERMS, "dd": _TERMS, "tr": _ROW, "td": _CELL, "th": _CELL, "option": _CHOICE}

_TAG = re.compile(r"<!--.*?(?:-->|$)|<[!?][^>]*(?:>|$)|<(/?)([A-Za-z][A-Za-z0-9:-]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)(?:>|$)", re.S)
_ATTRIBUTE = re.compile(r"([^\s\"'>/=]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?")
#: The end of a self-closed tag; a slash that ends a value without quotes is part of the value.
_CLOSED = re.compile(r"(?<!\S)/\s*\Z|[\"']/\s*\Z|(?:^|[\s\"'])[^\s\"'=/]+/\s*\Z")
_OPEN_VALUE = re.compile(r"=\s+[^\s\"']+\Z")
_SPLIT = re.compile(r"[^A-Za-z0-9]+|(?<=[a-z])(?=[A-Z])")
_SPACE = re.compile(r"\s+")


class Node:
    __slots__ = ("tag", "parts", "drop", "hash", "filled", "fixed")

    def __init__(self, tag: str, drop: bool = False) -> None:
        self.tag, self.drop, self.hash = tag, drop, 0
        #: whether there is text in it, and whether it is never deleted for recurring
        self.filled, self.fixed = False, tag in KEPT or tag in CELLS
        self.parts: list[Node | str] = []


def _marked(tag: str, attributes: str, inside: bool) -> bool:
    """Whether an element is no content by its kind or its marks."""
    if tag in DROP:
        return True
    if tag == "header":
        return not inside  # an article's own header holds its title
    if not attributes or tag in KEPT:
        return False
    for name, value in _ATTRIBUTE.findall(attributes):
        name = name.lower()
        if name == "hidden" or name == "aria-hidden" and "true" in value.lower():
            return True
        if tag in CONTAINERS and name in ("id", "class", "role"):
            for token in value.strip("\"'").split():
                words = {w.lower() for w in _SPLIT.split(token) if w}
                marks = words & MARKS
                if marks and words <= MARKS | PLAIN and not (inside and marks == {"header"}):
                    return True
    return False


def _self_closed(attributes: str) -> bool:
    return bool(_CLOSED.search(attributes)) and not _OPEN_VALUE.search(attributes)


class _Stack:
    """The open elements, with what is needed to close them without walking over them."""

    def __init__(self, root: Node) -> None:
        self.nodes = [root]
        self.articles = 0
        #: places of the open blocks, and how many there are of each
        self.blocks: list[int] = []
        self.many: dict[str, int] = {}
        #: open inline elements by tag, since the last open block
        self.inline: list[dict[str, int]] = [{}]
        #: by kind of ENDS, the places of the elements that it ends or stops at
        self.marks: dict[tuple, list[int]] = {kind: [] for kind in ENDS.values()}

    def push(self, node: Node) -> None:
        place, tag = len(self.nodes), node.tag
        self.nodes.append(node)
        self.articles += tag in ("article", "main")
        if tag in BLOCK:
            self.blocks.append(place)
            self.many[tag] = self.many.get(tag, 0) + 1
            self.inline.append({})
        else:
            self.inline[-1][tag] = self.inline[-1].get(tag, 0) + 1
        for kind, places in self.marks.items():
            if tag in kind[0] or tag in kind[1]:
                places.append(place)

    def pop(self) -> Node:
        node = self.nodes.pop()
        self.articles -= node.tag in ("article", "main")
        if node.tag in BLOCK:
            self.blocks.pop()
            self.many[node.tag] -= 1
            self.inline.pop()
        else:
            self.inline[-1][node.tag] -= 1
        for places in self.marks.values():
            if places and places[-1] == len(self.nodes):
                places.pop()
        return node

    def end(self, tag: str) -> None:
        """An end tag closes its element and what is in it; an inline one does not close a block."""
        if self.many.get(tag) if tag in BLOCK else self.inline[-1].get(tag):
            while self.pop().tag != tag:
                pass

    def start(self, tag: str) -> None:
        """What a start tag closes: an open paragraph, the list item, row or cell before it."""
        if tag in BLOCK and self.blocks and self.nodes[self.blocks[-1]].tag == "p":
            self.end("p")
        if tag in ENDS:
            places = self.marks[ENDS[tag]]
            while places and self.nodes[places[-1]].tag in ENDS[tag][0]:
                place = places[-1]
                while len(self.nodes) > place:
                    self.pop()


def parse(html: str) -> Node:
    """The tree of a page; broken markup closes where HTML would close it."""
    root = Node("")
    stack, at, end = _Stack(root), 0, len(html)
    while at < end:
        m = _TAG.search(html, at)
        if m is None:
            stack.nodes[-1].parts.append(html[at:])
            break
        if m.start() > at:
            stack.nodes[-1].parts.append(html[at : m.start()])
        at = m.end()
        if m.group(2) is None:
            continue
        tag = m.group(2).lower()
        if m.group(1):
            stack.end(tag)
            continue
        stack.start(tag)
        node = Node(tag, _marked(tag, m.group(3), stack.articles > 0))
        stack.nodes[-1].parts.append(node)
        if tag in VOID:
            continue
        if tag in ("svg", "math") and _self_closed(m.group(3)):
            continue
        if tag in RAW:
            close = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(html, at)
            at = close.end() if close else end
            continue
        if m.group(3).rstrip().endswith("/") and tag not in BLOCK:
            continue
        stack.push(node)
    return root


def _hashes(root: Node) -> list[int]:
    """Give every subtree its hash, without what is dropped in it; return those that a template could be."""
    out: list[int] = []
    roots = [root]
    while roots:
        node = roots.pop()
        todo: list[tuple[Node, int, xxhash.xxh64]] = [(node, 0, xxhash.xxh64(node.tag))]
        while todo:
            now, k, h = todo.pop()
            while k < len(now.parts):
                part = now.parts[k]
                k += 1
                if isinstance(part, str):
                    text = _SPACE.sub(" ", part).strip()
                    if text:
                        now.filled = True
                        h.update(b"\x01" + text.encode(errors="replace"))
                elif part.drop:
                    roots.append(part)
                else:
                    part.fixed = part.fixed or part.tag == "p" and now.tag in ("", "html", "body")
                    todo.append((now, k, h))
                    now, k, h = part, 0, xxhash.xxh64(part.tag)
            h.update(b"\x02")
            value = now.hash = h.intdigest() - (1 << 63)
            if removable(now):
                out.append(value)
            if todo:
                above = todo[-1][0]
                above.filled |= now.filled
                above.fixed |= now.tag in ("article", "main") or now.fixed and now.tag not in CELLS and now.tag not in KEPT
                todo[-1][2].update(value.to_bytes(8, "big", signed=True))
    return out


def removable(node: Node) -> bool:
    """Whether a hashed element goes if it recurs."""
    return node.filled and not node.fixed and (node.tag in BLOCK or node.drop)


def _content(root: Node, gone: frozenset[int] = frozenset()) -> list[Node]:
    """The outermost articles that hold text, else the outermost such main elements, else the page."""
    for tag in ("article", "main"):
        found, todo = [], [root]
        while todo:
            now = todo.pop()
            if now.drop or id(now) in gone:
                continue
            if now.tag == tag:
                if not gone or _holds_text(now, gone):
                    found.append(now)
                continue
            todo.extend(p for p in reversed(now.parts) if not isinstance(p, str))
        if found:
            return found
    return [root]


def _holds_text(node: Node, gone: frozenset[int]) -> bool:
    todo = [node]
    while todo:
        now = todo.pop()
        if now.drop or id(now) in gone:
            continue
        if any(isinstance(p, str) and p.strip() for p in now.parts):
            return True
        todo.extend(p for p in now.parts if not isinstance(p, str))
    return False


def subtree_hashes(html: str) -> tuple[list[int], int]:
    """Distinct hashes of the page's removable subtrees, and the hash of its content."""
    root = parse(html)
    found = sorted(set(_hashes(root)))
    content = xxhash.xxh64()
    for node in _content(root):
        content.update(node.hash.to_bytes(8, "big", signed=True))
    return found, content.intdigest() - (1 << 63)


def main_text(html: str, template: frozenset[int] = frozenset()) -> str:
    """Blocks of the content in page order, one a line, without the template's subtrees."""
    blocks: list[str] = []
    line: list[str] = []

    def close() -> None:
        text = _SPACE.sub(" ", unescape("".join(line))).strip()
        line.clear()
        if text:
            blocks.append(text)

    root = parse(html)
    gone = _template_nodes(root, template) if template else frozenset()
    for content in _content(root, gone):
        todo: list[tuple[Node, int]] = [(content, 0)]
        while todo:
            now, k = todo.pop()
            if k == 0 and now.tag in BLOCK:
                close()
            if k < len(now.parts):
                todo.append((now, k + 1))
                part = now.parts[k]
                if isinstance(part, str):
                    line.append(part)
                elif part.tag == "br":
                    line.append(" ")
                elif part.drop or id(part) in gone:
                    if part.tag in BLOCK:
                        close()
                else:
                    todo.append((part, 0))
            elif now.tag in BLOCK:
                close()
        close()
    return "\n".join(blocks)


def _template_nodes(root: Node, template: frozenset[int]) -> frozenset[int]:
    _hashes(root)
    gone, todo = set(), [root]
    while todo:
        now = todo.pop()
        for part in now.parts:
            if isinstance(part, str):
                continue
            if removable(part) and part.hash in template:
                gone.add(id(part))
            else:
                todo.append(part)
    return frozenset(gone)


def extract_text(pages: DataFrame, least_pages: int = 5, least_share: float = 0.3, salts: int = 32, broadcast_rows: int = 1_000_000) -> DataFrame:
    """One row per page: page_id, url, text, n_chars.

    A subtree is template if it is on at least ``least_pages`` pages of the host
    and on ``least_share`` of them, where pages with equal content are one page; a
    host has at most (subtrees of a page) / ``least_share`` of those. They are
    broadcast to the pages if a count shows at most ``broadcast_rows`` of them (8
    bytes each); beyond that they travel in one array per host, copied over
    ``salts`` so that a host with most pages is not one task.
    Defined cases: null and empty html give an empty text; a null url counts as
    the host of all urls without one; broken markup is read to its end; repeated
    rows are pages of their own; an empty table gives no rows; other columns are
    ignored.
    """
    ready(pages.sparkSession)
    host = F.coalesce(host_of(F.col("url").cast("string")), F.lit(""))
    work = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"), host.alias("host"))

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [subtree_hashes(h) for h in batch.column("html").to_pylist()]
            # every page has a row without a subtree besides: its host's pages are counted by it
            own = np.repeat(np.arange(len(found)), [len(f) + 1 for f, _ in found])
            content = np.array([c for _, c in found], np.int64)[own]
            yield pa.RecordBatch.from_arrays([batch.column("host").take(pa.array(own)), pa.array([x for f, _ in found for x in (*f, None)], pa.int64()), pa.array(content)], names=["host", "subtree", "content"])

    counts = work.select("html", "host").mapInArrow(hashed, "host string, subtree long, content long").groupBy("host", "subtree").agg(F.count_distinct("content").alias("_on"))
    counts = keep(counts.filter(F.col("_on") >= least_pages))
    sizes = counts.filter("subtree IS NULL").select("host", F.col("_on").alias("_pages"))
    template = counts.filter("subtree IS NOT NULL").join(sizes, "host").filter(F.col("_on") >= least_share * F.col("_pages"))
    template = keep(template.groupBy("host").agg(F.sort_array(F.collect_set("subtree")).alias("_template")))
    schema = "page_id long, url string, text string, n_chars long"

    def extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            gone = batch.column("_template").to_pylist() if "_template" in batch.schema.names else [None] * batch.num_rows
            texts = [main_text(h, frozenset(g or ())) for h, g in zip(batch.column("html").to_pylist(), gone)]
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    rows = template.agg(F.sum(F.size("_template"))).first()[0]
    if not rows:
        return work.select("page_id", "url", "html").mapInArrow(extracted, schema)
    if rows <= broadcast_rows:
        joined = work.join(F.broadcast(template), "host", "left")
        return joined.select("page_id", "url", "html", "_template").mapInArrow(extracted, schema)
    spread = template.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))).withColumnRenamed("host", "_host")
    salted = work.withColumn("_mine", F.pmod(F.xxhash64("page_id", "url"), F.lit(salts)).cast("int"))
    joined = salted.join(spread, (F.col("host") == F.col("_host")) & (F.col("_mine") == F.col("_salt")), "left")
    return joined.select("page_id", "url", "html", "_template").mapInArrow(extracted, schema)
