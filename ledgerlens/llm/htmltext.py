"""Main text of web pages by removal of site templates.

Every element of a page is a subtree with a hash of its tag, text and children.
Spark counts the subtrees per host; those that recur in many pages of their host
are its template and are deleted from every page. What remains is freed of page
furniture that need not recur (menus, footers, adverts, notices, forms,
comments, by tag, role, class or id) and read in page order.

A subtree recurs if it stands in pages of at least ``MIN_PAGES`` origins, and in
no more than ``COPIES`` pages per origin. The origin of a page, seen from a
subtree, is the least hash of the three-word shingles of the longest block of
text outside it and outside furniture: copies of one article, exact or slightly
changed, are one origin, so an article is not taken for a template because it
was copied. A page without such text has one origin. Paragraphs, headings and
such in an article that is marked as one are its text and are never counted or
deleted, however often they recur; nor is what holds most of a page's text.

The text is that of the outermost ``article`` elements; without them, of
``main``; without that, of the whole page less blocks made mostly of links.
Only what is within an article decides: an emptied article leaves no text.

A page is parsed twice rather than stored as a tree. What is shuffled are hashes
of subtrees; the recurring ones are sent to all tasks while they are few, else
joined by hash (``broadcast_rows``); the result is the same.

Defined cases: null html has no text; without a host in its url a page has no
template to remove; equal rows are one page; unclosed and misnested elements
are closed as browsers do for paragraphs, list items and table cells; a text
that ends within a tag or comment loses the unfinished tag. White space is what
``str.split`` cuts at.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from itertools import accumulate
from urllib.parse import urlsplit

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import Scratch, map_frames, small_frames

MIN_PAGES = 5
COPIES = 4
BROADCAST_ROWS = 1_000_000
SHINGLE = 3

TOKEN = re.compile(
    r"<!--(?:.*?-->|>|.*\Z)|<!\[CDATA\[(?P<cdata>.*?)(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*'|[\"'])*?)(?:>|\Z)|(?P<text>[^<]+|<)",
    re.DOTALL,
)
ATTRIBUTE = re.compile(r"([^\s=\"'/>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")

# The HTML vocabulary.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes template".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark nobr q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split()
)
PARAGRAPH_ENDS = frozenset(
    "address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split()
)
# A start tag closes an open element of these, up to the element that bounds it.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "option": ({"option"}, {"select"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"thead", "tbody", "tr", "td", "th"}, {"table"}), "thead": ({"caption"}, {"table"}), "tfoot": ({"tbody", "tr", "td", "th"}, {"table"}),
}
SCOPES = frozenset("table td th caption button object html body".split())
# Page furniture, by tag, by role, and by a word of class or id.
FURNITURE_TAGS = RAW | frozenset("nav footer aside form button select dialog head svg canvas object audio video menu input".split())
FURNITURE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog menu menubar toolbar alert".split())
FURNITURE_WORDS = frozenset(
    """ad ads advert adverts advertisement advertising adsense adslot adbox banner promo promotion promoted sponsor sponsored sponsors
    nav navbar navigation menu menubar breadcrumb breadcrumbs pagination pager sidebar footer masthead topbar toolbar
    aside cookie cookies consent gdpr notice notices notification alert popup modal overlay disclaimer newsletter subscribe subscription signup login
    share sharing social related recommended recommendations comment comments disqus respond replies reply widget skip hidden""".split()
)
FURNITURE_STARTS = ("comment", "advert", "sponsor", "cookie", "navbar", "sidebar", "breadcrumb")
# Elements whose text belongs to a marked article, if they stand in it.
PROSE = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre li dt dd td th figcaption caption".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
WORDS = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+")


class Node:
    """An element: its place among all elements and blocks, and what is known of it."""

    __slots__ = ("tag", "parent", "furniture", "prose", "article", "digest", "first", "end")

    def __init__(self, tag: str, parent: int, first: int):
        self.tag, self.parent, self.first, self.end = tag, parent, first, first
        self.furniture = self.prose = False
        self.article, self.digest = 0, None


def furniture(tag: str, attributes: str, in_article: bool) -> bool:
    if tag in FURNITURE_TAGS:
        return True
    if tag == "header" and not in_article:
        return True
    if attributes:
        for name, *values in ATTRIBUTE.findall(attributes):
            name, value = name.lower(), "".join(values)
            if name == "hidden" or name == "aria-hidden" and value.lower() == "true":
                return True
            if name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
                return True
            if name == "role" and value.lower() in FURNITURE_ROLES:
                return True
            if name in ("class", "id") and tag not in ("html", "body", "article", "main"):
                words = {w.lower() for w in WORDS.findall(value)}
                if not words.isdisjoint(FURNITURE_WORDS) or not in_article and "header" in words or any(w.startswith(FURNITURE_STARTS) for w in words):
                    return True
            if name in ("class", "id", "itemtype") and tag == "article" and "comment" in value.lower():
                return True
    return False


class Page:
    """The elements of a page in order (``nodes``) and its pieces of text (``blocks``: text, element, linked)."""

    def __init__(self, source: str):
        self.nodes: list[Node] = [Node("", -1, 0)]
        self.blocks: list[tuple[str, int, int]] = []
        self._pieces: list[str] = []
        self._linked = 0
        self._owner = 0
        self._open = [0]
        self._links = 0
        self._parse(source)

    def _break(self) -> None:
        """The text so far is a block."""
        if self._pieces:
            text = " ".join("".join(map(html.unescape, self._pieces)).split())
            if text:
                self.blocks.append((text, self._owner, self._linked))
            self._pieces, self._linked = [], 0

    def _text(self, text: str) -> None:
        if not self._pieces:
            if text.isspace():
                return
            self._owner = self._open[-1]
        self._pieces.append(text)
        if self._links:
            self._linked += len(text)

    def _start(self, tag: str, attributes: str) -> None:
        top = self.nodes[self._open[-1]]
        node = Node(tag, self._open[-1], 0)
        node.furniture = top.furniture or furniture(tag, attributes, top.article > 0)
        # An inline element of another kind of furniture is a block of its own.
        if tag not in INLINE or node.furniture != top.furniture:
            self._break()
        node.first = len(self.blocks)
        node.article = top.article or (len(self.nodes) if tag in ("article", "main") and not node.furniture else 0)
        if top.article and tag == "article" and self.nodes[top.article].tag == "main":
            node.article = len(self.nodes)
        header = top.tag == "header" and top.article > 0
        node.prose = node.article > 0 and not node.furniture and (top.prose or tag in PROSE)
        if header and tag not in HEADINGS and tag not in INLINE:
            node.furniture, node.prose = True, False
        self.nodes.append(node)
        self._open.append(len(self.nodes) - 1)
        self._links += tag == "a"

    def _close(self, depth: int) -> None:
        """Close the open elements from ``depth`` on."""
        while len(self._open) > depth:
            node = self.nodes[self._open[-1]]
            above = self.nodes[node.parent]
            if node.tag not in INLINE or node.furniture != above.furniture:
                self._break()
            node.end = len(self.blocks)
            self._links -= node.tag == "a"
            self._open.pop()

    def _imply(self, tag: str) -> None:
        """Close what a start tag closes without an end tag."""
        if tag in PARAGRAPH_ENDS:
            closed, bounds = {"p"}, SCOPES
        elif tag in CLOSES:
            closed, bounds = CLOSES[tag]
        else:
            return
        found = None
        for depth in range(len(self._open) - 1, 0, -1):
            name = self.nodes[self._open[depth]].tag
            if name in closed:
                found = depth
            elif name in bounds:
                break
        if found is not None:
            self._close(found)

    def _parse(self, source: str) -> None:
        at, size = 0, len(source)
        while at < size:
            match = TOKEN.match(source, at)
            at = match.end()
            kind = match.lastgroup
            if kind == "text":
                self._text(match["text"])
                continue
            if kind == "cdata":
                self._text(html.escape(match["cdata"]))
                continue
            tag = match["tag"]
            if tag is None:
                continue
            tag, attributes = tag.lower(), match["attrs"]
            if match["end"]:
                for depth in range(len(self._open) - 1, 0, -1):
                    name = self.nodes[self._open[depth]].tag
                    if name == tag:
                        self._close(depth)
                        break
                    if name in ("table", "td", "th") and tag not in ("table", "tr", "tbody", "thead", "tfoot", "body", "html"):
                        break
                if tag == "br":
                    self._break()
                continue
            if tag in VOID:
                if tag not in INLINE:
                    self._break()
                continue
            self._imply(tag)
            if attributes.endswith("/") and tag in ("svg", "path", "use"):
                continue
            self._start(tag, attributes)
            if tag in RAW:
                # Raw text runs to its own end tag only; none of it is text of the page.
                end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>", re.I).search(source, at)
                at = end.end() if end else size
                self._close(len(self._open) - 1)
        self._close(1)
        self._break()
        self.nodes[0].end = len(self.blocks)

    def hashed(self) -> None:
        """Digests of all subtrees with text; an element that only wraps another has that of the other."""
        parts: list[list[tuple[int, int]]] = [[] for _ in self.nodes]
        for number, (text, owner, _) in enumerate(self.blocks):
            while not self.nodes[owner].first <= number < self.nodes[owner].end:
                owner = self.nodes[owner].parent
            parts[owner].append((number, xxhash.xxh3_64_intdigest(text.encode("utf-8", "surrogatepass"))))
        own = [len(p) for p in parts]
        for number in range(len(self.nodes) - 1, 0, -1):
            node, inside = self.nodes[number], sorted(parts[number])
            if not inside:
                continue
            if len(inside) == 1 and not own[number]:
                node.digest = inside[0][1]
            else:
                node.digest = xxhash.xxh3_64_intdigest(f"{node.tag} {' '.join(str(d) for _, d in inside)}".encode())
            parts[node.parent].append((node.first, node.digest))


def shingle_minimum(text: str) -> int:
    words = text.encode("utf-8", "surrogatepass").split()
    if len(words) <= SHINGLE:
        return xxhash.xxh3_64_intdigest(b" ".join(words))
    return min(map(xxhash.xxh3_64_intdigest, map(b" ".join, zip(*(words[i:] for i in range(SHINGLE))))))


def host_of(url: str | None) -> str | None:
    """The host of an address in lower case, without user and port; None if there is none."""
    if not url:
        return None
    try:
        found = urlsplit(url if "//" in url else f"//{url}").hostname
    except ValueError:
        return None
    return found or None


def site_key(host: str, digest: int) -> int:
    """A host's subtree as a signed number."""
    return xxhash.xxh3_64_intdigest(f"{host} {digest}".encode("utf-8", "surrogatepass")) - (1 << 63)


def counted(page: Page) -> list[int]:
    """Numbers of the elements that may be template.

    They have text, are no prose of a marked article and, unless they are
    furniture anyway, hold no more than half of the page's other text.
    """
    lengths = [0 if page.nodes[owner].furniture else len(text) for text, owner, _ in page.blocks]
    before = list(accumulate(lengths, initial=0))
    found = []
    for number, node in enumerate(page.nodes):
        if node.digest is None or node.prose or node.tag in ("html", "body", "article", "main") or node.tag in INLINE and not node.furniture:
            continue
        if node.furniture or 2 * (before[node.end] - before[node.first]) <= before[-1]:
            found.append(number)
    return found


def subtree_rows(host: str, page: Page) -> list[tuple[int, int]]:
    """(site key, origin) of the subtrees of a page, each key once."""
    page.hashed()
    text = [b for b, (_, owner, _) in enumerate(page.blocks) if not page.nodes[owner].furniture]
    longest = sorted(text, key=lambda b: (-len(page.blocks[b][0]), b))
    minima: dict[int, int] = {}
    rows: dict[int, int] = {}
    for number in counted(page):
        node = page.nodes[number]
        outside = next((b for b in longest if not node.first <= b < node.end), None)
        if outside is not None and outside not in minima:
            minima[outside] = shingle_minimum(page.blocks[outside][0]) - (1 << 63)
        rows.setdefault(site_key(host, node.digest), 0 if outside is None else minima[outside])
    return list(rows.items())


def remaining_text(page: Page, deleted: set[int]) -> str:
    """The text of a page without the elements ``deleted`` and page furniture."""
    out = bytearray(len(page.nodes))
    for number, node in enumerate(page.nodes[1:], 1):
        out[number] = node.furniture or number in deleted or out[node.parent]
    marked = {node.article for node in page.nodes if node.article}
    articles = {a for a in marked if page.nodes[a].tag == "article"}
    wanted = articles or marked
    texts = []
    for text, owner, linked in page.blocks:
        node = page.nodes[owner]
        if out[owner] or wanted and node.article not in wanted:
            continue
        if not wanted and 2 * linked > len(text):
            continue
        texts.append(text)
    return " ".join(texts)


def page_keys(url: str, source: str) -> list[Column]:
    return [F.xxhash64(url, source).alias("k1"), F.hash(source, url).alias("k2")]


def subtrees(pages: DataFrame, url: str, source: str) -> DataFrame:
    """(k1, k2, key, origin): the subtrees of every page, equal pages once each."""
    rows = pages.filter(F.col(source).isNotNull()).select(*page_keys(url, source), F.col(url).alias("u"), F.col(source).alias("t"))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in small_frames(frames, "t"):
            out = []
            for k1, k2, u, t in frame.itertuples(index=False):
                host = host_of(u)
                if host is not None:
                    out += [(k1, k2, key, origin) for key, origin in subtree_rows(host, Page(t))]
            yield pd.DataFrame(out, columns=["k1", "k2", "key", "origin"])

    return map_frames(rows, run, "k1 long, k2 int, key long, origin long")


def templates(found: DataFrame, min_pages: int, copies: int) -> DataFrame:
    """(key): the subtrees that recur in their host."""
    pages = found.groupBy("key", "origin").agg(F.count(F.lit(1)).alias("pages"))
    counts = pages.groupBy("key").agg(F.count(F.lit(1)).alias("origins"), F.sum("pages").alias("pages"))
    return counts.filter((F.col("origins") >= min_pages) & (F.col("pages") <= copies * F.col("origins"))).select("key")


def main_text(
    pages: DataFrame, keep: tuple[str, ...] = ("page_id", "url"), url: str = "url", source: str = "html",
    min_pages: int = MIN_PAGES, copies: int = COPIES, broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """``keep`` and the main text (``text``, empty if none) of every page."""
    scratch, kept = Scratch(), Scratch()  # until the templates are known; until the result is written
    found = scratch.stored(subtrees(pages, url, source), "pages-subtrees")
    recurring = kept.stored(templates(found, min_pages, copies), "pages-templates")
    # Whole numbers go as text: pandas would turn them into floats beside nulls.
    types = [dict(pages.dtypes)[c] for c in keep]
    sent = ["string" if t in ("bigint", "int", "smallint", "tinyint") else t for t in types]
    kinds = [f"k{i} {t}" for i, t in enumerate(sent)]
    rows = pages.select(*[F.col(c).cast(t).alias(f"k{i}") for i, (c, t) in enumerate(zip(keep, sent))], F.col(url).alias("u"), F.col(source).alias("t"), *[k.alias(n) for k, n in zip(page_keys(url, source), ("h1", "h2"))])
    few = recurring.count() <= broadcast_rows
    if few:
        listed = np.sort(np.fromiter((r["key"] for r in recurring.toLocalIterator()), dtype=np.int64))
        shared = pages.sparkSession.sparkContext.broadcast(listed)
        rows = rows.withColumn("hits", F.lit(None).cast("array<long>"))
    else:
        hits = found.join(recurring, "key").groupBy(F.col("k1").alias("h1"), F.col("k2").alias("h2")).agg(F.collect_set("key").alias("hits"))
        rows = rows.join(kept.stored(hits, "pages-hits"), ["h1", "h2"], "left")
    rows = rows.drop("h1", "h2")

    def known(keys: list[int], hits) -> set[int]:
        if not few:
            return set() if hits is None else set(map(int, hits))
        have = shared.value
        if not len(have) or not keys:
            return set()
        asked = np.array(keys, dtype=np.int64)
        at = np.minimum(np.searchsorted(have, asked), len(have) - 1)
        return set(asked[have[at] == asked].tolist())

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in small_frames(frames, "t"):
            texts = []
            for u, t, hits in zip(frame["u"], frame["t"], frame["hits"]):
                if not t:
                    texts.append("")
                    continue
                page, host, deleted = Page(t), host_of(u), set()
                if host is not None:
                    page.hashed()
                    keys = {number: site_key(host, page.nodes[number].digest) for number in counted(page)}
                    gone = known(list(keys.values()), hits)
                    deleted = {number for number, key in keys.items() if key in gone}
                texts.append(remaining_text(page, deleted))
            out = frame.drop(columns=["u", "t", "hits"])
            out["text"] = texts
            yield out

    result = map_frames(rows, run, ", ".join([*kinds, "text string"]))
    scratch.clear()
    if few:
        kept.clear()
    return result.select(*[F.col(f"k{i}").cast(t).alias(c) for i, (c, t) in enumerate(zip(keep, types))], "text")
