"""Main text of web pages, with site templates found by counting element subtrees per host."""

from __future__ import annotations

import re
from collections import Counter
from html import unescape
from itertools import accumulate

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from proofmark.llm.common import col, per_batch, written

#: A subtree is template if so many different pages of a host hold it, and this share of the host's different pages;
TEMPLATE_PAGES = 5
TEMPLATE_SHARE = 0.2
#: or, outside articles, if so many do, and this far smaller share, which bounds the list of a host.
MANY_PAGES = 50
MANY_SHARE = 0.01
SALTS = 16

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<raw>script|style|noscript|template|iframe|svg|math|textarea|object)\b[^>]*>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][a-zA-Z0-9:-]*)(?P<rest>(?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>"
    r"|</?[a-zA-Z!?][^>]*(?:>|\Z)",
    re.S | re.I,
)
_ATTRIBUTE = re.compile(r"([a-zA-Z:-]+)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+)")
_NAME = re.compile(r"[a-z]+")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body br button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre section select summary table tbody td tfoot th "
    "thead title tr ul".split()
)
#: Elements whose whole subtree is never main text.
FURNITURE = frozenset("head nav header footer aside form menu button select option dialog fieldset label title".split())
#: Words of class, id and role that mark furniture.
MARKS = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promoted banner cookie cookies consent gdpr notice notices alert "
    "popup modal overlay newsletter subscribe subscription sidebar menu nav navbar navigation breadcrumb breadcrumbs masthead header footer "
    "contentinfo complementary search comment comments commentlist replies reply disqus related recommended share sharing social login signup form toolbar".split()
)
#: Elements that hold an article; a mark on them or around them does not remove them.
CONTENT = frozenset(["article", "main"])
#: Elements counted as possible templates. Paragraphs and headings are text, however often they recur.
CONTAINERS = frozenset("div section ul ol dl table nav header footer aside form center details figure menu span fieldset".split())
_CLOSES_P = BLOCKS - frozenset(["br", "option", "body", "html", "head", "title", "caption", "td", "th", "tr", "tbody", "thead", "tfoot", "li", "dd", "dt", "button", "select", "legend", "summary"])
_SIBLINGS = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",),
}
_SCOPES = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("table", "tr"), "th": ("table", "tr"), "option": ("select",)}


class Element:
    """An open or closed element: its place in the page's list of parts, and what its attributes say."""

    __slots__ = ("name", "start", "end", "parent", "marked", "comments", "content")

    def __init__(self, name: str, start: int, parent: int, marked: bool, comments: bool):
        self.name, self.start, self.end, self.parent, self.marked, self.comments, self.content = name, start, -1, parent, marked, comments, False


def parse(html: str) -> tuple[list, list[Element]]:
    """The page as a list of parts (text, or None at the edge of a block) and its elements in the order they open.

    End tags that HTML lets authors leave out are supplied; stray end tags are passed over; what is open at the end closes there.
    """
    parts: list[str | None] = []
    elements: list[Element] = []
    stack: list[int] = []
    opened: Counter = Counter()  # names on the stack, so that it is searched only for what it holds

    def close(depth: int) -> None:
        while len(stack) > depth:
            element = elements[stack.pop()]
            element.end = len(parts)
            opened[element.name] -= 1
            parts.append(None)

    at = 0
    for token in _TOKEN.finditer(html):
        if token.start() > at:
            parts.append(html[at : token.start()])
        at = token.end()
        name = token["name"]
        if not name:
            continue
        name = name.lower()
        if token["end"]:
            if opened[name]:
                depth = next(d for d in range(len(stack) - 1, -1, -1) if elements[stack[d]].name == name)
                if name in BLOCKS:
                    close(depth)
                else:
                    _close_inline(elements, stack, depth, parts, opened)
            continue
        if name in VOID:
            if name in ("br", "hr"):
                parts.append(None)
            continue
        if name in _CLOSES_P and opened["p"]:
            close(next(d for d in range(len(stack) - 1, -1, -1) if elements[stack[d]].name == "p"))
        if any(opened[sibling] for sibling in _SIBLINGS.get(name, ())):
            for d in range(len(stack) - 1, -1, -1):
                if elements[stack[d]].name in _SCOPES[name]:
                    break
                if elements[stack[d]].name in _SIBLINGS[name]:
                    close(d)
                    break
        if name in BLOCKS:
            parts.append(None)
        said = _said(token["rest"])
        element = Element(name, len(parts), stack[-1] if stack else -1, bool(said & MARKS), bool(said & {"comment", "comments", "commentlist", "disqus", "replies"}))
        stack.append(len(elements))
        opened[name] += 1
        elements.append(element)
        if token["rest"].endswith("/") and name not in BLOCKS:
            _close_inline(elements, stack, len(stack) - 1, parts, opened)
    if at < len(html):
        parts.append(html[at:])
    close(0)
    for element in elements:
        if element.name in CONTENT and not element.comments:
            up: Element | None = element
            while up is not None and not up.content:
                up.content = True
                up = elements[up.parent] if up.parent >= 0 else None
    return parts, elements


def _close_inline(elements: list[Element], stack: list[int], depth: int, parts: list, opened: Counter) -> None:
    """An inline end tag closes its element, and inline ones left open in it; blocks opened in it stay open."""
    if all(elements[i].name not in BLOCKS for i in stack[depth:]):
        for i in stack[depth:]:
            elements[i].end = len(parts)
            opened[elements[i].name] -= 1
        del stack[depth:]
    else:
        elements[stack[depth]].end = len(parts)
        opened[elements[stack[depth]].name] -= 1
        del stack[depth]


def _said(rest: str) -> set[str]:
    """Words of the attributes class, id and role."""
    said: set[str] = set()
    if "=" in rest:
        for name, value in _ATTRIBUTE.findall(rest):
            if name.lower() in ("class", "id", "role"):
                said.update(_NAME.findall(value.lower()))
    return said


class Subtrees:
    """Hashes of a page's elements with all below them: name, texts, block edges, and whether an article holds the element.

    Each part is hashed once; the hash of a stretch of parts comes from two running sums, however deep elements nest.
    """

    _PRIME, _BASE = (1 << 61) - 1, 0x1B873593CC9E2D51 % ((1 << 61) - 1)

    def __init__(self, parts: list, elements: list[Element]):
        self.sums, self.powers, self.edges = [0], [1], [0] * (len(parts) + 2)
        for part in parts:
            own = 1 if part is None else xxhash.xxh64_intdigest(" ".join(part.split())) % self._PRIME + 2
            self.sums.append((self.sums[-1] * self._BASE + own) % self._PRIME)
            self.powers.append(self.powers[-1] * self._BASE % self._PRIME)
        for e in elements:
            if e.name in CONTENT and not e.comments:
                self.edges[e.start] += 1
                self.edges[e.end] -= 1
        self.depth = list(accumulate(self.edges))

    def stretch(self, start: int, end: int) -> int:
        return (self.sums[end] - self.sums[start] * self.powers[end - start]) % self._PRIME

    def inside(self, element: Element) -> bool:
        return self.depth[element.start] > 0

    def key(self, element: Element) -> int:
        place = "article" if self.inside(element) else "page"
        said = f"{place}\x01{element.name}\x01{element.end - element.start}\x01{self.stretch(element.start, element.end)}"
        return xxhash.xxh64_intdigest(said) - (1 << 63)


def page_subtrees(html: str) -> tuple[int, dict[int, bool]]:
    """What tells the page from its copies (the hash of its articles, or without one of all of it), and the keys of its containers.

    Containers that hold an article or most of the page's text have no key. With each key: whether an article holds it.
    """
    parts, elements = parse(html)
    subtrees = Subtrees(parts, elements)
    sizes = [0]
    for p in parts:
        sizes.append(sizes[-1] + (len(p) if p is not None else 0))
    articles = [(e.start, e.end) for e in elements if e.name in CONTENT and not e.comments] or [(0, len(parts))]
    own = xxhash.xxh64_intdigest(repr([(end - start, subtrees.stretch(start, end)) for start, end in articles])) - (1 << 63)
    return own, {
        subtrees.key(e): subtrees.inside(e)
        for e in elements
        if e.name in CONTAINERS and not e.content and 0 < sizes[e.end] - sizes[e.start] <= sizes[-1] / 2
    }


def main_text(html: str, templates: frozenset[int] | set[int] = frozenset()) -> str:
    """Text of the article, or without one of the body, less furniture and less subtrees that are templates of the site."""
    parts, elements = parse(html)
    keep = bytearray(len(parts) + 1)
    articles = [e for e in elements if e.name in CONTENT and not e.comments]
    subtrees = Subtrees(parts, elements) if templates else None
    for e in articles:
        keep[e.start : e.end] = b"\x01" * (e.end - e.start)
    if not articles:
        keep[:] = b"\x01" * len(keep)
    for e in elements:
        if e.content or e.name in ("html", "body") or e.end <= e.start:
            continue
        gone = e.name in FURNITURE or e.marked
        if not gone and subtrees and e.name in CONTAINERS:
            gone = subtrees.key(e) in templates
        if gone:
            keep[e.start : e.end] = bytes(e.end - e.start)
    blocks, current = [], []
    for part, kept in zip(parts, keep):
        if part is None or not kept:
            if current:
                blocks.append(" ".join(unescape("".join(current)).split()))
                current = []
        else:
            current.append(part)
    if current:
        blocks.append(" ".join(unescape("".join(current)).split()))
    return " ".join(b for b in blocks if b)


def _host(url: str) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(col(url).cast("string"), F.lit("")), "^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1))


def site_templates(
    pages: DataFrame, url_col: str = "url", html_col: str = "html",
    least: int = TEMPLATE_PAGES, share: float = TEMPLATE_SHARE, many: int = MANY_PAGES, many_share: float = MANY_SHARE,
) -> DataFrame:
    """(host, templates): keys of subtrees that recur across many different pages of the host; copies of an article are one page.

    A subtree is template on `least` pages that are `share` of the host, or, unless an article holds it, on `many` pages
    that are `many_share` of the host. A host has at most (containers a page) / many_share templates, whatever its size.
    """
    source = pages.select(_host(url_col).alias("host"), F.coalesce(col(html_col), F.lit("")).cast("string").alias("html"))

    def start():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            hosts, keys, inside, owns = [], [], [], []
            for host, html in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist()):
                own, found = page_subtrees(html)
                hosts += [host] * (len(found) + 1)
                keys += [None, *found]  # the row without a key counts the page
                inside += [False, *found.values()]
                owns += [own] * (len(found) + 1)
            return pa.RecordBatch.from_arrays(
                [pa.array(hosts, pa.string()), pa.array(keys, pa.int64()), pa.array(inside, pa.bool_()), pa.array(owns, pa.int64())], ["host", "key", "inside", "own"]
            )

        return step

    # Distinct pages first, spread by all four columns, then counts: a subtree on every page of a host is in no single task.
    counts = source.mapInArrow(per_batch(start), "host string, key long, inside boolean, own long").distinct().groupBy("host", "key", "inside").agg(F.count("*").alias("n"))
    counts = written(counts.where(F.col("key").isNull() | (F.col("n") >= least)), "subtrees")
    sites = counts.where("key IS NULL").select("host", F.col("n").alias("pages"))
    often = F.col("n") >= F.col("pages") * share
    absolute = ~F.col("inside") & (F.col("n") >= many) & (F.col("n") >= F.col("pages") * many_share)
    return counts.where("key IS NOT NULL").join(sites, "host").where(often | absolute).groupBy("host").agg(F.collect_list("key").alias("templates"))


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", **limits) -> DataFrame:
    """Per input row: id, url, text, n_chars (code points).

    A null page is empty and has the empty text; a null or odd url belongs to the host ''. Pages of a busy host are dealt
    out over salts where the templates are too many to broadcast. Repeated rows stay; an empty table gives none.
    """
    templates = written(site_templates(pages, url_col, html_col, **limits), "templates")
    salted = templates.select("host", "templates", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    source = pages.select(
        col(id_col).alias("id"), col(url_col).alias("url"), F.coalesce(col(html_col), F.lit("")).cast("string").alias("html"),
        _host(url_col).alias("host"), F.pmod(F.xxhash64(col(id_col), col(url_col)), F.lit(SALTS)).cast("int").alias("salt"),
    )
    joined = source.join(salted, ["host", "salt"], "left").select("id", "url", "html", "templates")

    def start():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts = [main_text(h, frozenset(t or ())) for h, t in zip(batch.column("html").to_pylist(), batch.column("templates").to_pylist())]
            return pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("url"), pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())], ["id", "url", "text", "n_chars"]
            )

        return step

    id_type, url_type = (pages.schema[c].dataType.simpleString() for c in (id_col, url_col))
    out = joined.mapInArrow(per_batch(start), f"id {id_type}, url {url_type}, text string, n_chars long")
    return out.select(F.col("id").alias(id_col), F.col("url").alias(url_col), "text", "n_chars")
