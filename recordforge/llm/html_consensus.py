"""Main text of web pages by consensus host paths (operator 4).

First pass: every page is parsed into elements; each container (an element
that holds blocks) is scored by the text of its own blocks, less that in links,
with a share of its children's score, and its path is generalised: the tags from
the root down, each with its class names, digits as ``#``. The best path gives
way to that of an article around it, or of a container around it that holds a
heading of its own. Each page votes for its best path with its score. Spark adds up the votes of a host per
path and picks the path with the most; ties go to the shorter, then the smaller
path. Second pass: every page is parsed again, and the elements at its host's
winning path are extracted; a page that has none falls back to its own best
path.

Extraction skips menus, headers, footers, sidebars, notices, adverts, forms,
scripts, styles and reader comments inside the container, by tag, by role and by
whole words in class and id, unless a part so named, a form, a dialog, or a part that is
hidden or has such a role turns out to hold the article; of a form that stays, the
controls go. A header that holds a heading of the article stays. Text
is collected block by block: character references are decoded, white space
inside a block is one space, blocks are joined by one space.

Hot hosts: votes are summed in partial aggregates, and winners reach the pages
by a broadcast of counted size or else by a salted join. Null or empty html, and
pages with no container that holds text, give an empty text. Pages without a
host vote together. Repeated rows give equal results; extra columns are
ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections import Counter
from html import unescape

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BROADCAST_ROWS, by_value, map_batches, materialise, salt_of, salted, text_slices

by_value(__name__)

# fixed values of the HTML standard
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
RAW_TEXT = {"script", "style", "textarea", "title", "noscript", "iframe", "noembed", "noframes", "template", "svg", "math"}
RAW_END = {tag: re.compile("</" + tag, re.IGNORECASE | re.ASCII) for tag in RAW_TEXT}
INLINE = {
    "a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins", "kbd", "label",
    "mark", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr", "img",
}
#: A start tag closes an open element of these kinds first.
CLOSES_P = {
    "address", "article", "aside", "blockquote", "center", "details", "dialog", "dir", "div", "dl", "fieldset", "figcaption", "figure",
    "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hgroup", "hr", "main", "menu", "nav", "ol", "p", "pre", "section",
    "summary", "table", "ul",
}
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SCOPES = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table", "tbody", "thead", "tfoot"}, "td": {"tr", "table"}, "th": {"tr", "table"}}

SKIP_TAGS = {"nav", "footer", "aside", "button", "select", "menu", *RAW_TEXT}
SKIP_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alert", "form", "menu", "menubar"}
#: Of these, the ones that list links, however long they are.
LINK_ROLES = {"navigation", "menu", "menubar"}
SKIP_WORDS = {
    "ad", "ads", "advert", "adverts", "advertisement", "advertising", "alert", "banner", "breadcrumb", "breadcrumbs", "comment", "comments", "consent",
    "cookie", "cookies", "discussion", "disqus", "feedback", "footer", "gdpr", "masthead", "menu", "modal", "nav", "navbar", "navigation", "newsletter", "notice", "notices",
    "pager", "pagination", "popup", "promo", "promoted", "related", "replies", "reply", "responses", "share", "sharing", "sidebar", "social", "sponsor",
    "sponsored", "subscribe", "toolbar", "widget", "widgets",
}
#: Names of parts that readers write, or of other articles, however long they are.
READER_WORDS = {"comment", "comments", "discussion", "disqus", "feedback", "related", "replies", "reply", "responses"}
#: The share of a page's text that a part must hold to be kept despite its name.
MOST = 0.6
#: And the share for a dialog and for what is hidden or has another role than form; visible text goes first.
NEARLY_ALL = 0.8
#: Class names that begin so say something of the page, like no-sidebar.
STATES = {"no", "not", "has", "with", "without", "is"}
CONTAINERS = {"page", "article", "main", "section", "div", "td", "body", "center", "form", "html"}

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<close>/?)(?P<tag>[A-Za-z][^\s/>]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)",
    re.S,
)
_ATTR = re.compile(r"""(?:^|[\s/"'])(class|id|role|hidden|style|aria-hidden)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?(?=[\s/>"']|\Z)""", re.I)
_WORDS = re.compile(r"[a-z]+|[0-9]+")
_DIGITS = re.compile(r"[0-9]+")
_SPACE = re.compile(r"\s+")
TEXT = None  # the tag of a text event
#: Elements nested deeper (browsers stop nesting there, too) count as parts of the one at this depth: they
#: keep what they inherit, but have no path of their own, and walks to the root pass over those between.
MAX_DEPTH = 512


def events(html: str):
    """(tag, is_close, attributes, text): start tags, end tags, and text with tag None. Raw text elements give no text."""
    at, n = 0, len(html)
    while at < n:
        m = _TOKEN.search(html, at)
        if m is None:
            yield TEXT, False, "", html[at:]
            return
        if m.start() > at:
            yield TEXT, False, "", html[at : m.start()]
        at = m.end()
        if m["tag"] is None:
            if m[0].startswith("<![CDATA["):
                yield TEXT, False, "", m[0][9:].removesuffix("]]>").replace("&", "&amp;")
            continue
        tag = m["tag"].lower()
        if m["close"]:
            yield tag, True, "", ""
            continue
        yield tag, False, m["attrs"], ""
        if tag in RAW_TEXT and not m["attrs"].endswith("/"):
            end = RAW_END[tag].search(html, at)  # in the page itself: lower() may change its length
            at = end.start() if end else n


class Element:
    __slots__ = ("depth", "up", "paths", "tag", "parent", "path", "skip", "inline", "header", "number", "named", "hard", "wrap", "wraps", "in_form")

    def __init__(self, tag: str, parent: Element | None, attrs: str, number: int = 0, exempt: frozenset = frozenset()):
        self.tag, self.parent, self.number = tag, parent, number
        self.inline = tag in INLINE
        self.depth = parent.depth + 1 if parent else 0
        self.up = parent if not parent or parent.depth <= MAX_DEPTH else parent.up
        self.paths: dict[str, str] | None = None  # of its children, one string for all that share it
        words, classes, off, role = set(), (), False, ""
        if attrs and not attrs.isspace():
            for name, a, b, c in _ATTR.findall(attrs):
                name, value = name.lower(), (a or b or c).lower()
                if name == "class":
                    classes = value.split()
                    for c in classes:
                        parts = _WORDS.findall(c)
                        if parts and parts[0] not in STATES:
                            words.update(parts)
                elif name == "id":
                    words.update(_WORDS.findall(value))
                elif name == "role":
                    role = value.strip()
                elif name == "hidden" or name == "aria-hidden" and value == "true" or name == "style" and re.search(r"display\s*:\s*none", value):
                    off = True
        # what its names say; "named" parts are left out unless they turn out to hold the text
        self.named = frozenset() if self.inline or tag in ("page", "html", "body", "main") else frozenset(words & SKIP_WORDS)
        self.header = parent.header if parent else None
        if tag == "header":
            self.header = self
        # wrappers are left out, too, unless they turn out to hold the text
        form = tag == "form" or role == "form"
        self.wrap = ""
        if off or form or tag == "dialog" or role in SKIP_ROLES:
            self.wrap = "hidden" if off else "form" if form else "links" if role in LINK_ROLES else "part"
        self.wraps = (parent.wraps if parent else ()) + ((self,) if self.wrap and self.depth <= MAX_DEPTH else ())
        self.in_form = bool(parent and parent.in_form) or form
        self.hard = bool(parent and parent.hard) or tag in SKIP_TAGS or tag == "label" and self.in_form
        named = bool(self.named) and tag != "article" and number not in exempt
        self.skip = bool(parent and parent.skip) or self.hard or named or bool(self.wrap) and -number not in exempt
        if self.inline or self.depth > MAX_DEPTH:
            self.path = parent.path if parent else ""
        else:
            name = ".".join([tag, *sorted(_DIGITS.sub("#", c) for c in classes)])
            if parent is None:
                self.path = name
            else:
                if parent.paths is None:
                    parent.paths = {}
                self.path = parent.paths.setdefault(name, f"{parent.path}>{name}" if parent.path else name)


def parse(tokens: list, on_text, exempt: frozenset = frozenset()):
    """Walk the ``events`` of a page; calls ``on_text(element, raw text or None)``; None stands for a block's begin or end.

    The elements numbered in ``exempt`` are not left out for their names, those with their number
    negated there not for being wrappers."""
    root = Element("page", None, "")
    now, number = root, 0
    held: Counter = Counter()  # open elements by tag: no walk for a tag that none has

    def leave(to: Element) -> Element:
        up = now
        while up is not to:
            held[up.tag] -= 1
            up = up.parent
        return to

    for tag, is_close, attrs, text in tokens:
        if tag is TEXT:
            on_text(now, text)
            continue
        if is_close:
            if tag == "br":
                on_text(now, None)
            up = now if held[tag] else root
            while up is not root and up.tag != tag:
                if tag in INLINE and not up.inline:  # an inline end tag never closes a block
                    up = root
                    break
                up = up.parent
            if up is not root:
                if not up.inline:
                    on_text(now, None)
                now = leave(up.parent)
            continue
        if tag in VOID:
            if tag not in INLINE:
                on_text(now, None)
            continue
        if tag in CLOSES_P and held["p"]:
            now = leave(close_open(now, root, {"p"}, {"table", "td", "th", "button", "object", "caption"}, on_text))
        if tag in CLOSES and any(held[k] for k in CLOSES[tag]):
            now = leave(close_open(now, root, CLOSES[tag], SCOPES.get(tag, set()), on_text))
        if tag in ("html", "body") and held[tag]:
            continue
        number += 1
        child = Element(tag, now, attrs, number, exempt)
        if not child.inline:
            on_text(now, None)
        if not attrs.endswith("/") or tag not in ("svg", "math"):
            now = child
            held[tag] += 1
    on_text(now, None)


def lineage(e: Element):
    while e is not None:
        yield e
        e = e.up


def close_open(now: Element, root: Element, kinds: set, scope: set, on_text) -> Element:
    up = now
    while up is not root and up.tag not in scope:
        if up.tag in kinds:
            on_text(now, None)
            return up.parent
        up = up.parent
    return now


def is_mark(e: Element) -> bool:
    """Whether ``e`` is the main element or an article that its names leave in."""
    return e.tag == "main" or e.tag == "article" and not e.named


def holding_the_text(tokens: list) -> frozenset:
    """Numbers of the elements that names would leave out although they hold the main element, an
    article that is not so named itself, or, on pages without either, most of the text that is not
    the readers'; and, negated, the numbers of the wrappers that stay."""
    held: dict[int, int] = {}
    named: dict[int, frozenset] = {}
    texts: list[tuple[Element, int]] = []
    total, marked = 0, False

    def on_text(e: Element, text: str | None) -> None:
        if text is not None and not e.hard and not text.isspace():
            texts.append((e, len(text)))

    parse(tokens, on_text)
    out: set[int] = wrappers_of_the_text(texts) if any(e.wraps for e, _ in texts) else set()
    for e, size in texts:
        if any(-w.number not in out for w in e.wraps):
            continue
        if not readers(e):
            total += size
        inner = False
        for x in lineage(e):
            if x.named and x.tag != "article":
                named[x.number] = x.named
                held[x.number] = held.get(x.number, 0) + size
                if inner:
                    out.add(x.number)
            inner = inner or is_mark(x)
        marked = marked or inner
    if not marked:
        out.update(k for k, n in held.items() if n > MOST * total and named[k].isdisjoint(READER_WORDS))
    return frozenset(out)


def readers(e: Element) -> bool:
    return any(x.named and not x.named.isdisjoint(READER_WORDS) for x in lineage(e))


def wrappers_of_the_text(texts: list[tuple[Element, int]]) -> set[int]:
    """The negated numbers of the wrappers that hold the text of a page, of which ``texts`` are (element, size).

    A form stays if it holds a mark (main or an article), or most of the text and no mark is outside it.
    Any other wrapper stays only if no mark is outside wrappers and it holds one, or nearly all text."""
    held: dict[Element, int] = {}
    marked: set[Element] = set()
    total = visible = 0  # with and without what wrappers other than forms hold
    for e, size in texts:
        size = 0 if readers(e) else size
        total += size
        if all(w.wrap == "form" for w in e.wraps):
            visible += size
        inner = apart = False
        for x in lineage(e) if e.wraps else ():
            if x.wrap:
                held[x] = held.get(x, 0) + (0 if apart and x.wrap == "form" else size)
                if inner:
                    marked.add(x)
                apart = apart or x.wrap != "form"
            inner = inner or is_mark(x)

    out: set[int] = set()

    def open_mark() -> bool:
        return any(all(-w.number in out for w in e.wraps) and any(map(is_mark, lineage(e))) for e, _ in texts)

    outside = open_mark()
    for x, size in held.items():
        if x.wrap == "form":
            within = any(map(is_mark, lineage(x)))
            whole = visible if all(w.wrap == "form" for w in x.wraps) else total
            if x in marked or size > MOST * whole and (within or not outside):
                out.add(-x.number)
    if not open_mark():
        out.update(-x.number for x, n in held.items() if x.wrap != "form" and (x in marked or n > NEARLY_ALL * total and x.wrap != "links"))
    return out


def container_of(e: Element | None) -> Element | None:
    """The nearest container at or above ``e``."""
    while e is not None and e.up is not None and (e.inline or e.tag not in CONTAINERS):
        e = e.up
    return e


def best_paths(html: str) -> list[tuple[str, float]]:
    """The containers' paths with their scores, best first: own text less links, and half of that of their blocks."""
    scores: dict[str, float] = {}
    around: dict[str, tuple[str, bool]] = {}  # the path that gives way -> the one it gives way to

    def on_text(e: Element, text: str | None) -> None:
        if text is None or e.skip or text.isspace():
            return
        size = len(_SPACE.sub(" ", text).strip())
        share = float(-size if any(x.tag == "a" for x in inline_lineage(e)) else size)
        block = container_of(e)
        if any(x.tag in HEADINGS for x in until(e, block)):
            heads.add(block.path)
        for _ in range(3):  # the block's container, and less to those around it
            if block is None:
                break
            if block.path not in scores:
                up = container_of(block.up)
                around[block.path] = (up.path if up else "", block.tag == "article")
            scores[block.path] = scores.get(block.path, 0.0) + share
            share /= 2
            block = container_of(block.up) if block.up else None

    heads: set[str] = set()
    tokens = list(events(html))
    parse(tokens, on_text, holding_the_text(tokens))
    ranked = sorted(((p, s) for p, s in scores.items() if s > 0), key=lambda x: (-x[1], len(x[0]), x[0]))
    if not ranked:
        return []
    path, score = ranked[0]
    best, up = path, path
    while up in around and not around[up][1]:  # up to the nearest article
        up = around[up][0]
        if up not in around or up.rpartition(">")[2].partition(".")[0] in ("page", "html", "body"):
            break
        if around[up][1] or up in heads and up.rpartition(">")[2].partition(".")[0] != "form":
            best = up
    return [(best, score), *(x for x in ranked if x[0] != best)]


def inline_lineage(e: Element):
    while e is not None and e.inline:
        yield e
        e = e.up


def extract(html: str, path: str) -> str | None:
    """The main text of the elements at ``path``; None if there is none."""
    blocks: list[str] = []
    current: list[str] = []
    seen = False

    def container(e: Element) -> Element | None:
        for x in lineage(e):
            if not x.inline and x.path == path:
                return x
        return None

    def flush() -> None:
        if current:
            text = _SPACE.sub(" ", "".join(current).replace("\x00", "")).strip()
            current.clear()
            if text:
                blocks.append(text)

    def on_text(e: Element, text: str | None) -> None:
        nonlocal seen
        if text is None:
            flush()
            return
        if len(e.path) < len(path) or not e.path.startswith(path):
            return
        own = container(e)
        if own is None:
            return
        seen = True
        if not below_skip(e, own):
            current.append(unescape(text))  # a reference ends with its piece of text

    tokens = list(events(html))
    parse(tokens, on_text, holding_the_text(tokens))
    flush()
    return " ".join(blocks) if seen else None


def below_skip(e: Element, top: Element) -> bool:
    """Whether ``e`` is in a part of ``top`` that is not main text."""
    if top.skip:
        return e.hard and not top.hard
    if e.skip or any(x.tag == "article" and not x.named.isdisjoint(READER_WORDS) for x in until(e, top)):
        return True
    return e.header is not None and e.header is not top.header and not any(x.tag in HEADINGS for x in until(e, e.header))


HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6", "hgroup"}


def until(e: Element, top: Element):
    while e is not None and e is not top:
        yield e
        e = e.up


def host(url):
    """The host of ``url``, lower case, without port or user; empty if it has none."""
    return F.coalesce(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)), F.lit(""))


def votes(pages: DataFrame) -> DataFrame:
    """(host, path, score): the best path of every page that has one."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for at, n in text_slices(batch, "html"):
                part = batch.slice(at, n)
                out = []
                for h, html in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    found = best_paths(html) if html else []
                    if found:
                        out.append((h, *found[0]))
                if out:
                    kinds = [pa.string(), pa.string(), pa.float64()]
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], ["host", "path", "score"])

    return map_batches(pages.select("host", "html"), run, "host string, path string, score double")


def main_text(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars, path), one row per row of ``pages``."""
    pages = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"), F.col(html).alias("html"), host(F.col(url)).alias("host"))
    polled = votes(pages).groupBy("host", "path").agg(F.count(F.lit(1)).alias("n"), F.sum("score").alias("score"))
    order = F.struct(-F.col("n"), F.length("path"), F.col("path"))
    winners = materialise(polled.groupBy(F.col("host").alias("_host")).agg(F.min_by("path", order).alias("path")))
    if winners.count() <= BROADCAST_ROWS // 10:
        joined = pages.join(F.broadcast(winners), F.col("host") == F.col("_host"), "left")
    else:
        dealt = pages.withColumn("_salt", salt_of("page_id", "url"))
        spread = salted(winners, "_salt2")
        joined = dealt.join(spread, (F.col("host") == F.col("_host")) & (F.col("_salt") == F.col("_salt2")), "left")
    joined = joined.select("page_id", "url", "html", "path")

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for at, n in text_slices(batch, "html"):
                part = batch.slice(at, n)
                texts, paths = [], []
                for page, path in zip(part.column(2).to_pylist(), part.column(3).to_pylist()):
                    text = extract(page, path) if page and path else None
                    if page and not text:
                        own = best_paths(page)
                        path = own[0][0] if own else None
                        text = extract(page, path) if path else None
                    texts.append(text or "")
                    paths.append(path if text else None)
                sizes = pa.array([len(t) for t in texts], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(texts, pa.string()), sizes, pa.array(paths, pa.string())],
                    ["page_id", "url", "text", "n_chars", "path"],
                )

    kind = joined.schema["page_id"].dataType.simpleString()
    return map_batches(joined, run, f"page_id {kind}, url string, text string, n_chars bigint, path string")
