"""Main text of web pages by composite text density.

A page becomes a tree of elements; what is never article text (scripts, menus, footers, forms,
hidden parts, reader comments and the like) is left out by its tag, role, class or id. Each
remaining node's density is its characters per tag, lowered by how many of both are in links. The
element with the greatest sum of its children's densities is the page's main one. The least
density on its path up to the body is the threshold: elsewhere in the page, whatever is
at least as dense gives its own greatest element too, so an article in several sections stays whole.
Where authors marked an ``article`` or ``main``, the search is within it, and all of it is taken.

Everything runs in one pass over the page and a few over its nodes, however deep or broken it is.
"""

from __future__ import annotations

import html
import math
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linewise.llm.blocks import blocks

# Elements of HTML by what they mean here.
RAW = ("script", "style", "title", "textarea", "xmp", "noembed", "noframes", "iframe")
VOID = ("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr")
LEFT_OUT = (
    "aside", "audio", "button", "canvas", "datalist", "dialog", "embed", "fieldset", "footer", "form", "head", "iframe", "input", "label", "map", "math", "menu",
    "nav", "noembed", "noframes", "noscript", "object", "option", "script", "select", "style", "svg", "template", "textarea", "title", "video",
)
BLOCKS = (
    "address", "article", "aside", "blockquote", "body", "br", "caption", "center", "dd", "details", "dialog", "dir", "div", "dl", "dt", "fieldset", "figcaption",
    "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hgroup", "hr", "html", "legend", "li", "main", "menu", "nav", "ol", "p", "pre",
    "search", "section", "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul",
)
ROLES = ("alert", "alertdialog", "banner", "complementary", "contentinfo", "dialog", "form", "menu", "menubar", "navigation", "search", "toolbar")
#: Words of a class or id that name what is not the article.
HINTS = (
    "ad", "ads", "adsense", "advert", "advertisement", "adverts", "advertising", "alert", "alerts", "banner", "breadcrumb", "breadcrumbs", "comment", "commentlist", "comments",
    "consent", "cookie", "cookies", "copyright", "disclaimer", "discussion", "disqus", "footer", "gdpr", "login", "masthead", "menu", "modal", "nav", "navbar",
    "navigation", "newsletter", "notice", "notices", "notification", "outbrain", "pager", "pagination", "overlay", "paywall", "popup", "promo", "promotion",
    "recommendations", "recommended", "related", "replies", "reply", "respond", "share", "sharing", "sidebar", "signup", "skip", "social", "sponsor", "sponsored", "subscribe",
    "taboola", "toolbar", "topbar",
)
#: A header of one of these is the article's own.
ARTICLE = ("article", "content", "entry", "post", "story")
#: Of the hints, what names reader comments, which may be marked as articles of their own.
COMMENTS = ("comment", "commentlist", "comments", "discussion", "disqus", "replies", "reply", "respond")
#: A start tag of a key closes an open element of its value's first tuple, unless one of the second stands between.
_LISTS, _TABLE = ("ul", "ol", "dir", "menu"), ("table",)
CLOSES = {
    "li": (("li",), _LISTS), "dt": (("dt", "dd"), ("dl",)), "dd": (("dt", "dd"), ("dl",)), "tr": (("tr",), _TABLE), "td": (("td", "th"), _TABLE),
    "th": (("td", "th"), _TABLE), "tbody": (("tbody", "thead", "tfoot"), _TABLE), "tfoot": (("tbody", "thead", "tfoot"), _TABLE), "option": (("option",), ("select",)),
}

_TOKEN = re.compile(
    r"<!--(?:>|->|.*?(?:--!?>|(?P<unclosed>\Z)))|<(?:[!?]|/(?![A-Za-z]))[^>]*>"
    r"|<(?P<end>/?)(?P<tag>[A-Za-z][^\s/>]*+)(?P<attributes>(?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')?+)*+)>",
    re.S,
)
_ATTRIBUTE = re.compile(r"([^\s\"'>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_TELLING = re.compile(r"class|id|role|style", re.I)
_ENDS = {tag: re.compile(rf"</{tag}(?=[\s/>])", re.I) for tag in RAW}
_WORDS = re.compile(r"[A-Za-z][a-z]*")
_RAW, _VOID, _OUT, _BLOCK, _ROLES, _HINTS, _COMMENTS, _ARTICLE = map(frozenset, (RAW, VOID, LEFT_OUT, BLOCKS, ROLES, HINTS, COMMENTS, ARTICLE))
_MENUS = frozenset(("div", "dl", "ol", "section", "table", "ul"))
_CLOSES_P = _BLOCK - {"body", "br", "caption", "html", "legend", "tbody", "td", "tfoot", "th", "thead", "tr"}
_HOLDS_P = frozenset(("table", "td", "th", "caption", "button", "object", "html", "body"))


class Page:
    """The tree in page order: per element its tag, parent, last descendant (``stop``) and whether
    it is left out (``hinted``: by class or id alone). ``texts`` are (element, decoded text)."""

    def __init__(self, source: str):
        self.tags, self.parents, self.stops = ["html"], [-1], [0]
        self.out, self.hinted = [False], [False]
        self.texts: list[tuple[int, str]] = []
        self._open: list[int] = [0]
        self._at: dict[str, list[int]] = {"html": [0]}  # per tag, the depths at which it is open
        self._blocks: list[int] = [0]  # depths of open block elements
        self._read(source)
        while self._open:
            self._close()

    def _close(self) -> None:
        element = self._open.pop()
        self._at[self.tags[element]].pop()
        if self.tags[element] in _BLOCK:
            self.texts.append((element, " "))
        if self._blocks and self._blocks[-1] == len(self._open):
            self._blocks.pop()
        self.stops[element] = len(self.tags)

    def _depth(self, tags) -> int:
        return max((self._at[t][-1] for t in tags if self._at.get(t)), default=-1)

    def _close_to(self, depth: int) -> None:
        while len(self._open) > depth:
            self._close()

    def _start(self, tag: str, attributes: str) -> None:
        if tag in ("html", "body", "head") and self._at.get(tag):
            return
        if tag in CLOSES:
            closed, within = CLOSES[tag]
            if (depth := self._depth(closed)) > self._depth(within):
                self._close_to(depth)
        if tag in _CLOSES_P and (depth := self._depth(("p",))) > self._depth(_HOLDS_P):
            self._close_to(depth)
        if tag == "body" and self._at.get("head"):
            self._close_to(self._at["head"][-1])
        element = len(self.tags)
        self.tags.append(tag)
        self.parents.append(self._open[-1])
        self.stops.append(element + 1)
        out, hinted = _left_out(tag, attributes)
        if tag == "header":
            out = out or not (self._at.get("article") or self._at.get("main"))
        self.out.append(out)
        self.hinted.append(hinted)
        if tag in _BLOCK:
            self.texts.append((element, " "))
        if tag in _VOID:
            return
        self._at.setdefault(tag, []).append(len(self._open))
        if tag in _BLOCK:
            self._blocks.append(len(self._open))
        self._open.append(element)

    def _end(self, tag: str) -> None:
        depth = self._depth((tag,))
        # An inline element is not closed from within a block that it holds.
        if depth > 0 and (tag in _BLOCK or depth >= self._blocks[-1]):
            self._close_to(depth)

    def _read(self, source: str) -> None:
        at, last = 0, source.rfind(">") + 1
        while 0 <= (start := source.find("<", at, last)):
            token = _TOKEN.match(source, start, last)
            if token is None:  # a sign that opens nothing
                self._text(source[at : start + 1])
                at = start + 1
                continue
            self._text(source[at:start])
            at = token.end()
            if token["unclosed"] is not None:
                return
            if token["tag"] is None:
                continue
            tag = token["tag"].lower()
            if token["end"]:
                self._end(tag)
                continue
            self._start(tag, token["attributes"])
            if tag in _RAW:
                end = _ENDS[tag].search(source, at)
                if end is None:
                    return
                at = end.start()
        self._text(re.sub(r"<[A-Za-z/!?].*\Z", "", source[at:], flags=re.S))

    def _text(self, text: str) -> None:
        if text:
            self.texts.append((self._open[-1], text))


def _left_out(tag: str, attributes: str) -> tuple[bool, bool]:
    """Whether an element is not article text by its tag, role or style; and by its class or id."""
    if tag in _OUT:
        return True, False
    if tag in ("html", "body") or not _TELLING.search(attributes):  # "hidden" holds "id"
        return False, False
    hinted = False
    for name, *values in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), html.unescape("".join(values))
        if name == "hidden" or name == "aria-hidden" and value.strip().lower() == "true":
            return True, False
        if name == "role" and _ROLES.intersection(value.lower().split()):
            return True, False
        if name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
            return True, False
        if name in ("class", "id"):
            for words in map(_named, value.split()):
                hinted = hinted or not words.isdisjoint(_COMMENTS if tag in ("article", "main") else _HINTS) or "header" in words and words.isdisjoint(_ARTICLE)
    return False, hinted


def _named(name: str) -> set[str]:
    """The words of a class or id; none where it says that something has or lacks a part."""
    words = [w.lower() for w in _WORDS.findall(name.lower() if name.isupper() else name)]
    return set() if words and words[0] in ("has", "no", "with", "without") else set(words)


def _density(chars: int, tags: int, link_chars: int, link_tags: int, share: float) -> float:
    """Characters per tag, times the part of the composite density that the node's links leave it:
    the logarithm of chars / link chars * tags / links, to a base that grows with the link characters, against
    what it would be without links. ``share`` is that of link characters in the body."""
    if not chars or not link_chars and not link_tags:
        return chars / max(tags, 1)
    tags, link_chars, link_tags = max(tags, 1), max(link_chars, 1), max(link_tags, 1)

    def composite(ratio: float, linked: float) -> float:
        return math.log(max(ratio, 1.0)) / math.log(math.log(linked + share * chars + math.e))

    whole = composite(chars * tags, 1.0)
    return chars / tags * min(1.0, composite(chars / link_chars * tags / link_tags, chars / max(chars - link_chars, 1) * link_chars) / whole) if whole else 0.0


def main_text(source: str | None) -> str:
    """The page's article, blocks joined by one blank; empty where it has none."""
    if not source:
        return ""
    page = Page(source)
    n, tags, parents, stops, out = len(page.tags), page.tags, page.parents, page.stops, page.out
    # A name alone does not hold against an article that the element contains.
    marked = [0] * (n + 1)
    for k in range(n):
        marked[k + 1] = marked[k] + (tags[k] in ("article", "main") and not page.hinted[k] and not out[k])
    links = [False] * n
    for k in range(1, n):
        out[k] = out[parents[k]] or out[k] or page.hinted[k] and marked[stops[k]] == marked[k + 1]
        links[k] = links[parents[k]] or tags[k] == "a"
    texts = [(k, html.unescape(t)) for k, t in page.texts if not out[k]]
    own = [0] * n
    for k, text in texts:
        own[k] += len(" ".join(text.split()))

    def counted() -> tuple[list[int], list[int], list[int], list[int]]:
        """Characters, tags, link characters and links below each node."""
        chars, link_chars = [0 if o else c for c, o in zip(own, out)], [c if a and not o else 0 for c, a, o in zip(own, links, out)]
        n_tags, n_links = [0] * n, [0] * n
        for k in range(n - 1, 0, -1):
            if not out[k]:
                up = parents[k]
                chars[up] += chars[k]
                link_chars[up] += link_chars[k]
                n_tags[up] += n_tags[k] + 1
                n_links[up] += n_links[k] + (tags[k] == "a")
        return chars, n_tags, link_chars, n_links

    chars, n_tags, link_chars, n_links = counted()
    menus = [tags[k] in _MENUS and n_links[k] >= 3 and 10 * link_chars[k] >= 9 * chars[k] for k in range(n)]
    if any(menus):  # links and little else
        for k in range(1, n):
            out[k] = out[parents[k]] or out[k] or menus[k]
        chars, n_tags, link_chars, n_links = counted()
    if not chars[0]:
        return ""
    share = link_chars[0] / chars[0]
    density = [_density(*counts, share) for counts in zip(chars, n_tags, link_chars, n_links)]
    sums = [-1.0 if o else 0.0 for o in out]
    for k in range(1, n):
        if not out[k] and tags[k] in _BLOCK:
            sums[parents[k]] += density[k]
    units = [k for k in range(n) if tags[k] in ("article", "main") and not out[k] and chars[k]]
    chosen = _marked_unit(units, stops, tags, sums) if units else _by_thresholds(parents, stops, out, density, sums)
    inside = bytearray(n)
    for k in chosen:
        inside[k : stops[k]] = b"\x01" * (stops[k] - k)
    return " ".join("".join(t for k, t in texts if inside[k] and not out[k]).split())


def _marked_unit(units: list[int], stops: list[int], tags: list[str], sums: list[float]) -> list[int]:
    """Of the outermost marked articles (else of the ``main`` elements) the one that holds the greatest sum."""
    outer: list[int] = []
    for k in [k for k in units if tags[k] == "article"] or units:
        if not outer or k >= stops[outer[-1]]:
            outer.append(k)
    return [max(outer, key=lambda k: (max(sums[k : stops[k]]), -k))]


def _by_thresholds(parents: list[int], stops: list[int], out: list[bool], density: list[float], sums: list[float]) -> list[int]:
    """The element with the greatest sum of its blocks' densities; and wherever a subtree is as dense
    as the thinnest element on the way from there up to the body, its element with the greatest sum."""
    n = len(parents)
    best = list(range(n))  # per node the element with the greatest sum in its subtree, the first of equals
    for k in range(n - 1, 0, -1):
        if (up := parents[k]) >= 0 and (sums[best[k]], -best[k]) > (sums[best[up]], -best[up]):
            best[up] = best[k]
    top = best[0]
    threshold, k, path = density[top], top, set()
    while k > 0:
        threshold, k = min(threshold, density[k]), parents[k]
        path.add(k)
    chosen, inside, k = [top], bytearray(n), 1
    inside[top : stops[top]] = b"\x01" * (stops[top] - top)
    while k < n:
        if out[k] or inside[k]:
            k = stops[k]
            continue
        if k not in path and density[k] >= threshold > 0 and not inside[best[k]]:
            chosen.append(best[k])
            inside[best[k] : stops[best[k]]] = b"\x01" * (stops[best[k]] - best[k])
            continue  # the rest of this subtree follows
        k += 1
    return chosen


def extract_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``page_id``, ``url``, ``text`` (empty if there is none) and ``n_chars``, its code points, of
    every row. A null or empty page has no text; rows that share an id each get a row; other
    columns are not read. A page is worked on whole by one task."""

    def run(batches):
        for block in blocks(batches, "html"):
            texts = [main_text(raw.decode("utf-8", "replace")) for raw in block.texts()]
            yield pa.RecordBatch.from_arrays(
                [block.column("page_id"), block.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"]
            )

    narrow = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html"))
    return narrow.mapInArrow(run, "page_id long, url string, text string, n_chars long")
