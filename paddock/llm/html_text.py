"""Main text of web pages: parser events, text-to-tag ratios, smoothing and clustering.

The standard library's streaming parser turns a page into lines, one per block of text, each with its number of
characters and of tags and the containers around it. Containers that are no part of an article by their element
(menus, headers, footers, asides, forms, scripts and the like) or role leave the page with all they hold; a header inside an
article is the article's. So do those whose class or id is made of nothing but ``MARKS`` and ``LAYOUT`` words (ad-slot, cookieNotice), and a section
headed as reader comments. A class or id that only mentions such a word, or an ``AMBIGUOUS`` one (discussion, search-results,
legal-analysis), is a doubt and no more: inside an article or main element it drops what is mostly links, elsewhere what the
ratios do not find to be content.

The text-to-tag ratio of the lines is smoothed with a Gaussian, and a threshold between two clusters of ratios marks
the content lines. The content region is the main element that holds content, or the outermost articles that do. Where there is none, it is the
innermost container that holds all content lines but links, extended to parents that add no links, to the page if that adds paragraphs and
headings only, and from a quotation, details or a table cell to the parent that holds more. All its lines are the text, short
ones too; only runs of list items that are nothing but links are dropped as menus.

Character references are decoded, white space inside a block becomes one space, blocks are joined by one. A null or empty
page, or one without content, has the empty text. Unclosed and stray tags, truncated pages and pages of any length are read to
the end. Repeated rows are extracted row by row; an empty table gives an empty result. Other columns pass through; an input
column named like the output is replaced.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paddock.llm.common import table

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CONTAINERS = frozenset("html body main article section div td th blockquote details center".split())
BLOCKS = CONTAINERS | frozenset("p h1 h2 h3 h4 h5 h6 li ul ol dl dt dd pre table tr thead tbody tfoot figure figcaption address hr "
                                "header footer nav aside form fieldset legend summary dialog menu br caption".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
DROPPED = frozenset("script style noscript template head title nav footer aside form button select option textarea input label iframe "
                    "object svg canvas audio video dialog menu".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar toolbar form".split())
#: Words that mark what is not the article, where a class or id holds nothing but them and words of layout.
MARKS = frozenset("""
    nav navbar navigation menu submenu breadcrumb breadcrumbs pagination pager masthead topbar footer footnav sidebar aside
    ad ads adv advert adverts advertisement advertising adsense adslot sponsor sponsored promo promotion promoted
    cookie cookies consent gdpr notice notices popup modal overlay newsletter subscribe subscription signup login paywall
    share sharing comment comments disqus toolbar
""".split())
LAYOUT = frozenset("""
    slot box container wrapper wrap area bar list section block main top bottom left right site page inner outer global primary secondary
    js link links item items button buttons form widget row col column panel holder content region unit text body head
""".split())
#: Words that may as well name a part of an article.
AMBIGUOUS = frozenset("""
    header banner teaser alert social follow reply replies respond responses discussion related recommended recommendations
    trending popular search skip legal rail copyright disclaimer
""".split())
COMMENT_HEADINGS = frozenset("comments|reader comments|responses|replies|discussion|leave a comment|leave a reply|kommentare|leserkommentare|commentaires|comentarios".split("|"))

_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_COUNT = re.compile(r"[\d():.\s]+")
SIGMA, RADIUS = 1.0, 2


@dataclass
class Line:
    text: str
    tags: int
    path: tuple[int, ...]
    kind: str
    linked: int
    doubts: tuple[int, ...] = ()


@dataclass
class Node:
    tag: str
    number: int
    outside: bool = False
    in_article: bool = False
    doubtful: bool = False
    headed: bool = field(default=False)


class Lines(HTMLParser):
    """Collects a page's lines, without what is outside the article."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.lines: list[Line] = []
        self.open: list[Node] = [Node("", 0)]
        self.names = [""]
        self.parts: list[str] = []
        self.tags = self.linked = self.links = 0
        self.comments: set[int] = set()

    def _end_line(self) -> None:
        if self.parts:
            text = " ".join("".join(self.parts).split())
            if text:
                path = tuple(n.number for n in self.open if n.tag in CONTAINERS)
                kind = next((n.tag for n in reversed(self.open) if n.tag in HEADINGS or n.tag in ("li", "p")), "")
                self.lines.append(Line(text, max(1, self.tags), path, kind, self.linked, tuple(n.number for n in self.open if n.doubtful)))
                holder = next((n for n in reversed(self.open) if n.tag in CONTAINERS), None)
                if holder and not holder.headed:
                    holder.headed = True
                    if holder.tag in ("section", "div") and _COUNT.sub(" ", text).strip().lower() in COMMENT_HEADINGS:
                        self.comments.add(holder.number)
                self.tags = 0
            self.parts, self.linked = [], 0

    def _is_outside(self, tag: str, attrs: list, parent: Node) -> tuple[bool, bool]:
        """Whether an element is no part of the article, and whether that is in doubt."""
        if tag in DROPPED or (tag == "header" and not parent.in_article):
            return True, False
        doubt = False
        if tag in ("html", "body", "main"):
            return False, False
        for name, value in attrs:
            if name in ("class", "id"):
                if tag == "article" and not parent.in_article:
                    continue
                for token in (value or "").split():
                    words = {w.lower() for w in _WORDS.findall(token)}
                    if words & MARKS and words <= MARKS | LAYOUT:
                        return True, False
                    doubt |= bool(words & (MARKS | AMBIGUOUS))
            elif name == "role":
                if (value or "").lower() in ROLES:
                    return True, False
            elif name == "hidden" or (name == "aria-hidden" and value == "true"):
                return True, False
        return False, doubt

    def handle_starttag(self, tag, attrs):
        self.tags += 1
        if tag in BLOCKS:
            if tag == "br":
                self.parts.append(" ")
                return
            self._end_line()
            if tag in ("p", "li", "td", "th", "tr", "dt", "dd", "option") or tag in HEADINGS or tag in CONTAINERS:
                self._close_implied(tag)
        if tag in VOID:
            return
        parent = self.open[-1]
        outside, doubt = self._is_outside(tag, attrs, parent)
        node = Node(tag, len(self.names), parent.outside or outside, parent.in_article or tag in ("article", "main"), doubt)
        self.names.append(tag)
        if tag == "a":
            self.links += 1
        self.open.append(node)

    def _close_implied(self, tag: str) -> None:
        """An open paragraph ends at the next block; list items and cells at the next of their kind."""
        ends = {"li": {"li"}, "td": {"td", "th"}, "th": {"td", "th"}, "tr": {"tr", "td", "th"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}}.get(tag, set())
        for i in range(len(self.open) - 1, 0, -1):
            here = self.open[i].tag
            if here == "p" or here in ends:
                self._pop_to(i)
                if here != "p":
                    return
            elif here in BLOCKS and not (ends and here in HEADINGS):
                return

    def _pop_to(self, i: int) -> None:
        for n in self.open[i:]:
            if n.tag == "a":
                self.links -= 1
        del self.open[i:]

    def handle_endtag(self, tag):
        self.tags += 1
        if tag in BLOCKS and tag != "br":
            self._end_line()
        for i in range(len(self.open) - 1, 0, -1):
            here = self.open[i].tag
            if here == tag:
                self._pop_to(i)
                return
            if tag not in BLOCKS and here in BLOCKS:
                return  # a stray inline end tag closes no block

    def handle_data(self, data):
        if not self.open[-1].outside:
            self.parts.append(data)
            if self.links:
                self.linked += len(data.strip())

    def read(self, html: str) -> list[Line]:
        self.feed(html)
        self.close()
        self._end_line()
        if not self.comments:
            return self.lines
        return [x for x in self.lines if not self.comments.intersection(x.path)]


def smoothed(values: list[float]) -> list[float]:
    """Gaussian smoothing; at the ends over what there is."""
    weights = [math.exp(-(k * k) / (2 * SIGMA * SIGMA)) for k in range(-RADIUS, RADIUS + 1)]
    out = []
    for i in range(len(values)):
        pairs = [(w, values[j]) for w, j in zip(weights, range(i - RADIUS, i + RADIUS + 1), strict=True) if 0 <= j < len(values)]
        out.append(sum(w * v for w, v in pairs) / sum(w for w, _ in pairs))
    return out


def threshold(values: list[float]) -> float:
    """Halfway between the centres of two clusters of values."""
    low, high = min(values), max(values)
    for _ in range(50):
        cut = (low + high) / 2
        below, above = [v for v in values if v < cut], [v for v in values if v >= cut]
        new = (sum(below) / len(below) if below else low, sum(above) / len(above) if above else high)
        if new == (low, high):
            break
        low, high = new
    return (low + high) / 2


def _menus(lines: list[Line]) -> set[int]:
    """Runs of at least three list items that are all link."""
    out: set[int] = set()
    run: list[int] = []
    for i, x in enumerate([*lines, None]):
        if x and x.kind == "li" and x.linked >= 0.9 * len(x.text.replace(" ", "")):
            run.append(i)
            continue
        if len(run) >= 3:
            out.update(run)
        run = []
    return out


def _is_link(x: Line) -> bool:
    return x.linked >= 0.5 * len(x.text.replace(" ", ""))


def _extends(tag: str, parent: str, more: list[Line]) -> bool:
    """Whether a region in an element ``tag`` goes on to the parent, which adds the lines ``more``."""
    if tag in ("blockquote", "details") or not more:
        return True
    if tag in ("td", "th"):
        return any(not _is_link(x) and (x.kind or len(x.text.split()) > 2) for x in more)
    if parent in ("", "html", "body"):  # a site's name, an imprint or the like may stand here
        return all(x.kind in HEADINGS or (x.kind == "p" and not _is_link(x)) for x in more) and any(x.kind == "p" for x in more)
    return all(x.kind in HEADINGS or not _is_link(x) for x in more)


def _cleared(lines: list[Line], content: list[bool], names: list[str]) -> tuple[list[Line], list[bool]]:
    """The lines without doubtful elements that are not content."""
    held: dict[int, list[int]] = {}
    for i, x in enumerate(lines):
        for d in x.doubts:
            held.setdefault(d, []).append(i)
    gone: set[int] = set()
    for own in held.values():
        size = sum(len(lines[i].text) for i in own)
        links = sum(lines[i].linked for i in own) >= 0.5 * sum(len(lines[i].text.replace(" ", "")) for i in own)
        found = 2 * sum(len(lines[i].text) for i in own if content[i]) >= size
        if links or not (found or any(names[n] in ("article", "main") for n in lines[own[0]].path)):
            gone.update(own)
    if len(gone) == len(lines):
        return lines, content
    keep = [i for i in range(len(lines)) if i not in gone]
    return [lines[i] for i in keep], [content[i] for i in keep]


def _holders(lines: list[Line], content: list[bool], names: list[str]) -> set[int]:
    """The main element that holds most content, or all outermost articles that hold some."""
    mains: dict[int, int] = {}
    articles: set[int] = set()
    for x, c in zip(lines, content, strict=True):
        if c:
            for n in (n for n in x.path if names[n] == "main"):
                mains[n] = mains.get(n, 0) + len(x.text)
            articles.update([n for n in x.path if names[n] == "article"][:1])
    return {max(mains, key=mains.__getitem__)} if mains else articles


def main_text(html: str | None) -> str:
    page = Lines()
    lines = page.read(html or "")
    menus = _menus(lines)
    lines = [x for i, x in enumerate(lines) if i not in menus]
    if not lines:
        return ""
    ratio = smoothed([len(x.text) / x.tags for x in lines])
    cut = threshold(ratio)
    lines, marked = _cleared(lines, [r >= cut for r in ratio], page.names)
    holders = _holders(lines, marked, page.names)
    if holders:
        return " ".join(x.text for x in lines if holders.intersection(x.path))
    content = [i for i, c in enumerate(marked) if c] or list(range(len(lines)))
    content = [i for i in content if not _is_link(lines[i])] or content
    region = [n for n in lines[content[0]].path if all(n in lines[i].path for i in content)]
    while region:
        parent = region[-2] if len(region) > 1 else None
        more = [x for x in lines if region[-1] not in x.path and (parent is None or parent in x.path)]
        if not _extends(page.names[region[-1]], page.names[parent] if parent else "", more):
            break
        region.pop()
    return " ".join(x.text for x in lines if not region or region[-1] in x.path)


def extract_text(pages: DataFrame, html_col: str = "html", out_col: str = "text") -> DataFrame:
    """``pages`` with the main text of their html."""

    @F.pandas_udf("string")
    def extracted(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for html in batches:
            yield html.map(main_text, na_action=None).astype(object)

    return pages.withColumn(out_col, extracted(F.col(html_col)))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = extract_text(table(spark, sf_dir, "pages"))
    return out.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
