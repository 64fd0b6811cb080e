"""HTML extraction by two-pass block rules.

Pass 1 cuts the page into blocks and classifies each by itself: blocks in menus, headers,
footers, sidebars, forms, adverts, notices and comments, and blocks of links, are bad;
long blocks dense with stop words are good; the rest - short blocks, and long ones with
few stop words (lists, code, other languages) - stay undecided. In pass 2 undecided blocks inherit the label of the nearest
decided neighbours: the nearer of the two, bad if they are equally near and differ. The
edges of an article count as good neighbours of what is within it, and while a page has
an article, what lies outside is no main text.

Defined cases: NULL html is empty html and gives an empty text; markup that is never
closed ends with the page; a NULL id or url is passed on; repeated rows give repeated
results; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from watchtide.llm.common import chunks

STOP_WORDS = frozenset((
    "the of and to in a is that it was for on are as with be by at this from or an which not have has "
    "der die das und in zu den von mit ist im für auf nicht ein eine als auch es dem des sich werden aus "
    "le la les de des du et en un une que qui est dans pour par sur au avec ne pas il ce se "
    "el los las y del que en un una por con para es al lo como su no se").split())

LONG, DENSE = 70, 0.20  # characters; share of stop words
LINKED, LINKED_IN_ARTICLE = 0.34, 0.67  # shares of a block's characters within links

_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q s samp small "
                    "span strike strong sub sup time tt u var wbr".split())
_RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
_BAD_TAGS = frozenset("head nav footer aside form menu dialog noscript template select button object canvas svg audio video map "
                      "script style textarea title iframe".split())
_BAD_ROLES = frozenset("navigation banner contentinfo complementary search form menu menubar dialog alertdialog alert".split())
_BAD_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored sponsors promo promos promotion banner banners cookie cookies "
    "consent gdpr notice notices alert comment comments commentlist respond reply replies disqus discussion sidebar aside widget "
    "widgets menu menus nav navbar navigation breadcrumb breadcrumbs footer masthead topbar toolbar share sharing social "
    "newsletter subscribe subscription signup login popup modal overlay paywall related recommended recommendations pagination pager "
    "disclaimer copyright siteheader sitefooter pageheader pagefooter cookiebanner cookienotice adsbygoogle adbox adslot subnav "
    "sidenav topnav mainnav".split())
_CLOSES_P = frozenset("p div ul ol li dl table section article aside nav header footer form h1 h2 h3 h4 h5 h6 pre blockquote hr main".split())

_MARKUP = re.compile(r"""<(?:!--(?:.*?-->|.*\Z)|[!?][^>]*(?:>|\Z)|(/?)([a-zA-Z][^\s/>]*)((?>(?:[^>"']|"[^"]*"|'[^']*')*)|[^>]*)(?:>|\Z))""", re.S)
_ATTR = re.compile(r"""([a-zA-Z][\w:-]*)\s*(?:=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
_NAME_PARTS = re.compile(r"[^a-zA-Z]+")
_UNSEEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
_HUMPS = re.compile(r"(?<=[a-z])(?=[A-Z])")


@dataclass
class Block:
    parts: list[str] = field(default_factory=list)
    link_chars: int = 0
    bad: bool = False      # in a container that holds no main text
    article: int = 0       # number of the article it lies in; 0: none
    label: str = ""
    heir: str = ""         # label inherited in pass 2
    text: str = ""


def _names(value: str) -> set[str]:
    """Words of a class or id: parts of letters, and the humps of each."""
    parts = _NAME_PARTS.split(value)
    return {x.lower() for x in parts} | {x.lower() for p in parts for x in _HUMPS.split(p)}


def _marked_bad(tag: str, attrs: str, in_article: bool) -> bool:
    """Whether an element holds no main text, by its tag, names, role or being hidden."""
    if tag in _BAD_TAGS or tag == "header" and not in_article:
        return True
    if not attrs:
        return False
    for name, value in _ATTR.findall(attrs):
        name, value = name.lower(), value.strip("\"'")
        if name in ("class", "id") and tag not in ("html", "body", "main"):
            names = _names(value)
            if not _BAD_NAMES.isdisjoint(names) or "header" in names and not in_article:
                return True
        elif name == "role" and value.strip().lower() in _BAD_ROLES or name == "hidden" or name == "aria-hidden" and value.lower() == "true":
            return True
        elif name == "style" and _UNSEEN.search(value):
            return True
    return False


def blocks(page: str) -> list[Block]:
    """The page's blocks in order, with their text, links and surroundings."""
    out: list[Block] = []
    stack: list[tuple[str, bool, int]] = []  # open elements: tag, bad from here on, article
    solid: list[str] = []  # those of them that aren't inline
    open_tags: dict[str, int] = {}
    articles = links = at = 0
    current = Block()

    def end_block() -> None:
        nonlocal current
        if current.parts:
            out.append(current)
        bad, article = (stack[-1][1], stack[-1][2]) if stack else (False, 0)
        current = Block(bad=bad, article=article)

    def add(text: str) -> None:
        if text:
            current.parts.append(text)
            if links:
                current.link_chars += len("".join(text.split()))

    def pop(tag: str) -> None:
        nonlocal links
        while stack:
            top = stack.pop()[0]
            open_tags[top] -= 1
            if top not in _INLINE:
                solid.pop()
            links -= top == "a"
            if top == tag:
                break

    while at < len(page):
        m = _MARKUP.search(page, at)
        add(page[at:m.start()] if m else page[at:])
        if not m:
            break
        at = m.end()
        close, tag, attrs = m[1], (m[2] or "").lower(), m[3] or ""
        if not tag:
            continue
        if tag == "br":
            add(" ")
            continue
        breaks = tag not in _INLINE
        if close:
            if open_tags.get(tag):
                inside = stack[-1][1:]
                pop(tag)
                if breaks or inside != (stack[-1][1:] if stack else (False, 0)):
                    end_block()
            elif breaks:
                end_block()
            continue
        if tag in _CLOSES_P and solid and solid[-1] == "p":  # however many inline elements it holds
            pop("p")
        bad, article = (stack[-1][1], stack[-1][2]) if stack else (False, 0)
        marked = _marked_bad(tag, attrs, article > 0)
        if (tag == "article" or (tag == "main" or "articleBody" in attrs) and not article) and not (bad or marked):
            articles += 1
            article = articles
        if tag in _VOID or attrs.endswith("/") and breaks and tag not in ("p", "div", "article", "section"):
            if breaks:
                end_block()
            continue
        if tag in _RAW:
            end = re.compile(rf"</{tag}\b[^>]*(?:>|\Z)", re.I).search(page, at)
            at = end.end() if end else len(page)
            continue
        stack.append((tag, bad or marked, article))
        if breaks:
            solid.append(tag)
        open_tags[tag] = open_tags.get(tag, 0) + 1
        links += tag == "a"
        if breaks or marked:
            end_block()
    end_block()
    for b in out:
        b.text = " ".join(entities.unescape("".join(b.parts)).split())
    return [b for b in out if b.text]


def label_alone(b: Block) -> str:
    """Pass 1: good, bad, or empty for undecided."""
    chars = max(1, len(b.text.replace(" ", "")))
    linked = b.link_chars / chars
    if b.bad or linked > (LINKED_IN_ARTICLE if b.article else LINKED):
        return "bad"
    words = b.text.lower().split()
    stops = sum(w.strip(".,;:!?\"'()") in STOP_WORDS for w in words) / len(words)
    if len(b.text) >= LONG and stops >= DENSE:
        return "good"
    return ""


def _nearest(found: list[Block], order: range) -> list[tuple[str, int]]:
    """Per block the label of the last decided block in this order, and how far back it is.

    Entering an article counts as a good neighbour, leaving it as none. Blocks that are bad
    for where they stand say nothing of their surroundings.
    """
    out, label, far, article = [("", 0)] * len(found), "", 0, 0
    for i in order:
        b = found[i]
        if b.article != article:
            label, far, article = "good" if b.article else "", 0, b.article
        far += 1
        out[i] = (label, far)
        if b.label and not b.bad:
            label, far = b.label, 0
    return out


def inherit(found: list[Block]) -> None:
    """Pass 2: undecided blocks take the label of the nearest decided neighbour, good if there is none."""
    n = len(found)
    for b, (one, d1), (two, d2) in zip(found, _nearest(found, range(n)), _nearest(found, range(n - 1, -1, -1)), strict=True):
        if b.label:
            continue
        if not (one and two) or one == two:
            b.heir = one or two or "good"
        else:
            b.heir = (one if d1 < d2 else two) if d1 != d2 else "good" if b.article else "bad"
    for b in found:
        b.label = b.label or b.heir


def main_text(page: str | None) -> str:
    """The page's main text: its good blocks in order, joined by one space."""
    found = blocks(page or "")
    for b in found:
        b.label = label_alone(b)
    inherit(found)
    if any(b.article and b.label == "good" for b in found):
        found = [b for b in found if b.article]
    return " ".join(b.text for b in found if b.label == "good")


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text of every page."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in chunks(whole, "html"):
                text = [main_text(x) for x in b.column("html").to_pylist()]
                yield pa.RecordBatch.from_arrays([b.column("page_id"), b.column("url"), pa.array(text, pa.string())], ["page_id", "url", "text"])

    return (pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html")
            .mapInArrow(run, "page_id long, url string, text string"))


def op8_extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars."""
    return extract(pages).withColumn("n_chars", F.char_length("text").cast("long"))
