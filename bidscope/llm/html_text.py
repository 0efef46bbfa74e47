"""The main text of a page by line-block distribution.

Markup is stripped so that every block element is one line. What stands in an element that is no part of an
article (menus, page headers, footers, sidebars, notices, adverts, forms, comments: told by tag, role, class or id) leaves
a gap of empty lines, and so do a line that is mostly links and the edge of a container. Text lengths are summed over a window of
``WINDOW`` lines: text begins to be kept where a sum surges from zero, and ends where it dives to zero again. A stretch
between surge and dive is kept if its highest sum reaches ``SURGE``; where none is high enough, the highest one is kept.
A lower stretch stays too if it stands in the same container as a kept one. A page's article mark is a weight: of
the stretches inside and outside of it, those with more text decide, and text inside counts ``MARKED`` times.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bidscope.llm.common import A_TO_Z, table

WINDOW = 3
#: About a line of print: ``WINDOW`` labels or captions in a row stay below it, a sentence or two reach it.
SURGE = 86
LINKS = 0.6
MARKED = 2

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']++|\"[^\"]*\"|'[^']*')*+)>"
    r"|<[/!?]?[a-zA-Z!?/][^>]*>|[^<]+|<",
    re.S,
)
_ATTR = re.compile(r"(?:^|\s)(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_RAW = frozenset("script style noscript template title textarea svg iframe object select canvas audio video math".split())
_APART = frozenset("nav header footer aside form button menu dialog".split())
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q s samp small span strike "
    "strong sub sup time tt u var wbr".split()
)
_HOLDS = frozenset("div section".split())
_SPACE = frozenset("br td th".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Parts of class, id and role names that mark what is no part of an article.
_MARKS = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs combobox comment comments consent "
    "contentinfo cookie cookies disqus footer gdpr header login masthead menu modal nav navbar navigation "
    "newsletter notice notices pagination popup promo related reply replies respond search share sharing sidebar signup "
    "social sponsor sponsored subscribe toolbar widget".split()
)
#: Lower case for tag names, which keeps every place in the page; ``str.lower`` makes some letters two.
_LOWER = str.maketrans(A_TO_Z, A_TO_Z.lower())
#: Marks that are ordinary words too; as the first part of a name they count before one of ``_LISTS`` only.
_WORDS = frozenset("login notice notices promo related replies reply respond search share sharing signup social subscribe".split())
_LISTS = frozenset(
    "area articles bar block box buttons container content entries form icons items links list news panel posts products "
    "section stories topics widget wrap wrapper".split()
)
_HEADERS = frozenset("header masthead".split())
#: First parts of names that tell of what else there is.
_ABOUT = frozenset("has hide is no show with without".split())
_TALK = frozenset("comment comments disqus replies reply respond".split())
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


def _marks(names: str, in_article: bool) -> bool:
    """Whether a class, id or role says that the element itself is no part of an article.

    A name does whose last part is a mark, or whose first is one and no ordinary word as well. Inside an article such
    words say nothing, and headers are its own.
    """
    for name in names.split():
        parts = [part.lower() for part in _PARTS.findall(name)]
        if not parts or parts[0] in _ABOUT:
            continue
        first, last = parts[0], parts[-1]
        if in_article and (last in _HEADERS or len(parts) == 1 and last in _WORDS):
            continue
        if last in _MARKS or first in _MARKS and (first not in _WORDS or last in _LISTS):
            return True
    return False


def _apart(tag: str, attrs: str, in_article: bool) -> bool:
    if tag in _APART:
        return not (tag == "header" and in_article)
    if not attrs or tag in ("body", "html", "article", "main") and "comment" not in attrs.lower():
        return False
    return _marks(_names(attrs), in_article)


def _names(attrs: str) -> str:
    return " ".join(next(g for g in found if g) if any(found) else "" for found in _ATTR.findall(attrs))


class _Page:
    """The tokens of a page, with the end of every element and running totals of text and article marks.

    All of it is one walk: an element's end tag is found by a stack for each tag, and how much an element holds is the
    difference of two totals.
    """

    def __init__(self, page: str) -> None:
        self.tokens: list[re.Match[str]] = []
        #: Per token the token that ends its element, or -1.
        self.ends: list[int] = []
        #: Characters of text, and article marks, before each token.
        self.texts, self.marks = [0], [0]
        lower, at = page.translate(_LOWER), 0
        waiting: dict[str, list[int]] = {}
        while found := _TOKEN.match(page, at):
            at, tag, text, mark = found.end(), found["tag"], 0, 0
            number = len(self.tokens)
            self.tokens.append(found)
            self.ends.append(-1)
            if tag is None:
                if found[0][0] != "<" or len(found[0]) == 1:
                    text = len("".join(found[0].split()))
            else:
                tag = tag.lower()
                if found["end"]:
                    if waiting.get(tag):
                        self.ends[waiting[tag].pop()] = number
                elif tag not in _VOID:
                    waiting.setdefault(tag, []).append(number)
                    mark = tag in ("article", "main") and "comment" not in found["attrs"].lower()
                    if tag in _RAW and not found["attrs"].endswith("/"):
                        # What is in there is no markup.
                        stop = lower.find(f"</{tag}", at)
                        at = at if stop < 0 else stop
            self.texts.append(self.texts[-1] + text)
            self.marks.append(self.marks[-1] + mark)

    def holds_main(self, number: int, stop: int) -> bool:
        """Whether an element told by its class holds all the page's article marks, or most of its text; comments may."""
        found = self.tokens[number]
        if found["tag"].lower() in _APART or {part.lower() for part in _PARTS.findall(_names(found["attrs"]))} & _TALK:
            return False
        marks = self.marks[stop] - self.marks[number + 1]
        if marks and marks == self.marks[-1]:
            return True
        return 2 * (self.texts[stop] - self.texts[number + 1]) > self.texts[-1]


def _lines(page: str) -> list[tuple[str, int, bool, bool, int, bool]]:
    """Per line its raw text, the characters in links, whether it is in an article, whether it follows a gap, its container, whether it is a heading.

    Containers are numbered; all of an article is one, and one that holds a single line and no other is its parent's.
    """
    out: list[tuple[str, int, bool, bool, int, bool]] = []
    text: list[str] = []
    links = article = anchors = opened = 0
    inside: list[int] = [0]
    #: Per container its parent, and what it holds: lines and containers.
    parents, held = {0: 0}, {0: 2}
    gap = heading = False
    walk = _Page(page)

    def close() -> None:
        nonlocal links, gap
        if any(not piece.isspace() for piece in text):
            out.append(("".join(text), links, article > 0, gap, inside[-1], heading))
            held[inside[-1]] = held.get(inside[-1], 0) + 1
            gap = False
        text.clear()
        links = 0

    def enter() -> None:
        nonlocal opened
        opened += 1
        parents[opened] = inside[-1]
        held[inside[-1]] = held.get(inside[-1], 0) + 2
        inside.append(opened)

    number = -1
    while (number := number + 1) < len(walk.tokens):
        found = walk.tokens[number]
        tag = found["tag"]
        if tag is None:
            piece = found[0]
            if piece[0] != "<" or len(piece) == 1:
                text.append(piece)
                links += len(piece.strip()) if anchors else 0
            elif piece.startswith("<![CDATA["):
                text.append(piece[9:].removesuffix("]]>"))
            continue
        tag, attrs, ends = tag.lower(), found["attrs"], bool(found["end"])
        if tag in _INLINE:
            if tag == "a":
                anchors = 0 if ends else 1
            if ends or tag in _VOID or not _apart(tag, attrs, article > 0):
                continue
        elif tag in _SPACE:
            text.append(" ")
            continue
        else:
            close()
            anchors = 0
            heading = tag in _HEADINGS and not ends
        if tag in ("article", "main") and not _apart(tag, attrs, False):
            article = max(0, article + (-1 if ends else 1))
            if article == (0 if ends else 1):
                opened += 1
                parents[opened], held[opened] = 0, 2
                inside = inside[:1] + [opened] if article else [opened]
            continue
        if tag in _HOLDS and not article and ends:
            del inside[max(1, len(inside) - 1) :]
        elif not ends and tag not in _VOID and not attrs.endswith("/"):
            if tag not in _RAW and _apart(tag, attrs, article > 0):
                stop = walk.ends[number]
                if stop > 0 and not walk.holds_main(number, stop):
                    close()
                    number, gap = stop, True
                    continue
            if tag in _HOLDS and not article:
                enter()
    close()
    alone = {holder for holder, count in held.items() if count == 1}
    return [(t, n, m, g, parents[c] if c in alone else c, h) for t, n, m, g, c, h in out]


def main_text(page: str | None) -> str:
    """The kept lines, character references decoded and white space single, joined by line breaks."""
    lines = [(" ".join(html.unescape(t).split()), *rest) for t, *rest in _lines(page or "")]
    lengths, texts, places = [], [], []
    before = None
    for text, links, marked, gap, holder, heading in lines:
        if not text:
            continue
        plain = marked or links < LINKS * len(text)
        # A gap also at the edge of an article, so that a stretch is wholly inside or outside, and of a container, but not
        # behind a heading.
        apart = WINDOW if gap or before and (before[0] != marked or before[1] != holder and not before[2]) else 0
        after = 0 if plain else WINDOW
        before = (marked, holder, heading)
        lengths += [0] * apart + [len(text) if plain else 0] + [0] * after
        texts += [""] * apart + [text if plain else ""] + [""] * after
        places += [(marked, holder)] * (apart + 1 + after)
    if not any(lengths):
        return ""
    sums = np.convolve(lengths, np.ones(WINDOW, dtype=np.int64))[: len(lengths)]  # each line with those before it
    full = np.r_[0, (sums > 0).astype(np.int8), 0]
    surges, dives = np.flatnonzero(np.diff(full) == 1), np.flatnonzero(np.diff(full) == -1)
    stretches = [(a, b, int(sums[a:b].max()), places[a][0]) for a, b in zip(surges, dives)]
    mass = {side: sum(sum(lengths[a:b]) for a, b, _, s in stretches if s == side) for side in (True, False)}
    side = MARKED * mass[True] >= mass[False] and mass[True] > 0
    stretches = [stretch for stretch in stretches if stretch[3] == side]
    least = min(SURGE, max(height for _, _, height, _ in stretches))
    held = {places[i] for a, b, height, _ in stretches if height >= least for i in range(a, b) if texts[i]}
    kept = [(a, b) for a, b, h, _ in stretches if h >= least or any(places[i] in held for i in range(a, b) if texts[i])]
    return "\n".join(t for a, b in kept for t in texts[a:b] if t)


def _extract(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        texts = [main_text(page) for page in batch["page"]]
        yield pd.DataFrame(
            {"page_id": batch["page_id"].astype("Int64"), "url": batch["url"], "text": texts, "n_chars": [len(t) for t in texts]}
        )


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``page_id, url, text, n_chars`` of every row, in one pass without a shuffle.

    A null or empty page, and one without text, has an empty text. Null ids and urls and repeated rows stay. An
    empty table gives no rows. Other columns are not read.
    """
    rows = pages.select(
        F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("page")
    )
    return rows.mapInPandas(_extract, "page_id long, url string, text string, n_chars long")


def op1_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))
