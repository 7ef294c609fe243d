"""Main text of web pages by tag-path ratios.

A page is cut into blocks of text, each with the path of block elements from the root to it. Text
length, punctuation and length in links are added up per path: in running text, paths hold much
text and punctuation in each of few kinds of nodes, whereas menus and notices hold little. Lengths
and punctuation per node are smoothed over neighbouring paths, fused by multiplication, and
paths above a threshold give the content. An <article> or <main> around the best path bounds the article,
else the lowest element around all content does; the title ahead of it belongs to it.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from html import unescape
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

# Fixed values of HTML: elements without content of their own, elements within a line of text,
# those whose content is not text, and those that never hold the article.
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var wbr br img nobr".split()
)
_SILENT = "script|style|noscript|template|svg|math|iframe|object|canvas|title|textarea|select"
# Silent elements that hold nothing but characters: without an end tag they reach to the end of the head or page.
_RAW = frozenset("script style iframe textarea".split())
_APART = frozenset("nav header footer aside form menu dialog button fieldset".split())
# Elements whose names tell what they hold; ids and classes of headings and text blocks are not looked at.
_CONTAINERS = frozenset("div section center ul ol dl table".split())
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# Elements within an article that do not bound it, however much of its text they hold.
_WITHIN = _HEADINGS | frozenset("p li dt dd tr pre blockquote ul ol dl table thead tbody tfoot caption figure figcaption".split())
# A start tag of these ends an open paragraph, list item, cell and so on.
_CLOSES = {
    "p": "address article aside blockquote details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split(),
    "li": ["li"], "dt": ["dt", "dd"], "dd": ["dt", "dd"], "td": ["td", "th", "tr"], "th": ["td", "th", "tr"], "tr": ["tr"], "option": ["option"],
}
_ATTRIBUTES = r"((?:\"[^\"]*\"|'[^']*'|[^'\">])*+)(?:>|\Z)"
_TAG = re.compile(
    rf"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<({_SILENT})(?=[\s/>]){_ATTRIBUTES}|<(/?)([a-z][a-z0-9:-]*){_ATTRIBUTES}",
    re.S | re.I,
)
_END = {name: re.compile(rf"</{name}(?=[\s/>])[^>]*(?:>|\Z)", re.I) for name in _SILENT.split("|")}
_HEAD_END = re.compile(r"(?=</head[\s>]|<body[\s/>])|\Z", re.I)
# Tags that end an svg or math element which is still open.
_BREAKOUT = re.compile(
    r"(?=</?(?:article|aside|blockquote|body|center|dd|div|dl|dt|footer|h[1-6]|header|hr|li|main|nav|ol|p|pre|section|table|ul)[\s/>])|\Z", re.I
)
_NAMES = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_CLASS_OR_ROLE = re.compile(r"(?<![\w-])(?:class|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_CLASS = re.compile(r"(?<![\w-])class\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
# Words in class, id and role that hint at what is not the article.
_MARKED = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|banner\w*|cookies?|consent|notices?|notification\w*|alerts?|popups?|modals?|overlay|"
    r"newsletter\w*|subscri\w*|promo\w*|sponsor\w*|social|shar(?:e|ing)\w*|sidebar\w*|menus?|nav\w*|breadcrumbs?|"
    r"header|masthead|footer\w*|comments?|commentlist|respond|repl(?:y|ies)|disqus|related|recommend\w*|widgets?|"
    r"login|signup|signin|search\w*|pagination|pager|toolbar|copyright|legal|disclaimer|tags|metadata|byline|hidden|complementary|contentinfo|navigation)(?:$|[\s_-])",
    re.I,
)
# Names that are nothing but a word for comments, notices or adverts and words for parts of a page. Fixed values.
_AWAY = re.compile(
    r"(?:comments?|commentlist|commentary|disqus|respond|replies|cookies?|consent|gdpr|ads?|adverts?|advertisements?|sponsors?|sponsored|"
    r"promos?|promotions?|banners?|newsletters?|popups?|modals?|sidebars?|paywall|notifications?)"
    r"(?:[-_](?:list|section|area|box|thread|form|wrap|wrapper|container|block|notice|banner|bar|consent|popup|slot|unit|inner|outer|"
    r"body|content|items?|holder|panel|widget|message|text|left|right|top|bottom|inline|links?|\d+))*",
    re.I,
)
_PUNCTUATION = re.compile(r"[.,;:!?…。，！？]")
# A path is content from this part of the best path's score on.
THRESHOLD = 0.1
# A class or role that is nothing but a listed word lowers a container's score to this part.
_LOWERED = 0.1
# So many blocks of links in a row are a menu; fewer are cited links.
_MENU = 3


def _silent_end(html: str, name: str, attributes: str, at: int, unclosed: set[str]) -> int:
    """Where the silent element ends whose start tag ends at ``at``.

    ``unclosed`` gathers names without a further end tag, so that each is looked for in vain once.
    """
    if name in ("svg", "math") and attributes.endswith("/"):
        return at
    end = None if name in unclosed else _END[name].search(html, at)
    if end:
        return end.end()
    unclosed.add(name)
    if name in _RAW:
        return _HEAD_END.search(html, at).end()
    if name in ("svg", "math"):
        return _BREAKOUT.search(html, at).end()
    if name == "title":
        return len(html) if (to := html.find("<", at)) < 0 else to
    return at


class Block(NamedTuple):
    """Elements from the root have a name in paths, tag and class, and a number of their own."""

    path: tuple[str, ...]
    nodes: tuple[int, ...]
    text: str
    linked: int  # characters in links
    apart: bool
    suspect: int = 0  # number of the outermost container with a marked name, negative if its class or role is just that
    away: int = 0  # number of the outermost container or paragraph whose name says comments, a notice or an advert

    def tag(self, k: int) -> str:
        return self.path[k].split(".")[0]

    @property
    def heading(self) -> bool:
        return bool(self.path) and self.tag(-1) in _HEADINGS


def blocks(html: str) -> list[Block]:
    """Every block in page order."""
    stack: list[tuple[str, str, int, bool, int, int]] = []  # tag, name in paths, number, whether it is set apart, suspect, away
    found: list[Block] = []
    number = 0
    pieces: list[str] = []
    linked = [0]

    def text(raw: str) -> None:
        if raw:
            plain = unescape(raw)
            pieces.append(plain)
            if any(tag == "a" for tag, *_ in stack):
                linked[0] += len(" ".join(plain.split()))

    def flush() -> None:
        joined = " ".join("".join(pieces).split())
        if joined:
            held = [x for x in stack if x[0] not in _INLINE]
            marks = (next((x[k] for x in stack if x[k]), 0) for k in (4, 5))
            found.append(Block(tuple(x[1] for x in held), tuple(x[2] for x in held), joined, linked[0], any(x[3] for x in stack), *marks))
        pieces.clear()
        linked[0] = 0

    at = 0
    unclosed: set[str] = set()
    while m := _TAG.search(html, at):
        text(html[at : m.start()])
        at = m.end()
        tag = (m[4] or "").lower()
        if m[1]:
            pieces.append(" ")
            at = _silent_end(html, m[1].lower(), m[2], at, unclosed)
        if not tag:
            continue
        if tag == "br":
            pieces.append(" ")
        if tag not in _INLINE:
            flush()
        if tag == "head":
            continue  # what it may hold is silent or void; anything else ends it, with or without </head>
        if m[3]:
            opened = [t for t, *_ in stack]
            if tag in opened:
                k = len(opened) - 1 - opened[::-1].index(tag)
                # An inline end tag does not end the blocks around it.
                if tag not in _INLINE or all(t in _INLINE for t in opened[k:]):
                    del stack[k:]
        elif tag not in _VOID:
            for k in range(len(stack) - 1, -1, -1):
                inner = stack[k][0]
                if tag in _CLOSES.get(inner, ()):
                    del stack[k:]
                    break
                if inner not in _INLINE and inner not in _CLOSES:
                    break
            names = " ".join(a or b or c for a, b, c in _NAMES.findall(m[5] or ""))
            # The heading of an article belongs to it.
            apart = tag in _APART and not (tag == "header" and any(t in ("article", "main") for t, *_ in stack))
            if tag in ("article", "main"):
                # What holds an article is no advert, whatever its name.
                stack[:] = [(*x[:4], 0, 0) for x in stack]
            if not m[5].endswith("/") or tag not in _INLINE:
                # Ids differ between like elements, so paths go by class.
                kind = " ".join(a or b or c for a, b, c in _CLASS.findall(m[5] or ""))
                number += 1
                suspect = number if tag in _CONTAINERS and _MARKED.search(names) else 0
                # An id may be made of a heading's words, and so may a part of a class.
                if suspect and any(_MARKED.fullmatch(x) for y in _CLASS_OR_ROLE.findall(m[5]) for x in "".join(y).split()):
                    suspect = -suspect
                away = number if (tag in _CONTAINERS or tag == "p") and any(_AWAY.fullmatch(x) for x in names.split()) else 0
                stack.append((tag, f"{tag}.{kind}" if kind else tag, number, apart, suspect, away))
    text(html[at:] if not html[at:].startswith("<") else "")
    flush()
    return found


def _common(a: tuple[int, ...], b: tuple[int, ...]) -> tuple[int, ...]:
    n = next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
    return a[:n]


def _title(page: list[Block], first: int, inside: Callable[[Block], bool]) -> int | None:
    """The title ahead of block ``first``: the last h1, or else a heading just ahead of it."""
    ahead = [k for k in range(first) if page[k].heading and (not page[k].suspect or (page[k].suspect > 0 and inside(page[k])))]
    top = [k for k in ahead if page[k].tag(-1) == "h1"]
    return top[-1] if top else ahead[-1] if ahead and ahead[-1] == first - 1 else None


def _ratio(some: list[Block]) -> float:
    """Text per block, raised by its punctuation and lowered by links."""
    chars, marks = sum(len(b.text) for b in some), sum(len(_PUNCTUATION.findall(b.text)) for b in some)
    return chars / len(some) * (1 + marks / len(some)) * (1 - sum(b.linked for b in some) / chars)


def _menus(page: list[Block]) -> list[bool]:
    """Blocks of a list, or of a run of blocks, that is mostly links; headings are never among them."""
    lists: dict[int, list[int]] = {}
    for b in page:
        k = next((k for k in range(len(b.path) - 1, -1, -1) if b.tag(k) in ("ul", "ol", "dl")), None)
        if k is not None:
            both = lists.setdefault(b.nodes[k], [0, 0])
            both[0] += b.linked
            both[1] += len(b.text)
    dense = [b.linked >= 0.9 * len(b.text) and not b.heading for b in page]
    menu = [False] * len(page)
    at = 0
    while at < len(page):
        to = at
        while to < len(page) and dense[to]:
            to += 1
        for k in range(at, to):
            menu[k] = to - at >= _MENU or any(n in lists and lists[n][0] >= 0.9 * lists[n][1] for n in page[k].nodes)
        at = max(to, at + 1)
    return menu


def path_scores(page: list[Block]) -> dict[tuple[str, ...], float]:
    """Score of each path, in the order of their first blocks."""
    index: dict[tuple[str, ...], int] = {}
    rows = np.array([[index.setdefault(b.path, len(index)), len(b.text), len(_PUNCTUATION.findall(b.text)), b.linked] for b in page])
    nodes = np.bincount(rows[:, 0]).astype(float)
    chars, marks, links = (np.bincount(rows[:, 0], rows[:, c]) for c in (1, 2, 3))
    # Paths in the order of their first nodes; neighbours lend each other a little.
    smooth = lambda x: np.convolve(np.pad(x, 1, mode="edge"), [0.1, 0.8, 0.1], "valid")
    # The share of the page's text weighs a path that carries the article against one long notice.
    fused = smooth(chars / nodes) * (1 + smooth(marks / nodes)) * (1 - links / chars) * np.sqrt(chars / chars.sum())
    return dict(zip(index, fused.tolist()))


def main_text(html: str | None) -> str:
    """The article's blocks joined by blank lines; empty if there are none.

    Containers with a marked name do not count in the search for the article. Within it they are
    kept if their own text is like its text. What is named as comments, a notice or an advert goes, as
    long as a path above the threshold is left without it.
    """
    full = [b for b in blocks(html or "") if not b.apart]
    page = [b for b in full if not b.suspect] or full
    if not page:
        return ""
    scores = path_scores(page)
    best = max(scores, key=scores.get)
    if scores[best] <= 0:
        return ""
    chosen = [scores[b.path] >= THRESHOLD * scores[best] for b in page]
    marked = [k for k, name in enumerate(best) if name.split(".")[0] in ("article", "main")]
    if marked:
        # Within the article's element all running text belongs to it, headings and short lines too.
        around = best[: marked[-1] + 1]
        inside = lambda b: b.path[: len(around)] == around
        kept = [inside(b) for b in page]
    else:
        picked = [b for b, c in zip(page, chosen) if c]
        root = picked[0].nodes
        for b in picked:
            root = _common(root, b.nodes)
        while root and picked[0].tag(len(root) - 1) in _WITHIN:
            root = root[:-1]
        # Body and html bound nothing; there only the content and headings are kept, and what
        # shares an element with the content.
        bounded = bool(root) and picked[0].tag(len(root) - 1) not in ("html", "body")
        homes = {b.nodes[:-1] for b in picked if len(b.nodes) > 1 and b.tag(-2) not in ("html", "body")}
        inside = lambda b: bounded and b.nodes[: len(root)] == root
        kept = [inside(b) or c or (b.heading and b.nodes[: len(root)] == root) or b.nodes[:-1] in homes for b, c in zip(page, chosen)]
    groups: dict[int, list[Block]] = {}
    for b in full:
        groups.setdefault(b.suspect, []).append(b)
    like = _ratio([b for b in page if b.path == best]) * THRESHOLD
    alike = {s for s, some in groups.items() if s and _ratio(some) * (_LOWERED if s < 0 else 1) >= like}
    taken = iter(kept)
    kept = [next(taken) if page is full or not b.suspect else inside(b) and b.suspect in alike for b in full]
    kept = [k and not menu for k, menu in zip(kept, _menus(full))]
    running = {b.path for b, c in zip(page, chosen) if c and not b.heading}
    if any(k and not b.away and b.path in running for b, k in zip(full, kept)):
        kept = [k and not b.away for b, k in zip(full, kept)]
    if any(kept):
        first = kept.index(True)
        title = _title(full, first, inside)
        if title is not None and not (full[first].heading and full[first].tag(-1) == "h1"):
            kept[title] = True
    return "\n\n".join(b.text for b, k in zip(full, kept) if k)


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars), one row per row of ``pages``.

    A null or empty page, and one without running text, has an empty text. Unclosed elements,
    cut-off pages and unknown character references are taken as browsers take them, roughly. Rows
    that repeat an id are separate; an empty table gives an empty table; other columns are ignored.
    """
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).cast("string").alias("html"))
    kinds = ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in ("page_id", "url"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(h) for h in batch.column("html").to_pylist()]
            columns = [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
            yield pa.record_batch(columns, names=["page_id", "url", "text", "n_chars"])

    return rows.mapInArrow(run, f"{kinds}, text string, n_chars long")
