"""Main text of web pages by tag-path ratios.

A page is read into blocks: runs of text between the starts and ends of block elements, each with
its path of block tags from the root. What can't be an article is set aside: scripts, styles, forms,
navigation, headers outside the article, footers, asides, and elements whose class, id or role names
such a part (menu, advert, notice, comments and the like). Of the rest, each path gets two ratios: characters
outside links, and punctuation marks, for each of its blocks. Both are smoothed over neighbouring blocks,
weighted by how alike their paths are, fused by their geometric mean, and the paths that reach the standard
deviation of the page's blocks are chosen.

The chosen blocks say where the article is. If most of their text lies in one ``article`` or ``main``
element, its blocks are the main text; else those from the first chosen block, with headings right before
it, to the last one, in the innermost ``div`` or the like that has nearly all chosen text. Lists that are nearly all links are menus and stay out. Nothing else is dropped.

Defined cases: null or empty html, and pages of nothing but set-aside parts, give an empty text; if
names alone would set all of a page aside, names don't count on it; unclosed comments and scripts
reach to the end of the page; repeated rows give a row each; other columns aren't read. White space is what
``str.split`` takes for it, after decoding character references, so it includes no-break spaces.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import arrow_map, slices

#: Blocks on each side that a ratio is smoothed over, and the width of the Gaussian.
RADIUS, WIDTH = 2, 1.0
#: Tags at the leaf end by which two paths are compared.
COMPARED = 32
#: A list with so large a part of its text in links is a menu.
MENU_SHARE = 0.8
#: Without ``article`` and ``main``, the article is in the innermost of these that has so much of the chosen text.
HOLDERS, HELD_SHARE = frozenset("body div section td center".split()), 0.9
PUNCTUATION = ".,;:!?…、。，！？"

VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
RAW = frozenset("script style textarea title iframe xmp noembed noframes".split())
HEADINGS = frozenset(f"h{n}" for n in range(1, 7))
BLOCKS = HEADINGS | frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "head header hgroup hr html legend li main menu nav noscript ol optgroup option p pre search section select summary table tbody "
    "td template tfoot th thead tr ul textarea title iframe".split()
)
LISTS = frozenset("ul ol menu dir dl".split())
#: Elements that are never part of an article.
APART = frozenset(
    "script style noscript template title textarea iframe xmp noembed noframes svg canvas object audio video nav footer aside form "
    "button select option optgroup datalist dialog menu search".split()
)
#: Words in classes, ids and roles that name parts apart from the article.
NAMES = frozenset(
    "ad ads advert adverts advertisement advertising adsense adslot sponsor sponsored promo promotion banner nav navbar navigation menu "
    "breadcrumb breadcrumbs pagination pager toolbar toc sidebar aside complementary widget widgets header masthead footer contentinfo "
    "copyright legal disclaimer cookie cookies consent gdpr notice notification alert popup modal overlay dialog newsletter subscribe "
    "subscription signup signin login search form related recommended recommendations share sharing social comment comments "
    "commentlist reply replies respond responses disqus discussion".split()
)
#: What a start tag ends: the open element of these, unless one of the second set lies above it.
ENDS = {
    "li": (("li",), LISTS),
    "dt": (("dt", "dd"), ("dl",)),
    "dd": (("dt", "dd"), ("dl",)),
    "tr": (("tr", "td", "th"), ("table",)),
    "td": (("td", "th"), ("table", "tr")),
    "th": (("td", "th"), ("table", "tr")),
    "thead": (("thead", "tbody", "tfoot"), ("table",)),
    "tbody": (("thead", "tbody", "tfoot"), ("table",)),
    "tfoot": (("thead", "tbody", "tfoot"), ("table",)),
    "option": (("option",), ("select", "datalist")),
    "a": (("a",), BLOCKS),
}
_P_STAYS = frozenset("td th li button caption dd dt option optgroup summary legend tr tbody thead tfoot body html head".split())
_IN_HEAD = frozenset("base link meta noscript script style template title".split())
_TAG = re.compile(r"</?[a-zA-Z][^\s/>]*")
_ATTRIBUTE = re.compile(r"""[\s/]*([^\s/>=][^\s/>=]*)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"'][^\s>]*)?))?""")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden")
_WORDS = re.compile(r"[a-z]+")

FOUND = "page_id bigint, url string, text string, n_chars bigint, n_blocks int"


@dataclass
class Block:
    element: int
    path: int
    text: str
    links: int  # characters inside links
    marks: int  # punctuation marks
    heading: bool


@dataclass
class Page:
    """Elements in page order, parents before children, and the blocks of text. Element 0 and path 0 are the root."""

    parent: list[int] = field(default_factory=lambda: [0])
    tag: list[str] = field(default_factory=lambda: [""])
    linked: list[bool] = field(default_factory=lambda: [False])  # inside a link
    muted: list[bool] = field(default_factory=lambda: [False])  # inside an inline part that is no text of the block around it
    hidden: list[bool] = field(default_factory=lambda: [False])
    named: list[bool] = field(default_factory=lambda: [False])
    core: list[bool] = field(default_factory=lambda: [False])  # holds the page's main heading or main element
    paths: list[tuple[int, str]] = field(default_factory=lambda: [(0, "")])
    blocks: list[Block] = field(default_factory=list)


def _attributes(html: str, at: int) -> tuple[int, dict[str, str]]:
    """Attributes from ``at`` on, and the place after the tag's ``>``."""
    found: dict[str, str] = {}
    while True:
        m = _ATTRIBUTE.match(html, at)
        if not m:
            stop = html.find(">", at)
            return (len(html) if stop < 0 else stop + 1), found
        found.setdefault(m[1].lower(), m[2] or m[3] or m[4] or "")
        at = m.end()


def tokens(html: str) -> Iterator[tuple[str, str, dict[str, str]]]:
    """``(kind, value, attributes)``: kind is text, open or close; comments, declarations and raw contents are left out."""
    at, size = 0, len(html)
    while at < size:
        start = html.find("<", at)
        if start < 0:
            yield "text", html[at:], {}
            return
        m = _TAG.match(html, start)
        if not m and html[start + 1 : start + 2] not in ("!", "?", "/"):
            yield "text", html[at : start + 1], {}
            at = start + 1
            continue
        if start > at:
            yield "text", html[at:start], {}
        if not m:
            end = "-->" if html.startswith("<!--", start) else ">"
            stop = html.find(end, start + 2)
            at = size if stop < 0 else stop + len(end)
            continue
        at, attributes = _attributes(html, m.end())
        name = m[0].lstrip("</").lower()
        if m[0][1] == "/":
            yield "close", name, {}
            continue
        yield "open", name, attributes
        if name in RAW:
            end = re.compile(rf"</{name}(?=[\s/>])", re.IGNORECASE).search(html, at)
            at = end.start() if end else size


def _parts(names: str) -> bool:
    return not NAMES.isdisjoint(_WORDS.findall(names.lower()))


def read_page(html: str) -> Page:
    """Elements and blocks of a page, with end tags implied as HTML has it."""
    page = Page()
    stack, paths = [0], [0]  # open elements, and the path of each
    numbers: dict[tuple[int, str], int] = {}
    run: list[str] = []
    links = 0

    def flush() -> None:
        nonlocal links
        text = " ".join("".join(run).split())
        if text:
            block = next(e for e in reversed(stack) if not e or page.tag[e] in BLOCKS)
            heading = page.tag[block] in HEADINGS
            page.blocks.append(Block(block, paths[-1], text, min(links, len(text)), sum(map(text.count, PUNCTUATION)), heading))
        run.clear()
        links = 0

    def pop(to: int) -> None:
        """Close all from the stack's place ``to`` on."""
        if any(page.tag[e] in BLOCKS for e in stack[to:]):
            flush()
        del stack[to:], paths[to:]

    def close_open(tags: tuple[str, ...], stops) -> None:
        for place in range(len(stack) - 1, 0, -1):
            tag = page.tag[stack[place]]
            if tag in stops and tag not in tags:
                return
            if tag in tags:
                pop(place)
                return

    for kind, value, attributes in tokens(html):
        if kind == "text":
            if page.muted[stack[-1]]:
                continue
            text = unescape(value) if "&" in value else value
            run.append(text)
            if page.linked[stack[-1]]:
                links += len(" ".join(text.split()))
        elif kind == "close":
            if value == "br" or value in VOID:
                run.append(" ")
                continue
            for place in range(len(stack) - 1, 0, -1):
                tag = page.tag[stack[place]]
                if tag == value:
                    if value in BLOCKS:
                        pop(place)
                    else:  # blocks inside stay open
                        del stack[place], paths[place]
                    break
                if tag in BLOCKS and value not in BLOCKS or tag in ("td", "th", "table") and value in HEADINGS | {"p", "li", "div"} and tag != value:
                    break
        else:
            if page.tag[stack[-1]] == "head" and value not in _IN_HEAD:
                pop(len(stack) - 1)
            if value in ENDS:
                close_open(*ENDS[value])
            elif value in BLOCKS and value not in _P_STAYS and value not in RAW:
                close_open(("p",), BLOCKS - {"p"})
            elif value in ("body", "html") and any(page.tag[e] == value for e in stack):
                continue
            if value in BLOCKS:
                flush()
            elif value in VOID:
                run.append(" ")
            if value in VOID:
                continue
            element, above = len(page.tag), stack[-1]
            names = " ".join(attributes.get(a, "") for a in ("class", "id", "role"))
            page.parent.append(above)
            page.tag.append(value)
            page.linked.append(value == "a" or page.linked[above])
            unseen = "hidden" in attributes or attributes.get("aria-hidden") == "true" or bool(_HIDDEN.search(attributes.get("style", "")))
            page.hidden.append(unseen)
            page.named.append(value not in ("html", "body", "main", "code", "pre") and bool(names.strip()) and _parts(names))
            page.core.append(False)
            if value in ("h1", "main"):
                while element and not page.core[element]:
                    page.core[element] = True
                    element = page.parent[element]
                element = len(page.tag) - 1
            stack.append(element)
            path = paths[-1]
            if value in BLOCKS:
                path = numbers.setdefault((path, value), len(page.paths))
                if path == len(page.paths):
                    page.paths.append((paths[-1], value))
            paths.append(path)
            page.muted.append(page.muted[above] or value not in BLOCKS and (value in APART or page.named[-1] or unseen))
    flush()
    return page


def apart(page: Page, by_name: bool = True) -> list[bool]:
    """Which elements are no part of an article, by tag, or by name unless they hold the main heading."""
    out, within = [False], [False]
    for e in range(1, len(page.tag)):
        above, tag = page.parent[e], page.tag[e]
        own = tag in APART or page.hidden[e] or (tag == "header" and not within[above]) or (by_name and page.named[e] and not page.core[e])
        out.append(out[above] or own)
        within.append(within[above] or tag in ("article", "main"))
    return out


def alike(page: Page, one: int, other: int) -> float:
    """Twice the common tags of two paths' leaf ends, over all their tags; 1 for equal paths."""
    if one == other:
        return 1.0
    ends = []
    for path in (one, other):
        chain = []
        while path and len(chain) < COMPARED:
            path, tag = page.paths[path]
            chain.append((path, tag))
        ends.append(chain)
    shared = len(set(ends[0]) & set(ends[1]))
    return 2 * shared / max(len(ends[0]) + len(ends[1]), 1)


def path_scores(page: Page, blocks: list[Block]) -> np.ndarray:
    """The fused ratio of each block's path, from 0 to 1."""
    numbers = {p: n for n, p in enumerate(dict.fromkeys(b.path for b in blocks))}
    of = np.array([numbers[b.path] for b in blocks])
    size = np.bincount(of)
    likeness_of: dict[tuple[int, int], float] = {}

    def likeness(one: Block, other: Block) -> float:
        pair = (one.path, other.path)
        if pair not in likeness_of:
            likeness_of[pair] = alike(page, *pair)
        return likeness_of[pair]

    def ratio(values: list[int]) -> np.ndarray:
        """Smoothed means by path: each block's, over its neighbours, weighted by distance and likeness."""
        each = (np.bincount(of, values) / size)[of]
        total, weight = each.copy(), np.ones(len(of))
        for step in range(1, min(RADIUS, len(of) - 1) + 1):
            near = np.exp(-(step * step) / (2 * WIDTH * WIDTH))
            weights = near * np.array([likeness(x, y) for x, y in zip(blocks, blocks[step:])])
            total[:-step] += weights * each[step:]
            total[step:] += weights * each[:-step]
            weight[:-step] += weights
            weight[step:] += weights
        smooth = np.bincount(of, total / weight) / size
        return smooth / smooth.max() if smooth.max() > 0 else smooth

    letters, marks = ratio([len(b.text) - b.links for b in blocks]), ratio([b.marks for b in blocks])
    return (np.sqrt(letters * marks) if marks.any() else letters)[of]


def container(page: Page, chosen: list[Block]) -> list[bool]:
    """Which elements lie in the innermost element that may hold an article and has nearly all of the chosen text."""
    weight = [0] * len(page.tag)
    for b in chosen:
        weight[b.element] += len(b.text)
    for e in range(len(weight) - 1, 0, -1):
        weight[page.parent[e]] += weight[e]
    holder = max(e for e, w in enumerate(weight) if not e or page.tag[e] in HOLDERS and w >= HELD_SHARE * weight[0])
    inside: list[bool] = []
    for e in range(len(weight)):
        inside.append(e == holder or bool(e) and inside[page.parent[e]])
    return inside


def main_blocks(page: Page) -> list[str]:
    """Texts of the blocks of the article, in page order."""
    for by_name in (True, False):
        out = apart(page, by_name)
        blocks = [b for b in page.blocks if not out[b.element]]
        if blocks:
            break
    else:
        return []
    lists: list[int] = []  # the outermost list around each element, or 0
    around: list[int] = []  # the outermost article or main around each element, or 0
    for e, tag in enumerate(page.tag):
        above = page.parent[e]
        lists.append((lists[above] if e else 0) or (e if tag in LISTS else 0))
        around.append((around[above] if e else 0) or (e if tag in ("article", "main") else 0))
    total, linked = np.zeros(len(page.tag)), np.zeros(len(page.tag))
    for b in blocks:
        total[lists[b.element]] += len(b.text)
        linked[lists[b.element]] += b.links
    menu = [bool(lists[b.element]) and linked[lists[b.element]] >= MENU_SHARE * total[lists[b.element]] for b in blocks]
    blocks = [b for b, m in zip(blocks, menu) if not m]
    if not blocks:
        return []
    scores = path_scores(page, blocks)
    chosen = ((scores > 0) & (scores >= scores.std())).tolist()
    weight = [0] * len(page.tag)
    for b, c in zip(blocks, chosen):
        weight[around[b.element]] += len(b.text) if c else 0
    best = weight.index(max(weight)) if any(chosen) else max(around)
    if best and 2 * weight[best] >= sum(weight):
        return [b.text for b in blocks if around[b.element] == best]
    if not any(chosen):
        return []
    inside = container(page, [b for b, c in zip(blocks, chosen) if c])
    places = [n for n, (b, c) in enumerate(zip(blocks, chosen)) if c and inside[b.element]]
    first, last = places[0], places[-1]
    while first and blocks[first - 1].heading:
        first -= 1
    return [b.text for b in blocks[first : last + 1]]


def main_text(html: str | None) -> str:
    return "\n".join(main_blocks(read_page(html))) if html else ""


def extract_text(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """``page_id, url, text, n_chars, n_blocks`` of every page."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 64):
            found = [main_blocks(read_page(h.as_py())) if h.is_valid else [] for h in batch.column(2)]
            texts = ["\n".join(f) for f in found]
            columns = [*batch.columns[:2], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64()), pa.array([len(f) for f in found], pa.int32())]
            yield pa.record_batch(columns, ["page_id", "url", "text", "n_chars", "n_blocks"])

    rows = pages.select(F.col(page_id).cast("bigint").alias("page_id"), F.col(url).cast("string").alias("url"), F.col(html).cast("string").alias("html"))
    return arrow_map(rows, run, FOUND)
