"""Main text of web pages by a minimum cut between article and boilerplate.

A page becomes a list of text blocks.  What a block looks like (where it sits,
its links, its length) makes it cost something to call it article or
boilerplate: the capacities to the two terminals.  Blocks that follow each other
or sit in one element cost something to call differently: the edges between
them.  An element whose class, id or role sounds like boilerplate is a node of its
own, paid for once if anything in it is to be article.  The cheapest labelling of
the whole page is a minimum cut.
"""

from __future__ import annotations

import math
import re
from collections import deque
from html import unescape
from typing import NamedTuple

from pyspark.sql import DataFrame

from larder.llm.common import map_columns

BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search section select "
    "summary table tbody td tfoot th thead title tr ul button noscript".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea iframe noframes noembed xmp".split())  # HTML reads them to their end tag, or to the end of the page
FOREIGN = frozenset(("svg", "math"))  # "/>" ends an element in these
REPLACED = frozenset("object canvas audio video".split())
NEVER = frozenset("head title select option optgroup button datalist template".split())
BOILER_TAGS = frozenset("nav footer aside form menu dialog search noscript fieldset".split())
ARTICLE_TAGS = frozenset(("article", "main"))
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# Starting one of these ends an open one of those named.
CLOSES = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"),
    "option": ("option",), "body": ("head",),
}
BOILER_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense adslot sponsor sponsored sponsors promo promotion banner cookie "
    "cookies consent gdpr notice notices notification alert popup popover modal overlay sidebar menu nav navbar navigation "
    "breadcrumb breadcrumbs footer masthead topbar comment comments commentlist disqus respond reply replies share sharing "
    "social related recommended recommendations newsletter subscribe subscription signup login search widget widgets toolbar "
    "pagination pager copyright legal disclaimer skip".split()
)
HEADER_NAMES = BOILER_NAMES | {"header"}  # outside an article
ARTICLE_NAMES = frozenset("article content entry post story main body".split())

# What a block costs under the wrong label: evidence for the article is positive.
PRIOR = -1.0
IN_ARTICLE = 6.0
ARTICLE_NAME = 2.0
BOILER = -20.0  # inside menus, footers, asides, forms
# Of an element named so, once for all its blocks, up to the next article inside it: in a name
# that starts or ends so ("ad-slot"), and in one that merely holds or denies the word ("has-comments").
NAMED, PARTLY_NAMED = -10.0, -4.0
QUALIFIERS = frozenset("has have no not is with without hide show".split())
HEADER = -8.0  # a page header, unless it belongs to the article
LINKS = -4.0  # times the share of linked text, outside the article
FALLBACK = -2.0  # what replaced elements hold for browsers that cannot show them
WORDS, MOST_WORDS = 0.1, 40  # in elements named like boilerplate, all unlinked words count
SENTENCE = 1.0
SAME_PARENT, NEIGHBOUR = 0.8, 0.3  # cost of a change of label between blocks

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>", re.S
)
_NAMES = re.compile(r"\b(?:class|id|role)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+)", re.I)
_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|/|$)|display\s*:\s*none|aria-hidden\s*=\s*[\"']?true", re.I)


class Element(NamedTuple):
    tag: str
    number: int
    article: bool
    named: bool
    boiler: bool
    header: bool
    never: bool
    mark: int  # the nearest element named like boilerplate, counted from 1
    fallback: bool
    foreign: bool


class Block(NamedTuple):
    text: str
    parent: int
    score: float
    mark: int


class Mark(NamedTuple):
    score: float
    above: int


def _open(tag: str, attributes: str, above: Element, number: int, marks: list[Mark]) -> Element:
    names: set[str] = set()
    named = 0.0
    if attributes:
        suspect = BOILER_NAMES if above.article else HEADER_NAMES
        for m in _NAMES.finditer(attributes):
            for name in m.group(1).split():
                parts = [p.lower() for p in _PARTS.findall(name)]
                names.update(parts)
                if not suspect.isdisjoint(parts):
                    outside = parts[0] in suspect or (parts[-1] in suspect and parts[0] not in QUALIFIERS)
                    named = min(named, NAMED if outside else PARTLY_NAMED)
    boiler = above.boiler or tag in BOILER_TAGS or bool(attributes and _HIDDEN.search(attributes))
    mark, header = above.mark, above.header
    if tag in ARTICLE_TAGS:
        # An article is one whatever wraps it, except those of which a page has many, like comments.
        mark, header = mark if named == NAMED else 0, False
    elif named and tag not in ("html", "body"):
        marks.append(Mark(named, mark))
        mark = len(marks)
    header = header or (tag == "header" and not above.article)
    return Element(
        tag, number, above.article or tag in ARTICLE_TAGS, (above.named and mark == above.mark) or not names.isdisjoint(ARTICLE_NAMES),
        boiler, header, above.never or tag in NEVER, mark, above.fallback or tag in REPLACED, above.foreign or tag in FOREIGN,
    )


def _apart(element: Element) -> tuple[bool, int, bool]:
    """Text on either side of a change of these is never one block."""
    return element.boiler, element.mark, element.fallback


def _score(element: Element, text: str, linked: int) -> float:
    words = text.count(" ") + 1
    share = min(1.0, linked / len(text))
    s = PRIOR + WORDS * max(min(words, MOST_WORDS), words * (1 - share) if element.mark else 0) + (SENTENCE if text[-1:] in ".!?…。" else 0.0)
    # A name inside an article takes its word for what it holds.
    s += IN_ARTICLE if element.article and not element.mark else LINKS * share
    s += ARTICLE_NAME if element.named else 0.0
    s += BOILER if element.boiler else 0.0
    s += HEADER if element.header else 0.0
    s += FALLBACK if element.fallback else 0.0
    s += 1.0 if element.tag in HEADINGS else 0.0
    return s


def blocks_of(html: str) -> tuple[list[Block], list[Mark]]:
    """The page's visible text blocks in order, references decoded, white space joined; elements named like boilerplate."""
    out: list[Block] = []
    marks: list[Mark] = []
    root = Element("", 0, False, False, False, False, False, 0, False, False)
    stack, held, number, linked, in_link, at = [root], [], 0, 0, 0, 0

    def hold(text: str) -> None:
        if not stack[-1].never:
            held.append(text)

    def flush() -> None:
        nonlocal held, linked
        if held:
            text = " ".join(unescape("".join(held)).split())
            top = next((e for e in reversed(stack) if e.tag in BLOCKS or not e.tag), root)
            if text:
                near = top if _apart(stack[-1]) == (False, 0, False) else stack[-1]
                out.append(Block(text, top.number, _score(near, text, linked), near.mark))
            held, linked = [], 0

    size = len(html)
    while at < size:
        m = _TOKEN.search(html, at)
        if m is None:
            hold(html[at:])
            break
        if m.start() > at:
            hold(html[at : m.start()])
            if in_link and not stack[-1].never:
                linked += m.start() - at
        at = m.end()
        tag = (m.group(2) or m.group(5) or "").lower()
        if not tag:
            continue
        ending = m.group(1) or m.group(4)
        if ending:
            if tag == "a":
                in_link = 0
            place = next((k for k in range(len(stack) - 1, 0, -1) if stack[k].tag == tag), 0)
            if tag in BLOCKS or (place and _apart(stack[place]) != _apart(stack[place - 1])):
                flush()
            if place:
                # A closed inline element does not close the blocks opened inside it.
                if tag in BLOCKS or not any(e.tag in BLOCKS for e in stack[place + 1 :]):
                    del stack[place:]
            continue
        attributes = m.group(3) or m.group(6) or ""
        if tag in RAW:
            if not attributes.endswith("/") or tag in ("script", "style", "textarea"):
                end = re.compile(rf"</{re.escape(tag)}\b[^>]*>", re.I).search(html, at)
                at = end.end() if end else size
            hold(" " if tag not in ("script", "style") else "")
            continue
        if tag == "br":
            hold(" ")
            continue
        if tag in BLOCKS:
            flush()
            closes = ("p",) if tag not in CLOSES else (*CLOSES[tag], "p")
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag in closes:
                    del stack[k:]
                    break
                if stack[k].tag in BLOCKS and stack[k].tag not in ("p", "li", "td", "th", "dd", "dt"):
                    break
        if tag in VOID or (attributes.endswith("/") and (stack[-1].foreign or tag in FOREIGN)):
            continue
        if tag == "a":
            in_link = 1
        number += 1
        element = _open(tag, attributes, stack[-1], number, marks)
        if _apart(element) != _apart(stack[-1]):
            flush()
        stack.append(element)
    flush()
    return out, marks


def minimum_cut(scores: list[float], edges: list[tuple[int, int, float]], needs: list[tuple[int, int]] = ()) -> list[bool]:
    """Which nodes stay with the source: blocking flows over shortest paths until none is left.

    Of each pair in ``needs`` the first stays only with the second.
    """
    n = len(scores)
    source, sink = n, n + 1
    ends: list[int] = []
    room: list[float] = []
    near: list[list[int]] = [[] for _ in range(n + 2)]

    def link(a: int, b: int, there: float, back: float) -> None:
        near[a].append(len(ends))
        near[b].append(len(ends) + 1)
        ends.extend((b, a))
        room.extend((there, back))

    for k, s in enumerate(scores):
        if s > 0:
            link(source, k, s, 0.0)
        elif s < 0:
            link(k, sink, -s, 0.0)
    for a, b, w in edges:
        link(a, b, w, w)
    for a, b in needs:
        link(a, b, math.inf, 0.0)
    while True:
        depth = [-1] * (n + 2)
        depth[source] = 0
        queue = deque([source])
        while queue:
            a = queue.popleft()
            for e in near[a]:
                b = ends[e]
                if room[e] > 1e-9 and depth[b] < 0:
                    depth[b] = depth[a] + 1
                    queue.append(b)
        if depth[sink] < 0:
            return [depth[k] >= 0 for k in range(n)]
        tried = [0] * (n + 2)
        path: list[int] = []
        a = source
        while True:
            if a == sink:
                flow = min(room[e] for e in path)
                for e in path:
                    room[e] -= flow
                    room[e ^ 1] += flow
                # Back to the first edge that is full now.
                full = next(k for k, e in enumerate(path) if room[e] <= 1e-9)
                a = ends[path[full] ^ 1]
                del path[full:]
                continue
            links = near[a]
            while tried[a] < len(links):
                e = links[tried[a]]
                if room[e] > 1e-9 and depth[ends[e]] == depth[a] + 1:
                    break
                tried[a] += 1
            if tried[a] < len(links):
                path.append(links[tried[a]])
                a = ends[path[-1]]
            elif path:
                e = path.pop()
                a = ends[e ^ 1]
                tried[a] += 1
            else:
                break


def main_text(html: str | None) -> str:
    """The article's blocks, one per line; empty if there is none."""
    blocks, marks = blocks_of(html) if html else ([], [])
    if not blocks:
        return ""
    edges, last = [], {}
    for k, block in enumerate(blocks):
        if k and blocks[k - 1].parent != block.parent:
            edges.append((k - 1, k, NEIGHBOUR))
        if block.parent in last:
            edges.append((last[block.parent], k, SAME_PARENT))
        last[block.parent] = k
    n = len(blocks) - 1  # marks are counted from 1
    needs = [(k, n + b.mark) for k, b in enumerate(blocks) if b.mark]
    needs += [(n + k, n + m.above) for k, m in enumerate(marks, 1) if m.above]
    kept = minimum_cut([b.score for b in blocks] + [m.score for m in marks], edges, needs)
    return "\n".join(b.text for b, keep in zip(blocks, kept) if keep)


def extract(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` per row of ``pages``, in one narrow pass over whole pages.

    Null and empty pages, and pages without article text, give an empty text of
    0 characters.  Repeated rows and null ids are treated row by row; other
    columns are not read.
    """

    def run(batch) -> dict:
        texts = [main_text(h) for h in batch.column(2).to_pylist()]
        return {"page_id": batch.column(0), "url": batch.column(1), "text": texts, "n_chars": [len(t) for t in texts]}

    return map_columns(pages.select("page_id", "url", "html"), run, "page_id long, url string, text string, n_chars long")
