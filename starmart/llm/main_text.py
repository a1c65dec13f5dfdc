"""HTML extraction: blocks of text labelled content or boilerplate by a minimum cut.

Each block gets two costs from a small classifier over its place and its text; they become the capacities to the two
terminals. Blocks next to each other in the page, and neighbours within the same DOM container, are joined by
smoothness edges that weaken with the distance between their containers. The maximum flow leaves the labelling of
least total cost; what stays on the content side is the main text.
"""

from __future__ import annotations

import math
import re
from collections import Counter, deque
from dataclasses import dataclass, field
from html.parser import HTMLParser

from pyspark.sql import DataFrame

from starmart.llm.common import map_lists


@dataclass(frozen=True)
class CutParams:
    """``zone`` is what a sign of boilerplate costs right below it, ``fading`` how much of that each further level keeps. A
    sign of layout on an element with more than ``bulk`` of the page's unlinked text is none."""

    adjacent: float = 0.9
    sibling: float = 0.5
    zone: float = 6.0
    fading: float = 0.8
    section: float = 2.5
    bulk: float = 0.6


VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd mark q ruby rp rt s samp small span strike strong sub sup time tt u var wbr".split()
)
#: Elements whose text is never shown as text.
SILENT = frozenset("head script style noscript template svg iframe object button select textarea label canvas audio video".split())
BOILERPLATE = frozenset("nav footer aside menu dialog header form".split())
WRAPPERS = frozenset(("header", "form"))
CONTENT = frozenset(("article", "main"))
# Names of parts of a page. Those of the second list also name layouts: an element that holds most of the
# page's text is not such a part, whatever it is called.
PARTS = re.compile(
    r"(?:^|[_-])(?:ads?|adverts?|advertisements?|advertising|sponsor(?:ed)?|promos?|promotion|banners?|menus?|nav|navbar|navigation|breadcrumbs?"
    r"|cookies?|consent|notices?|alert|popup|newsletter|subscribe|signup|login|comments?|disqus|respond|replies|reply|reviews?|related|recommended"
    r"|pagination|pager|copyright|legal|skip)(?:$|[_-])",
    re.I,
)
LAYOUT = re.compile(
    r"(?:^|[_-])(?:sidebar|side|footer|foot|header|masthead|modal|overlay|share|sharing|social|widget|toolbar)(?:$|[_-])", re.I
)
#: "has-sidebar", "no-comments": a name about a part is no name of that part.
ABOUT = re.compile(r"^(?:has|have|with|without|no|is|are|hide|show|layout|page|site|body|wp)[_-]", re.I)
GOOD_HINT = re.compile(r"(?:^|[\s_-])(?:article|story|post|entry|content|body|text|main)(?:$|[\s_-])", re.I)


@dataclass
class Element:
    tag: str
    above: "Element | None"
    part: bool = False
    layout: bool = False
    good: bool = False
    silent: bool = False
    level: int = 0
    own_text: int = 0  # unlinked characters within


@dataclass
class Block:
    text: str
    linked: int
    within: Element


@dataclass
class Blocks(HTMLParser):
    """The page's blocks of text in order, each with what surrounds it. Unclosed and stray tags are taken as they come.

    Elements know what is above them, so a block costs the same at any depth.
    """

    found: list[Block] = field(default_factory=list)

    def __post_init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Element("", None)
        self.stack: list[Element] = [self.root]
        self.elements: list[Element] = [self.root]
        self.open: Counter[str] = Counter()
        self.parts: list[str] = []
        self.linked = self.silent = 0

    def flush(self) -> None:
        text = " ".join("".join(self.parts).split())
        if text:
            within = self.stack[-1]
            within.own_text += max(0, len(text) - self.linked)
            self.found.append(Block(text, self.linked, within))
        self.parts, self.linked = [], 0

    def pop(self) -> None:
        gone = self.stack.pop()
        self.open[gone.tag] -= 1
        self.silent -= gone.silent

    def close_to(self, tag: str) -> None:
        while self.stack[-1].tag != tag:
            self.pop()
        self.pop()

    def handle_starttag(self, tag, attrs):
        if tag not in INLINE:
            self.flush()
            for own in ("p", tag if tag in ("li", "dt", "dd", "tr", "td", "th", "option") else "p"):
                if self.open[own] and (own != "p" or self._open_paragraph()):
                    self.close_to(own)
        elif tag == "br":
            self.parts.append(" ")
        if tag in VOID:
            return
        kinds = dict(attrs)
        names = " ".join(kinds.get(k) or "" for k in ("class", "id", "role")).split()
        hidden = "hidden" in kinds or kinds.get("aria-hidden") == "true" or "display:none" in (kinds.get("style") or "").replace(" ", "").lower()
        named = [] if tag in ("html", "body") else [n for n in names if not ABOUT.match(n)]
        part = tag in BOILERPLATE - WRAPPERS or any(map(PARTS.search, named))
        layout = tag in WRAPPERS or any(map(LAYOUT.search, named))
        fine = tag in CONTENT or any(GOOD_HINT.search(n) and not PARTS.search(n) and not LAYOUT.search(n) for n in names)
        above = self.stack[-1]
        element = Element(tag, above, part or hidden, layout, fine and not part and not hidden, tag in SILENT, above.level + (tag not in INLINE))
        self.stack.append(element)
        self.elements.append(element)
        self.open[tag] += 1
        self.silent += element.silent

    def _open_paragraph(self) -> bool:
        """A paragraph is open with no other block in it."""
        for e in reversed(self.stack):
            if e.tag == "p":
                return True
            if e.tag not in INLINE:
                break
        return False

    def handle_endtag(self, tag):
        if tag not in INLINE:
            self.flush()
        if tag not in VOID and self.open[tag]:
            self.close_to(tag)

    def handle_data(self, data):
        if not self.silent:
            self.parts.append(data)
            if self.open["a"]:
                self.linked += len(data.strip())


def parsed(html: str) -> Blocks:
    parser = Blocks()
    parser.feed(html)
    parser.close()
    parser.flush()
    return parser


def settings(elements: list[Element], params: CutParams) -> dict[int, tuple[bool, float]]:
    """Per element whether it is within content, and what the signs of boilerplate above it weigh.

    Elements come parents first. A sign fades with every level below it; an element of content below one of layout
    starts anew, one below a part (a comment's own ``article``) does not.
    """
    for e in reversed(elements):
        if e.above is not None:
            e.above.own_text += e.own_text
    most = params.bulk * elements[0].own_text
    out: dict[int, tuple[bool, float, float]] = {}
    for e in elements:
        inside, part, layout = out[id(e.above)] if e.above is not None else (False, 0.0, 0.0)
        if e.tag not in INLINE:
            part, layout = part * params.fading, layout * params.fading
        if e.part:
            inside, part = False, params.zone
        elif e.good and not part:
            inside, layout = True, 0.0
        elif e.layout and e.own_text <= most and not (e.tag in WRAPPERS and inside):
            inside, layout = False, params.zone
        out[id(e)] = inside, part, layout
    return {k: (inside, max(part, layout)) for k, (inside, part, layout) in out.items()}


def evidence(block: Block, inside: bool, weight: float, params: CutParams) -> float:
    """Logarithm of the odds that a block is content."""
    n = len(block.text)
    score = -1.0 + 0.9 * math.log1p(n / 20) - 3.0 * min(1.0, block.linked / n)
    score += 0.6 if block.text[-1] in ".!?:;\"'" else 0.0
    return score + params.section * inside - weight


def container(block: Block) -> Element:
    """What holds the block's own element."""
    e = block.within
    while e.tag in INLINE:
        e = e.above
    return e.above or e


def _distance(a: Element, b: Element) -> int:
    """Steps between two containers in the tree; from one block to the next they are elements closed and opened between."""
    steps = 0
    while a is not b:
        if a.level > b.level:
            a = a.above
        elif b.level > a.level:
            b = b.above
        else:
            a, b, steps = a.above, b.above, steps + 1
        steps += 1
        if a is None or b is None:
            break
    return steps


def minimum_cut(odds: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """Which nodes stay with the source; ``odds`` are the differences of the terminal capacities, edges go both ways.

    Maximum flow by shortest augmenting layers. Nodes in balance go to the sink.
    """
    n = len(odds)
    source, sink = n, n + 1
    heads: list[list[int]] = [[] for _ in range(n + 2)]
    to: list[int] = []
    room: list[float] = []

    def join(a: int, b: int, forth: float, back: float) -> None:
        heads[a].append(len(to))
        to.append(b)
        room.append(forth)
        heads[b].append(len(to))
        to.append(a)
        room.append(back)

    for i, z in enumerate(odds):
        join(source, i, z, 0.0) if z > 0 else join(i, sink, -z, 0.0)
    for a, b, weight in edges:
        join(a, b, weight, weight)
    while True:
        level = [-1] * (n + 2)
        level[source] = 0
        queue = deque([source])
        while queue:
            a = queue.popleft()
            for e in heads[a]:
                if room[e] > 1e-9 and level[to[e]] < 0:
                    level[to[e]] = level[a] + 1
                    queue.append(to[e])
        if level[sink] < 0:
            return [x >= 0 for x in level[:n]]
        following = [0] * (n + 2)
        path: list[int] = []
        a = source
        while True:
            if a == sink:
                least = min(room[e] for e in path)
                for e in path:
                    room[e] -= least
                    room[e ^ 1] += least
                first = next(k for k, e in enumerate(path) if room[e] <= 1e-9)
                a = to[path[first] ^ 1]
                del path[first:]
                continue
            while following[a] < len(heads[a]):
                e = heads[a][following[a]]
                if room[e] > 1e-9 and level[to[e]] == level[a] + 1:
                    break
                following[a] += 1
            else:
                if a == source:
                    break
                level[a] = -1
                a = to[path.pop() ^ 1]
                continue
            path.append(e)
            a = to[e]


def extract(html: str | None, params: CutParams = CutParams()) -> str:
    """The main text of one page; empty if there is none."""
    page = parsed(html or "")
    blocks, around = page.found, settings(page.elements, params)
    edges, last = [], {}
    held = [container(b) for b in blocks]
    for i, here in enumerate(held):
        if i:
            edges.append((i - 1, i, params.adjacent / (1 + _distance(held[i - 1], here))))
        if id(here) in last and last[id(here)] != i - 1:
            edges.append((last[id(here)], i, params.sibling))
        last[id(here)] = i
    kept = minimum_cut([evidence(b, *around[id(b.within)], params) for b in blocks], edges)
    return "\n".join(b.text for b, keep in zip(blocks, kept) if keep)


def main_text(pages: DataFrame, params: CutParams = CutParams()) -> DataFrame:
    """page_id, url, text and n_chars (code points), one row per row of ``pages``.

    Null or empty html gives an empty text. Null ids and urls stay. Only the three columns are read; each page is
    labelled by itself, so nothing is shuffled.
    """

    def run(ids, urls, htmls):
        return [(i, url, text := extract(html, params), len(text)) for i, url, html in zip(ids, urls, htmls)]

    return map_lists(pages.select("page_id", "url", "html"), run, "page_id long, url string, text string, n_chars long", 256)
