"""Main text of web pages by minimum-cut labelling of their blocks.

A page is read as a list of blocks, each with its text, the share of it in
links, and the element it lies in. A log-linear classifier turns words, links,
and the elements and names around a block (bounded, weak evidence) into the cost of either label; the costs become
the capacities to the terminals. Neighbours in page order, and neighbours under one
parent, are tied by edges whose capacity shrinks with the steps between
their parents. The minimum cut parts content from boilerplate at the least total cost, so
a short line or an oddly named paragraph goes with what surrounds it.

Before the flow, blocks whose own cost outweighs all their edges get their
label, and their edges move to the terminals of the neighbours; and blocks of which one edge
outweighs all else become one with its other end. Both leave the minimum the same; what is left flows.

Text in a block has its references decoded, white space turned into one space
and its ends trimmed; ``<br>`` is white space. The blocks of content are joined by
line ends in page order. Time and memory grow in proportion to the page, however
deep its elements lie.

Defined results: a null or empty html, or a page without content, has an empty
text; markup that never ends is read to the end of the page; repeated rows each
give a row; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import html as entities
import re
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame

from folioscope.llm.shared import project, slices, small_batches, tidy

#: Elements whose content is never text of the page.
SILENT = "script|style|noscript|template|iframe|svg|object|canvas|select|textarea|title|audio|video|annotation|annotation-xml"
MARKUP = re.compile(
    rf"""<!--(?:.*?-->|.*\Z) | <(?:svg|math)(?:\s[^>]*+)?(?<=/)> | <(?P<silent>{SILENT})(?=[\s/>])[^>]*+>.*?(?:</(?P=silent)\s*+[^>]*+>|\Z) | <(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*+)(?P<rest>(?:"[^"]*+"|'[^']*+'|[^>"'])*+(?:["'][^>]*+)?)(?:>|\Z) | <[!?/][^>]*+(?:>|\Z)""",
    re.DOTALL | re.IGNORECASE | re.VERBOSE,
)
NAMED = re.compile(r"""\b(?:class|id|role|itemprop|aria-label)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.IGNORECASE)
HIDDEN = re.compile(r"""(?:^|\s)hidden(?:\s|=|/|$)|aria-hidden\s*=\s*["']?true|display\s*:\s*none|visibility\s*:\s*hidden""", re.IGNORECASE)
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q ruby rb rp rt s samp small span strike strong sub sup time tt u var wbr input "
    "math mi mn mo ms mtext mrow mfrac msqrt mroot mstyle msub msup msubsup munder mover munderover mtable mtr mtd semantics".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HEADINGS = ("h1", "h2", "h3", "h4", "h5", "h6")
#: A start of the key's elements ends an open element of the value's, within the nearest of the fences.
ENDS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
FENCES = ("ul", "ol", "dl", "table", "body", "html")

#: Log odds of content that elements around a block give; forms and bad names that hold a page's main part, and headers in it, give none.
ELEMENTS = {"nav": -3.0, "footer": -3.0, "aside": -3.0, "form": -1.5, "button": -3.0, "dialog": -3.0, "menu": -3.0, "header": -2.0, "article": 2.5, "main": 1.5, "address": -1.5, "figure": -0.3}
MAIN = frozenset(("article", "main", "h1"))
BAD_NAME = re.compile(
    r"(?:^|[\s_-])(?:ads?|adverts?|advertisements?|advertising|sponsor(?:ed)?|promos?|promotions?|banners?|cookies?|consent|gdpr|notices?|alerts?|popups?|modals?|overlays?|sidebars?|menus?|navs?|navbar|navigation|breadcrumbs?"
    r"|footers?|headers?|masthead|topbar|comments?|replies|disqus|respond|share|sharing|social|related|recommended|newsletters?|subscribe|subscriptions?|signup|login|search|widgets?|pagination|pager|skip|toolbar|tags|complementary|contentinfo)(?=$|[\s_-])",
    re.IGNORECASE,
)
#: Names of a whole page's layout, which tell nothing about the element.
LAYOUT = re.compile(r"(?:^|(?<=\s))(?:has|with|no|without|is|layout|page)[-_]\S*", re.IGNORECASE)
GOOD_NAME = re.compile(r"(?:^|[\s_-])(?:article|articlebody|content|main|post|entry|story|body|text)(?=$|[\s_-])", re.IGNORECASE)
#: What a bad name gives an element that holds blocks, and what it gives a block; what a good name gives; what being hidden gives.
BAD, ODD, GOOD, UNSEEN = -6.0, -1.5, 0.7, -9.0
PARAGRAPHS, ITEMS = frozenset(("p", "blockquote", "pre")), frozenset(("li", "td", "th", "dt", "dd"))
#: Bounds of all that speaks against a block and of all that speaks for it in the elements and names around it; hidden elements, which aren't seen, are beyond them.
AROUND = (-7.0, 3.0)
FORM = {"start": -1.5, "word": 0.08, "most_words": 25, "links": -4.0, "heading": 0.5, "paragraph": 0.8, "item": -0.4, "stop": 0.4}
#: Capacity of an edge between neighbours under one parent, what each step between their parents leaves of it, and its least.
TIE, STEP, LOOSE = 2.0, 0.15, 0.01


@dataclass
class Block:
    text: str
    linked: float
    element: int


@dataclass
class Page:
    """The elements of a page (parent, depth, name, log odds; 0 is the page) and its blocks, in order."""

    parent: list[int]
    depth: list[int]
    name: list[str]
    around: list[float]
    blocks: list[Block]


def _names(rest: str, bad: float) -> tuple[float, float]:
    """(log odds of the names of an element, what its being hidden adds)."""
    value = 0.0
    for found in NAMED.finditer(rest):
        own = LAYOUT.sub("", found[1] or found[2] or found[3] or "")
        value += bad if BAD_NAME.search(own) else GOOD if GOOD_NAME.search(own) else 0.0
    return value, UNSEEN if HIDDEN.search(rest) else 0.0


class _Reader:
    """Builds the elements and blocks of a page from its tags."""

    def __init__(self) -> None:
        self.parent, self.depth, self.name = [0], [0], [""]
        self.given: list[tuple[float, float, float]] = [(0.0, 0.0, 0.0)]  # by the element, by its names, by being hidden
        self.holds = [False]  # whether the page's main part lies in it
        self.open, self.where = [0], {}
        self.blocks: list[Block] = []
        self.parts: list[str] = []
        self.linked: list[str] = []
        self.links = 0

    def add(self, text: str) -> None:
        if text:
            self.parts.append(text)
            if self.links:
                self.linked.append(text)

    def close(self) -> None:
        text = " ".join(entities.unescape("".join(self.parts)).split())
        if text:
            near = " ".join(entities.unescape("".join(self.linked)).split())
            self.blocks.append(Block(text, len(near) / len(text), self.open[-1]))
        self.parts.clear()
        self.linked.clear()

    def last(self, names: tuple[str, ...]) -> int:
        """The place of the innermost open element of some names; 0 if there is none."""
        return max((self.where[n][-1] for n in names if self.where.get(n)), default=0)

    def pop(self, place: int) -> None:
        """End the open elements from a place on."""
        while len(self.open) > place > 0:
            self.where[self.name[self.open.pop()]].pop()

    def start(self, name: str, rest: str) -> None:
        if self.name[self.open[-1]] == "p" or self.name[self.open[-1]] in HEADINGS:
            self.pop(len(self.open) - 1)
        if name in ENDS and (place := self.last(ENDS[name])) > self.last(FENCES):
            self.pop(min(p for n in ENDS[name] for p in self.where.get(n, ()) if p > self.last(FENCES)) if name == "tr" else place)
        if name in VOID:
            return
        up, number = self.open[-1], len(self.parent)
        names, hidden = _names(rest, ODD if name in PARAGRAPHS or name in ITEMS or name in HEADINGS else BAD) if rest and name not in ("body", "html") else (0.0, 0.0)
        main = bool(self.where.get("article") or self.where.get("main"))
        self.given.append((0.0 if name == "header" and main else ELEMENTS.get(name, 0.0), names, hidden))
        self.parent.append(up)
        self.depth.append(self.depth[up] + 1)
        self.name.append(name)
        self.holds.append(False)
        self.where.setdefault(name, []).append(len(self.open))
        self.open.append(number)
        if name in MAIN:
            while up and not self.holds[up]:
                self.holds[up] = True
                up = self.parent[up]

    def page(self) -> Page:
        sums, around = [(0.0, 0.0, 0.0)], [0.0]
        for i in range(1, len(self.parent)):
            own, names, hidden = self.given[i]
            if self.holds[i] and self.name[i] != "header":
                own, names = 0.0 if self.name[i] == "form" else own, max(0.0, names)
            bad, good, unseen = sums[self.parent[i]]
            sums.append((max(bad + min(own, 0.0) + min(names, 0.0), AROUND[0]), min(good + max(own, 0.0) + max(names, 0.0), AROUND[1]), unseen + hidden))
            around.append(sum(sums[i]))
        return Page(self.parent, self.depth, self.name, around, self.blocks)


def read(html: str) -> Page:
    """The elements and blocks of a page."""
    reader, at = _Reader(), 0
    for tag in MARKUP.finditer(html):
        reader.add(html[at : tag.start()])
        at = tag.end()
        name = (tag["name"] or "").lower()
        if not name:
            continue
        if name in INLINE:
            if name == "br":
                reader.add(" ")
            elif name == "a":
                reader.links = max(0, reader.links + (-1 if tag["close"] else 1))
            continue
        reader.close()
        if tag["close"]:
            reader.pop(reader.last((name,)))
            reader.links = 0
        else:
            reader.start(name, tag["rest"])
    reader.add(html[at:])
    reader.close()
    return reader.page()


def odds(page: Page, block: Block) -> float:
    """The classifier's log odds that a block is content."""
    tag = page.name[block.element]
    z = FORM["start"] + page.around[block.element] + FORM["word"] * min(block.text.count(" ") + 1, FORM["most_words"]) + FORM["links"] * block.linked
    z += FORM["heading"] if tag in HEADINGS else FORM["paragraph"] if tag in PARAGRAPHS else FORM["item"] if tag in ITEMS else 0.0
    return z + (FORM["stop"] if block.text[-1] in ".!?…:。！？" else 0.0)


def edges(page: Page) -> list[tuple[int, int, float]]:
    """Edges between neighbours in the page, and between those next to each other under one parent."""
    out: dict[tuple[int, int], float] = {}
    last: dict[int, int] = {}
    for i, b in enumerate(page.blocks):
        up = page.parent[b.element]
        for j in {i - 1, last.get(up, -1)}:
            if j >= 0:
                x, y = up, page.parent[page.blocks[j].element]
                steps = 0
                while x != y:
                    x, y, steps = (page.parent[x], y, steps + 1) if page.depth[x] >= page.depth[y] else (x, page.parent[y], steps + 1)
                out[j, i] = max(LOOSE, TIE * STEP**steps)
        last[up] = i
    return [(i, j, w) for (i, j), w in out.items()]


def minimum_cut(gain: list[float], ties: list[tuple[int, int, float]]) -> list[bool]:
    """Labels of least cost: node i pays max(0, -gain) as content and max(0, gain) as other; parted ends of a tie pay its weight."""
    n = len(gain)
    gain = list(gain)
    near: list[dict[int, float]] = [{} for _ in range(n)]
    for i, j, w in ties:
        near[i][j] = near[i].get(j, 0.0) + w
        near[j][i] = near[j].get(i, 0.0) + w
    label: list[bool | None] = [None] * n
    same = list(range(n))  # a node that goes with another points at it

    def root(i: int) -> int:
        while same[i] != i:
            same[i] = i = same[same[i]]
        return i

    waiting = deque(range(n))
    while waiting:
        i = waiting.popleft()
        if same[i] != i or label[i] is not None:
            continue
        total, most = sum(near[i].values()), max(near[i], key=near[i].__getitem__, default=-1)
        if abs(gain[i]) >= total and (gain[i] or not near[i]):  # its own cost outweighs all its ties
            label[i] = gain[i] > 0
            for j, w in near[i].items():
                gain[j] += w if label[i] else -w
                near[j].pop(i)
                waiting.append(j)
            near[i] = {}
        elif most >= 0 and 2 * near[i][most] >= abs(gain[i]) + total:  # one tie outweighs all else: both ends have one label
            a, b = (i, most) if len(near[i]) <= len(near[most]) else (most, i)
            same[a] = b
            gain[b] += gain[a]
            near[b].pop(a)
            for k, w in near[a].items():
                if k != b:
                    near[k].pop(a)
                    near[k][b] = near[b][k] = near[b].get(k, 0.0) + w
                    waiting.append(k)
            near[a] = {}
            waiting.append(b)
    rest = [i for i in range(n) if label[i] is None and same[i] == i]
    if rest:
        for i, side in zip(rest, _flow([gain[i] for i in rest], {i: k for k, i in enumerate(rest)}, near, rest), strict=True):
            label[i] = side
    return [bool(label[root(i)]) for i in range(n)]


def _flow(gain: list[float], number: dict[int, int], near: list[dict[int, float]], rest: list[int]) -> list[bool]:
    """Shortest augmenting paths, by levels; the side of the source is content."""
    n = len(gain)
    source, sink = n, n + 1
    room: list[dict[int, float]] = [{} for _ in range(n + 2)]

    def add(a: int, b: int, there: float, back: float) -> None:
        room[a][b] = room[a].get(b, 0.0) + there
        room[b][a] = room[b].get(a, 0.0) + back

    for k, i in enumerate(rest):
        if gain[k] > 0:
            add(source, k, gain[k], 0.0)
        elif gain[k] < 0:
            add(k, sink, -gain[k], 0.0)
        for j, w in near[i].items():
            if i < j:
                add(k, number[j], w, w)
    while True:
        level = {source: 0}
        queue = deque([source])
        while queue:
            a = queue.popleft()
            for b, r in room[a].items():
                if r > 1e-12 and b not in level:
                    level[b] = level[a] + 1
                    queue.append(b)
        if sink not in level:
            return [k in level for k in range(n)]
        ways = {a: iter(list(room[a])) for a in level}
        path = [source]
        while path:
            a = path[-1]
            if a == sink:
                least = min(room[x][y] for x, y in zip(path, path[1:], strict=False))
                for x, y in zip(path, path[1:], strict=False):
                    room[x][y] -= least
                    room[y][x] += least
                path = [source]
                ways[source] = iter(list(room[source]))
                continue
            for b in ways[a]:
                if room[a][b] > 1e-12 and level.get(b) == level[a] + 1:
                    path.append(b)
                    break
            else:
                level.pop(a, None)
                path.pop()
                if path:
                    ways[path[-1]] = iter(list(room[path[-1]]))


def labelled(page: Page) -> tuple[list[bool], list[bool]]:
    """(whether each block is content by the minimum cut, and by its own cost alone)."""
    # the two costs of a label are -log p and -log(1 - p); their difference is the log odds
    gain = [z or -1e-9 for z in (odds(page, b) for b in page.blocks)]
    return minimum_cut(gain, edges(page)), [z > 0 for z in gain]


def extract(html: str | None) -> tuple[str, int, int, int]:
    """(main text, blocks of content, blocks, blocks that the cut labels otherwise than their own cost) of a page."""
    page = read(html or "")
    if not page.blocks:
        return "", 0, 0, 0
    content, own = labelled(page)
    kept = [b.text for b, c in zip(page.blocks, content, strict=True) if c]
    return "\n".join(kept), len(kept), len(content), sum(a != b for a, b in zip(content, own, strict=True))


def main_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars, n_kept, n_blocks and n_moved (labels that the cut turns) of each page."""
    small_batches(pages.sparkSession)
    pages = project(pages, "page_id", "url", "html")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "html"):
                texts, *counts = zip(*map(extract, batch.column("html").to_pylist()), strict=True)
                columns = [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64()), *[pa.array(c, pa.int64()) for c in counts]]
                yield pa.RecordBatch.from_arrays(columns, names=["page_id", "url", "text", "n_chars", "n_kept", "n_blocks", "n_moved"])

    kinds = dict(pages.dtypes)
    return pages.mapInArrow(tidy(run), f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long, n_kept long, n_blocks long, n_moved long")
