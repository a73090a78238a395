"""Main text of web pages by minimum-cut labelling.

A page is a line of text blocks. A classifier gives each block a cost for being called content and one
for being called boilerplate; these are the capacities to the two terminals. Neighbours in page order,
and blocks under the same element, are tied by smoothness edges, so a block that says little of itself
takes the label of its surroundings. Max-flow finds the cheapest labelling of the whole page at once.

The weights are fixed and stated below. What an element's own name or role says outweighs all edges a
block can have, so smoothness decides only where the markup is silent. A class or id word is only a cost,
except within an article or main element, which begins without the words of what is around it.
"""

from __future__ import annotations

import re
from collections import deque
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Elements without text of the page.
SKIPPED = {"script", "style", "noscript", "template", "title", "svg", "annotation", "annotation-xml", "iframe", "object", "canvas", "textarea", "select", "button"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "br", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img", "ins",
          "kbd", "label", "mark", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt",
          "u", "var", "wbr",
          "math", "semantics", "annotation", "annotation-xml", "maction", "menclose", "merror", "mfenced", "mfrac", "mi", "mmultiscripts", "mn",
          "mo", "mover", "mpadded", "mphantom", "mprescripts", "mroot", "mrow", "ms", "mspace", "msqrt", "mstyle", "msub", "msubsup", "msup",
          "mtable", "mtd", "mtext", "mtr", "munder", "munderover"}
FOREIGN = {"svg", "math"}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
#: A new one of these ends an open one of the same kind, up to the named elements.
CLOSES = {"p": (), "li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("tr", "table"), "th": ("tr", "table"), "option": ("select",)}
BOILERPLATE = {"nav", "header", "footer", "aside", "form", "menu", "dialog", "head"}
CONTENT = {"article", "main"}
_BAD = re.compile(
    r"(?:^|[\s_-])(?:nav(?:igation|bar)?|menu|breadcrumbs?|header|masthead|footer|sidebar|side|aside|ads?|adverts?|advertisement"
    r"|banner|sponsor(?:ed)?|promo|cookies?|consent|notice|popup|modal|newsletter|subscribe|signup|login|search|share|sharing|social"
    r"|related|recommended|comments?|commentlist|disqus|replies|pagination|pager|toolbar|widget|copyright|legal|tags)(?:$|[\s_-])", re.I)
#: Class words that tell what a page has or lacks beside its text.
_MODIFIER = re.compile(r"(?:^|(?<=\s))(?:has|with|without|no)[_-]\S*", re.I)
_GOOD = re.compile(r"(?:^|[\s_-])(?:article|content|main|post|entry|story|body|text)(?:$|[\s_-])", re.I)
_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "alert", "menu", "menubar"}

# Costs of a wrong label, and of a boundary between two blocks. One block has at most two edges of each kind.
MARKED, NAMED, INSIDE, HINT, LINKS, PROSE, SHORT = 12.0, 2.5, 5.0, 1.5, 3.0, 1.2, 0.4
#: What an element's name or role adds to the marks; a class or id word adds 1.
SURE = 1000
NEXT, SIBLING = 0.3, 1.0


class _Blocks(HTMLParser):
    """Text blocks of a page: (text, length of text in links, classes of its elements, its parent)."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.open: list[tuple[str, int, bool]] = []  # name, number, hidden
        # Of the open elements: boilerplate, content, and boilerplate for a heading.
        self.marks: list[tuple[int, int, int]] = [(0, 0, 0)]
        self.blocks: list[tuple[str, int, int, int, int]] = []
        self.parts: list[str] = []
        self.linked = self.links = self.hidden = self.number = self.foreign = 0

    def flush(self) -> None:
        text = " ".join("".join(self.parts).split())
        if text:
            home = next((n for name, n, _ in reversed(self.open) if name not in INLINE and name not in ("p", "li")), 0)
            self.blocks.append((text, self.linked, *self.marks[-1][:2], home))
        self.parts, self.linked = [], 0

    def handle_starttag(self, name, attrs):
        if name not in INLINE:
            self.flush()
            self._end_implied(name)
        if name in VOID:
            if name == "br":
                self.parts.append(" ")
            return
        given = dict(attrs)
        hidden = name in SKIPPED or "hidden" in given or given.get("aria-hidden") == "true" or bool(
            re.search(r"display\s*:\s*none", given.get("style") or "", re.I))
        named = f"{given.get('class') or ''} {given.get('id') or ''}"
        role = (given.get("role") or "").lower()
        bad, good, heading = self.marks[-1]
        sure = name in BOILERPLATE or role in _ROLES
        if sure or name not in INLINE | {"body", "html"} | CONTENT and role != "main" and _BAD.search(_MODIFIER.sub("", named)):
            # Where all is content but for such marks, a word is as good as a name.
            more = SURE if sure or good > 1 else 1
            bad += more
            if not (good >= SURE and (name == "header" or re.search(r"(?:^|[\s_-])header(?:$|[\s_-])", named, re.I))):
                heading += more
        elif name in CONTENT or role == "main":
            if good < SURE and bad < SURE:
                bad = heading = 0
            good += SURE
        elif name not in ("body", "html") and _GOOD.search(named):
            good += 1
        if name in HEADINGS:
            # The title in an article's own header is content.
            bad = heading
        self.number += 1
        self.open.append((name, self.number, hidden))
        self.marks.append((bad, good, heading))
        self.foreign += name in FOREIGN
        self.hidden += hidden
        self.links += name == "a"

    def handle_startendtag(self, name, attrs):
        self.handle_starttag(name, attrs)
        # Only in SVG and MathML does "/>" end an element.
        if self.foreign and name not in VOID:
            self.handle_endtag(name)

    def _end_implied(self, name: str) -> None:
        if name not in CLOSES and name in INLINE:
            return
        stops = CLOSES.get(name, ())
        # Any block element ends an open paragraph; items and cells end those of their own list or row.
        for i in reversed(range(len(self.open))):
            other = self.open[i][0]
            if other == "p" or other == name and name in CLOSES:
                self._cut(i)
                if other == name:
                    return
            elif other in stops or other not in INLINE and name not in CLOSES or other in ("body", "article", "div", "section"):
                return

    def _cut(self, i: int) -> None:
        for name, _, hidden in self.open[i:]:
            self.hidden -= hidden
            self.links -= name == "a"
            self.foreign -= name in FOREIGN
        del self.open[i:], self.marks[i + 1 :]

    def handle_endtag(self, name):
        if name not in INLINE:
            self.flush()
        for i in reversed(range(len(self.open))):
            if self.open[i][0] == name:
                self._cut(i)
                return

    def handle_data(self, data):
        if not self.hidden:
            self.parts.append(data)
            if self.links:
                self.linked += len("".join(data.split()))


def blocks(page: str) -> list[tuple[str, int, int, int, int]]:
    reader = _Blocks()
    reader.feed(page)
    reader.close()
    reader.flush()
    return reader.blocks


def costs(block: tuple[str, int, int, int, int]) -> tuple[float, float]:
    """What it costs to call a block boilerplate, and to call it content."""
    text, linked, bad, good, _ = block
    for_content = for_boilerplate = 0.0
    if bad >= SURE:
        for_boilerplate += MARKED
    else:
        for_boilerplate += min(NAMED * bad, MARKED)
    if good and bad < SURE:
        for_content += INSIDE if good > 1 else HINT
    letters = len("".join(text.split()))
    if 2 * linked > letters:
        for_boilerplate += LINKS
    if len(text) >= 80 or re.search(r"[.!?…]['\"”»)]?$", text):
        for_content += PROSE
    elif len(text) < 25:
        for_boilerplate += SHORT
    else:
        for_content += SHORT
    return for_content, for_boilerplate


def labels(found: list[tuple[str, int, int, int, int]]) -> list[bool]:
    """For each block, whether it is content, at the least total cost.

    Flow runs from the content terminal to the boilerplate one. What goes straight through a block is
    sent at once; the rest takes shortest augmenting paths through the smoothness edges.
    """
    n = len(found)
    excess = [a - b for a, b in map(costs, found)]
    ties: list[dict[int, float]] = [{} for _ in range(n)]
    last_under: dict[int, int] = {}
    for i, block in enumerate(found):
        for j, weight in ((i - 1, NEXT), (last_under.get(block[4], -1), SIBLING)):
            if j >= 0:
                ties[i][j] = ties[i].get(j, 0.0) + weight
                ties[j][i] = ties[j].get(i, 0.0) + weight
        last_under[block[4]] = i
    tiny = 1e-9
    sources = deque(i for i in range(n) if excess[i] > tiny)
    reached = [False] * n
    while sources:
        # One search from a block with flow to give; what it cannot give on stays on the content side.
        start = sources[0]
        came: dict[int, int] = {start: -1}
        queue, goal = deque([start]), -1
        while queue and goal < 0:
            i = queue.popleft()
            for j, room in ties[i].items():
                if room > tiny and j not in came:
                    if reached[j]:
                        continue  # nothing flows on from there
                    came[j] = i
                    if excess[j] < -tiny:
                        goal = j
                        break
                    queue.append(j)
        if goal < 0:
            for i in came:
                reached[i] = True
            sources.popleft()
            while sources and reached[sources[0]]:
                sources.popleft()
            continue
        path, i = [], goal
        while came[i] >= 0:
            path.append((came[i], i))
            i = came[i]
        amount = min(excess[start], -excess[goal], *(ties[a][b] for a, b in path))
        for a, b in path:
            ties[a][b] -= amount
            ties[b][a] += amount
        excess[start] -= amount
        excess[goal] += amount
        if excess[start] <= tiny:
            sources.popleft()
            while sources and reached[sources[0]]:
                sources.popleft()
    return reached


def main_text(page: str) -> str:
    """Content blocks in page order, joined by line feeds. White space in a block is one space."""
    found = blocks(page)
    return "\n".join(b[0] for b, content in zip(found, labels(found)) if content)


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every row; a null or empty page has empty text.

    A page of any length is one graph in one task. Repeated rows stay repeated, other columns are ignored, an empty table gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(p) if p else "" for p in batch.column(2).to_pylist()]
            columns = [*batch.columns[:2], pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["page_id", "url", "text", "n_chars"])

    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), "html")
    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")
