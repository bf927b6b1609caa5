"""Main text of web pages: blocks labelled content or boilerplate by a minimum cut."""

from __future__ import annotations

import re
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass, field
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame

from .batches import by_bytes

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([A-Za-z][A-Za-z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)", re.DOTALL)
ATTRIBUTE = re.compile(r"([A-Za-z_:-]+)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
#: Elements whose contents are no markup, and are never text of the page.
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
BLOCK = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav noscript ol optgroup option p pre search section select summary "
    "svg table tbody td template tfoot th thead tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: What an opening tag closes if it is still open within the same container.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SCOPE = {"li": {"ul", "ol", "menu", "dir"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table", "tr"}, "th": {"table", "tr"}, "option": {"select"}}

NEVER = frozenset("nav footer aside form menu dialog select button head template svg noscript search fieldset optgroup option".split())
CONTENT = frozenset("article main".split())
ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alert", "menu", "menubar", "form"}
OUTSIDE = re.compile(
    r"(?:^|[-_\s])(?:ads?|adverts?|advertisement|sponsor(?:ed)?|promo(?:tion)?s?|banner|cookies?|consent|gdpr|notices?|alert|popup|modal|overlay|newsletter|"
    r"subscribe|subscription|sidebar|side-bar|rail|menu|nav|navbar|navigation|breadcrumbs?|footer|header|masthead|comments?|disqus|repl(?:y|ies)|respond|"
    r"share|sharing|social|related|recommended|widget|login|signup|sign-up|toolbar|pagination|pager|skip|paywall|toc)(?:$|[-_\s\d])"
)
INSIDE = re.compile(r"(?:^|[-_\s])(?:article|content|post|entry|story|main|body|text)(?:$|[-_\s\d])")

#: Weights of the classifier: log-odds of a block being content.
BIAS = -0.5
IN_CONTENT, IN_BOILERPLATE, BESIDE_CONTENT = 4.0, -9.0, -2.0
PARAGRAPH, HEADING, PER_WORD, MOST_WORDS, PER_LINK_SHARE, RIGHTS = 1.0, 0.5, 0.04, 40, -4.0, -2.0
#: Capacities of the edges between blocks next to each other, and between next blocks of one container.
NEXT_TO, SAME_PARENT = 1.0, 0.5


@dataclass
class Block:
    text: str
    path: tuple[int, ...]
    tag: str
    links: int
    kind: int  # 1 within the page's content element, -1 within boilerplate, else 0


@dataclass
class Open:
    tag: str
    number: int
    kind: int


def kind_of(tag: str, attributes: str, outer: int) -> int:
    """What an element says of its contents; boilerplate holds for all within."""
    if outer < 0 or tag in NEVER:
        return -1
    if tag == "header" and outer != 1:
        return -1
    kind = 1 if tag in CONTENT else outer
    if attributes and not attributes.isspace() and tag not in ("html", "body"):
        for name, a, b, c in ATTRIBUTE.findall(attributes):
            name, value = name.lower(), (a or b or c).lower()
            if name in ("class", "id"):
                if OUTSIDE.search(value):
                    return -1
                if kind == 0 and INSIDE.search(value):
                    kind = 1
            elif name == "role" and value in ROLES or name == "hidden" or name == "aria-hidden" and value == "true" or name == "style" and "display:none" in value.replace(" ", ""):
                return -1
            elif name == "role" and value in ("main", "article"):
                kind = 1
    return kind


@dataclass
class Reader:
    """Blocks of a page in order. A block is the text between two block-level tags."""

    blocks: list[Block] = field(default_factory=list)
    stack: list[Open] = field(default_factory=lambda: [Open("", 0, 0)])
    parts: list[str] = field(default_factory=list)
    linked: int = 0
    in_link: bool = False
    count: int = 0

    def flush(self) -> None:
        if self.parts:
            text = " ".join("".join(self.parts).split())
            if text:
                top = self.stack[-1]
                self.blocks.append(Block(text, tuple(o.number for o in self.stack), top.tag, self.linked, top.kind))
            self.parts = []
        self.linked, self.in_link = 0, False

    def text(self, raw: str) -> None:
        if raw:
            clean = unescape(raw) if "&" in raw else raw
            self.parts.append(clean)
            if self.in_link:
                self.linked += len(clean)

    def close(self, tags: set[str] | frozenset[str], scope: set[str] | frozenset[str]) -> None:
        """Close the innermost open element of ``tags``, looking no further than ``scope``."""
        for i in range(len(self.stack) - 1, 0, -1):
            if self.stack[i].tag in tags:
                del self.stack[i:]
                return
            if self.stack[i].tag in scope:
                return

    def read(self, html: str) -> list[Block]:
        at, n = 0, len(html)
        while at < n:
            m = TOKEN.search(html, at)
            if m is None:
                self.text(html[at:])
                break
            self.text(html[at : m.start()])
            at = m.end()
            if m[2] is None:
                continue
            tag = m[2].lower()
            if tag in RAW and not m[1]:
                end = re.compile(rf"</{tag}\b[^>]*>", re.IGNORECASE).search(html, at)
                at = end.end() if end else n
            elif tag in BLOCK:
                self.flush()
                if m[1]:
                    if any(o.tag == tag for o in self.stack):
                        self.close({tag}, frozenset())
                elif tag not in VOID:
                    self.close({"p"}, BLOCK - {"p"})
                    if tag in CLOSES:
                        self.close(CLOSES[tag], SCOPE[tag])
                    if not m[3].endswith("/") or tag not in ("svg",):
                        self.count += 1
                        self.stack.append(Open(tag, self.count, kind_of(tag, m[3], self.stack[-1].kind)))
            elif tag == "br":
                self.parts.append(" ")
            elif tag == "a":
                self.in_link = not m[1]
        self.flush()
        return self.blocks


def theta(b: Block, has_content: bool) -> float:
    """Log-odds of the block being content."""
    out = BIAS + PER_WORD * min(MOST_WORDS, b.text.count(" ") + 1) + PER_LINK_SHARE * b.links / len(b.text)
    if b.kind:
        out += IN_CONTENT if b.kind > 0 else IN_BOILERPLATE
    elif has_content:
        out += BESIDE_CONTENT
    if b.tag in ("p", "pre", "blockquote"):
        out += PARAGRAPH
    elif len(b.tag) == 2 and b.tag[0] == "h" and b.tag[1].isdigit():
        out += HEADING
    if b.kind <= 0 and ("©" in b.text or "all rights reserved" in b.text.lower()):
        out += RIGHTS
    return out


def edges(blocks: list[Block]) -> list[tuple[int, int, float]]:
    """Smoothness: neighbours in page order, weaker the further apart in the tree, and next siblings."""
    out = []
    last: dict[int, int] = {}
    for i, b in enumerate(blocks):
        if i:
            a = blocks[i - 1]
            shared = 0
            for x, y in zip(a.path, b.path):
                if x != y:
                    break
                shared += 1
            out.append((i - 1, i, NEXT_TO / (1 + len(a.path) + len(b.path) - 2 * shared)))
        parent = b.path[-2] if len(b.path) > 1 else b.path[-1]
        if parent in last:
            out.append((last[parent], i, SAME_PARENT))
        last[parent] = i
    return out


def minimum_cut(cost: list[float], links: list[tuple[int, int, float]]) -> list[bool]:
    """Labelling of least cost: ``max(0, -cost)`` for content, ``max(0, cost)`` for boilerplate, and a link's
    capacity where its ends differ. True is content.

    A node whose own cost exceeds all its links has that label in every minimum cut, so it is fixed and its links
    become part of its neighbours' costs; a maximum flow settles what is left.
    """
    n = len(cost)
    own = list(cost)
    near: list[list[tuple[int, float]]] = [[] for _ in range(n)]
    for a, b, w in links:
        near[a].append((b, w))
        near[b].append((a, w))
    open_links = [sum(w for _, w in x) for x in near]
    label: list[bool | None] = [None] * n
    todo = deque(i for i in range(n) if abs(own[i]) > open_links[i])
    while todo:
        i = todo.popleft()
        if label[i] is not None:
            continue
        label[i] = own[i] > 0
        for j, w in near[i]:
            if label[j] is None:
                own[j] += w if label[i] else -w
                open_links[j] -= w
                if abs(own[j]) > open_links[j]:
                    todo.append(j)
    rest = [i for i in range(n) if label[i] is None]
    if rest:
        number = {i: k for k, i in enumerate(rest)}
        content = max_flow_side(
            [own[i] for i in rest],
            [(number[a], number[b], w) for a, b, w in links if label[a] is None and label[b] is None],
        )
        for i, c in zip(rest, content):
            label[i] = c
    return [bool(x) for x in label]


def max_flow_side(cost: list[float], links: list[tuple[int, int, float]]) -> list[bool]:
    """Source side after a maximum flow by level graphs; terminals stand for content and boilerplate."""
    n = len(cost)
    source, sink = n, n + 1
    to: list[int] = []
    room: list[float] = []
    out: list[list[int]] = [[] for _ in range(n + 2)]

    def arc(a: int, b: int, forth: float, back: float) -> None:
        out[a].append(len(to))
        to.append(b)
        room.append(forth)
        out[b].append(len(to))
        to.append(a)
        room.append(back)

    for i, c in enumerate(cost):
        if c > 0:
            arc(source, i, c, 0.0)
        elif c < 0:
            arc(i, sink, -c, 0.0)
    for a, b, w in links:
        arc(a, b, w, w)
    tiny = 1e-9

    def levels() -> list[int]:
        level = [-1] * (n + 2)
        level[source] = 0
        queue = deque([source])
        while queue:
            v = queue.popleft()
            for e in out[v]:
                if room[e] > tiny and level[to[e]] < 0:
                    level[to[e]] = level[v] + 1
                    queue.append(to[e])
        return level

    while (level := levels())[sink] >= 0:
        turn = [0] * (n + 2)
        path: list[int] = []
        v = source
        while True:
            if v == sink:
                push = min(room[e] for e in path)
                for e in path:
                    room[e] -= push
                    room[e ^ 1] += push
                path, v = [], source
                continue
            while turn[v] < len(out[v]):
                e = out[v][turn[v]]
                if room[e] > tiny and level[to[e]] == level[v] + 1:
                    break
                turn[v] += 1
            else:
                if not path:
                    break
                e = path.pop()
                v = to[e ^ 1]
                turn[v] += 1
                continue
            path.append(e)
            v = to[e]
    return [x >= 0 for x in level[:n]]


def main_text(html: str | None) -> str:
    """Content blocks of a page, one a line."""
    blocks = Reader().read(html or "")
    if not blocks:
        return ""
    has_content = any(b.kind > 0 for b in blocks)
    label = minimum_cut([theta(b, has_content) for b in blocks], edges(blocks))
    return "\n".join(b.text for b, content in zip(blocks, label) if content)


def extract(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` of every row of ``pages``.

    A null or empty page, or one without content, has the empty text. Rows are answered one by one, so
    null or repeated ids and urls stay as they are; other columns are ignored. Pages are read whole.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, "html"):
            text = [main_text(x) for x in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(text, pa.string()), pa.array([len(t) for t in text], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    kind = pages.schema["page_id"].dataType.simpleString()
    return pages.select("page_id", "url", "html").mapInArrow(run, f"page_id {kind}, url string, text string, n_chars long")
