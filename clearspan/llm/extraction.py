"""Main text of web pages by minimum-cut labelling (operator 10).

A page is read into blocks of text. A linear classifier over what surrounds a block (its
elements, their names, its links) and over the block itself gives the cost of calling it
content and of calling it boilerplate; these costs are the capacities to the two terminals.
Blocks that follow one another, and blocks under one parent, are joined by smoothness edges.
The minimum cut, found by maximum flow, labels all blocks of the page at least total cost.
"""

from __future__ import annotations

import re
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass, field
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clearspan.llm.common import need

#: Elements without content of their own.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is no text of the page.
SILENT = frozenset("script style noscript template svg math iframe object canvas audio video head select textarea button".split())
#: Of these, those whose content is raw up to their end tag.
RAW = frozenset("script style textarea title xmp".split())
#: Elements that stand inside a line of text; all others end a block.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark meter output q rp rt ruby s samp small "
    "span strike strong sub sup time tt u var wbr nobr".split()
)
#: Elements, and words in class, id or role, that speak for or against content.
GOOD_TAGS = frozenset("article main".split())
BAD_TAGS = frozenset("nav footer aside form dialog menu fieldset select option".split())
GOOD_NAMES = re.compile(r"(?:^|[-_ ])(?:article|main|content|post|entry|story|body|text)(?:$|[-_ ]|body|content|text)", re.I)
BAD_NAMES = re.compile(
    r"(?:^|[-_ ])(?:ads?|adverts?|advertisements?|banners?|sponsor(?:ed)?|promos?|promotions?|nav|navbar|navigation|menus?|breadcrumbs?|"
    r"side ?-?bars?|footers?|header|masthead|topbar|comments?|commentlist|discuss|disqus|repl(?:y|ies)|respond|cookies?|consent|gdpr|notices?|"
    r"alerts?|popups?|modal|overlay|newsletters?|subscri(?:be|ption)|signup|login|search|share|sharing|social|related|recommend(?:ed|ations?)?|"
    r"widgets?|tags?|pagination|pager|copyright|legal|disclaimer|toolbar|skip|contentinfo|complementary|dialog|alert)(?:$|[-_ 0-9])",
    re.I,
)

#: A quote opens a value only right after an equals sign; elsewhere it is a character like others.
_TAG = re.compile(r"<!--.*?(?:-->|$)|<!\[CDATA\[.*?(?:\]\]>|$)|<[!?][^>]*(?:>|$)|<(/?)([A-Za-z][^\s/>]*)((?:=\s*\"[^\"]*(?:\"|$)|=\s*'[^']*(?:'|$)|[^>])*)(?:>|$)", re.S)
_ATTRIBUTE = re.compile(r"(class|id|role|hidden|aria-hidden|style)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
_LAYOUT = re.compile(r"\b(?:has|with|without|no)[-_][-\w]+", re.I)
_WHITE = re.compile(r"\s+")

#: An open element that the start of another one ends.
_ENDS = {
    "p": frozenset("address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split()),
    "li": frozenset(["li"]),
    "dt": frozenset(["dt", "dd"]),
    "dd": frozenset(["dt", "dd"]),
    "tr": frozenset(["tr", "tbody", "tfoot"]),
    "td": frozenset(["td", "th", "tr", "tbody", "tfoot"]),
    "th": frozenset(["td", "th", "tr", "tbody", "tfoot"]),
    "option": frozenset(["option", "optgroup"]),
}

#: Weights of the classifier: evidence for content, in units of the smoothness edges.
BIAS = 0.5
W_GOOD_TAG, W_GOOD_NAME, W_BAD_TAG, W_BAD_NAME = 5.0, 1.5, -12.0, -9.0
W_HEADER_OUTSIDE, W_LINKS, W_LONG, W_SENTENCE = -8.0, -3.0, 2.0, 0.5
#: Smoothness: neighbours in the page, and neighbours under one parent.
ADJACENT, SIBLING = 0.6, 0.8


@dataclass
class Block:
    """A block of text: its words, how many characters are inside links, and the elements around it."""

    text: str
    linked: int
    path: tuple[int, ...]
    good_tags: int = 0
    good_names: int = 0
    bad_tags: int = 0
    bad_names: int = 0
    header: bool = False
    parts: list[str] = field(default_factory=list)


def _names(attributes: str) -> tuple[str, bool]:
    """Class, id and role as one text, and whether the element is hidden."""
    names, hidden = [], False
    for key, *values in _ATTRIBUTE.findall(attributes):
        value, key = "".join(values), key.lower()
        if key == "hidden" or key == "aria-hidden" and value.lower() == "true":
            hidden = True
        elif key == "style":
            hidden |= "display:none" in value.replace(" ", "").lower()
        elif key != "aria-hidden":
            names.append(value)
    return " ".join(names), hidden


def blocks_of(html: str) -> list[Block]:
    """Blocks of a page in order; never fails on broken markup: open elements end with the page."""
    out: list[Block] = []
    # open elements: tag, number, good tag, good name, bad tag, bad name, header, silent
    stack: list[tuple] = [("", 0, 0, 0, 0, 0, False, False)]
    pieces: list[str] = []
    state = {"linked": 0, "in_link": 0, "made": 0}

    def flush() -> None:
        if pieces:
            text = _WHITE.sub(" ", unescape("".join(pieces))).strip()
            if text:
                own = [e for e in stack if e[0] not in INLINE]
                top = own[-1]
                out.append(Block(text, state["linked"], tuple(e[1] for e in own), *top[2:6], top[6]))
            pieces.clear()
        state["linked"] = 0

    def add(text: str) -> None:
        if text and not stack[-1][7]:
            pieces.append(text)
            if state["in_link"]:
                state["linked"] += len(text.strip())

    def close(depth: int) -> None:
        if any(e[0] not in INLINE for e in stack[depth:]):
            flush()
        state["in_link"] -= sum(e[0] == "a" for e in stack[depth:])
        del stack[depth:]

    at, n = 0, len(html)
    while at < n:
        match = _TAG.search(html, at)
        if match is None:
            add(html[at:])
            break
        add(html[at : match.start()])
        at = match.end()
        if match[2] is None:
            continue
        tag = match[2].lower()
        if match[1]:
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth][0] == tag:
                    close(depth)
                    break
                if stack[depth][0] not in INLINE and tag in INLINE:
                    break
            else:
                if tag == "p":
                    flush()
            continue
        if tag == "br":
            add(" ")
            continue
        while len(stack) > 1 and tag in _ENDS.get(next((e[0] for e in reversed(stack) if e[0] not in INLINE), ""), ()):
            close(next(d for d in range(len(stack) - 1, 0, -1) if stack[d][0] not in INLINE))
        if tag not in INLINE:
            flush()
        if tag in VOID:
            continue
        names, hidden = _names(match[3]) if match[3] else ("", False)
        # a wrapper may only say what lies elsewhere on the page
        names = "" if tag in ("html", "body") else _LAYOUT.sub("", names)
        up = stack[-1]
        state["made"] += 1
        block = tag not in INLINE
        in_article = up[2] > 0
        stack.append(
            (
                tag,
                state["made"],
                up[2] + (tag in GOOD_TAGS),
                up[3] + bool(block and names and GOOD_NAMES.search(names)),
                up[4] + (tag in BAD_TAGS),
                up[5] + bool(names and BAD_NAMES.search(names)),
                up[6] or tag == "header" and not in_article,
                up[7] or hidden or tag in SILENT,
            )
        )
        if tag == "a":
            state["in_link"] += 1
        if match[3].endswith("/") and tag not in INLINE and tag not in ("p", "div", "li", "td"):
            close(len(stack) - 1)
        if tag in RAW and len(stack) > 1 and stack[-1][0] == tag:
            end = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(html, at)
            at = end.start() if end else n
    flush()
    return out


def evidence(block: Block, has_article: bool) -> float:
    """What speaks for content (positive) or boilerplate (negative)."""
    n = len(block.text)
    score = BIAS + W_GOOD_NAME * min(1, block.good_names) + W_BAD_TAG * min(1, block.bad_tags) + W_BAD_NAME * min(1, block.bad_names)
    if block.good_tags:
        score += W_GOOD_TAG
    elif has_article:
        score -= W_GOOD_TAG
    score += W_HEADER_OUTSIDE * block.header
    if block.linked * 2 > n and not block.good_tags:
        score += W_LINKS
    score += W_LONG * min(1.0, n / 400)
    score += W_SENTENCE * (block.text[-1] in ".!?:…")
    return score


class Flow:
    """Maximum flow by shortest augmenting paths in levels (Dinic)."""

    def __init__(self, nodes: int):
        self.to: list[int] = []
        self.left: list[float] = []
        self.edges: list[list[int]] = [[] for _ in range(nodes)]

    def join(self, a: int, b: int, there: float, back: float = 0.0) -> None:
        self.edges[a].append(len(self.to))
        self.to.append(b)
        self.left.append(there)
        self.edges[b].append(len(self.to))
        self.to.append(a)
        self.left.append(back)

    def _levels(self, source: int) -> list[int]:
        level = [-1] * len(self.edges)
        level[source] = 0
        queue = deque([source])
        while queue:
            a = queue.popleft()
            for e in self.edges[a]:
                b = self.to[e]
                if self.left[e] > 1e-12 and level[b] < 0:
                    level[b] = level[a] + 1
                    queue.append(b)
        return level

    def source_side(self, source: int, sink: int) -> list[bool]:
        """Nodes that stay with the source in a minimum cut."""
        while True:
            level = self._levels(source)
            if level[sink] < 0:
                return [x >= 0 for x in level]
            at = [0] * len(self.edges)
            path: list[int] = []
            a = source
            while True:
                if a == sink:
                    least = min(self.left[e] for e in path)
                    for e in path:
                        self.left[e] -= least
                        self.left[e ^ 1] += least
                    cut = next(k for k, e in enumerate(path) if self.left[e] <= 1e-12)
                    a = self.to[path[cut] ^ 1]
                    del path[cut:]
                    continue
                edges = self.edges[a]
                while at[a] < len(edges):
                    e = edges[at[a]]
                    if self.left[e] > 1e-12 and level[self.to[e]] == level[a] + 1:
                        break
                    at[a] += 1
                if at[a] < len(edges):
                    path.append(edges[at[a]])
                    a = self.to[edges[at[a]]]
                elif path:
                    e = path.pop()
                    a = self.to[e ^ 1]
                    at[a] += 1
                else:
                    break


def labels(found: list[Block]) -> list[bool]:
    """Whether each block is content: the labelling of least cost.

    Neighbouring blocks share the less of their surroundings the further apart they hang, so the
    edge between them weighs less; blocks under one parent are joined in a chain.
    """
    n = len(found)
    has_article = any(b.good_tags for b in found)
    scores = [evidence(b, has_article) for b in found]
    if all(s > 0 for s in scores) or all(s <= 0 for s in scores):
        return [s > 0 for s in scores]
    flow = Flow(n + 2)
    last_under: dict[int, int] = {}
    for k, (block, score) in enumerate(zip(found, scores, strict=True)):
        if score > 0:
            flow.join(n, k, score)
        else:
            flow.join(k, n + 1, -score)
        if k:
            a, b = found[k - 1].path, block.path
            shared = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))
            weight = ADJACENT / (1 + len(a) + len(b) - 2 * shared)
            flow.join(k - 1, k, weight, weight)
        parent = block.path[-2] if len(block.path) > 1 else 0
        if parent in last_under:
            flow.join(last_under[parent], k, SIBLING, SIBLING)
        last_under[parent] = k
    return flow.source_side(n, n + 1)[:n]


def main_text(html: str | None) -> str:
    """Main text of a page: its content blocks, joined by line feeds; empty if there is none."""
    found = blocks_of(html) if html else []
    return "\n".join(b.text for b, keep in zip(found, labels(found), strict=True) if keep) if found else ""


def extracted(pages: DataFrame, html: str = "html") -> DataFrame:
    """``pages`` with ``text`` and ``n_chars`` in place of the html and of columns of those names.

    A null or empty html has no text. Every whole page is read; repeated rows are kept.
    """
    need(pages, html)
    kept = [c for c in pages.columns if c not in (html, "text", "n_chars")]
    rows = pages.select(*kept, F.col(html).cast("string").alias("html"))
    out = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name != "html"), "text string", "n_chars bigint"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(x) for x in batch.column(len(kept)).to_pylist()]
            columns = [batch.column(k) for k in range(len(kept))]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], [*kept, "text", "n_chars"]
            )

    return rows.mapInArrow(run, out)


def op10_main_text(spark, sf_dir: str) -> DataFrame:
    """Main text of every row of ``pages``."""
    return extracted(spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html"))
