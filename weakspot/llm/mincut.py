"""Main text of web pages by minimum cut.

A page becomes a row of text blocks with their place in the DOM. A linear
classifier gives each block a cost for either label (article or
boilerplate); the costs are the capacities from the two terminals. Blocks
next to each other and blocks that follow one another in the same container
are tied by smoothness edges, stronger the deeper the container they share.
The minimum cut is the cheapest labelling of the whole page; blocks on the
article's side, in page order, are the text.

The graph is reduced first: a block whose own costs outweigh all of its ties
keeps its label whatever the others get, so it is fixed and its ties become
costs of its neighbours. What is left is solved by augmenting paths.

NULL, empty and tag-free pages are handled alike (a page of bare text is one
block); broken markup closes at the next block. Nothing is capped. Extra
columns are ignored; each row, repeated or not, gives one row.
"""

from __future__ import annotations

import re
from collections import deque
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame

from weakspot.llm.arrow import map_columns, texts

# quoted values are skipped whole; where quotes are not closed a tag ends at the first bracket. No part is tried twice.
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(script|style|noscript|template|svg|iframe|object|textarea|select|title|head)\b(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)((?>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)(?=>)|[^>]*+)>|<[!?][^>]*+>", re.S)
ATTRIBUTE = re.compile(r"\b(class|id|role|itemprop|aria-label|hidden|style)\b(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.I)
WORDS = re.compile(r"[A-Za-z][a-z]+|[A-Z]+(?![a-z])|[a-z]+")
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q s samp small span strike strong "
                   "sub sup time tt u var wbr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SKIPPED = frozenset("button option datalist audio video canvas".split())
# costs in thousandths of a log-odds unit, positive for article
TAG_COST = {"nav": -6000, "footer": -6000, "aside": -6000, "form": -5000, "menu": -6000, "dialog": -5000, "header": -4000, "fieldset": -5000,
            "article": 3500, "main": 2500}
BAD = frozenset("ad ads advert advertisement advertising banner sponsor sponsored promo promotion nav navbar navigation menu breadcrumb breadcrumbs "
                "sidebar footer masthead cookie cookies consent gdpr notice notification alert popup modal overlay newsletter subscribe "
                "subscription signup login share sharing social related recommended recommendations trending popular comment comments reply replies "
                "discussion disqus respond widget toolbar pagination pager copyright legal disclaimer tags paywall search form skip header".split())
GOOD = frozenset("article content main post entry story body text prose".split())
ROLES = {"navigation": -6000, "banner": -5000, "contentinfo": -6000, "complementary": -6000, "search": -5000, "dialog": -5000, "alert": -5000,
         "form": -5000, "main": 2500, "article": 3000}
NEXT, SAME = 700, 900


def _container_cost(tag: str, attributes: str) -> int:
    """What an element says about the text in it."""
    cost = TAG_COST.get(tag, 0)
    good = bad = False
    for name, *values in ATTRIBUTE.findall(attributes) if attributes else ():
        name, value = name.lower(), "".join(values)
        if name == "hidden" or name == "style" and "display:none" in value.replace(" ", "").lower():
            return -9000
        if name == "role":
            cost += ROLES.get(value.lower(), 0)
        elif name in ("class", "id", "itemprop", "aria-label"):
            words = {w.lower() for w in WORDS.findall(value)}
            good, bad = good or bool(words & GOOD), bad or bool(words & BAD)
    if bad and tag not in ("body", "html"):
        return min(cost, 0) - 5500
    return cost + (2000 if good else 0)


class Block:
    __slots__ = ("text", "path", "cost", "links")

    def __init__(self, text, path, cost, links):
        self.text, self.path, self.cost, self.links = text, path, cost, links


def blocks(html: str) -> list[Block]:
    """Text blocks in page order; ``path`` holds the ids of open containers."""
    out: list[Block] = []
    stack: list[tuple[str, int, int, bool]] = []  # tag, id, cost so far, whether text in it is dropped
    held: list[str] = []
    linked = at = serial = 0
    anchors = 0
    dropped, cost = False, 0

    def flush() -> None:
        nonlocal held, linked
        if held:
            text = " ".join("".join(held).split())
            if text:
                out.append(Block(text, tuple(s[1] for s in stack), cost, min(1.0, linked / len(text))))
        held, linked = [], 0

    def take(part: str) -> None:
        nonlocal linked
        if part and not dropped:
            part = unescape(part) if "&" in part else part
            held.append(part)
            if anchors:
                linked += len(part.strip())

    while m := TOKEN.search(html, at):
        take(html[at:m.start()])
        at = m.end()
        raw, closing, tag, attributes = m[1], m[2], (m[3] or "").lower(), m[4] or ""
        if raw:
            end = re.compile(rf"</{raw}\s*>", re.I).search(html, at)
            if raw.lower() == "head" and not end:
                end = re.compile(r"(?=<body\b)", re.I).search(html, at)
            flush()
            at = end.end() if end else at if raw.lower() == "head" else len(html)
        elif not tag:
            continue
        elif tag in INLINE and tag not in ("label",):
            if tag == "a":
                anchors = max(0, anchors + (-1 if closing else 1)) if closing or not attributes.rstrip().endswith("/") else anchors
        elif closing:
            flush()
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == tag:
                    # an inner element's end must not close an outer container of another kind
                    del stack[i:]
                    break
            dropped, cost = (stack[-1][3], stack[-1][2]) if stack else (False, 0)
            anchors = 0
        else:
            flush()
            anchors = 0
            if tag in VOID or attributes.rstrip().endswith("/"):
                continue
            if tag in ("p", "h1", "h2", "h3", "h4", "h5", "h6", "li", "dt", "dd", "tr", "td", "th", "option"):
                same = ("p", "h1", "h2", "h3", "h4", "h5", "h6") if tag[0] in "ph" else (tag,)
                if stack and stack[-1][0] in same:
                    stack.pop()
            serial += 1
            outer = stack[-1] if stack else ("", 0, 0, False)
            own = _container_cost(tag, attributes)
            # boilerplate inside an article stays boilerplate; an article inside a wrapper may still win
            if tag in ("article", "main") and own > 0:
                total = own if outer[2] > -5000 else outer[2]
            elif own < 0:
                total = min(outer[2], 0) + own
            elif outer[2] < -3000:
                total = outer[2]
            else:
                total = min(outer[2] + own, 6000)
            if tag == "header" and outer[2] > 0:
                total = outer[2] - 800  # an article's own heading
            stack.append((tag, serial, total, outer[3] or tag in SKIPPED))
            dropped, cost = stack[-1][3], total
    take(html[at:])
    flush()
    return out


def block_cost(block: Block) -> int:
    """Log-odds of a block being article text, in thousandths."""
    text = block.text
    size = len(text)
    cost = -600 + min(size, 400) * 5 - int(3500 * block.links)
    if text[-1] in ".!?…\"”":
        cost += 700
    if text[:1] in "©" or "all rights reserved" in text[:200].lower():
        cost -= 3000
    return cost + block.cost


def label(costs: list[int], edges: dict[tuple[int, int], int]) -> list[bool]:
    """Minimum cut: True is the side with positive costs."""
    near: list[dict[int, int]] = [{} for _ in costs]
    for (a, b), w in edges.items():
        near[a][b] = near[a].get(b, 0) + w
        near[b][a] = near[b].get(a, 0) + w
    costs, side = list(costs), [None] * len(costs)
    tie = [sum(n.values()) for n in near]
    waiting = deque(range(len(costs)))
    while waiting:
        v = waiting.popleft()
        if side[v] is None and abs(costs[v]) >= tie[v] and (costs[v] or not tie[v]):
            side[v] = costs[v] > 0
            for u, w in near[v].items():
                if side[u] is None:
                    costs[u] += w if side[v] else -w
                    tie[u] -= w
                    waiting.append(u)
    left = [v for v in range(len(costs)) if side[v] is None]
    if left:
        source, sink = -1, -2
        room = {v: {u: w for u, w in near[v].items() if side[u] is None} for v in left}
        room[source], room[sink] = {}, {}
        for v in left:
            if costs[v] > 0:
                room[source][v], room[v][source] = costs[v], 0
            elif costs[v] < 0:
                room[v][sink], room[sink][v] = -costs[v], 0
        while True:
            came, queue = {source: source}, deque([source])
            while queue and sink not in came:
                v = queue.popleft()
                for u, w in room[v].items():
                    if w > 0 and u not in came:
                        came[u] = v
                        queue.append(u)
            if sink not in came:
                break
            path, v = [], sink
            while v != source:
                path.append((came[v], v))
                v = came[v]
            flow = min(room[a][b] for a, b in path)
            for a, b in path:
                room[a][b] -= flow
                room[b][a] += flow
        for v in left:
            side[v] = v in came
    return side


def main_blocks(html: str) -> list[tuple[str, bool]]:
    """(text, whether it is article text) of every block."""
    found = blocks(html)
    edges: dict[tuple[int, int], int] = {}
    last: dict[int, int] = {}
    for i, block in enumerate(found):
        if i:
            other = found[i - 1]
            shared = sum(a == b for a, b in zip(block.path, other.path))
            deep = max(len(block.path), len(other.path), 1)
            edges[i - 1, i] = NEXT * shared // deep
        for level, container in enumerate(block.path[:-1], 1):
            if level >= len(block.path) - 1:
                if container in last:
                    pair = (last[container], i)
                    edges[pair] = edges.get(pair, 0) + SAME
                last[container] = i
    side = label([block_cost(b) for b in found], edges)
    return [(b.text, s) for b, s in zip(found, side)]


def main_text(html: str) -> str:
    return " ".join(text for text, article in main_blocks(html) if article)


def extract(pages: DataFrame, keep: list[str], html: str = "html") -> DataFrame:
    """(*keep, text, n_chars) of every page."""
    fields = ", ".join(f"`{c}` {pages.schema[c].dataType.simpleString()}" for c in keep)

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            made = [main_text(h) for h in texts(batch, html)]
            yield {**{c: batch.column(c) for c in keep}, "text": made, "n_chars": [len(t) for t in made]}

    return map_columns(pages, list(dict.fromkeys([*keep, html])), f"{fields}, text string, n_chars long", run)
