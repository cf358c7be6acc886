"""Main text of web pages by minimum cut.

A page is read into blocks of text with their place in the element tree (a parent
for each element, so time and memory grow with the page, however deep it is). A
scorer says for each block how likely it is part of the article; its costs are
the capacities between the block and the two terminals. Blocks that follow each
other or share a parent are tied by edges that weaken with their distance in the
tree. The minimum cut then labels all blocks at once: a short paragraph between
long ones stays with them, a link list beside the article does not.

Blocks whose own costs outweigh all their edges are labelled first and folded
into their neighbours' costs, which leaves the cut as it is; maximum flow
decides the rest.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter, deque
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from tripmill.llm.common import small_batches

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<![^>]*>|<\?[^>]*>"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)([^>]*)>",
    re.S,
)
_ATTRIBUTE = re.compile(r"([a-zA-Z-]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")

#: Fixed values of HTML: elements without content, elements whose text is not
#: shown as text, and elements that do not break a block.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title xmp".split())
DROPPED = set("datalist head option select template".split())
#: Elements whose text counts as links: they lead away from what is read.
LINKS = set("a button".split())
#: Elements of other vocabularies: nothing in them breaks a block, and only there a tag can close itself.
FOREIGN = set("math svg".split())
INLINE = set("a abbr acronym b bdi bdo big button cite code data del dfn em font i ins kbd label mark q ruby s samp small span strike strong sub sup time tt u var wbr rb rt rp".split())
#: What may stand in a head; anything else ends it.
HEAD = set("base link meta noscript script style template title".split())
#: Start tags that end an open element of these kinds.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "thead": {"tr"}, "tbody": {"tr", "thead"}}
#: Where such a search ends.
SCOPE = set("html body div section article main aside nav header footer table ul ol dl form fieldset td th blockquote".split())

#: Words in names of classes, ids and roles that mark what is not the article, and what is.
AWAY = set(
    "ad ads advert adverts advertisement advertising adsense banner sponsor sponsored promo promotion promoted cookie cookies consent gdpr notice notices alert popup modal overlay dialog newsletter subscribe subscription signup login paywall "
    "sidebar aside widget widgets related recommended recommendations trending popular nav navbar navigation menu breadcrumb breadcrumbs masthead topbar toolbar footer copyright legal disclaimer share sharing social follow "
    "comment comments disqus reply replies respond discussion search pagination pager skip hidden complementary contentinfo taboola outbrain".split()
)
TOWARDS = set("article content post entry story main prose".split())
#: Elements that hold what is not the article.
ASIDE = set("nav footer aside form dialog menu".split())
#: Names of what readers write.
READERS = set("comment comments disqus reply replies respond discussion".split())
#: A name can be wrong: it is not believed of an element with more than this share of a page's text, if all that is kept is less than that share of the element's.
MOST, LITTLE = 0.5, 0.2


class Named:
    """An element that a name marks as not the article: the one around it of that kind, whether readers write there, and its text."""

    __slots__ = ("around", "believed", "chars", "readers")

    def __init__(self, around: Named | None, readers: bool) -> None:
        self.around, self.readers, self.chars, self.believed = around, readers, 0, True


class Block:
    """A block's text, the characters of it in links, its innermost element's tag and number, its marks and the innermost name."""

    __slots__ = ("away", "element", "links", "named", "tag", "text", "towards")

    def __init__(self, text: str, links: int, tag: str, element: int, away: bool, towards: bool, named: Named | None = None) -> None:
        self.text, self.links, self.tag, self.element, self.away, self.towards, self.named = text, links, tag, element, away, towards, named


def _marks(tag: str, attributes: str, inside: bool) -> tuple[bool, set[str], bool]:
    """Whether an element leads away from the article, the names that say so, and whether it leads towards it."""
    away, named, towards = tag in ASIDE or (tag == "header" and not inside), {"fieldset"} if tag == "fieldset" else set(), tag in ("article", "main")
    if attributes and not attributes.isspace():
        for name, *values in _ATTRIBUTE.findall(attributes):
            name, value = name.lower(), next((v for v in values if v), "")
            if name in ("class", "id", "role"):
                words = {w.lower() for w in _PART.findall(value)}
                if tag not in ("html", "body", "main", "article"):
                    named |= words & (AWAY if inside else AWAY | {"header"})
                towards |= bool(words & TOWARDS)
            elif name == "hidden" or (name == "aria-hidden" and value == "true") or (name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value)):
                away = True
    return away, named, towards


class Open:
    """An element that has not ended: tag, innermost element that breaks blocks (itself or around), marks."""

    __slots__ = ("away", "dropped", "element", "foreign", "linked", "named", "tag", "block_tag", "towards")

    def __init__(self, tag: str, element: int, block_tag: str, away: bool, towards: bool, dropped: bool, linked: bool, foreign: bool, named: Named | None = None) -> None:
        self.tag, self.element, self.block_tag, self.named = tag, element, block_tag, named
        self.away, self.towards, self.dropped, self.linked, self.foreign = away, towards, dropped, linked, foreign


def blocks_of(page: str) -> tuple[list[Block], list[int], list[int]]:
    """The blocks of a page that have text, in page order; parent and depth of each element that breaks blocks."""
    out: list[Block] = []
    parts: list[str] = []
    linked: list[str] = []
    parent, depth = [-1], [0]
    stack = [Open("", 0, "", False, False, False, False, False)]
    count: Counter[str] = Counter()  # of open elements
    at = 0

    def flush() -> None:
        text = " ".join("".join(parts).split())
        if text:
            top = stack[-1]
            out.append(Block(text, len(" ".join("".join(linked).split())), top.block_tag, top.element, top.away, top.towards, top.named))
        parts.clear()
        linked.clear()

    def say(raw: str) -> None:
        if raw and not stack[-1].dropped:
            text = html.unescape(raw) if "&" in raw else raw
            parts.append(text)
            if stack[-1].linked:
                linked.append(text)

    def close(index: int) -> None:
        if stack[-1].element != stack[index - 1].element:  # an element that breaks blocks is among them
            flush()
        count.subtract(x.tag for x in stack[index:])
        del stack[index:]

    size, last = len(page), page.rfind(">") + 1
    while at < size:
        # what no ">" follows is no tag, so it is not sought there; a comment ends with the page
        m = _TOKEN.search(page, at, last) if at < last else None
        if not m:
            cut = page.find("<!--", max(at, last))
            say(page[at : cut if cut >= 0 else size])
            break
        say(page[at : m.start()])
        at = m.end()
        end, tag, attributes = (m[1], m[2], m[3]) if m[2] else (m[4], m[5], m[6])
        if not tag:
            continue
        tag = tag.lower()
        if end:
            if count[tag]:
                i = len(stack) - 1
                while stack[i].tag != tag:
                    i -= 1
                close(i)
            elif tag not in INLINE:
                flush()
            continue
        if tag == "br" or tag == "hr":
            say(" ")
            if tag == "hr":
                flush()
            continue
        if tag in VOID:
            continue
        if tag in RAW:
            done = re.compile(rf"</{tag}[\s>/]", re.I).search(page, at)
            at = page.find(">", done.start()) + 1 if done and page.find(">", done.start()) >= 0 else size
            continue
        foreign = stack[-1].foreign or tag in FOREIGN
        breaks = tag not in INLINE and not foreign
        if breaks:
            flush()
            if stack[-1].tag == "head" and tag not in HEAD:
                close(len(stack) - 1)
            ends = CLOSES.get(tag, set())
            left = count["p"] + sum(count[x] for x in ends)
            i = len(stack) - 1
            while left and i > 0 and (stack[i].tag not in SCOPE or stack[i].tag in ends):
                if stack[i].tag == "p" or stack[i].tag in ends:
                    before = count["p"] + sum(count[x] for x in ends)
                    close(i)
                    left -= before - count["p"] - sum(count[x] for x in ends)
                i -= 1
        top = stack[-1]
        if foreign and attributes.endswith("/"):
            continue
        away, names, towards = _marks(tag, attributes, top.towards) if tag not in INLINE or attributes else (False, None, False)
        named = Named(top.named, bool(names & READERS)) if names else top.named
        element, block_tag = top.element, top.block_tag
        if breaks:
            parent.append(element)
            depth.append(depth[element] + 1)
            element, block_tag = len(parent) - 1, tag
        count[tag] += 1
        stack.append(Open(tag, element, block_tag, top.away or away, (top.towards or towards) and not (away or names), top.dropped or tag in DROPPED, top.linked or tag in LINKS, foreign, named))
    flush()
    return out, parent, depth


def score(block: Block) -> float:
    """Log odds that a block is part of the article."""
    words = block.text.count(" ") + 1
    s = -0.8 + min(2.0, 0.4 * math.log2(words))
    s += {"p": 1.2, "blockquote": 0.8, "pre": 0.8, "li": -0.4, "td": -0.4, "th": -0.4, "label": -1.5}.get(block.tag, 0.6 if re.fullmatch("h[1-6]", block.tag) else 0.0)
    s -= 5 * block.links / len(block.text)
    if words > 4 and block.text[-1] in ".!?…»\"”’":
        s += 0.6
    if block.text[0] == "©":
        s -= 2
    named = block.named
    while named and not named.believed:
        named = named.around
    return s + 3.0 * block.towards - 7.0 * (block.away or named is not None)


def ties(blocks: list[Block], parent: list[int], depth: list[int]) -> list[tuple[int, int, float]]:
    """Edges between neighbours, weaker with their distance in the tree, and between neighbours among the blocks of one parent."""
    out, last = [], {}
    for i, b in enumerate(blocks):
        around = parent[b.element]
        if i:
            x, y = blocks[i - 1].element, b.element
            apart = 0
            while x != y:  # up to where both are; in page order, that passes each element twice at most
                if depth[x] >= depth[y]:
                    x = parent[x]
                else:
                    y = parent[y]
                apart += 1
            out.append((i - 1, i, 1.6 / (1 + apart)))
        if last.get(around, i) != i:
            out.append((last[around], i, 0.4))
        last[around] = i
    return out


def min_cut(gain: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """Labels with the least cost: a label against ``gain`` costs it, an edge between two labels its weight."""
    n = len(gain)
    unit = 1 << 20
    own = [round(g * unit) for g in gain]
    near: list[dict[int, int]] = [{} for _ in range(n)]
    for a, b, w in edges:
        if a != b and (w := round(w * unit)) > 0:
            near[a][b] = near[a].get(b, 0) + w
            near[b][a] = near[b].get(a, 0) + w
    label: list[bool | None] = [None] * n
    queue = list(range(n))
    while queue:  # labels that hold whatever the neighbours have
        i = queue.pop()
        if label[i] is None and abs(own[i]) >= sum(near[i].values()):
            label[i] = own[i] > 0
            for j, w in near[i].items():
                own[j] += w if label[i] else -w
                del near[j][i]
                queue.append(j)
            near[i] = {}
    rest = [i for i in range(n) if label[i] is None]
    if rest:
        reach = _max_flow(rest, own, near)
        for i in rest:
            label[i] = i in reach
    return label


def _max_flow(nodes: list[int], own: list[int], near: list[dict[int, int]]) -> set[int]:
    """What the source still reaches after a maximum flow along shortest paths."""
    source, sink = -1, -2
    left: dict[int, dict[int, int]] = {i: dict(near[i]) for i in nodes}
    left[source], left[sink] = {}, {}
    for i in nodes:
        if own[i] > 0:
            left[source][i], left[i][source] = own[i], 0
        elif own[i] < 0:
            left[i][sink], left[sink][i] = -own[i], 0
    while True:
        back = {source: source}
        queue = deque([source])
        while queue and sink not in back:
            a = queue.popleft()
            for b, room in left[a].items():
                if room > 0 and b not in back:
                    back[b] = a
                    queue.append(b)
        if sink not in back:
            return set(back)
        path, b = [], sink
        while b != source:
            path.append((back[b], b))
            b = back[b]
        flow = min(left[a][b] for a, b in path)
        for a, b in path:
            left[a][b] -= flow
            left[b][a] = left[b].get(a, 0) + flow


def _believe_less(blocks: list[Block], kept: list[bool]) -> bool:
    """Names of elements that hold most of a page are not believed if next to nothing is kept; whether there are any."""
    names: list[Named] = []
    known: set[int] = set()
    for b in blocks:
        n = b.named
        while n and id(n) not in known:
            known.add(id(n))
            names.append(n)
            n = n.around
        if b.named:
            b.named.chars += len(b.text) - b.links
    # inner ones come before those around them, once sorted by how many are around
    depth: dict[int, int] = {}
    for n in names:
        path = []
        while n and id(n) not in depth:
            path.append(n)
            n = n.around
        at = depth[id(n)] if n else 0
        for x in reversed(path):
            depth[id(x)] = at = at + 1
    for n in sorted(names, key=lambda n: -depth[id(n)]):
        if n.around:
            n.around.chars += n.chars
    total = sum(len(b.text) for b in blocks)
    have = sum(len(b.text) for b, k in zip(blocks, kept) if k)
    doubted = [n for n in names if n.chars > MOST * total and (have < LITTLE * n.chars if not n.readers else not have)]
    for n in doubted:
        n.believed = False
    return bool(doubted)


def main_text(page: str | None) -> str:
    """The article's blocks, joined by two line feeds."""
    blocks, parent, depth = blocks_of(page) if page else ([], [], [])
    edges = ties(blocks, parent, depth)
    kept = min_cut([score(b) for b in blocks], edges)
    if any(b.named for b in blocks) and _believe_less(blocks, kept):
        kept = min_cut([score(b) for b in blocks], edges)
    return "\n\n".join(b.text for b, k in zip(blocks, kept) if k)


def extract(pages: DataFrame, key: str = "page_id", url: str = "url", page: str = "html") -> DataFrame:
    """key, url, text, n_chars of every row.

    Null, empty and textless pages have an empty text. A page is one row's
    work, whatever its length; repeated rows give repeated results.
    """
    small_batches(pages.sparkSession)
    kinds = dict(pages.dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(p) for p in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], [key, url, "text", "n_chars"])

    return pages.select(key, url, page).mapInArrow(run, f"{key} {kinds[key]}, {url} {kinds[url]}, text string, n_chars long")
