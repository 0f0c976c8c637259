"""Main text of HTML pages by minimum-cut labelling.

A page is read as blocks: runs of text between block-level tags, with the open
elements around them. A linear score of each block (where it stands, links,
length, punctuation) becomes its capacity to the source if it speaks for content
and to the sink otherwise. Blocks next to each other, and the next sibling blocks
under one parent, are joined by edges whose capacity grows with the share of
open elements that they have in common and is small across the border of a
region such as a menu. The minimum cut, found by maximum flow, separates content
from boilerplate: blocks that the source still reaches are content.

Text comes out in page order: character references decoded, white space in a
block one space, blocks joined by two line feeds. Scripts, styles, comments and
the head hold no blocks; line breaks are white space.

Defined results: a null, empty or blank html, and one whose blocks are all
boilerplate, give an empty text; ill-formed markup is read as far as it goes
(what isn't a tag is text, open elements end with the page); rows are
independent, so repeated pages give repeated rows; an empty table gives an empty
table; further columns are left out. Whole pages are read, however long.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickwork.llm.common import batch_of, renamed, small_batches

#: Fixed values of HTML: elements that end a block, that have no end tag, and whose content isn't text of the page.
BLOCK_TAGS = frozenset("""address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption
figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search section
select summary table tbody td tfoot th thead tr ul""".split())
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW_TAGS = frozenset("script style textarea title iframe noscript noembed noframes xmp template svg math canvas audio video object".split())
HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))
#: An element of the first kind ends when one of its kind opens, up to the element that holds them.
ENDED_BY = {"li": ("li", ("ul", "ol", "menu", "dir")), "dt": ("dt dd", ("dl",)), "dd": ("dt dd", ("dl",)), "tr": ("tr td th", ("table", "tbody", "thead", "tfoot")), "td": ("td th", ("tr", "table")), "th": ("td th", ("tr", "table")), "option": ("option", ("select",))}
#: Of those, the ones that hold markup: without its end tag such a tag is passed over, and the page goes on.
MARKUP_TAGS = frozenset("template svg math canvas audio video object".split())

#: Elements, roles and words of class or id that mark regions.
BAD_TAGS = frozenset("nav footer aside form dialog menu select button fieldset search head".split())
BAD_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert menu menubar toolbar form tablist".split())
BAD_WORDS = frozenset("""ad ads adsense advert adverts advertisement advertising adbox alert banner breadcrumb breadcrumbs byline
colophon comment commentlist comments consent cookie cookies copyright disclaimer disqus dropdown footer gdpr header hidden login
masthead menu menus modal nav navbar navigation newsletter notice notices notification overlay pager pagination paywall popup
promo promoted promotion recommend recommended recommendations related replies reply respond rss search share sharing shoutbox
sidebar sidebars signin signup skyscraper social sponsor sponsored subscribe subscription tagcloud teaser toolbar topbar tracking
widget widgets""".split())
GOOD_TAGS, GOOD_ROLES = frozenset(("article", "main")), frozenset(("article", "main"))
GOOD_WORDS = frozenset("article articlebody body blog content entry main page post story text".split())

TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/<>]*)((?:[^<>"']|"[^"]*"|'[^']*')*)>|<(/?)([a-zA-Z][^\s/<>]*)([^<>]*)>|[^<]+|<""", re.DOTALL)
ATTRIBUTE = re.compile(r"""([a-zA-Z][\w:-]*)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")
MARKED = re.compile(r"class|id|role|hidden|style", re.IGNORECASE)
RAW_END = {tag: re.compile(rf"</{tag}(?=[\s/>])[^>]*>", re.IGNORECASE) for tag in RAW_TAGS}

#: Capacities are whole numbers: this many to a point of score.
UNIT = 100


TEXT_TAGS = frozenset(("p", "blockquote", "pre"))


class Element:
    """An open element; what holds for all within it (``heading``, ``prose``, ``marked``, ``content``) is handed down."""

    __slots__ = ("tag", "parent", "depth", "bad", "good", "soft", "chars", "holds_good", "within_good", "heading", "prose", "marked", "content")

    def __init__(self, tag: str, parent: Element | None, bad: bool, good: bool, soft: bool):
        self.tag, self.parent, self.bad, self.good, self.soft, self.chars, self.holds_good = tag, parent, bad, good, soft, 0, False
        self.depth = parent.depth + 1 if parent else 1
        self.within_good = good or (parent is not None and parent.within_good)
        self.heading = tag in HEADINGS or (parent is not None and parent.heading)
        self.prose = tag in TEXT_TAGS or (parent is not None and parent.prose)
        #: Depth of the innermost element, up to this one, that marks a region.
        self.marked = self.depth if bad or good else parent.marked if parent else 0
        #: False in a region of boilerplate, True in one of content, None in neither; known when the page is read.
        self.content: bool | None = None


class Block:
    """A text, its innermost open element, and how many of the open elements it has in common with the block before."""

    __slots__ = ("text", "leaf", "common", "links")

    def __init__(self, text: str, leaf: Element | None, common: int, links: int):
        self.text, self.leaf, self.common, self.links = text, leaf, common, links

    @property
    def depth(self) -> int:
        return self.leaf.depth if self.leaf else 0


def closes_itself(attributes: str) -> bool:
    """Whether a tag ends with a slash of its own; one at the end of a value without quotes is the value's."""
    return attributes.endswith("/") and (len(attributes) == 1 or attributes[-2].isspace() or attributes[-2] in "\"'")


def element(tag: str, attributes: str, parent: Element | None) -> Element:
    """An element and what its tag, role, class and id say."""
    inside_good = parent is not None and parent.within_good
    bad, soft = tag in BAD_TAGS or (tag == "header" and not inside_good), tag == "form"
    good = tag in GOOD_TAGS
    if attributes and MARKED.search(attributes):
        found = {k.lower(): v.strip("\"'") for k, v in ATTRIBUTE.findall(attributes)}
        words = {w.lower() for key in ("class", "id") for w in WORD.findall(found.get(key, ""))}
        role = found.get("role", "").lower()
        if tag not in ("html", "body") and not good:
            marks, praise = words & BAD_WORDS, words & GOOD_WORDS
            if marks and not words & {"has", "with", "no", "without"} and not (praise and tag not in ("div", "section", "ul", "ol", "p", "span") or praise and not marks & {"comment", "comments", "ad", "ads", "related", "sidebar", "footer", "nav", "menu", "share", "sponsored", "promo", "cookie", "notice"}):
                bad, soft = True, not bad or soft
            good = good or bool(praise & {"article", "articlebody", "post", "entry", "story", "content"}) and not marks
        if role in BAD_ROLES or "hidden" in found or found.get("aria-hidden", "").lower() == "true" or re.search(r"display\s*:\s*none", found.get("style", "")):
            bad = True
        good = good or role in GOOD_ROLES
    return Element(tag, parent, bad, good and not bad, soft)


class Stack:
    """The open elements, and where in the stack those of each tag and the block elements are: no search walks it."""

    def __init__(self):
        self.open: list[Element] = []
        self.places: dict[str, list[int]] = {}
        self.blocks: list[int] = []
        self.link_depth = 0

    def top(self) -> Element | None:
        return self.open[-1] if self.open else None

    def last(self, *tags: str) -> int:
        """Place of the innermost element of one of the tags; -1 without one."""
        return max((self.places[t][-1] for t in tags if self.places.get(t)), default=-1)

    def push(self, e: Element) -> None:
        self.places.setdefault(e.tag, []).append(len(self.open))
        if e.tag in BLOCK_TAGS:
            self.blocks.append(len(self.open))
        self.link_depth += e.tag == "a"
        self.open.append(e)

    def cut(self, size: int) -> None:
        while len(self.open) > size:
            e = self.open.pop()
            self.places[e.tag].pop()
            if e.tag in BLOCK_TAGS:
                self.blocks.pop()
            self.link_depth -= e.tag == "a"

    def ended_by_close(self, tag: str) -> int:
        """Place of the element that ``</tag>`` ends: an inline one within the innermost block element only."""
        k = self.last(tag)
        return k if tag in BLOCK_TAGS or k > (self.blocks[-1] if self.blocks else -1) else -1

    def ended_by_open(self, tag: str) -> int:
        """Place of the element that ends when the block element ``tag`` opens."""
        if tag not in ENDED_BY:  # an open paragraph, if no block element is open in it
            k = self.last("p")
            return k if k >= 0 and k == self.blocks[-1] else -1
        ends, limits = ENDED_BY[tag]
        k = self.last(*ends.split())
        return k if k > self.last(*limits) else -1


def read_blocks(html: str) -> list[Block]:
    """The blocks of a page in order."""
    blocks: list[Block] = []
    stack, elements = Stack(), []
    parts: list[str] = []
    links = at = common = 0
    leaf, placed = None, False
    # fewest open elements since the block before began, and since this one did
    since_block = since_start = 0
    unended: set[str] = set()

    def flush() -> None:
        nonlocal links, leaf, placed, since_block
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                if leaf:
                    leaf.chars += len(text)
                blocks.append(Block(text, leaf, common, links))
                since_block = since_start
            parts.clear()
        links, leaf, placed = 0, None, False

    def cut(size: int) -> None:
        nonlocal since_block, since_start
        stack.cut(size)
        since_block, since_start = min(since_block, size), min(since_start, size)

    scan, end = TOKEN.match, len(html)
    while at < end:
        m = scan(html, at)
        start, at = at, m.end()
        tag = m.group(2) or m.group(5)
        if tag is None:
            if html[start] != "<" or at == start + 1:
                text = m.group()
                if not placed and not text.isspace():
                    leaf, placed, common, since_start = stack.top(), True, since_block, len(stack.open)
                parts.append(unescape(text) if "&" in text else text)
                if stack.link_depth:
                    links += len(text.strip())
            continue
        tag, closing, attributes = tag.lower(), m.group(1) or m.group(4), m.group(3) or m.group(6) or ""
        block = tag in BLOCK_TAGS
        if tag == "br":
            parts.append(" ")
        if block:
            flush()
        if closing:
            k = stack.ended_by_close(tag)
            if k >= 0:
                cut(k)
            continue
        if tag in RAW_TAGS:
            if not closes_itself(attributes) and tag not in unended:
                close = RAW_END[tag].search(html, at)
                if close:
                    at = close.end()
                elif tag in MARKUP_TAGS:
                    unended.add(tag)
                else:
                    at = end
            continue
        if tag in VOID_TAGS:
            continue
        if block:
            k = stack.ended_by_open(tag)
            if k >= 0:
                cut(k)
        e = element(tag, attributes, stack.top())
        if e.good:
            x = e.parent
            while x is not None and not x.holds_good:  # what is around a marked element is marked
                x.holds_good, x = True, x.parent
        if not closes_itself(attributes) or block:
            elements.append(e)
            stack.push(e)
    flush()
    settle(elements, sum(len(b.text) for b in blocks))
    return blocks


def settle(elements: list[Element], total: int) -> None:
    """Add up the characters in all elements, and hand down which of them are content; each comes after its parent."""
    for e in reversed(elements):
        if e.parent is not None:
            e.parent.chars += e.chars
    for e in elements:
        around = e.parent.content if e.parent is not None else None
        if around is False or (e.bad and not (e.soft and e.holds_good and e.chars > 0.6 * total)):
            e.content = False
        else:
            e.content = e.good or around


def score(block: Block) -> float:
    """Points for content, negative for boilerplate."""
    inner = block.leaf.content if block.leaf else None
    heading = block.leaf is not None and block.leaf.heading
    words, chars = block.text.count(" ") + 1, len(block.text)
    points = {None: -0.5, False: -8.0, True: 5.0}[inner]
    share = min(1.0, block.links / chars)
    points += -3.0 * share if share > 0.3 else 0.0
    points += 2.0 if words >= 25 else 1.0 if words >= 10 else -0.5 if words < 4 and not heading else 0.0
    points += 0.5 if block.text[-1] in ".!?…”\"" and words >= 4 else 0.0
    points += 0.5 if heading or (block.leaf is not None and block.leaf.prose) else 0.0
    if inner is None and (block.text[0] == "©" or "all rights reserved" in block.text.lower()):
        points -= 3.0
    return points


def edges(blocks: list[Block]) -> list[tuple[int, int, int]]:
    """Smoothness between neighbours on the page, and between next siblings."""
    out, last = [], {}
    for k, b in enumerate(blocks):
        parent = id(b.leaf.parent) if b.depth > 1 else 0
        near = {k - 1, last.get(parent, k - 1)} - {-1}
        last[parent] = k
        for j in near:
            a = blocks[j]
            common = b.common if j == k - 1 else max(0, b.depth - 1 + (a.leaf is b.leaf))
            apart = any(x.leaf is not None and x.leaf.marked > common for x in (a, b))
            weight = (1.5 if j == k - 1 else 0.75) * (2 * common + 1) / (a.depth + b.depth + 1) * (0.1 if apart else 1.0)
            out.append((j, k, round(UNIT * weight)))
    return out


def source_side(excess: list[int], links: list[tuple[int, int, int]]) -> list[bool]:
    """Nodes on the source's side of the minimum cut; ``excess`` is the capacity to the source, or if negative to the sink.

    Maximum flow by blocking flows in layers: breadth-first layers from all nodes with excess, then depth-first
    pushes along them until none is left, and again until no node with a deficit is reached.
    """
    n = len(excess)
    left = list(excess)
    to: list[int] = []
    capacity: list[int] = []
    out: list[list[int]] = [[] for _ in range(n)]
    for a, b, w in links:
        if w > 0:
            out[a].append(len(to))
            out[b].append(len(to) + 1)
            to += (b, a)
            capacity += (w, w)
    while True:
        layer = [0 if x > 0 else -1 for x in left]
        queue = [k for k in range(n) if left[k] > 0]
        reached = False
        for v in queue:
            for e in out[v]:
                if capacity[e] and layer[to[e]] < 0:
                    layer[to[e]] = layer[v] + 1
                    reached |= left[to[e]] < 0
                    queue.append(to[e])
        if not reached:
            return [x >= 0 for x in layer]
        at = [0] * n
        for s in range(n):
            while left[s] > 0:
                path, v = [], s
                while left[v] >= 0:
                    while at[v] < len(out[v]):
                        e = out[v][at[v]]
                        if capacity[e] and layer[to[e]] == layer[v] + 1:
                            break
                        at[v] += 1
                    if at[v] < len(out[v]):
                        path.append(out[v][at[v]])
                        v = to[path[-1]]
                    elif path:
                        v = to[path.pop() ^ 1]
                        at[v] += 1
                    else:
                        break
                if left[v] >= 0:
                    break
                push = min(left[s], -left[v], *(capacity[e] for e in path))
                for e in path:
                    capacity[e] -= push
                    capacity[e ^ 1] += push
                left[s] -= push
                left[v] += push


def extract(html: str | None) -> str:
    """The main text of a page."""
    blocks = read_blocks(html or "")
    keep = source_side([round(UNIT * score(b)) for b in blocks], edges(blocks))
    return "\n\n".join(b.text for b, k in zip(blocks, keep, strict=True) if k)


SCHEMA = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())])


def extract_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text, n_chars of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            texts = [extract(h) for h in batch.column(2).to_pylist()]
            yield batch_of(SCHEMA, batch.column(0), batch.column(1), texts, [len(t) for t in texts])

    rows = renamed(pages, page_id=id_col, url=url_col, html=html_col)
    return rows.select(F.col("page_id").cast("long"), "url", "html").mapInArrow(run, "page_id long, url string, text string, n_chars long")
