"""Main text of web pages by tag-path ratios.

A page is cut into text nodes, each with its path of open elements from the root.
Over the page's nodes of one path the operator aggregates text length and
punctuation; the ratio of a path is text per node, its density punctuation per node.
Each node takes its path's two ratios; both sequences are smoothed over neighbouring
nodes, fused into one score (the product of the scaled ratios), and paths whose mean
fused score reaches the page's threshold are content paths.

The content root is the deepest element (``article`` or ``main`` where there is one)
that holds the content paths' text. Below it a run of content reaches from the first
to the last block on a content path, and everything within it stays, however much it is,
but for lists of links; before it the headings of the run and what follows them, or
adjoining paragraphs, items and quotations, and such blocks after it, belong to it as well.

Elements that are not the article (navigation, headers and footers of the page, sidebars,
notices, adverts, forms, comments, scripts and styles) are left out besides. They are known
by element, or by a whole name in their class, id or role, unless the element holds the
content: nearly all of the page's text, or a good part of it and its main heading.

Character references are decoded, white space within a block becomes one space,
blocks are joined by one space in page order; inline elements don't break words.
Unclosed elements end with their parent, cut-off pages end where they stop; a tag with an
unclosed quote ends at the next ``>``. Null or empty pages, and pages without content, give
an empty text. Repeated rows repeat theirs, extra columns are ignored. Elements know their
parent, so that deep or unclosed markup takes time and memory in proportion to the page.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagetrail.llm.common import lean

#: Elements without content, those whose content is no text, those that never hold the article, those within a line.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe svg math canvas object audio video select button head".split())
ASIDE = frozenset("nav footer aside form menu dialog fieldset label option".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
#: Parts of a class, id or role that name something other than the article, and parts that may go with them.
NOISE = re.compile(
    r"ads?|advert\w*|adsense|sponsor\w*|promo\w*|banner|cookies?|consent|gdpr|notice|popup|modal|overlay|newsletter|subscri\w+|signup|login|"
    r"nav\w*|menu\w*|breadcrumbs?|sidebar\w*|aside|widget\w*|related|recommend\w*|share|sharing|social\w*|comments?|commentlist|disqus|replies|respond|"
    r"footer\w*|masthead|topbar|toolbar|pagination|pager|copyright|legal|disclaimer|complementary|contentinfo|navigation|search|side",
    re.I,
)
BESIDE = re.compile(
    r"site|page|main|top|bottom|global|left|right|upper|lower|inner|outer|header|head|bar|area|box|list|item|items|links?|icons?|buttons?|container|wrap|wrapper|"
    r"section|block|panel|group|row|col|column|slot|unit|body|content|text|form|posts?|articles?|stories|the|and|primary|secondary|\w?\d+",
    re.I,
)
#: Whole names that are no article though none of their parts tells.
HEADERS = frozenset("site-header page-header main-header top-header global-header".split())
_STOP = re.compile(r"[<>\"']")
_TAG = re.compile(r"</?[a-zA-Z][^\s/><]*")
_MARK = re.compile(r"\b(?:class|id|role|aria-label)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|/|$)|aria-hidden\s*=\s*[\"']?true|display\s*:\s*none", re.I)
_PUNCTUATION = re.compile(r"[,.;:!?、。，！？]")
#: An opening tag that ends an open element of the same kind.
_ENDS = {"p": ("p",), "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
_ENDS_P = frozenset("address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split())
#: Elements that don't end an unclosed head.
_IN_HEAD = frozenset("html head base link meta title style script noscript template".split())
_BORDER = frozenset("article main section div body html table ul ol td th blockquote aside nav header footer form".split())


_HEADING = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Blocks that may begin or end a run of content.
_TAIL = frozenset("p li dd dt blockquote pre figcaption caption td th".split())
#: Shares of a page's text at which an element holds the content whatever its names, without and with the main heading.
HOLDS, HOLDS_HEADING = 0.8, 0.3


def telling(attributes: str) -> bool:
    """Whether a whole name in class, id or role marks an element as not the article."""
    for mark in _MARK.findall(attributes):
        for name in next(filter(None, mark), "").lower().split():
            parts = [x for x in re.split(r"[-_]+", name) if x]
            if name in HEADERS or (any(map(NOISE.fullmatch, parts)) and all(NOISE.fullmatch(x) or BESIDE.fullmatch(x) for x in parts)):
                return True
    return False


class Page:
    """The elements of a page, numbered in page order with parents first, and its text nodes."""

    def __init__(self, page: str) -> None:
        self.name, self.parent, self.path, self.whole = ["#root"], [-1], [0], [0]
        self.noise, self.marked, self.article, self.link, self.head, self.tail = ([False] for _ in range(6))
        self.paths: dict[tuple[int, str], int] = {}
        self.texts: list[tuple[str, int, bool]] = []  # text, element, begins a new block
        self._stack, self._open = [0], {}
        self._border, self._block = [0], [0]  # per open element: the nearest border and block element, as depths
        self._parse(page)
        self._settle()

    def _parse(self, page: str) -> None:
        at, broke, i, unclosed = 0, True, page.find("<"), {}
        while i >= 0:
            end, name, attributes = self._token(page, i, unclosed)
            if end < 0:  # a bare "<"
                i = page.find("<", i + 1)
                continue
            if i > at:
                self.texts.append((page[at:i], self._stack[-1], broke))
                broke = False
            at = end
            if name:
                bare = name.lstrip("/")
                broke = broke or bare not in INLINE
                if name != bare:
                    self._end(bare)
                elif bare in RAW and bare != "head" and not attributes.rstrip().endswith("/"):
                    close = re.compile(rf"</{re.escape(bare)}\s*>", re.I).search(page, at)
                    at = close.end() if close else len(page)
                else:
                    self._begin(bare, attributes)
            i = page.find("<", at)
        if at < len(page):
            self.texts.append((page[at:], self._stack[-1], broke))

    def _token(self, page: str, i: int, unclosed: dict[str, bool]) -> tuple[int, str, str]:
        """(end, lower-case name with a leading slash if it closes, attributes) of the tag or comment at i; end -1 if there is none."""
        size = len(page)
        if page.startswith("<!--", i):
            end = page.find("-->", i + 4)
            return (size if end < 0 else end + 3), "", ""
        if page[i + 1 : i + 2] in ("!", "?"):
            end = page.find(">", i)
            return (size if end < 0 else end + 1), "", ""
        tag = _TAG.match(page, i)
        if not tag:
            return -1, "", ""
        at = tag.end()
        while True:
            stop = _STOP.search(page, at)
            if not stop:
                end = at = size
                break
            at = stop.start()
            if page[at] == ">":
                end = at + 1
                break
            if page[at] == "<":  # a tag that another one cuts off
                end = at
                break
            close = -1 if unclosed.get(page[at]) else page.find(page[at], at + 1)
            if close < 0:
                unclosed[page[at]] = True  # no such quote further on: this holds for all later tags
                at = page.find(">", tag.end())
                end = at = size if at < 0 else at
                end += at < size
                break
            at = close + 1
        return end, tag[0][1:].lower(), page[tag.end() : at]

    def _begin(self, name: str, attributes: str) -> None:
        if name in _ENDS_P:
            self._close(("p",))
        if name in _ENDS:
            self._close(_ENDS[name])
        if name in VOID:
            return
        if name not in _IN_HEAD:
            self._close(("head",))
        above, number, depth = self._stack[-1], len(self.name), len(self._stack)
        self.name.append(name)
        self.parent.append(above)
        self.path.append(self.paths.setdefault((self.path[above], name), len(self.paths) + 1))
        self.whole.append(self.whole[above] if name in INLINE else self.paths.setdefault((self.whole[above], name), len(self.paths) + 1))
        self.noise.append(
            self.noise[above] or name in ASIDE or name == "head" or (name == "header" and not self.article[above]) or bool(_HIDDEN.search(attributes)))
        self.marked.append(name not in ("html", "body", "article", "main") and telling(attributes))
        self.article.append(self.article[above] or name in ("article", "main"))
        self.link.append(self.link[above] or name == "a")
        self.head.append(self.head[above] or name in _HEADING)
        self.tail.append(self.tail[above] or name in _TAIL)
        self._stack.append(number)
        self._open.setdefault(name, []).append(depth)
        self._border.append(depth if name in _BORDER else self._border[-1])
        self._block.append(depth if name not in INLINE else self._block[-1])

    def _end(self, name: str) -> None:
        # a stray end tag of an inline element ends no block
        if self._open.get(name) and (name not in INLINE or self._open[name][-1] > self._block[-1]):
            self._cut(self._open[name][-1])

    def _close(self, names: tuple[str, ...]) -> None:
        """End the nearest open element of these names, unless a container stands between."""
        depth = max((self._open[x][-1] for x in names if self._open.get(x)), default=0)
        if depth and depth >= self._border[-1]:
            self._cut(depth)

    def _cut(self, depth: int) -> None:
        for number in self._stack[depth:]:
            self._open[self.name[number]].pop()
        for x in (self._stack, self._border, self._block):
            del x[depth:]

    def _up(self, at: list[float]) -> list[float]:
        """Sums over the elements below each one and itself."""
        for i in range(len(at) - 1, 0, -1):
            at[self.parent[i]] += at[i]
        return at

    def _settle(self) -> None:
        """Elements with a telling name are noise unless they hold the content; what is in noise is noise."""
        at, heading = [0.0] * len(self.name), [0.0] * len(self.name)
        for text, element, _ in self.texts:
            if not self.noise[element]:
                at[element] += len(text.strip())
        for i, name in enumerate(self.name):
            heading[i] = float(name in ("h1", "main", "article") and not self.noise[i])
        at, heading = self._up(at), self._up(heading)
        for i in range(1, len(self.name)):
            if self.marked[i]:
                holds = at[i] >= (HOLDS_HEADING if heading[i] else HOLDS) * at[0] and (heading[i] or not heading[0])
                self.noise[i] = self.noise[i] or not holds
            self.noise[i] = self.noise[i] or self.noise[self.parent[i]]


def _smooth(x: np.ndarray) -> np.ndarray:
    return np.convolve(np.pad(x, 1, mode="edge"), [0.25, 0.5, 0.25], "valid")


def content_paths(page: Page) -> set[int]:
    """Paths, without elements within a line, of the nodes whose smoothed, fused text and punctuation ratios reach the page's threshold."""
    texts = [n for n in page.texts if n[0].strip() and not page.noise[n[1]]]
    texts = [n for n in texts if not page.link[n[1]]] or texts
    if not texts:
        return set()
    index: dict[int, int] = {}
    at = np.array([index.setdefault(page.path[n[1]], len(index)) for n in texts])
    length = np.array([len(n[0].strip()) for n in texts], float)
    marks = np.array([len(_PUNCTUATION.findall(n[0])) + 0.5 for n in texts])
    count = np.bincount(at)
    ratios = [_smooth((np.bincount(at, x) / count)[at]) for x in (length, marks)]
    fused = np.sqrt((ratios[0] / ratios[0].max()) * (ratios[1] / ratios[1].max()))
    score = np.bincount(at, fused) / count
    held = score[at] >= fused.mean() - fused.std()
    return {page.whole[n[1]] for n, x in zip(texts, held, strict=True) if x}


def _roots(page: Page, paths: set[int]) -> list[bool]:
    """Whether an element is in the content root."""
    inside, weight = [False] * len(page.name), [0.0] * len(page.name)
    for text, element, _ in page.texts:
        if not page.noise[element] and page.whole[element] in paths:
            weight[element] += len(text.strip())
    if sum(w for w, x in zip(weight, page.article, strict=True) if x) >= 0.5 * sum(weight):
        return page.article
    weight = page._up(weight)
    # elements with nearly all of the text are one below the other: the last is the deepest
    root = max((i for i, w in enumerate(weight) if w >= 0.9 * weight[0] and page.name[i] not in INLINE and page.name[i] != "p"), default=0)
    inside[root] = True
    for i in range(root + 1, len(inside)):
        inside[i] = inside[page.parent[i]]
    return inside


def extract(text: str | None) -> str:
    """The main text of one page."""
    page = Page(text or "")
    paths = content_paths(page)
    if not paths:
        return ""
    inside = _roots(page, paths)
    out, blocks, before = [], [], False
    for n in page.texts:  # blocks of text in the root; what is left out ends a block
        use = inside[n[1]] and not page.noise[n[1]]
        if use and before and not n[2]:
            blocks[-1].append(n)
        elif use:
            blocks.append([n])
        before = use
    for kept, block in zip(_kept(page, blocks, paths), blocks, strict=True):
        if kept:
            out.append((" " if block[0][2] else "") + "".join(n[0] for n in block))
        else:
            out.append(" ")
    return " ".join(html.unescape("".join(out)).split())


def _link_lists(linked: list[bool], items: list[bool]) -> list[bool]:
    """Blocks in a row of linked ones: of any length among items of lists and tables, of three or more elsewhere."""
    out = list(linked)
    i = 0
    while i < len(linked):
        j = i + 1
        while linked[i] and j < len(linked) and linked[j]:
            j += 1
        if linked[i] and j - i < 3:
            out[i:j] = items[i:j]
        i = j
    return out


def _kept(page: Page, blocks: list[list], paths: set[int]) -> list[bool]:
    """Which blocks belong to a run of content, in page order."""
    blank = [not any(n[0].strip() for n in b) for b in blocks]
    sizes = [sum(len(n[0].strip()) for n in b) for b in blocks]
    linked = [bool(size) and 2 * sum(len(n[0].strip()) for n in b if page.link[n[1]]) >= size for b, size in zip(blocks, sizes, strict=True)]
    if all(x or e for x, e in zip(linked, blank, strict=True)):  # a page of links only
        linked = [False] * len(blocks)
    full = [i for i in range(len(blocks)) if not blank[i]]  # blank ones are in nobody's way
    element = [blocks[i][0][1] for i in full]
    lists = _link_lists([linked[i] for i in full], [_item(page, e) for e in element])
    content = [k for k, i in enumerate(full) if not linked[i] and any(page.whole[n[1]] in paths and n[0].strip() for n in blocks[i])]
    kept = [False] * len(blocks)
    if not content:
        return kept
    first, last = content[0], content[-1]
    k = heading = first
    while k > 0 and not lists[k - 1]:
        k -= 1
        if page.head[element[k]]:
            heading = k
    while first > heading or (first > 0 and not lists[first - 1] and page.tail[element[first - 1]]):
        first -= 1
    while last + 1 < len(full) and not lists[last + 1] and page.tail[element[last + 1]]:
        last += 1
    for k in range(first, last + 1):
        kept[full[k]] = not lists[k]
    return kept


def _item(page: Page, element: int) -> bool:
    """Whether the block's own element, or the one around its paragraph, is an item of a list or table."""
    while page.name[element] in INLINE or page.name[element] == "p":
        element = page.parent[element]
    return page.name[element] in ("li", "td", "th", "dd", "dt")


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [extract(page) for page in batch.column(2).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string())], ["page_id", "url", "text"])


def main_text(pages: DataFrame) -> DataFrame:
    """(page_id, url, text) of every row of ``pages`` (page_id, url, html)."""
    pages = pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    return pages.mapInArrow(lean(_extract), "page_id bigint, url string, text string")
