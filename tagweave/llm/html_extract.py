"""Main text of web pages by tag-path ratios.

A page is read as a sequence of text nodes, each with the path of tags from the root to it. For each
path, text length and punctuation marks are divided by its number of nodes; both ratios are
smoothed along the page, multiplied, and averaged by path. Paths that reach a share of the page's
mean are content. The content's smallest common element is the article, from which all blocks are
taken but for parts that are mostly links, so that a heading or a short line belongs to it; if that
element is the whole page, parts without content are left out as well.

Nodes in elements that are never an article (navigation, footers, forms, scripts ...), or whose
class or id says so by all its words (adverts, notices, sidebars, reader comments ...), take no part
in any of this.

Pages are independent: one pass, no shuffle, and memory by page. Defined results: a null or empty
page, or one without text, has an empty text; broken markup ends where the next tag of its kind
begins or the page ends; a page without tags is one block; a page is read in time by its length,
however broken, nested or long it is; an empty table gives an empty result; repeated rows each give a row; further
columns are not read.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_right
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tagweave.llm.common import slices

SHARE, PART_BYTES = 0.5, 8_000_000
KERNEL = np.array([0.05, 0.25, 0.4, 0.25, 0.05])

# Elements of HTML by their role.
RAW = {"script", "style", "textarea", "title", "xmp", "noembed", "noframes", "iframe"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
NEVER = {
    "aside", "button", "canvas", "datalist", "dialog", "fieldset", "footer", "form", "head", "iframe", "input", "label", "menu",
    "nav", "noscript", "object", "optgroup", "option", "script", "select", "style", "svg", "template", "textarea", "title",
}
BLOCK = {
    "address", "article", "aside", "blockquote", "body", "caption", "center", "dd", "details", "dir", "div", "dl", "dt", "fieldset",
    "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "head", "header", "hgroup", "hr", "html", "legend",
    "li", "main", "menu", "nav", "ol", "p", "pre", "section", "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul",
}
LEAF = {"p", "h1", "h2", "h3", "h4", "h5", "h6", "li", "dt", "dd", "pre", "td", "th", "caption", "figcaption", "summary", "address"}
#: A start tag ends an open element of these kinds, up to one of the borders.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
CLOSES_P = BLOCK - {"caption", "dd", "dt", "legend", "body", "head", "html", "tbody", "td", "tfoot", "th", "thead", "tr", "summary", "figcaption"}
# Words of class names and ids, whole or as beginnings, that say what is no article.
SAYS_NEVER = {
    "ad", "ads", "adsense", "banner", "cookie", "cookies", "consent", "gdpr", "notice", "alert", "popup", "modal", "newsletter",
    "subscribe", "breadcrumb", "breadcrumbs", "sidebar", "side", "aside", "footer", "foot", "related", "share", "sharing", "social",
    "comment", "comments", "commentlist", "reply", "replies", "respond", "login", "signup", "search", "pagination", "pager", "tag",
    "tags", "skip", "copyright",
}
BEGINS_NEVER = ("advert", "sponsor", "promo", "nav", "menu", "widget", "recommend", "disqus")
# What says so outside of an article only, as its last word, and words that say nothing.
SAYS_HEADER = {"header", "masthead"}
ENDS_NEVER = {"ad", "ads", "breadcrumbs", "comments", "commentlist", "newsletter", "pagination", "replies", "sidebar"}
SAYS_NOTHING = {
    "area", "bar", "block", "bottom", "box", "button", "buttons", "container", "content", "form", "global", "icons", "inner", "item",
    "items", "left", "links", "list", "main", "outer", "page", "post", "posts", "right", "section", "site", "slot", "top", "unit",
    "wrap", "wrapper",
}
BEGIN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>?|<(/?)([A-Za-z][^\s/>]*)", re.DOTALL)
QUOTE_OR_END = re.compile("[\"'>]")
NAMED = re.compile(r"(?:^|\s)(class|id|role|hidden|aria-hidden)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.IGNORECASE)
MARKS = re.compile(r"[.,;:!?…。，、؛،¿¡]")


def says_never(names: str, in_article: bool) -> bool:
    """Whether one of the names of an element says that it is no article.

    A name says so by all its words, not by one: ``ad-slot`` and ``site-header`` do, ``side-effects``,
    ``notice-period`` and ``entry-header`` do not. Inside of an article a header belongs to it.
    """

    def says(word: str) -> bool:
        return word in SAYS_NEVER or word.startswith(BEGINS_NEVER) or (word in SAYS_HEADER and not in_article)

    for name in names.lower().split():
        words = [w for w in re.split("[-_]+", name) if w]
        telling = [w for w in words if not (w in SAYS_NOTHING or w.isdigit())]
        if telling and (all(map(says, telling)) or words[-1] in ENDS_NEVER):
            return True
    return False


class _Page:
    """Elements by number with parent, tag, path and whether they can hold content; text nodes in order.

    A page is read once, and each step takes time by what it opens or closes, so broken pages are read
    in linear time too. An unclosed quote in a tag is text of the tag; a tag without an end is text.
    """

    def __init__(self, source: str):
        self.parent, self.tag, self.path, self.open_to, self.linked, self.in_article = [-1], [""], [0], [True], [False], [False]
        self.paths: dict[tuple[int, str], int] = {}
        self.nodes: list[tuple[int, str, int]] = []  # element, text, block
        self.block = 0
        self.stack = [0]
        #: Places in the stack by tag, and of all blocks.
        self.at: dict[str, list[int]] = defaultdict(list)
        self.blocks: list[int] = []
        self._endless: set[int] = set()
        at = told = 0  # told: where the text begins that is not a node yet
        last_end = source.rfind(">")
        while found := BEGIN.search(source, at) if at <= last_end else re.compile("<[!?]").search(source, at):
            name, stop = "", found.end()
            if at > last_end:
                stop = len(source)
            elif found[2]:
                name = found[2].lower()
                stop = self._end_of_tag(source, found.end())
                if stop < 0:
                    at = found.start() + 1
                    continue
            if found.start() > told:
                self._text(self.stack[-1], source[told : found.start()])
            at = told = stop
            if not name:
                continue
            if found[1]:
                self._close(name)
                continue
            self._imply(name)
            if name in BLOCK:
                self.block += 1
            elif name == "br":
                self._text(self.stack[-1], "\n")
            if name in VOID:
                continue
            self._open(name, source[found.end() : stop - 1])
            if name in RAW:
                end = re.compile(f"</{name}(?=[\\s/>])", re.IGNORECASE).search(source, at)
                at = told = end.start() if end else len(source)
        if told < len(source):
            self._text(self.stack[-1], source[told:])

    def _end_of_tag(self, source: str, at: int) -> int:
        """Behind the end of the tag whose name ends at ``at``; -1 if there is none.

        Quotes from which no end is reached are remembered, as later tags come to them in the same state.
        """
        opened = []
        while found := QUOTE_OR_END.search(source, at):
            if found[0] == ">":
                return found.end()
            quote = found.start()
            if quote in self._endless:
                break
            opened.append(quote)
            closed = source.find(found[0], quote + 1)
            at = closed + 1 if closed >= 0 else quote + 1
        self._endless.update(opened)
        return -1

    def _open(self, name: str, attributes: str) -> None:
        held = {k.lower(): a or b or c for k, a, b, c in NAMED.findall(attributes)} if attributes else {}
        label = " ".join(held.get(k, "") for k in ("class", "id"))
        above = self.stack[-1]
        in_article = self.in_article[above]
        never = name in NEVER or (name == "header" and not in_article) or "hidden" in held or held.get("aria-hidden") == "true"
        never = never or held.get("role", "") in ("navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alert")
        if not never and label.strip() and name not in ("html", "body", "article", "main"):
            never = says_never(label, in_article)
        key = (self.path[above], f"{name}.{label.strip()}")
        self.parent.append(above)
        self.tag.append(name)
        self.path.append(self.paths.setdefault(key, len(self.paths) + 1))
        self.open_to.append(self.open_to[above] and not never)
        self.linked.append(self.linked[above] or name == "a")
        self.in_article.append(in_article or name in ("article", "main"))
        self.at[name].append(len(self.stack))
        if name in BLOCK:
            self.blocks.append(len(self.stack))
        self.stack.append(len(self.tag) - 1)

    def _cut(self, size: int) -> None:
        """Closes the elements of the stack from place ``size`` on."""
        while len(self.stack) > size:
            name = self.tag[self.stack.pop()]
            self.at[name].pop()
            if name in BLOCK:
                self.blocks.pop()

    def _close(self, name: str) -> None:
        if name in BLOCK:
            self.block += 1
        places = self.at.get(name)
        # The end of an inline element does not end blocks around it.
        if places and (name in BLOCK or not self.blocks or places[-1] > self.blocks[-1]):
            self._cut(places[-1])

    def _imply(self, name: str) -> None:
        if name in CLOSES_P:
            self._end({"p"}, {"article", "section", "div", "body", "td", "th", "li", "blockquote", "table", "button", "object"})
        if name in ENDS:
            self._end(*ENDS[name])

    def _end(self, kinds: set[str], borders: set[str]) -> None:
        border = max((self.at[b][-1] for b in borders if self.at.get(b)), default=0)
        lowest = [places[bisect_right(places, border)] for places in map(self.at.get, kinds) if places and places[-1] > border]
        if lowest:
            self._cut(min(lowest))

    def _text(self, element: int, text: str) -> None:
        if self.open_to[element]:
            self.nodes.append((element, html.unescape(text), self.block))

    def common(self, elements: set[int]) -> int:
        """The deepest element that holds all of these; elements are numbered from the outside in."""
        within = [0] * len(self.tag)
        for element in elements:
            within[element] = 1
        for element in range(len(self.tag) - 1, 0, -1):
            within[self.parent[element]] += within[element]
        return max(k for k, n in enumerate(within) if n == len(elements))

    def parts_below(self, root: int) -> list[int]:
        """For each element the child of ``root`` it lies in, ``root`` for itself, -1 outside of it."""
        part = [-1] * len(self.tag)
        part[root] = root
        for element in range(root + 1, len(self.tag)):
            above = self.parent[element]
            part[element] = element if above == root else part[above]
        return part


def _smooth(values: np.ndarray) -> np.ndarray:
    """Weighted mean with neighbours; weights that fall off the page are left out."""
    half = len(KERNEL) // 2
    weight = np.convolve(np.ones(len(values)), KERNEL)[half : half + len(values)]
    return np.convolve(values, KERNEL)[half : half + len(values)] / weight


def _content(page: _Page, filled: list[tuple[int, str, int]]) -> set[int]:
    """Paths whose fused ratio reaches its share of the mean."""
    length, marks, count = defaultdict(int), defaultdict(int), defaultdict(int)
    for element, text, _ in filled:
        path = page.path[element]
        length[path] += len(text.strip())
        marks[path] += len(MARKS.findall(text))
        count[path] += 1
    of_node = [page.path[element] for element, _, _ in filled]
    text_ratio = _smooth(np.array([length[p] / count[p] for p in of_node]))
    mark_ratio = _smooth(np.array([(marks[p] + 0.1) / count[p] for p in of_node]))
    fused = np.sqrt(text_ratio * mark_ratio)
    total = defaultdict(float)
    for path, value in zip(of_node, fused):
        total[path] += value
    mean = {p: total[p] / count[p] for p in total}
    weight = sum(length[p] for p in mean)
    threshold = SHARE * sum(mean[p] * length[p] for p in mean) / weight
    return {p for p, value in mean.items() if value >= threshold}


def main_text(source: str) -> str:
    page = _Page(source)
    filled = [n for n in page.nodes if n[1].strip()]
    if not filled:
        return ""
    content = _content(page, filled)
    chosen = [n for n in filled if page.path[n[0]] in content]
    root = page.common({n[0] for n in chosen})
    while root and (page.tag[root] in LEAF or page.tag[root] not in BLOCK):
        root = page.parent[root]
    part_of = page.parts_below(root)
    parts: dict[int, list[int]] = {}
    places = {}
    for element, text, _ in filled:
        places[element] = part_of[element]
        if places[element] >= 0:
            sums = parts.setdefault(places[element], [0, 0, 0])
            sums[page.path[element] in content] += len(text)
            sums[2] += len(text) if page.linked[element] else 0
    # A part of the article stays if most of its text is content, or if it is one block. So does any
    # other part that is not mostly links, unless the article is the whole page.
    whole = page.tag[root] in ("", "html", "body")
    kept = set()
    for part, (other, mine, linked) in parts.items():
        single = part == root or page.tag[part] in LEAF or page.tag[part] not in BLOCK
        if mine >= other or single or not (whole or 2 * linked > other + mine):
            kept.add(part)
    blocks: dict[int, list[str]] = defaultdict(list)
    for element, text, block in page.nodes:
        if places.get(element, places.get(page.parent[element], -1)) in kept:
            blocks[block].append(text)
    joined = (" ".join("".join(texts).split()) for texts in blocks.values())
    return "\n\n".join(text for text in joined if text)


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in slices(whole, "html", PART_BYTES):
            texts = [main_text(t or "") for t in batch.column(2).to_pylist()]
            columns = [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["page_id", "url", "text", "n_chars"])


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars for each page."""
    rows = pages.select("page_id", "url", "html")
    kinds = [rows.schema[c].dataType.simpleString() for c in ("page_id", "url")]
    return rows.mapInArrow(_extract, f"page_id {kinds[0]}, url {kinds[1]}, text string, n_chars long")
