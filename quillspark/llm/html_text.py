"""Main text of web pages by tag-path ratios.

A page is read into text nodes with their root-to-leaf tag paths. Text length and punctuation are added up per path and divided by the path's nodes;
both ratios are smoothed over the nodes in page order, fused by multiplying, and thresholded. The smallest container that holds nearly all of the
fused weight of the kept nodes is the article; its nodes that are no boilerplate by tag, role or name make the text.

Edge cases: a null or empty page gives an empty text. Open, unclosed and stray tags are read as browsers do in the common cases: a new paragraph
ends the last one, an end tag closes what is open inside. Text after an unclosed script or comment is part of it. Null ids and addresses stay null,
repeated rows give repeated results; other columns of the input are ignored.
"""

from __future__ import annotations

import html
import math
import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import as_table, small_batches

# Element names of HTML and the words that mark parts beside the article.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup"
                   " time tt u var wbr".split())
BESIDE = frozenset("nav footer aside form script style noscript template button select option textarea iframe svg head title dialog menu object"
                   " embed map audio video canvas fieldset datalist".split())
CONTAINERS = frozenset("html body main article section div td center blockquote".split())
BESIDE_ROLES = frozenset("navigation banner contentinfo complementary search alert alertdialog dialog menu menubar form toolbar".split())
BESIDE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising adsense banner sponsor sponsored promo promotion cookie cookies consent gdpr notice notices alert alerts"
    " popup modal overlay newsletter subscribe subscription signup login sidebar sidebars aside menu menus nav navbar navigation breadcrumb"
    " breadcrumbs footer masthead topbar toolbar comment comments commentlist reply replies respond disqus discussion share sharing social related"
    " recommended recommendations widget widgets pagination pager skip hidden copyright disclaimer".split())
# Elements that an opening tag ends, up to the nearest element in the second set.
CLOSES = {"li": ("li", "ul ol menu"), "dt": ("dt dd", "dl"), "dd": ("dt dd", "dl"), "tr": ("tr td th", "table"), "td": ("td th", "tr table"),
          "th": ("td th", "tr table"), "option": ("option", "select"), "thead": ("tr td th tbody thead", "table"), "tbody": ("tr td th tbody thead", "table")}
ENDS_P = frozenset("address article aside blockquote center details dialog div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol"
                   " p pre section table ul".split())
TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.S)
ATTRIBUTE = re.compile(r"(class|id|role|hidden|aria-hidden|style)\b(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
PIECE = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
PUNCTUATION = ".,;:!?…。，、！？；：؟،।"
SMOOTH = 1
SHARE = 0.8
LINKED = 0.8


def beside(tag: str, attributes: str, in_article: bool) -> bool:
    """True for an element whose content is not the article's, whatever its ratios."""
    if tag in BESIDE or tag == "header" and not in_article:
        return True
    if not attributes:
        return False
    for m in ATTRIBUTE.finditer(attributes):
        name, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if name == "hidden" or name == "aria-hidden" and value == "true" or name == "style" and "display:none" in value.replace(" ", ""):
            return True
        if name == "role" and value.lower() in BESIDE_ROLES:
            return True
        if name in ("class", "id") and tag not in ("html", "body", "article", "main") and any(
                w.lower() in BESIDE_WORDS for w in PIECE.findall(value)):
            return True
    return False


class Page:
    """Text nodes of one page: the text, its block, whether it is beside the article or in a link, its path and its enclosing elements."""

    def __init__(self, source: str):
        self.nodes: list[tuple[str, int, bool, bool, str, tuple[int, ...]]] = []
        self.stack: list[tuple[str, bool, bool, str, int]] = [("", False, False, "", 0)]  # tag, beside, link, path, element
        self.tags = {0: ""}
        self.block = self.elements = 0
        at = 0
        while m := TOKEN.search(source, at):
            if m.start() > at:
                self.text(source[at:m.start()])
            at = m.end()
            if not m[2]:
                continue
            tag = m[2].lower()
            if m[1]:
                self.end(tag)
            else:
                self.start(tag, m[3])
                if tag in RAW:
                    stop = re.compile(rf"</{tag}\b[^>]*>", re.I).search(source, at)
                    if tag == "textarea":
                        self.text(source[at:stop.start() if stop else len(source)])
                    at = stop.end() if stop else len(source)
                    self.end(tag)
        if at < len(source):
            self.text(source[at:])

    def text(self, text: str) -> None:
        _, out, link, path, _ = self.stack[-1]
        self.nodes.append((html.unescape(text) if "&" in text else text, self.block, out, link, path, tuple(x[4] for x in self.stack)))

    def pop_to(self, depth: int) -> None:
        del self.stack[depth:]

    def start(self, tag: str, attributes: str) -> None:
        if tag not in INLINE:
            self.block += 1
        if tag == "br" or tag in VOID:
            return
        if tag in ENDS_P:
            for k in range(len(self.stack) - 1, 0, -1):
                if self.stack[k][0] == "p":
                    self.pop_to(k)
                    break
                if self.stack[k][0] in CONTAINERS or self.stack[k][0] in ("li", "button", "table"):
                    break
        if tag in CLOSES:
            ended, within = (x.split() for x in CLOSES[tag])
            first = None
            for k in range(len(self.stack) - 1, 0, -1):
                if self.stack[k][0] in within:
                    break
                if self.stack[k][0] in ended:
                    first = k
            if first is not None:
                self.pop_to(first)
        if attributes.rstrip().endswith("/") and tag in ("path", "circle", "rect", "use"):
            return
        above = self.stack[-1]
        self.elements += 1
        self.tags[self.elements] = tag
        in_article = any(x[0] in ("article", "main") for x in self.stack)
        self.stack.append((tag, above[1] or beside(tag, attributes, in_article), above[2] or tag == "a", f"{above[3]}/{tag}", self.elements))

    def end(self, tag: str) -> None:
        if tag not in INLINE:
            self.block += 1
        for k in range(len(self.stack) - 1, 0, -1):
            if self.stack[k][0] == tag:
                self.pop_to(k)
                return
            if tag in INLINE and self.stack[k][0] in CONTAINERS:
                return


def smoothed(values: np.ndarray) -> np.ndarray:
    """Gaussian mean over neighbours in page order."""
    reach = np.arange(-2 * SMOOTH, 2 * SMOOTH + 1)
    weights = np.exp(-(reach / SMOOTH) ** 2 / 2)
    total = np.convolve(values, weights, "full")[2 * SMOOTH:2 * SMOOTH + len(values)]
    return total / np.convolve(np.ones(len(values)), weights, "full")[2 * SMOOTH:2 * SMOOTH + len(values)]


def path_ratios(nodes: list[tuple]) -> tuple[np.ndarray, np.ndarray]:
    """For each node the text and punctuation ratios of its path."""
    size, marks, count = defaultdict(int), defaultdict(int), defaultdict(int)
    for text, _, _, _, path, _ in nodes:
        size[path] += len(text)
        marks[path] += sum(map(text.count, PUNCTUATION))
        count[path] += 1
    return (np.array([size[x[4]] / count[x[4]] for x in nodes]), np.array([marks[x[4]] / count[x[4]] for x in nodes]))


def link_lists(nodes: list[tuple]) -> set[str]:
    """Paths of at least three nodes whose text is nearly all links."""
    linked, size, count = defaultdict(int), defaultdict(int), defaultdict(int)
    for text, _, _, link, path, _ in nodes:
        if link:
            linked[path] += len(text)
        size[path] += len(text)
        count[path] += 1
    return {p for p in size if count[p] >= 3 and linked[p] >= LINKED * size[p] and "/li" in p}


def main_text(source: str | None) -> str:
    """The article's text; blocks in page order joined by one space."""
    if not source:
        return ""
    page = Page(source)
    nodes = [x for x in page.nodes if not x[2]]
    filled = [x for x in nodes if not x[0].isspace()]
    if not filled:
        return ""
    text_ratio, mark_ratio = path_ratios(filled)
    fused = smoothed(text_ratio) * (1 + smoothed(mark_ratio))
    weight = np.where(fused >= fused.mean() - fused.std(), fused, 0.0) * np.sqrt([len(x[0]) for x in filled])
    root = article_element(page.tags, filled, weight)
    lists = link_lists(filled)
    blocks: dict[int, list[str]] = {}
    for text, block, _, _, path, inside in nodes:
        if root in inside and path not in lists:
            blocks.setdefault(block, []).append(text)
    return " ".join(t for parts in blocks.values() if (t := " ".join("".join(parts).split())))


def article_element(tags: dict[int, str], nodes: list[tuple], weight: np.ndarray) -> int:
    """The deepest container with at least ``SHARE`` of the weight."""
    held: dict[int, float] = defaultdict(float)
    depth: dict[int, int] = {}
    for (_, _, _, _, _, inside), w in zip(nodes, weight):
        for d, e in enumerate(inside):
            held[e] += w
            depth[e] = d
    total = math.fsum(weight)
    fit = [e for e in held if held[e] >= SHARE * total and (e == 0 or tags[e] in CONTAINERS)]
    return max(fit, key=depth.__getitem__, default=0)


def extract(pages: DataFrame, id_column: str = "page_id", url_column: str = "url", html_column: str = "html") -> DataFrame:
    """``page_id, url, text, n_chars`` for every page; pages do not meet, so nothing is shuffled."""
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "html"):
            texts = [main_text(x) for x in batch.column("html").to_pylist()]
            yield as_table({"page_id": batch.column("page_id"), "url": batch.column("url"), "text": texts, "n_chars": [len(t) for t in texts]}, schema)

    kept = pages.select(F.col(id_column).cast("long").alias("page_id"), F.col(url_column).cast("string").alias("url"),
                        F.col(html_column).cast("string").alias("html"))
    return kept.mapInArrow(rows, "page_id long, url string, text string, n_chars long")
