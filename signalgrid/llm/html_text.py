"""Main text of web pages by tag-path ratios.

A page is cut into blocks (text between block-level tags). Blocks below menus, headers, footers,
sidebars, notices, adverts, forms, comments and the like (by tag, role, or a whole word of class or
id) are out, and so is what is hidden; never an html, body, main or article element. An element that
is out by a name of layout (sidebar, widget, header) or a form stays if it is around the page's only
article or most of its text (``_spared``); comments, notices, adverts and the like never do. For each
root-to-leaf tag path of the rest, text length per block and punctuation per block are aggregated; both ratios are smoothed over the page in block order and fused, and paths whose
greatest fused ratio reaches the threshold are content. The least element around the content
blocks (an article or main element around them if there is one) is the article: all its blocks
stay, short ones and lists of links too. Without article or main, headings and text that border on
that element stay as well. Paths that are mostly links are not content and end that border; if the
article is the whole body, they go where they stand before or after all content.

Null and empty pages give an empty text, and so do pages without such blocks. Markup may be broken:
end tags without a start are skipped, open elements end with their parent, an open comment or
script runs to the end of the page.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import StringType, StructField, StructType

from signalgrid.llm.arrays import pieces

#: Of the greatest fused ratio of a page, what a content path reaches.
THRESHOLD = 0.15
#: Smoothing weights of a block and its neighbours on either side.
KERNEL = (0.25, 0.5, 0.25)
#: Paths with more of their text in links are lists of links.
LINK_SHARE = 0.6

# Elements of HTML and words that name parts of a page.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript template".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form"
    " h1 h2 h3 h4 h5 h6 head header hgroup hr html li main menu nav ol option p pre search section select summary"
    " table tbody td tfoot th thead title tr ul".split()
)
OUT_TAGS = frozenset(
    "aside button dialog footer form head iframe input menu nav noscript option script search select style svg"
    " template textarea title".split()
)
OUT_ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu navigation search".split())
#: Names of what is never part of an article, however much of a page it is.
NEVER_WORDS = frozenset(
    "ad ads adsbygoogle advert advertisement adverts breadcrumb breadcrumbs comment comments consent cookie cookies"
    " copyright disclaimer login modal newsletter notice pagination popup promo promotion related share sharing signup"
    " social sponsor sponsored subscribe".split()
)
#: Names of layout, which may be around an article.
OUT_WORDS = NEVER_WORDS | frozenset("banner footer menu nav navbar navigation sidebar toolbar widget".split())
HEAD_WORDS = frozenset("header masthead topbar".split())
#: Parts that may stand beside such a word in one name (site-footer); any other part is of a state or layout.
PLAIN_WORDS = frozenset(
    "area bar block bottom box buttons container global google inner left links list main page post posts primary right"
    " secondary section site slot top unit wrap wrapper".split()
)
#: Tags whose elements may still be around the whole text; of the other out tags none is.
AROUND_TAGS = frozenset("dialog form header".split())
WHOLE = frozenset("html body main article".split())
#: Of the text outside links: over this share is most of it, and what an element in an article must have over.
MOST, MOST_OF_ARTICLE = 0.5, 0.75
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup".split())
PUNCTUATION = re.compile(r"[.,;:!?…。，、！？]")

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>",
    re.S,
)
#: What may begin behind the last ``>`` of a page and runs to its end.
_OPEN_ENDED = re.compile(r"<!--.*\Z|<!\[CDATA\[.*\Z|<[!?].*\Z|(?!)(/?)()()", re.S)
_ATTRIBUTE = re.compile(r"([^\s\"'>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_PART = re.compile(r"[-_]+")


class _Element:
    __slots__ = ("tag", "path", "parent", "out", "article", "depth", "mark", "fixed", "holder")

    def __init__(self, tag: str, path: int, parent: _Element | None, out: bool, article: bool):
        self.tag, self.path, self.parent, self.out, self.article = tag, path, parent, out, article
        self.depth = parent.depth + 1 if parent else 0
        #: The nearest mark it is under, and whether it is under an element that its tag puts out.
        self.mark: _Mark | None = parent and parent.mark
        self.fixed: bool = bool(parent and parent.fixed)
        #: The nearest block it is in, itself included.
        self.holder: _Element = self if tag in BLOCK or not parent else parent.holder


class _Mark:
    """An element that is out by a name or a form around it, and what it holds."""

    __slots__ = ("place", "in_article", "above", "size", "articles")

    def __init__(self, place: int, in_article: bool, above: _Mark | None):
        self.place, self.in_article, self.above, self.size, self.articles = place, in_article, above, 0, 0


def _names(value: str, words: frozenset[str]) -> bool:
    """Whether a whole word of ``value`` is one of ``words``, alone or beside plain parts."""
    for word in value.split():
        if word in words:
            return True
        parts = [part for part in _PART.split(word) if part and not part.isdigit()]
        if not words.isdisjoint(parts) and all(part in words or part in PLAIN_WORDS for part in parts):
            return True
    return False


def _is_out(tag: str, attributes: str, article: bool) -> int:
    """Whether an element and all below it is no part of an article: 0 if it may be one, 1 unless it
    is around the article, 2 in any case."""
    if tag in WHOLE:
        return 0
    if tag in OUT_TAGS and tag not in AROUND_TAGS:
        return 2
    words = OUT_WORDS if article else OUT_WORDS | HEAD_WORDS
    found = int(tag in OUT_TAGS or (tag == "header" and not article))
    for match in _ATTRIBUTE.finditer(attributes):
        name = match[1].lower()
        value = (match[2] or match[3] or match[4] or "").strip().lower()
        if name == "hidden" or (name == "aria-hidden" and value == "true"):
            return 2
        if name == "style" and "display:none" in value.replace(" ", ""):
            return 2
        if name in ("class", "id") and _names(value, NEVER_WORDS):
            return 2
        if (name == "role" and value in OUT_ROLES) or (name in ("class", "id") and _names(value, words)):
            found = 1
    return found


def _spared(marks: list[_Mark], total: int, standing: int) -> set[int]:
    """Places of the marked elements that are around the article of a page.

    ``total`` is the size of the text, ``standing`` of that in main or article elements that are not
    out. If there is some, a marked element around other articles has comments or teasers.
    """
    if standing:
        return {mark.place for mark in marks if mark.in_article and mark.size > MOST_OF_ARTICLE * total}
    return {mark.place for mark in marks if mark.articles == 1 or mark.size > MOST * total}


def blocks_of(page: str) -> list[tuple[str, _Element, int]]:
    """(text, element, characters in links) of the blocks that are not out, in page order."""
    found, marks, total, standing = _parse(page, frozenset())
    if marks and (spared := _spared(marks, total, standing)):
        found = _parse(page, spared)[0]
    if marks and total and not found:
        found = _parse(page, {mark.place for mark in marks})[0]
    return found


def _parse(page: str, spared: Iterable[int]) -> tuple[list[tuple[str, _Element, int]], list[_Mark], int, int]:
    """Blocks that are not out if elements at the places ``spared`` are not, the marked elements, and
    the sizes of the text outside links: all of it, and that in main or article elements not out."""
    marks: list[_Mark] = []
    place = total = standing = 0
    paths: dict[tuple[int, str], int] = {}
    element = _Element("", 0, None, False, False)
    found: list[tuple[str, _Element, int]] = []
    parts: list[str] = []
    holder = element
    open_tags: Counter[str] = Counter()
    links = linked = 0
    at = 0

    def close_block() -> None:
        nonlocal linked
        text = " ".join("".join(parts).split())
        if text and not holder.out:
            found.append((text, holder, linked))
        parts.clear()
        linked = 0

    def add(text: str) -> None:
        nonlocal linked
        if text:
            text = unescape(text)
            parts.append(text)
            if links:
                linked += len(text.strip())

    def measure(text: str) -> None:
        nonlocal total, standing
        if element.fixed or links or not (size := len(text.strip())):
            return
        total += size
        if element.article and not element.out:
            standing += size
        if element.mark:
            element.mark.size += size

    def pop_to(target: _Element) -> None:
        nonlocal element, links, holder
        while element is not target:
            if element.tag == "a":
                links = max(links - 1, 0)
            open_tags[element.tag] -= 1
            element = element.parent
        holder = element.holder

    # Behind the last of these no tag ends; there is no point in trying.
    last = page.rfind(">")
    while (match := _TOKEN.search(page, at)) if at <= last else (match := _OPEN_ENDED.search(page, at)):
        measure(page[at : match.start()])
        if not element.out:
            add(page[at : match.start()])
        at = match.end()
        if not match[2]:
            if match[0].startswith("<![CDATA[") and not element.out:
                add(match[0][9:].removesuffix("]]>"))
            continue
        tag = match[2].lower()
        if match[1]:
            target = element
            while open_tags[tag] and target.tag != tag:
                target = target.parent
            if open_tags[tag]:
                if tag in BLOCK:
                    close_block()
                pop_to(target.parent)
            continue
        if tag in RAW:
            # Nothing in these is markup or text of an article.
            end = re.compile(rf"</{tag}\s*>", re.I).search(page, at)
            at = end.end() if end else len(page)
            if tag in BLOCK:
                close_block()
            continue
        if tag == "br":
            parts.append(" ")
            continue
        if tag in BLOCK:
            close_block()
            closes = {"li": ("li",), "dd": ("dd", "dt"), "dt": ("dd", "dt"), "tr": ("tr",), "td": ("td", "th"), "th": ("td", "th")}.get(tag, ())
            open_ = element
            while open_.parent and open_.tag != "p" and open_.tag not in closes:
                if open_.tag in BLOCK:
                    break
                open_ = open_.parent
            if open_.tag == "p" or open_.tag in closes:
                pop_to(open_.parent)
        if tag in VOID or match[3].endswith("/") and tag not in BLOCK:
            continue
        place += 1
        article = element.article or tag in ("article", "main")
        own = _is_out(tag, match[3], element.article)
        if article and not element.article and element.mark and not element.fixed:
            element.mark.articles += 1
        out = element.out or own == 2 or (own == 1 and place not in spared)
        path = paths.setdefault((element.path, tag), len(paths) + 1)
        element = _Element(tag, path, element, out, article)
        open_tags[tag] += 1
        if own == 2:
            element.fixed = True
        elif own and not element.fixed:
            element.mark = _Mark(place, article, element.mark)
            marks.append(element.mark)
        if tag == "a":
            links += 1
        if tag in BLOCK:
            holder = element
    measure(page[at:])
    if not element.out:
        add(page[at:])
    close_block()
    for mark in reversed(marks):
        if mark.above:
            mark.above.size += mark.size
            mark.above.articles += mark.articles
    return found, marks, total, standing


def _fused(found: list[tuple[str, _Element, int]]) -> np.ndarray:
    """Smoothed text and punctuation ratios of each block's path, as one number."""
    _, path = np.unique([element.path for _, element, _ in found], return_inverse=True)
    count = np.bincount(path)
    length = np.bincount(path, [len(text) for text, _, _ in found]) / count
    marks = np.bincount(path, [len(PUNCTUATION.findall(text)) for text, _, _ in found]) / count
    smooth = [np.convolve(np.pad(ratio[path], 1, "edge"), KERNEL, "valid") for ratio in (length, marks)]
    return smooth[0] * (1 + smooth[1])


def _in_heading(element: _Element) -> bool:
    while element.parent and element.tag not in HEADINGS:
        element = element.parent
    return element.tag in HEADINGS


def main_text(page: str | None) -> str:
    """The article of a page: its blocks, one per line."""
    found = blocks_of(page or "")
    if not found:
        return ""
    totals: dict[int, list[int]] = {}
    for text, element, linked in found:
        total = totals.setdefault(element.path, [0, 0])
        total[0] += len(text)
        total[1] += linked
    listed = {path for path, (size, linked) in totals.items() if linked > LINK_SHARE * size}
    texts = [block for block in found if block[1].path not in listed]
    if not texts:
        texts, listed = found, set()
    fused = _fused(texts)
    best: dict[int, float] = {}
    for (_, element, _), value in zip(texts, fused.tolist()):
        best[element.path] = max(best.get(element.path, 0.0), value)
    least = THRESHOLD * max(best.values())
    content = [element for _, element, _ in texts if best[element.path] >= least]
    # The least element that holds them all, or the article around it.
    around = content[0]
    if not around.parent or all(element is around for element in content):
        around = around.parent or around
    for element in content[1:]:
        while element.depth > around.depth:
            element = element.parent
        while around.depth > element.depth:
            around = around.parent
        while element is not around:
            element, around = element.parent, around.parent
    article = around
    while article.article and article.tag not in ("article", "main"):
        article = article.parent
    if article.article:
        around = article

    def inside(element: _Element, around: _Element) -> bool:
        while element.depth > around.depth:
            element = element.parent
        return element is around

    places = [i for i, (_, element, _) in enumerate(found) if inside(element, around)]
    first, last = places[0], places[-1]
    if around.tag in ("", "html", "body"):
        # The page itself: what is listed before or after its content is no part of the article.
        own = [i for i in places if (path := found[i][1].path) not in listed and best[path] >= least]
        places = [i for i in places if own[0] <= i <= own[-1] or found[i][1].path not in listed]
    elif not article.article:
        beside = around.parent

        def borders(i: int) -> bool:
            element = found[i][1]
            return element.path not in listed and (_in_heading(element) or inside(element, beside))

        while first and borders(first - 1):
            first -= 1
        while last + 1 < len(found) and borders(last + 1):
            last += 1
        places = [*range(first, places[0]), *places, *range(places[-1] + 1, last + 1)]
    return "\n".join(found[i][0] for i in places)


def extract(pages: DataFrame, html: str = "html", text: str = "text") -> DataFrame:
    """``pages`` without ``html``, with the main text of each row added (or replaced)."""
    shape = [field for field in pages.schema.fields if field.name not in (html, text)]
    names = [field.name for field in shape]
    pages = pages.select(*names, html)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, html, 4 << 20):
                texts = pa.array([main_text(page) for page in piece.column(html).to_pylist()], pa.string())
                yield pa.record_batch([*(piece.column(name) for name in names), texts], [*names, text])

    return pages.mapInArrow(run, StructType([*shape, StructField(text, StringType())]))
