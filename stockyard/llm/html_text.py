"""Main text of HTML pages: the contiguous region with the highest score.

A page is a row of words and tags. Each word scores one, each tag a negative weight; one linear scan finds the region whose sum is
highest (the maximum-scoring subsequence). Tag weights are learned from labelled pages, those whose content is marked by
exactly one ``article`` element: a tag costs the more the larger the share of its occurrences outside marked content. Every tag of HTML has a weight
of its own; names that are not HTML's (custom elements, misspellings, noise) share one, so that the weights are learned from all tags and yet are few.
Elements that are never content (menus, headers, footers, sidebars, notices, adverts, forms, comments, scripts, styles) are taken out and cost as one tag each.
One that is known only by its class, id or role stays if it holds a ``main`` or the page's first ``article`` or, on a page with neither, most of the words.

Defined results: a NULL or empty page has an empty text; of regions with equal scores the one that ends first, then the shortest, wins; an unclosed element ends with the page only
if it is a footer, else it is read as if it had no tag; nothing is cut from long pages; extra columns are not touched.
"""

import html
import re
from bisect import bisect_right
from collections.abc import Iterator
from itertools import accumulate

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockyard.llm.rows import whole

#: Cost of a tag that only occurs outside content, and of one that only occurs inside.
OUTSIDE, INSIDE = 3.0, 0.01
#: Cost of a removed element, which may also stand within content.
REMOVED = 0.5

_PART = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>"
    r"""|<(svg|math)\b(?:[^"'<>=/]++|/(?!>)|=\s*(?:"[^"]*"|'[^']*'|[^\s"'>]++))*+/>"""
    r"|<(script|style|noscript|template|textarea|title|svg|iframe|select|button|object|math)\b[^>]*>.*?(?:</\2\s*>|\Z)"
    r"""|<(/?)([a-z][a-z0-9:-]*)((?:[^"'<>]++|"[^"<]*"|'[^'<]*'|["'])*+)>"""
    r"|[^<]+|<", re.I | re.S)
_ATTRIBUTE = re.compile(r"""\b(class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)
_HIDDEN = re.compile(r"""(^|\s)hidden(\s|=|$)|display\s*:\s*none|aria-hidden\s*=\s*["']?true""", re.I)
_SPACES = re.compile(r"\s+")

NEVER = frozenset("nav header footer aside form menu dialog".split())
NEVER_NAMED = frozenset("""ad ads advert adverts advertisement advertising sponsor sponsored promo promotion sidebar nav navbar navigation menu breadcrumb breadcrumbs
    footer cookie cookies consent notice notices banner comment comments disqus replies share sharing social related newsletter subscribe popup modal
    complementary contentinfo search dialog alert toolbar pagination""".split())
_WHOLE = frozenset("html body main article".split())
BLOCKS = frozenset("""address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html
    legend li main menu nav ol p pre section summary table caption tbody td tfoot th thead tr ul""".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Tags that may stand in content; if no labelled page shows one, it costs little. Others unseen cost ``OUTSIDE``.
_PLAIN = frozenset("a abbr b bdi bdo blockquote br caption cite code dd del dfn div dl dt em figcaption figure h1 h2 h3 h4 h5 h6 hr i img ins kbd li main mark ol p pre q s samp section small span strong sub sup table tbody td tfoot th thead time tr u ul var wbr".split())
#: Names with a weight of their own: HTML's. All others have that of ``OTHER``.
_NAMED = BLOCKS | _VOID | _PLAIN | frozenset("""audio big button canvas center cite data datalist del font frame frameset iframe label legend map marquee math meter nobr noframes
    noscript object optgroup option output picture progress ruby rp rt script select slot strike style svg template textarea title tt var video wbr""".split())
OTHER = "other"

WORD, TAG, NOT = 0, 1, 2


def parts(page: str) -> list[tuple[int, str, bool]]:
    """Text, tags (name, whether closing) and elements that are never content, each as one part."""
    raw, opened, match = [], {}, {}
    for m in _PART.finditer(page):
        name = m.group(4)
        if name:
            name = name.lower()
            k = len(raw)
            closing = bool(m.group(3))
            named = ""
            if closing:
                if opened.get(name):
                    match[opened[name].pop()] = k
            elif name not in _VOID and not m.group(5).rstrip().endswith("/"):
                opened.setdefault(name, []).append(k)
                named = m.group(5)
            raw.append((TAG, name, closing, named))
        elif m.group(1) or m.group(2):
            raw.append((NOT, (m.group(1) or m.group(2)).lower(), False, ""))
        elif m.group()[:2] in ("<!", "<?") and len(m.group()) > 2:
            continue
        else:
            raw.append((WORD, m.group(), False, ""))
    out, k, content = [], 0, None
    while k < len(raw):
        kind, name, closing, named = raw[k]
        if kind == TAG and not closing and name not in _WHOLE and name not in _VOID and _never(name, named):
            end = match.get(k, len(raw) if name == "footer" else None)
            by_name = end is not None and name not in NEVER and not _HIDDEN.search(named)
            if by_name and content is None:
                content = _content(raw)
            if end is not None and not (by_name and _holds(content, k, end)):
                out.append((NOT, name, False))
                k = end + 1
                continue
        out.append((kind, name, closing))
        k += 1
    return out


def _never(name: str, attributes: str) -> bool:
    if name in NEVER:
        return True
    if not attributes:
        return False
    for _, value in _ATTRIBUTE.findall(attributes):
        if NEVER_NAMED.intersection(re.split(r"[\s_-]+", value.strip("\"'").lower())):
            return True
    return bool(_HIDDEN.search(attributes))


def _content(raw: list[tuple]) -> tuple[list[int], list[int]]:
    """Of a page: places of each main and of its first article, and the words before each place if it has neither."""
    places = [k for k, part in enumerate(raw) if part[0] == TAG and not part[2] and part[1] == "main"]
    places += [k for k, part in enumerate(raw) if part[0] == TAG and not part[2] and part[1] == "article"][:1]
    return sorted(places), [] if places else [0, *accumulate(len(part[1].split()) if part[0] == WORD else 0 for part in raw)]


def _holds(content: tuple[list[int], list[int]], start: int, end: int) -> bool:
    """Whether an element has one of these places in it or, on a page without, most of the words."""
    places, before = content
    if places:
        k = bisect_right(places, start)
        return k < len(places) and places[k] < end
    return 2 * (before[end] - before[start]) > before[-1]


def _class(tag: str) -> str:
    return tag if tag in _NAMED else OTHER


def main_text(page: str, weights: dict[str, float]) -> str:
    """Text of the best region: blocks in order, two line ends between them, white space within a block as one blank."""
    row = parts(page)
    best, best_at, total, start = 0.0, (0, 0), 0.0, 0
    for k, (kind, value, _) in enumerate(row):
        if kind == WORD:
            total += len(value.split())
        elif kind == NOT:
            total -= REMOVED
        else:
            total -= weights.get(_class(value), INSIDE if value in _PLAIN else OUTSIDE)
        if total <= 0:
            total, start = 0.0, k + 1
        elif total > best:
            best, best_at = total, (start, k + 1)
    blocks, inner = [], []
    for kind, value, _ in row[slice(*best_at)]:
        if kind == WORD:
            inner.append(html.unescape(value))
        elif kind == NOT or value in BLOCKS:
            if kind == TAG or value in BLOCKS:
                blocks.append("".join(inner))
                inner = []
        elif value == "br":
            inner.append(" ")
    blocks.append("".join(inner))
    tidy = (_SPACES.sub(" ", b).strip() for b in blocks)
    return "\n\n".join(b for b in tidy if b)


def tag_counts(pages: DataFrame, page: str = "html") -> DataFrame:
    """``tag, inside, outside`` over all labelled pages and all their tags; ``tag`` is a name of HTML or ``OTHER``."""
    layout = pa.schema([("tag", pa.string()), ("inside", pa.int64()), ("outside", pa.int64())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, list[int]] = {}
        for batch in batches:
            for text in batch.column(0):
                row = parts(text.as_py())
                edges = [(k, c) for k, (kind, v, c) in enumerate(row) if kind == TAG and v == "article"]
                if len(edges) != 2 or edges[0][1] or not edges[1][1]:
                    continue
                for k, (kind, value, _) in enumerate(row):
                    if kind == TAG:
                        seen.setdefault(_class(value), [0, 0])[not edges[0][0] < k < edges[1][0]] += 1
        if seen:
            yield pa.RecordBatch.from_pylist([{"tag": t, "inside": a, "outside": b} for t, (a, b) in seen.items()], layout)

    marked = pages.where(F.contains(F.lower(F.col(f"`{page}`")), F.lit("<article"))).select(F.col(f"`{page}`").cast("string").alias("page"))
    return marked.mapInArrow(work, "tag string, inside long, outside long").groupBy("tag").agg(F.sum("inside").alias("inside"), F.sum("outside").alias("outside"))


def tag_weights(pages: DataFrame, page: str = "html") -> dict[str, float]:
    """Cost of each tag seen: one of the fixed names of HTML, or ``OTHER`` for all the rest together."""
    return {r.tag: INSIDE + (OUTSIDE - INSIDE) * r.outside / (r.inside + r.outside) for r in tag_counts(pages, page).collect()}


def main_texts(page: Column, weights: dict[str, float]) -> Column:
    @F.pandas_udf("string")
    def extract(pages: pd.Series) -> pd.Series:
        return pd.Series([main_text(p or "", weights) for p in pages], dtype="object")

    return extract(whole(page))
