"""Main text of web pages by the maximum-scoring subsequence.

A page is read as a sequence of blocks of words and of tags. Words score by where
they stand, tags score below zero; the weights are log odds counted on labelled
pages, which are those whose own markup declares the article. One linear scan finds
the contiguous region of the greatest sum; its blocks, without those that stand
in menus, forms, adverts and the like, are the text.
"""

from __future__ import annotations

import html as references
import math
import re
from collections import Counter
from collections.abc import Mapping, Sequence
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martkit.llm.common import unused

_TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?>(?:=\s*"[^"]*"|=\s*'[^']*'|[^>])*))>""", re.S
)
_OPEN = re.compile("</?[a-zA-Z]|<[!?]")
_ATTRIBUTE = re.compile(r"""([a-zA-Z][\w:-]*)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
_NAME_PARTS = re.compile("[A-Z]?[a-z]+|[A-Z]+(?![a-z])")

# Fixed values of HTML: elements without end tag, without page text, and inside a line of text.
_VOID = set("area base br col embed hr img input link meta param source track wbr".split())
_RAW = set("script style title textarea iframe xmp noembed noframes".split())
_INLINE = set(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong "
    "sub sup time tt u var wbr img br input".split()
)
_CLOSED_BY = {"li": "ul ol menu", "dt": "dl", "dd": "dl", "tr": "table", "td": "table", "th": "table", "option": "select"}
_SIBLINGS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}

#: What stands apart from the text: by element, by role, by a part of a class or id.
_BY_TAG = {
    "nav": "menu", "menu": "menu", "header": "header", "footer": "footer", "aside": "side", "form": "form", "button": "form",
    "select": "form", "fieldset": "form", "datalist": "form", "dialog": "notice", "noscript": "hidden", "template": "hidden",
    "svg": "hidden", "math": "hidden", "object": "hidden", "canvas": "hidden", "audio": "hidden", "video": "hidden",
}
_BY_ROLE = {
    "navigation": "menu", "menu": "menu", "menubar": "menu", "banner": "header", "contentinfo": "footer", "complementary": "side",
    "search": "form", "form": "form", "dialog": "notice", "alertdialog": "notice", "alert": "notice",
}
_BY_NAME = {
    part: kind
    for kind, parts in {
        "comment": "comment comments disqus respond replies commentlist",
        "menu": "nav navbar navigation menu breadcrumb breadcrumbs pagination pager share sharing social",
        "header": "header masthead topbar",
        "footer": "footer colophon copyright",
        "side": "sidebar aside rail widget related recommended recommendations trending teaser",
        "notice": "cookie cookies consent gdpr notice alert popup modal overlay newsletter subscribe paywall disclaimer toast",
        "advert": "ad ads adv advert adverts advertisement advertisements advertising sponsor sponsored promo promotion banner adslot adbox",
        "form": "form search login signup",
    }.items()
    for part in parts.split()
}
_SAYS_NOT = {"has", "with", "no", "without", "is", "not"}
_DECLARED = {"article", "main"}
_RESET = {"menu", "header", "footer", "notice", "advert", "form"}

TEXT = "text"
_DEPTH = 512  # elements nested deeper take the place of the last one; no text is lost
_PRIOR = 10.0
_LIMIT = 3.0
_TAG_COST = 0.01
_TAG_LIMIT = 0.25  # so that a list or an advert inside the text does not cost the lines after it


class Block(NamedTuple):
    """One block: its text, its place, and the tags before it and within its line as (name, place, kind)."""

    text: str
    words: int
    linked: bool
    tag: str
    kind: str
    place: str
    tags: list[tuple[str, str, str]]
    inner: list[tuple[str, str, str]]


def _kind_of(name: str, attributes: str, inside: str, declared: bool) -> str:
    """Kind of an element's words: that of its parent, unless its own markup says more."""
    own = _BY_TAG.get(name)
    if attributes and name not in ("html", "body"):
        for key, value in _ATTRIBUTE.findall(attributes):
            key, value = key.lower(), value.strip("\"'")
            if key == "hidden" or (key == "style" and "display:none" in value.replace(" ", "").lower()):
                return "hidden"
            if key == "role":
                own = own or _BY_ROLE.get(value.lower())
            elif key in ("class", "id"):
                for one in value.split():
                    parts = [p.lower() for p in _NAME_PARTS.findall(one)]
                    if not _SAYS_NOT.intersection(parts):
                        # The article itself may be called after what it has; comments are often articles too.
                        kinds = [k for p in parts if (k := _BY_NAME.get(p)) and (name not in _DECLARED or k in ("comment", "side"))]
                        own = own or next(iter(kinds), None)
    if own == "header" and declared:
        own = None  # the headline of the article
    if name in _DECLARED and own is None and inside in _RESET:
        return TEXT  # a part before it was not closed
    return inside if inside != TEXT else own or TEXT


def blocks(page: str) -> list[Block]:
    """Blocks of a page in order. Markup may be broken: unknown end tags and open elements do no harm."""
    out: list[Block] = []
    stack: list[tuple[str, str, str]] = []  # name, kind, place: article, main or nothing
    pieces: list[str] = []
    tags: list[tuple[str, str, str]] = []
    inner: list[tuple[str, str, str]] = []
    linked = 0
    block_tag = ""

    def end_block():
        nonlocal linked, tags, inner
        text = "".join(pieces)
        pieces.clear()
        text = " ".join((references.unescape(text) if "&" in text else text).split())
        if text:
            n = text.count(" ") + 1
            _, kind, place = stack[-1] if stack else ("", TEXT, "")
            if text.startswith("©") and not place:
                kind = "footer" if kind == TEXT else kind
            out.append(Block(text, n, linked * 2 > len(text), block_tag, kind, place, tags, inner))
            tags = []
        linked, inner = 0, []

    def opened(name):
        return next((k for k in range(len(stack) - 1, -1, -1) if stack[k][0] == name), None)

    at = 0
    while True:
        start = _OPEN.search(page, at)
        m = _TOKEN.match(page, start.start()) if start else None  # none: the page ends inside a tag
        chunk = page[at : start.start() if start else len(page)]
        if chunk:
            pieces.append(chunk)
            if any(s[0] == "a" for s in stack):
                linked += len(chunk)
        if m is None:
            break
        at = m.end()
        name = (m[2] or "").lower()
        if not name:
            continue
        _, kind, place = stack[-1] if stack else ("", TEXT, "")
        if name in _RAW:
            if not m[1] and not m[3].endswith("/"):
                close = re.compile(f"</{name}[\\s/>]", re.I).search(page, at)
                at = close.start() if close else len(page)
            continue
        mine = _kind_of(name, m[3], kind, bool(place)) if not m[1] and name not in _VOID else kind
        block = name not in _INLINE or mine != kind
        if m[1] and not block and (k := opened(name)) is not None and stack[k][1] != (stack[k - 1][1] if k else TEXT):
            block = True  # end of an inline element that stands apart
        if block:
            end_block()
            block_tag = "" if m[1] else name
        elif name == "br":
            pieces.append(" ")
        (tags if block else inner).append((name, place, kind if m[1] else mine))
        if m[1]:
            k = opened(name)
            if k is not None and not any(s[0] in _DECLARED for s in stack[k + 1 :]) and not (
                name in _INLINE and any(s[0] not in _INLINE for s in stack[k + 1 :])
            ):
                del stack[k:]
        elif name not in _VOID and not m[3].endswith("/"):
            if block:  # a block ends an open paragraph, an item the one before it
                bounds = set(_CLOSED_BY.get(name, "").split())
                closes = _SIBLINGS.get(name, set()) | {"p"}
                k = len(stack)
                while k and stack[k - 1][0] not in bounds and (stack[k - 1][0] in closes or stack[k - 1][0] in _INLINE):
                    k -= 1
                if any(s[0] in closes for s in stack[k:]):
                    del stack[k:]
            _, kind, place = stack[-1] if stack else ("", TEXT, "")
            mine = _kind_of(name, m[3], kind, bool(place))
            if name in _DECLARED and mine == TEXT:
                place = "article" if name == "article" else place or "main"
            if len(stack) < _DEPTH and (block or name == "a"):
                stack.append((name, mine, place))
    end_block()
    return _placed(out)


def _placed(read: list[Block]) -> list[Block]:
    """``place`` becomes inside or outside of the declared article, or unknown on a page that declares none."""
    places = {b.place for b in read if b.kind == TEXT}
    inside = "article" if "article" in places else "main" if "main" in places else None

    def where(place: str, tag: str = "") -> str:
        if inside is None:
            return "unknown"
        return "inside" if place == "article" or place == inside or (place and tag == "h1") else "outside"

    told = lambda tags: [(t, where(p), k) for t, p, k in tags]
    return [b._replace(place=where(b.place, b.tag), tags=told(b.tags), inner=told(b.inner)) for b in read]


def _word_key(b: Block, place: str) -> str:
    shape = "heading" if b.tag in ("h1", "h2", "h3", "h4", "h5", "h6") else "loose" if b.tag in ("", "div", "span", "body", "section") else "block"
    return f"word|{place}|{b.kind == TEXT}|{b.linked}|{shape}"


def _tag_key(name: str, place: str, kind: str) -> str:
    return f"tag|{place}|{kind == TEXT}|{name}"


def count_labels(page: str) -> Counter:
    """(key, label) counts of a labelled page: words and tags in the declared article or not; empty for others."""
    out: Counter[tuple[str, bool]] = Counter()
    for b in blocks(page):
        if b.place == "unknown":
            return Counter()
        label = b.place == "inside" and b.kind == TEXT
        for place in (b.place, "unknown"):  # as they are, and as they look on a page that declares nothing
            out[_word_key(b, place), label] += b.words
            for name, where, kind in b.tags + b.inner:
                out[_tag_key(name, where if place != "unknown" else place, kind), where == "inside" and kind == TEXT] += 1
    return out


def _prior(key: str) -> tuple[float, float]:
    """Counts of content and other that a key has before any page is read."""
    what, place, text, *rest = key.split("|")
    if place != "unknown":
        return (_PRIOR, 1.0) if place == "inside" and text == "True" else (1.0, _PRIOR)
    if text == "False":
        return 1.0, _PRIOR
    if what == "tag":
        return (1.0, _PRIOR) if rest[0] in ("ul", "li", "a", "table", "tr", "td") else (_PRIOR, 1.0)
    linked, shape = rest
    return (1.0, _PRIOR) if linked == "True" else (_PRIOR, 2.0 if shape != "loose" else 4.0)


def learn_weights(pages: DataFrame) -> dict[str, float]:
    """Weights from all labelled pages of ``pages`` (html); what no page tells has its prior.

    Counted in the tasks; a count per kind of word and name of element comes
    back. Names outside HTML's letters, or longer than 12, count as one.
    """

    def count(batches):
        held: Counter = Counter()
        for batch in batches:
            for page in batch.column(0).to_pylist():
                held.update(count_labels(page) if page else {})
        keys = list(held)
        columns = [pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.bool_()), pa.array([held[k] for k in keys], pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, names=["key", "label", "n"])

    told = pages.select(F.col("html").cast("string")).mapInArrow(count, "key string, label boolean, n bigint")
    known = F.when(F.col("key").rlike(r"^word\||\|[a-z][a-z0-9]{0,11}$"), F.col("key")).otherwise("tag|unknown|True|other")
    sums = told.groupBy(known.alias("key")).agg(
        F.sum(F.when(F.col("label"), F.col("n")).otherwise(0)).alias("yes"), F.sum(F.when(F.col("label"), 0).otherwise(F.col("n"))).alias("no")
    )
    # Names are made up by pages: the 2,000 most frequent decide, any other has its prior.
    rows = sums.orderBy(F.desc(F.col("yes") + F.col("no")), "key").limit(2000).collect()
    return {r.key: _weight(r.key, r.yes, r.no) for r in rows}


def _weight(key: str, yes: int = 0, no: int = 0) -> float:
    """Log odds of content; tags never score above zero, nor do words that stand apart."""
    a, b = _prior(key)
    odds = max(-_LIMIT, min(_LIMIT, math.log((yes + a) / (no + b))))
    if key.startswith("tag"):
        declared = key.split("|")[1] == "inside"  # what stands apart there does not end the article
        return -_TAG_COST if declared else max(-_TAG_LIMIT, min(-_TAG_COST, odds))
    return odds if key.split("|")[2] == "True" else min(0.0, odds / _LIMIT * _TAG_COST)


def best_region(scores: Sequence[tuple[float, float]]) -> tuple[int, int]:
    """First and past-last block of the greatest sum, from (tags before, words) scores; (0, 0) if none is above zero.

    The tags before the first block of a region are not part of it.
    """
    best, span, run, start = 0.0, (0, 0), 0.0, 0
    for i, (tags, words) in enumerate(scores):
        run += tags
        if run <= 0:
            run, start = 0.0, i
        run += words
        if run > best:
            best, span = run, (start, i + 1)
    return span


def main_text(page: str | None, weights: Mapping[str, float]) -> str:
    """Text of the best contiguous region; empty if no block scores above zero."""
    if not page:
        return ""
    read = blocks(page)
    memo = dict(weights)

    def weight(key):
        if key not in memo:
            memo[key] = _weight(key)
        return memo[key]

    cost = lambda tags: sum(weight(_tag_key(*t)) for t in tags)
    low, high = best_region([(cost(b.tags), b.words * weight(_word_key(b, b.place)) + cost(b.inner)) for b in read])
    return "\n".join(b.text for b in read[low:high] if b.kind == TEXT and b.place != "outside")


def extract_pages(pages: DataFrame, weights: Mapping[str, float] | None = None) -> DataFrame:
    """Rows of ``pages`` (html) with ``text`` and ``n_chars`` added; columns of that name are replaced.

    ``weights`` are learned from the pages themselves if none are given. Null and
    empty pages, and pages without a block of text, have an empty text. The whole
    html counts, however long; repeated rows give equal texts; an empty table
    gives no rows. Every other column passes through.
    """
    weights = learn_weights(pages) if weights is None else dict(weights)
    pages = pages.drop("text", "n_chars")
    (body,) = unused(pages, "page_body")

    @F.pandas_udf("string")
    def read(html):
        return html.map(lambda page: main_text(page, weights))

    out = pages.withColumn(body, F.coalesce(read(F.col("html").cast("string")), F.lit("")))
    return out.withColumns({"text": F.col(body), "n_chars": F.length(body).cast("bigint")}).drop(body)


_BLOCK_TAGS = "p|div|section|article|main|ul|ol|li|dl|dt|dd|table|thead|tbody|tr|td|th|h[1-6]|blockquote|pre|figure|figcaption|hr"
# For pages that declare their article, with nothing in it that stands apart.
SQL = rf"""
WITH inner_ AS (
  SELECT page_id, url, regexp_extract(coalesce(html, ''), '(?s)<article[^>]*>(.*?)(</article>|$)', 1) AS body FROM pages),
cut AS (
  SELECT page_id, url, regexp_split_to_array(body, '</?({_BLOCK_TAGS})(\s[^>]*)?>') AS parts FROM inner_),
plain AS (
  SELECT page_id, url, list_transform(parts, lambda x: replace(replace(replace(replace(replace(
    regexp_replace(regexp_replace(x, '<br\s*/?>', ' ', 'g'), '<[^>]*>', '', 'g'),
    '&quot;', '"'), '&lt;', '<'), '&gt;', '>'), '&#39;', ''''), '&amp;', '&')) AS parts FROM cut),
trimmed AS (
  SELECT page_id, url, array_to_string(list_filter(list_transform(parts, lambda x:
    trim(regexp_replace(regexp_replace(x, '&amp', '&', 'g'), '\s+', ' ', 'g'))), lambda x: x <> ''), chr(10)) AS text FROM plain)
SELECT page_id, url, text, CAST(length(text) AS BIGINT) AS n_chars FROM trimmed
"""
