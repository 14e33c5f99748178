"""Main text of web pages by line-block distribution.

Markup is stripped first: scripts, styles, comments and the other parts that are never
article text go with their content, as do elements that say by tag, role, class or id
that they are menus, headers, footers, sidebars, notices, adverts, forms or reader
comments (unless they hold the article itself). Every block element left is one line;
its character references are decoded and its white space becomes single blanks.

The text lengths of the lines are summed over a sliding window. Where the sum surges
over ``SURGE`` the main text begins, where it dives below for good it ends. Lines that are
mostly link text weigh nothing, and only they make a dive between two surges: one of at
least ``GAP`` lines, more than half of them links, or more than ``GAP`` links in a row.
Short lines of other text (lists, tables, verse) do not end the main text. Of several
such stretches the one with most text is kept, with the short lines on both sides of it
up to the next dive or the page's end. If the page marks its article (article, main,
role=main), lines outside it weigh nothing and any text in it is a surge, link text too:
every stretch of it is kept. Class names made up of several words (section-header) are
not read inside a marked article.

Defined cases: null and empty html give an empty text; pages without any line over the
surge keep all their lines that weigh something; unclosed and truncated markup is read
as far as it goes; repeated rows are extracted each; an empty table gives an empty
result; columns other than key, url and html are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chunked, col

WINDOW = 3
SURGE = 90
GAP = 4
LINK_SHARE = 0.6

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*+(?:>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*+)(?P<attrs>(?:[^>\"']|\"[^\"]*+\"|'[^']*+')*+)(?:>|\Z)"
    r"|<(?P<end2>/?)(?P<tag2>[a-zA-Z][^\s/>]*+)(?P<attrs2>[^>]*+)(?:>|\Z)"
    r"|[^<]+|<", re.S)
_ATTR = re.compile(r"(?<![^\s\"'])(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)

# Fixed values of HTML: elements by how they are read.
RAW = {"script", "style", "textarea", "title", "noscript", "xmp", "iframe", "noembed", "noframes"}
DROPPED = {"head", "nav", "header", "footer", "aside", "form", "template", "select", "button", "dialog", "menu"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
BLOCK = {"address", "article", "aside", "blockquote", "body", "caption", "center", "dd", "details", "dialog", "dir",
         "div", "dl", "dt", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6",
         "head", "header", "hgroup", "hr", "html", "legend", "li", "main", "menu", "nav", "ol", "option", "p", "pre",
         "section", "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul"}
SELF_CLOSING = {"p", "li", "dt", "dd", "td", "th", "tr", "option"}
ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "alertdialog", "alert",
         "menu", "menubar", "toolbar"}
# Words of class and id names that mark what is not the article.
HINTS = {"ad", "ads", "advert", "adverts", "advertisement", "advertising", "sponsor", "sponsored", "promo", "promotion",
         "banner", "nav", "navbar", "navigation", "menu", "menubar", "breadcrumb", "breadcrumbs", "masthead", "footer",
         "header", "topbar", "sidebar", "rail", "aside", "widget", "widgets", "related", "recommended",
         "recommendations", "share", "sharing", "social", "cookie", "cookies", "consent", "gdpr", "notice", "notices",
         "notification", "popup", "modal", "overlay", "newsletter", "subscribe", "subscription", "signup", "login",
         "paywall", "comment", "comments", "commentlist", "disqus", "reply", "replies", "respond", "form",
         "searchform", "pagination", "pager", "toolbar", "copyright", "skiplink"}
# Inside a marked article only these, as a whole class or id name, mark what is not text of it.
INSIDE_HINTS = {"ad", "ads", "advert", "adverts", "advertisement", "advertising", "sponsored", "nav", "navbar",
                "navigation", "menu", "breadcrumb", "breadcrumbs", "footer", "sidebar", "cookie", "cookies", "notice",
                "notices", "newsletter", "comment", "comments", "commentlist", "disqus", "pagination"}
NEGATIONS = {"has", "no", "with", "without", "is", "not"}


def _marked(tag: str, attrs: str, inside: bool) -> str:
    """'main' for the article's own element, 'off' for what is not article; ``inside`` an
    article class names made up of several words say nothing."""
    role, names = "", []
    for m in _ATTR.finditer(attrs):
        value = (m[2] or m[3] or m[4] or "").lower()
        if m[1].lower() == "role":
            role = value.strip()
        else:
            names += value.split()
    if tag in ("html", "body"):
        return ""
    off = tag in DROPPED or role in ROLES
    for name in names:
        if inside:
            off = off or name in INSIDE_HINTS
            continue
        parts = re.split(r"[-_:]+", re.sub(r"\d+$", "", name))
        if parts[0] not in NEGATIONS and HINTS.intersection(parts):
            off = True
    if off:
        return "off"
    return "main" if tag in ("article", "main") or role in ("main", "article") else ""


def lines(html: str) -> list[tuple[str, int, bool]]:
    """(text, characters of it in links, inside the marked article) of every line left.

    Takes time in proportion to the page, however deep its elements are nested.
    """
    out: list[tuple[str, int, int, bool]] = []
    stack: list[tuple[str, int, bool]] = []     # tag, off mark that holds below it, is article
    open_: Counter = Counter()                  # tags on the stack
    articles = 0                                # articles on the stack
    above = [0]                                 # for each off mark the one around it, 0: none
    holding = {0}                               # off marks around the article: wrappers of it
    pieces: list[str] = []
    linked = links = 0
    at = 0

    def off() -> int:
        return stack[-1][1] if stack else 0

    def flush() -> None:
        nonlocal linked
        text = " ".join("".join(pieces).split())
        if text:
            out.append((text, linked, off(), articles > 0))
        pieces.clear()
        linked = 0

    def pop() -> None:
        nonlocal articles
        tag, _, article = stack.pop()
        open_[tag] -= 1
        articles -= article

    while at < len(html):
        m = _TOKEN.match(html, at)
        at = m.end()
        tag = (m["tag"] or m["tag2"] or "").lower()
        if not tag:
            if m.group()[:2] not in ("<!", "<?"):
                text = unescape(m.group())
                pieces.append(text)
                if links:
                    linked += len(text.strip())
            continue
        ends = bool(m["end"] or m["end2"])
        if tag in RAW:
            if not ends:
                close = re.compile(rf"</{tag}\b[^>]*+(?:>|\Z)", re.I).search(html, at)
                at = close.end() if close else len(html)
            continue
        if tag == "a":
            links = 0 if ends else 1
        if tag == "br":
            pieces.append(" ")
        if tag in BLOCK:
            flush()
        if ends:
            if open_[tag]:
                flush()
                while stack[-1][0] != tag:
                    pop()
                pop()
            continue
        if tag in VOID:
            continue
        if tag in BLOCK and stack and stack[-1][0] == "p":
            pop()
        if tag in SELF_CLOSING and stack and stack[-1][0] == tag:
            pop()
        kind = _marked(tag, m["attrs"] or m["attrs2"] or "", articles > 0)
        mark = off()
        if kind == "off":
            flush()
            above.append(mark)
            mark = len(above) - 1
        elif kind == "main" and not articles:
            # An off element around the article is a wrapper, unless it is inside another article.
            while mark not in holding:
                holding.add(mark)
                mark = above[mark]
            mark = off()
        if kind or tag in BLOCK:
            stack.append((tag, mark, kind == "main"))
            open_[tag] += 1
            articles += kind == "main"
    flush()
    # Whether only wrappers are around a line; a mark comes after the one around it.
    free = [True]
    for n in range(1, len(above)):
        free.append(n in holding and free[above[n]])
    return [(t, n, inside) for t, n, mark, inside in out if free[mark]]


def _dives(weights: list[int]) -> bool:
    """Whether the lines between two surges are link text rather than short lines."""
    row = longest = 0
    for w in weights:
        row = 0 if w else row + 1
        longest = max(longest, row)
    return len(weights) >= GAP and (longest > GAP or 2 * weights.count(0) > len(weights))


def _extended(weights: list[int], start: int, step: int) -> int:
    """The last line before a dive (``GAP`` lines of link text, or the page's end) from
    ``start`` in the direction of ``step``."""
    last, i = start, start + step
    while 0 <= i < len(weights) and abs(i - last) <= GAP:
        if weights[i]:
            last = i
        i += step
    return last


def main_text(html: str | None) -> str:
    """The main text of a page: its lines between surge and dive, joined by newlines.

    Where the page marks its article, lines outside it weigh nothing and any text is a
    surge, so that every stretch of it is kept. Else link text weighs nothing, and the
    stretch with most text is kept with the short lines around it, up to the next dive.
    """
    found = lines(html or "")
    marked = any(inside for _, _, inside in found)
    if marked:
        weights = [len(t) if inside else 0 for t, _, inside in found]
    else:
        weights = [0 if linked >= LINK_SHARE * len(t) else len(t) for t, linked, _ in found]
    half = WINDOW // 2
    sums = [sum(weights[max(0, i - half):i + half + 1]) for i in range(len(weights))]
    stretches: list[list[int]] = []             # [first, last] lines at or over the surge
    for i, s in enumerate(sums):
        if s >= (1 if marked else SURGE):
            if stretches and (stretches[-1][1] == i - 1 or not marked and not _dives(weights[stretches[-1][1] + 1:i])):
                stretches[-1][1] = i
            else:
                stretches.append([i, i])
    if marked or not stretches:
        kept = range(len(found)) if not stretches else (i for a, b in stretches for i in range(a, b + 1))
        return "\n".join(found[i][0] for i in kept if weights[i])
    first, last = max(stretches, key=lambda s: sum(weights[s[0]:s[1] + 1]))
    while first < last and not weights[first]:
        first += 1
    while last > first and not weights[last]:
        last -= 1
    first, last = _extended(weights, first, -1), _extended(weights, last, 1)
    return "\n".join(t for t, _, _ in found[first:last + 1])


def extract(df: DataFrame, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """(key, url, text, n_chars) of every page."""
    rows = df.select(col(key).alias("_k"), col(url).alias("_u"), col(html).alias("_html"))
    kinds = dict(rows.dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunked(batches, 2):
            texts = [main_text(h) for h in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string())], names=["_k", "_u", "text"])

    got = rows.mapInArrow(run, f"_k {kinds['_k']}, _u {kinds['_u']}, text string")
    return got.select(F.col("_k").alias(key), F.col("_u").alias(url), "text",
                      F.char_length("text").cast("long").alias("n_chars"))
