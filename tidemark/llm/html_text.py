"""Main text of web pages by line-block distribution.

Markup is stripped to lines, one for each block of the page. A line's length is what it adds to the article: nothing where it
lies in a menu, header, footer, sidebar, notice, advert, form or comment, or (outside of an article) where all of it is links.
The lengths of ``window`` lines on end are summed at every line. Where the sum rises from nothing is a surge, where it falls back
to nothing a dive, and the text of the lines between the two is kept. Where one of those parts begins or ends, empty lines stand between
it and the lines beside it, so that no window reaches over.

A page that marks its article (or, failing that, its main part) is measured there alone. In a page without
such marks a stretch counts if its greatest sum reaches ``surge`` code points, and the greatest stretch of a page always does.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Elements whose content is no text, elements without an end, elements that stand in a line of text.
_RAW = "script|style|noscript|template|title|textarea|iframe|svg|math|object|canvas|audio|video"
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
# Elements and words of class, id and role that tell what is not the article.
_ASIDE = frozenset("nav header footer aside form menu dialog button select fieldset".split())
_NAMES = frozenset("ad ads adv advert adverts advertisement advertising banner breadcrumb breadcrumbs captcha consent cookie cookies disclaimer disqus footer header login masthead menu modal nav navbar navigation newsletter notice notices notification pagination paywall popup promo promotion recommended related search share sharing sidebar signup skyscraper social sponsor sponsored subscribe tags toolbar widget alert complementary contentinfo".split())
_WITH = frozenset("has with without no".split())
_REPLIES = frozenset("comment comments commentlist replies reply discussion respond".split())
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())

_TOKEN = re.compile(rf"<!--.*?(?:-->|\Z)|<(?P<raw>{_RAW})\b.*?(?:</(?P=raw)\s*>|\Z)|<(?P<end>/?)(?P<name>[a-z][^\s/>]*)(?P<rest>(?:[^>\"']++|\"[^\"]*\"|'[^']*'|[\"'])*+)(?:>|\Z)|<[!?/][^>]*(?:>|\Z)", re.S | re.I)
_MARKS = re.compile(r"\b(?:class|id|role|itemprop)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+))", re.I)
_FREE, _SOFT, _HARD = 0, 1, 2
_ANYWHERE, _MAIN, _ARTICLE = 0, 1, 2


def _words(marks: str) -> set[str]:
    """The names in class, id and role, each with its first and last part: ``site-header``, ``ad_top``, ``mainNav``. ``has-sidebar`` tells of another element."""
    out = set()
    for name in re.sub("(?<=[a-z])(?=[A-Z])", "-", marks).lower().split():
        parts = re.split("[-_]+", name)
        if _WITH.isdisjoint(parts):
            out |= {name, parts[0], parts[-1]}
    return out


def _kind(name: str, rest: str) -> tuple[int, bool, bool]:
    """How firmly an element lies outside of the article, whether it holds readers' comments, whether it is an article's body."""
    found = " ".join(x for m in _MARKS.findall(rest) for x in m) if rest and name not in ("html", "body") else ""
    words = _words(found) if found else set()
    replies = not words.isdisjoint(_REPLIES)
    if name in _ASIDE or replies:
        return _HARD, replies, False
    return (_SOFT if not words.isdisjoint(_NAMES) else _FREE), False, "articlebody" in found.lower()


def _lines(page: str, window: int) -> tuple[list[str], list[int], list[int]]:
    """The lines of a page, each with the code points it adds and the part it lies in; empty lines stand where parts meet."""
    lines, sizes, scopes = [], [], []
    stack: list[tuple[str, int, int, int]] = []  # element, then what held outside of it
    level, scope, links = _FREE, _ANYWHERE, 0
    text: list[str] = []
    free: list[str] = []

    def close() -> None:
        if text:
            line = " ".join(html.unescape("".join(text)).split())
            if line:
                bare = len(" ".join(html.unescape("".join(free)).split()))
                lines.append(line)
                sizes.append(0 if level else len(line) if scope == _ARTICLE else bare)
                scopes.append(scope)
            text.clear()
            free.clear()

    def gap() -> None:
        lines.extend([""] * window)
        sizes.extend([0] * window)
        scopes.extend([scope] * window)

    def leave(to: int) -> None:
        nonlocal level, scope, links
        close()
        before = level, scope
        _, level, scope, links = stack[to]
        del stack[to:]
        if before != (level, scope):
            gap()

    at = 0
    for m in _TOKEN.finditer(page):
        if m.start() > at and not level:
            part = page[at : m.start()]
            text.append(part)
            if not links:
                free.append(part)
        at = m.end()
        name = m["name"]
        if name is None:
            continue
        name = name.lower()
        if m["end"]:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == name:
                    if name in _INLINE and i == len(stack) - 1 and stack[i][1:3] == (level, scope):
                        links = stack.pop()[3]
                    elif name not in _INLINE or stack[i][1:3] != (level, scope):
                        leave(i)
                    else:
                        links = stack.pop(i)[3]
                    break
            else:
                if name not in _INLINE:
                    close()
            continue
        if name not in _INLINE:
            close()
        if name in _VOID:
            continue
        firm, replies, body = _kind(name, m["rest"])
        stack.append((name, level, scope, links))
        before = level, scope
        if name == "a":
            links += 1
        article = body or name in ("article", "main")
        if name in _HEADINGS and level == _SOFT and scope == _ARTICLE:
            level = _FREE  # the heading of an article in a header of its own
        elif name == "header" and scope == _ARTICLE:
            level = max(level, _SOFT)
        elif article and level <= _SOFT and not replies and firm < _SOFT:
            level = _FREE
        else:
            level = max(level, firm)
        if article and not level:
            scope = max(scope, _MAIN if name == "main" and not body else _ARTICLE)
        if before != (level, scope):
            close()
            gap()
    if at < len(page) and not level:
        text.append(page[at:])
        if not links:
            free.append(page[at:])
    close()
    return lines, sizes, scopes


def main_text(page: str | None, window: int = 3, surge: int = 80) -> str:
    """The main text of one page; empty if it has none."""
    if not page:
        return ""
    lines, sizes, scopes = _lines(page, window)
    size, scope = np.array(sizes, np.int64), np.array(scopes, np.int64)
    marked = scope[size > 0]
    if not len(marked):
        return ""
    best = int(marked.max())
    size[scope < best] = 0
    total = np.concatenate([[0], np.cumsum(size)])
    n = len(size)
    # The sum of the window that begins at each line, and at the places where it still reaches back before the first.
    starts = np.arange(1 - window, n)
    block = total[np.minimum(starts + window, n)] - total[np.maximum(starts, 0)]
    rising = np.concatenate([[False], block > 0, [False]])
    surges, dives = np.flatnonzero(~rising[:-1] & rising[1:]), np.flatnonzero(rising[:-1] & ~rising[1:])
    peaks = np.array([block[a:b].max() for a, b in zip(surges, dives, strict=True)])
    kept = np.ones(len(peaks), bool) if best else peaks >= min(surge, peaks.max())
    out: list[str] = []
    for a, b in zip(surges[kept], dives[kept], strict=True):
        there = np.flatnonzero(size[max(a - window + 1, 0) : min(b, n)]) + max(a - window + 1, 0)
        out += [lines[i] for i in range(there[0], there[-1] + 1) if lines[i]]
    return " ".join(out)


def extract_main_text(pages: DataFrame, html_col: str = "html", carry: list[str] | None = None, window: int = 3, surge: int = 80) -> DataFrame:
    """The columns ``carry`` (all but the page itself, if none are named), ``text`` and ``n_chars`` of every page.

    The whole page is read. Character references are decoded as browsers do, white space inside a block becomes one space, blocks
    are joined by one space in the order of the page. A null or empty page, or one without text of its own, has empty text. Rows that
    repeat are answered each by itself; an empty table gives an empty one. Unclosed elements end with the element around them. A
    carried column named ``text`` or ``n_chars`` fails the call. One pass without a shuffle.
    """
    carry = [c for c in pages.columns if c != html_col and c not in ("text", "n_chars")] if carry is None else carry
    if {c.lower() for c in carry} & {"text", "n_chars"}:
        raise ValueError("carried columns must not be named text or n_chars")
    shape = T.StructType([*[pages.schema[c] for c in carry], T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [main_text(page.as_py(), window, surge) for page in batch.column(batch.num_columns - 1)]
            columns = [*batch.columns[:-1], pa.array(got, pa.string()), pa.array(map(len, got), pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=shape.names)

    return pages.select(*[F.col(f"`{c}`") for c in carry], F.col(f"`{html_col}`").cast("string").alias("_page")).mapInArrow(texts, shape)
