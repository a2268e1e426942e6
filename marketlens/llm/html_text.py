"""Main text of HTML by line-block distribution.

Markup is stripped to lines, one per block that has text. A line weighs as many characters as its
text has; lines of menus, headers, footers, sidebars, notices, adverts, forms and reader comments
weigh nothing, and neither do lines of little but links, unless one stands alone: a heading or a line
after text, with text after it. The weights are summed over a sliding window of lines. Where the sums
surge past a threshold the main text begins, where they dive to nothing it ends, and at both edges
it reaches on over text up to the next line that weighs nothing; what weighs something between the
edges is kept, all of it. The threshold is SURGE characters, or half of the highest sum on a page of
short lines. Where the page marks its article, only lines in it weigh, and each weighs PRIOR more, so
that its short lines surge as well.

Boilerplate is known by element, role, hiding, and by a class or id all of whose parts say so
(`sidebar`, `left-sidebar`, `site-footer`, not `header-fixed` or `layout-sidebar`). What only a class,
a role, hiding, a form, a header or a dialog sets aside stays if it holds most of the page's text,
comments excepted.

Tags and attributes are read as browsers do: a quote opens a value only behind `=`. The text of raw
elements (scripts, styles, drawings, players) is skipped; one that is never closed ends at the next
block.

Cases: null and empty pages, and pages without main text, give an empty text. Unclosed and stray
tags, comments and scripts are read as far as they go. Repeated rows are all extracted. No rows
give none.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from marketlens.llm.common import narrow, small_batches

#: Lines of a window, characters of a surge, share of a line that may be links.
WINDOW = 3
SURGE = 86
LINKS = 0.5
#: Characters that a line weighs more for standing in the article that a page marks.
PRIOR = SURGE

# Element and class names, fixed values of HTML and of common page templates.
BLOCKS = frozenset(
    "address article aside blockquote body br button caption center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 head header hgroup hr html label legend li main menu nav ol optgroup option p pre search section select "
    "summary table tbody td tfoot th thead title tr ul".split()
)
VOID = frozenset("area base br col embed frame hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea iframe object svg math title xmp canvas audio video".split())
ASIDE_ELEMENTS = frozenset("nav footer aside head menu button select fieldset datalist".split())
SOFT_ELEMENTS = frozenset("form dialog search".split())
ASIDE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
ASIDE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising adbox banner breadcrumb breadcrumbs byline comment comments commentlist consent "
    "cookie cookies disclaimer disqus footer footnav gdpr header login masthead menu menus modal nav navbar navi navigation newsletter "
    "notice notices notification pager pagination paywall popup promo promoted promotion related recommended replies reply respond share "
    "sharing sidebar signup skip social sponsor sponsored subscribe subscription tags toolbar topbar widget widgets".split()
)
#: What may stand beside such a word in a class or id that still says no more than it.
BESIDE_WORDS = frozenset(
    "area bar bottom box block buttons col column container global inner left links list main page primary right secondary section "
    "sections site slot slots top unit wrap wrapper".split()
)
COMMENT_WORDS = frozenset("comment comments commentlist disqus replies reply respond".split())
ARTICLE_ELEMENTS = frozenset(("article", "main"))
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())

#: A comment, a tag (closing, name, attributes), or another declaration. A quote opens a value only behind `=`.
_TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:=\s*(?:"[^"]*"|'[^']*')|[^>])*+(?:>|\Z))|<[!?][^>]*(?:>|\Z)""", re.S)
_ATTRIBUTE = re.compile(r"""([^\s/>=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")
_CLOSE = {name: re.compile(rf"</{name}(?=[\s/>])[^>]*>", re.I) for name in RAW}
_BLOCK = re.compile(rf"</?(?:{'|'.join(sorted(BLOCKS))})(?=[\s/>])", re.I)
_PARTS = re.compile(r"[a-z]+|[^a-z\W_]+")


@dataclass(eq=False)
class _Open:
    """An element that is open. aside: it sets its text aside; soft: unless that is most of the page's."""

    name: str
    aside: bool
    soft: bool
    article: bool
    comments: bool
    chars: int = 0


def says_aside(token: str, inside: bool) -> tuple[bool, bool]:
    """Whether a class or id says that its element is boilerplate, and whether reader comments. In an
    article a header is part of it."""
    parts = _PARTS.findall(token)
    words = {w for w in parts if w in ASIDE_WORDS and not (inside and w == "header")}
    if not words or any(w not in words and w not in BESIDE_WORDS for w in parts):
        return False, False
    return True, bool(words & COMMENT_WORDS)


def _opened(name: str, attributes: str, inside: bool) -> _Open:
    hard, soft, comments = name in ASIDE_ELEMENTS, name in SOFT_ELEMENTS or (name == "header" and not inside), False
    if attributes.strip(" />"):
        seen: dict[str, str] = {}
        for kind, *values in _ATTRIBUTE.findall(attributes):
            seen.setdefault(kind.lower(), max(values).lower())
        soft |= seen.get("role", "").strip() in ASIDE_ROLES
        soft |= "hidden" in seen or seen.get("aria-hidden") == "true" or "display:none" in seen.get("style", "").replace(" ", "")
        if name not in ("html", "body"):
            for token in f"{seen.get('class', '')} {seen.get('id', '')}".split():
                beside, of_comments = says_aside(token, inside)
                soft |= beside
                comments |= of_comments
    hard |= comments
    return _Open(name, hard or soft, not hard, name in ARTICLE_ELEMENTS and not (hard or soft), comments)


@dataclass
class _Line:
    text: str
    article: bool
    asides: list[_Open]
    linking: bool
    heading: bool


def _lines(page: str) -> list[_Line]:
    """The lines that have text, with what is known of each."""
    out: list[_Line] = []
    stack: list[_Open] = []
    text: list[str] = []
    linked = links = 0

    def end_line() -> None:
        nonlocal text, linked
        whole = " ".join(html.unescape("".join(text)).split())
        if whole:
            asides = [e for e in stack if e.aside]
            for e in asides:
                e.chars += len(whole)
            article = any(e.article for e in stack)
            out.append(_Line(whole, article, asides, linked > LINKS * len(whole), any(e.name in HEADINGS for e in stack)))
        text, linked = [], 0

    at, size = 0, len(page)
    unclosed: set[str] = set()
    while at < size:
        token = _TOKEN.search(page, at)
        start = token.start() if token else size
        if start > at:
            text.append(page[at:start])
            if links:
                linked += start - at
        if token is None:
            break
        at = token.end()
        name = token[2]
        if name is None:
            continue
        name, closing = name.lower(), bool(token[1])
        if name in RAW:
            if not closing and not (name in ("svg", "math") and token[3].endswith("/>")):
                end = None if name in unclosed else _CLOSE[name].search(page, at)
                if end is None:
                    unclosed.add(name)
                    end = _BLOCK.search(page, at)
                    at = end.start() if end else size
                else:
                    at = end.end()
            continue
        if name in BLOCKS:
            end_line()
        if name == "a":
            links = 0 if closing else 1
        if name in VOID:
            continue
        if closing:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i].name == name:
                    del stack[i:]
                    break
        elif name in BLOCKS or name in ARTICLE_ELEMENTS or "=" in token[3]:
            if name in BLOCKS:  # a new block closes an open paragraph, an item the item before it
                while stack and (stack[-1].name == "p" or stack[-1].name not in BLOCKS or stack[-1].name == name in ("li", "option", "dt", "dd", "tr", "td", "th")):
                    stack.pop()
            own = _opened(name, token[3], any(e.article for e in stack))
            if name in ARTICLE_ELEMENTS and not own.aside:
                for e in stack:  # what holds the article isn't beside it
                    if e.aside and not e.comments and e.name not in ASIDE_ELEMENTS:
                        e.aside = False
                own.article = not any(e.aside for e in stack)
            if not token[3].endswith("/>") or name in BLOCKS:
                stack.append(own)
    end_line()
    return out


def lines(page: str) -> list[tuple[str, int, bool]]:
    """(text, weight, in an article) of each line of the page that has text."""
    found = _lines(page)
    total = sum(len(line.text) for line in found)
    weighs = [not any(e.aside and not (e.soft and 2 * e.chars > total) for e in line.asides) for line in found]
    linking = [w and line.linking and not line.article for w, line in zip(weighs, found)]
    plain = [w and not k for w, k in zip(weighs, linking)]
    out = []
    for i, line in enumerate(found):
        alone = linking[i] and (line.heading or i > 0 and plain[i - 1]) and plain[i + 1 : i + 2] == [True]
        out.append((line.text, len(line.text), line.article) if plain[i] or alone else ("", 0, line.article and not linking[i]))
    return out


def edges(weights: np.ndarray, window: int, least: int) -> tuple[int, int]:
    """First and last line of the main text; some window of `weights` sums up to `least`."""
    sums = np.convolve(weights, np.ones(window, dtype=int), "full")  # sums[i]: lines i - window + 1 to i
    high = np.flatnonzero(sums >= least)
    begin, end = max(0, int(high[0]) - window + 1), int(high[-1])
    # the last high window ends where the sums go on falling to nothing
    while end + 1 < len(sums) and sums[end + 1]:
        end += 1
    while begin and weights[begin - 1]:
        begin -= 1
    return begin, min(end, len(weights) - 1)


def main_text(page: str | None, window: int = WINDOW, surge: int = SURGE) -> str:
    found = lines(page or "")
    marked = any(article and weight for _, weight, article in found)
    weights = np.array([weight + PRIOR * marked if weight and (article or not marked) else 0 for _, weight, article in found])
    if not weights.any():
        return ""
    highest = int(np.convolve(weights, np.ones(window, dtype=int)).max())
    begin, end = edges(weights, window, min(surge, (highest + 1) // 2))
    return " ".join(text for (text, _, _), w in list(zip(found, weights))[begin : end + 1] if w)


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = [main_text(page) for page in batch.column(2).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(out, pa.string()), pa.array([len(t) for t in out], pa.int64())],
            names=["page_id", "url", "text", "n_chars"],
        )


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """A row per page: page_id, url, text, n_chars."""
    small_batches(pages.sparkSession)
    rows = narrow(pages, page_id=id_col, url=url_col, html=html_col)
    return rows.mapInArrow(_extract, f"page_id {rows.schema['page_id'].dataType.simpleString()}, url string, text string, n_chars long")
