"""Main text of HTML pages by tag-path ratios.

A page is cut into text nodes, each with its path of open tags from the root. Per
page and distinct path, text length and punctuation are added up. A path's
ratio is its text per node, raised by its share of the page's punctuation:
articles put long, punctuated text under few paths, menus short words under many
nodes. The sequence of ratios in page order is smoothed by a Gaussian, so that
headings and short paragraphs between long ones keep up with them; the smoothed
values are averaged per path and fused with the paths' own ratios. Paths above
a share of the values' standard deviation are content.

The innermost element that holds all selected blocks is the article: all its
blocks are kept, also short ones, in page order; no selected block is lost. Elements that by HTML's meaning or by
their class, id or role are no article text (menus, headers, footers, sidebars,
notices, adverts, forms, comments, scripts, styles) are left out first. A class or
id counts as a whole: `legal` or `site-header`, not `legal-background`; on headings it
never counts. A form that holds most of the page's text is the page, not a form.

Parsing is forgiving: unclosed paragraphs, list items and cells end where HTML
says so; stray end tags are ignored; comments, scripts and styles are skipped
whole, whatever they hold. One pass with one compiled pattern, linear in the page.

Rows are only mapped: nothing is shuffled, no page meets another. Defined
results: a null or empty page has the empty text; a page without content paths
gives the text of all its blocks that are not left out; a page without any gives
the empty text; repeated rows stay; the other columns are kept, but those named
like a result are replaced.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import LongType, StringType, StructField, StructType

SMOOTHING = 1.0
CUT = 0.3

# Names from the HTML standard and words that sites use for what is not article text.
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = "script|style|noscript|template|textarea|iframe|svg|title|select|object"
_SKIPPED = frozenset(
    "head nav header footer aside button menu dialog".split()
) | frozenset(_RAW.split("|"))
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small "
    "span strike strong sub sup time tt u var wbr".split()
)
_NOT_TEXT = frozenset(
    "ad ads advert adverts advertisement advertising advertorial banner promo promoted promotion sponsor sponsored "
    "nav navbar navigation menu submenu breadcrumb breadcrumbs pagination pager header masthead topbar footer sidebar aside "
    "rail widget comment comments respond disqus discussion notice notices cookie cookies consent gdpr newsletter "
    "subscribe subscription signup login modal popup overlay share sharing social related recommended "
    "toolbar skip copyright search form alert disclaimer legal reply replies topnav subnav sidenav adbox adslot "
    "adunit adsense adsbygoogle".split()
)
# Words that may stand before or after them in a whole class or id, as in `site-header` or `nav-links`.
_BEFORE = frozenset(
    "site page main global primary secondary top bottom left right sub side sticky fixed mobile desktop article post "
    "entry blog content user".split()
)
_AFTER = frozenset(
    "box area bar list section block container wrapper inner item items link links button buttons icons row group "
    "slot unit posts articles stories news".split()
)
_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar".split())
_CLOSED_BY = {
    "li": frozenset(["li"]),
    "dt": frozenset(["dt", "dd"]),
    "dd": frozenset(["dt", "dd"]),
    "tr": frozenset(["tr", "td", "th"]),
    "td": frozenset(["td", "th"]),
    "th": frozenset(["td", "th"]),
    "option": frozenset(["option"]),
}
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_SCOPES = frozenset("ul ol dl table article section div body html main".split())
_ENDS_P = frozenset(
    "address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header "
    "hr main menu nav ol p pre section table ul".split()
)

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<svg(?![^\s/>])(?:[^>\"']|\"[^\"]*\"|'[^']*')*/>"
    rf"|<(?P<raw>{_RAW})(?![^\s/>])(?:[^>\"']|\"[^\"]*\"|'[^']*')*>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)>"
    r"|<[!?/][^>]*>",
    re.S | re.I,
)
_ATTRIBUTE = re.compile(r"([^\s\"'<>/=]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?")
_LABEL_WORD = re.compile(r"[^\W\d_]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
_PUNCTUATION = re.compile(r"[.,;:!?…。，；：！？]")


def _no_article(token: str) -> bool:
    """Whether a class or id as a whole names what is no article text."""
    words = _LABEL_WORD.findall(_CAMEL.sub("-", token).lower())
    named = [w in _NOT_TEXT for w in words]
    return bool(words) and (
        "".join(words) in _NOT_TEXT
        # The last word names the thing: `article-header` is a header, `header-image-article` an article.
        or (named[-1] and all(n or w in _BEFORE for n, w in zip(named, words, strict=True)))
        or (named[0] and all(n or w in _AFTER for n, w in zip(named, words, strict=True)))
    )


def _labels(tag: str, rest: str) -> tuple[str, bool]:
    """What tells the element from others of its tag, and whether it is no article text."""
    skipped, name = False, ""
    for key, value in _ATTRIBUTE.findall(rest):
        key, value = key.lower(), value.strip("\"'")
        if key == "role":
            skipped |= value.lower() in _ROLES and tag != "form"
        elif key == "aria-hidden":
            skipped |= value.lower() == "true"
        elif key == "hidden":
            skipped = True
        elif key in ("class", "id"):
            name += f".{value}" if key == "class" else ""
            if tag not in _HEADINGS and tag != "form":
                skipped |= any(map(_no_article, value.split()))
    return name, skipped


def blocks(page: str) -> list[tuple[tuple[str, ...], tuple[int, ...], str]]:
    """(tag path, numbers of the open elements, text) of each text block that is not left out."""
    out: list = []
    stack: list[tuple[str, str, int, bool]] = []  # tag, label, number, left out
    parts: list[str] = []
    at, elements = 0, 0
    place: list[tuple[str, str, int, bool]] = []

    def flush() -> None:
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            if text:
                out.append((tuple(t + n for t, n, _, _ in place), tuple(k for _, _, k, _ in place), text))
            parts.clear()

    for token in _TOKEN.finditer(page):
        if token.start() > at and not (stack and stack[-1][3]):
            if not parts:
                place = [s for s in stack if s[0] not in _INLINE]
            parts.append(page[at : token.start()])
        at = token.end()
        name = token["name"]
        if name is None:
            continue
        name = name.lower()
        if token["end"]:
            if any(s[0] == name for s in stack):
                if name not in _INLINE:
                    flush()
                    while stack[-1][0] != name:
                        stack.pop()
                    stack.pop()
                elif stack[-1][0] == name:
                    stack.pop()
                else:
                    # An inline end tag closes its own element, not the blocks inside it.
                    last = max(i for i, s in enumerate(stack) if s[0] == name)
                    if all(s[0] in _INLINE for s in stack[last:]):
                        del stack[last:]
            continue
        if name not in _INLINE:
            flush()
        if name in _VOID:
            continue
        if name in _ENDS_P and any(s[0] == "p" for s in stack):
            last = max(i for i, s in enumerate(stack) if s[0] == "p")
            if not any(s[0] in _SCOPES for s in stack[last:]):
                del stack[last:]
        closes = _CLOSED_BY.get(name)
        if closes:
            last = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] in closes or stack[i][0] in _SCOPES), -1)
            if last >= 0 and stack[last][0] in closes:
                del stack[last:]
        label, skipped = _labels(name, token["rest"]) if token["rest"].strip() else ("", False)
        # The root may carry site-wide words in its classes.
        skipped = (skipped and name not in ("html", "body", "main")) or name in _SKIPPED
        skipped |= bool(stack) and stack[-1][3]
        if not token["rest"].rstrip().endswith("/") or name not in ("path", "use"):
            elements += 1
            stack.append((name, label, elements, skipped))
    if at < len(page) and not (stack and stack[-1][3]):
        if not parts:
            place = [s for s in stack if s[0] not in _INLINE]
        parts.append(page[at:])
    flush()
    # A form is left out, but not one around most of the text.
    sizes: dict[int, int] = {}
    for path, numbers, text in out:
        for tag, number in zip(path, numbers, strict=True):
            if tag.partition(".")[0] == "form":
                sizes[number] = sizes.get(number, 0) + len(text)
    whole = sum(len(text) for _, _, text in out)
    small = {number for number, size in sizes.items() if 2 * size <= whole}
    return [block for block in out if small.isdisjoint(block[1])] if small else out


def path_scores(nodes: list[tuple[tuple[str, ...], tuple[int, ...], str]]) -> np.ndarray:
    """The fused ratio of each node's path."""
    number: dict[tuple[str, ...], int] = {}
    path = np.array([number.setdefault(p, len(number)) for p, _, _ in nodes])
    length = np.array([len(t) for _, _, t in nodes], dtype=float)
    marks = np.array([len(_PUNCTUATION.findall(t)) for _, _, t in nodes], dtype=float)
    count = np.bincount(path)
    text = np.bincount(path, weights=length)
    punctuation = np.bincount(path, weights=marks)
    ratio = text / count * (1 + punctuation / max(1.0, punctuation.sum()))
    along = ratio[path]
    reach = np.arange(-2, 3)
    kernel = np.exp(-(reach**2) / (2 * SMOOTHING**2))
    weight = np.convolve(np.ones(len(along)), kernel, mode="full")[2:-2]
    smooth = np.convolve(along, kernel, mode="full")[2:-2] / weight
    fused = (np.bincount(path, weights=smooth) / count + ratio) / 2
    return fused[path]


def main_text(page: str | None) -> str:
    """The article's blocks, white space inside each one space, joined by one space."""
    nodes = blocks(page or "")
    if not nodes:
        return ""
    scores = path_scores(nodes)
    chosen = scores >= CUT * (scores.std() or scores.max())
    own = [set(elements) for (_, elements, _), c in zip(nodes, chosen, strict=True) if c]
    # Elements are numbered as they open, so of several that hold all the last is innermost.
    enough = set.intersection(*own) if own else set()
    # A paragraph is never the article: the next element around it is.
    kinds = {e: p for path, elements, _ in nodes for e, p in zip(elements, path, strict=True)}
    enough = [e for e in enough if re.match(r"\w+", kinds[e])[0] in _SCOPES]
    article = max(enough) if enough else None
    kept = [t for (_, elements, t) in nodes if article is None or article in elements]
    return " ".join(kept)


def extract(pages: DataFrame, page: str = "html", result: str = "text") -> DataFrame:
    """`pages`, all columns, with the main text and `n_chars`, its code points."""
    pages = pages.drop(*({result, "n_chars"} - {page}))
    at = pages.columns.index(page)
    schema = StructType(
        [*pages.schema.fields, StructField(result, StringType()), StructField("n_chars", LongType())]
    )
    arrow = to_arrow_schema(schema)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(p.as_py()) for p in batch.column(at)]
            added = [pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *added], schema=arrow)

    return pages.mapInArrow(task, schema)
