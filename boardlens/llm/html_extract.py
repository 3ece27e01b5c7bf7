"""Main text of a web page by the distribution of text over line blocks."""

from __future__ import annotations

import html
import re

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

WINDOW = 3  # lines of a block
SURGE = 60  # characters that a block of a text has to reach, or half of the page's fullest block if that is less
LINK_SHARE = 0.6  # a line with more of its characters in links is a menu line

# Elements, roles and name parts by their public meaning in HTML.
RAW = {"script", "style", "noscript", "template", "iframe", "svg", "math", "object", "canvas", "select", "textarea", "title", "video", "audio"}
DROPPED = {"nav", "footer", "aside", "form", "head", "menu", "dialog", "button", "fieldset", "map", "datalist"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
BLOCKS = {
    "address", "article", "aside", "blockquote", "body", "caption", "center", "dd", "details", "dialog", "dir", "div", "dl", "dt", "fieldset",
    "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "head", "header", "hgroup", "hr", "html", "legend", "li",
    "main", "menu", "nav", "ol", "optgroup", "option", "p", "pre", "search", "section", "summary", "table", "tbody", "td", "tfoot", "th",
    "thead", "tr", "ul",
}
ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "alert", "alertdialog", "dialog", "menu", "menubar", "toolbar"}
NAMES = {
    "nav", "navbar", "navigation", "menu", "menubar", "breadcrumb", "breadcrumbs", "masthead", "topbar", "header", "footer", "sidebar", "aside",
    "widget", "ad", "ads", "advert", "adverts", "advertisement", "advertising", "sponsor", "sponsored", "promo", "promotion", "banner", "cookie",
    "cookies", "consent", "gdpr", "notice", "notices", "notification", "alert", "popup", "modal", "overlay", "newsletter", "subscribe",
    "subscription", "signup", "login", "search", "share", "sharing", "social", "related", "recommended", "recommendations", "comment",
    "comments", "replies", "respond", "disqus", "pagination", "pager", "toolbar", "copyright", "disclaimer", "legal", "tagcloud", "toc",
}
NEGATIONS = {"no", "has", "with", "without", "not"}
WHOLE = {"html", "body", "main"}  # their names describe the page, not a part of it

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?>[^\"'>]+|\"[^\"]*\"|'[^']*')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>",
    re.S,
)
_ATTRIBUTE = re.compile(r"([^\s=\"'/>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_NAME_PART = re.compile(r"[a-z]+")
_RAW_END = {t: re.compile(rf"</{t}\s*>", re.I) for t in RAW}


def _drops(tag: str, attributes: str, inside_text: bool) -> bool:
    """Whether an element holds no main text, by its name and its attributes."""
    if tag in DROPPED or tag == "header" and not inside_text:
        return True
    if not attributes or attributes.isspace() or tag in WHOLE:
        return False
    found = {m[1].lower(): next((v for v in m.groups()[1:] if v is not None), "") for m in _ATTRIBUTE.finditer(attributes)}
    if "hidden" in found or found.get("aria-hidden") == "true" or found.get("role", "").lower() in ROLES:
        return True
    if "none" in found.get("style", "") and re.search(r"display\s*:\s*none", found["style"]):
        return True
    for name in f"{found.get('class', '')} {html.unescape(found.get('id', ''))}".lower().split():
        parts = set(_NAME_PART.findall(name))
        if parts & NAMES and not parts & NEGATIONS and not (tag == "article" and not parts & {"comment", "comments", "ad", "advert", "promo"}):
            return not (inside_text and "header" in parts and not parts & (NAMES - {"header"}))
    return False


def page_lines(page: str) -> list[tuple[str, int, bool, bool]]:
    """The page as (text, characters in links, stripped, inside article or main) for each block element's run of text, in page order.

    ``stripped`` marks text inside elements that hold none of the main text. Scripts, styles, comments and markup are gone.
    """
    lines: list[tuple[str, int, bool, bool]] = []
    parts: list[str] = []
    links = 0
    stack: list[tuple[str, bool]] = []
    counts: dict[str, int] = {}
    stripped = 0

    def flush() -> None:
        nonlocal links
        text = " ".join(html.unescape("".join(parts)).split())
        if text:
            lines.append((text, links, stripped > 0, bool(counts.get("article") or counts.get("main"))))
        parts.clear()
        links = 0

    def close(tag: str) -> None:
        nonlocal stripped
        while stack:
            name, drop = stack.pop()
            counts[name] -= 1
            stripped -= drop
            if name == tag:
                return

    def add(text: str) -> None:
        nonlocal links
        parts.append(text)
        if counts.get("a"):
            links += len(" ".join(html.unescape(text).split()))

    at = 0
    while m := _TOKEN.search(page, at):
        if m.start() > at:
            add(page[at : m.start()])
        at = m.end()
        tag = (m[2] or m[5] or "").lower()
        if not tag:
            continue
        if m[1] or m[4]:  # an end tag
            if tag in BLOCKS:
                flush()
            if counts.get(tag):
                close(tag)
            continue
        attributes = m[3] or m[6] or ""
        if tag in RAW:
            if not attributes.endswith("/") or tag not in {"svg", "math"}:
                end = _RAW_END[tag].search(page, at)
                at = end.end() if end else len(page)
            continue
        if tag == "br":
            parts.append(" ")
        if tag in BLOCKS:
            flush()
            if counts.get("p") and stack and any(name == "p" for name, _ in stack[-4:]):
                close("p")  # a block ends an open paragraph
            if tag in {"li", "dt", "dd", "tr", "td", "th", "option"} and stack and stack[-1][0] == tag:
                close(tag)
        if tag in VOID or attributes.endswith("/"):
            continue
        drop = _drops(tag, attributes, bool(counts.get("article") or counts.get("main")))
        stack.append((tag, drop))
        counts[tag] = counts.get(tag, 0) + 1
        stripped += drop
    if at < len(page):
        add(page[at:])
    flush()
    return lines


def text_spans(lengths: np.ndarray) -> list[tuple[int, int]]:
    """Line ranges [from, to) between a surge and the next dive of the block lengths.

    A block is WINDOW lines, its length the sum of theirs. The lengths rise from zero at a surge and return to zero
    at a dive; what lies between counts as text if a block there reaches the bound, which half of the page's fullest
    block lowers on pages with little text.
    """
    n = len(lengths)
    if not n or not lengths.any():
        return []
    sums = np.convolve(np.concatenate([lengths, np.zeros(WINDOW - 1, lengths.dtype)]), np.ones(WINDOW, lengths.dtype), "valid")
    bound = min(SURGE, sums.max() / 2)
    rises = np.diff(np.concatenate([[0], (sums > 0).astype(np.int8), [0]]))
    surges, dives = np.flatnonzero(rises == 1), np.flatnonzero(rises == -1)
    return [(int(a), int(b)) for a, b in zip(surges, dives, strict=True) if sums[a:b].max() >= bound]


def main_text(page: str | None) -> str:
    """The article of a page, its blocks joined by an empty line; null and pages without text give an empty string.

    Stripped lines are left out before blocks are summed. Inside article or main all other lines stay, also linked and short ones.
    """
    if not page:
        return ""
    lines = [x for x in page_lines(page) if not x[2]]
    lengths = np.array([0 if links > LINK_SHARE * len(text) and not inside else len(text) for text, links, _, inside in lines], np.int64)
    kept = {i for a, b in text_spans(lengths) for i in range(a, b) if lengths[i]}
    return "\n\n".join(text for i, (text, *_, inside) in enumerate(lines) if inside or i in kept)


@F.pandas_udf(StringType())
def _main_text(pages: pd.Series) -> pd.Series:
    return pd.Series([main_text(x) for x in pages], dtype=object)


def extract(page: Column) -> Column:
    """The main text of a column of HTML pages."""
    return _main_text(page)
