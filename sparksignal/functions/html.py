"""Text, sections and links from HTML columns."""

from __future__ import annotations

import html as html_lib
import re
from urllib.parse import urljoin, urlsplit

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import strip

# Elements without visible text. The first two hold raw text,
# which may contain anything that looks like a tag.
RAW_BLOCKS = ["script", "style"]
HIDDEN_BLOCKS = ["header", "footer", "nav", "noscript"]

# Elements that never have content.
VOID_TAGS = {
    "area",
    "base",
    "br",
    "col",
    "embed",
    "hr",
    "img",
    "input",
    "link",
    "meta",
    "param",
    "source",
    "track",
    "wbr",
}

# Elements whose end tag may be left out before the element named, and those that keep them open.
_TABLE = frozenset({"table", "template"})
_LISTS = frozenset({"ul", "ol", "menu", "table", "template"})
_PARAGRAPH_LIMITS = frozenset({"button", "caption", "object", "table", "td", "template", "th"})
ENDED_BY = {
    "li": (frozenset({"li"}), _LISTS),
    "dt": (frozenset({"dt", "dd"}), frozenset({"dl", "table", "template"})),
    "dd": (frozenset({"dt", "dd"}), frozenset({"dl", "table", "template"})),
    "td": (frozenset({"td", "th"}), _TABLE | {"tr"}),
    "th": (frozenset({"td", "th"}), _TABLE | {"tr"}),
    "tr": (frozenset({"tr", "td", "th"}), _TABLE),
    "thead": (frozenset({"thead", "tbody", "tfoot", "tr", "td", "th"}), _TABLE),
    "tbody": (frozenset({"thead", "tbody", "tfoot", "tr", "td", "th"}), _TABLE),
    "tfoot": (frozenset({"thead", "tbody", "tfoot", "tr", "td", "th"}), _TABLE),
    "option": (frozenset({"option"}), frozenset({"select", "datalist"})),
    "optgroup": (frozenset({"option", "optgroup"}), frozenset({"select"})),
    "body": (frozenset({"head"}), frozenset()),
} | {
    name: (frozenset({"p"}), _PARAGRAPH_LIMITS)
    for name in (
        "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form "
        "h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre search section summary table ul"
    ).split()
}
_NOTHING = (frozenset(), frozenset())

# Headings that delimit the business section of an annual report.
SECTION_START = r"ITEM\s+1\.\s+BUSINESS"
SECTION_END = r"ITEM\s+1A\.\s+RISK\s+FACTORS"

_HREF = r"(?is)<a\s[^>]*?(?<![\w-])href\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+)"
_BREAK = "\u0001"


def drop_raw_blocks(html: Column, names: list[str] = RAW_BLOCKS) -> Column:
    """Remove comments and elements whose content is raw text."""
    out = F.regexp_replace(html, r"(?s)<!--.*?-->", _BREAK)
    for name in names:
        out = F.regexp_replace(out, rf"(?is)<{name}\b[^>]*>.*?</{name}\s*>", _BREAK)
    return out


@F.pandas_udf(T.StringType())
def unescape_entities(text: pd.Series) -> pd.Series:
    """Decode character references such as &amp; and &#233;."""
    return text.map(html_lib.unescape, na_action="ignore")


def join_text_nodes(nodes: Column) -> Column:
    """Trim each text piece and join the non-empty ones by blanks."""
    pieces = F.transform(F.split(nodes, _BREAK), strip)
    return F.array_join(F.filter(pieces, lambda piece: piece != ""), " ")


_TOKEN = re.compile(
    r"<!--.*?-->|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/<>]*)((?:[^<>\"']++|\"[^\"]*+\"|'[^']*+')*+)>", re.DOTALL
)
_HIDDEN_STYLE = re.compile(
    r"""style\s*=\s*(?:"[^"]*display:\s*none[^"]*"|'[^']*display:\s*none[^']*'|display:none)""", re.IGNORECASE
)
_RAW_END = {name: re.compile(rf"</{name}\s*>", re.IGNORECASE) for name in RAW_BLOCKS}


class _OpenElements:
    """The elements open at a place of a page, and whether one of them hides what is in it."""

    def __init__(self):
        self.names: list[str] = []
        self.count: dict[str, int] = {}
        self.hidden_from: int | None = None

    def open(self, name: str, hidden: bool) -> None:
        if hidden and self.hidden_from is None:
            self.hidden_from = len(self.names)
        self.names.append(name)
        self.count[name] = self.count.get(name, 0) + 1

    def _cut(self, size: int) -> None:
        while len(self.names) > size:
            self.count[self.names.pop()] -= 1
        if self.hidden_from is not None and self.hidden_from >= size:
            self.hidden_from = None

    def close(self, name: str) -> None:
        """An end tag also ends all elements inside; one that nothing waits for is ignored."""
        if self.count.get(name):
            self._cut(len(self.names) - 1 - self.names[::-1].index(name))

    def close_before(self, name: str) -> None:
        """End the elements whose end tag may be left out before a ``name`` element."""
        ends, limits = ENDED_BY.get(name, _NOTHING)
        while any(self.count.get(e) for e in ends):
            for at in range(len(self.names) - 1, -1, -1):
                if self.names[at] in ends:
                    self._cut(at)
                    break
                if self.names[at] in limits:
                    return
            else:
                return


def page_pieces(page: str, hidden_names: frozenset[str] = frozenset(), styled: bool = False) -> list[str]:
    """The text between a page's tags, in one pass, without what hidden elements hold.

    ``hidden_names`` are hidden elements; with ``styled``, so are elements styled
    ``display: none``. A hidden element ends where its end tag stands, where an
    element around it ends, or where a new element ends it (a list entry the one
    before it). Scripts, style sheets and comments are no text.
    """
    kept, position, elements = [], 0, _OpenElements()
    token = _TOKEN.search(page)
    while token:
        if elements.hidden_from is None:
            kept.append(page[position : token.start()])
        position = token.end()
        closing, name, attributes = token.group(1), token.group(2), token.group(3)
        if name:
            name = name.lower()
            if closing:
                elements.close(name)
            else:
                elements.close_before(name)
                whole = name in VOID_TAGS or attributes.endswith("/")
                if not whole and name in _RAW_END:
                    end = _RAW_END[name].search(page, position)
                    position = end.end() if end else len(page)
                elif not whole:
                    elements.open(name, name in hidden_names or (styled and bool(_HIDDEN_STYLE.search(attributes))))
        token = _TOKEN.search(page, position)
    if elements.hidden_from is None:
        kept.append(page[position:])
    return kept


@F.pandas_udf(T.StringType())
def text_nodes(html: pd.Series) -> pd.Series:
    """Texts between tags, entities decoded, separated by one mark; none from elements without visible text."""
    names = frozenset(HIDDEN_BLOCKS)
    return html.map(lambda page: html_lib.unescape(_BREAK.join(page_pieces(page, names))), na_action="ignore")


def visible_text(html: Column) -> Column:
    """Readable text of a page, page title included."""
    return join_text_nodes(text_nodes(html))


_PYTHON_SPACES = re.compile(r"\s+")


def plain_filing_text(html: str) -> str:
    """Text of one filing without hidden elements and tags, white space collapsed."""
    return _PYTHON_SPACES.sub(" ", html_lib.unescape(" ".join(page_pieces(html, styled=True))))


@F.pandas_udf(T.StringType())
def filing_text(html: pd.Series) -> pd.Series:
    """``plain_filing_text`` by batches: nesting is beyond regular expressions."""
    return html.map(plain_filing_text, na_action="ignore")


def _sections(text: Column) -> Column:
    """The business section as an array of one text, or empty."""
    # Cut before every start heading; the last piece then begins with its heading.
    last = F.element_at(F.split(text, rf"(?i)(?={SECTION_START})"), -1)
    parts = F.split(last, rf"(?i){SECTION_END}", 2)
    found = F.filter(F.array(parts), lambda p: (F.size(p) == 2) & F.get(p, 0).rlike(rf"(?i)^{SECTION_START}"))
    return F.transform(found, lambda p: F.trim(F.get(p, 0)))


def business_section(text: Column) -> Column:
    """From the last start heading to the first end heading after it, else NULL.

    Taking the last start heading skips the table of contents. Each pattern
    runs over the text once.
    """
    return F.get(_sections(text), 0)


def business_section_rows(text: Column) -> Column:
    """Generator of the section, without a row where there is none."""
    return F.explode(_sections(text))


def page_title(html: Column) -> Column:
    """Content of the first title element, NULL if there is none."""
    raw = F.regexp_extract(html, r"(?is)<title\b[^>]*>(.*?)</title\s*>", 1)
    text = unescape_entities(F.regexp_replace(raw, r"(?s)<[^>]*>", ""))
    return F.when(strip(text) != "", strip(text))


def page_body(html: Column) -> Column:
    """Readable text below the page head, NULL if there is none."""
    text = visible_text(F.regexp_replace(html, r"(?is)^.*?</head\s*>", ""))
    return F.when(text != "", text)


@F.pandas_udf(T.ArrayType(T.StringType()))
def _resolve(base: pd.Series, hrefs: pd.Series) -> pd.Series:
    def links(page: str | None, found) -> list[str]:
        out = set()
        for href in found if found is not None else ():
            try:
                target = urljoin(page or "", html_lib.unescape(href))
                if urlsplit(target).scheme in ("http", "https"):
                    out.add(target)
            except ValueError:
                continue
        return sorted(out)

    return pd.Series([links(page, found) for page, found in zip(base, hrefs)], index=base.index)


def page_links(base_url: Column, html: Column) -> Column:
    """Sorted distinct absolute http(s) targets of a page's anchors."""
    quoted = F.regexp_extract_all(drop_raw_blocks(html), F.lit(_HREF), F.lit(1))
    bare = F.transform(quoted, lambda href: F.regexp_replace(href, r"^[\"']|[\"']$", ""))
    return _resolve(base_url, bare)
