"""Text expressions: native where Spark has them, Arrow-batched Python where it has not."""

from __future__ import annotations

import difflib
import re
import unicodedata
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType

# Patterns of the bibliographic fields.
DOI = r"(?i)\b10\.\d{4,9}/[-._;()/:A-Z0-9]+"
YEAR = r"\b(19\d{2}|20\d{2})\b"
_TAG = re.compile(r"<[^>]+>")


def collapse(c: Column) -> Column:
    """White space of any kind runs to one space, none at the ends."""
    return F.trim(F.regexp_replace(c, r"(?U)\s+", " "))


def truncate(c: Column, limit: int = 240) -> Column:
    t = collapse(c)
    return F.when(F.length(t) > limit, F.concat(F.rtrim(F.substring(t, 1, limit - 1)), F.lit("…"))).otherwise(t)


def strip_tags(c: Column) -> Column:
    return collapse(F.regexp_replace(c, "<[^>]+>", " "))


def doi(c: Column) -> Column:
    """The first DOI without trailing punctuation, null if there is none."""
    d = F.rtrim(F.regexp_extract(c, DOI, 0), F.lit(".,;"))
    return F.when(d != "", d)


def years(c: Column) -> Column:
    return F.regexp_extract_all(c, F.lit(YEAR), F.lit(1))


def token_estimate(c: Column) -> Column:
    return F.greatest(F.lit(1), F.ceil(F.length(c) / 4)).cast("int")


def keywords(c: Column) -> Column:
    """The list after a keyword heading's colon, items trimmed of spaces and full stops, empty ones dropped."""
    rest = F.regexp_replace(c, r"(?s)^[^:]*:?", "")
    items = F.transform(F.split(rest, ","), lambda x: F.regexp_replace(x, r"^[ .]+|[ .]+$", ""))
    return F.filter(items, lambda x: x != "")


def family_name(c: Column) -> Column:
    return F.element_at(F.split(collapse(c), " "), -1)


def citation_author(families: Column, corporate: Column | None = None) -> Column:
    """One family name, two joined by e, or the first et al.; without any the corporate author, if there is one."""
    n, name = F.size(families), lambda i: F.get(families, F.lit(i))
    cited = F.when(n == 1, name(0)).when(n == 2, F.concat(name(0), F.lit(" e "), name(1))).when(n > 2, F.concat(name(0), F.lit(" et al.")))
    return cited if corporate is None else cited.when(F.coalesce(n, F.lit(0)) <= 0, corporate)


def without_accents(c: Column) -> Column:
    """Lower-case Latin letters without their accents; other characters as they are."""
    return F.translate(c, "áàâãäåéèêëíìîïóòôõöúùûüçñýÿ", "aaaaaaeeeeiiiiooooouuuucnyy")


@F.pandas_udf(StringType())
def normalize_text(s: pd.Series) -> pd.Series:
    """NFKC, case-folded, tags dropped, white space collapsed."""
    return s.map(lambda x: None if x is None else " ".join(_TAG.sub(" ", unicodedata.normalize("NFKC", x).casefold()).split()))


@F.pandas_udf(StringType())
def plain_heading(s: pd.Series) -> pd.Series:
    """NFKD without accents, case-folded, tags stripped, trimmed of spaces and .:- at the ends."""

    def one(x):
        if x is None:
            return None
        t = "".join(c for c in unicodedata.normalize("NFKD", re.sub(r"<[^>]+>", " ", x)) if not unicodedata.combining(c))
        return " ".join(t.casefold().split()).strip(" .:-")

    return s.map(one)


def sequence_ratio_of(a: str, b: str, autojunk: bool = True) -> float:
    return difflib.SequenceMatcher(None, a, b, autojunk=autojunk).ratio()


@F.pandas_udf(DoubleType())
def sequence_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """Matching-block similarity with the popularity heuristic; null if either is null."""
    return pd.Series([None if x is None or y is None else sequence_ratio_of(x, y) for x, y in zip(a, b)], dtype="float64")


@F.pandas_udf(DoubleType())
def sequence_ratio_exact(a: pd.Series, b: pd.Series) -> pd.Series:
    """The same without the heuristic."""
    return pd.Series([None if x is None or y is None else sequence_ratio_of(x, y, False) for x, y in zip(a, b)], dtype="float64")


class _Text(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.parts: list[str] = []
        self.skip = 0

    def handle_starttag(self, tag, attrs):
        self.skip += tag in ("script", "style")

    def handle_endtag(self, tag):
        self.skip -= tag in ("script", "style") and self.skip > 0

    def handle_data(self, data):
        if not self.skip and data.strip():
            self.parts.append(data.strip())


def html_to_text_of(html: str) -> str:
    p = _Text()
    p.feed(html)
    p.close()
    return " ".join(p.parts)


@F.pandas_udf(StringType())
def html_to_text(s: pd.Series) -> pd.Series:
    """Text pieces of HTML joined by one space."""
    return s.map(lambda x: None if x is None else html_to_text_of(x))


class _Markdown(HTMLParser):
    """Headings with #, lists with -, emphasis with *, strong with **, links, code; sup and sub stay as tags."""

    INLINE = {"em": "*", "i": "*", "strong": "**", "b": "**", "code": "`"}

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.out: list[str] = []
        self.lists: list[list] = []
        self.href: list[str] = []
        self.cells: list[str] | None = None
        self.rows = 0

    def handle_starttag(self, tag, attrs):
        if re.fullmatch("h[1-6]", tag):
            self.out.append("\n\n" + "#" * int(tag[1]) + " ")
        elif tag in ("p", "div", "section", "article", "blockquote"):
            self.out.append("\n\n" + ("> " if tag == "blockquote" else ""))
        elif tag == "br":
            self.out.append("\n")
        elif tag in ("ul", "ol"):
            self.lists.append([tag, 0])
            self.out.append("\n" if len(self.lists) == 1 else "")
        elif tag == "li":
            if self.lists:
                self.lists[-1][1] += 1
            mark = f"{self.lists[-1][1]}." if self.lists and self.lists[-1][0] == "ol" else "-"
            self.out.append("\n" + "  " * (len(self.lists) - 1) + mark + " ")
        elif tag in self.INLINE:
            self.out.append(self.INLINE[tag])
        elif tag in ("sup", "sub"):
            self.out.append(f"<{tag}>")
        elif tag == "a":
            self.href.append(dict(attrs).get("href") or "")
            self.out.append("[")
        elif tag == "img":
            a = dict(attrs)
            self.out.append(f"![{a.get('alt') or ''}](<{a.get('src') or ''}>)")
        elif tag == "table":
            self.rows = 0
        elif tag == "tr":
            self.cells = []
            self.out.append("\n|")
        elif tag in ("td", "th"):
            self.out.append(" ")

    def handle_endtag(self, tag):
        if tag in self.INLINE:
            self.out.append(self.INLINE[tag])
        elif tag in ("sup", "sub"):
            self.out.append(f"</{tag}>")
        elif tag == "a" and self.href:
            self.out.append(f"](<{self.href.pop()}>)")
        elif tag in ("ul", "ol") and self.lists:
            self.lists.pop()
            self.out.append("" if self.lists else "\n")
        elif tag in ("td", "th"):
            self.out.append(" |")
            if self.cells is not None:
                self.cells.append(tag)
        elif tag == "tr":
            self.rows += 1
            if self.rows == 1 and self.cells:
                self.out.append("\n|" + " --- |" * len(self.cells))

    def handle_data(self, data):
        self.out.append(re.sub(r"\s+", " ", data))


def html_to_markdown_of(html: str) -> str:
    p = _Markdown()
    p.feed(html)
    p.close()
    text = re.sub(r"[ \t]+\n", "\n", "".join(p.out))
    return re.sub(r"\n{3,}", "\n\n", text).strip()


@F.pandas_udf(StringType())
def html_to_markdown(s: pd.Series) -> pd.Series:
    return s.map(lambda x: None if x is None else html_to_markdown_of(x))
