"""Problem 3: one consistent form for text that looks the same.

Two implementations of one mapping:

* ``unify_column``: the distributed operator. Strings that hold at least one
  character outside the stable repertoire are exploded into positioned code
  points, joined with the (broadcast) decomposition and look-alike table,
  rebuilt in order, and their combining marks ordered by class and recomposed.
* ``fold``: the same mapping for one Python string, for operators that already
  hold the text in Python.

What changes: character width, composition of accents, invisible characters,
kinds of space and hyphen, ligatures, look-alike letters of other scripts.
What stays: case, accents, raised figures and all other punctuation.
"""

from __future__ import annotations

import re
import sys
import unicodedata
from functools import lru_cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Letters of other scripts that are drawn like Latin letters.
LOOKALIKES = {
    # Cyrillic
    "а": "a", "с": "c", "ԁ": "d", "е": "e", "һ": "h", "і": "i", "ј": "j", "ӏ": "l", "о": "o", "р": "p",
    "ԛ": "q", "ѕ": "s", "ѵ": "v", "ԝ": "w", "х": "x", "у": "y", "ү": "y",
    "А": "A", "В": "B", "С": "C", "Е": "E", "Н": "H", "І": "I", "Ј": "J", "К": "K", "М": "M", "О": "O",
    "Р": "P", "Ԛ": "Q", "Ѕ": "S", "Т": "T", "Ԝ": "W", "Х": "X", "У": "Y", "Ү": "Y", "Ӏ": "I", "Ѵ": "V",
    # Greek
    "α": "a", "ι": "i", "ο": "o", "ρ": "p", "ν": "v", "υ": "u", "γ": "y", "ϲ": "c", "ϳ": "j",
    "Α": "A", "Β": "B", "Ϲ": "C", "Ε": "E", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O",
    "Ρ": "P", "Τ": "T", "Χ": "X", "Υ": "Y", "Ζ": "Z",
    # Armenian
    "ց": "g", "հ": "h", "ո": "n", "օ": "o", "զ": "q", "ս": "u", "Օ": "O", "Տ": "S", "Լ": "L",
    # Latin letters for phonetics and dotless i
    "ɡ": "g", "ɑ": "a", "ı": "i",
}
# Hyphens drawn like the ASCII hyphen.
HYPHENS = "‐‑﹣－֊"
# Characters without a shape besides the format characters (category Cf).
SHAPELESS = [0x034F, 0x115F, 0x1160, 0x17B4, 0x17B5, 0x3164, 0xFFA0, *range(0x180B, 0x180F), *range(0xFE00, 0xFE10)]
# Characters that the mapping never changes and that cannot combine; a string of only these is its own form.
STABLE_CLASS = "\\x00-\\x7E\\u00A1-\\u00AC\\u00AE-\\u017F\\u2013\\u2014\\u2018-\\u201D\\u2020-\\u2022\\u2026\\u2030\\u20AC"
# the look-ahead spares ASCII characters the walk through the ranges
UNSTABLE = f"(?=[^\\x00-\\x7E])[^{STABLE_CLASS}]|[\\u0131-\\u0133\\u0149]"
_UNSTABLE = re.compile(f"[^{STABLE_CLASS}]|[\\u0131-\\u0133\\u0149]")


@lru_cache(maxsize=1)
def mapping() -> dict[int, str]:
    """Code point to its replacement, for every code point that changes.

    Made from the Unicode tables by rule; about 3,000 entries, fixed by Unicode
    and so bounded whatever the data.
    """
    out: dict[int, str] = {}
    shapeless = set(SHAPELESS)
    for cp in range(0xA0, sys.maxunicode + 1):
        if 0xAC00 <= cp <= 0xD7A3 or 0xD800 <= cp <= 0xDFFF or 0x4E00 <= cp <= 0x9FFF:
            continue
        ch = chr(cp)
        cat = unicodedata.category(ch)
        if cat == "Cn" or cat == "Co":
            continue
        if cat == "Cf" or cp in shapeless:
            out[cp] = ""
            continue
        if cat == "Zs":
            out[cp] = " "
            continue
        if ch in HYPHENS:
            out[cp] = "-"
            continue
        parts = unicodedata.decomposition(ch)
        base = ch
        if parts.startswith(("<wide>", "<narrow>")) or (parts.startswith("<compat>") and "LIGATURE" in unicodedata.name(ch, "")):
            base = unicodedata.normalize("NFKC", ch)
        made = "".join(LOOKALIKES.get(c, c) for c in unicodedata.normalize("NFD", base))
        made = unicodedata.normalize("NFC", made)
        if made != ch:
            out[cp] = made
    return out


def fold(text: str) -> str:
    """The one form of a Python string."""
    if text.isascii():
        return text
    try:
        raw = text.encode("latin-1")
        if b"\xa0" not in raw and b"\xad" not in raw:
            return text
    except UnicodeEncodeError:
        if not _UNSTABLE.search(text):
            return text
    return unicodedata.normalize("NFC", text.translate(mapping()))


@F.pandas_udf(StringType())
def _fold(s):
    return s.map(lambda x: None if x is None else fold(x))


def folded_text(text: Column) -> Column:
    """``fold`` of a column for operators that only compare: the few affected texts go through Python, the rest stay in the JVM."""
    return F.coalesce(_fold(F.when(is_unstable(text), text)), text)


def mapping_frame(spark: SparkSession) -> DataFrame:
    """``ch, parts``: the mapping as rows, one per character that changes, bounded by Unicode."""
    return spark.createDataFrame([(chr(cp), made) for cp, made in mapping().items()], "ch string, parts string")


@F.pandas_udf(StringType())
def _compose(s):
    return s.map(lambda x: None if x is None else unicodedata.normalize("NFC", x))


def is_unstable(c: Column) -> Column:
    return c.rlike(UNSTABLE)


def unify_column(df: DataFrame, text: str, out: str = "unified") -> DataFrame:
    """``df`` with ``out``, the one form of column ``text``.

    Null stays null, empty stays empty. Each distinct affected string is treated
    once, whatever the number of its rows; equal strings get equal results. Only
    affected strings are shuffled; a very long string makes one group of its own
    code points and no more. Other columns, whatever their names, are kept.
    """
    spark = df.sparkSession
    # rows of one code point carry a hash of their string, never the string
    key = F.when(is_unstable(F.col(f"`{text}`")), F.unhex(F.md5(F.col(f"`{text}`"))))
    affected = df.select(key.alias("__k"), F.col(f"`{text}`").alias("__s")).where("__k is not null").dropDuplicates(["__k"])
    # one row per code point, each replaced by its parts
    points = affected.select("__k", F.posexplode(F.regexp_extract_all("__s", F.lit("(?s)."), F.lit(0))).alias("__pos", "ch"))
    mapped = points.join(F.broadcast(mapping_frame(spark)), "ch", "left").select("__k", "__pos", F.coalesce("parts", "ch").alias("part"))
    whole = mapped.groupBy("__k").agg(F.array_sort(F.collect_list(F.struct("__pos", "part"))).alias("a"))
    # ordering of the marks by combining class and recomposition are the two steps of NFC
    fixed = whole.select("__k", _compose(F.array_join(F.transform("a", lambda x: x["part"]), "")).alias("__u"))
    keep = [F.col(f"l.`{c}`") for c in df.columns if c != out]
    left = df.withColumn("__key", key)
    return left.alias("l").join(fixed.alias("r"), F.col("l.__key") == F.col("r.__k"), "left").select(*keep, F.coalesce(F.col("r.__u"), F.col(f"l.`{text}`")).alias(out))


def look_alike_pairs(df: DataFrame, field: str, key: str, text: str) -> DataFrame:
    """``field, key_a, key_b``: pairs of rows whose strings differ but look the same; key_a < key_b.

    Pairs are made of distinct strings first, then of the rows that hold them,
    so a string that thousands of rows share meets only its variants and never
    itself. Null keys and null strings give no pairs.
    """
    rows = df.select(F.col(field).alias("field"), F.col(key).alias("key"), F.col(text).alias("t")).where(F.col("key").isNotNull() & F.col("t").isNotNull()).distinct()
    # A group only matters if one of its members is affected; all members are needed, affected or not.
    strings = rows.select("field", "t").distinct()
    forms = unify_column(strings, "t", "u").select("field", F.unhex(F.md5("u")).alias("g"), F.unhex(F.md5("t")).alias("h"), (F.col("t") != F.col("u")).alias("odd"))
    # one of each pair of variants is always odd: two stable strings that look the same are equal
    odd = forms.where("odd").select("field", "g", F.col("h").alias("ha"))
    pairs = odd.join(forms.select("field", "g", F.col("h").alias("hb"), F.col("odd").alias("odd_b")), ["field", "g"]).where("ha <> hb and (not odd_b or ha < hb)").select("field", "ha", "hb")
    keys = rows.select("field", "key", F.unhex(F.md5("t")).alias("h"))
    a = pairs.join(keys.select("field", F.col("h").alias("ha"), F.col("key").alias("a")), ["field", "ha"])
    b = a.join(keys.select("field", F.col("h").alias("hb"), F.col("key").alias("b")), ["field", "hb"])
    return b.where("a <> b").select("field", F.least("a", "b").alias("key_a"), F.greatest("a", "b").alias("key_b")).distinct()
