"""Problem 10: keyword-stuffed and link-list pages.

A page divides into segments (list entries, links, sentences). A segment with
clause structure - articles, pronouns, conjunctions, auxiliaries - is prose. The
suffix automaton of the rest of the page tells how many of its characters are
covered by maximal substrings that repeat. A page is spam if more than half of
its words stand in segments that have no clause structure and repeat.

A page in which half of the words or more stand in prose segments cannot be
spam whatever repeats in it, so the automaton is built only for the others;
this bound is exact.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from ..session import spread
from .lookalike import fold

# Words that carry clause structure in English, Portuguese, Spanish and French.
CLAUSE_WORDS = frozenset(
    """
    the a an this that these those which who whose is are was were be been has have had will would can could may must it its they
    we our their and but if when while because since whenever than
    o a os as um uma uns umas este esta esse essa que quem cujo é são foi foram ser tem têm pode podem não se seu sua nós eles
    e mas quando enquanto porque como
    el la los las un una unos unas esto ese esa quien cuyo es son fue fueron ha han puede pueden no su sus nos y pero cuando
    mientras porque como lo
    le les une des ce cette qui dont est sont et mais lorsque
    """.split()
)
# Of these, one alone is not enough: they also join or introduce bare keywords.
WEAK = frozenset(("e", "y", "and", "et", "but", "no", "es", "se", "como", "when"))
# Characters of a repeated substring, at least: two short words or a long one.
LEAST = 8
REPEATED_SHARE = 0.5
SPAM_SHARE = 0.5
_LINK = re.compile(r"https?://\S+|www\.\S+")
_SPLIT = re.compile(r"\n+|(?<=[.!?;])\s+|\s*\|\s*")
_RUN = re.compile(r"[^\W_]+")
_TOKEN = re.compile(r"[^\W_]+(?:[-'’][^\W_]+)*")
_CAMEL = re.compile(r"(?<=[^\W\d_A-Z])(?=[A-Z])")
_MARKUP = re.compile(r"<[^>]*>|\]\([^)]*\)")


def repeated_cover(text: str, least: int = LEAST) -> bytearray:
    """Which characters of a text stand in a substring of at least ``least`` characters that occurs twice or more.

    The suffix automaton of the text: a state occurs more than once if another
    state's suffix link leads to it. At each position the longest repeated suffix
    that ends there is found on the links, and its whole length is covered.
    """
    nxt: list[dict[str, int]] = [{}]
    link, length, prefix = [-1], [0], []
    last = 0
    for c in text:
        cur = len(length)
        nxt.append({})
        length.append(length[last] + 1)
        link.append(0)
        prefix.append(cur)
        p = last
        while p >= 0 and c not in nxt[p]:
            nxt[p][c] = cur
            p = link[p]
        if p >= 0:
            q = nxt[p][c]
            if length[p] + 1 == length[q]:
                link[cur] = q
            else:
                clone = len(length)
                nxt.append(nxt[q].copy())
                length.append(length[p] + 1)
                link.append(link[q])
                link[q] = link[cur] = clone
                while p >= 0 and nxt[p].get(c) == q:
                    nxt[p][c] = clone
                    p = link[p]
        last = cur
    repeated = bytearray(len(link))
    for s in link[1:]:
        repeated[s] = 1
    n = len(text)
    covered = bytearray(n)
    reach = n  # what lies to the right of it is decided
    for i in range(n - 1, -1, -1):
        s = prefix[i]
        k = length[s] if repeated[s] else length[link[s]]
        if k >= least and i - k + 1 < reach:
            end = min(reach, i + 1)
            reach = i - k + 1
            covered[reach:end] = b"\x01" * (end - reach)
    return covered


def segments(text: str) -> list[str]:
    return [s for s in _SPLIT.split(text) if s]


def has_clause(tokens: list[str]) -> bool:
    """At least one clause word in about twelve; weak ones count half."""
    score = 0.0
    for w in tokens:
        if w in CLAUSE_WORDS:
            score += 0.5 if w in WEAK else 1.0
    return score >= max(1.0, len(tokens) / 14)


def measure(text: str, stop_early: bool = True) -> tuple[int, int, int]:
    """``(words, words of clause-less segments, words of clause-less segments that repeat)`` of a page.

    Links count word by word as text like any other, and hold no clause; rows of
    figures are data, not keywords.
    """
    total = loose = 0
    parts: list[tuple[int, str]] = []
    for s in segments(fold(text)):
        links = _LINK.findall(s) if "://" in s or "www." in s else []
        plain = _LINK.sub(" ", _MARKUP.sub(" ", s)) if links or "<" in s or "](" in s else s
        if "#" in plain:
            plain = _CAMEL.sub(" ", plain)
        tokens = _TOKEN.findall(plain.lower())
        linked = [w for u in links for w in _RUN.findall(u.lower())]
        n = len(tokens) + len(linked)
        if not n:
            continue
        total += n
        if links or not has_clause(tokens):
            loose += n
            data = not links and 3 * sum(t[0].isdigit() for t in tokens) > n
            parts.append((0 if data else n, " ".join(tokens + linked)))
    if stop_early and loose <= SPAM_SHARE * total:
        return total, loose, 0
    covered = repeated_cover("\n".join(p for _, p in parts) + "\n")
    at = spam = 0
    for n, part in parts:
        if sum(covered[at : at + len(part)]) >= REPEATED_SHARE * len(part):
            spam += n
        at += len(part) + 1
    return total, loose, spam


def _score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        made = [measure(t) for t in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array([m[k] for m in made], pa.int32()) for k in range(3))], ["doc_id", "n_words", "loose_words", "spam_words"])


def spam_scores(documents: DataFrame) -> DataFrame:
    """``doc_id, n_words, loose_words, spam_words`` of every document with a text.

    Nothing is shuffled. Null texts give no row, empty and blank texts a row of
    zeros. Repeated rows give repeated rows; other columns are not read.
    """
    return spread(documents.select("doc_id", "text").where("doc_id is not null and text is not null")).mapInArrow(_score, "doc_id long, n_words int, loose_words int, spam_words int")


def found(documents: DataFrame) -> DataFrame:
    return spam_scores(documents).where(f"spam_words > {SPAM_SHARE} * n_words").select("doc_id").distinct()
