"""Problem 9: evaluation texts leaking into training text.

A generalised suffix automaton of the normalised test items is built once; each
training document is streamed through it word by word, and the automaton state
tells at every word how long the longest passage of any test item is that ends
there, and which items hold it.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import spread
from .lookalike import fold

MIN_WORDS = 12
# An automaton has at most two states a word, which bounds what is broadcast at once; items beyond this many words are
# treated in several automata, whose spans are put together by document before anything is cut.
MAX_WORDS_AN_AUTOMATON = 250_000
_WORD = re.compile(r"[^\W_]+")


def words(text: str) -> list[str]:
    """Runs of letters and digits in lower case and one form."""
    return _WORD.findall(fold(text).casefold())


class SuffixAutomaton:
    """Of all suffixes of all items, over word ids.

    ``window[s]`` is the state of the last ``min_words`` words of a match that
    ends in state ``s``; ``items[s]`` are the items that hold the words of a
    window state.
    """

    def __init__(self, items: list[tuple[object, list[str]]], min_words: int = MIN_WORDS):
        self.min_words = min_words
        self.vocabulary: dict[str, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link = [-1]
        self.length = [0]
        coded = []
        for key, ws in items:
            ids = [self.vocabulary.setdefault(w, len(self.vocabulary)) for w in ws]
            coded.append((key, ids))
            last = 0
            for c in ids:
                last = self._extend(last, c)
        self.window = [0] * len(self.next)
        for s in sorted(range(1, len(self.next)), key=self.length.__getitem__):
            if self.length[s] >= min_words:
                up = self.link[s]
                self.window[s] = s if self.length[up] < min_words else self.window[up]
        self.items: dict[int, set] = {}
        for key, ids in coded:
            s = 0
            for n, c in enumerate(ids, 1):
                s = self.next[s][c]
                if n >= min_words:
                    self.items.setdefault(self.window[s], set()).add(key)

    def _new(self, length: int, nxt: dict[int, int], link: int) -> int:
        self.next.append(nxt)
        self.link.append(link)
        self.length.append(length)
        return len(self.next) - 1

    def _clone(self, p: int, c: int, q: int) -> int:
        q2 = self._new(self.length[p] + 1, dict(self.next[q]), self.link[q])
        self.link[q] = q2
        while p != -1 and self.next[p].get(c) == q:
            self.next[p][c] = q2
            p = self.link[p]
        return q2

    def _extend(self, last: int, c: int) -> int:
        q = self.next[last].get(c)
        if q is not None:  # the passage stands in an earlier item
            return q if self.length[q] == self.length[last] + 1 else self._clone(last, c, q)
        cur = self._new(self.length[last] + 1, {}, 0)
        p = last
        while p != -1 and c not in self.next[p]:
            self.next[p][c] = cur
            p = self.link[p]
        if p != -1:
            q = self.next[p][c]
            self.link[cur] = q if self.length[p] + 1 == self.length[q] else self._clone(p, c, q)
        return cur

    def matches(self, ws: list[str]) -> list[tuple[int, int, int]]:
        """``(end, length, window state)`` at every word where a passage of at least min_words words ends."""
        get, nxt, link, length, least, window = self.vocabulary.get, self.next, self.link, self.length, self.min_words, self.window
        out = []
        s = n = 0
        for end, c in enumerate(map(get, ws)):
            if c is None:
                s = n = 0
                continue
            to = nxt[s].get(c)
            while to is None and s:
                s = link[s]
                n = length[s]
                to = nxt[s].get(c)
            if to is None:
                continue
            s = to
            n += 1
            if n >= least:
                out.append((end, n, window[s]))
        return out


def spans_of(matches: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """Merged half-open word ranges covered by matches."""
    out: list[list[int]] = []
    for end, n, _ in matches:
        a, b = end - n + 1, end + 1
        while out and out[-1][1] >= a:
            a = min(a, out[-1][0])
            out.pop()
        out.append([a, b])
    return [(a, b) for a, b in out]


def cut_words(text: str, spans: list[tuple[int, int]]) -> str:
    """The text, in its one form, without the words of the spans and what stands between them."""
    text = fold(text)
    at = [m.span() for m in _WORD.finditer(text)]
    out, done = [], 0
    for a, b in spans:
        out.append(text[done : at[a][0]])
        done = at[b - 1][1]
    return "".join(out) + text[done:]


_SPANS = "doc_id long, h long, items array<bigint>, longest int, spans array<struct<a:int,b:int>>, n_words int"
_KIND = "doc_id long, item_id long, longest int, leaked_words int, n_words int, clean string"


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Ranges that overlap or touch put together, in order."""
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(b, out[-1][1])
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def _leaks_of(auto: SuffixAutomaton, text: str) -> tuple[list, int, list[tuple[int, int]], int] | None:
    """``(items, longest, spans, words)`` of a document, or None if it holds nothing."""
    ws = words(text)
    hits = auto.matches(ws) if len(ws) >= auto.min_words else []
    if not hits:
        return None
    return sorted(set().union(*(auto.items[w] for _, _, w in hits))), max(n for _, n, _ in hits), spans_of(hits), len(ws)


def _rows(doc, text: str, items: list, longest: int, spans: list[tuple[int, int]], n_words: int, cover_limit: float) -> list[tuple]:
    leaked = sum(b - a for a, b in spans)
    clean = "" if leaked >= cover_limit * n_words else cut_words(text, spans)
    return [(doc, item, longest, leaked, n_words, clean) for item in items]


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows)) or [()] * 6
    kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.string())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], ["doc_id", "item_id", "longest", "leaked_words", "n_words", "clean"])


def _stream(shared, cover_limit: float):
    """All there is to know of a document if there is one automaton."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                if (made := _leaks_of(shared.value, text)) is not None:
                    rows += _rows(doc, text, *made, cover_limit)
            yield _batch(rows)

    return run


def _stream_spans(shared):
    """What one of several automata knows of a document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc, h, text in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "h", "text"))):
                if (made := _leaks_of(shared.value, text)) is not None:
                    rows.append((doc, h, made[0], made[1], [{"a": a, "b": b} for a, b in made[2]], made[3]))
            cols = list(zip(*rows)) or [()] * 6
            kinds = (pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.int32(), pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())])), pa.int32())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], ["doc_id", "h", "items", "longest", "spans", "n_words"])

    return run


def _cut(cover_limit: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            for doc, text, items, longest, spans, n_words in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "items", "longest", "spans", "n_words"))):
                rows += _rows(doc, text, sorted(set(items)), longest, merged([(s["a"], s["b"]) for s in spans]), n_words, cover_limit)
            yield _batch(rows)

    return run


def automata(items: DataFrame, min_words: int) -> Iterator[SuffixAutomaton]:
    """Automata over the distinct items, each of at most about MAX_WORDS_AN_AUTOMATON words; one at a time on the driver."""
    held: list = []
    size = 0
    for r in items.select("item_id", "text").where("item_id is not null and text is not null").distinct().toLocalIterator():
        ws = words(r["text"])
        if held and size + len(ws) > MAX_WORDS_AN_AUTOMATON:
            yield SuffixAutomaton(held, min_words)
            held, size = [], 0
        held.append((r["item_id"], ws))
        size += len(ws)
    yield SuffixAutomaton(held, min_words)


def leaks(documents: DataFrame, items: DataFrame, min_words: int = MIN_WORDS, cover_limit: float = 0.8) -> DataFrame:
    """``doc_id, item_id, longest, leaked_words, n_words, clean``: one row per document and item it holds.

    ``clean`` is the document without the leaked spans of all items, empty when
    they cover ``cover_limit`` of its words. Null and empty texts and items hold
    nothing; items sent twice count once; ties between items that share a
    passage give a row for every item; documents sent twice give their rows twice.

    With one automaton documents are never shuffled. Several put the spans of a
    document together first, in a shuffle of leaking documents only.
    """
    spark = documents.sparkSession
    shared = [spark.sparkContext.broadcast(a) for a in automata(items, min_words)]
    docs = spread(documents.select("doc_id", "text").where("doc_id is not null and text is not null"))
    if len(shared) == 1:
        return docs.mapInArrow(_stream(shared[0], cover_limit), _KIND)
    hashed = docs.withColumn("h", F.xxhash64("text"))
    parts = None
    for one in shared:
        part = hashed.mapInArrow(_stream_spans(one), _SPANS)
        parts = part if parts is None else parts.unionByName(part)
    whole = parts.groupBy("doc_id", "h").agg(F.flatten(F.collect_set("items")).alias("items"), F.max("longest").alias("longest"), F.flatten(F.collect_set("spans")).alias("spans"), F.max("n_words").alias("n_words"))
    return hashed.join(whole, ["doc_id", "h"]).select("doc_id", "text", "items", "longest", "spans", "n_words").mapInArrow(_cut(cover_limit), _KIND)


def found(documents: DataFrame, items: DataFrame) -> DataFrame:
    return leaks(documents, items).select("doc_id", "item_id").distinct()
