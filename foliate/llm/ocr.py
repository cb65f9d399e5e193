"""Problem 5: noise in text from scanned pages.

Misread words: candidates for a word outside the corpus vocabulary come from an
inverted index of character q-grams over the vocabulary; a gradient-boosted
ranker, trained here on corrupted vocabulary words, accepts or rejects them.
Broken words, running headers and page numbers are decided on pairs of
neighbouring lines and blocks of a document in reading order.

The vocabulary holds the words that make up at least VOCABULARY_SHARE of all
words of the corpus, so it has at most 1 / VOCABULARY_SHARE entries whatever the
corpus: that bounds the broadcast.
"""

from __future__ import annotations

import json
import random
import re
from collections import Counter, defaultdict
from collections.abc import Callable, Container, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import checkpointed, spread
from .boosting import Boosted
from .lookalike import fold

VOCABULARY_SHARE = 1e-5
VOCABULARY_LEAST = 5
# A word is held to be a misreading of one that is so many times as frequent, for each confusion between them.
RATIO = 50
# Cost from which two words of letters are no readings of each other: an edit that is neither a confusion nor a speck costs
# as much. With a digit or sign in it one such edit and one confusion are allowed.
FAR, FAR_ODD = 1.0, 1.31
# Bound of the labelled sample the ranker is trained on.
SAMPLE = 6_000
# Blocks of one document held together; a longer document is treated in runs of this many blocks, each with so many
# blocks around it: a paragraph must end somewhere within these for the runs to give what the whole document gives.
RUN = 2_000
CONTEXT = 64
# Ids of documents of several runs that are broadcast, at most.
LONG_BROADCAST = 100_000
RUNNING_TEXT = ("body", "abstract", "list", "aside")
NO_LINES = ("title", "table", "code", "equation", "chart", "figure")

# What recognition takes letters for, as (seen, true). Pairs that are also endings of gender (a, o) are left out.
CONFUSIONS = [
    ("c", "e"), ("e", "c"), ("ii", "u"), ("cl", "d"), ("ri", "n"), ("rn", "m"), ("m", "in"), ("m", "rn"), ("m", "ni"), ("in", "m"),
    ("y", "v"), ("v", "y"), ("f", "t"), ("t", "f"), ("b", "h"), ("h", "b"), ("vv", "w"), ("l", "i"), ("i", "l"), ("l", "t"), ("t", "l"),
    ("q", "ç"), ("f", "tí"), ("n", "u"), ("u", "n"), ("li", "h"), ("lc", "k"), ("nn", "m"), ("g", "q"), ("j", "i"),
    ("0", "o"), ("1", "l"), ("1", "i"), ("!", "i"), ("!", "l"), ("|", "l"), ("|", "i"), ("@", "a"), ("6", "b"), ("9", "g"), ("5", "s"), ("8", "b"),
    ("3", "e"), ("4", "a"), ("7", "t"), ("2", "z"), ("5", "ã"), ("6", "é"), ("6", "ó"), ("$", "s"), ("(", "c"), ("<", "c"), ("[", "l"), ("]", "l"), ("€", "e"), ("£", "e"), ("&", "e"), ("{", "c"),
]
# Specks that recognition puts between letters.
SPECKS = "^~*|°'`¨_=+"
_CHEAP = {pair: 0.3 for pair in CONFUSIONS}
# Letters by what stays of them under every confusion; "I" is a run of strokes, and what is not named here stays as it is.
_STROKES = str.maketrans({**dict.fromkeys("iltfjnumrhbéóí1!|[]768", "I"), **dict.fromkeys("ce3€£&(<{", "c"), "d": "cI", "k": "Ic", **dict.fromkeys("yvw", "v"), **dict.fromkeys("qçg9", "q"), "0": "o", **dict.fromkeys("@4", "a"), **dict.fromkeys("5$ã", "s"), "2": "z", **dict.fromkeys(SPECKS.replace("|", ""), "")})
_REPEATED = re.compile(r"I{2,}|v{2,}")
_WORD = re.compile(r"[^\W\d_]+")
_SHAPE = re.compile(r"[^\W\d_][0-9!|@$€£&(^~*°<\[{+=]+[^\W\d_]|^[0-9!|@$€£<{]+[^\W\d_]{3}|[^\W\d_]{3}[!|@$€£&^~*°<{0-9][^\W\d_]*$")
_NOT_A_WORD = re.compile(r"://|www\.|@\w+\.\w|\.(?:com|org|net|example|test|pdf|html?)\b|^[\W\d_]*$|^\W*(?-i:[A-Z]{1,3})-?\d+\W*$", re.I)
_QUOTES = ".,;:?\"“”‘’…–—-"
_OUTER = ".,;:?\"“”‘’…–—-()[]"
# a hyphen at a line's end, or with a space after it and the rest of the word
_SOFT = "­"
_HYPHENS = "-\u00ad\u00ac\u2010\u2011"
_BREAK = re.compile(r"([^\W\d_]+)([-­¬‐‑])([ \t\r ]*\n\s*|[  ]+|$)([^\W\d_]*)")
# Words after a suspended hyphen, as in "short- and long-term".
_CONJUNCTIONS = frozenset("and or to und e ou y o u et a nor versus vs".split())
_NUMBER = r"(\d{1,4}|[ivxlc]{1,9})(?:\s*(?:/|of|de)\s*\d{1,4})?"
_PAGE = re.compile(rf"^(?:[-–—|•*·~]{{1,3}}\s*)?(?:(?:page|página|pagina|pág|pag|p)\b\.?\s*)?{_NUMBER}(?:\s*[-–—|•*·~]{{1,3}}|\s+\.)?$|^\[\s*{_NUMBER}\s*\]$|^\(\s*{_NUMBER}\s*\)$", re.I)
_LINE_NUMBER = re.compile(r"^\W*\d{1,4}\s{2,}|\s{2,}\d{1,4}\W*$|^\d{1,4}\s+|\s+\d{1,4}$")
_NAMES = re.compile(r"^[^\W\d_]{3,}(?:\s*(?:,|&|and|e|y|et)\s*[^\W\d_]{3,}){1,3}(?:\s+et al\.?)?$", re.I)


# ---- vocabulary -----------------------------------------------------------------------------


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        tokens: Counter = Counter()
        for text in batch.column("text").to_pylist():
            tokens.update(text.split())
        # each distinct token of the batch is taken apart once
        seen: Counter = Counter()
        for token, n in tokens.items():
            for word in _WORD.findall(fold(token).lower()):
                seen[word] += n
        yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())], ["word", "n"])


def word_counts(blocks: DataFrame) -> DataFrame:
    """``word, n`` over all texts; words are counted within Arrow batches before they are shuffled."""
    return spread(blocks.select("text").where("text is not null")).mapInArrow(_count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


# ---- misread words --------------------------------------------------------------------------


# Steps within the cost limit move at most so far from the diagonal: a speck costs 0.2.
_BAND = 13


def confusion_cost(seen: str, true: str, limit: float = 2.5) -> float:
    """Edit distance in which what recognition confuses is cheap; beyond ``limit`` it is not worked out.

    Only cells near the diagonal can stay within the limit, so words of any length take time in proportion to it.
    """
    n, m = len(seen), len(true)
    if abs(n - m) > 3:
        return limit + 1
    a = 0
    while a < n and a < m and seen[a] == true[a]:
        a += 1
    b = 0
    while b < n - a and b < m - a and seen[n - 1 - b] == true[m - 1 - b]:
        b += 1
    # one letter of context on either side, for confusions of two letters
    a, b = max(0, a - 1), max(0, b - 1)
    seen, true = seen[a : n - b], true[a : m - b]
    n, m = len(seen), len(true)
    far = limit + 1
    last = before = [far] * (m + 1)
    for i in range(n + 1):
        row = [far] * (m + 1)
        low, high = (0, m) if m <= _BAND else (max(0, i - _BAND), min(m, i + _BAND))
        for j in range(low, high + 1):
            if i == j == 0:
                row[0] = 0.0
                continue
            best = far
            if i:
                best = last[j] + (0.2 if seen[i - 1] in SPECKS else 1.0)
            if j:
                best = min(best, row[j - 1] + 1.0)
            if i and j:
                best = min(best, last[j - 1] + (0.0 if seen[i - 1] == true[j - 1] else _CHEAP.get((seen[i - 1], true[j - 1]), 1.0)))
            if i > 1 and j and (seen[i - 2 : i], true[j - 1]) in _CHEAP:
                best = min(best, before[j - 1] + 0.3)
            if i and j > 1 and (seen[i - 1], true[j - 2 : j]) in _CHEAP:
                best = min(best, last[j - 2] + 0.3)
            row[j] = best
        if i and min(row) > limit and min(last) > limit:
            return far
        before, last = last, row
    return min(far, last[m])


def _grams(word: str) -> set[str]:
    w = f"^{word}$"
    return {w[i : i + 3] for i in range(len(w) - 2)} | {w[:2], w[-2:]}


def skeleton(word: str) -> str:
    """What all readings of a word by confusions and specks alone have in common."""
    return _REPEATED.sub(lambda m: m.group()[0], word.translate(_STROKES))


def skeletons(word: str) -> set[str]:
    """Skeletons of what a word may have been read from.

    An upright bar is a letter or a speck; five of them cost more than FAR. One
    digit or sign may stand between letters for nothing at all, with one more at most beside it.
    """
    parts = word.split("|")
    if len(parts) > 5:
        return set()
    made = [parts[0]]
    for p in parts[1:]:
        made = [m + bar + p for m in made for bar in ("|", "")]
    odd = [i for i, c in enumerate(word) if not c.isalpha()]
    if len(odd) <= 2:
        made += [word[:i] + word[i + 1 :] for i in odd if i]
    return {skeleton(m) for m in made}


class Speller:
    """Decides whether a token is a misread word, and of which word."""

    def __init__(self, vocabulary: dict[str, int]):
        self.vocabulary = vocabulary
        self.words = sorted(vocabulary)
        self.grams = {w: _grams(w) for w in self.words if len(w) >= 3}
        index: dict[str, list[str]] = defaultdict(list)
        bones: dict[str, list[str]] = defaultdict(list)
        for w, grams in self.grams.items():
            for g in grams:
                index[g].append(w)
            bones[skeleton(w)].append(w)
        self.index, self.bones = dict(index), dict(bones)
        self.known: dict[str, str | None] = {}
        self.sound: set[str] = set()
        self.ranker: Boosted | None = None
        self.joiner = Joiner(vocabulary)
        # whether the corpus has words below the share; the counts of those near the token in hand
        self.rarer = False
        self.extra: dict[str, int] = {}

    def candidates(self, word: str, most: int) -> list[tuple[int, str]]:
        """The vocabulary words that share most q-grams: rows to train on, near misses among them."""
        shared: Counter = Counter()
        for g in _grams(word):
            shared.update(self.index.get(g, ()))
        near = [(n, v) for v, n in shared.items() if n >= max(2, len(word) - 4) and abs(len(v) - len(word)) <= 3]
        near.sort(key=lambda x: (-x[0] / (len(x[1]) + 3), x[1]))
        return near[:most]

    def near(self, word: str, others: Iterable[str] | None = None) -> list[tuple[int, float, str]]:
        """``(shared q-grams, cost, other word)`` of the vocabulary, or of ``others``, for all words that confusions and specks alone may have made this one of.

        Such words have a skeleton of this word; of them those stay that share
        enough q-grams, which costs least to see, and are near enough.
        """
        if others is None:
            others = {v for k in skeletons(word) for v in self.bones.get(k, ())}
        grams, least, out = _grams(word), max(2, len(word) - 4), []  # two confusions leave so many of the q-grams
        far = FAR if _WORD.fullmatch(word) else FAR_ODD
        for v in others:
            if abs(len(v) - len(word)) <= 3 and (n := len(grams & (self.grams.get(v) or _grams(v)))) >= least and (cost := confusion_cost(word, v, far)) < far:
                out.append((n, cost, v))
        return sorted(out, key=lambda x: (-x[0] / (len(x[2]) + 3), x[2]))

    def features(self, seen: str, true: str, shared: int, capital: bool) -> tuple:
        cost = confusion_cost(seen, true)
        short = min(len(seen), len(true))
        same = next((i for i in range(short) if seen[i] != true[i]), short)
        return (cost, cost / max(1, len(true)), float(len(true)), float(abs(len(seen) - len(true))), shared / (len(true) + 3), float(np.log10(1 + (self.vocabulary.get(true) or self.extra.get(true, 0)))), float(same == short), float(capital))

    def train(self, others: list[str], seed: int = 11) -> Speller:
        """Positives are vocabulary words corrupted by the confusions; negatives are words of the corpus that are
        rare or stand in the vocabulary themselves, with their nearest other vocabulary word."""
        self.joiner.train(others)
        rng = random.Random(seed)
        rows, labels = [], []
        pool = [w for w in self.words if len(w) >= 4]
        for _ in range(min(SAMPLE // 2, 4 * len(pool))):
            w = rng.choice(pool)
            places = [(i, s, t) for s, t in CONFUSIONS for i in range(len(w)) if w.startswith(t, i)]
            if not places:
                continue
            i, s, t = rng.choice(places)
            x = w[:i] + s + w[i + len(t) :] if rng.random() < 0.75 else w[: max(1, i)] + rng.choice(SPECKS) + w[max(1, i) :]
            if x in self.vocabulary:
                continue
            for n, v in self.candidates(x, 3):
                rows.append(self.features(x, v, n, rng.random() < 0.15))
                labels.append(float(v == w))
        wrong = [(w, False) for w in pool] + [(w, True) for w in others]
        rng.shuffle(wrong)
        for w, capital in wrong[: SAMPLE // 2]:
            for n, v in self.candidates(w, 3):
                if v != w:
                    f = self.features(w, v, n, capital)
                    # a rare word at the price of one confusion may itself be misread: no label
                    if not (capital and f[0] <= 0.3):
                        rows.append(f)
                        labels.append(0.0)
        if len(set(labels)) == 2:
            self.ranker = Boosted().fit(np.array(rows), np.array(labels))
        return self

    def any_misread(self, tokens: set[str]) -> bool:
        """Whether one of the tokens is misread; tokens found sound are remembered."""
        for token in tokens - self.sound:
            if self.correct(token) is not None:
                return True
            if len(self.sound) > 400_000:  # a cache, as below
                self.sound.clear()
            self.sound.add(token)
        return False

    def correct(self, token: str) -> str | None:
        """The word a token was misread from, "" if it cannot be told which, None if it is not misread."""
        try:
            return self.known[token]
        except KeyError:
            made = self._correct(token)
            if len(self.known) > 400_000:  # a cache, not a limit on what is decided
                self.known.clear()
            self.known[token] = made
            return made

    def judged(self, tokens: set[str]) -> tuple[bool, list[str]]:
        """Whether one of the tokens is misread whatever the rarer words are, else the tokens that these decide."""
        undecided = []
        for token in tokens - self.sound:
            core = token.strip(_OUTER)
            if core.lower() not in self.vocabulary and not _NOT_A_WORD.search(token):
                if core.isalpha() and len(core) >= 3:
                    undecided.append(token)
                    continue
                if self.correct(token) is not None:
                    return True, []
                if _SHAPE.search(core) or token.strip(_QUOTES)[:1] in tuple("([<{"):
                    undecided.append(token)
                    continue
            if len(self.sound) > 400_000:  # a cache, as below
                self.sound.clear()
            self.sound.add(token)
        return False, undecided

    def correct_among(self, token: str, rarer: dict[str, int]) -> str | None:
        """``correct`` with the rarer words near the token; below VOCABULARY_LEAST they only tell how often the token itself occurs."""
        self.extra = rarer
        try:
            return self._correct(token)
        finally:
            self.extra = {}

    def is_misreading(self, word: str, n: int) -> bool:
        """Whether a word of n occurrences is a confusion or more away from a word that is RATIO times as frequent for each."""
        for _, cost, v in self.near(word) + (self.near(word, self.extra) if self.extra else []):
            count = self.vocabulary.get(v) or self.extra.get(v, 0)
            if v != word and count >= RATIO * n and count >= RATIO ** round(cost / 0.3) * n:
                return True
        return False

    def _correct(self, token: str) -> str | None:
        core = token.strip(_OUTER)
        low = core.lower()
        if not core or low in self.vocabulary or _NOT_A_WORD.search(token):
            return None
        if self.extra.get(low, 0) >= VOCABULARY_LEAST and not (token.strip(_QUOTES)[:1] in tuple("([<{") and self._rank(token.strip(_QUOTES).lower(), core)) and not self.is_misreading(low, self.extra[low]):
            return None
        if any(p and p in self.vocabulary for p in re.split(r"[-/'’]", low)) and _WORD.sub("", low).strip("-/'’") == "":
            return None if len(re.split(r"[-/'’]", low)) > 1 else self._rank(low, core)
        loose = token.strip(_QUOTES).lower()
        if _SHAPE.search(core) or (loose[:1] in "([<{" and loose[:1] and len(loose) > 4 and loose[1:] not in self.vocabulary):
            got = self._rank(loose if loose[:1] in "([<{" else low, core)
            if got is None and loose != low:
                got = self._rank(low, core)
            if got is not None:
                return got
            letters = sum(c.isalpha() for c in core)
            inner = re.sub(r"[^\W\d_]", "", core)
            return "" if _SHAPE.search(core) and letters >= 4 and len(inner) <= 2 and letters >= 0.7 * len(core) and not re.search(r"[(\[<{&+=]", core) else None
        if not core.isalpha() or len(core) < 3:
            return None
        return self._rank(low, core)

    def _rank(self, low: str, core: str) -> str | None:
        capital = core[:1].isupper() and not core[1:2].isupper()
        best, top = None, 0.0
        rarer = [v for v, n in self.extra.items() if n >= VOCABULARY_LEAST and v != low]
        for n, _, v in self.near(low) + (self.near(low, rarer) if rarer else []):
            if v not in self.vocabulary and v not in rarer:  # dropped as a misreading itself
                continue
            # names differ by single letters: a capitalised one is misread only from one that is far more frequent
            if v in rarer and core[:1].isupper() and _WORD.fullmatch(low) and not self.extra[v] >= RATIO * max(1, self.extra.get(low, 1)):
                continue
            f = self.features(low, v, n, capital)
            s = self.ranker.score(f) if self.ranker else 1.0 - f[0]
            if s > top:
                best, top = v, s
        return best


# ---- lines and blocks of one document -------------------------------------------------------


class Joiner:
    """Classifier of line pairs: whether the end of one line and the start of the next are one broken word.

    Trained on pairs made from the corpus's own words: words broken at every
    place with every kind of hyphen, against suspended hyphens before
    conjunctions, dashes between whole words, and invisible hyphens that only stand there.
    """

    def __init__(self, vocabulary: dict[str, int]):
        self.vocabulary = vocabulary
        self.model: Boosted | None = None

    def features(self, left: str, hyphen: str, line: bool, right: str) -> tuple:
        v = self.vocabulary
        joined, l, r = fold(left + right).lower(), fold(left).lower(), fold(right).lower()
        return (float(joined in v), float(l in v), float(r in v), float(r in _CONJUNCTIONS), float(line), float(hyphen == _SOFT), float(right[:1].islower()), float(min(len(l), 9)), float(min(len(r), 9)))

    def train(self, others: list[str], seed: int = 5) -> Joiner:
        rng = random.Random(seed)
        words = [w for w in sorted(self.vocabulary) if len(w) >= 5]
        short = [w for w in sorted(self.vocabulary) if len(w) >= 2]
        names = [w for w in others if len(w) >= 6]
        if not words:
            return self
        rows, labels = [], []
        for _ in range(SAMPLE // 2):
            w = rng.choice(names).capitalize() if names and rng.random() < 0.25 else rng.choice(words)
            cut = rng.randrange(2, len(w) - 1)
            hyphen = rng.choice("-¬‐" + _SOFT)
            rows.append(self.features(w[:cut], hyphen, hyphen == _SOFT or rng.random() < 0.6, w[cut:]))
            labels.append(1.0)
        for _ in range(SAMPLE // 2):
            case, a, b = rng.random(), rng.choice(short), rng.choice(short)
            if case < 0.4:  # short- and long-term
                pair = (rng.choice([a, a[: rng.randrange(2, 6)]]), rng.choice("-‐"), rng.random() < 0.3, rng.choice(sorted(_CONJUNCTIONS)))
            elif case < 0.7:  # an invisible hyphen between words
                pair = (rng.choice([a, rng.choice(names or words)]), _SOFT, rng.random() < 0.3, rng.choice([b, b.capitalize()]))
            else:  # a dash set without a space
                pair = (a, "-", False, rng.choice([b, b.capitalize()]))
            if fold(pair[0] + pair[3]).lower() not in self.vocabulary:
                rows.append(self.features(*pair))
                labels.append(0.0)
        self.model = Boosted(rounds=60).fit(np.array(rows), np.array(labels))
        return self

    def joins(self, left: str, hyphen: str, line: bool, right: str) -> bool:
        return self.model is None or self.model.score(self.features(left, hyphen, line, right)) > 0


def broken_words(text: str, following: str, joiner: Joiner) -> list[tuple[int, int, str]]:
    """``(start, end, joined word)`` of every word broken at a line's end, at the block's end, or where the line break became a space.

    The classifier decides between a line and the next; a hyphen at the block's
    end or before a line of other matter is a break, an invisible one only if the text goes on in lower case.
    """
    out = []
    for m in _BREAK.finditer(text):
        left, hyphen, gap, right = m.groups()
        if (not gap or not right and "\n" not in gap) and m.end() < len(text):
            continue
        if not right and m.end() == len(text):
            more = _WORD.match(following.lstrip())
            if hyphen != _SOFT or more and more.group()[0].islower():
                out.append((m.start(1), m.end(), left))
        elif not right or joiner.joins(left, hyphen, "\n" in gap, right):
            out.append((m.start(1), m.end(), left + right))
    return out


def _header_key(line: str) -> str:
    return "".join(_WORD.findall(line.lower()))


def _is_named(bare: str, words: list[str], named: set[str], known: Container[str]) -> bool:
    """Whether a line names the title or the authors: half of its words, or a list of names with one of them."""
    told = sum(w in named for w in words)
    return told * 2 >= len(words) or bool(_NAMES.match(bare)) and (told > 0 or len(words) <= 4) and not all(w in known for w in words)


def _commonest(counts: Counter) -> int | None:
    """The offset that occurs most often, the smallest of several."""
    return min(counts, key=lambda x: (-counts[x], x), default=None)


class Facts:
    """What a document's noise is decided by besides the lines themselves: words of its title and authors, header lines
    on two pages or more, and how printed page numbers differ from the page's place.

    Made of all blocks of the document: for one that is cut into runs, by ``long_facts``.
    """

    def __init__(self, headers: dict[str, str], offsets: Counter, alone: Counter):
        self.headers, self.offsets, self.alone = headers, offsets, alone
        # one word of each header, to pass over other lines quickly
        self.marks = [max(_WORD.findall(h.lower()), key=len) for h in headers.values()]


def named_words(role: str | None, page: int | None, folded: str) -> list[str]:
    """Words that name the document, of a title or of a list of authors on the first page."""
    if role == "title" or role == "metadata" and ";" in folded and (page or 0) == 0:
        return [w for w in _WORD.findall(folded.lower()) if len(w) > 2]
    return []


def header_lines(role: str | None, folded: str) -> Iterator[tuple[str, str]]:
    """``(key, line)`` of the lines of a block that have the shape of a running header."""
    if role in NO_LINES:
        return
    for line in folded.split("\n"):
        # most lines of running text go here: they start in lower case or end a sentence
        if not 8 <= len(line) <= 110 or line[0].islower() or line[-1] in ".,;:?!":
            continue
        bare = _LINE_NUMBER.sub("", line.strip()).strip()
        words = _WORD.findall(bare.lower())
        if 2 <= len(words) <= 11 and bare[-1:] not in ".!?:" and bare[:1].isupper():
            yield "".join(words), bare


def page_numbers(role: str | None, folded: str) -> Iterator[tuple[int, int | None, bool, bool]]:
    """``(line, number if in digits, whether it stands bare among other lines, whether within them)`` of the lines that hold only a page number."""
    if role in NO_LINES:
        return
    lines = folded.split("\n")
    for i, line in enumerate(lines):
        s = line.strip()
        if s and len(s) <= 24 and (m := _PAGE.match(s)) and ((number := m[m.lastindex]).isdigit() or len(lines) == 1 or i in (0, len(lines) - 1)):
            yield i, int(number) if number.isdigit() else None, number == s and s.isdigit() and len(lines) > 1, 0 < i < len(lines) - 1


class Document:
    """Blocks of one document, or of one run of it with what stands around it, in reading order: ``(block_id, page, role, text, own)``."""

    def __init__(self, blocks: list[tuple], speller: Speller, facts: Facts | None = None):
        self.speller = speller
        self.blocks = [(*b[:4], b[4] if len(b) > 4 else True) for b in blocks]
        self.folded = [fold(b[3]) for b in blocks]
        self.facts = facts or self._facts()
        self.headers, self.marks = self.facts.headers, self.facts.marks
        # whether a block ends in a letter and a hyphen
        self.broken = [len(t := b[3].rstrip()) > 1 and t[-1] in _HYPHENS and bool(_WORD.match(t[-2])) for b in blocks]
        # (block, token) that words below the vocabulary's share decide
        self.undecided: list[tuple[str, str]] = []
        # place of the next block of the same role
        self.next_of_role: list[int | None] = [None] * len(blocks)
        seen: dict[str | None, int] = {}
        for k in range(len(blocks) - 1, -1, -1):
            self.next_of_role[k] = seen.get(blocks[k][2])
            seen[blocks[k][2]] = k

    def _facts(self) -> Facts:
        named: set[str] = set()
        titled = False
        for (_, page, role, _, _), text in zip(self.blocks, self.folded):
            if role != "title" or not titled:
                named.update(named_words(role, page, text))
                titled = titled or role == "title"
        pages: dict[str, set] = defaultdict(set)
        shown: dict[str, str] = {}
        offsets, alone = Counter(), Counter()
        for (_, page, role, _, _), text in zip(self.blocks, self.folded):
            for key, bare in header_lines(role, text):
                pages[key].add(page)
                shown.setdefault(key, bare)
            for _, number, bare, _ in page_numbers(role, text):
                if number is not None and page is not None:
                    (alone if bare else offsets)[number - page] += 1
        known = self.speller.vocabulary
        return Facts({k: shown[k] for k, p in pages.items() if len(p - {None}) >= 2 and _is_named(shown[k], _WORD.findall(shown[k].lower()), named, known)}, offsets, alone)

    def noise(self) -> Iterator[tuple[str, str]]:
        """Distinct ``(block_id, kind of noise)`` of the own blocks."""
        offsets, alone = self.facts.offsets, self.facts.alone
        common = _commonest(offsets + alone)
        for k, ((block, page, role, text, own), folded) in enumerate(zip(self.blocks, self.folded)):
            if not own:
                continue
            kinds = set()
            lines = folded.split("\n")
            furniture = set()
            for i, number, bare, inside in page_numbers(role, folded):
                furniture.add(i)
                # a figure alone in a line of running text may end a sentence: decided by the numbers of the other pages
                if not bare or page is not None and number - page == common and (not inside or offsets or alone[common] > 1):
                    kinds.add("page_number")
            if role not in NO_LINES and self.headers:
                for i, line in enumerate(lines):
                    s = line.strip()
                    if i not in furniture and s and len(s) <= 110 and self._names_header(s):
                        furniture.add(i)
                        kinds.add("running_header")
                if "running_header" not in kinds and any(h in folded for h in self.headers.values()):
                    kinds.add("running_header")
            if role not in NO_LINES and any(h in text for h in _HYPHENS):
                after = self.next_of_role[k]
                broken = broken_words(text, "" if after is None else self.folded[after], self.speller.joiner)
                if broken:
                    kinds.add("hyphenation")
                    parts, at = [], 0
                    for a, b, joined in broken:
                        # a word that goes on in another block is not looked at
                        parts += [text[at:a], joined if b < len(text) else "", "\n"]
                        at = b
                    text = "".join(parts) + text[at:]
                    folded = fold(text)
                    lines = folded.split("\n")
                    furniture = {i for i, x in enumerate(lines) if self._is_furniture(x)}
            if role is None or role in RUNNING_TEXT:
                tokens = set()
                for i, line in enumerate(lines):
                    if i not in furniture:
                        tokens.update(line.split())
                first = lines[0].split()[:1] if k and self._broken_end(k - 1) else []
                if self.speller.rarer:
                    misread, undecided = self.speller.judged(tokens.difference(first))
                    self.undecided += [(block, t) for t in undecided]
                else:
                    misread = self.speller.any_misread(tokens.difference(first))
                if misread:
                    kinds.add("misread")
            for kind in kinds:
                yield block, kind

    def _broken_end(self, k: int) -> bool:
        """Whether one of the blocks just before ends within a word."""
        return any(self.broken[max(0, k - 3) : k + 1])

    def _is_furniture(self, line: str) -> bool:
        s = line.strip()
        return bool(s) and (len(s) <= 24 and bool(_PAGE.match(s)) or bool(self.headers) and self._names_header(s))

    def _names_header(self, line: str) -> bool:
        low = line.lower()
        return any(w in low for w in self.marks) and _header_key(_LINE_NUMBER.sub("", line)) in self.headers

    def paragraphs(self) -> Iterator[str]:
        """Continuous text: furniture dropped, broken words joined, misread words replaced, lines joined across pages.

        A paragraph belongs to the run in which it begins.
        """
        held, mine = "", True
        for _, _, role, text, own in self.blocks:
            if role not in ("body", "abstract", "list", None):
                continue
            lines = [x for x in text.split("\n") if not self._is_furniture(fold(x))]
            clean = "\n".join(lines)
            if not clean.strip():
                continue
            joined = f"{held}\n{clean}" if held else clean
            mine = mine if held else own
            parts, at = [], 0
            for a, b, word in broken_words(joined, "", self.speller.joiner):
                if b < len(joined):
                    parts += [joined[at:a], word, " "]
                    at = b
            whole = fold(" ".join(("".join(parts) + joined[at:]).split()))
            if whole[-1:] in "-¬" or (whole[-1:] not in ".!?:;)\"”" and len(whole) > 40):
                held = whole
                continue
            if mine:
                yield self._respelled(whole)
            held = ""
        if held and mine:
            yield self._respelled(held)

    def _respelled(self, text: str) -> str:
        # words below the vocabulary's share are looked up for all paragraphs at once, later
        return text if self.speller.rarer else respelled(text, self.speller.correct)


def respelled(text: str, correct: Callable[[str], str | None]) -> str:
    out = []
    for token in text.split(" "):
        right = correct(token)
        if right:
            core = token.strip(_OUTER)
            right = right.capitalize() if core[:1].isupper() else right
            token = token.replace(core, right, 1)
        out.append(token)
    return " ".join(out)


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, list[tuple], dict | None]]:
    """Documents of a partition sorted by document, run and reading order, with the facts of long ones; rows sent twice are dropped."""
    held, rows, seen, facts = None, [], set(), None
    for batch in batches:
        for doc, run, own, block, page, role, text in zip(*(batch.column(c).to_pylist() for c in ("document_id", "run", "own", "block_id", "page", "role", "text"))):
            if (doc, run) != held:
                if any(r[4] for r in rows):
                    yield held, rows, facts
                held, rows, seen, facts = (doc, run), [], set(), None
            if block is None:
                facts = json.loads(text)
            elif block not in seen:
                seen.add(block)
                rows.append((block, page, role, text, own))
    if any(r[4] for r in rows):
        yield held, rows, facts


def _document(rows: list[tuple], speller: Speller, facts: dict | None) -> Document:
    return Document(rows, speller, facts and Facts(dict(facts["headers"]), Counter(dict(facts["offsets"])), Counter(dict(facts["alone"]))))


def _noise(shared):
    def run(batches):
        out: list[tuple[str, str | None, str | None]] = []

        def batch():
            return pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*out)], ["block_id", "noise", "token"])

        for _, rows, facts in _runs(batches):
            document = _document(rows, shared.value, facts)
            out += [(b, k, None) for b, k in document.noise()]
            out += [(b, None, t) for b, t in document.undecided]
            if len(out) > 5_000:
                yield batch()
                out = []
        if out:
            yield batch()

    return run


# ---- words below the vocabulary's share -----------------------------------------------------


def _mapped(rows: Callable, kinds: list[tuple[str, pa.DataType]]):
    """A function of Arrow batches from one that gives rows for the columns of a row."""

    def run(batches):
        for batch in batches:
            made = [r for x in zip(*(c.to_pylist() for c in batch.columns)) for r in rows(*x)]
            cols = list(zip(*made)) or [()] * len(kinds)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(cols, kinds)], [n for n, _ in kinds])

    return run


def _forms(token: str) -> set[str]:
    """What a token is looked up by: with and without the brackets before it."""
    return {token.strip(_OUTER).lower(), token.strip(_QUOTES).lower()}


def _token_keys(token: str) -> list[tuple[str, str]]:
    """Keys under which a token meets the words it may have been read from (f; F for capitalised names, which only far more frequent ones are) and its own count (w)."""
    keys, kind = set(), "F" if token.strip(_OUTER)[:1].isupper() else "f"
    for form in _forms(token):
        if _WORD.fullmatch(form):
            keys |= {kind + skeleton(form), "w" + form}
        else:
            keys |= {"f" + k for k in skeletons(form)}
    return [(token, k) for k in keys]


def _word_keys(word: str, n: int) -> list[tuple[str, str, int]]:
    return [(k + skeleton(word), word, n) for k in ("f", "F")[: 1 + (n >= RATIO)]]


def _is_near(token: str, word: str, n: int, speller: Speller) -> list[tuple[str, str, int]]:
    return [(token, word, n)] if any(f == word or speller.near(f, (word,)) for f in _forms(token)) else []


def verdicts(tokens: DataFrame, counts: DataFrame, shared) -> DataFrame:
    """``token, right`` of the distinct tokens that are misread, given all words of the corpus and not only those of the broadcast vocabulary.

    An inverted join by skeletons, which no pair of words within the cost misses; both sides stay distributed.
    """
    text, number = pa.string(), pa.int64()
    distinct = tokens.select("token").distinct()
    keys = distinct.mapInArrow(_mapped(_token_keys, [("token", text), ("key", text)]), "token string, key string")
    words = counts.where((F.length("word") >= 3) & (F.col("n") < shared.value.share))
    real = words.where(F.col("n") >= VOCABULARY_LEAST).select("word", "n").mapInArrow(_mapped(lambda w, n: [] if shared.value.is_misreading(w, n) else _word_keys(w, n), [("key", text), ("word", text), ("n", number)]), "key string, word string, n long")
    own = words.select(F.concat(F.lit("w"), "word").alias("key"), "word", "n")
    pairs = keys.join(real.unionByName(own), "key").select("token", "word", "n")
    near = pairs.distinct().mapInArrow(_mapped(lambda t, w, n: _is_near(t, w, n, shared.value), [("token", text), ("word", text), ("n", number)]), "token string, word string, n long")
    lists = near.groupBy("token").agg(F.sort_array(F.collect_set(F.struct("word", "n"))).alias("near"))

    def judge(token, near):
        right = shared.value.correct_among(token, {x["word"]: x["n"] for x in near or ()})
        return [] if right is None else [(token, right)]

    return distinct.join(lists, "token", "left").select("token", "near").mapInArrow(_mapped(judge, [("token", text), ("right", text)]), "token string, right string")


def _repair(shared):
    def run(batches):
        for (doc, part), rows, facts in _runs(batches):
            made = list(_document(rows, shared.value, facts).paragraphs())
            yield pa.RecordBatch.from_arrays([pa.array([doc] * len(made), pa.string()), pa.array([part] * len(made), pa.int32()), pa.array(range(len(made)), pa.int32()), pa.array(made, pa.string())], ["document_id", "part", "paragraph", "text"])

    return run


def fit_speller(blocks: DataFrame) -> tuple[Speller, DataFrame]:
    """The speller and the counts of all words it was made from; the vocabulary and a bounded sample of rare words come to the driver."""
    counts = checkpointed(word_counts(blocks))
    total = counts.agg(F.sum("n")).first()[0] or 0
    least = max(VOCABULARY_LEAST, total * VOCABULARY_SHARE)
    vocabulary = {r["word"]: r["n"] for r in counts.where(F.col("n") >= least).collect()}
    others = counts.where((F.col("n") < least) & (F.length("word") >= 4))
    # every n-th of the rare words by hash: about SAMPLE of them reach the driver, whatever their number
    every = max(1, others.count() // SAMPLE)
    rare = sorted(r["word"] for r in others.where(F.pmod(F.xxhash64("word"), F.lit(every)) == 0).select("word").collect())
    speller = Speller(vocabulary).train(rare)
    # at the scale of the corpus, frequent misreadings of very frequent words pass the share: they are dropped again
    misreadings = [w for w in vocabulary if len(w) >= 3 and any(v != w and vocabulary[v] >= 200 * vocabulary[w] and cost <= 0.3 for _, cost, v in speller.near(w))]
    for w in misreadings:
        del vocabulary[w]
    speller.known.clear()
    speller.sound.clear()
    speller.share = least
    speller.rarer = least > VOCABULARY_LEAST
    return speller, counts


def _placed(blocks: DataFrame) -> DataFrame:
    """``document_id, o, block_id, page, role, text`` of the blocks with text; a block without a document is one of its own, a page missing in the row is taken from the block's id."""
    page = F.coalesce(F.col("page"), F.regexp_extract("block_id", ":p(\\d{4}):", 1).try_cast("int"))
    rows = blocks.where("block_id is not null and text is not null")
    return rows.select(F.coalesce("document_id", F.concat(F.lit("\0"), "block_id")).alias("document_id"), F.coalesce("reading_order", F.lit(0)).alias("o"), "block_id", page.alias("page"), "role", "text")


def _facts_of_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``document_id, kind, key, page, o, text`` of all that the facts of a long document are made from."""
    for batch in batches:
        rows = []
        for doc, o, page, role, text in zip(*(batch.column(c).to_pylist() for c in ("document_id", "o", "page", "role", "text"))):
            folded = fold(text)
            for w in set(named_words(role, page, folded)):
                rows.append((doc, "title" if role == "title" else "author", w, page, o, None))
            rows += [(doc, "line", key, page, o, bare) for key, bare in header_lines(role, folded)]
            rows += [(doc, "alone" if bare else "offset", str(number - page), page, o, None) for _, number, bare, _ in page_numbers(role, folded) if number is not None and page is not None]
        cols = list(zip(*rows)) or [()] * 6
        kinds = (pa.string(), pa.string(), pa.string(), pa.int32(), pa.int32(), pa.string())
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], ["document_id", "kind", "key", "page", "o", "text"])


def long_facts(blocks: DataFrame, shared) -> DataFrame | None:
    """``document_id, last, facts`` of the documents of more than one run, None if there are none.

    Counted over all blocks of a document with map-side combining: no document is gathered. The ids of the long
    documents, counted first, are broadcast up to LONG_BROADCAST and joined in a shuffle beyond.
    """
    last = blocks.where("document_id is not null").groupBy("document_id").agg(F.max("reading_order").alias("last")).where(F.col("last") >= RUN)
    long = checkpointed(last)
    n = long.count()
    if not n:
        return None
    ids = long.select("document_id")
    made = checkpointed(_placed(blocks).join(F.broadcast(ids) if n <= LONG_BROADCAST else ids, "document_id", "left_semi").mapInArrow(_facts_of_blocks, "document_id string, kind string, key string, page int, o int, text string"))
    first = made.where("kind = 'title'").groupBy("document_id").agg(F.min("o").alias("o"))
    named = made.where("kind = 'title'").join(first, ["document_id", "o"]).unionByName(made.where("kind = 'author'")).groupBy("document_id").agg(F.collect_set("key").alias("named"))
    lines = made.where("kind = 'line'").groupBy("document_id", "key").agg(F.countDistinct("page").alias("pages"), F.min_by("text", "o").alias("text")).where("pages >= 2").join(named, "document_id", "left")

    def real(doc, key, text, words):
        return [(doc, key, text)] if _is_named(text, _WORD.findall(text.lower()), set(words or ()), shared.value.vocabulary) else []

    text = pa.string()
    headers = lines.select("document_id", "key", "text", "named").mapInArrow(_mapped(real, [("document_id", text), ("key", text), ("text", text)]), "document_id string, key string, text string")
    headers = headers.groupBy("document_id").agg(F.collect_list(F.array("key", "text")).alias("headers"))
    offsets = made.where("kind in ('alone', 'offset')").groupBy("document_id", "kind", "key").count()
    pair = F.struct(F.col("key").cast("int").alias("a"), F.col("count").alias("n"))
    numbers = offsets.groupBy("document_id").agg(F.collect_list(F.when(F.col("kind") == "offset", pair)).alias("offsets"), F.collect_list(F.when(F.col("kind") == "alone", pair)).alias("alone"))
    whole = long.join(headers, "document_id", "left").join(numbers, "document_id", "left")

    def packed(doc, last, headers, offsets, alone):
        return [(doc, last, json.dumps({"headers": headers or [], "offsets": [[x["a"], x["n"]] for x in offsets or ()], "alone": [[x["a"], x["n"]] for x in alone or ()]}))]

    return whole.select("document_id", "last", "headers", "offsets", "alone").mapInArrow(_mapped(packed, [("document_id", text), ("last", pa.int32()), ("facts", text)]), "document_id string, last int, facts string")


def in_reading_order(blocks: DataFrame, shared) -> DataFrame:
    """Blocks with text, sorted within partitions; one shuffle by document and run of RUN blocks.

    A document that holds a third of all rows spreads over its runs. Each run has the CONTEXT blocks before and after it,
    not its own, and the facts of its whole document, so that what is decided does not depend on where it is cut.
    """
    rows = _placed(blocks)
    run = lambda o: F.greatest(F.lit(0), F.floor(o / RUN)).cast("int")
    rows = rows.withColumn("run", F.explode(F.sequence(run(F.col("o") - CONTEXT), run(F.col("o") + CONTEXT)))).withColumn("own", run(F.col("o")) == F.col("run"))
    facts = long_facts(blocks, shared)
    if facts is not None:
        each = facts.withColumn("run", F.explode(F.sequence(F.lit(0), F.floor(F.col("last") / RUN).cast("int"))))
        rows = rows.unionByName(each.select("document_id", F.lit(-(2**31)).cast("int").alias("o"), F.lit(None).cast("string").alias("block_id"), F.lit(None).cast("int").alias("page"), F.lit(None).cast("string").alias("role"), F.col("facts").alias("text"), "run", F.lit(False).alias("own")))
    return rows.repartition("document_id", "run").sortWithinPartitions("document_id", "run", "o", "block_id").drop("o")


def noise(blocks: DataFrame) -> DataFrame:
    """``block_id, noise``: the kinds of scanning noise of each block, distinct.

    Null and empty texts have none; a block without a document is a document of
    its own; equal reading orders fall back to the block id.
    """
    speller, counts = fit_speller(blocks)
    shared = blocks.sparkSession.sparkContext.broadcast(speller)
    made = in_reading_order(blocks, shared).mapInArrow(_noise(shared), "block_id string, noise string, token string")
    if not speller.rarer:
        return made.select("block_id", "noise")
    made = checkpointed(made)
    open_ = made.where("token is not null")
    misread = open_.join(verdicts(open_, counts, shared), "token").select("block_id", F.lit("misread").alias("noise"))
    return made.where("noise is not null").select("block_id", "noise").unionByName(misread).distinct()


def found(blocks: DataFrame) -> DataFrame:
    return noise(blocks).distinct()


def paragraphs(blocks: DataFrame) -> DataFrame:
    """``document_id, part, paragraph, text``: continuous repaired paragraphs in reading order."""
    speller, counts = fit_speller(blocks)
    shared = blocks.sparkSession.sparkContext.broadcast(speller)
    columns = "document_id string, part int, paragraph int, text string"
    made = in_reading_order(blocks, shared).mapInArrow(_repair(shared), columns)
    if not speller.rarer:
        return made
    made, at = checkpointed(made), ["document_id", "part", "paragraph"]
    kinds = [("document_id", pa.string()), ("part", pa.int32()), ("paragraph", pa.int32())]
    one = lambda d, p, k, text: [(d, p, k, t) for t in set(text.split(" ")) if shared.value.judged({t})[1]]
    open_ = made.mapInArrow(_mapped(one, [*kinds, ("token", pa.string())]), "document_id string, part int, paragraph int, token string")
    lists = open_.join(verdicts(open_, counts, shared), "token").groupBy(*at).agg(F.collect_list(F.struct("token", "right")).alias("rights"))

    def respell(d, p, k, text, rights):
        known = {x["token"]: x["right"] for x in rights or ()}
        return [(d, p, k, respelled(text, lambda t: known.get(t) if shared.value.judged({t})[1] else shared.value.correct(t)))]

    return made.join(lists, at, "left").select(*at, "text", "rights").mapInArrow(_mapped(respell, [*kinds, ("text", pa.string())]), columns)
