"""Toxicity: disguised words are restored by Viterbi decoding, then the text is scored."""

from __future__ import annotations

import re
import unicodedata
from array import array
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from tillstream.llm.common import kept_safe, or_empty, settled, ship, unused, without
from tillstream.llm.transducer import settle

TRAIN_DOCS = 20_000  # labelled documents the classifier is fitted on, at most
MAX_FEATURES = 4096
MIN_TOXIC = 5
MIN_PRECISION = 0.8
CLEAR = 0.99
TOGETHER = 0.85
MAX_BASE = 0.49  # a text without any feature is never judged toxic
PIECE = 3  # characters of a short piece, at most
CACHED = 40  # characters of a word, or of a run of pieces, that is remembered
CACHE_WORDS = 100_000
SPAN_CHARS = 1 << 20
SCAN_CHARS = 1 << 18  # texts are scanned for what may bear a feature in runs of so many

# What a written character may stand for.
STANDS_FOR = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t",
    "8": "b", "9": "g", "@": "a", "$": "s", "!": "il", "+": "t", "|": "il", "(": "c",
    "€": "e", "£": "l", "¡": "i", "*": "aeiou", "#": "aeiou",
}
DROPPED = "*.-_~^'`,:;/\\=#%&\"​‌‍­"

SYMBOLS = 64
BOUNDARY, BREAK = 0, SYMBOLS - 1
COST_SUBSTITUTE, COST_DROP, COST_DROP_SIGN, COST_REPEAT, COST_ODD = 0.7, 0.5, 7.0, 0.6, 6.0
COST_BORDER = 3.0  # a word that begins where no sign or blank is

_WORDY = re.compile(r"[^\W\d_](?:.*[^\W\d_])?", re.DOTALL).search
_CORE = "".join(re.escape(c) for c in STANDS_FOR)
_EDGES = re.compile(rf"^[^\w{_CORE}]+|[^\w{_CORE}]+$")
_RUN = re.compile(r"(.)\1\1")
_LONG = re.compile(rf"(?<!\S)\S{{{3 * PIECE + 1},}}")  # words that are no short pieces
_SIGNS = "!,.:;?*#%&$|+()@"  # around a plain word they say nothing

# What a code point is to the scan (see ``kinds_of``); WILD: what stands for a letter sought.
LETTER, BLANK, MARK, SIGN, DIGIT, STRANGE, EDGE, WILD = (1 << n for n in range(8))


def symbols_of() -> np.ndarray:
    """Language-model symbol of every code point: 0 white space, a-z, other letters
    folded into the numbers up to 62, 63 for what is no letter."""
    table = np.full(0x110000, BREAK, dtype=np.uint8)
    for code in range(0x3000):
        if chr(code).isalpha():
            table[code] = 27 + code % (BREAK - 27)
    high = np.arange(0x3000, 0x110000)
    table[high] = 27 + high % (BREAK - 27)
    table[ord("a") : ord("z") + 1] = np.arange(1, 27)
    for code in (9, 10, 11, 12, 13, 32):
        table[code] = BOUNDARY
    return table


def _symbols(text: str, table: np.ndarray) -> np.ndarray:
    points = np.frombuffer(text.encode("utf-32-le", "replace"), dtype=np.uint32)
    return table[np.minimum(points, 0x10FFFF)].astype(np.int64)


def trigram_counts(docs: DataFrame, text: Column) -> DataFrame:
    """(trigram, n): how often each three symbols follow each other in all texts."""
    table = symbols_of()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        settle()
        total = np.zeros(SYMBOLS**3, dtype=np.int64)

        def add(texts: list[str]) -> None:
            s = _symbols(" " + " \0 ".join(texts).lower() + " ", table)
            clean = (s[:-2] != BREAK) & (s[1:-1] != BREAK) & (s[2:] != BREAK)
            code = (s[:-2] * SYMBOLS + s[1:-1]) * SYMBOLS + s[2:]
            np.add(total, np.bincount(code[clean], minlength=SYMBOLS**3), out=total)

        for batch in batches:
            some, held = [], 0
            for value in batch.column(0):
                some.append(value.as_py())
                held += len(some[-1])
                if held > SPAN_CHARS:
                    add(some)
                    some, held = [], 0
            if some:
                add(some)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(seen, pa.int64()), pa.array(total[seen], pa.int64())], ["trigram", "n"]
        )

    parts = docs.select(or_empty(text).alias("text")).mapInArrow(settled(run), "trigram long, n long")
    return parts.groupBy("trigram").agg(F.sum("n").alias("n"))


@dataclass
class Language:
    """Costs (negative logarithms) of each symbol after the two before it."""

    costs: np.ndarray
    table: np.ndarray = field(default_factory=symbols_of)

    @staticmethod
    def fitted(trigram: np.ndarray, n: np.ndarray) -> Language:
        counts = np.zeros(SYMBOLS**3)
        counts[trigram] = n
        three = counts.reshape(SYMBOLS, SYMBOLS, SYMBOLS)
        two, one = three.sum(0), three.sum((0, 1)) + 1.0
        backing = (two + 2.0 * one / one.sum()) / (two.sum(1, keepdims=True) + 2.0)
        chance = (three + 5.0 * backing) / (three.sum(2, keepdims=True) + 5.0)
        return Language(-np.log(chance).astype(np.float32))

    def __getstate__(self) -> dict:
        return {"costs": self.costs, "table": self.table}

    def _flat(self) -> array:
        flat = self.__dict__.get("flat")
        if flat is None:
            flat = self.__dict__["flat"] = array("f", self.costs.tobytes())
        return flat

    def restored(self, word: str) -> str:
        """The likeliest spelling behind a disguised word or passage: Viterbi over the
        lattice of what each character, or run of equal ones, may stand for, the blank
        between two words among it; a state is the last two symbols."""
        costs, table = self._flat(), self.table
        symbols: dict[str, list[int]] = {}
        best: dict[int, tuple[float, tuple | None]] = {BOUNDARY * SYMBOLS + BOUNDARY: (0.0, None)}
        for options in _lattice(word):
            steps = []
            for letters, price in options:
                spelt = symbols.get(letters)
                if spelt is None:
                    spelt = symbols[letters] = [int(table[ord(c)]) for c in letters]
                steps.append((letters, price, spelt))
            after: dict[int, tuple[float, tuple | None]] = {}
            for state, (cost, way) in best.items():
                for letters, price, spelt in steps:
                    at, total = state, cost + price
                    for s in spelt:
                        total += costs[at * SYMBOLS + s] if s != BREAK else COST_ODD
                        at = at % SYMBOLS * SYMBOLS + s
                    known = after.get(at)
                    if known is None or total < known[0]:
                        after[at] = (total, (way, letters) if letters else way)
            best = after
        ends = ((c + costs[at * SYMBOLS + BOUNDARY], way) for at, (c, way) in best.items())
        way, out = min(ends, key=lambda end: end[0])[1], []
        while way is not None:
            way, letters = way
            out.append(letters)
        return "".join(reversed(out))


def _lattice(word: str) -> Iterator[list[tuple[str, float]]]:
    at = 0
    while at < len(word):
        letter, end = word[at], at + 1
        while end < len(word) and word[end] == letter:
            end += 1
        run, at = end - at, end
        if letter.isspace():
            yield [(" ", 0.0), ("", COST_DROP)]
            continue
        options: list[tuple[str, float]] = []
        for other in STANDS_FOR.get(letter, ""):
            options.append((other, COST_SUBSTITUTE + COST_REPEAT * (run > 1)))
            if run > 1:
                options.append((other * 2, COST_SUBSTITUTE))
        if letter in DROPPED:
            options += [("", COST_DROP), (" ", COST_DROP)]
        elif not letter.isalpha():
            options += [("", COST_DROP_SIGN), (" ", COST_DROP_SIGN)]
        if letter.isalpha():
            options.append((letter, COST_REPEAT * (run > 1)))
            if run > 1:
                options.append((letter * 2, 0.0 if run == 2 else COST_REPEAT))
            options.append((" " + letter, COST_BORDER + COST_REPEAT * (run > 1)))
        yield options


def plain_form(word: str, language: Language) -> str:
    """A lower-case word as scored: without signs around it, restored if disguised,
    then possibly several words with blanks between."""
    if not word.isascii():
        word = unicodedata.normalize("NFKC", word)
    if word.isalpha() and not _RUN.search(word):
        return word
    core = _EDGES.sub("", word)
    inner = _WORDY(core)
    if inner is None:
        return ""
    letters = inner[0]
    if letters.isalpha() and not _RUN.search(letters):
        first, last = inner.span()
        signs = (core[:first] + core[last:]).strip(_SIGNS)
        if not signs:
            return letters
    return language.restored(core)


def _short(word: str) -> bool:
    return len(word) <= PIECE or (len(word) <= 3 * PIECE and len(_EDGES.sub("", word)) <= PIECE)


def short_runs(words: list[str]) -> Iterator[str]:
    """Every maximal run of two or more short pieces, one blank between."""
    at = 0
    while at < len(words):
        begin = at
        while at < len(words) and _short(words[at]):
            at += 1
        if at - begin > 1:
            yield " ".join(words[begin:at])
        at += at == begin


def passage_form(run: str, language: Language) -> str:
    """A passage of several words as scored."""
    return language.restored(run) if _WORDY(run) else ""


def plain_words(text: str, language: Language, cache: dict[str, str]) -> set[str]:
    """The different words of a text, restored; runs of short pieces are also decoded
    as one passage."""
    listed = text.lower().split()
    if len(cache) > CACHE_WORDS:
        cache.clear()
    out = set()
    for word in set(listed):
        form = cache.get(word)
        if form is None:
            form = plain_form(word, language)
            if len(word) <= CACHED:
                cache[word] = form
        out.update(form.split())
    for run in set(short_runs(listed)):
        if not run.isascii():
            run = unicodedata.normalize("NFKC", run)
        form = cache.get(run)
        if form is None:
            form = passage_form(run, language)
            if len(run) <= CACHED:
                cache[run] = form
        out.update(form.split())
    return out


def features(word: str) -> list[str]:
    """A word, and its beginnings with a mark: stems show under any ending."""
    return [word, *[word[:n] + "~" for n in (4, 5, 6) if len(word) >= n]]


class Sought:
    """Finds the passages whose decoding can hold a feature: its letters, or what stands
    for them, in order, with repeats and anything but plain letters between. One bit per
    letter of all features, one step per character."""

    def __init__(self, names: Iterable[str]):
        stems = {f.removesuffix("~") for f in names}
        stems = {s for s in stems if not any(s[:n] in stems for n in range(1, len(s)))}
        self.first = self.last = 0
        self.fits, self.again = Counter(), Counter()
        bit = 1
        for stem in sorted(stems):
            self.first |= bit
            for letter in stem:
                self.again[letter] |= bit
                for written in [letter, *[k for k, v in STANDS_FOR.items() if letter in v]]:
                    self.fits[written] |= bit
                bit <<= 1
            self.last |= bit >> 1

    def search(self, text: str) -> bool:
        now = 0
        for c in text:
            held = self.again[c] & now if "a" <= c <= "z" else now
            now = ((now << 1 | self.first) & self.fits[c]) | held
            if now & self.last:
                return True
        return False


@dataclass
class Model:
    language: Language
    chance: dict[str, float]
    base: float

    def features_in(self, words: Iterable[str]) -> frozenset[str]:
        return frozenset(f for w in words for f in features(w) if f in self.chance)

    def score(self, words: Iterable[str]) -> float:
        return self.score_of(self.features_in(words))

    def score_of(self, found: Iterable[str]) -> float:
        """Chance that at least one cause makes the text toxic: the base rate of
        texts without any feature, or one of the different features found."""
        clean = 1.0 - min(self.base, MAX_BASE)
        for name in sorted(found):
            clean *= 1.0 - self.chance[name]
        return float(min(1.0, max(0.0, 1.0 - clean)))


@cache
def kinds_of() -> np.ndarray:
    """Flags of every code point. ``LETTER``: a letter that normalisation leaves alone
    wherever it stands. ``EDGE``: cut off around a word. ``SIGN`` and ``MARK``: says nothing
    around a plain word, unless it has one of both. ``DIGIT``: ASCII digits and the
    underscore. ``STRANGE``: no ASCII, and neither letter nor mark."""
    kinds = np.full(0x110000, STRANGE, dtype=np.uint8)
    for code in range(0x110000):
        c = chr(code)
        if c.isspace():
            kinds[code] = BLANK
            continue
        edge = not (c.isalnum() or c == "_" or c in STANDS_FOR)
        settled_form = code < 0x80 or (
            (code < 0x1100 or 0x2000 <= code < 0x3000 or 0x3040 <= code < 0xD7A4)
            and unicodedata.category(c)[0] != "M"
            and unicodedata.normalize("NFKC", c) == c
        )
        if settled_form and c.isalpha():
            kinds[code] = LETTER
        elif settled_form and c in _SIGNS:
            kinds[code] = 0 if edge else SIGN
        elif settled_form and edge:
            kinds[code] = MARK
        elif code < 0x80:
            kinds[code] = DIGIT
        kinds[code] |= EDGE * edge
    return kinds


def _letters_of(kinds: np.ndarray) -> np.ndarray:
    """Numbers of letters: a-z from 1, 27 for any other, 0 for what is none."""
    letters = np.where(kinds & LETTER, 27, 0).astype(np.uint8)
    letters[ord("a") : ord("z") + 1] = np.arange(1, 27)
    return letters


def _pieces(text: str) -> Iterator[str]:
    """A long text in pieces. A cut lies at a word that is no short piece and belongs to
    both sides, so no passage, nor the words around it, is cut."""
    begin = 0
    while len(text) - begin > SCAN_CHARS:
        word = _LONG.search(text, begin + SCAN_CHARS)
        if word is None:
            break
        yield text[begin : word.end()]
        begin = word.start()
    yield text[begin:]


NOTHING: frozenset[str] = frozenset()


class Judge:
    """Scores texts by a model. One scan over all characters of a span of texts finds the
    words and passages that can bear a feature; only these are decoded, each exactly.

    A word is passed over if it is plain (see ``plain_form``) and no feature begins with
    its first four letters, or if it holds no letter. A run of short pieces, with the words
    around it, is passed over if it holds nothing that stands for a letter of a feature and
    nowhere, blanks, signs and repeats left out, the first four letters of one."""

    def __init__(self, model: Model):
        self.model, self.sought, self.cache = model, Sought(model.chance), {}
        stems = {f.removesuffix("~") for f in model.chance}
        self.kinds = kinds_of().copy()
        for c in self.sought.fits:
            if not "a" <= c <= "z":
                self.kinds[ord(c)] |= WILD
        self.kinds[(self.kinds & STRANGE) > 0] |= WILD
        self.letters = _letters_of(self.kinds)
        self.begins = np.zeros(28**4, dtype=bool)
        self.passes = np.zeros((27,) * 4, dtype=bool)
        self.all_runs = False
        for stem in stems:
            first = [int(self.letters[ord(c)]) for c in stem[:4]]
            self.begins[_number(*first, *[0] * (4 - len(first)))] = True
            if not all("a" <= c <= "z" for c in stem):
                continue  # its other letters are wild
            single = re.sub(r"(.)\1+", r"\1", stem)
            self.all_runs |= len(single) < 2
            self.passes[tuple(ord(c) - 96 for c in single[:4])] = True
        self.passes = self.passes.reshape(-1)

    def scores(self, texts: Iterable[str]) -> list[float]:
        found, n_texts = {}, 0
        some, held = [], 0
        for text in texts:
            for piece in _pieces(text.lower()):
                some.append((n_texts, piece))
                held += len(piece) + 1
                if held > SCAN_CHARS:
                    self._scan(some, found)
                    some, held = [], 0
            n_texts += 1
        self._scan(some, found)
        clean = self.model.score_of(NOTHING)
        return [self.model.score_of(found[n]) if n in found else clean for n in range(n_texts)]

    def _scan(self, pieces: list[tuple[int, str]], found: dict[int, set[str]]) -> None:
        """Adds the features in pieces of texts to those found in each text."""
        if not pieces or not self.model.chance:
            return
        joined = "".join(f"{piece}\n" for _, piece in pieces)
        edges = np.cumsum([0, *(len(piece) + 1 for _, piece in pieces)])
        words, passages = self._suspects(joined, edges)
        for known, suspects in ((self._word, words), (self._passage, passages)):
            for at, begin, end in zip(*suspects, strict=True):
                names = known(joined[begin:end])
                if names:
                    found.setdefault(pieces[at][0], set()).update(names)

    def _suspects(self, joined: str, edges: np.ndarray) -> tuple[tuple[list, list, list], ...]:
        """(pieces, begins, ends) of the words, and of the passages, to be decoded; piece n
        lies between ``edges`` n and n + 1 and ends with a blank."""
        points = np.frombuffer(joined.encode("utf-32-le"), dtype=np.uint32)
        kinds = self.kinds[points]
        blank = (kinds & BLANK) > 0
        turns = np.flatnonzero(blank[1:] != blank[:-1]) + 1
        if not blank[0]:
            turns = np.concatenate([[0], turns])
        starts, ends = turns[::2], turns[1::2]
        if not len(starts):
            return ([], [], []), ([], [], [])
        letters = np.concatenate([self.letters[points], np.zeros(3, dtype=np.uint8)])

        def listed(begins: np.ndarray, finals: np.ndarray) -> tuple[list, list, list]:
            pieces = np.searchsorted(edges, begins, "right") - 1
            return pieces.tolist(), begins.tolist(), finals.tolist()

        odd = self._odd(points, kinds, letters, starts)
        first, last = self._runs(kinds, starts, ends, np.searchsorted(starts, edges))
        begins, finals = starts[first], ends[last]
        if not self.all_runs:
            held = np.zeros(len(begins), dtype=bool)
            for at in (np.flatnonzero(kinds & WILD), self._beginnings(letters)):
                held |= np.searchsorted(at, begins) < np.searchsorted(at, finals)
            begins, finals = begins[held], finals[held]
        return listed(starts[odd], ends[odd]), listed(begins, finals)

    def _odd(self, points, kinds, letters, starts) -> np.ndarray:
        """Which words are not plain, or begin like a feature."""
        plain = (kinds & LETTER) > 0
        blocks = np.flatnonzero(plain & ~np.concatenate([[False], plain[:-1]]))
        first = np.searchsorted(blocks, starts)
        n_blocks = np.diff(np.concatenate([first, [len(blocks)]]))
        kind = np.bitwise_or.reduceat(kinds, starts)
        both = ((kind & MARK) > 0) & ((kind & SIGN) > 0)
        odd = ((kind & STRANGE) > 0) | ((n_blocks > 0) & (both | ((kind & DIGIT) > 0)))
        odd |= n_blocks > 1
        same = points[1:] == points[:-1]
        thrice = np.flatnonzero(same[1:] & same[:-1] & plain[2:])
        odd[np.searchsorted(starts, thrice, "right") - 1] = True
        rest = np.flatnonzero(~odd & (n_blocks > 0))
        at = blocks[first[rest]]
        one, two, three, four = (letters[at + n].astype(np.int32) for n in range(4))
        three *= two > 0
        four *= three > 0
        odd[rest] = self.begins[_number(one, two, three, four)]
        return odd

    @staticmethod
    def _runs(kinds, starts, ends, of_piece) -> tuple[np.ndarray, np.ndarray]:
        """First and last word of each run of two or more short pieces in one piece of text,
        the words around it included; ``of_piece``: the first word of each, and the end."""
        length = ends - starts
        short = length <= PIECE
        edge = (kinds & EDGE) > 0
        some = np.flatnonzero(~short & (length <= 3 * PIECE) & (edge[starts] | edge[ends - 1]))
        if len(some):
            step = np.arange(3 * PIECE)
            inside = step < length[some, None]
            kept = inside & ~edge[np.minimum(starts[some, None] + step, len(edge) - 1)]
            begin, end = kept.argmax(1), len(step) - kept[:, ::-1].argmax(1)
            short[some] = ~kept.any(1) | (end - begin <= PIECE)
        opens = short & ~np.concatenate([[False], short[:-1]])
        closes = short & ~np.concatenate([short[1:], [False]])
        begun = of_piece[of_piece < len(short)]
        opens[begun] = short[begun]
        closed = of_piece[of_piece > 0] - 1
        closes[closed] = short[closed]
        first, last = np.flatnonzero(opens), np.flatnonzero(closes)
        long = last > first
        first, last = first[long], last[long]
        at = np.searchsorted(of_piece, first, "right") - 1
        return np.maximum(first - 1, of_piece[at]), np.minimum(last + 1, of_piece[at + 1] - 1)

    def _beginnings(self, letters: np.ndarray) -> np.ndarray:
        """Where the letters a-z, all else and repeats left out, go on like a feature."""
        at = np.flatnonzero((letters > 0) & (letters < 27))
        v = letters[at]
        final = np.ones(len(v), dtype=bool)  # of equal letters the last one
        final[:-1] = v[1:] != v[:-1]
        at = at[final]
        v = np.concatenate([v[final], np.zeros(3, dtype=np.uint8)]).astype(np.int32)
        n = len(at)
        return at[self.passes[((v[:n] * 27 + v[1 : n + 1]) * 27 + v[2 : n + 2]) * 27 + v[3 : n + 3]]]

    def _word(self, word: str) -> frozenset[str]:
        names = self.cache.get(word)
        return self._names(word, plain_form) if names is None else names

    def _passage(self, run: str) -> frozenset[str]:
        run = " ".join(run.split())
        if not run.isascii():
            run = unicodedata.normalize("NFKC", run)
        if not self.sought.search(run):
            return NOTHING
        names = self.cache.get(run)
        return self._names(run, passage_form) if names is None else names

    def _names(self, written: str, form: Callable[[str, Language], str]) -> frozenset[str]:
        names = self.model.features_in(form(written, self.model.language).split()) or NOTHING
        if len(written) <= CACHED:
            if len(self.cache) > CACHE_WORDS:
                self.cache.clear()
            self.cache[written] = names
        return names


def _number(one, two, three, four):
    return ((one * 28 + two) * 28 + three) * 28 + four


def doc_words(docs: DataFrame, language: Language, carry: str) -> DataFrame:
    """(carry, features) for the bounded training sample."""
    kind = docs.schema[carry].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache: dict[str, str] = {}
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                some = batch.slice(at, 64)
                found = [
                    sorted({f for w in plain_words(t.as_py(), language, cache) for f in features(w)})
                    for t in some.column("text")
                ]
                yield pa.RecordBatch.from_arrays(
                    [some.column(carry), pa.array(found, pa.list_(pa.string()))],
                    [carry, "features"],
                )

    return docs.mapInArrow(settled(run), f"{carry} {kind}, features array<string>")


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> Model:
    """Language model from all of ``docs``, classifier from labelled ones.

    ``labels`` holds key and toxic (0/1; null rows are ignored; a repeated key is toxic
    if any of its labels says so). Of more than ``TRAIN_DOCS`` labelled documents a
    seeded hash picks about that many. Features that occur in at least ``MIN_TOXIC``
    toxic texts, mostly toxic ones, are candidates (``MAX_FEATURES`` at most, the most
    frequent); see ``chosen_features`` for those that are kept. Without any
    toxic label nothing is ever judged toxic.
    """
    ship(docs.sparkSession)
    counts = trigram_counts(docs, F.col(text)).toPandas()  # at most SYMBOLS**3 rows
    language = Language.fitted(counts["trigram"].to_numpy(np.int64), counts["n"].to_numpy())
    known = (
        labels.filter(F.col("toxic").isNotNull() & F.col(key).isNotNull())
        .groupBy(F.col(key).alias("_key"))
        .agg(F.max("toxic").cast("int").alias("toxic"))
    )
    n_known = known.count()
    dice = F.pmod(F.xxhash64(F.lit(11), "_key"), F.lit(1 << 20))
    limit = (1 << 20) * min(1.0, TRAIN_DOCS / max(n_known, 1))
    picked = known.filter(dice < limit)
    # Broadcast: TRAIN_DOCS rows of two numbers, give or take the hash.
    texts = docs.select(F.col(key).alias("_key"), or_empty(F.col(text)).alias("text"))
    sample = texts.join(F.broadcast(picked), "_key").select("toxic", "text")
    # Equal texts are one witness.
    sample = sample.groupBy("text").agg(F.max("toxic").alias("toxic"))
    seen = kept_safe(doc_words(sample.select("toxic", "text"), language, "toxic"))
    toxic = seen.filter("toxic > 0")
    n_toxic, n_all = toxic.count(), seen.count()
    if not n_toxic:
        return Model(language, {}, 0.5 / (n_all + 2.0))
    frequent = (
        toxic.select(F.explode("features").alias("f"))
        .groupBy("f")
        .agg(F.count("*").alias("n"))
        .filter(F.col("n") >= MIN_TOXIC)
    )
    both = (
        seen.select("toxic", F.explode("features").alias("f"))
        .join(frequent, "f")
        .groupBy("f", "n")
        .agg(F.count("*").alias("total"))
        .filter(F.col("n") >= MIN_PRECISION * F.col("total"))
        .orderBy(F.desc("n"), "f")
        .limit(MAX_FEATURES)
    )
    table = {r["f"]: (r["n"], r["total"]) for r in both.collect()}
    if not table:
        return Model(language, {}, (n_toxic + 0.5) / (n_all + 1.0))
    held = toxic.select(F.array_intersect("features", F.lit(sorted(table))).alias("f"))
    texts = [frozenset(r["f"]) for r in held.collect()]  # of the bounded sample
    chosen = chosen_features(table, texts)
    missed = sum(1 for t in texts if not t & chosen.keys())
    rest = max(1, n_all - n_toxic + missed)
    return Model(language, chosen, (missed + 0.5) / (rest + 1.0))


def chosen_features(table: dict[str, tuple[int, int]], texts: list[frozenset]) -> dict[str, float]:
    """Features that make a text toxic, each with its chance to.

    ``table`` has the toxic and all texts of each candidate, ``texts`` the candidates
    in each toxic text. All clear ones with support count, unless most of their texts
    share another candidate that begins differently, as words of copied texts do; then, one by one, the one
    that explains most texts left, less three times the clean texts it is found in.
    Of a beginning and a longer one, or the word itself, that occur in as many toxic
    texts the longer stays.
    """
    support = max(MIN_TOXIC, len(texts) // 100)
    longer = Counter()
    for name, (n, _) in table.items():
        stem = name.removesuffix("~")
        for size in {4, 5, 6}:
            if size < len(stem) or (size == len(stem) and stem == name):
                longer[stem[:size] + "~"] = max(longer[stem[:size] + "~"], n)
    fair = {f: v for f, v in table.items() if not (f.endswith("~") and longer[f] >= v[0])}
    clear = {f for f, (n, total) in fair.items() if n >= support and n >= CLEAR * total}
    with_it: dict[str, Counter] = {f: Counter() for f in clear}
    for text in texts:
        for name in text & clear:
            with_it[name].update(text & fair.keys())
    for name, others in with_it.items():
        mine = others[name]
        if any(k >= TOGETHER * mine and f[:4] != name[:4] for f, k in others.items()):
            clear.discard(name)
    left = [t & fair.keys() for t in texts if not t & clear]
    while left:
        hits = Counter(f for t in left for f in t)
        worth = {f: k - 3 * (fair[f][1] - fair[f][0]) for f, k in hits.items()}
        name = max(worth, key=lambda f: (worth[f], len(f), f), default=None)
        if name is None or worth[name] < MIN_TOXIC - 2:
            break
        clear.add(name)
        left = [t for t in left if name not in t]
    return {f: (fair[f][0] + 0.5) / (fair[f][1] + 1.0) for f in clear}


def toxicity(
    docs: DataFrame,
    model: Model,
    text: str = "text",
    threshold: float = 0.5,
    added: tuple[str, str] = ("score", "predicted"),
) -> DataFrame:
    """Rows of ``docs`` with all columns, score (0 to 1) and predicted (0/1).

    Null and empty texts get the base rate; an empty table gives an empty one. The new
    columns are named by ``added``; columns of these names, in whatever case, are
    replaced. One narrow pass; the model (a table of ``SYMBOLS**3`` costs and at most
    ``MAX_FEATURES`` features) travels with the tasks.
    """
    ship(docs.sparkSession)
    score, predicted = added
    given = without(docs, added)
    scored = unused(given, "_scored")
    rows = given.select("*", or_empty(F.col(text)).alias(scored))
    ready = rows.sparkSession.sparkContext.broadcast(model)
    schema = StructType([*given.schema.fields, StructField(score, DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        settle()
        judge = Judge(ready.value)
        for batch in batches:
            scores = judge.scores(t.as_py() for t in batch.column(scored))
            names = [n for n in batch.schema.names if n != scored]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(n) for n in names], pa.array(scores, pa.float64())],
                [*names, score],
            )

    judged = rows.mapInArrow(settled(run), schema)
    return judged.withColumn(predicted, (F.col(score) >= threshold).cast("int"))
