"""Byte-level BPE compiled to a deterministic transducer that counts tokens."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import cache

import numpy as np

from tillstream.llm.common import give_back

CHUNK = 256
MAX_BYTES = 192 << 20  # a machine that takes more is compiled anew
STATE_BYTES, PAIR_BYTES = 650, 220  # of one state and one judged pair, as measured
END_OF_WORD = "</w>"
FIRST = 1 << 10  # added to the column of a symbol that begins a word

LETTER, NUMBER, SPACE, OTHER = range(4)


@cache
def byte_letters() -> dict[str, int]:
    """The public byte-level alphabet: printable bytes stand for themselves, the
    others for the characters from U+0100 on, in order."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


POINTS_AT_ONCE = 1 << 13


def _all_points() -> Iterator[tuple[np.ndarray, str]]:
    """Every code point of Unicode text, some at a time, as numbers and as a text."""
    points = np.concatenate([np.arange(0xD800), np.arange(0xE000, 0x110000)]).astype("<u4")
    for at in range(0, len(points), POINTS_AT_ONCE):
        some = points[at : at + POINTS_AT_ONCE]
        yield some, some.tobytes().decode("utf-32-le")


@cache
def classes() -> np.ndarray:
    """Letter, number, white space or other for every code point, as the library whose
    words must be met takes them: its own splitter is run over all of them once."""
    from tokenizers import Regex, pre_tokenizers

    out = np.full(0x110000, OTHER, dtype=np.uint8)
    for pattern, kind in ((r"\p{L}+", LETTER), (r"\p{N}+", NUMBER), (r"\s+", SPACE)):
        runs = pre_tokenizers.Split(Regex(pattern), "removed", invert=True)
        for points, text in _all_points():
            for _, (begin, end) in runs.pre_tokenize_str(text):
                out[points[begin:end]] = kind
    return out


@cache
def lower_cases() -> tuple[re.Pattern, dict[str, str]]:
    """Characters whose lower case in the library is not Python's, and that lower case."""
    from tokenizers import normalizers

    own, found = normalizers.Lowercase(), {}
    for _, text in _all_points():
        if "\x00" in text:  # the mark that parts the others is among them
            marked = [own.normalize_str(char) for char in text]
        else:
            marked = own.normalize_str("\x00".join(text)).split("\x00")
        for char, low in zip(text, marked, strict=True):
            if char.lower() != low:
                found[char] = low
    return re.compile("[" + "".join(found) + "]" if found else r"(?!)"), found


class Transducer:
    """A deterministic transducer over bytes, compiled from the merges as it is used.

    A word's last byte is a symbol of its own (256 more) if the vocabulary marks ends
    of words.

    The encoding of a prefix ends in exactly one token: the longest vocabulary token
    t ending there that the merges keep apart from the last token before it. So a
    state need only hold, for each suffix that some longer token starts with, the
    token that ends where the suffix starts and how many tokens lie between there
    and here. Reading a byte leads to one state and changes the number of tokens
    emitted so far by an amount that depends on state and byte alone: that number is
    the transition's annotation. State 0 is the start of a word.
    """

    def __init__(self, path: str, max_bytes: int = MAX_BYTES):
        self.max_bytes = max_bytes
        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        letters, vocab = byte_letters(), model["vocab"]
        self.marks_ends = model.get("end_of_word_suffix") == END_OF_WORD
        self.token: dict[str, int] = {}
        self.length: dict[int, int] = {}
        for name, number in vocab.items():
            ended = self.marks_ends and name.endswith(END_OF_WORD)
            bare = name.removesuffix(END_OF_WORD) if ended else name
            if bare and all(c in letters for c in bare):
                codes = [letters[c] for c in bare]
                codes[-1] += 256 * ended
                self.token["".join(map(chr, codes))] = number
                self.length[number] = len(codes)
        self.halves: dict[int, tuple[int, int]] = {}
        self.merged: dict[tuple[int, int], int] = {}
        for left, right in model["merges"]:
            pair, whole = (vocab[left], vocab[right]), vocab[left + right]
            self.halves.setdefault(whole, pair)
            self.merged[pair] = whole
        # Each beginning of a longer token once, shared by the states that hold it.
        self.starts = {t[:n]: t[:n] for t in self.token for n in range(1, len(t))}
        self.apart: dict[tuple[int, int], bool] = {}
        self.compile_anew()

    def compile_anew(self) -> None:
        self.apart.clear()
        self.column = np.full(512, -1, dtype=np.int64)
        self.symbols: list[str] = []
        start = (("", -1, 0),)
        self.states, self.numbers = [start], {start: 0}
        self.width, self.rows = 0, 0
        self._reserve(96, 1)

    def _reserve(self, width: int, rows: int) -> None:
        """Room for ``width`` symbols and at least ``rows`` states. A transition is the
        next state and, in the low byte, the tokens emitted, plus 128; 0 where there is
        none yet. Zeros take no memory until a state is used, so there is room for as
        many states as the bytes allow and, beyond, for one call that overruns them."""
        rows = max(rows, self.rows, self.max_bytes // (4 * width + STATE_BYTES) + (1 << 15))
        moves = np.zeros((rows, width), dtype=np.int32)
        if self.rows:
            held = len(self.states)
            moves[:held, : self.width] = self.moves.reshape(self.rows, self.width)[:held]
            self.last = np.concatenate([self.last, np.full(rows - len(self.last), -1, dtype=np.int32)])
        else:
            self.last = np.full(rows, -1, dtype=np.int32)
        self.moves, self.width, self.rows = moves.ravel(), width, rows

    def held_bytes(self) -> int:
        """About what the compiled part takes."""
        return (STATE_BYTES + 4 * self.width) * len(self.states) + PAIR_BYTES * len(self.apart)

    def columns_of(self, data: np.ndarray) -> np.ndarray:
        """The table's column for each symbol; symbols get one when first seen."""
        seen = np.flatnonzero(np.bincount(data, minlength=512))
        for symbol in seen[self.column[seen] < 0].tolist():
            if len(self.symbols) == self.width:
                self._reserve(self.width + 48, 1)
            self.column[symbol] = len(self.symbols)
            self.symbols.append(chr(symbol))
        return self.column[data]

    def stay_apart(self, left: int, right: int) -> bool:
        """Whether the merges leave these two tokens side by side as they are.

        Undo the later of the two last merges, again and again: if at some point the
        inner ends would have merged before a merge already undone, they would not
        have stayed apart.
        """
        pair = (left, right)
        known = self.apart.get(pair)
        if known is not None:
            return known
        halves, merged, limit, result = self.halves, self.merged, 1 << 60, True
        while True:
            whole = merged.get((left, right))
            if whole is not None and whole < limit:
                result = False
                break
            a, b = halves.get(left), halves.get(right)
            # A byte has no halves; a merged token's number grows with its rank.
            if a is not None and (left > right or b is None):
                limit, left = left, a[1]
            elif b is not None:
                limit, right = right + 1, b[0]
            else:
                break
        self.apart[pair] = result
        return result

    def _step(self, state: tuple, byte: str) -> tuple[tuple, int]:
        found = None
        for suffix, last, back in state:  # longest suffix first
            token = self.token.get(suffix + byte)
            if token is not None and (last < 0 or self.stay_apart(last, token)):
                found = token, 1 - back
                break
        if found is None:
            raise ValueError(f"no token for byte {byte!r}")
        token, added = found
        longer = [
            (self.starts[suffix + byte], last, back + added)
            for suffix, last, back in state
            if suffix + byte in self.starts
        ]
        return (*longer, ("", token, 0)), added

    def add(self, state: int, column: int) -> None:
        """Compiles one transition."""
        target, added = self._step(self.states[state], self.symbols[column])
        number = self.numbers.get(target)
        if number is None:
            number = self.numbers[target] = len(self.states)
            self.states.append(target)
            if number >= self.rows:
                self._reserve(self.width, number + (1 << 15))
            self.last[number] = target[-1][1]
        self.moves[state * self.width + column] = (number << 8) | (added + 128)

    def advance(self, states: np.ndarray, columns: np.ndarray) -> np.ndarray:
        """Transitions for many (state, column) pairs at once."""
        while True:
            spot = states * self.width + columns
            moves = self.moves.take(spot)
            if moves.min(initial=1) > 0:
                return moves
            for pair in np.unique(spot[moves == 0]).tolist():
                self.add(*divmod(pair, self.width))


def split_contractions(points: np.ndarray, start: np.ndarray) -> None:
    """'s 't 'm 'd 're 've 'll as words, wherever matching begins at the apostrophe."""
    n = len(points)
    for at in np.flatnonzero(points == 39).tolist():
        if not start[at]:
            continue
        tail = "".join(map(chr, points[at + 1 : at + 3].tolist()))
        size = 1 if tail[:1] in tuple("stmd") else 2 if tail in ("re", "ve", "ll") else 0
        if not size:
            continue
        end = at + 1 + size
        start[at + 1 : end] = False
        if end < n:
            # The rest of a letter run is a word; a space before text stays its start.
            start[end] = True


def read_words(
    machine: Transducer, data: np.ndarray, first: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """For each symbol the change of the token count and the state after it; ``first``
    marks the symbols that begin a word.

    The symbols are cut into chunks that are read in step. A chunk's state map is
    constant from its first word start on, so every chunk runs from there by itself;
    the few symbols before it are read from the exit state of the chunk before. Where
    a chunk has no word start, exit states are handed on chunk by chunk until none is
    left waiting, which composes the maps in order.
    """
    if machine.held_bytes() > machine.max_bytes:
        machine.compile_anew()
    total = len(data)
    moves = np.zeros(total, dtype=np.int32)
    if not total:
        return moves, moves
    codes = machine.columns_of(data) + FIRST * first
    begins = np.arange(0, total, CHUNK)
    ends = np.minimum(begins + CHUNK, total)
    exits = np.full(len(begins), -1, dtype=np.int64)
    marks = np.flatnonzero(first)
    own = np.searchsorted(marks, begins)
    head = np.where(own < len(marks), marks[np.minimum(own, len(marks) - 1)], total)
    head = np.minimum(head, ends)
    free = np.flatnonzero(head < ends)
    exits[free] = _read(machine, codes, moves, head[free], ends[free])
    waiting = np.flatnonzero(head > begins)
    while len(waiting):
        ready = waiting[exits[waiting - 1] >= 0]
        done = _read(machine, codes, moves, begins[ready], head[ready], exits[ready - 1])
        whole = head[ready] == ends[ready]
        exits[ready[whole]] = done[whole]
        waiting = np.setdiff1d(waiting, ready, assume_unique=True)
    return (moves & 255) - 128, moves >> 8


def _read(machine, codes, moves, begin, end, entry=None) -> np.ndarray:
    """Runs the machine over codes[begin:end] of each lane; returns the exit states."""
    order = np.argsort(begin - end, kind="stable")  # longest first: lanes end at the back
    begin, length = begin[order], (end - begin)[order]
    now = np.zeros(len(begin), dtype=np.int64) if entry is None else entry[order].copy()
    alive = len(begin)
    for step in range(int(length[0]) if alive else 0):
        while alive and length[alive - 1] <= step:
            alive -= 1
        at = begin[:alive] + step
        code = codes[at]
        fresh = code >= FIRST
        got = machine.advance(np.where(fresh, 0, now[:alive]), np.where(fresh, code - FIRST, code))
        now[:alive] = got >> 8
        moves[at] = got
    out = np.empty_like(now)
    out[order] = now
    return out


def token_ids(
    machine: Transducer, data: np.ndarray, first: np.ndarray, states: np.ndarray, emitted: np.ndarray
) -> np.ndarray:
    """Ids of all tokens in order. A word's encoding is the token its last state ends
    in, before it the one that the state at that token's start ends in, and so on."""
    ends = np.flatnonzero(np.append(first[1:], True)) if len(data) else np.zeros(0, dtype=np.int64)
    begins = np.flatnonzero(first)
    upto = np.cumsum(emitted, dtype=np.int64)
    ids = np.zeros(int(upto[-1]) if len(upto) else 0, dtype=np.uint32)
    sizes = np.zeros(max(machine.length, default=0) + 1, dtype=np.int64)
    sizes[list(machine.length)] = list(machine.length.values())
    place, at = upto[ends] - 1, ends
    while len(at):
        token = machine.last[states[at]]
        ids[place] = token
        at = at - sizes[token]
        more = at >= begins
        at, begins, place = at[more], begins[more], place[more] - 1
    return ids


@cache
def machine_of(path: str) -> Transducer:
    return Transducer(path)


def settle() -> None:
    """Gives back what earlier tasks of other operators left in a Python worker:
    workers live on between stages, and two of them share an executor's memory."""
    machine_of.cache_clear()
    give_back()
