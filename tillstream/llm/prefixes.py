"""Byte-level BPE, encoding and decoding, by the last token of every byte prefix.

The encoding of a prefix ends in exactly one token. Token t is the last one of a prefix
if it ends there and the merges keep it apart from the last token of the prefix before
it. So one table holds the encodings of all prefixes: bytes can be appended without
looking back further than the longest token, and after an edit only the entries near it
change.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import cache
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstream.llm.common import or_empty, settled, ship, spans
from tillstream.llm.lookup import Lookup
from tillstream.llm.transducer import LETTER, NUMBER, OTHER, SPACE, split_contractions

NEVER = 1 << 60
MEMO_WORDS = 250_000
IDS_AT_ONCE = 1 << 19
TEXT_BYTES = 1 << 20
MEMO_BYTES = 64  # longer words are not remembered
PAIRS = 500_000


def ranks_of(path: str) -> dict[bytes, int]:
    with open(path, "rb") as file:
        lines = [line.split() for line in file if line.strip()]
    return {base64.b64decode(name): int(number) for name, number in lines}


class Vocabulary:
    """Tokens by their bytes, with the merges that their ranks imply."""

    def __init__(self, path: str):
        self.rank = ranks_of(path)
        self.name = {number: name for name, number in self.rank.items()}
        self.longest = max(map(len, self.rank))
        # All tokens read from their ends: (node, byte) leads to the next node.
        self.next: dict[int, int] = {}
        self.ends: list[int] = [-1]
        for name, number in self.rank.items():
            node = 0
            for byte in reversed(name):
                edge = node << 8 | byte
                node = self.next.get(edge, 0)
                if not node:
                    node = self.next[edge] = len(self.ends)
                    self.ends.append(-1)
            self.ends[node] = number
        self.unbuilt: set[int] = set()
        self._steps: dict[int, tuple | None] = {}
        self.apart: dict[int, bool] = {}
        for token in self.name:
            self.steps(token)

    def steps(self, token: int) -> tuple[tuple, tuple, tuple] | None:
        """How the merges build a token out of its bytes: the ranks of the merges in
        their order, and the first and the last part before the first merge and after
        each one, as tokens. None if they never build it."""
        if token in self._steps:
            return self._steps[token]
        name, rank = self.name[token], self.rank
        parts = [name[i : i + 1] for i in range(len(name))]
        ranks, heads, tails = [], [rank[parts[0]]], [rank[parts[-1]]]
        while True:
            pairs = [rank.get(a + b, NEVER) for a, b in pairwise(parts)]
            best = min(pairs, default=NEVER)
            if best == NEVER:
                break
            at = pairs.index(best)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            ranks.append(best)
            heads.append(rank[parts[0]])
            tails.append(rank[parts[-1]])
        built = (*ranks, NEVER), tuple(heads), tuple(tails)
        if len(parts) > 1:
            built = None
            self.unbuilt.add(token)
        self._steps[token] = built
        return built

    def judge(self, left: int, right: int) -> bool:
        """Whether the merges leave two tokens side by side as they are: both are built
        at the same time, lowest rank first and of equals the leftmost, and no pair
        across their border may come first."""
        one, two = self.steps(left), self.steps(right)
        if one is None or two is None:
            return False
        (in_left, _, tails), (in_right, heads, _) = one, two
        name, rank, i, j = self.name, self.rank, 0, 0
        while True:
            across = rank.get(name[tails[i]] + name[heads[j]], NEVER)
            if across < in_left[i] and across <= in_right[j]:
                return False
            if in_left[i] == in_right[j] == NEVER:
                return True
            if in_left[i] <= in_right[j]:
                i += 1
            else:
                j += 1

    def stay_apart(self, left: int, right: int) -> bool:
        """:meth:`judge`, remembered."""
        key = left << 32 | right
        known = self.apart.get(key)
        if known is None:
            if len(self.apart) > PAIRS:
                self.apart.clear()
            known = self.apart[key] = self.judge(left, right)
        return known


class PrefixTable:
    """The last token of every non-empty prefix of some bytes, as the merges alone have
    it; that a whole word may be one token is for the encoder to see."""

    def __init__(self, vocabulary: Vocabulary, data: bytes = b""):
        self.vocabulary, self.data, self.last = vocabulary, b"", []
        self.append(data)

    def _extend(self, upto: int) -> None:
        """Fills in the entries up to ``upto``: of the tokens that end there, longest
        first, the one that stays apart from the token before it."""
        vocabulary, data, last = self.vocabulary, self.data, self.last
        follow, ends, known = vocabulary.next.get, vocabulary.ends, vocabulary.apart.get
        for end in range(len(last) + 1, upto + 1):
            node, at, found = 0, end, []
            while at:
                node = follow(node << 8 | data[at - 1])
                if node is None:
                    break
                at -= 1
                token = ends[node]
                if token >= 0:
                    found.append((at, token))
            while found:
                begin, token = found.pop()
                if not begin:
                    fits = vocabulary.steps(token) is not None
                else:
                    left = last[begin - 1]
                    fits = known(left << 32 | token)
                    if fits is None:
                        fits = vocabulary.stay_apart(left, token)
                if fits:
                    last.append(token)
                    break
            else:
                raise ValueError(f"no token ends with byte {data[end - 1]}")

    def append(self, more: bytes) -> None:
        """Adds bytes at the end; entries that are there stay as they are."""
        self.data += more
        self._extend(len(self.data))

    def edit(self, begin: int, end: int, put: bytes) -> int:
        """Puts ``put`` in place of the bytes from ``begin`` to ``end`` and returns how
        many entries were worked out anew. An entry depends on the entries and bytes of
        one longest token before it, so once that many in a row behind the edit are as
        they were, so are all others."""
        old = self.last[end:]
        self.data = self.data[:begin] + put + self.data[end:]
        self.last = self.last[:begin]
        edge, same = begin + len(put), 0
        for at in range(begin + 1, len(self.data) + 1):
            self._extend(at)
            token = self.last[-1]
            same = same + 1 if at > edge and old[at - edge - 1] == token else 0
            if same == self.vocabulary.longest:
                self.last += old[at - edge :]
                return at - begin
        return len(self.data) - begin

    def ids(self, end: int | None = None) -> list[int]:
        """The encoding of the first ``end`` bytes, of all if not given."""
        at, out = len(self.data) if end is None else end, []
        while at:
            token = self.last[at - 1]
            out.append(token)
            at -= len(self.vocabulary.name[token])
        return out[::-1]


@cache
def kinds() -> np.ndarray:
    """Letter, number, white space or other for every code point, as the library that
    the encodings must equal takes them."""
    import tiktoken

    single = {bytes([b]): b for b in range(256)}
    points = [*range(0xD800), *range(0xE000, 0x110000)]
    text = "".join(map(chr, points))
    out = np.full(0x110000, OTHER, dtype=np.uint8)
    for pattern, kind in ((r"\p{L}", LETTER), (r"\p{N}", NUMBER), (r"\s", SPACE)):
        probe = tiktoken.Encoding("probe", pat_str=pattern, mergeable_ranks=single, special_tokens={})
        found = bytes(probe.encode_ordinary(text)).decode()
        out[np.frombuffer(found.encode("utf-32-le"), dtype=np.uint32)] = kind
    return out


def word_borders(text: str, raw: bytes) -> list[int]:
    """Byte offsets where the words of the public pattern begin, and the end."""
    plain = len(raw) == len(text)
    data = np.frombuffer(raw, dtype=np.uint8)
    points = (
        data.astype(np.uint32)
        if plain
        else np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)
    )
    kind = kinds()[points]
    start = np.ones(len(points), dtype=bool)
    start[1:] = kind[1:] != kind[:-1]
    # Of white space before a word the last character is apart; a plain space is the
    # word's own beginning.
    last = np.zeros(len(points), dtype=bool)
    last[:-1] = (kind[:-1] == SPACE) & (kind[1:] != SPACE)
    start |= last
    start[1:] &= ~(last & (points == 32))[:-1]
    split_contractions(points, start)
    at = np.flatnonzero(start)
    if not plain:
        at = np.flatnonzero((data & 0xC0) != 0x80)[at]
    return [*at.tolist(), len(raw)]


class Codec:
    """Encodes whole texts; words met before are looked up."""

    def __init__(self, path: str):
        self.vocabulary = vocabulary = Vocabulary(path)
        self.edges = Lookup(20)
        self.edges.add(
            np.fromiter(vocabulary.next, np.int64, len(vocabulary.next)),
            np.fromiter(vocabulary.next.values(), np.int32, len(vocabulary.next)),
        )
        self.ends = np.array(vocabulary.ends, dtype=np.int32)
        self.size = np.zeros(max(vocabulary.name) + 1, dtype=np.int32)
        self.size[list(vocabulary.name)] = [len(x) for x in vocabulary.name.values()]
        self.pairs = Lookup(20)
        self.forget()

    def forget(self) -> None:
        self.row: dict[bytes, int] = {}
        self.begin, self.length = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        self.flat = np.zeros(0, dtype=np.int32)

    def word(self, word: bytes) -> list[int]:
        whole = self.vocabulary.rank.get(word)
        return [whole] if whole is not None else PrefixTable(self.vocabulary, word).ids()

    def _apart(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = left.astype(np.int64) << 32 | right
        known = self.pairs.find(keys)
        if known.min(initial=0) < 0:
            if self.pairs.held > 4 * PAIRS:
                self.pairs, known = Lookup(20), np.full(len(keys), -1)
            fresh = np.unique(keys[known < 0])
            judged = [self.vocabulary.judge(k >> 32, k & 0xFFFFFFFF) for k in fresh.tolist()]
            self.pairs.add(fresh, np.array(judged, dtype=np.int32))
            known = self.pairs.find(keys)
        return known == 1

    def _candidates(self, data: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, ...]:
        """For every byte the tokens that end there inside its word, longest first: where
        a byte's candidates begin, their tokens and their lengths. ``place`` is a byte's
        number in its word."""
        at, node = np.arange(len(data)), np.zeros(len(data), dtype=np.int64)
        spots, tokens, sizes, back = [], [], [], 0
        while len(at):
            node = self.edges.find(node << 8 | data[at - back]).astype(np.int64)
            on = node >= 0
            at, node = at[on], node[on]
            token = self.ends[node]
            back += 1
            found = token >= 0
            spots.append(at[found])
            tokens.append(token[found])
            sizes.append(np.full(len(spots[-1]), back, dtype=np.int64))
            further = place[at] >= back
            at, node = at[further], node[further]
        spot = np.concatenate(spots[::-1])
        order = np.argsort(spot, kind="stable")
        first = np.searchsorted(spot[order], np.arange(len(data) + 1))
        return first, np.concatenate(tokens[::-1])[order], np.concatenate(sizes[::-1])[order]

    def _last_tokens(self, data: np.ndarray, begins: np.ndarray) -> np.ndarray:
        """Prefix tables of many words side by side: entries of the same place in their
        words are filled in together."""
        if not len(data):
            return np.zeros(0, dtype=np.int32)
        lengths = np.diff(np.append(begins, len(data)))
        place = np.arange(len(data)) - np.repeat(begins, lengths)
        first, tokens, sizes = self._candidates(data, place)
        last = np.full(len(data), -1, dtype=np.int32)
        by_place = np.argsort(place, kind="stable")
        edge = np.searchsorted(place[by_place], np.arange(int(lengths.max(initial=0)) + 1))
        for low, high in pairwise(edge.tolist()):
            at = by_place[low:high]
            choice = first[at]
            while len(at):
                if (choice >= first[at + 1]).any():
                    raise ValueError("no token ends with some byte")
                token, size = tokens[choice], sizes[choice]
                inner = place[at] >= size
                fits = ~inner
                if inner.any():
                    fits[inner] = self._apart(last[at[inner] - size[inner]], token[inner])
                for n in np.flatnonzero(~inner) if self.vocabulary.unbuilt else ():
                    fits[n] = int(token[n]) not in self.vocabulary.unbuilt
                last[at[fits]] = token[fits]
                at, choice = at[~fits], choice[~fits] + 1
        return last

    def _learn(self, words: list[bytes]) -> None:
        """Adds the encodings of words not met before."""
        rank = self.vocabulary.rank
        whole = [rank.get(w, -1) for w in words]
        ids, sizes = [], np.ones(len(words), dtype=np.int64)
        parts = [n for n, token in enumerate(whole) if token < 0]
        lengths = np.array([len(words[n]) for n in parts], dtype=np.int64)
        data = np.frombuffer(b"".join(words[n] for n in parts), dtype=np.uint8).astype(np.int64)
        begins = np.cumsum(lengths) - lengths
        last = self._last_tokens(data, begins)
        # From the end of a word token by token to its beginning.
        at, row = begins + lengths - 1, np.arange(len(parts))
        found, counted = [], np.zeros(len(parts), dtype=np.int64)
        while len(at):
            token = last[at]
            found.append((row, token))
            counted[row] += 1
            at = at - self.size[token]
            more = at >= begins[row]
            at, row = at[more], row[more]
        sizes[parts] = counted
        begin = np.cumsum(sizes) - sizes
        ids = np.array(whole, dtype=np.int32)
        flat = np.empty(int(sizes.sum()), dtype=np.int32)
        single = ids >= 0
        flat[begin[single]] = ids[single]
        ends = (begin + sizes)[parts] if parts else begin[:0]
        for step, (row, token) in enumerate(found, 1):
            flat[ends[row] - step] = token
        start = len(self.row)
        self.row.update(zip(words, range(start, start + len(words)), strict=True))
        self.begin = np.concatenate([self.begin, begin + len(self.flat)])
        self.length = np.concatenate([self.length, sizes])
        self.flat = np.concatenate([self.flat, flat])

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text."""
        cut = []
        for text in texts:
            raw = text.encode("utf-8")
            cut.append([raw[a:b] for a, b in pairwise(word_borders(text, raw))] if raw else [])
        if len(self.row) > MEMO_WORDS:
            self.forget()
        fresh = {w for words in cut for w in words}.difference(self.row)
        long = {w: np.array(self.word(w), dtype=np.int32) for w in fresh if len(w) > MEMO_BYTES}
        self._learn([w for w in fresh if w not in long])
        out = []
        for words in cut:
            if long and any(len(w) > MEMO_BYTES for w in words):
                ids = [long[w] if len(w) > MEMO_BYTES else self._ids([w]) for w in words]
                out.append(np.concatenate(ids))
            else:
                out.append(self._ids(words))
        return out

    def _ids(self, words: list[bytes]) -> np.ndarray:
        """The encodings of known words, one after another."""
        rows = np.fromiter(map(self.row.__getitem__, words), np.int64, len(words))
        sizes = self.length[rows]
        upto = np.cumsum(sizes)
        shift = np.repeat(self.begin[rows] - (upto - sizes), sizes)
        return self.flat[shift + np.arange(len(shift))]


class Names:
    """The bytes of all tokens, one after another."""

    def __init__(self, path: str):
        names = {number: name for name, number in ranks_of(path).items()}
        known = [names.get(n, b"") for n in range(max(names) + 1)]
        self.bytes = np.frombuffer(b"".join(known), dtype=np.uint8)
        self.size = np.array([len(x) for x in known], dtype=np.int64)
        self.begin = np.cumsum(self.size) - self.size

    def decode(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bytes of some ids, and after how many bytes each of them ends."""
        if len(ids) and (ids.min() < 0 or ids.max() >= len(self.size) or not self.size[ids].all()):
            raise ValueError("an id that the vocabulary does not have")
        size = self.size[ids]
        upto = np.cumsum(size)
        shift = np.repeat(self.begin[ids] - (upto - size), size)
        return self.bytes[shift + np.arange(len(shift))], upto


class LiveText:
    """An encoded text that can be edited: words that an edit cannot reach keep their
    tokens."""

    def __init__(self, codec: Codec, text: str):
        self.codec, self.text = codec, ""
        self.words: list[str] = []
        self.ids: list[list[int]] = []
        self.edit(0, 0, text)

    def _words(self, text: str) -> list[str]:
        raw = text.encode("utf-8")
        return [raw[a:b].decode() for a, b in pairwise(word_borders(text, raw))] if raw else []

    def edit(self, begin: int, end: int, put: str) -> int:
        """Puts ``put`` in place of the characters from ``begin`` to ``end``; returns how
        many words were encoded anew.

        A word's end depends on two characters behind it at most, or on the run of
        white space it begins; so words that end two or more before the edit, and are
        not white space next to it, stay. Behind the edit words are cut anew until one
        begins where one began before, with two more known after it: from there on the
        cuts depend on the same characters as before.
        """
        edges = np.concatenate([[0], np.cumsum([len(w) for w in self.words], dtype=np.int64)])
        low = int(np.searchsorted(edges, begin - 2, side="right")) - 1
        low = max(low, 0)
        while low and (self.words[low].isspace() or self.words[low - 1].isspace()):
            low -= 1
        begins = int(edges[low])
        shift = len(put) - (end - begin)
        self.text = self.text[:begin] + put + self.text[end:]
        known = {int(e) + shift: n for n, e in enumerate(edges.tolist()) if e >= end}
        reach = 64
        while True:
            stop = min(len(self.text), begin + len(put) + reach)
            fresh = self._words(self.text[begins:stop])
            at, kept, high = begins, len(fresh), len(self.words)
            trusted = len(fresh) if stop == len(self.text) else len(fresh) - 3
            for n in range(trusted):
                if at > begin + len(put) and at in known:
                    kept, high = n, known[at]
                    break
                at += len(fresh[n])
            else:
                if stop < len(self.text):
                    reach *= 4
                    continue
            break
        new = fresh[:kept]
        self.words[low:high] = new
        self.ids[low:high] = [self.codec.word(w.encode()) for w in new]
        return len(new)

    def tokens(self) -> list[int]:
        return [i for word in self.ids for i in word]


@cache
def codec_of(path: str) -> Codec:
    return Codec(path)


@cache
def names_of(path: str) -> Names:
    return Names(path)


def _encoded(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = codec_of(path)
        for batch in batches:
            for at, to in spans(batch.column("text"), TEXT_BYTES):
                some = batch.slice(at, to - at)
                ids = codec.encode(some.column("text").to_pylist())
                edge = np.cumsum([0, *map(len, ids)]).astype(np.int32)
                flat = np.concatenate(ids) if ids else np.zeros(0, dtype=np.int32)
                lists = pa.ListArray.from_arrays(pa.array(edge), pa.array(flat, pa.int32()))
                yield pa.RecordBatch.from_arrays([some.column("key"), lists], ["key", "ids"])

    return settled(run)


def _decoded(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = names_of(path)
        for batch in batches:
            lengths = batch.column("ids").value_lengths().fill_null(0).to_numpy().astype(np.int64)
            cuts = np.flatnonzero(np.diff(np.cumsum(lengths) // IDS_AT_ONCE)) + 1
            for at, to in pairwise([0, *cuts.tolist(), batch.num_rows]):
                some = batch.slice(at, to - at)
                lists = some.column("ids")
                data, upto = names.decode(lists.flatten().to_numpy())
                rows = np.concatenate([[0], np.cumsum(lengths[at:to])])
                edge = np.concatenate([[0], upto])[rows].astype(np.int64)
                texts = pa.Array.from_buffers(
                    pa.large_binary(), to - at, [None, pa.py_buffer(edge), pa.py_buffer(data)]
                )
                texts = pc.if_else(lists.is_valid(), texts, pa.scalar(None, pa.large_binary()))
                yield pa.RecordBatch.from_arrays(
                    [*some.columns, texts.cast(pa.binary())], [*some.schema.names, "data"]
                )

    return settled(run)


def bpe_encode(docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key and ids (array of int) for every row: the words of the public pattern, each
    encoded by the ranks in ``tokenizer`` as the library does, without special tokens.

    Null texts count as empty and have no ids; null and repeated keys stay; no rows in,
    no rows out; other columns are not carried. One narrow pass. A word of any length
    is encoded whole, in time that grows with its length alone.
    """
    ship(docs.sparkSession)
    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key).alias("key"), or_empty(F.col(text)).alias("text"))
    out = rows.mapInArrow(_encoded(tokenizer), f"key {kind}, ids array<int>")
    return out.withColumnRenamed("key", key)


def bpe_decode(rows: DataFrame, tokenizer: str, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """key, ids and data, the bytes of the tokens one after another. Null ids give null,
    none give no bytes, an id that the file does not have fails the job."""
    ship(rows.sparkSession)
    kind = rows.schema[key].dataType.simpleString()
    given = rows.select(F.col(key).alias("key"), F.col(ids).alias("ids"))
    out = given.mapInArrow(_decoded(tokenizer), f"key {kind}, ids array<int>, data binary")
    return out.withColumnRenamed("key", key)
