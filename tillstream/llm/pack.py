"""Packing: all documents as one stream of token ids, cut into sequences."""

from __future__ import annotations

import json
import unicodedata
import zlib
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstream.llm.common import (
    arrow_batches,
    kept_safe,
    or_empty,
    running_totals,
    settled,
    ship,
    small_side,
    spans,
)
from tillstream.llm.transducer import (
    NUMBER,
    SPACE,
    classes,
    lower_cases,
    machine_of,
    read_words,
    split_contractions,
    token_ids,
)

WIDTH = 4096
END_ID = 2
SPAN_BYTES = 1 << 20
BATCH_BYTES = 2 << 20

IDS = "key {key}, part int, before long, doc_tokens long, ids binary"
PIECES = (
    "key {key}, start long, length long, ids_crc32 long, doc_tokens long, "
    "sequence_id long, offset long, ids binary"
)


class WordIds:
    """Token ids of texts, equal to the library's, by the compiled vocabulary.

    For tokenizers that compose characters, put them in lower case, drop white space
    and mark ends of words. A text that holds a special string goes to the library.
    """

    def __init__(self, path: str):
        self.path, self.machine = path, machine_of(path)
        with open(path, encoding="utf-8") as file:
            self.special = [t["content"] for t in json.load(file).get("added_tokens", [])]

    @cached_property
    def tokenizer(self):
        from tokenizers import Tokenizer

        return Tokenizer.from_file(self.path)

    def encode(self, texts: list[str]) -> list[bytes]:
        own = [None if any(s in t for s in self.special) else t for t in texts]
        parts = [_words("" if t is None else t) for t in own]
        data = np.concatenate([p[0] for p in parts])
        first = np.concatenate([p[1] for p in parts])
        emitted, states = read_words(self.machine, data, first)
        ids = token_ids(self.machine, data, first, states, emitted).astype("<u4")
        sums = np.concatenate([[0], np.cumsum(emitted, dtype=np.int64)])
        edge = sums[np.concatenate([[0], np.cumsum([len(p[0]) for p in parts])])]
        out = [ids[a:b].tobytes() for a, b in zip(edge[:-1], edge[1:], strict=True)]
        for i, text in enumerate(own):
            if text is None:
                whole = self.tokenizer.encode(texts[i], add_special_tokens=False).ids
                out[i] = np.array(whole, dtype="<u4").tobytes()
        return out


def _words(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Symbols of a text without white space, and whether a word begins at each: letter
    runs, single numbers, runs of other characters, contractions."""
    if not text.isascii() and not unicodedata.is_normalized("NFC", text):
        text = unicodedata.normalize("NFC", text)
    # Each character by itself: a final sigma is no special case.
    text = text.replace("\u03a3", "\u03c3")
    if not text.isascii():
        others, low = lower_cases()
        text = others.sub(lambda found: low[found[0]], text)
    text = text.lower()
    raw = text.encode("utf-8")
    data = np.frombuffer(raw, dtype=np.uint8)
    if not len(data):
        return data.astype(np.int16), np.zeros(0, dtype=bool)
    plain = len(raw) == len(text)
    points = (
        data.astype(np.uint32)
        if plain
        else np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)
    )
    kind = classes()[points]
    start = np.ones(len(points), dtype=bool)
    start[1:] = (kind[1:] != kind[:-1]) | (kind[1:] == NUMBER)
    split_contractions(points, start)
    inside = kind != SPACE
    if not plain:
        leads = (data & 0xC0) != 0x80
        flags = np.zeros(len(data), dtype=bool)
        flags[leads] = start
        start, inside = flags, inside[np.cumsum(leads) - 1]
    final = np.append(start[1:], True)
    return (data.astype(np.int16) + 256 * final)[inside], start[inside]


def _encoded(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, part, before = WordIds(path), TaskContext.get().partitionId(), 0
        end = np.array([END_ID], dtype="<u4").tobytes()
        for batch in batches:
            for at, to in spans(batch.column("text"), SPAN_BYTES):
                some = batch.slice(at, to - at)
                ids = [x + end for x in words.encode(some.column("text").to_pylist())]
                counts = [len(x) // 4 for x in ids]
                starts = np.concatenate([[0], np.cumsum(counts)]).astype("int64") + before
                before = int(starts[-1])
                yield pa.RecordBatch.from_arrays(
                    [
                        some.column("key"),
                        pa.array([part] * len(ids), pa.int32()),
                        pa.array(starts[:-1], pa.int64()),
                        pa.array(counts, pa.int64()),
                        pa.array(ids, pa.binary()),
                    ],
                    ["key", "part", "before", "doc_tokens", "ids"],
                )

    return settled(run)


def _cut(width: int, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, rows, out = batch.column("key"), [], []
            places = batch.column("place").to_pylist()
            for row, (place, ids) in enumerate(
                zip(places, batch.column("ids").to_pylist(), strict=True)
            ):
                total, at = len(ids) // 4, 0
                while at < total:
                    sequence, offset = divmod(place + at, width)
                    length = min(width - offset, total - at)
                    piece = ids[4 * at : 4 * (at + length)]
                    rows.append(row)
                    out.append((at, length, zlib.crc32(piece), total, sequence, offset,
                                piece if with_ids else None))
                    at += length
            names = ["start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids"]
            kinds = [pa.int64()] * 6 + [pa.binary()]
            columns = list(zip(*out, strict=True)) if out else [[]] * 7
            yield pa.RecordBatch.from_arrays(
                [keys.take(pa.array(rows, pa.int64())),
                 *[pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]],
                ["key", *names],
            )

    return run


def pack(
    docs: DataFrame,
    tokenizer: str,
    width: int = WIDTH,
    key: str = "doc_id",
    text: str = "text",
    with_ids: bool = True,
) -> DataFrame:
    """Pieces of documents in sequences of ``width`` tokens: key, start, length,
    ids_crc32, doc_tokens, sequence_id, offset and, on request, the ids (binary,
    little-endian 32 bits).

    Each document is its ids and then ``END_ID``; a null or empty text is that id
    alone, so every row has a piece, also rows with null or repeated keys. Documents
    are laid end to end and the stream is cut every ``width`` ids; only the last
    sequence may be shorter. No rows in, no pieces out.

    First pass: each task encodes its documents and numbers their ids from zero; the
    ids are written to the shared folder, so a lost executor changes neither order
    nor numbers. Second pass: running totals over the tasks' sums turn these numbers
    into places in the stream, from which each document cuts its own pieces. Texts
    and ids are never shuffled, and a long document is cut like any other.
    """
    ship(docs.sparkSession)
    kind = docs.schema[key].dataType.simpleString()
    texts = docs.select(F.col(key).alias("key"), or_empty(F.col(text)).alias("text"))
    with arrow_batches(docs.sparkSession, BATCH_BYTES):
        encoded = kept_safe(texts.mapInArrow(_encoded(tokenizer), IDS.format(key=kind)))
    parts = kept_safe(encoded.groupBy("part").agg(F.sum("doc_tokens").alias("tokens")))
    starts = running_totals(parts, "part", "tokens").select("part", F.col("before").alias("base"))
    placed = encoded.join(small_side(starts, parts.count()), "part").select(
        "key", (F.col("base") + F.col("before")).alias("place"), "ids"
    )
    pieces = placed.mapInArrow(_cut(width, with_ids), PIECES.format(key=kind))
    pieces = pieces if with_ids else pieces.drop("ids")
    return pieces.withColumnRenamed("key", key)
