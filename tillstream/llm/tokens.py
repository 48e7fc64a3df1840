"""Token counts by a byte-level BPE tokenizer compiled to a counting transducer."""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstream.llm.common import or_empty, ship
from tillstream.llm.transducer import (
    SPACE,
    Transducer,
    classes,
    machine_of,
    read_words,
    split_contractions,
)

SPAN_BYTES = 2 << 20


def word_starts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a text and, for each, whether a word of the public pattern
    (contractions, letters, numbers, others, each with one space before; white
    space apart) begins there."""
    raw = text.encode("utf-8")
    data = np.frombuffer(raw, dtype=np.uint8)
    if not len(data):
        return data, np.zeros(0, dtype=bool)
    points = (
        data.astype(np.uint32)
        if len(raw) == len(text)
        else np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)
    )
    kind = classes()[points]
    n = len(points)
    start = np.ones(n, dtype=bool)
    start[1:] = kind[1:] != kind[:-1]
    # The last character of a white-space run before other text is a word of its own,
    # or, if it is a plain space, the beginning of the next word.
    last = np.zeros(n, dtype=bool)
    last[:-1] = (kind[:-1] == SPACE) & (kind[1:] != SPACE)
    start |= last
    joins = last & (points == 32)
    start[1:] &= ~joins[:-1]
    split_contractions(points, start)
    if n == len(data):
        return data, start
    flags = np.zeros(len(data), dtype=bool)
    flags[(data & 0xC0) != 0x80] = start
    return data, flags


def count_tokens(texts: list[str], machine: Transducer) -> np.ndarray:
    """Tokens of each text."""
    parts = [word_starts(t) for t in texts]
    if not parts:
        return np.zeros(0, dtype=np.int64)
    data = np.concatenate([p[0] for p in parts])
    emitted, _ = read_words(machine, data, np.concatenate([p[1] for p in parts]))
    sums = np.concatenate([[0], np.cumsum(emitted, dtype=np.int64)])
    edge = np.concatenate([[0], np.cumsum([len(p[0]) for p in parts])])
    return sums[edge[1:]] - sums[edge[:-1]]


def _counted(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = machine_of(path)
        for batch in batches:
            lists = batch.column("pieces")
            texts = lists.flatten()
            cuts = np.flatnonzero(np.diff(np.cumsum(_sizes(texts)) // SPAN_BYTES)) + 1
            counts, at = [np.zeros(1, dtype=np.int64)], 0
            for cut in [*cuts.tolist(), len(texts)]:
                counts.append(count_tokens(texts.slice(at, cut - at).to_pylist(), machine))
                at = cut
            upto = np.cumsum(np.concatenate(counts))
            edge = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy())])
            per_text = upto[edge[1:]] - upto[edge[:-1]] + lists.value_lengths().to_numpy() - 1
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), batch.column("n_bytes"), pa.array(per_text, pa.int64())],
                ["key", "n_bytes", "n_tokens"],
            )

    return run


def _sizes(texts: pa.Array) -> np.ndarray:
    return pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)


def token_counts(
    docs: DataFrame, tokenizer: str, limit: int, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """key, n_bytes, n_tokens (long) and over_limit for every row.

    Counts equal those of the library for the file ``tokenizer`` (byte-level BPE with
    the public word pattern). A special string in a text splits it and counts as one
    token, as is the library's default. Null texts count as empty, with no tokens;
    null or repeated keys are kept; no rows in, no rows out. One narrow pass, no shuffle; texts are read in
    spans of about ``SPAN_BYTES``, a long one alone.
    """
    with open(tokenizer, encoding="utf-8") as file:
        special = [t["content"] for t in json.load(file).get("added_tokens", [])]
    clean = or_empty(F.col(text))
    marks = "|".join(r"\Q" + mark + r"\E" for mark in special)
    pieces = F.split(clean, marks, -1) if special else F.array(clean)
    ship(docs.sparkSession)
    kind = docs.schema[key].dataType.simpleString()
    out = docs.select(
        F.col(key).alias("key"),
        F.octet_length(clean).cast("long").alias("n_bytes"),
        pieces.alias("pieces"),
    ).mapInArrow(_counted(tokenizer), f"key {kind}, n_bytes long, n_tokens long")
    return out.select(
        F.col("key").alias(key), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")
    )
