"""Fill-in-middle: texts cut at line borders that a Fenwick tree over blocks finds."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstream.llm.common import or_empty, settled, ship, spans, string_bytes

BLOCK_BYTES = 4096
NEWLINE = 10
MARKS = ("<P>", "<S>", "<M>")  # prefix, suffix, middle
PLAIN, PSM, SPM = "plain", "psm", "spm"


class Fenwick:
    """Lines that end and code points that begin in fixed blocks of a text, as partial
    sums: node i, from 1 on, holds the sums of the last i & -i blocks up to block i."""

    def __init__(self, data: np.ndarray, block: int = BLOCK_BYTES):
        self.data, self.block = data, block
        starts = np.arange(0, len(data), block)
        ends = np.add.reduceat(data == NEWLINE, starts, dtype=np.int64) if len(data) else starts
        points = np.add.reduceat(leads(data), starts, dtype=np.int64) if len(data) else starts
        node = np.arange(1, len(starts) + 1)
        below = node - (node & -node)
        upto = np.concatenate([[0], np.cumsum(ends)])
        self.lines = [0, *(upto[node] - upto[below]).tolist()]
        self.newlines = int(upto[-1])
        upto = np.concatenate([[0], np.cumsum(points)])
        self.points = [0, *(upto[node] - upto[below]).tolist()]
        self.n_points = int(upto[-1])
        self.n_lines = self.newlines + int(len(data) > 0 and data[-1] != NEWLINE)

    def cut(self, lines: int) -> tuple[int, int]:
        """Bytes and code points of the first ``lines`` lines."""
        if lines == 0:
            return 0, 0
        if lines > self.newlines:
            return len(self.data), self.n_points
        # Binary lifting: the most blocks before which fewer lines end.
        at, points, left = 0, 0, lines
        step = 1 << (len(self.lines) - 1).bit_length()
        while step:
            to = at + step
            if to < len(self.lines) and self.lines[to] < left:
                at, left, points = to, left - self.lines[to], points + self.points[to]
            step >>= 1
        begin = at * self.block
        found = np.flatnonzero(self.data[begin : begin + self.block] == NEWLINE)
        end = begin + int(found[left - 1]) + 1
        return end, points + int(np.count_nonzero(leads(self.data[begin:end])))


def leads(data: np.ndarray) -> np.ndarray:
    """Whether a code point begins at each byte of UTF-8."""
    return (data & 0xC0) != 0x80


def _arranged(marks: tuple[bytes, bytes, bytes], block: int):
    prefix_mark, suffix_mark, middle_mark = marks

    def one(text: bytes, data: np.ndarray, form: str, first: int, second: int) -> tuple:
        tree = Fenwick(data, block)
        n = tree.n_lines
        if form == PLAIN:
            return n, None, None, text
        low, high = sorted((first % (n + 1), second % (n + 1)))
        (a, before), (b, upto) = tree.cut(low), tree.cut(high)
        prefix, middle, suffix = text[:a], text[a:b], text[b:]
        if form == PSM:
            parts = prefix_mark, prefix, suffix_mark, suffix, middle_mark, middle
        else:
            parts = suffix_mark, suffix, prefix_mark, prefix, middle_mark, middle
        return n, before, upto - before, b"".join(parts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, to in spans(batch.column("text")):
                some = batch.slice(at, to - at)
                raw, edge = string_bytes(some.column("text"))
                data = np.frombuffer(raw, dtype=np.uint8)
                plans = zip(*(some.column(c).to_pylist() for c in ("form", "h1", "h2")), strict=True)
                out = [
                    one(raw[a:b], data[a:b], *plan)
                    for a, b, plan in zip(edge[:-1], edge[1:], plans, strict=True)
                ]
                n, before, middle, texts = zip(*out, strict=True) if out else ((),) * 4
                yield pa.RecordBatch.from_arrays(
                    [
                        some.column("key"),
                        pa.array(n, pa.int64()),
                        some.column("form"),
                        pa.array(before, pa.int64()),
                        pa.array(middle, pa.int64()),
                        pa.array(texts, pa.binary()).view(pa.string()),
                    ],
                    ["key", "n", "form", "prefix_chars", "middle_chars", "output"],
                )

    return settled(run)


def draws(seed: int, key: Column) -> list[Column]:
    """The first four 8-digit groups of the hex SHA-256 of ``seed:key``, as integers."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("")))
    digest = F.sha2(name.cast("binary"), 256)
    return [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long") for k in range(4)]


def _tell_apart(marks: tuple[str, ...]) -> bool:
    """Whether no mark lies in another one or begins with what some mark ends with."""
    inside = any(a in b for i, a in enumerate(marks) for j, b in enumerate(marks) if i != j)
    meet = any(a.endswith(b[:n]) for a in marks for b in marks for n in range(1, min(len(a), len(b))))
    return len(marks) == 3 and all(marks) and not inside and not meet


def fill_in_middle(
    docs: DataFrame,
    rate: int = 100,
    spm_rate: int = 50,
    seed: int = 7,
    marks: tuple[str, str, str] = MARKS,
    key: str = "doc_id",
    text: str = "text",
    block: int = BLOCK_BYTES,
) -> DataFrame:
    """One row per row of ``docs``: key, n (lines), form, prefix_chars, middle_chars
    (code points) and output, the arranged text.

    Lines are the units; an end without line feed is one too. The draws of the key and
    ``seed`` say where the middle begins and ends, whether the text stays plain (all but
    ``rate`` of 100 do) and whether the suffix goes first (``spm_rate`` of 100). Empty
    and null texts (n = 0) and texts that hold a mark stay plain, with null lengths and
    their text as output. A null key draws as the empty text; rows with equal keys draw
    alike; no rows in, no rows out. Other columns are not carried. One narrow pass: a
    text's blocks are counted once, then each cut is found in logarithmic time and
    looked up inside one block. ``restored`` gives the text back.
    """
    if not _tell_apart(marks):
        raise ValueError("marks must be three texts, no beginning of one an end of another")
    clean = or_empty(F.col(text))
    h1, h2, h3, h4 = draws(seed, F.col(key))
    marked = clean.contains(marks[0]) | clean.contains(marks[1]) | clean.contains(marks[2])
    form = (
        F.when((clean == "") | marked | (h3 % 100 >= rate), PLAIN)
        .when(h4 % 100 < spm_rate, SPM)
        .otherwise(PSM)
    )
    kind = docs.schema[key].dataType.simpleString()
    ship(docs.sparkSession)
    rows = docs.select(
        F.col(key).alias("key"), clean.alias("text"), form.alias("form"), h1.alias("h1"), h2.alias("h2")
    )
    out = rows.mapInArrow(
        _arranged(tuple(m.encode() for m in marks), block),
        f"key {kind}, n long, form string, prefix_chars long, middle_chars long, output string",
    )
    return out.withColumnRenamed("key", key)


def restored(output: Column, form: Column, marks: tuple[str, str, str] = MARKS) -> Column:
    """The text that ``output`` was made of. No mark can arise where parts meet, since
    none of its beginnings ends another, so the text falls apart at its three marks."""
    parts = F.split(output, "|".join(r"\Q" + m + r"\E" for m in marks), -1)
    return (
        F.when(form == PSM, F.concat(F.get(parts, F.lit(1)), F.get(parts, F.lit(3)), F.get(parts, F.lit(2))))
        .when(form == SPM, F.concat(F.get(parts, F.lit(2)), F.get(parts, F.lit(3)), F.get(parts, F.lit(1))))
        .otherwise(output)
    )
