"""Line dedup: fuzzy lines by MinHash, verified, one line kept per component."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstream.llm.common import kept_safe, or_empty, settled, ship, small_side
from tillstream.llm.components import components
from tillstream.llm.simhash import Groups
from tillstream.llm.transducer import settle

SHINGLE = 8  # characters, a power of two
SIMILARITY = 0.8
BANDS, BAND_ROWS = 6, 3
BLOCK = 256
CALL_ROWS = 2000
COLUMNS = 4096
FEW = 12
SPAN_CHARS = 1 << 21
STEP_CHARS = 1 << 15  # keeps a step's arrays in the processor's cache
EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def line_list(text: Column) -> Column:
    return F.split(or_empty(text), "\n", -1)


def line_id(line: Column) -> Column:
    return F.xxhash64(line)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


def _shingle_hashes(points: np.ndarray) -> np.ndarray:
    """64-bit hash of every run of ``SHINGLE`` code points: a polynomial, put together
    from those of runs half as long."""
    total, width, factor = points.astype(np.uint64), 1, MULTIPLIER
    with np.errstate(over="ignore"):
        while width < SHINGLE:
            total = total[:-width] * factor + total[width:]
            width, factor = 2 * width, factor * factor
    return _mixed(total)


def band_hashes(lines: list[str]) -> np.ndarray:
    """(lines, BANDS) band hashes, some lines at a time."""
    return np.concatenate([_bands(lines[a:b]) for a, b in steps(lines)])


def steps(lines: list[str]) -> Iterator[tuple[int, int]]:
    """Ranges of lines with about ``STEP_CHARS`` characters each, one line at least."""
    sizes = np.cumsum([len(x) for x in lines])
    cuts = (np.flatnonzero(np.diff(sizes // STEP_CHARS)) + 1).tolist()
    return pairwise([0, *cuts, len(lines)])


def _hashed(lines: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all shingles of all lines, none across two lines, and their lines."""
    points = np.frombuffer("".join(lines).encode("utf-32-le", "replace"), dtype=np.uint32)
    sizes = np.array([len(x) for x in lines], dtype=np.int64)
    hashes = _shingle_hashes(points)
    owner = np.repeat(np.arange(len(lines)), sizes)[: len(hashes)]
    inside = np.arange(len(hashes)) <= np.cumsum(sizes)[owner] - SHINGLE
    return hashes[inside], owner[inside]


def _bands(lines: list[str]) -> np.ndarray:
    """(lines, BANDS) hashes of MinHash bands. One hash per shingle: its upper part
    picks one of BANDS * BAND_ROWS bins, each bin keeps its least value; an empty bin
    takes its right neighbour's."""
    bins = BANDS * BAND_ROWS
    hashes, owner = _hashed(lines)
    spot = ((hashes >> np.uint64(32)) * np.uint64(bins)) >> np.uint64(32)
    least = np.full(len(lines) * bins, EMPTY)
    # Halves swapped: the order inside a bin does not follow from the bin.
    value = (hashes << np.uint64(32)) | (hashes >> np.uint64(32))
    np.minimum.at(least, owner * bins + spot.astype(np.int64), value)
    least = least.reshape(len(lines), bins)
    for _ in range(bins):
        hollow = least == EMPTY
        if not hollow.any():
            break
        least = np.where(hollow, np.roll(least, -1, axis=1), least)
    grouped = least.reshape(len(lines), BANDS, BAND_ROWS)
    total = np.zeros((len(lines), BANDS), dtype=np.uint64)
    for row in range(BAND_ROWS):
        total = _mixed(total * MULTIPLIER + grouped[:, :, row])
    return _mixed(total + np.arange(1, BANDS + 1, dtype=np.uint64))


def shingle_sets(lines: list[str]) -> list[np.ndarray]:
    """The sorted set of shingle hashes of each line of ``SHINGLE`` characters or more."""
    out: list[np.ndarray] = []
    for a, b in steps(lines):
        hashes, owner = _hashed(lines[a:b])
        edge = np.searchsorted(owner, np.arange(b - a + 1))
        for lo, hi in pairwise(edge.tolist()):
            hashes[lo:hi].sort()
        new = np.ones(len(hashes), dtype=bool)
        new[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
        hashes, owner = hashes[new], owner[new]
        edge = np.searchsorted(owner, np.arange(b - a + 1)).tolist()
        out += [hashes[lo:hi] for lo, hi in pairwise(edge)]
    return out


def jaccard(a: np.ndarray, b: np.ndarray) -> float:
    """Of two sorted sets."""
    both = int((a[np.minimum(np.searchsorted(a, b), len(a) - 1)] == b).sum())
    return both / (len(a) + len(b) - both)


def alike(sets: list[np.ndarray], similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of a bounded number of sets that are similar enough."""
    sizes = np.array([len(x) for x in sets])
    if len(sets) <= FEW:
        pairs = [
            (i, j)
            for i in range(len(sets))
            for j in range(i + 1, len(sets))
            if jaccard(sets[i], sets[j]) >= similarity
        ]
        found = np.array(pairs, dtype=np.int64).reshape(-1, 2)
        return found[:, 0], found[:, 1]
    owner = np.repeat(np.arange(len(sets)), sizes)
    _, column = np.unique(np.concatenate(sets), return_inverse=True)
    both = np.zeros((len(sets), len(sets)))
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    for at in range(0, int(column[-1]) + 1, COLUMNS):
        lo, hi = np.searchsorted(column, [at, at + COLUMNS])
        held = np.zeros((len(sets), COLUMNS), dtype=np.float32)
        held[owner[lo:hi], column[lo:hi] - at] = 1.0
        both += held @ held.T
    near = both / (sizes[:, None] + sizes[None, :] - both) >= similarity
    return np.nonzero(np.triu(near, 1))


def _signed(docs: DataFrame, key: str, text: str, shortest: int) -> DataFrame:
    """(key, mark, pos, line, bands) for every line of ``shortest`` characters or more;
    line is its hash. A line without a shingle has no bands: only equal ones match it."""
    ship(docs.sparkSession)
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh64_intdigest

        def flush(rows, spots, lines):
            able = np.array([len(x) >= SHINGLE for x in lines])
            edges = np.concatenate([[0], np.cumsum(able * BANDS)])
            shingled = [x for x in lines if len(x) >= SHINGLE]
            bands = band_hashes(shingled).view(np.int64).ravel() if shingled else np.zeros(0, np.int64)
            ids = [xxh64_intdigest(x.encode("utf-8"), 42) for x in lines]
            spot = pa.array(rows, pa.int64())
            return pa.RecordBatch.from_arrays(
                [
                    batch.column("key").take(spot),
                    batch.column("mark").take(spot),
                    pa.array(spots, pa.int32()),
                    pa.array(np.array(ids, dtype=np.uint64).view(np.int64)),
                    pa.ListArray.from_arrays(pa.array(edges, pa.int32()), pa.array(bands)),
                ],
                ["key", "mark", "pos", "line", "bands"],
            )

        settle()
        for batch in batches:
            rows, spots, lines, held = [], [], [], 0
            for row, value in enumerate(batch.column("text")):
                for pos, line in enumerate(value.as_py().split("\n")):
                    if len(line) >= shortest:
                        rows.append(row)
                        spots.append(pos)
                        lines.append(line)
                        held += len(line)
                if held > SPAN_CHARS:
                    yield flush(rows, spots, lines)
                    rows, spots, lines, held = [], [], [], 0
            if lines:
                yield flush(rows, spots, lines)

    given = docs.select(
        F.col(key).alias("key"),
        F.xxhash64(or_empty(F.col(text))).alias("mark"),
        or_empty(F.col(text)).alias("text"),
    )
    return given.mapInArrow(settled(run), f"key {kind}, mark long, pos int, line long, bands array<long>")


def _texts(docs: DataFrame, wanted: DataFrame, n_wanted: int, text: str) -> DataFrame:
    """(line, words) for the wanted lines: one copy of each line's text."""
    every = docs.select(F.explode(line_list(F.col(text))).alias("words"))
    long_ones = every.filter(F.char_length("words") >= SHINGLE)
    named = long_ones.select(line_id(F.col("words")).alias("line"), "words")
    picked = named.join(small_side(wanted, n_wanted), "line", "left_semi")
    return kept_safe(picked.groupBy("line").agg(F.first("words").alias("words")))


def _judged(pairs: list[tuple[str, str]], similarity: float) -> list[bool]:
    spot = {x: i for i, x in enumerate({x for pair in pairs for x in pair})}
    sets = shingle_sets(list(spot)) if spot else []
    return [jaccard(sets[spot[x]], sets[spot[y]]) >= similarity for x, y in pairs]


def _verified(pairs: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """Pairs (a, b) with ``near``: whether their Jaccard similarity is high enough."""
    left = texts.select(F.col("line").alias("a"), F.col("words").alias("one"))
    right = texts.select(F.col("line").alias("b"), F.col("words").alias("two"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            near, some, held = [], [], 0
            for one, two in zip(batch.column("one"), batch.column("two"), strict=True):
                some.append((one.as_py(), two.as_py()))
                held += len(some[-1][0]) + len(some[-1][1])
                if held > SPAN_CHARS:
                    near += _judged(some, similarity)
                    some, held = [], 0
            near += _judged(some, similarity)
            yield pa.RecordBatch.from_arrays(
                [batch.column("a"), batch.column("b"), pa.array(near, pa.bool_())],
                ["a", "b", "near"],
            )

    joined = pairs.join(left, "a").join(right, "b").select("a", "b", "one", "two")
    return joined.mapInArrow(settled(run), "a long, b long, near boolean")


def line_components(
    docs: DataFrame, key: str, text: str, similarity: float = SIMILARITY, shortest: int = 1
) -> tuple[DataFrame, DataFrame]:
    """(occurrences, components): every judged line (key, mark, pos, line) and, for
    lines similar to a different one, (node, component) by line hash."""
    signed = kept_safe(_signed(docs, key, text, max(1, shortest)))
    banded = signed.select(F.explode("bands").alias("band"), "line")
    # Per band the least and greatest line: reduced inside the map tasks, so repeated
    # lines and large buckets shrink before they move.
    buckets = kept_safe(
        banded.groupBy("band")
        .agg(F.min("line").alias("head"), F.max("line").alias("tail"))
        .filter("head <> tail")
    )
    n_buckets = buckets.count()
    members = kept_safe(
        banded.join(small_side(buckets.select("band", "head"), n_buckets), "band").distinct()
    )
    pairs = kept_safe(
        members.filter("line <> head")
        .select(F.least("line", "head").alias("a"), F.greatest("line", "head").alias("b"))
        .distinct()
    )
    wanted = kept_safe(
        pairs.select(F.col("a").alias("line")).union(pairs.select(F.col("b").alias("line"))).distinct()
    )
    texts = _texts(docs, wanted, wanted.count(), text)
    checked = kept_safe(_verified(pairs, texts, similarity))
    edges = checked.filter("near").select(F.col("a").alias("src"), F.col("b").alias("dst"))
    refused = checked.filter("not near").select("a", "b")
    # A bucket whose lines all resemble its head is connected. In the others any two
    # lines may still resemble each other: all of them are compared, in blocks.
    mixed = kept_safe(
        members.filter("line <> head")
        .select("band", F.least("line", "head").alias("a"), F.greatest("line", "head").alias("b"))
        .join(refused, ["a", "b"], "left_semi")
        .select("band")
        .distinct()
    )
    rest = members.join(mixed, "band", "left_semi").select("band", "line")
    sizes = kept_safe(
        rest.groupBy("band").agg(F.count("*").alias("n")).filter("n > 2").withColumn(
            "blocks", F.ceil(F.col("n") / BLOCK)
        )
    )
    dealt = (
        rest.join(small_side(sizes, sizes.count()), "band")
        .withColumn("block", F.pmod(F.xxhash64("line"), "blocks"))
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
        .select(
            "band", F.least("block", "other").alias("low"),
            F.greatest("block", "other").alias("high"), "line",
        )
        .join(texts, "line")
    )

    def compare(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["band", "low", "high"])
        spot = frame[["band", "low", "high"]].to_numpy(np.int64)
        edge = (np.flatnonzero((spot[1:] != spot[:-1]).any(axis=1)) + 1).tolist()
        ids, groups = frame["line"].to_numpy(np.int64), Groups(len(frame))
        once, spots = np.unique(ids, return_inverse=True)
        words = frame["words"].to_numpy()
        first = np.zeros(len(once), dtype=np.int64)
        first[spots] = np.arange(len(ids))
        known = shingle_sets([words[i] for i in first])
        sets = [known[i] for i in spots]
        for a, b in pairwise([0, *edge, len(ids)]):
            one, two = alike(sets[a:b], similarity)
            groups.join(one + a, two + a)
        moved = groups.label != np.arange(len(ids))
        return pd.DataFrame({"src": ids[moved], "dst": ids[groups.label[moved]]})

    # Many small buckets share a call.
    calls = sizes.agg(F.sum(F.col("n") * F.col("blocks"))).first()[0] or 0
    part = F.pmod(F.xxhash64("band", "low", "high"), F.lit(1 + int(calls) // CALL_ROWS))
    others = dealt.groupBy(part.alias("part")).applyInPandas(compare, "src long, dst long")
    linked = kept_safe(components(edges.union(others)))
    return signed.drop("bands"), linked


def duplicate_lines(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    similarity: float = SIMILARITY,
    shortest: int = 1,
) -> DataFrame:
    """One row per line of ``shortest`` characters or more, by default every line that
    is not empty: key, mark (hash of the document's text), pos (from 0), line_id,
    component_id, kept.

    Lines are split at newlines. Lines with the same text, or with a Jaccard similarity
    of ``similarity`` or more between their sets of ``SHINGLE``-character shingles
    (candidates by MinHash bands: 98.7 % recall at 0.8, more above; all candidates
    verified), are one component; of a component the occurrence with the smallest
    (key, mark, pos) is kept, null keys last. Documents equal in key and text share
    their rows, marked alike. A line of fewer than ``SHINGLE`` characters has no
    shingle and is like equal lines only. Empty lines, and so null and empty texts, are
    not listed: they stay, as do lines shorter than ``shortest``. An empty table gives an empty result.
    line_id is a 64-bit hash, by which equal lines are told.
    """
    lines, linked = line_components(docs, key, text, similarity, shortest)
    place = F.struct(F.col("key").isNull().alias("none"), "key", "mark", "pos")
    firsts = kept_safe(lines.groupBy("line").agg(F.min(place).alias("first")))
    rooted = firsts.join(linked, firsts["line"] == linked["node"], "left").select(
        "line", "first", F.coalesce("component", "line").alias("root")
    )
    rooted = kept_safe(rooted)
    heads = kept_safe(rooted.groupBy("root").agg(F.min("first").alias("keep")))
    chosen = kept_safe(rooted.join(heads, "root").select("line", "root", "keep"))
    return lines.join(chosen, "line").select(
        F.col("key").alias(key),
        "mark",
        "pos",
        F.col("line").alias("line_id"),
        F.col("root").alias("component_id"),
        (
            F.col("key").eqNullSafe(F.col("keep.key"))
            & (F.col("mark") == F.col("keep.mark"))
            & (F.col("pos") == F.col("keep.pos"))
        ).alias("kept"),
    )


def without_duplicate_lines(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    similarity: float = SIMILARITY,
    shortest: int = 1,
) -> DataFrame:
    """``docs`` with all columns, their text without the lines that are not kept.

    Every row stays, also one whose lines all go (its text is then empty). A text
    without dropped lines, or null, is unchanged, and so is every other column, whatever
    its name. An empty table gives an empty one.
    """
    marked = duplicate_lines(docs, key, text, similarity, shortest)
    gone = kept_safe(
        marked.filter("not kept")
        .select(F.col(key).alias("_key"), F.col("mark").alias("_mark"), "pos")
        .distinct()
        .groupBy("_key", "_mark")
        .agg(F.collect_list("pos").alias("_gone"))  # positions in one document
    )
    rows = docs.select(F.struct("*").alias("_row"), F.col(text).alias("_text"), F.col(key).alias("_id"))
    rows = rows.withColumn("_sum", F.xxhash64(or_empty(F.col("_text"))))
    same = F.col("_id").eqNullSafe(F.col("_key")) & (F.col("_sum") == F.col("_mark"))
    joined = rows.join(small_side(gone, gone.count()), same, "left")

    def left(lines: Column) -> Column:
        # Bound once as a variable of the lambda; a set of positions is taken away.
        stay = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("_gone"))
        return F.array_join(F.transform(stay, lambda i: F.get(lines, i)), "\n")

    rest = F.get(F.transform(F.array(line_list(F.col("_text"))), left), 0)
    cleaned = joined.withColumn(
        "_clean", F.when(F.col("_gone").isNull(), F.col("_text")).otherwise(rest)
    )
    return cleaned.select(
        *[F.col("_clean" if c == text else f"_row.`{c}`").alias(c) for c in docs.columns]
    )
