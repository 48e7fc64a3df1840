"""Importance resampling towards a target distribution of hashed word n-grams."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from tillstream.llm.common import (
    kept_safe,
    or_empty,
    running_totals,
    settled,
    ship,
    small_side,
    spans,
)

# ASCII but digits and letters, which are in lower case by then.
BETWEEN_WORDS = r"[\x00-\x2f\x3a-\x60\x7b-\x7f]+"
BUCKETS = 10_000
MIN_WORDS = 20
SEED = 7


def word_features(texts: pa.Array, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of all features of some texts, the row of each feature's text, and words
    per text. Features are single words and pairs of neighbours, repeats included.

    Words become numbers once, by dictionary encoding; a pair is two numbers, one the
    shifted list of the other. Only distinct words and distinct pairs are hashed (a
    pair's CRC goes on from its first word's), then taken back to where they stand.
    """
    lists = pc.split_pattern_regex(pc.ascii_lower(texts), BETWEEN_WORDS)
    coded = pc.list_flatten(lists).dictionary_encode()
    row = pc.list_parent_indices(lists).to_numpy().astype(np.int64)
    word = coded.indices.to_numpy().astype(np.int64)
    names = coded.dictionary.cast(pa.binary()).to_pylist()
    if b"" in names:  # before a first and after a last word
        real = word != names.index(b"")
        row, word = row[real], word[real]
    crc = np.array([zlib.crc32(x) for x in names], dtype=np.int64)
    ahead = [zlib.crc32(b" ", int(c)) for c in crc]
    follows = row[1:] == row[:-1]
    pair = word[:-1][follows] * max(1, len(names)) + word[1:][follows]
    distinct, place = np.unique(pair, return_inverse=True)
    lefts, rights = np.divmod(distinct, max(1, len(names)))
    pair_crc = np.fromiter(
        (zlib.crc32(names[b], ahead[a]) for a, b in zip(lefts.tolist(), rights.tolist(), strict=True)),
        dtype=np.int64,
        count=len(distinct),
    )
    found = np.concatenate([(crc % buckets)[word], (pair_crc % buckets)[place]])
    rows = np.concatenate([row, row[1:][follows]])
    return found, rows, np.bincount(row, minlength=len(texts))


def _counted(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            texts = batch.column("text")
            for at, to in spans(texts):
                found, _, _ = word_features(texts.slice(at, to - at), buckets)
                counts += np.bincount(found, minlength=buckets)
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(counts[used])], ["bucket", "n"])

    return settled(run)


def bucket_counts(docs: DataFrame, buckets: int, text: str = "text") -> np.ndarray:
    """Features per bucket over all texts. A task sums its own ones, so at most
    ``buckets`` rows a task are shuffled, and as many reach the driver."""
    ship(docs.sparkSession)
    rows = docs.select(or_empty(F.col(text)).alias("text"))
    found = rows.mapInArrow(_counted(buckets), "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(buckets, dtype=np.int64)
    for bucket, n in found.collect():
        out[bucket] = n
    return out


def bucket_gains(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of the smoothed shares of each bucket, floored."""
    n = len(raw)
    up = (target + 1).astype(np.float64) * float(raw.sum() + n)
    down = (raw + 1).astype(np.float64) * float(target.sum() + n)
    return np.floor(1000 * np.log(up / down)).astype(np.int64)


def _weighed(gains: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text")
            for at, to in spans(texts):
                found, rows, words = word_features(texts.slice(at, to - at), len(gains))
                order = np.argsort(rows, kind="stable")
                upto = np.concatenate([[0], np.cumsum(gains[found[order]])])
                size = np.bincount(rows, minlength=to - at)
                edge = np.concatenate([[0], np.cumsum(size)])
                total = upto[edge[1:]] - upto[edge[:-1]]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("key").slice(at, to - at),
                        pa.array(words.astype(np.int64)),
                        pa.array(size.astype(np.int64)),
                        pa.array(total // np.maximum(size, 1)),
                    ],
                    ["key", "n_words", "n_features", "weight"],
                )

    return settled(run)


def gumbel(seed: int, key: Column) -> Column:
    """Thousandths of a Gumbel draw that depends on seed and key alone, floored."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("")))
    number = F.conv(F.substring(F.sha2(name.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((number + 0.5) / F.lit(4294967296.0)))).cast("long")


def importance_resample(
    docs: DataFrame,
    target: DataFrame,
    percent: int = 25,
    buckets: int = BUCKETS,
    min_words: int = MIN_WORDS,
    seed: int = SEED,
    key: str = "doc_id",
    text: str = "text",
    target_text: str = "text",
) -> DataFrame:
    """One row per row of ``docs``: key, n_features, weight, score, rank (all long but
    the key); rank is null for what is not drawn.

    weight is the floored mean gain of a text's features towards ``target`` (0 without
    features), score adds a Gumbel draw of the key. Of the rows with ``min_words`` words
    or more, ``percent`` of 100 are drawn, those of the greatest score; ties go to the
    smaller key, a null key counting as smallest, then to the row read first. Null texts
    count as empty. Rows with equal keys draw alike but rank apart. Empty tables are
    fine on both sides: without a target every gain comes from the documents alone.
    Other columns are not carried.

    Texts are read twice and never shuffled. Scores are integers in a range that doubles
    bound, so their histogram is small; it gives the score below which nothing can be
    drawn. Only the rows above are sorted, over all tasks, and ranked by the tasks'
    running totals; the row number in the sort key splits rows that are equal otherwise.
    """
    gains = bucket_gains(bucket_counts(docs, buckets, text), bucket_counts(target, buckets, target_text))
    kind = docs.schema[key].dataType.simpleString()
    weighed = docs.select(F.col(key).alias("key"), or_empty(F.col(text)).alias("text")).mapInArrow(
        _weighed(gains), f"key {kind}, n_words long, n_features long, weight long"
    )
    rows = kept_safe(
        weighed.withColumn("score", F.col("weight") + gumbel(seed, F.col("key"))).withColumn(
            "row", F.monotonically_increasing_id()
        )
    )
    able = rows.filter(F.col("n_words") >= min_words)
    by_score = kept_safe(able.groupBy("score").agg(F.count("*").alias("n")))
    drawn = by_score.agg(F.sum("n")).first()[0] or 0
    drawn = percent * drawn // 100
    upto = F.sum("n").over(W.orderBy(F.desc("score")))
    lowest = by_score.withColumn("upto", upto).filter(F.col("upto") >= drawn).agg(F.max("score")).first()[0]
    may_win = (F.col("n_words") >= min_words) & (F.col("score") >= F.lit(lowest if drawn else None).cast("long"))
    may_win = F.coalesce(may_win, F.lit(False))
    placed = F.monotonically_increasing_id()  # task above 33 bits, place below
    first = kept_safe(
        rows.filter(may_win)
        .orderBy(F.desc("score"), F.asc_nulls_first("key"), "row")
        .withColumn("part", F.shiftright(placed, 33))
        .withColumn("place", placed.bitwiseAND(F.lit((1 << 33) - 1)))
    )
    parts = kept_safe(first.groupBy("part").agg(F.count("*").alias("n")))
    starts = running_totals(parts, "part", "n").select("part", "before")
    rank = F.col("before") + F.col("place") + 1
    ranked = first.join(small_side(starts, parts.count()), "part").withColumn(
        "rank", F.when(rank <= drawn, rank)
    )
    names = ["key", "n_features", "weight", "score", "rank"]
    rest = rows.filter(~may_win).withColumn("rank", F.lit(None).cast("long"))
    return ranked.select(*names).union(rest.select(*names)).withColumnRenamed("key", key)
