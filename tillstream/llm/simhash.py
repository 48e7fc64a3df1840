"""Near duplicates by SimHash, found with a sharded vantage-point tree."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstream.llm.common import kept_safe, or_empty, settled, ship
from tillstream.llm.components import components
from tillstream.llm.transducer import settle

SHINGLE = 3
RADIUS = 3
HASH_SEED = 42
MAX_SHARDS = 16_384
SAMPLE_PER_SHARD = 32
BLOCK_ROWS = 65_536  # a shard with more rows is worked on block by block
SMALL = 1024
STEP = 1 << 16


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    """64-bit majority of the XXH64 of all word shingles, as a signed number."""
    from xxhash import xxh64_intdigest

    words = text.encode("utf-8").lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    size = min(shingle, len(words))
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = [0, *ends[:-size].tolist()] if len(words) > size else [0]
    spans = zip(starts, (ends[size - 1 :] - 1).tolist(), strict=True)
    hashes = np.array([xxh64_intdigest(line[a:b], HASH_SEED) for a, b in spans], dtype=">u8")
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), STEP):
        octets = hashes[at : at + STEP].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(octets, axis=1).sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * ones > len(hashes)).tobytes()
    return int.from_bytes(bits, "big", signed=True)


def fingerprints(docs: DataFrame, shingle: int, text: Column, *carry: Column) -> DataFrame:
    """``carry`` and fp (long) for every row."""
    ship(docs.sparkSession)
    rows = docs.select(*carry, or_empty(text).alias("_text"))
    kept = [f for f in rows.schema.fields if f.name != "_text"]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        settle()
        for batch in batches:
            found = [fingerprint(t.as_py(), shingle) for t in batch.column("_text")]
            columns = [batch.column(f.name) for f in kept]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(found, pa.int64())], [*[f.name for f in kept], "fp"]
            )

    return rows.mapInArrow(settled(run), f"{schema}, fp long")


def distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a ^ b)


class Tree:
    """Vantage points and radii; leaves are shard numbers."""

    def __init__(self, sample: np.ndarray, n_shards: int, radius: int, seed: int = 7):
        self.radius, self.nodes, self.leaves = radius, [], 0
        self.random = np.random.default_rng(seed)
        self.top = self._grow(np.sort(sample), n_shards)

    def _grow(self, points: np.ndarray, shards: int) -> int:
        split = best_split(points, self.radius, self.random) if shards > 1 else None
        if split is None:
            self.leaves += 1
            return -self.leaves  # leaf k is held as -k
        point, border, far = split
        inner = max(1, min(shards - 1, round(shards * (1 - far.mean()))))
        at = len(self.nodes)
        self.nodes.append(None)
        self.nodes[at] = (
            point,
            border,
            self._grow(points[~far], inner),
            self._grow(points[far], shards - inner),
        )
        return at

    def route(self, points: np.ndarray) -> Iterator[tuple[int, np.ndarray, bool]]:
        """(shard, indexes, resident?) for every shard that points live in or must see.

        A point lives on its side of each border. If it lies outside but within the
        radius of the border it also visits the inner side; a visitor goes wherever
        the triangle inequality allows a neighbour. So of two neighbours parted by a
        border, the outer one meets the inner one where that lives.
        """
        todo = [(self.top, np.arange(len(points)), True)]
        while todo:
            at, index, home = todo.pop()
            if not len(index):
                continue
            if at < 0:
                yield -at - 1, index, home
                continue
            point, border, inner, outer = self.nodes[at]
            away = distance(points[index], point).astype(np.int64)
            near = away <= border
            reach = away <= border + self.radius
            if home:
                todo.append((inner, index[near], True))
                todo.append((outer, index[~near], True))
                todo.append((inner, index[~near & reach], False))
            else:
                todo.append((inner, index[reach], False))
                todo.append((outer, index[away > border - self.radius], False))


def best_split(points: np.ndarray, radius: int, random) -> tuple | None:
    """(vantage point, border, who lies beyond): of a few tries the split with the
    fewest points within the radius of its border, parts not too uneven."""
    best, found = 2.0, None
    if len(points) < 8:
        return None
    for point in random.choice(points, size=min(12, len(points)), replace=False):
        away = distance(points, point).astype(np.int64)
        below = np.cumsum(np.bincount(away, minlength=65)) / len(points)
        for border in np.flatnonzero((below >= 0.25) & (below <= 0.75)):
            low = below[border - radius] if border >= radius else 0.0
            overlap = below[min(border + radius, 64)] - low
            cost = overlap + abs(below[border] - 0.5)
            if cost < best:
                best, found = cost, (point, int(border), away > border)
    return found


class Groups:
    """Union-find over array indexes, many edges at a time."""

    def __init__(self, n: int):
        self.label = np.arange(n)

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        while True:
            x, y = self.label[a], self.label[b]
            differ = x != y
            if not differ.any():
                return
            a, b, x, y = a[differ], b[differ], x[differ], y[differ]
            np.minimum.at(self.label, np.maximum(x, y), np.minimum(x, y))
            while True:
                up = self.label[self.label]
                if (up == self.label).all():
                    break
                self.label = up


def link_near(points: np.ndarray, resident: np.ndarray, radius: int, seed: int = 7) -> np.ndarray:
    """For each point the index of its group's first point, counting the pairs within
    ``radius`` that include a resident. Vantage points go on pruning inside."""
    groups, random = Groups(len(points)), np.random.default_rng(seed)

    def compare(a: np.ndarray, b: np.ndarray) -> None:
        for i in range(0, len(a), 256):
            for j in range(0, len(b), 2048):
                one, two = a[i : i + 256], b[j : j + 2048]
                hit = distance(points[one][:, None], points[two][None, :]) <= radius
                x, y = np.nonzero(hit)
                if len(x):
                    groups.join(one[x], two[y])

    def work(home: np.ndarray, guests: np.ndarray) -> None:
        split = None
        if len(home) > SMALL:
            split = best_split(points[home], radius, random)
        if split is None:
            compare(home, home)
            compare(home, guests)
            return
        point, border, far = split
        away = distance(points[guests], point).astype(np.int64)
        own = distance(points[home], point).astype(np.int64)
        cross = home[far & (own <= border + radius)]
        work(home[~far], np.concatenate([guests[away <= border + radius], cross]))
        work(home[far], guests[away > border - radius])

    work(np.flatnonzero(resident), np.flatnonzero(~resident))
    return groups.label


def near_edges(points: DataFrame, n_points: int, radius: int = RADIUS) -> DataFrame:
    """Edges (src, dst) that connect the distinct fingerprints ``points`` (fp) exactly
    as all pairs within ``radius`` bits do; at most one per row of a shard.

    There is a shard for every four times the root of the number of points: each
    doubling of the shards makes points visit half as many again, so more and smaller
    shards would cost more moved rows than they save in comparisons, which are pruned
    further inside a shard anyway. The tree's upper part is fitted to a sample of at most ``SAMPLE_PER_SHARD`` points
    for each of at most ``MAX_SHARDS`` shards; every point is routed through it. The
    pairs of a shard are compared in one task, block by block where it has more than
    ``BLOCK_ROWS`` rows, and only a spanning forest of them leaves it.
    """
    spark = points.sparkSession
    if n_points < 2:
        return spark.createDataFrame([], "src long, dst long")
    n_shards = max(1, min(MAX_SHARDS, math.isqrt(n_points) // 4))
    wanted = n_shards * SAMPLE_PER_SHARD
    dice = F.pmod(F.xxhash64(F.lit(1), "fp"), F.lit(1 << 30)) / float(1 << 30)
    sample = points.filter(dice < min(1.0, wanted / n_points)).select("fp").toPandas()
    tree = Tree(sample["fp"].to_numpy(np.int64).view(np.uint64), n_shards, radius)

    def routed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            mine = batch.column("fp").to_numpy()
            for shard, index, home in tree.route(mine.view(np.uint64)):
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(index), shard, dtype=np.int32)),
                        pa.array(mine[index]),
                        pa.array(np.full(len(index), home)),
                    ],
                    ["shard", "fp", "home"],
                )

    rows = kept_safe(points.select("fp").mapInArrow(routed, "shard int, fp long, home boolean"))
    sizes = rows.groupBy("shard").agg(F.ceil(F.count("*") / BLOCK_ROWS).cast("int").alias("n"))
    block = F.pmod(F.xxhash64(F.lit(2), "fp"), F.col("n")).cast("int")
    dealt = (
        rows.join(F.broadcast(sizes), "shard")  # MAX_SHARDS rows at most
        .withColumn("block", block)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("n") - 1)))
        .select(
            "shard",
            F.least("block", "other").alias("low"),
            F.greatest("block", "other").alias("high"),
            "fp",
            "home",
        )
    )

    def linked(frame: pd.DataFrame) -> pd.DataFrame:
        mine = frame["fp"].to_numpy(np.int64)
        label = link_near(mine.view(np.uint64), frame["home"].to_numpy(), radius)
        moved = label != np.arange(len(label))
        return pd.DataFrame({"src": mine[moved], "dst": mine[label[moved]]})

    return dealt.groupBy("shard", "low", "high").applyInPandas(linked, "src long, dst long")


def simhash_groups(
    docs: DataFrame,
    shingle: int = SHINGLE,
    radius: int = RADIUS,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """One row per document: key, mark, fingerprint (16 hex digits), component_id, kept.

    Documents link when their fingerprints differ in at most ``radius`` bits;
    component_id is the smallest key reachable (null if no key of the group is known).
    Null and empty texts have fingerprint zero and link like any other. ``mark`` is a
    hash of the text: with the key it names a row even where keys repeat. The kept row
    of a group has its smallest (key, mark), null keys last; rows equal in both are
    all marked as kept. An empty table gives an empty result.

    Equal fingerprints are one point (copies never pair up), the tree works on points,
    and all joins are on materialised tables that adaptive execution may split.
    """
    hashed = kept_safe(
        fingerprints(
            docs,
            shingle,
            F.col(text),
            F.col(key).alias("_key"),
            F.xxhash64(or_empty(F.col(text))).alias("mark"),
        )
    )
    name = F.struct(F.col("_key").isNull().alias("none"), "_key", "mark")
    points = kept_safe(hashed.groupBy("fp").agg(F.min(name).alias("first")))
    linked = kept_safe(components(near_edges(points, points.count(), radius)))
    rooted = points.join(linked, points["fp"] == linked["node"], "left").select(
        "fp", "first", F.coalesce("component", "fp").alias("root")
    )
    rooted = kept_safe(rooted)
    roots = kept_safe(rooted.groupBy("root").agg(F.min("first").alias("chosen")))
    chosen = kept_safe(rooted.join(roots, "root").select("fp", "chosen"))
    return hashed.join(chosen, "fp").select(
        F.col("_key").alias(key),
        "mark",
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        F.col("chosen._key").alias("component_id"),
        (
            F.col("_key").eqNullSafe(F.col("chosen._key")) & (F.col("mark") == F.col("chosen.mark"))
        ).alias("kept"),
    )
