"""Near-duplicate vectors by NN-descent."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tillstream.llm.common import kept_safe, ship, small_side
from tillstream.llm.components import components
from tillstream.llm.simhash import Groups
from tillstream.workspace import fresh_folder

LIST = 12  # neighbours a vector holds
TREES = 10  # random projections that make the first lists
LEAF = 48  # vectors that meet in one leaf, about
BLOCK = 256  # vectors that meet in one comparison, at most
ROUNDS = 4
DONE = 0.005  # a round that changes fewer of the list places is the last
AUDIT = 256  # vectors compared with all others to measure recall
RECALL = 0.98
TRIES = 3
GROUP = 256  # vectors whose lists are joined in one call
CENTRES = 1 << 21  # numbers in the centres that one pass over the vectors holds


def _matrix(vectors: pd.Series) -> np.ndarray:
    x = np.array(vectors.tolist(), dtype=np.float64)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _top(pairs: DataFrame, size: int) -> DataFrame:
    """The ``size`` nearest of each src; a src has a bounded number of rows here."""
    order = W.partitionBy("src").orderBy(F.desc("sim"), "dst")
    return (
        pairs.groupBy("src", "dst")
        .agg(F.max("sim").alias("sim"))
        .withColumn("_n", F.row_number().over(order))
        .filter(F.col("_n") <= size)
        .drop("_n")
    )


def _best(ids: np.ndarray, sims: np.ndarray, size: int) -> tuple:
    """(src, dst, sim) of the ``size`` best others for each of a small set."""
    n = len(ids)
    np.fill_diagonal(sims, -2.0)
    k = min(size, n - 1)
    near = np.argpartition(-sims, k - 1, axis=1)[:, :k]
    rows = np.repeat(np.arange(n), k)
    near = near.ravel()
    return ids[rows], ids[near], sims[rows, near]


def _frame(parts: list[tuple]) -> pd.DataFrame:
    if not parts:
        return pd.DataFrame(
            {"src": np.array([], "int64"), "dst": np.array([], "int64"), "sim": np.array([])}
        )
    src, dst, sim = (np.concatenate(p) for p in zip(*parts, strict=True))
    return pd.DataFrame({"src": src, "dst": dst, "sim": sim})


EDGES = "src long, dst long, sim double"


def first_lists(points: DataFrame, trees: Sequence[int], size: int, leaf: int) -> DataFrame:
    """Neighbours among vectors on the same side of random hyperplanes, per tree.

    A label with n vectors uses as many hyperplanes as make leaves of about ``leaf``.
    A leaf that stays larger than ``BLOCK`` is dealt into blocks at random: these are
    only the first lists, what they lack is the descent's work.
    """
    numbers = list(trees)
    counts = points.groupBy("kind").agg(F.count("*").alias("n")).withColumn(
        "depth",
        F.greatest(F.lit(0), F.ceil(F.log2(F.col("n") / leaf))).cast("int"),
    )
    sized = points.join(small_side(counts, counts.count()), "kind").select(
        "kind", "cid", "vec", "depth"
    )

    def coded(frames):
        planes: dict[tuple[int, int], np.ndarray] = {}
        for frame in frames:
            for dim, some in frame.groupby(frame["vec"].map(len)):
                x = _matrix(some["vec"])
                for tree in numbers:
                    if (dim, tree) not in planes:
                        random = np.random.default_rng([tree, dim])
                        planes[dim, tree] = random.standard_normal((dim, 40))
                    bits = (x @ planes[dim, tree] > 0).astype(np.int64)
                    code = bits @ (1 << np.arange(40, dtype=np.int64))
                    depth = np.minimum(some["depth"].to_numpy(np.int64), 40)
                    yield pd.DataFrame(
                        {
                            "kind": some["kind"].to_numpy(),
                            "tree": tree,
                            "code": code & ((1 << depth) - 1),
                            "cid": some["cid"].to_numpy(),
                            "vec": some["vec"].to_numpy(),
                        }
                    )

    schema = "kind string, tree int, code long, cid long, vec array<double>"
    leaves = sized.mapInPandas(coded, schema)
    place = ["kind", "tree", "code"]
    sizes = kept_safe(leaves.groupBy(*place).agg(F.ceil(F.count("*") / BLOCK).alias("blocks")))
    dealt = leaves.join(small_side(sizes, sizes.count()), place).withColumn(
        "block", F.pmod(F.xxhash64("tree", "cid"), "blocks")
    )

    def meet(frame: pd.DataFrame) -> pd.DataFrame:
        if len(frame) < 2:
            return _frame([])
        x = _matrix(frame["vec"])
        return _frame([_best(frame["cid"].to_numpy(np.int64), x @ x.T, size)])

    found = dealt.groupBy(*place, "block").applyInPandas(meet, EDGES)
    return _top(found, size)


def descend(graph: DataFrame, points: DataFrame, n_points: int, size: int) -> DataFrame:
    """One round: all vectors in a list, or listing the same vector, meet each other.

    A vector that very many list is no single group: those who list it are dealt into
    blocks, and its own list goes to every block, so each of them meets all of the
    list (a neighbour's neighbours), and others of its block.
    """
    listed = kept_safe(
        graph.groupBy(F.col("dst").alias("v")).agg(F.ceil(F.count("*") / 32).alias("blocks"))
    )
    back = graph.select(F.col("dst").alias("v"), F.col("src").alias("u")).join(listed, "v")
    back = back.select("v", F.pmod(F.xxhash64("u"), "blocks").alias("block"), "u")
    ahead = graph.select(F.col("src").alias("v"), F.col("dst").alias("u"))
    ahead = ahead.join(listed, "v", "left").select(
        "v", F.explode(F.sequence(F.lit(0), F.coalesce("blocks", F.lit(1)) - 1)).alias("block"), "u"
    )
    members = back.union(ahead).distinct()
    worst = graph.groupBy("src").agg(F.min("sim").alias("worst"), F.count("*").alias("held"))
    known = points.join(worst, points["cid"] == worst["src"], "left").select(
        F.col("cid").alias("u"),
        "vec",
        F.when(F.col("held") >= size, F.col("worst")).otherwise(-2.0).alias("worst"),
    )
    groups = max(1, n_points // GROUP)
    rows = members.join(kept_safe(known), "u").withColumn(
        "part", F.pmod(F.xxhash64("v", "block"), F.lit(groups))
    )

    def join_lists(frame: pd.DataFrame) -> pd.DataFrame:
        out = []
        frame = frame.sort_values(["v", "block", "u"])
        ids, worst = frame["u"].to_numpy(np.int64), frame["worst"].to_numpy()
        spot = frame[["v", "block"]].to_numpy(np.int64)
        edge = np.flatnonzero((spot[1:] != spot[:-1]).any(axis=1)) + 1
        x = _matrix(frame["vec"])
        for a, b in zip([0, *edge.tolist()], [*edge.tolist(), len(ids)], strict=True):
            if b - a > 1:
                sims = x[a:b] @ x[a:b].T
                np.fill_diagonal(sims, -2.0)
                i, j = np.nonzero(sims > worst[a:b, None])
                out.append((ids[a:b][i], ids[a:b][j], sims[i, j]))
        return _frame(out)

    return _top(graph.union(rows.groupBy("part").applyInPandas(join_lists, EDGES)), size)


def compared(members: DataFrame, threshold: float) -> DataFrame:
    """(cid, found, tie) for members (group, cid, n, vec), all pairs of a group compared
    block by block: how many rows of a pair of blocks each vector links to, and another
    vector of its component there (itself if it is the first)."""
    sizes = members.groupBy("group").agg(F.ceil(F.count("*") / (2 * BLOCK)).alias("blocks"))
    sizes = kept_safe(sizes)
    dealt = (
        members.join(small_side(sizes, sizes.count()), "group")
        .withColumn("block", F.pmod(F.xxhash64("cid"), "blocks"))
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
        .select(
            "group",
            F.least("block", "other").alias("low"),
            F.greatest("block", "other").alias("high"),
            "block",
            "cid",
            "n",
            "vec",
        )
    )

    def count(frame: pd.DataFrame) -> pd.DataFrame:
        x, n = _matrix(frame["vec"]), frame["n"].to_numpy(np.int64)
        near = x @ x.T >= threshold
        np.fill_diagonal(near, False)
        ids, block = frame["cid"].to_numpy(np.int64), frame["block"].to_numpy()
        if frame["low"].iloc[0] != frame["high"].iloc[0]:
            near &= block[:, None] != block[None, :]
        groups = Groups(len(ids))
        groups.join(*np.nonzero(np.triu(near, 1)))
        return pd.DataFrame({"cid": ids, "found": near @ n, "tie": ids[groups.label]})

    schema = "cid long, found long, tie long"
    return dealt.groupBy("group", "low", "high").applyInPandas(count, schema)


def links_within(members: DataFrame, threshold: float) -> DataFrame:
    """(cid, found) for members (group, cid, n, vec) of saturated groups: how many rows
    each vector links to."""
    return compared(members, threshold).groupBy("cid").agg(F.sum("found").alias("found"))


def saturated(graph: DataFrame, linked: DataFrame, threshold: float) -> DataFrame:
    """(group, cid): the components that hold a vector whose whole list links."""
    links = graph.filter(F.col("sim") >= threshold)
    full = links.groupBy("src").agg(F.count("*").alias("k")).filter(F.col("k") >= LIST)
    groups = kept_safe(
        linked.join(full, linked["node"] == full["src"]).select(F.col("component").alias("group")).distinct()
    )
    return kept_safe(
        linked.join(groups, linked["component"] == groups["group"]).select("group", F.col("node").alias("cid"))
    )


def links_out(points: DataFrame, crowded: DataFrame, threshold: float) -> DataFrame:
    """(src, dst): an edge from every vector outside a saturated group (group, cid) that
    links to one inside.

    A group's centre is its vector of the least cid, its radius the largest angle to the
    centre. What links to a member lies within the radius and the threshold's angle;
    these candidates, and no others, are compared with all members, block by block.
    """
    members = kept_safe(crowded.join(points.select("kind", "cid", "vec"), "cid"))
    centres = members.filter(F.col("group") == F.col("cid"))
    centres = kept_safe(centres.select("group", F.col("vec").alias("centre")))
    n_centres = centres.count()

    def spread(frames):
        for frame in frames:
            angles = np.empty(len(frame))
            for _, some in frame.groupby(frame["vec"].map(len)):
                at = frame.index.get_indexer(some.index)
                angles[at] = (_matrix(some["vec"]) * _matrix(some["centre"])).sum(1)
            angles = np.arccos(np.clip(angles, -1.0, 1.0))
            yield pd.DataFrame({"group": frame["group"].to_numpy(), "kind": frame["kind"].to_numpy(), "angle": angles})

    apart = members.join(small_side(centres, n_centres), "group").select("group", "kind", "vec", "centre")
    radii = (
        apart.mapInPandas(spread, "group long, kind string, angle double")
        .groupBy("group", "kind")
        .agg(F.max("angle").alias("radius"))
    )
    numbers = centres.agg(F.sum(F.size("centre"))).first()[0] or 0
    passes = 1 + int(numbers) // CENTRES
    placed = kept_safe(
        radii.join(centres, "group").withColumn("pass", F.pmod(F.xxhash64("group"), F.lit(passes)))
    )
    homes = points.select("kind", "cid", "vec").join(
        crowded.select("cid", F.col("group").alias("home")), "cid", "left"
    )
    homes = homes.withColumn("home", F.coalesce("home", F.lit(-1).cast("long")))
    slack = float(np.arccos(threshold)) + 1e-6
    found = []
    for number in range(passes):
        some = placed.filter(F.col("pass") == number).toPandas()  # CENTRES numbers, about
        by_kind = {
            kind: (c["group"].to_numpy(np.int64), _matrix(c["centre"]), c["radius"].to_numpy() + slack)
            for kind, c in some.groupby("kind")
        }

        def guests(frames, by_kind=by_kind):
            for frame in frames:
                for kind, rows in frame.groupby("kind"):
                    if kind in by_kind:
                        groups, x, reach = by_kind[kind]
                        ids, home = rows["cid"].to_numpy(np.int64), rows["home"].to_numpy(np.int64)
                        y = _matrix(rows["vec"])
                        for a in range(0, len(groups), 4 * BLOCK):
                            part = slice(a, a + 4 * BLOCK)
                            angle = np.arccos(np.clip(y @ x[part].T, -1.0, 1.0))
                            close = (angle <= reach[part]) & (home[:, None] != groups[part])
                            i, j = np.nonzero(close)
                            yield pd.DataFrame({"group": groups[part][j], "cid": ids[i]})

        found.append(kept_safe(homes.mapInPandas(guests, "group long, cid long")))
    near = found[0]
    for more in found[1:]:
        near = near.union(more)
    one = members.groupBy("group").agg(F.ceil(F.count("*") / BLOCK).alias("ins"))
    two = near.groupBy("group").agg(F.ceil(F.count("*") / BLOCK).alias("outs"))
    sizes = kept_safe(one.join(two, "group"))
    n_sizes = sizes.count()

    def dealt(rows: DataFrame, own: str, other: str, inner: bool) -> DataFrame:
        sized = rows.join(small_side(sizes, n_sizes), "group")
        every = F.explode(F.sequence(F.lit(0).cast("long"), F.col(other) - 1))
        sized = sized.withColumn(f"{own}_at", F.pmod(F.xxhash64("cid"), own))
        sized = sized.withColumn(f"{other}_at", every)
        return sized.select("group", "ins_at", "outs_at", F.lit(inner).alias("inner"), "cid", "vec")

    both = dealt(members, "ins", "outs", True).union(
        dealt(near.join(points.select("cid", "vec"), "cid"), "outs", "ins", False)
    )

    def meet(frame: pd.DataFrame) -> pd.DataFrame:
        inner = frame["inner"].to_numpy(bool)
        ids = frame["cid"].to_numpy(np.int64)
        if inner.all() or not inner.any():
            return pd.DataFrame({"src": ids[:0], "dst": ids[:0]})
        sims = _matrix(frame["vec"][~inner]) @ _matrix(frame["vec"][inner]).T
        best = sims.argmax(axis=1)
        hit = sims[np.arange(len(best)), best] >= threshold
        return pd.DataFrame({"src": ids[~inner][hit], "dst": ids[inner][best[hit]]})

    return both.groupBy("group", "ins_at", "outs_at").applyInPandas(meet, "src long, dst long")


def audited(points: DataFrame, found: DataFrame, threshold: float, n_points: int) -> float:
    """Share of all links of a bounded sample that were found; the sample (``AUDIT``
    vectors, give or take the hash) is compared with every vector, batch by batch."""
    dice = F.pmod(F.xxhash64(F.lit(5), "cid"), F.lit(1 << 30)) / float(1 << 30)
    asked = points.filter(dice < min(1.0, AUDIT / max(n_points, 1)))
    queries = asked.select("kind", "cid", "vec").toPandas()
    if not len(queries):
        return 1.0
    by_kind = {
        kind: (q["cid"].to_numpy(np.int64), _matrix(q["vec"]))
        for kind, q in queries.groupby("kind")
    }

    def ask(frames):
        for frame in frames:
            for kind, some in frame.groupby("kind"):
                if kind in by_kind:
                    ids, x = by_kind[kind]
                    near = x @ _matrix(some["vec"]).T >= threshold
                    near &= ids[:, None] != some["cid"].to_numpy()[None, :]
                    yield pd.DataFrame({"cid": ids, "true": near @ some["n"].to_numpy(np.int64)})

    true = points.select("kind", "cid", "n", "vec").mapInPandas(ask, "cid long, true long")
    compared = true.groupBy("cid").agg(F.sum("true").alias("true")).join(found, "cid", "left")
    row = compared.agg(
        F.sum("true"), F.sum(F.least("true", F.coalesce("found", F.lit(0))))
    ).first()
    return row[1] / row[0] if row[0] else 1.0


def near_vectors(
    vectors: DataFrame,
    threshold: float = 0.93,
    key: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
) -> DataFrame:
    """One row per vector: key, n_links, component_id, kept.

    Vectors with equal label and equal dimension link at a cosine of ``threshold`` or
    more. n_links counts the other rows linked directly, component_id is the smallest
    key reachable, kept marks key = component_id. A vector that is null, empty, zero
    or holds a null or non-finite component, or whose label is null, links with
    nothing. Rows with a null key take part; their component is the smallest known
    key (null if there is none) and they are not kept. Among repeated keys with the
    smallest key of a group, each is marked as kept. No rows in, no rows out.

    Equal vectors are one point with a count, so copies cost nothing. First lists come
    from random projections; then lists are joined until few places change. A vector
    whose whole list lies beyond the threshold is saturated: its list is enlarged to
    all of its group, compared exactly in blocks, after the group was compared with
    every vector outside that can link to it. A sample audits the recall against all
    vectors; below ``RECALL`` more projections are added, and after the last try all
    vectors of a label are compared.
    """
    ship(vectors.sparkSession)
    numbers = F.col(vector)
    fine = F.coalesce(
        F.col(label).isNotNull()
        & (F.size(numbers) > 0)
        & F.forall(numbers, lambda x: x.isNotNull() & (F.abs(x) < float("inf")) & ~F.isnan(x))
        & F.exists(numbers, lambda x: x != 0),
        F.lit(False),
    )
    kind = F.concat_ws(":", F.col(label).cast("string"), F.size(numbers).cast("string"))
    named = vectors.select(
        F.col(key).alias("_key"), numbers.cast("array<double>").alias("vec"),
        F.when(fine, kind).alias("kind"),
    )
    points = kept_safe(
        named.filter("kind is not null")
        .groupBy("kind", "vec")
        .agg(F.min("_key").alias("first"), F.count("*").alias("n"))
        .withColumn("cid", F.monotonically_increasing_id())
    )
    n_points = points.count()
    graph, trees = None, TREES
    for attempt in range(TRIES):
        more = first_lists(points, range(attempt * TREES, attempt * TREES + trees), LIST, LEAF)
        graph = kept_safe(more if graph is None else _top(graph.union(more), LIST))
        for _ in range(ROUNDS):
            better = kept_safe(descend(graph, points, n_points, LIST))
            changed = better.join(graph, ["src", "dst"], "left_anti").count()
            graph = better
            if changed <= DONE * LIST * n_points:
                break
        links = graph.filter(F.col("sim") >= threshold).select("src", "dst")
        linked = kept_safe(components(links))
        crowded = saturated(graph, linked, threshold)
        if crowded.count():
            # A group is joined by all that link to it; one that joins and is saturated
            # itself was compared with everything too, so once is enough.
            # Read from files: estimated sizes, multiplied by every join of the first
            # components, would be multiplied again and outgrow the driver.
            place = fresh_folder(vectors.sparkSession, "links-out")
            links_out(points, crowded, threshold).write.parquet(place)
            more = vectors.sparkSession.read.parquet(place)
            if more.count():
                linked = kept_safe(components(links.union(more)))
                crowded = saturated(graph, linked, threshold)
        found = kept_safe(_link_counts(points, graph, crowded, threshold))
        if audited(points, found, threshold, n_points) >= RECALL:
            break
    else:
        whole = points.select(F.col("kind").alias("group"), "cid", "n", "vec")
        every = kept_safe(compared(whole, threshold))
        linked = kept_safe(components(every.select(F.col("cid").alias("src"), F.col("tie").alias("dst"))))
        found = kept_safe(every.groupBy("cid").agg(F.sum("found").alias("found")))
    rooted = points.join(linked, points["cid"] == linked["node"], "left").select(
        "kind", "vec", "cid", "first", "n", F.coalesce("component", "cid").alias("root")
    )
    rooted = kept_safe(rooted)
    roots = kept_safe(rooted.groupBy("root").agg(F.min("first").alias("component_id")))
    decided = kept_safe(
        rooted.join(roots, "root")
        .join(found, "cid", "left")
        .select(
            "kind",
            "vec",
            (F.coalesce("found", F.lit(0)) + F.col("n") - 1).alias("n_links"),
            "component_id",
        )
    )
    paired = (
        named.filter("kind is not null")
        .join(decided, ["kind", "vec"])
        .select("_key", "n_links", "component_id")
    )
    lone = named.filter("kind is null").select(
        "_key", F.lit(0).cast("long").alias("n_links"), F.col("_key").alias("component_id")
    )
    return paired.union(lone).select(
        F.col("_key").alias(key),
        "n_links",
        "component_id",
        F.coalesce(F.col("_key") == F.col("component_id"), F.lit(False)).alias("kept"),
    )


def _link_counts(
    points: DataFrame, graph: DataFrame, crowded: DataFrame, threshold: float
) -> DataFrame:
    """(cid, found): rows linked to each vector, other than its own copies."""
    links = graph.filter(F.col("sim") >= threshold).select("src", "dst")
    both = links.union(links.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
    both = both.distinct()
    inside = links_within(crowded.join(points.select("cid", "n", "vec"), "cid"), threshold)
    listed = (
        both.join(crowded, both["src"] == crowded["cid"], "left_anti")
        .join(points.select(F.col("cid").alias("dst"), "n"), "dst")
        .groupBy(F.col("src").alias("cid"))
        .agg(F.sum("n").alias("found"))
    )
    return inside.union(listed)
