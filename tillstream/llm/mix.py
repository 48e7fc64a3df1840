"""Mixing sources to target weights: hierarchical budgets, then seeded epochs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tillstream.llm.common import WORD, kept_safe, or_empty, without

SEED = 42
HASH_DIGITS = 15
SLOT_ROWS = 2048

# All leaves go to every task while their names and numbers take no more than this;
# beyond it only the leaves that hold over one row in so many do.
BROADCAST_BYTES = 32 << 20
LEAF_BYTES = 64
HOT_LEAVES = 1000


def word_count(text: Column) -> Column:
    return F.regexp_count(or_empty(text), F.lit(WORD)).cast("long")


def hand_down(nodes: DataFrame, parent: Sequence[str], budgets: DataFrame) -> DataFrame:
    """Shares each parent's budget among its children; adds ``budget`` to ``nodes``.

    ``nodes`` has weight and capacity (long), ``budgets`` the parent's columns and
    its budget, no larger than its children's capacities together. A child gets its
    share by weight, at most its capacity; what it cannot take goes to its siblings,
    by weight again, before anything is given back. Children are ordered by capacity
    per weight: from the first one whose share fits, all shares fit. Integer
    arithmetic throughout; the floors leave under one token per child unspent.
    Children without weight get nothing.
    """
    order = W.partitionBy("_pot").orderBy(
        (F.col("capacity") / F.col("weight")).asc(), *[F.col(c) for c in _names(nodes)]
    )
    held = nodes.filter("weight > 0").join(
        budgets.select(*parent, F.col("budget").alias("_pot_budget")), list(parent)
    )
    pot = F.concat_ws("\x01", F.lit(""), *[F.col(c) for c in parent])
    ranked = held.withColumn("_pot", pot).withColumns(
        {
            "_before": F.coalesce(
                F.sum("capacity").over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)
            ),
            "_weights": F.sum("weight").over(order.rowsBetween(0, W.unboundedFollowing)),
        }
    )
    rest = F.col("_pot_budget") - F.col("_before")
    fits = rest * F.col("weight") < F.col("capacity") * F.col("_weights")
    first = F.struct(rest.alias("rest"), F.col("_weights").alias("weights"))
    level = F.first(F.when(fits, first), ignorenulls=True).over(
        order.rowsBetween(W.unboundedPreceding, 0)
    )
    return (
        ranked.withColumn("_level", level)
        .withColumn(
            "budget",
            F.when(F.col("_level").isNull(), F.col("capacity")).otherwise(
                F.expr("_level.rest * weight div _level.weights")
            ),
        )
        .drop("_pot", "_pot_budget", "_before", "_weights", "_level")
    )


def _names(nodes: DataFrame) -> list[str]:
    return [c for c in nodes.columns if c not in ("weight", "capacity")]


def leaf_budgets(
    leaves: DataFrame, tree: Sequence[str], weights: Sequence[dict[str, int]], total: int
) -> DataFrame:
    """``leaves`` (one row per leaf: the ``tree`` columns and capacity) with a budget.

    ``weights[i]`` holds the weight of each value at level i, under "" that of all
    others. Capacities are summed up the tree; budgets come down level by level.
    Where a whole subtree is short, its siblings take over, and only what they cannot
    hold either moves further up; nothing is left over while any leaf has room.
    """
    capacity = leaves.agg(F.sum("capacity")).first()[0] or 0
    spark = leaves.sparkSession
    # Not from a local list: that would start Python workers, which stay, for one number.
    whole = F.lit(min(total, capacity)).cast("long")
    budgets = spark.range(0, 1, 1, 1).select(whole.alias("budget"))
    for depth in range(1, len(tree) + 1):
        here, above = list(tree[:depth]), list(tree[: depth - 1])
        named = weights[depth - 1]
        weight = F.lit(named[""]).cast("long")
        for value, number in named.items():
            if value:
                weight = F.when(F.col(tree[depth - 1]) == value, number).otherwise(weight)
        level = (
            leaves.groupBy(*here)
            .agg(F.sum("capacity").cast("long").alias("capacity"))
            .withColumn("weight", weight.cast("long"))
        )
        if above:
            budgets = hand_down(level, above, budgets)
        else:
            pot = budgets.select(F.lit("").alias("_root"), "budget")
            budgets = hand_down(level.withColumn("_root", F.lit("")), ["_root"], pot).drop("_root")
    return budgets


def _place(epoch: Column, key: Column, text: Column, seed: int) -> Column:
    """A row's place in one epoch: 15 hex digits of a seeded hash of key and text."""
    marked = F.concat_ws(
        "|", F.lit(str(seed)), epoch.cast("string"), key.cast("string"), F.md5(or_empty(text))
    )
    return F.substring(F.md5(marked), 1, HASH_DIGITS)


def _by_leaf(
    rows: DataFrame, leaves: DataFrame, levels: list[str], hot: DataFrame | None, how: str = "inner"
) -> DataFrame:
    """``rows`` joined with one row per leaf, which goes to every task while all leaves
    are small together (``hot`` is None). Else only the ``hot`` leaves, of which there are
    at most ``HOT_LEAVES``, do so; rows of the others, none of which holds more than
    its share of one in so many, are shuffled by leaf."""
    if hot is None:
        return rows.join(F.broadcast(leaves), levels, how)
    few = F.broadcast(hot)
    wide = leaves.join(few, levels, "left_semi")
    near = rows.join(few, levels, "left_semi").join(F.broadcast(wide), levels, how)
    far = rows.join(few, levels, "left_anti").join(leaves, levels, how)
    return near.unionByName(far)


def mix_sources(
    docs: DataFrame,
    tree: Sequence[tuple[str, Column]],
    weights: Sequence[dict[str, int]],
    share: tuple[int, int],
    max_epochs: int = 2,
    seed: int = SEED,
    key: str = "doc_id",
    text: str = "text",
    added: tuple[str, str] = ("tokens", "epoch"),
) -> DataFrame:
    """Rows of ``docs`` chosen for the mix, with all columns, tokens (words) and epoch.

    Those two are named by ``added``; columns of these names, in whatever case, are
    replaced. Null texts have no tokens; an empty table gives an empty mix.

    ``tree`` names the levels, each with its expression (null counts as "unknown").
    The budget is ``share`` (a fraction) of all tokens. A leaf's capacity is its
    tokens times ``max_epochs``. A leaf with a budget of several times its tokens
    repeats all its rows in the earlier epochs; of the last one it takes, in the
    order of a seeded hash, the longest prefix of rows whose tokens fit the rest.
    Rows of no tokens come along for free in that order while budget is left.

    Order without sorting a leaf: its hash range is cut into slots of about
    ``SLOT_ROWS`` rows; slot totals (reduced inside the map tasks) tell the slot in
    which the budget ends, and only that slot's rows are put in order. A source may
    hold a third of all rows and no task sees more than a slot of it. Rows equal in
    key and text share a place; which of them falls inside is of no consequence.
    """
    names = [n for n, _ in tree]
    row = F.struct(*without(docs, added).columns).alias("_row")
    placed = docs.select(
        row,
        *[F.coalesce(c.cast("string"), F.lit("unknown")).alias(f"_{n}") for n, c in tree],
        word_count(F.col(text)).alias("_tokens"),
        F.col(key).alias("_key"),
        F.col(text).alias("_text"),
    )
    levels = [f"_{n}" for n in names]
    leaves = kept_safe(
        placed.groupBy(*levels).agg(
            F.sum("_tokens").alias("held"), F.count("*").alias("rows"),
        )
    )
    capacity = leaves.withColumn("capacity", F.col("held") * max_epochs)
    name_bytes = sum((F.octet_length(name) for name in levels), F.lit(LEAF_BYTES))
    everything, n_rows, n_bytes = leaves.agg(
        *[F.coalesce(F.sum(c), F.lit(0)) for c in (F.col("held"), F.col("rows"), name_bytes)]
    ).first()
    hot = None
    if n_bytes > BROADCAST_BYTES:
        hot = leaves.filter(F.col("rows") * HOT_LEAVES > n_rows).select(*levels)
    part, whole = share
    total = everything * part // whole
    given_out = kept_safe(
        leaf_budgets(capacity.select(*levels, "capacity"), levels, weights, total)
        .join(leaves, levels)
        .select(
            *levels,
            F.expr("if(held > 0, least(budget div held, %d), 0)" % max_epochs).alias("_full"),
            F.expr("if(held > 0, budget %% greatest(held, 1), 0)" % ()).alias("_rest"),
            F.ceil(F.col("rows") / SLOT_ROWS).alias("_slots"),
        )
    )
    planned = _by_leaf(placed, given_out, levels, hot).withColumn(
        "_place", _place(F.col("_full"), F.col("_key"), F.col("_text"), seed)
    )
    number = F.conv(F.substring("_place", 1, 8), 16, 10).cast("long")
    planned = planned.withColumn(
        "_slot", F.floor(number * F.col("_slots") / F.lit(1 << 32)).cast("long")
    )
    slots = kept_safe(
        planned.filter("_rest > 0")
        .groupBy(*levels, "_slot", "_rest")
        .agg(F.sum("_tokens").alias("_sum"))
    )
    run = W.partitionBy(*levels).orderBy("_slot")
    edges = kept_safe(
        slots.withColumn("_upto", F.sum("_sum").over(run))
        .filter("_upto > _rest")
        .groupBy(*levels)
        .agg(F.min(F.struct("_slot", (F.col("_upto") - F.col("_sum")).alias("spent"))).alias("_cut"))
    )
    cut = _by_leaf(planned, edges, levels, hot, "left")
    inside = F.col("_rest") > 0
    slot, edge = F.col("_slot"), F.col("_cut._slot")
    below = inside & (edge.isNull() | (slot < edge))
    on_edge = F.coalesce(inside & (slot == edge), F.lit(False))
    order = W.partitionBy(*levels).orderBy("_place", "_key", "_tokens")
    spent = F.sum("_tokens").over(order.rowsBetween(W.unboundedPreceding, 0))
    bounded = (
        cut.filter(on_edge)
        .withColumn("_fits", F.col("_cut.spent") + spent <= F.col("_rest"))
        .drop("_cut")
    )
    sure = cut.filter(~on_edge).withColumn("_fits", below).drop("_cut")
    epochs = F.col("_full") + F.col("_fits").cast("int")
    return (
        sure.union(bounded)
        .filter(epochs > 0)
        .select(
            "_row",
            F.col("_tokens").alias(added[0]),
            F.explode(F.sequence(F.lit(0).cast("long"), epochs - 1)).alias(added[1]),
        )
        .select("_row.*", *added)
    )
