"""Exact duplicates by progressive refinement: length, then prefix, then full content."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstream.llm.common import WHITE, kept_safe, or_empty, small_side

PREFIX_CHARS = 128


def normalised(text: Column) -> Column:
    """Each run of white space as one space; null as empty."""
    return F.regexp_replace(or_empty(text), WHITE, " ")


def exact_groups(
    docs: DataFrame, key: str = "doc_id", text: str = "text", carry: Sequence[str] = ()
) -> DataFrame:
    """One row per document: key, ``carry``, keep_id, group_size (long), kept.

    Texts are equal when their normalised forms are identical. Of a group the row
    with the smallest key stays; a null key counts as largest; of rows that share
    the smallest key exactly one stays. Null and empty texts form one group; of an
    empty table nothing comes back. Names in ``carry`` may be any but those returned.

    First pass: rows per (length, prefix hash), summed inside the map tasks; lengths
    held by one row fall out, then prefixes. Second pass: only rows of a surviving
    pair have their whole content hashed. Texts never move while the surviving pairs
    are few enough to broadcast (``small_side``); else the join by pair moves them
    once, and adaptive execution splits a pair that many rows share. Decisions are
    joined on the hash, again splittable, so a group may hold a third of all rows.
    """
    clean = normalised(F.col(text))
    length = F.octet_length(clean).alias("_length")
    prefix = F.xxhash64(F.substring(clean, 1, PREFIX_CHARS)).alias("_prefix")
    heads = kept_safe(docs.select(length, prefix).groupBy("_length", "_prefix").count())
    lengths = heads.groupBy("_length").agg(F.sum("count").alias("n")).filter("n > 1")
    pairs = kept_safe(
        heads.join(lengths.select("_length"), "_length", "left_semi")
        .filter("count > 1")
        .select("_length", "_prefix", F.lit(True).alias("_again"))
    )
    # In a struct, where no name clashes with those of this operator.
    carried = F.struct(*carry) if carry else F.lit(None)
    rows = docs.select(F.col(key).alias("_key"), carried.alias("_more"), clean.alias("_clean"), length, prefix)
    hashed = kept_safe(
        rows.join(small_side(pairs, pairs.count()), ["_length", "_prefix"], "left").select(
            "_key",
            "_more",
            F.monotonically_increasing_id().alias("_row"),
            F.when(F.col("_again"), F.sha2(F.col("_clean"), 256)).alias("_full"),
        )
    )
    shared, alone = hashed.filter("_full is not null"), hashed.filter("_full is null")
    order = F.struct(F.col("_key").isNull().alias("n"), "_key", "_row")
    groups = kept_safe(
        shared.groupBy("_full").agg(F.min(order).alias("_keep"), F.count("*").alias("group_size"))
    )
    more = ["_more.*"] if carry else []
    decided = shared.join(groups, "_full").select(
        F.col("_key").alias(key),
        *more,
        F.col("_keep._key").alias("keep_id"),
        "group_size",
        (F.col("_row") == F.col("_keep._row")).alias("kept"),
    )
    single = alone.select(
        F.col("_key").alias(key),
        *more,
        F.col("_key").alias("keep_id"),
        F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"),
    )
    return decided.union(single)
