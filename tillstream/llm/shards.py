"""Sharding: a two-pass external shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstream.llm.common import kept_safe, or_empty, running_totals, small_side, without

BUCKET_BYTES = 16 << 20


def shuffled_shards(
    docs: DataFrame,
    n_shards: int,
    seed: int = 42,
    key: str = "doc_id",
    text: str = "text",
    bucket_bytes: int = BUCKET_BYTES,
) -> DataFrame:
    """All rows and columns of ``docs`` in random order, plus shard (int) and slot (long).

    Shards 0 to ``n_shards - 1`` hold row counts at most one apart; slots of a shard
    run from 0 without gaps. Columns of ``docs`` named shard or slot, in whatever case,
    are replaced. An empty table gives an empty one.

    First pass: rows are counted per bucket, a seeded hash of key and text modulo as
    many buckets as keep one near ``bucket_bytes``; running totals give each bucket's
    first position. Second pass: rows go to their buckets, are sorted by hash (so that
    a rerun starts from the same order), and each bucket gets a Fisher-Yates shuffle.
    Position in that order decides shard and slot. The text is part of the hash, so
    rows sharing a key spread. Rows equal in key and text would meet in one bucket:
    where they fill it, equal rows are counted (before any shuffle) and each copy gets
    its number, which is then part of the hash (:func:`_apart`). Tasks hold about one
    bucket's bytes, however large the table. Null keys and texts hash like any value; no
    row is ever dropped.
    """
    docs = without(docs, ("shard", "slot"))
    size = F.octet_length(or_empty(F.col(text))) + 16
    n_bytes = docs.agg(F.sum(size)).first()[0] or 0
    n_buckets = max(4 * n_shards, -(-n_bytes // bucket_bytes))
    n_tasks = max(1, min(n_buckets, -(-n_bytes // bucket_bytes)))
    same = (F.col(key), F.col(text))
    bucket = F.pmod(F.xxhash64(F.lit(seed), *same), F.lit(n_buckets))
    order = F.xxhash64(F.lit(seed + 1), *same)

    sized = docs.groupBy(bucket.alias("_bucket")).agg(
        F.count("*").alias("_rows"), F.sum(size).alias("_bytes")
    )
    sized = kept_safe(sized)
    counts, placed = sized.select("_bucket", "_rows"), _placed(docs, bucket, order)
    full = sized.filter(F.col("_bytes") > 2 * bucket_bytes).select("_bucket")
    n_full = full.count()
    if n_full:
        inside = docs.select(bucket.alias("_bucket"), order.alias("_order"), size.alias("_size"))
        groups = inside.join(small_side(full, n_full), "_bucket", "left_semi").groupBy("_order")
        heavy = groups.agg(F.sum("_size").alias("_bytes"), F.count("*").alias("_rows"))
        heavy = heavy.filter((F.col("_rows") > 1) & (F.col("_bytes") * 16 > bucket_bytes))
        heavy = kept_safe(heavy.select("_order"))
        n_heavy = heavy.count()
        if n_heavy:
            placed = _apart(placed, small_side(heavy, n_heavy), seed, n_buckets)
            counts = kept_safe(placed.groupBy("_bucket").agg(F.count("*").alias("_rows")))
    starts = kept_safe(running_totals(counts, "_bucket", "_rows").select("_bucket", "before"))
    n_rows = counts.agg(F.sum("_rows")).first()[0] or 0
    least, more = divmod(n_rows, n_shards)

    scattered = placed.repartition(n_tasks, "_bucket").sortWithinPartitions("_bucket", "_order")
    mixed = (
        scattered.groupBy("_bucket")
        .agg(F.collect_list("_row").alias("_rows"))
        .select("_bucket", F.posexplode(F.shuffle("_rows", seed)).alias("_pos", "_row"))
    )
    place = F.col("before") + F.col("_pos")
    border = F.lit(more * (least + 1)).cast("long")
    past = place - border
    width, rest = F.lit(least + 1).cast("long"), F.lit(max(least, 1)).cast("long")
    early = place < border
    return mixed.join(small_side(starts, n_buckets), "_bucket").select(
        "_row.*",
        F.when(early, F.floor(place / width))
        .otherwise(F.lit(more) + F.floor(past / rest))
        .cast("int")
        .alias("shard"),
        F.when(early, place % width).otherwise(past % rest).alias("slot"),
    )


def _placed(docs: DataFrame, bucket: Column, order: Column) -> DataFrame:
    """Rows as one struct each, with their bucket and their order inside it."""
    return docs.select(bucket.alias("_bucket"), order.alias("_order"), F.struct("*").alias("_row"))


def _apart(placed: DataFrame, heavy: DataFrame, seed: int, n_buckets: int) -> DataFrame:
    """``placed`` with the copies of heavy groups dealt out over all buckets.

    Copies equal in every column are interchangeable, so it is enough to know how many
    there are: they are counted, which each task does for itself before the shuffle, and
    made again with the numbers 0 to n - 1. Row and number decide the new bucket, so rows
    of a group that differ in other columns part as well. The same rows always give the
    same buckets, whatever the partitions and however often a task is run again.
    """
    copies = placed.join(heavy, "_order", "left_semi").groupBy("_row").agg(
        F.count("*").alias("_copies")
    )
    numbered = copies.select(
        "_row",
        F.xxhash64(F.to_json(F.struct("_row"))).alias("_whole"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("_copies") - 1)).alias("_copy"),
    )
    dealt = numbered.select(
        F.pmod(F.xxhash64(F.lit(seed), "_whole", "_copy"), F.lit(n_buckets)).alias("_bucket"),
        F.xxhash64(F.lit(seed + 1), "_whole", "_copy").alias("_order"),
        "_row",
    )
    return placed.join(heavy, "_order", "left_anti").select(*dealt.columns).unionByName(dealt)
