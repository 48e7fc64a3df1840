"""Sharding against brute force, with heavy groups of equal rows."""

from __future__ import annotations

import zlib
from collections import Counter

from pyspark.sql import functions as F

from tillstream.llm.catalogue import SHARDS, op1_sharding
from tillstream.llm.shards import shuffled_shards

SCHEMA = "doc_id long, text string, source string"


def places_of(rows, n):
    """Slots by shard; every shard even and without gaps."""
    slots = {}
    for r in rows:
        slots.setdefault(r.shard, []).append(r.slot)
    sizes = [len(slots.get(k, [])) for k in range(n)]
    assert max(sizes) - min(sizes) <= 1 and sum(sizes) == len(rows)
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    return slots


def equal_rows(spark):
    kind = F.col("id") % 3
    return spark.range(30_000).select(
        F.when(kind > 0, kind).alias("doc_id"),
        F.when(kind == 1, F.repeat(F.lit("ab "), 40)).when(kind == 2, "").alias("text"),
        F.when(F.col("id") % 5 > 0, "mine").alias("source"),
    )


def test_equal_rows_spread_over_all_shards(spark):
    docs = equal_rows(spark)
    got = shuffled_shards(docs, 6, bucket_bytes=1 << 16).collect()
    want = Counter((r.doc_id, r.text, r.source) for r in docs.collect())
    assert Counter((r.doc_id, r.text, r.source) for r in got) == want
    places_of(got, 6)
    kinds = Counter((r.shard, r.doc_id) for r in got)
    assert all(1_400 < kinds[s, k] < 1_900 for s in range(6) for k in (None, 1, 2))


def test_heavy_rows_part_by_other_columns_and_are_the_same_again(spark):
    docs = spark.range(4_000).select(
        F.lit(7).alias("doc_id"),
        F.repeat(F.lit("x"), 500).alias("text"),
        F.create_map(F.lit("n"), F.col("id") % 2000).alias("facts"),
    )
    runs = [
        sorted((r.shard, r.slot, r.facts["n"]) for r in shuffled_shards(d, 4, bucket_bytes=1 << 14).collect())
        for d in (docs, docs.repartition(13))
    ]
    assert runs[0] == runs[1]
    assert Counter(n for _, _, n in runs[0]) == {n: 2 for n in range(2_000)}


def test_the_query_by_brute_force(spark, tmp_path):
    data = [(i, "w" * (i % 50), "s") for i in range(300)]
    data += [(None, None, None), (1, "\u00fc\U0001f642", None), (5, "", "s"), (5, "", "s")]
    spark.createDataFrame(data, SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    got = op1_sharding(spark, str(tmp_path)).collect()
    texts = [(i, (t or "").encode()) for i, t, _ in data]
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == Counter(
        (i, len(t) + 16, zlib.crc32(t)) for i, t in texts
    )
    assert all(r.law == "rows" and r.grown_shard is None for r in got)
    places_of(got, SHARDS)
