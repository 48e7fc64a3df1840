"""Connected components of a graph too large for one machine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstream.llm.common import kept_safe


def _digest(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("hi", "lo"))).first()
    return tuple(row)


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (src, dst: long); component is
    the smallest node reachable. Nodes without an edge to another one are absent;
    rows with a null end, loops and repeated edges are ignored.

    Union-find as alternating stars: each node ties its larger neighbours, then its
    smaller ones, to the smallest it knows, until nothing changes (a logarithmic
    number of rounds). Every step is a minimum per node, reduced inside the map
    tasks, and a join that adaptive execution may split, so a hub with a third of
    all edges is no single task. Each round's edges are written to the shared folder.
    """
    now = kept_safe(
        edges.filter(F.col("src") != F.col("dst"))
        .select(F.greatest("src", "dst").alias("hi"), F.least("src", "dst").alias("lo"))
        .distinct()
    )
    seen = _digest(now)
    while seen[0]:
        both = now.select(F.col("hi").alias("u"), F.col("lo").alias("v")).union(
            now.select(F.col("lo").alias("u"), F.col("hi").alias("v"))
        )
        least = kept_safe(both.groupBy("u").agg(F.least("u", F.min("v")).alias("m")))
        large = kept_safe(
            both.filter("v > u")
            .join(least, "u")
            .select(F.col("v").alias("hi"), F.col("m").alias("lo"))
            .distinct()
        )
        roots = kept_safe(large.groupBy("hi").agg(F.min("lo").alias("m")))
        small = large.join(roots, "hi").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
        now = kept_safe(
            small.filter("hi <> lo").union(roots.select("hi", F.col("m").alias("lo"))).distinct()
        )
        before, seen = seen, _digest(now)
        if before == seen:
            break
    return now.select(F.col("hi").alias("node"), F.col("lo").alias("component")).union(
        now.select(F.col("lo").alias("node"), F.col("lo").alias("component")).distinct()
    )
