"""Connected components of undirected graphs, without moving the graph to the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliant.session import cut


def _fingerprint(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(
        F.count("*").alias("n"), F.sum(F.pmod(F.xxhash64("u", "v"), F.lit(1 << 40))).alias("h")
    ).first()
    return row["n"], row["h"] or 0


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
    return (
        both.join(least, "u").filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    ).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").filter(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def connected_components(edges: DataFrame, left: str, right: str, max_rounds: int = 60) -> DataFrame:
    """(node, component) of every node of ``edges``; the component is the least node in it.

    Alternating large-star and small-star rounds: each is a partial minimum and an equi-join, so a
    hub is combined map-side and skewed joins are split at run time. Every round is cut by a
    reliable checkpoint. Null ends and loops are no edges. Needs O(log n) rounds; if ``max_rounds``
    do not suffice it raises rather than return a wrong result.
    """
    ends = edges.select(F.greatest(left, right).alias("__hi"), F.least(left, right).alias("__lo"))
    now = cut(ends.filter("__lo < __hi").distinct().toDF("u", "v"))
    seen = _fingerprint(now)
    for _ in range(max_rounds):
        now = cut(_small_star(_large_star(now)))
        mark = _fingerprint(now)
        if mark == seen:
            roots = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
            return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
        seen = mark
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")


def star_edges(df: DataFrame, node: str, key: str) -> DataFrame:
    """(u, v): every node that shares a key, linked to the least node of that key; never all pairs."""
    own = df.select(F.col(node).alias("u"), F.col(key).alias("k")).dropna().distinct()
    hubs = own.groupBy("k").agg(F.min("u").alias("v"), F.max("u").alias("w")).filter("v < w").drop("w")
    return own.join(hubs, "k").filter("u != v").select("u", "v").distinct()
