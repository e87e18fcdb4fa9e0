"""Exact ranks inside classes of any size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def spread_rank(
    df: DataFrame,
    keys: list[str],
    bucket: Column,
    order: list[Column],
    name: str = "rank",
) -> DataFrame:
    """Adds the 0-based rank of each row inside its class ``keys``.

    A class may hold any share of the rows: rows are first spread over ``bucket``, ranked inside
    (class, bucket) and shifted by the size of the class's lower buckets. If ``bucket`` rises with
    ``order`` the rank is the rank by ``order``; with a hash as bucket it is any fixed enumeration.
    ``order`` must be total for a reproducible result. Null class keys form a class of their own.
    """
    part = df.withColumn("__bucket", bucket)
    within = Window.partitionBy(*keys, "__bucket").orderBy(*order)
    ranked = part.withColumn("__row", F.row_number().over(within) - 1)
    sizes = part.groupBy(*keys, "__bucket").agg(F.count("*").alias("__n"))
    below = Window.partitionBy(*keys).orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.withColumn("__start", F.coalesce(F.sum("__n").over(below), F.lit(0))).drop("__n")
    same = F.lit(True)
    for k in [*keys, "__bucket"]:
        same = same & F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}"))
    return (
        ranked.alias("a")
        .join(starts.alias("b"), same, "inner")
        .select("a.*", (F.col("a.__row") + F.col("b.__start")).cast("long").alias(name))
        .drop("__bucket", "__row")
    )


def class_sizes(df: DataFrame, keys: list[str], name: str = "class_size") -> DataFrame:
    """Adds to each row the size of its class, by a partial count and a join."""
    sizes = df.groupBy(*keys).agg(F.count("*").alias(name))
    same = F.lit(True)
    for k in keys:
        same = same & F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}"))
    return df.alias("a").join(sizes.alias("b"), same, "inner").select("a.*", F.col(f"b.{name}"))
