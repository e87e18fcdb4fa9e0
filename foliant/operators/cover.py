"""Selections that cover rare conditions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliant.session import cut


def rarity(pairs: DataFrame, item: str, condition: str, scale: int = 1_000_000) -> DataFrame:
    """(item, score): the sum over an item's conditions of scale / number of items that show it."""
    own = pairs.select(item, condition).distinct()
    weight = own.groupBy(condition).agg(F.count("*").alias("__n"))
    worth = F.floor(F.lit(scale) / F.col("__n"))
    return own.join(weight, condition).groupBy(item).agg(F.sum(worth).cast("long").alias("score"))


def greedy_cover(pairs: DataFrame, item: str, condition: str) -> DataFrame:
    """(step, item, n_new): items chosen until every condition is covered, rarest worth first.

    Each step is one aggregation over the conditions not covered yet; there are at most as many
    steps as conditions, and conditions are a fixed list. Ties go to the least item.
    """
    spark = pairs.sparkSession
    left = cut(pairs.select(item, condition).distinct())
    chosen = []
    while True:
        weight = left.groupBy(condition).agg(F.count("*").alias("__n"))
        worth = left.join(F.broadcast(weight), condition).groupBy(item).agg(
            F.sum(F.floor(F.lit(1_000_000) / F.col("__n"))).alias("w"), F.count("*").alias("n"))
        best = worth.orderBy(F.desc("w"), item).limit(1).first()
        if best is None:
            break
        chosen.append((len(chosen), best[item], best["n"]))
        done = left.filter(F.col(item) == best[item]).select(condition)
        left = cut(left.join(F.broadcast(done), condition, "left_anti"))
    kind = pairs.schema[item].dataType.simpleString()
    return spark.createDataFrame(chosen, f"step int, `{item}` {kind}, n_new long")
