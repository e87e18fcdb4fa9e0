"""Chains of replacements: which name or symbol an old one leads to in the end."""

from __future__ import annotations

from foliant.session import cut
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def follow(edges: DataFrame, old: str, new: str, most: int = 64) -> DataFrame:
    """(old, last, hops): each old value followed to the end of its chain; a chain stops before it meets itself.

    ``edges`` hold one new value per old one; null ends are none. Each round is one equi-join over
    the chains that still go on, so rounds are as many as the longest chain is long; more than
    ``most`` raise rather than cut a chain short.
    """
    step = cut(edges.select(F.col(old).alias("__old"), F.col(new).alias("__new")).dropna().filter("__old <> __new"))
    now = step.select(F.col("__old").alias(old), F.col("__new").alias("last"), F.array("__old", "__new").alias("seen"), F.lit(1).alias("hops"))
    done = None
    for _ in range(most):
        both = cut(now.join(step, now["last"] == step["__old"], "left").withColumn("__on", F.coalesce(~F.array_contains("seen", F.col("__new")), F.lit(False))))
        ended = both.filter(~F.col("__on")).select(old, "last", "hops")
        done = ended if done is None else done.unionByName(ended)
        on = both.filter("__on")
        if on.isEmpty():
            return done
        now = on.select(old, F.col("__new").alias("last"), F.array_append("seen", F.col("__new")).alias("seen"), (F.col("hops") + 1).alias("hops"))
    raise RuntimeError(f"a chain is longer than {most}")
