"""Repetition inside a single document (problem 9).

The share of words that stand in a repeated run is measured for each text. The cutoffs are no
fixed numbers: a mergeable KLL quantile sketch per language and source gives each group its own
outlier threshold, and a join brings the thresholds back to the documents.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliant.session import cut, ship

RUN_WORDS = 8
SHARE = 0.4
SKETCH_K = 400
QUANTILES = (0.5, 0.9)
SPREAD = 3.0
FLOOR = 0.05

_DROP = regex.compile(r"[^\p{L}\p{M}\s]+")


def _run_classes(codes: np.ndarray, run: int) -> tuple[np.ndarray, np.ndarray]:
    """Exact class of the run that starts at each word, and the classes' sizes, by doubling."""
    length = 1
    while length < run:
        step = min(length, run - length)
        pair = codes[:-step].astype(np.int64) * (int(codes.max()) + 1) + codes[step:]
        _, codes, count = np.unique(pair, return_inverse=True, return_counts=True)
        length += step
    if run == 1:
        _, codes, count = np.unique(codes, return_inverse=True, return_counts=True)
    return codes, count


def repeated_words(text: str | None, run: int = RUN_WORDS) -> tuple[int, int]:
    """(words, words inside a run of ``run`` or more words that occurs more than once)."""
    if not text:
        return 0, 0
    words = _DROP.sub("", text).lower().split()
    n = len(words)
    if n <= run:
        return n, 0
    ids: dict[str, int] = {}
    codes = np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.int32, n)
    back, count = _run_classes(codes, run)
    again = (count > 1)[back]
    if not again.any():
        return n, 0
    edge = np.zeros(n + 1, np.int32)
    at = np.flatnonzero(again)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + run, -1)
    return n, int((np.cumsum(edge[:n]) > 0).sum())


def repetition_share(df: DataFrame, text_col: str = "text", run: int = RUN_WORDS) -> DataFrame:
    """Adds ``n_words``, ``n_repeated`` and ``repeated_share``.

    Words are parted by white space; letter case, digits, punctuation and symbols are disregarded,
    and what has no letter is no word. Two occurrences may overlap. Null, empty and wordless texts
    have share 0. Whole texts are read; memory grows with one text, not with the table.
    """

    @F.pandas_udf("n_words int, n_repeated int")
    def measure(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in texts:
            yield pd.DataFrame([repeated_words(t, run) for t in batch], columns=["n_words", "n_repeated"])

    ship(df.sparkSession)
    out = df.withColumn("__m", measure(F.col(text_col)))
    out = out.withColumn("n_words", F.col("__m.n_words")).withColumn("n_repeated", F.col("__m.n_repeated"))
    share = F.when(F.col("n_words") > 0, F.col("n_repeated") / F.col("n_words")).otherwise(0.0)
    return out.withColumn("repeated_share", share).drop("__m")


def adaptive_thresholds(
    df: DataFrame, group_cols: list[str], value_col: str = "repeated_share", ceiling: float = SHARE
) -> DataFrame:
    """One row per group: its size, its quantiles and ``threshold``.

    The threshold is median + SPREAD * (90th percentile - median), at least FLOOR and at most
    ``ceiling``, so that no group of bad documents can hide them. Sketches are merged from partial
    ones: a group with a third of all rows costs no more than any other.
    """
    mid, high = (F.kll_sketch_get_quantile_double("__sketch", F.lit(q)) for q in QUANTILES)
    return (
        df.groupBy(*group_cols)
        .agg(F.count("*").alias("group_size"), F.kll_sketch_agg_double(value_col, F.lit(SKETCH_K)).alias("__sketch"))
        .withColumn("q_mid", mid)
        .withColumn("q_high", high)
        .withColumn(
            "threshold",
            F.least(
                F.lit(ceiling),
                F.greatest(F.lit(FLOOR), F.col("q_mid") + F.lit(SPREAD) * (F.col("q_high") - F.col("q_mid"))),
            ),
        )
        .drop("__sketch")
    )


def repetition_outliers(df: DataFrame, language: Column, source: Column, ceiling: float = SHARE) -> DataFrame:
    """Documents at or over the threshold of their language and source, with share and threshold, without texts.

    Unknown languages and sources are groups like any other. Repeated rows are kept as they are.
    """
    shares = repetition_share(df.withColumns({"__language": F.coalesce(language, F.lit("")), "__source": F.coalesce(source, F.lit(""))}))
    # The texts have done their work: what is kept for thresholds and join is measured once.
    shares = cut(shares.drop("text"))
    limits = adaptive_thresholds(shares, ["__language", "__source"], ceiling=ceiling)
    return (
        shares.join(limits, ["__language", "__source"])
        .filter(F.col("repeated_share") >= F.col("threshold"))
        .drop("__language", "__source")
    )


def repetition_cases(documents: DataFrame, label: Column) -> DataFrame:
    """(doc_id) of the documents of which at least four tenths are repeated."""
    own = documents.select("doc_id", "text", label.alias("language"), "source")
    found = repetition_outliers(own, F.col("language"), F.col("source"))
    return found.filter(F.col("n_repeated") * 10 >= F.col("n_words") * 4).filter("n_words > 0").select("doc_id").distinct()
