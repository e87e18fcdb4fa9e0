"""Splits that keep related records together (problem 4).

Companies that share a file or list each other are components. Components are spread over many
equal bins by largest differencing, whole bins are then dealt to the splits by target share.
Components of one weight are interchangeable, so differencing works on the histogram of weights:
n records have at most sqrt(2n) different weights, and no component reaches the driver.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliant.operators.graph import connected_components, star_edges
from foliant.operators.ranking import spread_rank
from foliant.session import cut

BINS = 40
#: Components a task ranks at once; those of one weight are spread over as many buckets as they need.
BUCKET_ROWS = 1_000_000
SPLITS = ("FIT", "VALIDATION", "HOLDOUT")


def normal_hash(c: Column) -> Column:
    """A file hash without letter case and outer blanks; empty and all-zero hashes are null."""
    bare = F.lower(F.regexp_replace(c, r"^\s+|\s+$", ""))
    return F.when(~bare.rlike("^0*$"), bare)


def normal_locator(c: Column) -> Column:
    """An http address without scheme, letter case, query and fragment; other locators are null."""
    bare = F.lower(F.regexp_replace(c, r"^\s+|\s+$", ""))
    rest = F.regexp_replace(F.regexp_replace(bare, "^https?://", ""), "[?#].*$", "")
    return F.when(bare.rlike("^https?://[^?#]"), rest)


def company_edges(records: DataFrame, companies: DataFrame) -> DataFrame:
    """(u, v) links between company ids, a star per shared file; null and blank ids have none."""
    own = records.select(
        F.col("company_id"), normal_hash(F.col("sha256")).alias("h"), normal_locator(F.col("source_locator")).alias("l")
    ).filter("trim(company_id) <> ''")
    listed = (
        companies.select(F.col("company_id").alias("u"), F.explode(F.split("alternate_isins", r"\|")).alias("v"))
        .select("u", F.trim("v").alias("v"))
        .filter("trim(u) <> '' and v <> '' and u <> v")
    )
    return star_edges(own, "company_id", "h").unionByName(star_edges(own, "company_id", "l")).unionByName(listed)


def related_components(records: DataFrame, companies: DataFrame) -> DataFrame:
    """(node, component) of the company ids that are related to another."""
    return connected_components(company_edges(records, companies), "u", "v")


def related_pairs(records: DataFrame, companies: DataFrame) -> DataFrame:
    """(company_id_a, company_id_b), a < b: every pair of company ids that must share a split."""
    who = cut(related_components(records, companies))
    a = who.select("component", F.col("node").alias("company_id_a"))
    b = who.select("component", F.col("node").alias("company_id_b"))
    return a.join(b, "component").filter("company_id_a < company_id_b").drop("component")


def difference(weights: dict[int, int], bins: int = BINS) -> tuple[dict[int, list[tuple[int, int, int]]], np.ndarray]:
    """Largest differencing of ``weights`` (weight -> number of components) into ``bins``.

    Returns for each weight the rows (first rank, number, bin) and the bins' loads. Of n components
    of one weight, n // bins go into every bin, which changes no difference; what remains, fewer
    than ``bins`` per weight, is combined by repeatedly merging the two partial assignments with
    the widest spread, the heavy end of one with the light end of the other.
    """
    rows: dict[int, list[tuple[int, int, int]]] = {}
    load = np.zeros(bins, np.int64)
    heap: list[tuple[int, int, np.ndarray, tuple]] = []
    serial = 0
    for w in sorted(weights, reverse=True):
        each, rest = divmod(weights[w], bins)
        rows[w] = [(k * each, each, k) for k in range(bins)] if each else []
        load += each * w
        for _ in range(rest):
            one = np.zeros(bins, np.int64)
            one[-1] = w
            heap.append((-w, serial, one, (serial, w)))
            serial += 1
    heapq.heapify(heap)
    while len(heap) > 1:
        _, i, x, tx = heapq.heappop(heap)
        _, j, y, ty = heapq.heappop(heap)
        z = x + y[::-1]
        order = np.argsort(z, kind="stable")
        z = z[order]
        heapq.heappush(heap, (int(z[0] - z[-1]), serial, z, (tx, ty, order)))
        serial += 1
    if heap:
        _, _, z, tree = heap[0]
        load = load + z
        used = {w: (weights[w] // bins) * bins for w in weights}
        stack = [(tree, np.arange(bins))]  # place[k]: the final bin of this part's k-th bin
        while stack:
            node, place = stack.pop()
            if len(node) == 2:
                w = node[1]
                rows[w].append((used[w], 1, int(place[-1])))
                used[w] += 1
            else:
                tx, ty, order = node
                back = np.empty(bins, np.int64)
                back[order] = place
                stack += [(tx, back), (ty, back[::-1])]
    return rows, load


def deal(load: np.ndarray, targets: dict[str, float]) -> list[str]:
    """A split for each bin: heaviest bin first, to the split that lacks most."""
    total, share = load.sum(), sum(targets.values())
    lack = {s: total * t / share for s, t in targets.items()}
    out = [""] * len(load)
    for k in np.argsort(-load, kind="stable"):
        s = max(lack, key=lambda x: (lack[x], x))
        out[k] = s
        lack[s] -= load[k]
    return out


def split_targets(register: DataFrame) -> dict[str, float]:
    """Target shares from the one row ``overall`` of the register."""
    row = register.filter("dimension = 'overall'").agg(
        F.max("fit_count").alias("FIT"),
        F.max("validation_count").alias("VALIDATION"),
        F.max("holdout_count").alias("HOLDOUT"),
    ).first()
    if any(row[s] is None for s in SPLITS):
        raise ValueError("the register has no overall row")
    return {s: float(row[s]) for s in SPLITS}


def grouped_split(records: DataFrame, companies: DataFrame, targets: dict[str, float], bins: int = BINS) -> DataFrame:
    """(document_id, company_id, component, split): one row per document.

    All documents of related companies share a split. Documents without company are components of
    their own. A document delivered several times counts once, under its least company id; null
    document ids have no row. Equal weights are told apart by a hash of the component, so reruns
    and partitionings agree. A component may hold any share of the documents; the shares of the
    splits then differ from the targets by what it weighs too much.
    """
    spark = records.sparkSession
    blank = F.when(F.trim("company_id") != "", F.col("company_id"))
    docs = records.filter("document_id is not null").groupBy("document_id").agg(F.min(blank).alias("company_id"))
    parts = related_components(records, companies)
    own = F.coalesce("component", "company_id", F.concat(F.lit("document:"), F.col("document_id")))
    member = cut(
        docs.join(parts.withColumnRenamed("node", "company_id"), "company_id", "left").select(
            "document_id", "company_id", own.alias("component")
        )
    )
    weight = cut(member.groupBy("component").agg(F.count("*").alias("weight")))
    hist = {r["weight"]: r["n"] for r in weight.groupBy("weight").agg(F.count("*").alias("n")).collect()}
    rows, load = difference(hist, bins)
    dealt = deal(load, targets)
    place = {w: (np.array(sorted(r), np.int64), np.array([dealt[b] for _, _, b in sorted(r)])) for w, r in rows.items()}
    known = spark.sparkContext.broadcast(place)
    buckets = max(64, -(-max(hist.values(), default=0) // BUCKET_ROWS))
    ranked = spread_rank(weight, ["weight"], F.pmod(F.xxhash64("component"), F.lit(buckets)), [F.col("component")], "__rank")

    @F.pandas_udf("string")
    def choose(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for weights, ranks in batches:
            w, r = weights.to_numpy(), ranks.to_numpy()
            out = np.empty(len(w), object)
            for x in np.unique(w):
                at = np.flatnonzero(w == x)
                starts, names = known.value[int(x)]
                out[at] = names[np.searchsorted(starts[:, 0], r[at], side="right") - 1]
            yield pd.Series(out)

    chosen = ranked.select("component", choose("weight", "__rank").alias("split"))
    return member.join(chosen, "component").select("document_id", "company_id", "component", "split")
