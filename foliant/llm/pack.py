"""Filling containers of fixed capacity (problem 8).

Linear grouping: large sizes are rounded up inside groups of equal cardinality; the few rounded
sizes are packed by the best configurations, found by column generation; actual items take the
places of rounded ones; leftovers and small items follow by best fit. One path at every size. Items of one size are
interchangeable, so the plan is made on the histogram of sizes, which has at most ``capacity``
entries however many items there are. The items themselves never leave the executors.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliant.operators.ranking import spread_rank
from foliant.session import cut

CAPACITY = 2048
#: Sizes over capacity / LARGE are large and go through the groups; the rest is packed by best fit.
LARGE = 3
GROUPS = 96
#: Rows a task ranks at once; classes of one size are spread over as many buckets as they need.
BUCKET_ROWS = 1_000_000

Load = tuple[tuple[int, int], ...]  # ((size, copies), ...) of one container


def _groups(hist: dict[int, int], groups: int) -> list[list[int]]:
    """Large sizes, largest first, in runs of about equal cardinality; each its own if they are few."""
    if len(hist) <= groups:
        return [[s] for s in sorted(hist, reverse=True)]
    total, seen = sum(hist.values()), 0
    out: dict[int, list[int]] = defaultdict(list)
    for size in sorted(hist, reverse=True):
        out[min(groups - 1, seen * groups // total)].append(size)
        seen += hist[size]
    return [out[k] for k in sorted(out)]


def _knapsack(sizes: list[int], values: np.ndarray, capacity: int) -> np.ndarray:
    """Copies of each size that fit and are worth most."""
    order = np.argsort(sizes, kind="stable")
    size, value = np.array(sizes)[order], np.asarray(values)[order]
    fits = np.searchsorted(size, np.arange(capacity + 1), side="right")
    best, pick = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    for c in range(1, capacity + 1):
        best[c] = best[c - 1]
        if fits[c]:
            worth = best[c - size[: fits[c]]] + value[: fits[c]]
            k = int(worth.argmax())
            if worth[k] > best[c] + 1e-12:
                best[c], pick[c] = worth[k], order[k]
    out, c = np.zeros(len(sizes)), capacity
    while c > 0:
        if pick[c] < 0:
            c -= 1
        else:
            out[pick[c]] += 1
            c -= sizes[pick[c]]
    return out


def configurations(sizes: list[int], demand: list[int], capacity: int, rounds: int = 200) -> list[tuple[np.ndarray, int]]:
    """(copies of each size, times) by column generation, rounded down; never more than demanded rows need."""
    n = len(sizes)
    basis = np.diag([float(capacity // s) for s in sizes])
    need = np.array(demand, float)
    amount = np.linalg.solve(basis, need)
    for _ in range(rounds):
        price = np.linalg.solve(basis.T, np.ones(n))
        column = _knapsack(sizes, price, capacity)
        if price @ column <= 1 + 1e-9:
            break
        way = np.linalg.solve(basis, column)
        ratio = np.where(way > 1e-12, amount / np.where(way > 1e-12, way, 1), np.inf)
        out = int(np.argmin(ratio))
        basis[:, out] = column
        amount = np.maximum(np.linalg.solve(basis, need), 0)
    return [(basis[:, k].astype(int), int(amount[k] + 1e-9)) for k in range(n) if amount[k] >= 1 - 1e-9]


def plan_containers(hist: dict[int, int], capacity: int = CAPACITY, groups: int = GROUPS) -> list[tuple[Load, int]]:
    """(load, number of containers with it), for a histogram of sizes from 1 to ``capacity``.

    Always by linear grouping of the large sizes, at every size of the input.
    """
    if any(s < 1 or s > capacity for s in hist):
        raise ValueError("a size is not between 1 and the capacity")
    left = {s: n for s, n in hist.items() if n > 0}
    open_: dict[int, list[tuple[Load, int]]] = defaultdict(list)  # by room
    large = {s: n for s, n in left.items() if s * LARGE > capacity}
    if large:
        runs = _groups(large, groups)
        tops = [run[0] for run in runs]
        for copies, times in configurations(tops, [sum(large[s] for s in run) for run in runs], capacity):
            parts: list[tuple[Load, int]] = [((), times)]
            for g, k in enumerate(copies):
                for _ in range(k):
                    filled: list[tuple[Load, int]] = []
                    for load, count in parts:
                        while count:
                            size = next((s for s in runs[g] if left[s]), None)
                            if size is None:
                                filled.append((load, count))
                                break
                            take = min(count, left[size])
                            left[size] -= take
                            count -= take
                            filled.append((_with(load, size, 1), take))
                    parts = filled
            for load, count in parts:
                if load:
                    open_[capacity - sum(s * k for s, k in load)].append((load, count))
    for size in sorted(left, reverse=True):
        n = left[size]
        room = size
        while n:
            while room <= capacity and not open_[room]:
                room += 1
            if room > capacity:
                open_[capacity].append(((), -(-n // (capacity // size))))
                room = capacity
            load, count = open_[room].pop()
            fit = room // size
            full = min(count, n // fit)
            if full:
                open_[room - fit * size].append((_with(load, size, fit), full))
            n, count = n - full * fit, count - full
            if n and n < fit and count:
                open_[room - n * size].append((_with(load, size, n), 1))
                n, count = 0, count - 1
            if count and (load or n):
                open_[room].append((load, count))
    return [x for room in sorted(open_) for x in open_[room] if x[0]]


def _with(load: Load, size: int, copies: int) -> Load:
    held = dict(load)
    held[size] = held.get(size, 0) + copies
    return tuple(held.items())


def slots(plan: list[tuple[Load, int]]) -> dict[int, np.ndarray]:
    """By size: rows (first rank, copies per container, first container), in order of rank."""
    out: dict[int, list[tuple[int, int, int]]] = defaultdict(list)
    used: dict[int, int] = defaultdict(int)
    first = 0
    for load, count in plan:
        for size, copies in load:
            out[size].append((used[size], copies, first))
            used[size] += copies * count
        first += count
    return {s: np.array(rows, np.int64) for s, rows in out.items()}


def pack_items(
    sizes: DataFrame, id_col: str = "doc_id", size_col: str = "n_tokens", capacity: int = CAPACITY
) -> DataFrame:
    """(id, part_no, n_tokens, first_token, container_id): every item in exactly one container.

    Only an item larger than the capacity is cut: into full parts and one remainder. Items of size
    0 take no room and go to container 0; null sizes count as 0. ``id`` must be unique. Ties of
    size are placed by a hash of the id, so the result does not depend on partitioning. An empty
    table gives no rows. The broadcast plan has at most a few rows per size.
    """
    spark = sizes.sparkSession
    item = cut(
        sizes.select(F.col(id_col), F.coalesce(F.col(size_col), F.lit(0)).cast("long").alias("__size")).select(
            id_col,
            "__size",
            F.explode(F.sequence(F.lit(0), F.greatest(F.ceil(F.col("__size") / capacity) - 1, F.lit(0)).cast("int"))).alias(
                "part_no"
            ),
        ).select(
            id_col,
            "part_no",
            F.least(F.lit(capacity), F.col("__size") - F.col("part_no") * F.lit(capacity)).cast("int").alias("n_tokens"),
        )
    )
    hist = {r["n_tokens"]: r["n"] for r in item.groupBy("n_tokens").agg(F.count("*").alias("n")).collect()}
    most = max(hist.values(), default=0)
    hist.pop(0, None)
    table = spark.sparkContext.broadcast(slots(plan_containers(hist, capacity)))
    buckets = max(64, -(-most // BUCKET_ROWS))
    bucket = F.pmod(F.xxhash64(id_col, "part_no"), F.lit(buckets))
    ranked = spread_rank(item, ["n_tokens"], bucket, [F.col(id_col), F.col("part_no")], "__rank")

    @F.pandas_udf("long")
    def place(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        plan = table.value
        for size, rank in batches:
            out = np.zeros(len(size), np.int64)
            size, rank = size.to_numpy(), rank.to_numpy()
            for s in np.unique(size):
                if s > 0:
                    at = np.flatnonzero(size == s)
                    rows = plan[int(s)]
                    row = rows[np.searchsorted(rows[:, 0], rank[at], side="right") - 1]
                    out[at] = row[:, 2] + (rank[at] - row[:, 0]) // row[:, 1]
            yield pd.Series(out)

    return ranked.select(
        id_col,
        "part_no",
        "n_tokens",
        (F.col("part_no").cast("long") * capacity).alias("first_token"),
        place("n_tokens", "__rank").alias("container_id"),
    )
