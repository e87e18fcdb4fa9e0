"""Layout of blocks on a page: reading order, gutters, covered area."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from foliant.session import ship
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DEPTH = 6
LEAST_GAP = 4.0


def _widest_gap(spans: list[tuple[float, float]]) -> tuple[float, float]:
    """(width, middle) of the widest gap between intervals."""
    best, at, reach = 0.0, 0.0, None
    for a, b in sorted(spans):
        if reach is not None and a - reach > best:
            best, at = a - reach, (a + reach) / 2
        reach = b if reach is None else max(reach, b)
    return best, at


def reading_order(boxes: list[tuple[float, float, float, float]], depth: int = DEPTH) -> list[int]:
    """Positions of boxes (x0, y0, x1, y1) in reading order, by alternate cuts at the widest gaps.

    A page is cut into columns where a vertical gap runs through it, into bands where a horizontal
    one does; the wider gap goes first. What cannot be cut is read from the top, then from the left.
    """

    def walk(ids: list[int], left: int) -> list[int]:
        if len(ids) > 1 and left:
            gx, x = _widest_gap([(boxes[i][0], boxes[i][2]) for i in ids])
            gy, y = _widest_gap([(boxes[i][1], boxes[i][3]) for i in ids])
            if max(gx, gy) >= LEAST_GAP:
                side, at = (0, x) if gx > gy else (1, y)
                first = [i for i in ids if boxes[i][side] < at]
                rest = [i for i in ids if boxes[i][side] >= at]
                return walk(first, left - 1) + walk(rest, left - 1)
        return sorted(ids, key=lambda i: (boxes[i][1], boxes[i][0], i))

    return walk(list(range(len(boxes))), depth)


def order_blocks(pages: DataFrame, keys: list[str], blocks: str = "blocks") -> DataFrame:
    """(keys, order array<int>): block numbers of each page in reading order; null blocks give null.

    A page is the unit: its blocks come in one array, so no grouping is needed.
    """

    @F.pandas_udf("array<int>")
    def order(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in batches:
            yield pd.Series(
                [None if b is None else reading_order([(x["x0"], x["y0"], x["x1"], x["y1"]) for x in b]) for b in s]
            )

    ship(pages.sparkSession)
    boxes = F.transform(blocks, lambda b: F.struct(b["x0"].alias("x0"), b["y0"].alias("y0"), b["x1"].alias("x1"), b["y1"].alias("y1")))
    return pages.select(*keys, order(boxes).alias("order"))


def vertical_gaps(blocks: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, gap, at): the widest band of a page that no block touches, by a running end of blocks."""
    w = Window.partitionBy(*keys).orderBy("y0", "y1").rowsBetween(Window.unboundedPreceding, -1)
    reach = blocks.withColumn("reach", F.max("y1").over(w)).withColumn("gap", F.col("y0") - F.col("reach"))
    best = F.max_by(F.struct("gap", F.col("reach").alias("at")), F.struct("gap", -F.col("reach")))
    return reach.filter("gap > 0").groupBy(*keys).agg(best.alias("b")).select(*keys, "b.gap", "b.at")


def covered_cells(blocks: Column, width: float, height: float, grid: int = 40) -> Column:
    """Cells of a grid x grid page that some block of an array covers, each counted once; in the page's own row.

    Each row of the grid is one number whose bits are its columns (so ``grid`` is at most 62); blocks
    are joined bit by bit.
    """
    cell = lambda v, size: F.least(F.lit(grid - 1), F.greatest(F.lit(0), F.floor(v * grid / size).cast("int")))
    bit = lambda n: F.call_function("shiftleft", F.lit(1).cast("long"), n)
    spans = F.transform(blocks, lambda b: F.struct(
        cell(b["y0"], height).alias("r0"), cell(b["y1"], height).alias("r1"), (bit(cell(b["x1"], width) + 1) - bit(cell(b["x0"], width))).alias("mask")))
    own = lambda r: F.filter(spans, lambda s: (s["r0"] <= r) & (s["r1"] >= r))
    rows = F.transform(F.sequence(F.lit(0), F.lit(grid - 1)), lambda r: F.bit_count(F.aggregate(own(r), F.lit(0).cast("long"), lambda a, s: a.bitwiseOR(s["mask"]))))
    return F.aggregate(rows, F.lit(0).cast("long"), lambda a, n: a + n)
