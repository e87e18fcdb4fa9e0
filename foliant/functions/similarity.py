"""Likeness of names by common subsequences, as Arrow functions."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def common(a: str, b: str) -> int:
    """Length of the longest common subsequence, by bits."""
    at: dict[str, int] = {}
    for i, ch in enumerate(b):
        at[ch] = at.get(ch, 0) | 1 << i
    free = (1 << len(b)) - 1
    every = free
    for ch in a:
        u = free & at.get(ch, 0)
        free = (free + u | free - u) & every
    return len(b) - free.bit_count()


def indel(a: str, b: str) -> float:
    """100 * 2 * common subsequence over both lengths."""
    return 200.0 * common(a, b) / (len(a) + len(b)) if a or b else 100.0


def token_set(a: str, b: str) -> float:
    """The best of: shared tokens against each side's, and the sides against each other."""
    x, y = set(a.split()), set(b.split())
    if not x or not y:
        return 0.0
    both, left, right = (" ".join(sorted(s)) for s in (x & y, x - y, y - x))
    if both and (not left or not right):
        return 100.0
    one, two = f"{both} {left}".strip(), f"{both} {right}".strip()
    scores = [indel(one, two)]
    if both:
        scores += [indel(both, one), indel(both, two)]
    return max(scores)


def partial(a: str, b: str) -> float:
    """The best ratio of the shorter text against any stretch of the longer one, of at most its length."""
    a, b = sorted((a, b), key=len)
    if not a:
        return 0.0
    n = len(a)
    return max(indel(a, b[max(0, k) : k + n]) for k in range(1 - n, len(b)))


def name_likeness(found: Column, names: Column) -> Column:
    """struct<score, name>: the most similar of an array of normalised names; 0 and null for empty ones."""

    @F.pandas_udf("score double, name string")
    def best(texts: pd.Series, targets: pd.Series) -> pd.DataFrame:
        rows = []
        for t, many in zip(texts, targets):
            scored = [(max(token_set(t, n), partial(t, n)), n) for n in (many if many is not None else ()) if n] if t else []
            rows.append(max(scored, key=lambda x: x[0]) if scored else (0.0, None))
        return pd.DataFrame(rows, columns=["score", "name"])

    return best(found, names)
