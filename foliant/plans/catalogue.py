"""All queries of the engine and their SQL."""

from __future__ import annotations

import importlib

FAMILIES = ("coverage", "pages", "scoring", "entities", "sections", "verification", "audit")


def never_null(sql: str) -> str:
    """``sql`` with every count_if(x) as a count of the rows for which x holds, which is 0, never null, over unknowns."""
    name, out = "count_if(", ""
    while name in sql:
        head, _, rest = sql.partition(name)
        depth, end = 1, 0
        while depth:
            depth += {"(": 1, ")": -1}.get(rest[end], 0)
            end += 1
        out += f"{head}count(CASE WHEN {never_null(rest[: end - 1])} THEN 1 END)"
        sql = rest[end:]
    return out + sql


_modules = [importlib.import_module(f"foliant.plans.{f}") for f in FAMILIES]
QUERIES = {k: f for m in _modules for k, f in m.QUERIES.items()}
ORACLES = {k: never_null(s) for m in _modules for k, s in m.ORACLES.items()}
