import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))


@pytest.fixture(scope="session")
def spark():
    from foliant.session import local_session, ship

    s = local_session(cpus=4, partitions=4, memory="3g")
    s.sparkContext.setLogLevel("ERROR")
    ship(s)
    yield s
    s.stop()


@pytest.fixture(scope="session")
def data():
    d = Path("/root/testdata/sf0.001")
    if not d.exists():
        pytest.skip("no test data here")
    return str(d)


@pytest.fixture(scope="session")
def same():
    """Compares a query with its SQL: same columns and rows, in any order."""
    import math

    import duckdb

    def plain(v):
        if isinstance(v, float):
            return "nan" if math.isnan(v) else f"{v:.9g}"
        if hasattr(v, "asDict"):
            v = list(v.asDict().values())
        if isinstance(v, dict):
            v = list(v.values())
        if isinstance(v, (list, tuple)):
            return "[" + ",".join(plain(x) for x in v) + "]"
        return f"{float(v):.9g}" if type(v).__name__ == "Decimal" else str(v)

    def check(df, sql, folder):
        con = duckdb.connect()
        con.execute("SET timezone = 'UTC'")
        for f in Path(folder).glob("*.parquet"):
            con.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM read_parquet('{f}')")
        got = con.execute(sql)
        names = [c[0] for c in got.description]
        assert sorted(names) == sorted(df.columns)
        cols = sorted(names)
        want = sorted([plain(r[names.index(c)]) for c in cols] for r in got.fetchall())
        have = sorted([plain(r[c]) for c in cols] for r in df.collect())
        assert have == want

    return check
