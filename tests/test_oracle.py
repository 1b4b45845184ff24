"""Every registered query against its DuckDB oracle (rows-only queries: they run)."""

import math

import duckdb
import pytest

from kestrel.plans.registry import ORACLES, QUERIES, load_all
from kestrel.sources.tables import TABLES

load_all()


def _norm(v):
    if v is None:
        return "∅"
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 9))
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_norm(x) for x in v) + "]"
    if isinstance(v, dict):
        return "{" + ",".join(f"{k}:{_norm(x)}" for k, x in sorted(v.items())) + "}"
    if hasattr(v, "asDict"):
        return _norm(v.asDict(recursive=True))
    if hasattr(v, "isoformat"):
        return v.isoformat(sep=" ") if hasattr(v, "hour") else v.isoformat()
    return str(v)


@pytest.fixture(scope="module")
def con(sf_dir):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_oracle(spark, sf_dir, con, name):
    df = QUERIES[name](spark, sf_dir)
    cols, rows = df.columns, df.collect()
    r = con.execute(ORACLES[name])
    ocols = [d[0] for d in r.description]
    orows = r.fetchall()
    assert sorted(cols) == sorted(ocols)
    idx = [ocols.index(c) for c in cols]
    got = sorted("|".join(_norm(x) for x in row) for row in rows)
    want = sorted("|".join(_norm(row[i]) for i in idx) for row in orows)
    assert len(got) == len(want)
    assert got == want


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_rows_only_queries_run(spark, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    assert df.count() > 0
    assert len(df.columns) > 0
