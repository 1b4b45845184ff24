"""Run registered queries on Spark and their SQL on DuckDB; compare the results.

    python tools/oracle_check.py [--sf /root/testdata/sf0.01] [name ...]

Mirrors the driver's gate: column names, row count, order-insensitive values.
"""

from __future__ import annotations

import argparse
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from kestrel.plans.registry import ORACLES, QUERIES, load_all  # noqa: E402
from kestrel.session import build_session  # noqa: E402
from kestrel.sources.tables import TABLES  # noqa: E402


def norm(v):
    if v is None:
        return "∅"
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(round(v, 9))
    if hasattr(v, "isoformat"):
        return v.isoformat(sep=" ") if hasattr(v, "hour") else v.isoformat()
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(norm(x) for x in v) + "]"
    if isinstance(v, dict):
        return "{" + ",".join(f"{k}:{norm(x)}" for k, x in sorted(v.items())) + "}"
    if hasattr(v, "asDict"):
        return norm(v.asDict(recursive=True))
    return str(v)


def duck_type(dt) -> str:
    """DuckDB type name of a Spark type (for the schema comparison)."""
    from pyspark.sql import types as T
    simple = {T.IntegerType: "INTEGER", T.LongType: "BIGINT", T.DoubleType: "DOUBLE", T.FloatType: "FLOAT",
              T.StringType: "VARCHAR", T.BooleanType: "BOOLEAN", T.DateType: "DATE",
              T.TimestampNTZType: "TIMESTAMP", T.TimestampType: "TIMESTAMP WITH TIME ZONE",
              T.ShortType: "SMALLINT", T.ByteType: "TINYINT"}
    for k, v in simple.items():
        if isinstance(dt, k):
            return v
    if isinstance(dt, T.ArrayType):
        return duck_type(dt.elementType) + "[]"
    if isinstance(dt, T.DecimalType):
        return f"DECIMAL({dt.precision},{dt.scale})"
    if isinstance(dt, T.StructType):
        return "STRUCT(" + ", ".join(f"{f.name} {duck_type(f.dataType)}" for f in dt.fields) + ")"
    return dt.simpleString().upper()


def main():
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    ap.add_argument("names", nargs="*")
    a = ap.parse_args()
    load_all()
    spark = build_session("local[8]", 8)
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{a.sf}/{t}.parquet')")
    names = a.names or sorted(QUERIES)
    bad = []
    for n in names:
        t0 = time.time()
        try:
            df = QUERIES[n](spark, a.sf)
            cols = df.columns
            rows = df.collect()
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {n}: spark error {type(e).__name__}: {str(e)[:400]}")
            bad.append(n)
            continue
        ts = time.time() - t0
        if n not in ORACLES:
            print(f"ROWS {n}: {len(rows)} rows  cols={cols} ({ts:.1f}s)")
            continue
        try:
            r = con.execute(ORACLES[n])
            ocols = [d[0] for d in r.description]
            orows = r.fetchall()
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {n}: duckdb error {str(e)[:400]}")
            bad.append(n)
            continue
        if sorted(cols) != sorted(ocols):
            print(f"FAIL {n}: columns spark={cols} oracle={ocols}")
            bad.append(n)
            continue
        otypes = {d[0]: str(d[1]) for d in r.description}
        stypes = {f.name: duck_type(f.dataType) for f in df.schema.fields}
        tdiff = {c: (stypes[c], otypes[c]) for c in cols if stypes[c] != otypes[c]}
        if tdiff:
            print(f"TYPE {n}: {tdiff}")
        idx = [ocols.index(c) for c in cols]
        s1 = sorted("|".join(norm(x) for x in row) for row in rows)
        s2 = sorted("|".join(norm(row[i]) for i in idx) for row in orows)
        if s1 == s2:
            print(f"OK   {n}: {len(rows)} rows ({ts:.1f}s)")
        else:
            diff = [x for x in s1 if x not in set(s2)][:3]
            diff2 = [x for x in s2 if x not in set(s1)][:3]
            print(f"FAIL {n}: rows spark={len(rows)} oracle={len(orows)}\n   spark-only {diff}\n   oracle-only {diff2}")
            bad.append(n)
    print("BAD:", bad)


if __name__ == "__main__":
    main()
