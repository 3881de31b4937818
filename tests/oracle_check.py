"""Run every registered query in Spark and its SQL twin in DuckDB; compare rows, columns and values.

Usage: python tests/oracle_check.py [sf_dir] [name ...]
"""

from __future__ import annotations

import datetime as dt
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]


SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
                 "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP", "date": "DATE", "decimal": "DECIMAL",
                 "smallint": "SMALLINT", "float": "FLOAT", "timestamp": "TIMESTAMP WITH TIME ZONE"}


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def norm(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return int(v)
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 9)
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if hasattr(v, "item"):
        return norm(v.item())
    return v


def canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(norm(r[i]) for i in order) for r in rows]
    return [cols[i] for i in order], sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


def compare(spark, sf_dir: str, names=None) -> dict:
    import __spark_entry__ as E
    qs, sqls = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    results = {}
    for name in names or qs:
        t0 = time.time()
        try:
            sdf = qs[name](spark, sf_dir)
            srows = [tuple(r) for r in sdf.collect()]
            scols = sdf.columns
        except Exception as exc:  # report and continue
            results[name] = f"SPARK ERROR {type(exc).__name__}: {str(exc)[:300]}"
            continue
        st = time.time() - t0
        if name not in sqls:
            results[name] = f"rows-only {len(srows)} ({st:.1f}s)"
            continue
        try:
            rel = con.sql(sqls[name])
            dcols = rel.columns
            drows = rel.fetchall()
        except Exception as exc:
            results[name] = f"DUCKDB ERROR {type(exc).__name__}: {str(exc)[:300]}"
            continue
        sc, sr = canon(scols, srows)
        dc, dr = canon(dcols, drows)
        stypes = {f.name: SPARK_TO_DUCK.get(f.dataType.simpleString().split("(")[0], f.dataType.simpleString())
                  for f in sdf.schema.fields}
        dtypes = {c: str(t).split("(")[0] for c, t in zip(rel.columns, rel.types)}
        type_diff = {c: (stypes[c], dtypes.get(c)) for c in stypes if c in dtypes and stypes[c] != dtypes[c]}
        if sc != dc:
            results[name] = f"COLUMNS differ spark={sc} duck={dc}"
        elif len(sr) != len(dr):
            results[name] = f"ROWCOUNT spark={len(sr)} duck={len(dr)}"
        elif sr != dr:
            diffs = [(a, b) for a, b in zip(sr, dr) if a != b][:2]
            results[name] = f"VALUES differ e.g. {diffs}"
        else:
            results[name] = f"ok {len(sr)} rows ({st:.1f}s)" + (f" TYPES {type_diff}" if type_diff else "")
    return results


if __name__ == "__main__":
    from clientele import get_session
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or None
    spark = get_session("local[8]", shuffle_partitions=8)
    res = compare(spark, sf, names)
    for k, v in res.items():
        print(f"{k:28s} {v}", flush=True)
    bad = [k for k, v in res.items() if not (v.startswith("ok") or v.startswith("rows-only"))]
    print("FAILED:", bad)
