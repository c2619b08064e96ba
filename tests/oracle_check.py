"""Run registered Spark queries against their DuckDB oracle and compare.

Usage: python tests/oracle_check.py [sf_dir] [name-substring ...]
Compares column names, row counts and the sorted multiset of rows, with
doubles compared at 1e-6 absolute / relative tolerance.
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck_connection(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def _norm(v):
    if v is None:
        return (0, "")
    if isinstance(v, float):
        if math.isnan(v):
            return (0, "")
        return (1, round(v, 5))
    if isinstance(v, bool):
        return (1, int(v))
    if hasattr(v, "item"):
        return _norm(v.item())
    return (1, v)


def _close(a, b) -> bool:
    if a == b:
        return True
    if a[0] != b[0]:
        return False
    x, y = a[1], b[1]
    if isinstance(x, (int, float)) and isinstance(y, (int, float)):
        return abs(x - y) <= 1e-6 * max(1.0, abs(x), abs(y)) + 1e-5
    return False


def compare(spark_pdf, duck_pdf) -> str | None:
    sc, dc = sorted(spark_pdf.columns), sorted(duck_pdf.columns)
    if sc != dc:
        return f"columns differ: spark-only {sorted(set(sc) - set(dc))} duck-only {sorted(set(dc) - set(sc))}"
    if len(spark_pdf) != len(duck_pdf):
        return f"row count {len(spark_pdf)} vs {len(duck_pdf)}"
    cols = sc
    srows = sorted(tuple(_norm(v) for v in r) for r in spark_pdf[cols].itertuples(index=False, name=None))
    drows = sorted(tuple(_norm(v) for v in r) for r in duck_pdf[cols].itertuples(index=False, name=None))
    bad = 0
    first = None
    for a, b in zip(srows, drows):
        if not all(_close(x, y) for x, y in zip(a, b)):
            bad += 1
            if first is None:
                first = (a, b)
    if bad:
        return f"{bad} rows differ; first spark={first[0]} duck={first[1]} cols={cols}"
    return None


def run(spark, sf_dir: str, names=None, verbose=True) -> dict[str, str | None]:
    import __spark_entry__ as E

    qs, sqls = E.queries(), E.oracle_sql()
    con = duck_connection(sf_dir)
    results = {}
    for name, fn in qs.items():
        if names and not any(n in name for n in names):
            continue
        t0 = time.time()
        try:
            sdf = fn(spark, sf_dir).toPandas()
        except Exception as exc:  # noqa: BLE001
            results[name] = f"spark error: {type(exc).__name__}: {str(exc)[:400]}"
            if verbose:
                print(f"FAIL {name}: {results[name]}", flush=True)
            continue
        t1 = time.time()
        if name not in sqls:
            results[name] = None
            if verbose:
                print(f"rows-only {name}: {len(sdf)} rows spark {t1 - t0:.1f}s", flush=True)
            continue
        try:
            ddf = con.execute(sqls[name]).df()
        except Exception as exc:  # noqa: BLE001
            results[name] = f"duck error: {str(exc)[:400]}"
            if verbose:
                print(f"FAIL {name}: {results[name]}", flush=True)
            continue
        results[name] = compare(sdf, ddf)
        if verbose:
            status = "ok  " if results[name] is None else "FAIL"
            print(f"{status} {name}: {len(sdf)} rows spark {t1 - t0:.1f}s {results[name] or ''}", flush=True)
    return results


if __name__ == "__main__":
    from prismtab.session import local_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session(8)
    res = run(spark, sf, sys.argv[2:] or None)
    bad = {k: v for k, v in res.items() if v}
    print(f"{len(res) - len(bad)}/{len(res)} ok")
    sys.exit(1 if bad else 0)
