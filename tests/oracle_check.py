"""Run every registered Spark plan and its DuckDB twin and compare.

Usage: python tests/oracle_check.py [sf_dir] [key ...]
Prints one line per key: OK / MISMATCH / ROWS (no oracle) / ERROR.
"""

from __future__ import annotations

import math
import os
import sys
import time
import traceback

import duckdb
import pandas as pd

sys.path.insert(0, __file__.rsplit("/tests/", 1)[0])

from tidewatch.sources.tables import TABLES  # noqa: E402


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None or v is pd.NA or v is pd.NaT:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6)
    if hasattr(v, "item") and not isinstance(v, (list, dict, str, bytes)):
        try:
            return _norm(v.item())
        except (ValueError, AttributeError):
            pass
    if isinstance(v, pd.Timestamp):
        return v.to_pydatetime().replace(tzinfo=None)
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if hasattr(v, "tolist"):
        return tuple(_norm(x) for x in v.tolist())
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    return v


def rows(pdf: pd.DataFrame) -> list[tuple]:
    cols = sorted(pdf.columns)
    out = []
    for rec in pdf[cols].itertuples(index=False, name=None):
        out.append(tuple(_norm(v) for v in rec))
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
                 "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP", "float": "FLOAT", "date": "DATE",
                 "smallint": "SMALLINT", "tinyint": "TINYINT", "timestamp": "TIMESTAMP WITH TIME ZONE"}


def type_mismatches(sdf, con, sql) -> list[str]:
    duck_types = {d[0]: str(d[1]) for d in con.execute(f"DESCRIBE {sql}").fetchall()}
    bad = []
    for f in sdf.schema.fields:
        want = SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString().upper())
        got = duck_types.get(f.name)
        if got is not None and got != want:
            bad.append(f"{f.name}: spark {want} duck {got}")
    return bad


def compare(key, sdf, con, sql):
    spd = sdf.toPandas()
    if sql is None:
        return "ROWS", f"{len(spd)} rows"
    if os.environ.get("ORACLE_TYPES"):
        bad = type_mismatches(sdf, con, sql)
        if bad:
            return "TYPES", "; ".join(bad)
    dpd = con.execute(sql).df()
    if sorted(spd.columns) != sorted(dpd.columns):
        return "MISMATCH", f"columns spark={sorted(spd.columns)} duck={sorted(dpd.columns)}"
    if len(spd) != len(dpd):
        return "MISMATCH", f"rows spark={len(spd)} duck={len(dpd)}"
    a, b = rows(spd), rows(dpd)
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    if bad:
        return "MISMATCH", f"{len(bad)} rows differ; first spark={bad[0][0]} duck={bad[0][1]}"
    return "OK", f"{len(spd)} rows"


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    only = set(argv[2:])
    import __spark_entry__ as entry
    from tidewatch.session import get_session

    spark = get_session("local[8]", 8)
    con = duck(sf_dir)
    qs, oracle = entry.queries(), entry.oracle_sql()
    results = {}
    for key, fn in qs.items():
        if only and key not in only:
            continue
        t0 = time.time()
        try:
            status, msg = compare(key, fn(spark, sf_dir), con, oracle.get(key))
        except Exception as e:  # report and continue
            status, msg = "ERROR", f"{type(e).__name__}: {str(e)[:400]}"
            if only:
                traceback.print_exc()
        results[key] = status
        print(f"{status:8s} {key:28s} {time.time() - t0:6.2f}s  {msg}", flush=True)
    n_ok = sum(v == "OK" for v in results.values())
    print(f"SUMMARY ok={n_ok} rows={sum(v == 'ROWS' for v in results.values())} total={len(results)}")
    return results


if __name__ == "__main__":
    res = main(sys.argv)
    sys.exit(0 if all(v in ("OK", "ROWS") for v in res.values()) else 1)
