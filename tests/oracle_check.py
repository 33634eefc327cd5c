"""Run registered Spark queries next to their DuckDB oracles and compare
row count, column names and an order-insensitive hash of the values.

    python tests/oracle_check.py [sf_dir] [name ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import hashlib
import math
import sys
import time

import duckdb

sys.path.insert(0, __import__("os").path.dirname(__import__("os").path.dirname(__import__("os").path.abspath(__file__))))

from optlake.plans.fixtures import TABLE_NAMES  # noqa: E402

EXACT = bool(__import__("os").environ.get("ORACLE_EXACT"))


def _canon(v):
    if v is None:
        return "∅"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, (float, decimal.Decimal)):
        f = float(v)
        if math.isnan(f):
            return "nan"
        return repr(f) if EXACT else repr(round(f, 9))
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_canon(x) for x in v) + "]"
    return str(v)


def digest(columns: list[str], rows: list[tuple]) -> str:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    lines = sorted("|".join(_canon(r[i]) for i in order) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()[:16]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for t in TABLE_NAMES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


def compare(spark, sf_dir: str, names: list[str] | None = None, verbose: bool = True) -> dict:
    from optlake.plans.registry import ORACLES, QUERIES, load_all

    load_all()
    con = duck(sf_dir)
    out = {}
    for name in names or sorted(QUERIES):
        t0 = time.time()
        rec = {}
        try:
            df = QUERIES[name](spark, sf_dir)
            cols = df.columns
            rows = [tuple(r) for r in df.collect()]
            rec.update(rows=len(rows), spark_s=round(time.time() - t0, 2))
            if name in ORACLES:
                res = con.execute(ORACLES[name])
                ocols = [d[0] for d in res.description]
                orows = res.fetchall()
                rec["oracle_rows"] = len(orows)
                rec["cols_match"] = sorted(cols) == sorted(ocols)
                rec["hash_match"] = rec["cols_match"] and digest(cols, rows) == digest(ocols, orows)
                if not rec["cols_match"]:
                    rec["cols"] = (sorted(cols), sorted(ocols))
            else:
                rec["oracle_rows"] = None
        except Exception as exc:  # report and go on
            rec["error"] = f"{type(exc).__name__}: {str(exc)[:400]}"
        out[name] = rec
        if verbose:
            print(name, rec, flush=True)
    return out


if __name__ == "__main__":
    from optlake.session import get_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or None
    spark = get_session()
    res = compare(spark, sf, names)
    bad = [n for n, r in res.items() if "error" in r or r.get("hash_match") is False or
           (r.get("oracle_rows") is not None and r.get("oracle_rows") != r.get("rows"))]
    print("BAD:", bad)
