"""Run queries() in Spark and oracle_sql() in DuckDB on one folder and compare the results.

Usage: python tests/oracle_compare.py [sf_dir] [key ...]
Prints one line per key: exact / close / MISMATCH / ERROR and row counts.
"""

from __future__ import annotations

import math
import os
import sys
import time
import traceback

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v, digits):
    import datetime
    import decimal

    import pandas as pd

    if v is None or v is pd.NaT or v is pd.NA:
        return None
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if hasattr(v, "to_pydatetime"):
        v = v.to_pydatetime()
    if isinstance(v, datetime.datetime) and v.time() == datetime.time(0):
        v = v.date()
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, digits) if digits is not None else v
    import pandas as pd

    if v is pd.NaT or v is pd.NA:
        return None
    if hasattr(v, "item") and not isinstance(v, (str, bytes)):
        try:
            return _norm(v.item(), digits)
        except Exception:
            pass
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x, digits) for x in v)
    if hasattr(v, "tolist"):
        return tuple(_norm(x, digits) for x in v.tolist())
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


def rows_of(pdf, digits):
    cols = sorted(pdf.columns)
    out = []
    for rec in pdf[cols].itertuples(index=False, name=None):
        out.append(tuple(_norm(x, digits) for x in rec))
    return cols, sorted(out, key=lambda r: tuple((x is None, str(x)) for x in r))


def compare(spark, sf_dir, keys=None, verbose=True):
    import __spark_entry__ as E

    qs, sqls = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    results = {}
    for k in keys or list(qs):
        t0 = time.time()
        try:
            sp = qs[k](spark, sf_dir).toPandas()
            ts = time.time() - t0
            if k not in sqls:
                results[k] = ("rows-only", len(sp), None, ts)
            else:
                dk = con.execute(sqls[k]).df()
                c1, r1 = rows_of(sp, None)
                c2, r2 = rows_of(dk, None)
                if c1 != c2:
                    results[k] = (f"MISMATCH cols {c1} vs {c2}", len(sp), len(dk), ts)
                elif r1 == r2:
                    results[k] = ("exact", len(sp), len(dk), ts)
                else:
                    _, a = rows_of(sp, 6)
                    _, b = rows_of(dk, 6)
                    if a == b:
                        results[k] = ("close", len(sp), len(dk), ts)
                    else:
                        diff = [x for x in a if x not in set(b)][:3]
                        diff2 = [x for x in b if x not in set(a)][:3]
                        results[k] = (f"MISMATCH values spark-only={diff} duck-only={diff2}", len(sp), len(dk), ts)
        except Exception as e:  # noqa: BLE001
            results[k] = ("ERROR " + "".join(traceback.format_exception_only(type(e), e))[:800], None, None, time.time() - t0)
        if verbose:
            print(f"{k:28s} {results[k][0][:600]} rows={results[k][1]}/{results[k][2]} {results[k][3]:.1f}s", flush=True)
    return results


if __name__ == "__main__":
    from tally.session import build_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    keys = sys.argv[2:] or None
    spark = build_session("local[8]", 8)
    compare(spark, sf, keys)
