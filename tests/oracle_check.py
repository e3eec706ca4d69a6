"""Run registered queries in Spark and their oracle SQL in DuckDB; compare
row count, column names and an order-insensitive value digest."""

from __future__ import annotations

import datetime as dt
import decimal
import hashlib
import math
import sys
import time


def _norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        return repr(round(v, 9))
    if isinstance(v, decimal.Decimal):
        return str(v.normalize())
    if isinstance(v, dt.datetime):
        return v.strftime("%Y-%m-%d %H:%M:%S.%f")
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, bool):
        return str(v)
    return str(v)


def digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted("|".join(_norm(r[i]) for i in order) for r in rows)
    return hashlib.sha1("\n".join(lines).encode()).hexdigest(), lines


def compare(spark, sf_dir, names=None, verbose=True):
    sys.path.insert(0, "/root/repo")
    import __spark_entry__ as e
    from tests.duck import connect

    con = connect(sf_dir)
    qs, sqls = e.queries(), e.oracle_sql()
    results = {}
    for name in names or sorted(qs):
        t = time.time()
        try:
            df = qs[name](spark, sf_dir)
            cols = df.columns
            rows = [tuple(r) for r in df.collect()]
        except Exception as ex:  # noqa: BLE001
            results[name] = ("SPARK-ERROR", str(ex)[:300])
            if verbose:
                print(name, "SPARK-ERROR", str(ex)[:600], flush=True)
            continue
        st = time.time() - t
        if name not in sqls:
            results[name] = ("rows-only", len(rows))
            if verbose:
                print(f"{name}: rows-only {len(rows)} ({st:.1f}s)", flush=True)
            continue
        try:
            cur = con.execute(sqls[name])
            dcols = [d[0] for d in cur.description]
            drows = cur.fetchall()
        except Exception as ex:  # noqa: BLE001
            results[name] = ("DUCK-ERROR", str(ex)[:300])
            if verbose:
                print(name, "DUCK-ERROR", str(ex)[:600], flush=True)
            continue
        h1, l1 = digest(cols, rows)
        h2, l2 = digest(dcols, drows)
        ok = sorted(cols) == sorted(dcols) and len(rows) == len(drows) and h1 == h2
        results[name] = ("OK" if ok else "MISMATCH", len(rows), len(drows))
        if verbose:
            print(f"{name}: {'OK' if ok else 'MISMATCH'} spark={len(rows)} duck={len(drows)} ({st:.1f}s)", flush=True)
            if not ok:
                if sorted(cols) != sorted(dcols):
                    print("  cols", sorted(cols), sorted(dcols))
                a, b = set(l1), set(l2)
                print("  spark-only", list(a - b)[:2])
                print("  duck-only ", list(b - a)[:2])
    return results


if __name__ == "__main__":
    sys.path.insert(0, "/root/repo")
    from shardwise.session import get_session

    spark = get_session("local[8]", shuffle_partitions=8, driver_memory="16g")
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or None
    r = compare(spark, sf, names)
    bad = [k for k, v in r.items() if v[0] not in ("OK", "rows-only")]
    print("BAD:", bad)
