"""Compare registered Spark queries with their DuckDB oracle SQL.

Usage: python tests/oracle_compare.py [sf_dir] [query ...]
Prints one line per query: rows, column match, exact and tolerant value match.
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return (0, "")
    if isinstance(v, float):
        if math.isnan(v):
            return (0, "")
        return (1, v)
    if hasattr(v, "tolist"):
        v = v.tolist()
    if isinstance(v, (list, tuple)):
        return (2, tuple(_norm(x) for x in v))
    if isinstance(v, dict):
        return (3, tuple(sorted((k, _norm(x)) for k, x in v.items())))
    return (4, str(v))


def _close(a, b, rel=1e-9):
    if a == b:
        return True
    if a[0] == 1 and b[0] == 1:
        x, y = a[1], b[1]
        return abs(x - y) <= rel * max(1.0, abs(x), abs(y))
    if a[0] == 2 and b[0] == 2 and len(a[1]) == len(b[1]):
        return all(_close(x, y, rel) for x, y in zip(a[1], b[1]))
    return False


def rows_of(cols, records):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in records)


def compare(spark, con, name, fn, sql, sf_dir):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    srows = [tuple(r) for r in sdf.collect()]
    scols = sdf.columns
    t1 = time.time()
    res = {"query": name, "spark_rows": len(srows), "spark_sec": round(t1 - t0, 2)}
    if sql is None:
        res["oracle"] = "none"
        return res
    d = con.execute(sql)
    dcols = [c[0] for c in d.description]
    drows = d.fetchall()
    res["duck_rows"] = len(drows)
    res["cols_match"] = sorted(scols) == sorted(dcols)
    if not res["cols_match"]:
        res["cols"] = (sorted(set(scols) - set(dcols)), sorted(set(dcols) - set(scols)))
        return res
    a = rows_of(scols, srows)
    b = rows_of(dcols, drows)
    res["exact"] = a == b
    res["close"] = len(a) == len(b) and all(
        len(x) == len(y) and all(_close(p, q) for p, q in zip(x, y)) for x, y in zip(a, b))
    if not res["close"]:
        for x, y in zip(a, b):
            if not all(_close(p, q) for p, q in zip(x, y)):
                res["first_diff"] = (x, y)
                break
    return res


def main(argv):
    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    wanted = set(argv[1:])
    import __spark_entry__ as E
    from hourprofile.session import local_session
    spark = local_session(8, 8)
    con = duck(sf_dir)
    qs, sqls = E.queries(), E.oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if wanted and name not in wanted:
            continue
        try:
            r = compare(spark, con, name, fn, sqls.get(name), sf_dir)
        except Exception as e:  # report and go on
            r = {"query": name, "error": (type(e).__name__ + ": " + str(e))[:1500]}
        ok = r.get("oracle") == "none" or r.get("close")
        bad += not ok
        print(("OK  " if ok else "BAD ") + str(r), flush=True)
    print(f"{bad} failing of {len(qs) if not wanted else len(wanted)}")


if __name__ == "__main__":
    main(sys.argv[1:])
