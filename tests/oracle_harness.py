"""Run registered queries in Spark and their oracle SQL in DuckDB; compare.

Usage: python -m tests.oracle_harness [sf_dir] [name ...]
Comparison is order-insensitive over rows with columns sorted by name,
like the driver's check.
"""

from __future__ import annotations

import datetime as dt
import decimal
import sys
import time

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def norm(v):
    if isinstance(v, float):
        return round(v, 6)
    if isinstance(v, decimal.Decimal):
        return format(v.normalize(), "f") if v == v else str(v)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    return v


def canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(norm(r[i]) for i in order) for r in rows]
    return sorted(cols), sorted(out, key=repr)


def compare(spark, con, name, builder, sql, sf_dir):
    t0 = time.time()
    sdf = builder(spark, sf_dir)
    srows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    rel = con.sql(sql)
    dcols = rel.columns
    drows = rel.fetchall()
    scols, s = canon(sdf.columns, srows)
    dcols2, d = canon(dcols, drows)
    ok = scols == dcols2 and s == d
    detail = ""
    if not ok:
        if scols != dcols2:
            detail = f"cols spark={scols} duck={dcols2}"
        else:
            ss, ds = set(s), set(d)
            miss = [r for r in d if r not in ss][:3]
            extra = [r for r in s if r not in ds][:3]
            detail = f"rows spark={len(s)} duck={len(d)} only_duck={miss} only_spark={extra}"
    return ok, len(srows), t1 - t0, detail


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 and argv[1].startswith("/") else "/root/testdata/sf0.01"
    names = [a for a in argv[1:] if not a.startswith("/")]
    sys.path.insert(0, ".")
    import __spark_entry__ as ent
    from cartwheel.session import build_session
    spark = build_session("local[8]")
    con = duck(sf_dir)
    qs, oracles = ent.queries(), ent.oracle_sql()
    bad = 0
    for name, builder in qs.items():
        if names and name not in names:
            continue
        sql = oracles.get(name)
        if sql is None:
            t0 = time.time()
            n = builder(spark, sf_dir).count()
            print(f"ROWS  {name:32s} rows={n} {time.time()-t0:.2f}s (no oracle)")
            continue
        try:
            ok, n, secs, detail = compare(spark, con, name, builder, sql, sf_dir)
        except Exception as exc:  # noqa: BLE001
            ok, n, secs, detail = False, -1, 0.0, f"{type(exc).__name__}: {str(exc)[:400]}"
        bad += not ok
        print(f"{'OK  ' if ok else 'FAIL'}  {name:32s} rows={n} {secs:.2f}s {detail}")
    print(f"{bad} failing")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
