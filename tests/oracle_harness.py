"""Run registered queries in Spark and their oracle SQL in DuckDB, compare.

Mirrors the driver's gate: column names, row count and an order-insensitive
comparison of values (columns sorted by name).
"""

from __future__ import annotations

import datetime as _dt
import decimal
import math
import sys
import time

import duckdb

sys.path.insert(0, __file__.rsplit("/tests/", 1)[0])

from txprep.fixtures import TABLES  # noqa: E402


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        return "NULL" if math.isnan(v) else repr(v)
    if isinstance(v, decimal.Decimal):
        return "D" + str(v)
    if isinstance(v, (_dt.datetime, _dt.date)):
        return v.isoformat()
    if isinstance(v, bool):
        return str(v)
    return str(v)


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in rows)


def compare(spark, name, fn, sql, sf_dir, con):
    t0 = time.time()
    df = fn(spark, sf_dir)
    srows = [tuple(r) for r in df.collect()]
    snames = df.columns
    t1 = time.time()
    if sql is None:
        return {"name": name, "ok": None, "rows": len(srows), "spark_s": round(t1 - t0, 2)}
    res = con.execute(sql)
    dnames = [d[0] for d in res.description]
    drows = res.fetchall()
    out = {"name": name, "rows": len(srows), "oracle_rows": len(drows), "spark_s": round(t1 - t0, 2)}
    if sorted(snames) != sorted(dnames):
        out.update(ok=False, why=f"columns {snames} vs {dnames}")
        return out
    a, b = rows_of(snames, srows), rows_of(dnames, drows)
    if a != b:
        diff = [(x, y) for x, y in zip(a, b) if x != y][:3]
        out.update(ok=False, why=f"values differ; first: {diff}; only spark {len(set(a)-set(b))}")
        return out
    out["ok"] = True
    return out


def main(argv):
    from pyspark.sql import SparkSession
    import __spark_entry__ as entry
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    only = set(argv[2:])
    spark = (SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
             .config("spark.ui.enabled", "false").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    qs, os_ = entry.queries(), entry.oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if only and name not in only:
            continue
        try:
            r = compare(spark, name, fn, os_.get(name), sf_dir, con)
        except Exception as e:  # report and continue
            r = {"name": name, "ok": False, "why": f"{type(e).__name__}: {str(e)[:400]}"}
        bad += r.get("ok") is False
        print(r, flush=True)
    print("FAILED", bad)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
