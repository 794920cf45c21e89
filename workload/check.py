"""Run every query beside its SQL and compare: ``python -m workload.check [sf_dir] [name ...]``."""

from __future__ import annotations

import datetime
import decimal
import math
import sys
import time

from workload.oracle import ORACLE
from workload.queries import QUERIES

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _plain(v):
    if isinstance(v, decimal.Decimal):
        return int(v) if v == v.to_integral_value() else float(v)
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 9)
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, datetime.date):
        return v.isoformat()
    return v


def normal(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=repr)


def compare(spark, con, sf_dir: str, name: str):
    """Return (equal, message)."""
    df = QUERIES[name](spark, sf_dir)
    got = normal(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(ORACLE[name])
    want = normal([d[0] for d in cur.description], cur.fetchall())
    if got[0] != want[0]:
        return False, f"columns differ: {set(got[0]) ^ set(want[0])}"
    if len(got[1]) != len(want[1]):
        return False, f"{len(got[1])} rows, expected {len(want[1])}"
    for a, b in zip(got[1], want[1]):
        if a != b:
            diff = [(c, x, y) for c, x, y in zip(got[0], a, b) if x != y]
            return False, f"values differ: {diff[:5]} in {a}"
    return True, f"{len(want[1])} rows"


def session(cores: str = "8"):
    from pyspark.sql import SparkSession

    return (
        SparkSession.builder.master(f"local[{cores}]").appName("surveyscore-check")
        .config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g").config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.showConsoleProgress", "false").getOrCreate()
    )


def main(argv):
    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    spark, con = session(), duck(sf_dir)
    spark.sparkContext.setLogLevel("ERROR")
    bad = []
    for name in argv[1:] or QUERIES:
        start = time.time()
        try:
            ok, text = compare(spark, con, sf_dir, name) if name in ORACLE else (
                True, f"{QUERIES[name](spark, sf_dir).count()} rows, no SQL")
        except Exception as e:  # report and go on to the next query
            ok, text = False, f"{type(e).__name__}: {str(e)[:600]}"
        print(f"{'ok  ' if ok else 'FAIL'} {name:30s} {time.time() - start:6.2f}s  {text}", flush=True)
        if not ok:
            bad.append(name)
    print(f"{len(bad)} failed: {bad}" if bad else "all equal")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
