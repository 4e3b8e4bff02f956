"""Run registered queries on Spark and their SQL on DuckDB, compare all values.

    python tests/compare.py [--sf 0.01] [name ...]
"""

from __future__ import annotations

import argparse
import math
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

import __spark_entry__ as entry_module  # noqa: E402
from tagloom.sources.tables import GIVEN  # noqa: E402


def session():
    from pyspark.sql import SparkSession

    spark = (
        SparkSession.builder.master("local[8]")
        .appName("tagloom-check")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def database(sf_dir: str):
    con = duckdb.connect()
    for name in GIVEN:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def canonical(value):
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    if isinstance(value, float) and value == 0:
        return "0.0"
    return repr(value)


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(canonical(r[i]) for i in order) for r in data)


def compare(spark, con, name: str, sf_dir: str) -> str | None:
    """None when equal, else a description of the difference."""
    df = entry_module.queries()[name](spark, sf_dir)
    got_cols, got = df.columns, [tuple(r) for r in df.collect()]
    sql = entry_module.oracle_sql().get(name)
    if sql is None:
        return None if got else "no rows"
    res = con.execute(sql)
    cols = [d[0] for d in res.description]
    kinds = {d[0]: str(d[1]) for d in res.description}
    want = res.fetchall()
    odd = {c: k for c, k in kinds.items() if k.startswith(("HUGEINT", "DECIMAL"))}
    if odd:
        return f"check types {odd}"
    if sorted(cols) != sorted(got_cols):
        return f"columns {sorted(got_cols)} != {sorted(cols)}"
    a, b = rows(got_cols, got), rows(cols, want)
    if a == b:
        return None if a else "equal but no rows"
    only_a, only_b = sorted(set(a) - set(b))[:3], sorted(set(b) - set(a))[:3]
    return f"{len(a)} rows vs {len(b)}\n  cols {sorted(cols)}\n  spark {only_a}\n  sql   {only_b}"


def main() -> int:
    p = argparse.ArgumentParser()
    p.add_argument("--sf", default="0.01")
    p.add_argument("names", nargs="*")
    a = p.parse_args()
    sf_dir = f"/root/testdata/sf{a.sf}"
    spark, con = session(), database(sf_dir)
    known = entry_module.queries()
    names = [n for n in known if not a.names or any(n.startswith(x) for x in a.names)]
    bad = 0
    for n in names:
        start = time.time()
        try:
            diff = compare(spark, con, n, sf_dir)
        except Exception as e:  # noqa: BLE001
            diff = f"{type(e).__name__}: {str(e)[:1500]}"
        has = "sql" if n in entry_module.oracle_sql() else "rows"
        print(f"{'ok  ' if diff is None else 'FAIL'} {n} [{has}] {time.time() - start:.1f}s", flush=True)
        if diff:
            bad += 1
            print("  " + diff, flush=True)
    print(f"{len(names) - bad}/{len(names)} ok")
    return bad


if __name__ == "__main__":
    code = main()
    sys.stdout.flush()
    sys.exit(1 if code else 0)
