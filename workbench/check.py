"""Runs queries and their SQL side by side: python -m workbench.check [sf_dir] [name ...]."""

from __future__ import annotations

import math
import sys
import tempfile
import time
from collections import Counter

import duckdb

from fieldmark.session import session

from . import load

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()

_KINDS = {
    "INTEGER": "int", "BIGINT": "bigint", "DOUBLE": "double", "VARCHAR": "string", "BOOLEAN": "boolean", "DATE": "date",
}


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value
    if isinstance(value, (list, tuple)):
        return tuple(_plain(v) for v in value)
    return value


def compare(spark, con, run, sql, sf_dir):
    start = time.time()
    df = run(spark, sf_dir)
    got = df.collect()
    seconds = time.time() - start
    if not sql:
        return f"rows only: {len(got)}", seconds
    kinds = {r[0]: r[1] for r in con.execute(f"DESCRIBE {sql}").fetchall()}
    want = con.execute(sql).fetchall()
    names = list(kinds)
    if sorted(names) != sorted(df.columns):
        return f"COLUMNS {sorted(df.columns)} / {sorted(names)}", seconds
    wrong = [
        (c, t, kinds[c]) for c, t in df.dtypes if kinds[c] in _KINDS and _KINDS[kinds[c]] != t
    ]
    if wrong:
        return f"TYPES {wrong}", seconds
    left = Counter(tuple(_plain(r[c]) for c in names) for r in got)
    right = Counter(tuple(_plain(v) for v in r) for r in want)
    if left != right:
        return (
            f"DIFFERENT {len(got)}/{len(want)} rows\n   {names}\n   only Spark: {list((left - right).items())[:4]}"
            f"\n   only SQL:   {list((right - left).items())[:4]}"
        ), seconds
    return f"ok {len(got)}" + ("" if got else " EMPTY"), seconds


def main(argv):
    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    registry = load()
    names = argv[1:] or list(registry.QUERIES)
    spark = session("fieldmark-check", 8)
    spark.sparkContext.setLogLevel("ERROR")
    con = duckdb.connect()
    con.execute(f"SET temp_directory = '{tempfile.mkdtemp(prefix='fieldmark-sql-')}'")
    con.execute("SET memory_limit = '10GB'")
    con.execute("SET max_temp_directory_size = '4GB'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    bad = 0
    for name in names:
        try:
            verdict, seconds = compare(spark, con, registry.QUERIES[name], registry.SQL.get(name), sf_dir)
        except Exception as error:  # a broken query must not hide the others
            verdict, seconds = f"ERROR {str(error)[:1500]}", 0.0
        bad += not verdict.startswith(("ok", "rows only"))
        print(f"{name:32s} {seconds:6.1f}s  {verdict}", flush=True)
    print(f"{len(names) - bad} of {len(names)} agree")
    return 1 if bad else 0


if __name__ == "__main__":
    raise SystemExit(main(sys.argv[1:]))
