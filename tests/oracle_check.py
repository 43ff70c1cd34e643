"""Run every query and its SQL on the same tables and compare the results.

Usage: python tests/oracle_check.py [folder] [query ...]
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def _cell(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return ""
    if isinstance(value, bool):
        return str(value).lower()
    if isinstance(value, float):
        return repr(value)
    return str(value)


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def duck(folder):
    import duckdb

    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


_SPARK_TYPES = {
    "BIGINT": "bigint",
    "DOUBLE": "double",
    "VARCHAR": "string",
    "BOOLEAN": "boolean",
    "TIMESTAMP": "timestamp_ntz",
    "INTEGER": "int",
}


def compare(spark, con, name, query, sql, folder):
    """None if both sides agree, else what differs; also the Spark time."""
    begin = time.time()
    df = query(spark, folder)
    got = [tuple(r) for r in df.collect()]
    took = time.time() - begin
    rel = con.sql(sql)
    want = rel.fetchall()
    if sorted(df.columns) != sorted(rel.columns):
        return f"columns {sorted(df.columns)} != {sorted(rel.columns)}", took
    types = dict(zip(rel.columns, map(str, rel.types)))
    odd = {c: (t, types[c]) for c, t in df.dtypes if _SPARK_TYPES.get(types[c], "?") != t}
    if odd:
        return f"types {odd}", took
    left, right = _rows(df.columns, got), _rows(rel.columns, want)
    if left == right:
        return (None if left else "no rows"), took
    extra = [r for r in left if r not in set(right)][:3]
    missing = [r for r in right if r not in set(left)][:3]
    return f"{len(left)} vs {len(right)} rows; only spark {extra}; only sql {missing}", took


def main(folder, names):
    from __spark_entry__ import oracle_sql, queries

    from shelfwatch.runtime import build_session

    spark = build_session("check", "local[8]", **{"spark.sql.shuffle.partitions": "8"})
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = duck(folder), 0
    for name, query in queries().items():
        if names and name not in names:
            continue
        sql = oracle_sql().get(name)
        try:
            if sql is None:
                begin = time.time()
                n = query(spark, folder).count()
                print(f"rows {name}: {n} ({time.time() - begin:.1f}s)", flush=True)
                continue
            problem, took = compare(spark, con, name, query, sql, folder)
        except Exception as failure:
            problem, took = f"{type(failure).__name__}: {str(failure)[:600]}", 0.0
        bad += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} ({took:.1f}s) {problem or ''}", flush=True)
    print(f"{bad} problem(s)")


if __name__ == "__main__":
    args = sys.argv[1:]
    where = args[0] if args and "/" in args[0] else "/root/testdata/sf0.01"
    main(where, [a for a in args if "/" not in a])
