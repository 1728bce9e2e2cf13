"""Runs registered queries beside their SQL and compares row by row.

``python tests/check.py [name ...]`` checks the named queries, or all of them.
"""

from __future__ import annotations

import datetime
import decimal
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def oracle(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def cell(v):
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    if isinstance(v, datetime.datetime):
        return v.isoformat()
    return None if v is None else str(v)


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(
        (tuple(cell(r[i]) for i in order) for r in rows), key=lambda t: tuple(x or "" for x in t)
    )


def compare(df, con, sql) -> str:
    """Empty when equal, else what differs."""
    mine = rows_of(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    theirs = rows_of(names, cur.fetchall())
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    if len(mine) != len(theirs):
        return f"rows {len(mine)} != {len(theirs)}"
    diff = [(a, b) for a, b in zip(mine, theirs, strict=True) if a != b]
    return f"{len(diff)} of {len(mine)} rows differ, e.g. {diff[0]}" if diff else ""


def main(names: list[str]) -> int:
    from __spark_entry__ import oracle_sql, queries
    from dugout.session import local_session

    sf_dir = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.01")
    spark = local_session(8, "check")
    spark.sparkContext.setLogLevel("ERROR")
    con, sqls, bad = oracle(sf_dir), oracle_sql(), 0
    for name, run in queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            df = run(spark, sf_dir)
            if name in sqls:
                verdict = compare(df, con, sqls[name])
                n = ""
            else:
                verdict, n = "", f"rows only: {df.count()}"
        except Exception as e:  # noqa: BLE001
            verdict, n = f"{type(e).__name__}: {str(e)[:400]}", ""
        bad += bool(verdict)
        print(f"{'BAD' if verdict else 'ok '} {name} {time.time() - start:.2f}s {verdict}{n}", flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
