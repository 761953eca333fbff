"""Run queries next to their DuckDB statements and compare all rows.

``python tests/compare.py SF [name-part ...]`` prints one line per query.
"""

from __future__ import annotations

import datetime as dt
import decimal
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def plain(value):
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, (dt.date, dt.datetime)):
        return str(value)
    if isinstance(value, list):
        return tuple(plain(v) for v in value)
    return value


def rows_of(names: list[str], rows) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def compare(df, con, sql: str) -> str:
    """Empty text when names and all rows agree exactly, else the first difference."""
    want = con.execute(sql)
    names = [d[0] for d in want.description]
    expected = rows_of(names, want.fetchall())
    got_names = df.columns
    got = rows_of(got_names, [tuple(r) for r in df.collect()])
    if sorted(names) != sorted(got_names):
        return f"columns {sorted(got_names)} != {sorted(names)}"
    if len(got) != len(expected):
        return f"{len(got)} rows, expected {len(expected)}; first {got[:1]} / {expected[:1]}"
    bad = [(g, e) for g, e in zip(got, expected) if g != e]
    if bad:
        return f"{len(bad)} of {len(got)} rows differ, {sorted(names)}: {str(bad[0][0])[:500]} / {str(bad[0][1])[:500]}"
    return ""


def main() -> int:
    from __spark_entry__ import oracle_sql, queries
    from leakscope.session import build_session

    folder = f"/root/testdata/sf{sys.argv[1]}"
    spark = build_session("compare", "local[8]", 8)
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(folder)
    wanted, sqls, failed = sys.argv[2:], oracle_sql(), 0
    for name, run in queries().items():
        if wanted and not any(w in name for w in wanted):
            continue
        start = time.time()
        try:
            df = run(spark, folder)
            if name in sqls:
                message = compare(df, con, sqls[name]) or f"ok {df.count()} rows"
            else:
                message = f"rows only: {df.count()}"
        except Exception as e:  # report and go on with the next query
            message = f"ERROR {type(e).__name__} {str(e)[:700]}"
        failed += not message.startswith(("ok", "rows only"))
        print(f"{name:34s} {time.time() - start:6.2f}s  {message}", flush=True)
    print("failed", failed, "without statement", sorted(set(queries()) - set(sqls)))
    return failed


if __name__ == "__main__":
    sys.exit(main())
