"""Run queries beside their SQL and compare rows. ``python tests/compare.py SF [query ...]``."""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def session():
    from regain.plans.session import local_session

    return local_session(name="regain-compare")


def duck(folder: str):
    import duckdb

    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"create view {table} as select * from read_parquet('{folder}/{table}.parquet')")
    return con


def _cell(value):
    if value is None:
        return ("0", "")
    if isinstance(value, bool):
        return ("b", str(value))
    if isinstance(value, float):
        return ("n", "nan" if math.isnan(value) else f"{value:.9g}")
    if isinstance(value, int):
        return ("n", f"{float(value):.9g}")
    return (type(value).__name__, str(value))


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def compare(df, con, sql):
    """A short verdict: 'ok' or what differs."""
    result = con.execute(sql)
    names_b, rows_b = rows_of([d[0] for d in result.description], result.fetchall())
    names_a, rows_a = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if names_a != names_b:
        return f"columns differ: only spark {set(names_a) - set(names_b)}, only sql {set(names_b) - set(names_a)}"
    if len(rows_a) != len(rows_b):
        return f"rows differ: spark {len(rows_a)}, sql {len(rows_b)}"
    for a, b in zip(rows_a, rows_b):
        if a != b:
            return "values differ: " + str([(n, x, y) for n, x, y in zip(names_a, a, b) if x != y][:6]) + f" in row {a[:4]}"
    return "ok"


def main():
    import importlib

    entry = importlib.import_module("__spark_entry__")
    folder = f"/root/testdata/{sys.argv[1]}"
    queries, oracle = entry.queries(), entry.oracle_sql()
    spark, con = session(), duck(folder)
    bad = 0
    for name in sys.argv[2:] or queries:
        start = time.time()
        try:
            df = queries[name](spark, folder)
            verdict = compare(df, con, oracle[name]) if name in oracle else f"rows {df.count()} (no sql)"
        except Exception as error:
            verdict = f"FAILED {type(error).__name__}: {str(error)[:700]}"
        bad += not (verdict == "ok" or verdict.startswith("rows "))
        print(f"{name:28s} {time.time() - start:6.1f}s  {verdict}", flush=True)
    print("differences:", bad)


if __name__ == "__main__":
    main()
