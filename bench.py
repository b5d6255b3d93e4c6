"""Time the headline queries and print one JSON line.

Two queries warm the session up; then each query runs ``BENCH_RUNS`` times and the median counts. ``full_build`` writes every
staging, intermediate and mart table; the drill-downs after it read those tables, as the page would. Beside them stands the time DuckDB takes for the
same results on as many threads (``duckdb``, ``BENCH_DUCKDB_RUNS`` runs each after a warm one; 0 leaves it out).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = (
    "classify_lines", "reconcile_invoices", "customer_transactions", "customer_12m_change", "product_changes",
    "customer_mart", "product_mart", "sales_detail", "opportunities", "call_sheet",
)
OVER_TABLES = ("ranked_list", "monthly_profit", "recent_invoices", "top_brand_drops", "dq_tie_out", "dq_not_null")
RUNS = int(os.environ.get("BENCH_RUNS", "1"))
DUCKDB_RUNS = int(os.environ.get("BENCH_DUCKDB_RUNS", "1"))
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "documents")


def duckdb_times(folder: str, names: tuple[str, ...], threads: int) -> dict[str, float]:
    import duckdb

    from oracle.queries import ORACLE

    con = duckdb.connect(config={"threads": threads})
    for table in TABLES:
        con.execute(f"create view {table} as select * from read_parquet('{folder}/{table}.parquet')")
    times = {}
    for name in names:
        con.execute(ORACLE[name]).to_arrow_table()
        runs = []
        for _ in range(DUCKDB_RUNS):
            start = time.perf_counter()
            con.execute(ORACLE[name]).to_arrow_table()
            runs.append(time.perf_counter() - start)
        times[name] = round(statistics.median(runs), 3)
    return times


def main() -> None:
    from regain.plans.catalog import QUERIES, built
    from regain.plans.session import local_session

    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), name="regain-bench")
    lines = spark.read.parquet(f"{folder}/lineitem.parquet").count()

    def run(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    times: dict[str, float] = {}
    for name in ("classify_lines", "customer_12m_change"):
        run(name)
    for name in HEADLINE:
        times[name] = round(statistics.median(run(name) for _ in range(RUNS)), 3)
    start = time.perf_counter()
    built(spark, folder)
    times["full_build"] = round(time.perf_counter() - start, 3)
    for name in OVER_TABLES:
        run(name)
        times[name] = round(statistics.median(run(name) for _ in range(RUNS)), 3)
    total = round(sum(times.values()), 3)
    print(json.dumps({
        "metric": "headline query time", "value": total, "unit": "sec", "queries": times,
        "sf": os.path.basename(folder.rstrip("/")), "line_rows": lines,
        "rows_per_sec": {name: round(lines / t) for name, t in times.items() if t > 0},
        "duckdb": duckdb_times(folder, HEADLINE, int(os.environ.get("BENCH_CPUS", "8"))) if DUCKDB_RUNS else {},
    }))


if __name__ == "__main__":
    main()
