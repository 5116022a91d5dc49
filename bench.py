"""Benchmark: the warehouse build and the headline queries at one scale.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Phases (seconds): ``load`` = three bronze+silver loads, ``gold`` = star
rebuild, ``reload`` = a fourth load of the unchanged batch-3 extract (must
append 0 rows), ``checks`` = all 209 data checks, and the consumer queries
(median of 3 after a warm-up, forced with the no-op sink).  Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tessera.operators import star  # noqa: E402
from tessera.plans.pipeline import (  # noqa: E402
    build_gold,
    run_batch,
    run_data_checks,
    source_tables,
)
from tessera.session import local_test_session, scratch_root  # noqa: E402
from tessera.sources.driver_tables import DriverTables, stamp  # noqa: E402
from tessera.sources.store import Warehouse  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402


def _timed(fn) -> float:
    t = time.perf_counter()
    fn()
    return time.perf_counter() - t


def _force(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    m = re.search(r"sf([0-9.]+)", sf_dir)
    sf = float(m.group(1)) if m else None
    spark = local_test_session("tessera-bench", cores=cpus, shuffle_partitions=int(cpus))
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tessera-bench-"))
    wh = Warehouse(spark, f"{scratch_root(spark)}/bench-warehouse")
    tables = DriverTables(spark, sf_dir)

    q: dict[str, float] = {}
    q["load"] = _timed(lambda: [run_batch(wh, tables.batch(b), stamp(b), b) for b in (1, 2, 3)])
    q["gold"] = _timed(lambda: build_gold(wh))

    g = {n: wh.read("gold", n) for n in ["fact_transactions", "fact_loans",
                                         "fact_account_balance", "dim_customer", "dim_account",
                                         "dim_merchant", "dim_card", "dim_date"]}
    consumer = {
        "spend_by_city_quarter": lambda: star.spend_by_city_quarter(
            g["fact_transactions"], g["dim_customer"], g["dim_date"]),
        "join_point_in_time": lambda: star.transactions_point_in_time(
            g["fact_transactions"], g["dim_customer"]),
        "join_point_in_time_bucketed": lambda: star.transactions_point_in_time(
            g["fact_transactions"], g["dim_customer"], bucket="year"),
        "join_point_in_time_merged": lambda: star.transactions_point_in_time(
            g["fact_transactions"], g["dim_customer"], bucket="year", merge=True),
        "join_current": lambda: star.transactions_current(
            g["fact_transactions"], g["dim_customer"]),
        "transactions_star": lambda: star.transactions_star(
            g["fact_transactions"], g["dim_customer"], g["dim_account"], g["dim_merchant"],
            g["dim_date"]),
        "balances_star": lambda: star.balances_star(
            g["fact_account_balance"], g["dim_customer"], g["dim_account"], g["dim_date"]),
        "loans_star": lambda: star.loans_star(g["fact_loans"], g["dim_customer"], g["dim_date"]),
    }
    for name, build in consumer.items():
        _force(build())  # warm-up
        q[name] = statistics.median(_timed(lambda: _force(build())) for _ in range(3))

    rows: list = []
    q["checks"] = _timed(lambda: rows.extend(
        run_data_checks(wh, source_tables(tables)).collect()))
    failed = sum(1 for r in rows if r.failures)

    before = {n: wh.read("silver", n).count() for n in ["hub_customer", "sat_customer_details",
                                                       "sat_account_details"]}
    q["reload"] = _timed(lambda: run_batch(wh, tables.batch(3), F.lit("2021-01-01 00:00:00")
                                           .cast("timestamp_ntz"), 4))
    after = {n: wh.read("silver", n).count() for n in before}

    total = sum(q.values())
    print(json.dumps({
        "metric": "warehouse_build_and_queries_total",
        "value": round(total, 3),
        "unit": "sec",
        "queries": {k: round(v, 3) for k, v in q.items()},
        "sf": sf,
        "checks_run": len(rows),
        "checks_failed": failed,
        "reload_rows_appended": sum(after.values()) - sum(before.values()),
    }))


if __name__ == "__main__":
    main()
