"""Benchmark of the headline operators.

Runs on ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) with
``local[$BENCH_CPUS]`` (default 8) and prints ONE JSON line:
{"metric": "total_sec", "value": N, "unit": "sec", "queries": {...}, "sf": ...}

Each timed query ends in an action over its whole input (a collect of a small
result or a ``noop`` write of a large one). Input staging (writing the raw
CSV files the ingest reads) is not timed.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from orderlake.operators import monitor, rollups  # noqa: E402
from orderlake.operators.classify import accepted, classify  # noqa: E402
from orderlake.plans.etl import compute_rollups  # noqa: E402
from orderlake.plans.ingest import ingest  # noqa: E402
from orderlake.session import build_session, unique_path  # noqa: E402
from orderlake.sinks import write_orders_parquet  # noqa: E402
from orderlake.sources.fixture import raw_orders, read_table, stage_raw_files  # noqa: E402


def _noop(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = build_session(f"local[{cpus}]", app="orderlake-bench", shuffle_partitions=cpus * 2,
                          extra={"spark.driver.memory": "16g"})
    from pyspark.sql import functions as F

    def clean():
        return accepted(classify(raw_orders(spark, sf_dir)))

    # Warm-up (JVM start, first code generation); not timed.
    clean().limit(1).collect()
    landing = stage_raw_files(spark, sf_dir)

    timings: dict[str, float] = {}

    def timed(name, fn):
        t0 = time.perf_counter()
        fn()
        timings[name] = round(time.perf_counter() - t0, 3)

    timed("classify_all_rows", lambda: _noop(classify(raw_orders(spark, sf_dir))))
    timed("clean_orders", lambda: _noop(clean()))
    timed("reject_profile", lambda: classify(raw_orders(spark, sf_dir))
          .groupBy("status", "reason").count().collect())
    timed("vip_customers", lambda: rollups.vip_customers(clean()).collect())
    timed("market_performance", lambda: rollups.market_performance(clean()).collect())
    timed("product_performance", lambda: rollups.product_performance(clean()).collect())
    timed("rollups_three_pass", lambda: [df.collect() for df in
                                         compute_rollups(clean(), one_pass=False).values()])
    timed("rollups_one_pass", lambda: [df.collect() for df in
                                       compute_rollups(clean(), one_pass=True).values()])

    def csv_ingest():
        ing = ingest(spark, landing)
        _noop(ing.published())
        ing.rejects().count()
        ing.dead_letters().count()
    timed("csv_ingest_gated", csv_ingest)
    timed("orders_parquet_write", lambda: write_orders_parquet(clean(), unique_path(spark, "bench-orders")))
    timed("dead_letter_alarm", lambda: monitor.backlog_alarm(
        read_table(spark, sf_dir, "events").where(F.col("event_type") == "error")).count())

    m = re.search(r"sf([0-9.]+)", sf_dir)
    out = {
        "metric": "total_sec",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": cpus,
        "spark": spark.version,
    }
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
