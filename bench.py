"""Time the headline queries and the build; prints one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8)."""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
from datetime import datetime
from statistics import median

from pyspark.sql import functions as F

from martworks.catalog.lake import EARLIEST, Lake
from martworks.catalog.queries import QUERIES, SUITE_BOUNDS
from martworks.catalog.testdata import RAW_TABLES
from martworks.plans import pipeline, reports
from martworks.plans.warehouse import Warehouse
from martworks.quality import checks, declared, expectations, suites
from martworks.session import build_session

HEADLINE = (
    "stg_order_items payment_summary item_summary review_summary delivery_timeline "
    "fct_orders fct_order_items dim_customers dim_products dim_sellers dim_geography "
    "agg_daily_performance scd2_snapshot_two_loads scd2_overlap_violations "
    "scd2_point_in_time_revenue orphan_lines duplicate_keys monthly_revenue_region"
).split()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    folder = tempfile.mkdtemp(prefix="run-")
    spark = build_session(
        "bench",
        master=f"local[{cpus}]",
        shuffle_partitions=cpus,
        **{
            "spark.driver.memory": "12g",
            "spark.driver.extraJavaOptions": "-XX:+UseParallelGC",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.checkpoint.dir": f"{folder}/checkpoints",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds: dict[str, float] = {}

    def timed(name: str, step, repeat: int = 1):
        taken, result = [], None
        for _ in range(repeat):
            began = time.monotonic()
            result = step()
            taken.append(time.monotonic() - began)
        seconds[name] = round(median(taken), 3)
        return result

    def run(df):
        df.write.format("noop").mode("overwrite").save()

    # Start-up: JVM and generated code, on the smallest tables.
    small = os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.001")
    for name in HEADLINE:
        run(QUERIES[name](spark, small if os.path.isdir(small) else sf_dir))
    for name in HEADLINE:
        timed(name, lambda n=name: run(QUERIES[n](spark, sf_dir)))

    # The build on stored raw tables.
    lake, raw = Lake(spark, sf_dir), {}

    def store_raw():
        for table in RAW_TABLES:
            path, rows = f"{folder}/raw/{table}", lake.raw(table)
            if table in pipeline.SLICED:
                # Landed by slices; months in place of days, which suits small data.
                month = F.trunc("ingest_date", "month")
                rows = rows.withColumn("ingest_date", month).hint("rebalance", F.col("ingest_date"))
                rows.write.partitionBy("ingest_date").parquet(path)
            else:
                rows.hint("rebalance").write.parquet(path)
            raw[table] = spark.read.parquet(path)

    timed("store_raw", store_raw)
    warehouse = Warehouse(spark, f"{folder}/warehouse")
    for label, full in (("full", True), ("incremental", False)):
        build = pipeline.Build(
            warehouse,
            raw.__getitem__,
            datetime(2001, 9, 1),
            full_refresh=full,
            earliest=EARLIEST,
            partition_by_month=True,
            calendar=("1995-01-01", "2002-01-01"),
        )
        timed(f"build_{label}", build.run)
        steps = {task: taken for task, taken, _ in build.timings}
        for fact in ("fct_orders", "fct_order_items"):
            seconds[f"{fact}_{label}"] = round(steps[fact], 3)
        seconds[f"facts_{label}"] = round(
            max(steps["order_context"], steps["stg_order_items"]) + sum(steps[t] for t in pipeline.FACT_KEYS), 3
        )
    marts = {
        n: warehouse.read(n)
        for n in (
            "fct_orders fct_order_items dim_customers dim_products dim_sellers dim_geography "
            "dim_date agg_daily_performance dim_sellers_history"
        ).split()
    }
    timed("checks_marts_stored", lambda: checks.run_checks(marts, declared.MART_CHECKS).collect())
    scale = marts["fct_orders"].count()
    timed(
        "suites_stored",
        lambda: expectations.run_suites(marts, suites.build_suites(scale, SUITE_BOUNDS)).collect(),
    )
    trio = {
        "monthly_trend": reports.monthly_trend,
        "region_category": reports.region_category_revenue,
        "top_states": lambda facts: reports.top_states(facts, 2000),
    }
    for name, report in trio.items():
        for grain, table in (("fact", "fct_order_items"), ("agg", "agg_daily_performance")):
            timed(f"{name}_stored_{grain}", lambda r=report, t=table: r(marts[t]).collect(), 5)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "sum of headline queries, build, checks and dashboards",
                "value": round(sum(seconds[n] for n in seconds if "facts_" not in n), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "cpus": cpus,
            }
        )
    )


if __name__ == "__main__":
    sys.exit(main())
