"""Time the headline queries and print one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py [QUERY ...]

After a warm-up of the session, each query is built and run to the end three times, one
that takes longer than SLOW seconds once; the median counts. ``batch`` is one whole run of
the batch with few trees, from CSV files of the same tables: there, features and marts share
their base, which each query of the list makes for itself. It is not part of ``value``.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time
import uuid

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from checks.queries import QUERIES
from checks.views import AS_OF, StarShop
from stayline.plans.batch import run_batch
from stayline.session import build_session
from stayline.sources.sinks import export_marts
from stayline.sources.staging import checkpoint_root
from stayline.sources.tables import CSV_FILES

HEADLINE = (
    "unique_customers",
    "orders_by_status",
    "top_categories_by_revenue",
    "review_summary",
    "repeat_vs_one_time",
    "late_delivery_rate",
    "rfm_base",
    "category_diversity",
    "top_category",
    "customer_features",
    "executive_overview_mart",
    "sales_product_mart",
    "customer_behavior_mart",
    "churn_mart",
    "ai_briefs",
    "stratified_split",
    "auc_roc",
    "classification_report",
    "churn_scores",
)
SLOW = 20.0
BATCH = "batch"
BATCH_TREES = 20


def batch_seconds(spark: SparkSession, sf_dir: str) -> float:
    """Seconds of a whole batch over the shop as CSV files; writing these is not timed."""
    shop = StarShop(spark, sf_dir)
    empty = spark.range(0).select(F.col("id").cast("string").alias("id"))
    tables = {name: getattr(shop, name, empty) for name in CSV_FILES}
    folder = f"{checkpoint_root(spark).rstrip('/')}/bench-{uuid.uuid4().hex[:12]}"
    export_marts({CSV_FILES[name]: df for name, df in tables.items()}, f"{folder}/csv")
    start = time.perf_counter()
    run_batch(spark, f"{folder}/csv", f"{folder}/out", AS_OF, trees=BATCH_TREES)
    return round(time.perf_counter() - start, 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or [*HEADLINE, BATCH]
    spark = build_session(
        "bench",
        **{
            "spark.master": f"local[{cpus}]",
            "spark.driver.memory": "16g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.shuffle.partitions": cpus,
        },
    )
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    def median(name: str) -> float:
        times = [run(name)]
        while times[0] <= SLOW and len(times) < 3:
            times.append(run(name))
        return round(statistics.median(times), 3)

    run("orders_by_status")
    seconds = {name: median(name) for name in names if name != BATCH}
    found = {
        "metric": "total time of the headline queries",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
    }
    if BATCH in names:
        found[BATCH] = batch_seconds(spark, sf_dir)
    scale = re.search(r"sf([\d.]+)$", sf_dir)
    print(json.dumps({**found, "sf": float(scale.group(1)) if scale else None}))


if __name__ == "__main__":
    main()
