"""Physical plans: what must and must not be in them."""

from __future__ import annotations

import random
from contextlib import contextmanager

import pytest

from checks.compare import mismatch
from checks.views import AS_OF, StarShop
from stayline.plans import briefs, explore, features, marts, purchases
from stayline.plans.purchases import (
    category_lines,
    delivered,
    item_categories,
    product_categories,
)
from stayline.sources import sinks
from stayline.sources.bucketed import BucketStore
from stayline.sources.tables import StoredShop, read_parquet_folder
from tests.shops import duckdb_tables, random_shop, spark_tables, sql_rows

SF_DIR = "/root/testdata/sf0.001"

NATIVE = {
    "unique_customers": explore.unique_customers,
    "orders_by_status": explore.orders_by_status,
    "top_categories_by_revenue": explore.top_categories_by_revenue,
    "review_summary": explore.review_summary,
    "repeat_vs_one_time": explore.repeat_vs_one_time,
    "late_delivery_rate": explore.late_delivery_rate,
    "raw_features": lambda t: features.raw_features(t, AS_OF),
    "customer_features": lambda t: features.customer_features(t, AS_OF),
    "executive_overview_mart": marts.executive_overview_mart,
    "sales_product_mart": marts.sales_product_mart,
    "customer_behavior_mart": lambda t: marts.customer_behavior_mart(t, AS_OF),
}


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@contextmanager
def settings(spark, **values):
    names = {k.replace("__", "."): v for k, v in values.items()}
    before = {k: spark.conf.get(k, None) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


@pytest.mark.parametrize("name", sorted(NATIVE))
def test_no_python_and_no_pairing_of_all_rows(spark, name):
    plan = plan_of(NATIVE[name](StarShop(spark, SF_DIR)))
    for forbidden in ("Python", "Pandas", "CartesianProduct", "NestedLoopJoin", "Expand"):
        assert forbidden not in plan


def test_topk_is_one_operator(spark):
    table = StarShop(spark, SF_DIR)
    assert "TakeOrderedAndProject" in plan_of(explore.top_categories_by_revenue(table))
    scored = spark.createDataFrame(
        [("a", 90.0, "Critical")],
        "customer_unique_id string, churn_risk_score double, risk_segment string",
    )
    assert "TakeOrderedAndProject" in plan_of(briefs.high_risk_topk(scored))


def test_scans_read_only_what_is_used(spark, tmp_path):
    tables = spark_tables(spark, random_shop(3, orders=30)).named()
    empty = {name: spark.range(0) for name in ("sellers", "geolocation")}
    sinks.write_tables({**tables, **empty}, str(tmp_path))
    stored = read_parquet_folder(spark, str(tmp_path))
    plan = plan_of(explore.late_delivery_rate(stored))
    assert "EqualTo(order_status,delivered)" in plan
    assert "IsNotNull(order_delivered_customer_date)" in plan
    assert "order_purchase_timestamp" not in plan
    totals = plan_of(explore.top_categories_by_revenue(stored))
    assert "freight_value" not in totals and "order_item_id" not in totals


HOT_KEY_SETTINGS = {
    "spark__sql__autoBroadcastJoinThreshold": "-1",
    "spark__sql__adaptive__autoBroadcastJoinThreshold": "-1",
    "spark__sql__adaptive__coalescePartitions__enabled": "false",
    "spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes": "4k",
    "spark__sql__adaptive__skewJoin__skewedPartitionFactor": "1.5",
    "spark__sql__adaptive__advisoryPartitionSizeInBytes": "4k",
}


def test_hot_order_is_summed_before_category_counts(spark):
    """An order with 20,000 items joins as one row per category."""
    rows = random_shop(9, orders=300, hot="")
    order_id = next(o[0] for o in rows["orders"] if o[2] == "delivered")
    r = random.Random(9)
    rows["order_items"] += [(order_id, 1, f"pr{r.randrange(40)}", None, None) for _ in range(20000)]
    tables = spark_tables(spark, rows)
    with settings(spark, **HOT_KEY_SETTINGS), duckdb_tables(rows) as con:
        lines = category_lines(tables)
        assert lines.where(lines.order_id == order_id).count() <= len(rows["category_translation"]) + 1
        top = features.top_category(tables).toPandas()
        assert mismatch(top, sql_rows(con, "top_category")) is None


def test_hot_category_is_split_in_the_translation_of_products(spark):
    rows = random_shop(9, orders=30, hot="")
    name = rows["category_translation"][0][0]
    rows["products"] += [(f"hot{i}" * 5, name) for i in range(20000)]
    tables = spark_tables(spark, rows)
    with settings(spark, **HOT_KEY_SETTINGS):
        products = product_categories(tables).repartition("product_id")
        products.collect()
        assert "SortMergeJoin(skew=true)" in plan_of(products)


BASED = {
    "raw_features": lambda t: features.raw_features(t, AS_OF),
    "executive_overview_mart": marts.executive_overview_mart,
    "sales_product_mart": marts.sales_product_mart,
    "customer_behavior_base": lambda t: marts.customer_behavior_base(t, AS_OF),
}
BASE = ["category_lines", "order_lines", "order_payments", "order_reviews", "payment_lines", "purchases"]


@pytest.fixture
def stored(spark, tmp_path):
    """A random shop, over a store that counts what it makes."""
    tables = spark_tables(spark, random_shop(4, orders=60, hot=""))
    made = []

    class Counted(StoredShop):
        def shared(self, name, build):
            return super().shared(name, lambda: made.append(name) or build())

    store = BucketStore(spark, str(tmp_path / "base"), "order_id", 8)
    yield tables, Counted.over(tables, store), made
    store.close()


def test_a_batch_makes_its_base_tables_once(spark, stored, tmp_path):
    """Stored tables are scanned: one join of orders with customers, two scans of items."""
    tables, kept, made = stored
    for build in BASED.values():
        assert sorted(map(str, build(tables).collect())) == sorted(map(str, build(kept).collect()))
        files = build(kept).inputFiles()
        assert files and all(any(f"/{name}/" in f for name in made) for f in files)
    assert sorted(made) == BASE

    # A later run takes the tables as they lie, buckets included.
    again = BucketStore(spark, str(tmp_path / "base"), "order_id", 99)
    try:
        taken = StoredShop.over(tables, again)
        for build in BASED.values():
            assert sorted(map(str, build(tables).collect())) == sorted(map(str, build(taken).collect()))
            assert "SelectedBucketsCount: 8 out of 8" in plan_of(build(taken)) or "SortMergeJoin" not in plan_of(build(taken))
    finally:
        again.close()


@pytest.mark.parametrize("name", ["rfm_base", *BASED])
def test_stored_tables_join_without_a_shuffle(spark, stored, name):
    """Nothing is shuffled before the aggregate by the report's own keys."""
    _, kept, _ = stored
    build = {**BASED, "rfm_base": lambda t: features.rfm_base(t, AS_OF)}[name]
    with settings(spark, **HOT_KEY_SETTINGS):
        plan = plan_of(build(kept))
    shuffles = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert shuffles and plan.count("SortMergeJoin") >= 2
    assert not [line for line in shuffles if "order_id" in line]
    assert "Exchange RoundRobin" not in plan and plan.count("Bucketed: true") == plan.count("FileScan parquet")


def test_hot_customer_and_hot_product_are_split(spark):
    """Row-level joins are split; all else is summed before its join."""
    rows = random_shop(9, orders=3000, hot="c pr")
    tables = spark_tables(spark, rows)
    with settings(spark, **HOT_KEY_SETTINGS):
        bought = delivered(tables).repartition("order_id")
        bought.collect()
        assert "SortMergeJoin(skew=true)" in plan_of(bought)
        lines = item_categories(tables).groupBy("order_id", "category").count()
        lines.collect()
        assert "SortMergeJoin(skew=true)" in plan_of(lines)
        with duckdb_tables(rows) as con:
            for name in ("rfm_base", "sales_product_mart", "top_category"):
                plan = {**NATIVE, "rfm_base": lambda t: features.rfm_base(t, AS_OF)}.get(
                    name, features.top_category
                )
                result = plan(tables)
                assert mismatch(result.toPandas(), sql_rows(con, name)) is None
                assert "BroadcastHashJoin" not in plan_of(result)


def test_tasks_of_the_marts_stay_small_on_large_tables(spark, tmp_path):
    """Shuffles get more partitions with the tables, and adaptive execution merges none beyond a fixed size."""
    names = ("spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.shuffle.partitions")
    before = {n: spark.conf.get(n) for n in names}
    try:
        spark.conf.set(names[0], "128m")
        spark.conf.set(names[1], "8")
        purchases.small_tasks(spark.range(1000))
        assert [spark.conf.get(n) for n in names] == [f"{purchases.TASK_BYTES}b", "8"]
        purchases.small_tasks(spark.range(40 * purchases.TASK_BYTES // 8))
        assert spark.conf.get(names[1]) == str(40 * purchases.GROWTH)
        spark.conf.set(names[0], "64k")
        purchases.small_tasks(spark.range(1000))
        assert [spark.conf.get(n) for n in names] == ["64k", str(40 * purchases.GROWTH)]
    finally:
        for n, v in before.items():
            spark.conf.set(n, v)
