"""First-look reports on the raw tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayline.functions import half_up, ratio
from stayline.plans.purchases import DELIVERED, is_late, product_categories
from stayline.sources.tables import ShopTables


def unique_customers(t: ShopTables) -> DataFrame:
    return t.customers.agg(F.count_distinct("customer_unique_id").alias("unique_customers"))


def orders_by_status(t: ShopTables) -> DataFrame:
    return (
        t.orders.groupBy("order_status")
        .agg(F.count("*").alias("total_orders"))
        .orderBy(F.desc("total_orders"), "order_status")
    )


def top_categories_by_revenue(t: ShopTables, k: int = 10) -> DataFrame:
    """The ``k`` categories that sold most.

    Items are summed per product first: the join then sees one row per
    product, so a best-seller is no hot key.
    """
    per_product = t.order_items.groupBy("product_id").agg(
        F.count("order_id").alias("items"), F.sum("price").alias("revenue")
    )
    return (
        per_product.join(product_categories(t), "product_id")
        .groupBy("category")
        .agg(
            F.sum("items").alias("total_orders"),
            F.sum("revenue").cast("double").alias("total_revenue"),
        )
        .orderBy(F.desc("total_revenue"), "category")
        .limit(k)
    )


def review_summary(t: ShopTables) -> DataFrame:
    mean = ratio(F.sum("review_score"), F.count("review_score"))
    return t.reviews.agg(
        half_up(mean, 2).alias("avg_review_score"), F.count("*").alias("total_reviews")
    )


def repeat_vs_one_time(t: ShopTables) -> DataFrame:
    """Buyers with several delivered orders against those with one."""
    per_account = (
        t.orders.where(F.col("order_status") == DELIVERED)
        .groupBy("customer_id")
        .agg(F.count("order_id").alias("orders"))
    )
    per_person = (
        per_account.join(t.customers, "customer_id")
        .groupBy("customer_unique_id")
        .agg(F.sum("orders").alias("orders"))
    )
    return per_person.agg(
        F.sum(F.when(F.col("orders") > 1, 1).otherwise(0)).alias("repeat_customers"),
        F.sum(F.when(F.col("orders") == 1, 1).otherwise(0)).alias("one_time_customers"),
        F.count("*").alias("total_customers"),
    )


def late_delivery_rate(t: ShopTables) -> DataFrame:
    arrived = t.orders.where(
        (F.col("order_status") == DELIVERED) & F.col("order_delivered_customer_date").isNotNull()
    )
    late = F.sum(is_late().cast("bigint"))
    return arrived.agg(
        F.count("*").alias("total_delivered"),
        late.alias("late_deliveries"),
        half_up(ratio(late * 100, F.count("*")), 2).alias("late_delivery_pct"),
    )
