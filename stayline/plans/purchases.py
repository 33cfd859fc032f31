"""Joins that several datasets start from.

The first two end in a plain join of two shuffled inputs followed by another shuffle,
which lets adaptive execution split a customer or product that owns a large
part of all rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayline.operators.fanout import cents, line_totals, payment_totals, review_totals
from stayline.sources.tables import ShopTables

DELIVERED = "delivered"
CANCELED = "canceled"
#: Bytes of shuffled rows for one task, and shuffled bytes per byte of the tables' size.
TASK_BYTES = 8 << 20
GROWTH = 2


def is_late() -> Column:
    """Delivered after the promised date; an unknown date is not late."""
    late = F.col("order_delivered_customer_date") > F.col("order_estimated_delivery_date")
    return F.coalesce(late, F.lit(False))


def purchases(t: ShopTables) -> DataFrame:
    """Orders with their customer's person id, city and state."""
    return t.shared("purchases", lambda: _purchases(t))


def _purchases(t: ShopTables) -> DataFrame:
    return t.orders.select(
        "order_id",
        "customer_id",
        "order_status",
        "order_purchase_timestamp",
        "order_delivered_customer_date",
        "order_estimated_delivery_date",
        is_late().alias("is_late"),
    ).join(t.customers, "customer_id")


def delivered(t: ShopTables) -> DataFrame:
    return purchases(t).where(F.col("order_status") == DELIVERED)


def small_tasks(df: DataFrame) -> None:
    """Let a task read at most about TASK_BYTES of shuffled rows, however large the tables of ``df`` are.

    Adaptive execution merges small partitions up to its advisory size, 64 MB of packed rows
    where nothing is set, and makes no more partitions than the session has. A task that sorts
    several inputs holds many times what it reads.
    """
    spark = df.sparkSession
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    if spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(size)) > TASK_BYTES:
        spark.conf.set(size, f"{TASK_BYTES}b")
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size())]
    read = sum(n for n in sizes if n < 1 << 50)  # rows of unknown size count as the greatest number
    partitions = "spark.sql.shuffle.partitions"
    if GROWTH * read // TASK_BYTES > int(spark.conf.get(partitions)):
        spark.conf.set(partitions, str(GROWTH * read // TASK_BYTES))


def by_order(t: ShopTables, df: DataFrame) -> DataFrame:
    """``df`` with all rows of an order in one partition; stored tables lie so already."""
    if t.stored:
        return df
    small_tasks(df)
    return df.repartition("order_id")


def product_categories(t: ShopTables) -> DataFrame:
    """product_id and English category; untranslated products are left out."""
    return t.products.join(t.category_translation, "product_category_name").select(
        "product_id", F.col("product_category_name_english").alias("category")
    )


def item_categories(t: ShopTables) -> DataFrame:
    """Order items of translated products, with their category."""
    return t.order_items.join(product_categories(t), "product_id")


def order_lines(t: ShopTables) -> DataFrame:
    """Item rows, prices and freight per order."""
    return t.shared("order_lines", lambda: line_totals(t.order_items))


def order_reviews(t: ShopTables) -> DataFrame:
    return t.shared("order_reviews", lambda: review_totals(t.reviews))


def order_payments(t: ShopTables) -> DataFrame:
    return t.shared("order_payments", lambda: payment_totals(t.payments))


def payment_lines(t: ShopTables) -> DataFrame:
    """Payments per order and payment type."""
    return t.shared("payment_lines", lambda: payment_totals(t.payments, "payment_type"))


def category_lines(t: ShopTables) -> DataFrame:
    """Totals per order and category, over items of translated products."""
    extra = [
        F.count("order_item_id").alias("item_rows"),
        F.sum(cents(F.col("price") + F.col("freight_value"))).alias("value_cents"),
    ]
    return t.shared("category_lines", lambda: line_totals(item_categories(t), "category", extra=extra))
