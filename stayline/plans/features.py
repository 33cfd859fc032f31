"""Customer feature table: recency, frequency, spend, service quality, categories."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayline.functions import days_between, half_up, moment, ratio
from stayline.operators.fanout import Weights, mark_first
from stayline.operators.quantile import quantile_values
from stayline.plans.purchases import (
    by_order,
    category_lines,
    delivered,
    item_categories,
    order_lines,
    order_payments,
    order_reviews,
)
from stayline.sources.staging import stage
from stayline.sources.tables import ShopTables

# Fixed values.
AS_OF = datetime(2018, 9, 1)
CHURN_DAYS = 90
UNKNOWN_CATEGORY = "unknown"

FEATURE_COLUMNS = (
    "customer_unique_id",
    "recency_days",
    "frequency",
    "monetary",
    "avg_freight_paid",
    "avg_items_per_order",
    "avg_review_score",
    "min_review_score",
    "late_delivery_pct",
    "late_delivery_count",
    "avg_installments",
    "is_churned",
    "category_diversity",
    "top_category",
)


def days_since_last_order(as_of: datetime) -> Column:
    return days_between(F.max("order_purchase_timestamp"), moment(as_of))


def rfm_base(
    t: ShopTables, as_of: datetime = AS_OF, churn_days: float = CHURN_DAYS, dedupe: bool = False
) -> DataFrame:
    """One row per person with a delivered order: 12 columns.

    Prices, scores and instalments count once per row of the order's items x
    reviews x payments, or once with ``dedupe``. ``recency_days`` drops the fraction
    of a day, the churn test does not.
    """
    w = Weights(dedupe=dedupe)
    quiet_days = days_since_last_order(as_of)
    late_share = ratio(w.rows(F.col("is_late")), w.rows())
    orders = by_order(
        t,
        delivered(t)
        .where(F.col("order_delivered_customer_date").isNotNull())
        .select("order_id", "customer_unique_id", "order_purchase_timestamp", "is_late"),
    )
    return (
        mark_first(orders, "new_order", "order_id", "customer_unique_id")
        .join(order_lines(t), "order_id")
        .join(order_reviews(t), "order_id", "left")
        .join(order_payments(t), "order_id", "left")
        .groupBy("customer_unique_id")
        .agg(
            quiet_days.cast("int").alias("recency_days"),
            F.sum("new_order").alias("frequency"),
            w.money("price_cents").alias("monetary"),
            half_up(ratio(w.money("freight_cents"), w.lines("freight_rows")), 2).alias(
                "avg_freight_paid"
            ),
            half_up(ratio(w.line_rows_total(), w.rows()), 2).alias("avg_items_per_order"),
            half_up(ratio(w.scores("score_sum"), w.scores("score_rows")), 2).alias(
                "avg_review_score"
            ),
            F.min("score_min").cast("double").alias("min_review_score"),
            half_up(late_share * 100, 2).alias("late_delivery_pct"),
            w.rows(F.col("is_late")).cast("bigint").alias("late_delivery_count"),
            half_up(
                ratio(w.installments("installment_sum"), w.installments("installment_rows")), 2
            ).alias("avg_installments"),
            F.when(quiet_days > churn_days, 1).otherwise(0).alias("is_churned"),
        )
    )


def category_counts(t: ShopTables) -> DataFrame:
    """Delivered items per person and category (NULL where the translation is).

    From the stored totals per order and category where there are any. Else from single items:
    totals would need a shuffle of their own for nearly as many rows.
    """
    orders = delivered(t).select("order_id", "customer_unique_id")
    if t.stored:
        lines, items = category_lines(t).select("order_id", "category", "line_rows"), F.sum("line_rows")
    else:
        lines, items = item_categories(t).select("order_id", "category"), F.count("*")
    return orders.join(lines, "order_id").groupBy("customer_unique_id", "category").agg(items.alias("items"))


def _diversity() -> Column:
    return F.count("category").alias("category_diversity")


def _top() -> Column:
    """Most bought category; equal counts go to the first in the alphabet."""
    known = F.when(F.col("category").isNotNull(), F.struct(-F.col("items"), F.col("category")))
    return F.min_by("category", known).alias("top_category")


def category_diversity(t: ShopTables) -> DataFrame:
    return category_counts(t).groupBy("customer_unique_id").agg(_diversity())


def top_category(t: ShopTables) -> DataFrame:
    known = category_counts(t).where(F.col("category").isNotNull())
    return known.groupBy("customer_unique_id").agg(_top())


def raw_features(
    t: ShopTables, as_of: datetime = AS_OF, churn_days: float = CHURN_DAYS, dedupe: bool = False
) -> DataFrame:
    """``rfm_base`` with category columns, gaps not yet filled."""
    rfm = rfm_base(t, as_of, churn_days, dedupe).alias("rfm")
    habits = category_counts(t).groupBy("customer_unique_id").agg(_diversity(), _top()).alias("cat")
    # The person without an id is a group too and must find its partner.
    same = F.col("rfm.customer_unique_id").eqNullSafe(F.col("cat.customer_unique_id"))
    return rfm.join(habits, same, "left").select(
        "rfm.*", "cat.category_diversity", "cat.top_category"
    )


def fill_median(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Fill NULLs in ``columns`` with the column's median, all found in one search."""
    medians = quantile_values(df, columns, 0.5)
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(m)) for c, m in zip(columns, medians)})


def impute(raw: DataFrame) -> DataFrame:
    """Fill gaps, then drop people whose spend or recency is unknown.

    Medians are taken over all rows, before the drop.
    """
    return (
        fill_median(raw, ["avg_review_score", "min_review_score"])
        .na.fill({"late_delivery_pct": 0.0, "late_delivery_count": 0, "avg_installments": 1.0})
        .na.fill({"category_diversity": 1, "top_category": UNKNOWN_CATEGORY})
        .na.drop(subset=["monetary", "recency_days"])
        .select(*FEATURE_COLUMNS)
    )


def customer_features(
    t: ShopTables, as_of: datetime = AS_OF, churn_days: float = CHURN_DAYS, dedupe: bool = False
) -> DataFrame:
    """The feature table, 14 columns, one row per person; ``dedupe`` as in ``rfm_base``.

    The joined features are staged: the medians need them before the fill, and
    computing them twice would scan every input twice.
    """
    return impute(stage(raw_features(t, as_of, churn_days, dedupe), "raw_features"))
