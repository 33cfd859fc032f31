"""Per-order totals that stand in for a one-to-many join.

Joining items, reviews and payments of an order gives items x reviews x
payments rows. The reports aggregate those rows, but never need them: with
``n`` item rows, ``r`` review rows and ``p`` payment rows, a price counts
``r * p`` times, a score ``n * p`` times and an instalment ``n * r`` times.
So each side is reduced to one row per order (partly before the shuffle, which
also absorbs an order holding most of a table), and only totals are joined.

Totals are whole numbers (money in cents), which keeps the shuffled rows small.
The weighted sums are whole decimals: exact and free of the order of tasks. A
single order whose product passes 18 digits is an error.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

WHOLE = "bigint"
CENTS = 100


def cents(amount: Column) -> Column:
    """A money amount as a whole number; a double counts as the nearest cent."""
    return F.round(amount.cast("decimal(28,8)") * CENTS, 0).cast("bigint")


def total(whole: Column) -> Column:
    """Exact sum of whole numbers."""
    return F.sum(whole.cast("decimal(18,0)"))


def line_totals(
    order_items: DataFrame, *keys: str, extra: Sequence[Column] = ()
) -> DataFrame:
    """Item rows, prices and freight per order (and per further key)."""
    return order_items.groupBy("order_id", *keys).agg(
        F.count("*").alias("line_rows"),
        F.sum(cents(F.col("price"))).alias("price_cents"),
        F.count("price").alias("price_rows"),
        F.sum(cents(F.col("freight_value"))).alias("freight_cents"),
        F.count("freight_value").alias("freight_rows"),
        *extra,
    )


def review_totals(reviews: DataFrame) -> DataFrame:
    return reviews.groupBy("order_id").agg(
        F.count("*").alias("review_rows"),
        F.sum("review_score").alias("score_sum"),
        F.count("review_score").alias("score_rows"),
        F.min("review_score").alias("score_min"),
    )


def payment_totals(payments: DataFrame, *keys: str) -> DataFrame:
    return payments.groupBy("order_id", *keys).agg(
        F.count("*").alias("payment_rows"),
        F.sum("payment_installments").alias("installment_sum"),
        F.count("payment_installments").alias("installment_rows"),
    )


def mark_first(df: DataFrame, mark: str, *keys: str) -> DataFrame:
    """Add ``mark``: 1 on one row per combination of ``keys``, 0 on repeats.

    ``sum(mark)`` then counts distinct combinations beside other aggregates
    without the extra shuffle of a distinct count, provided ``df`` is already
    partitioned by one of the keys.
    """
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(keys[0]))
    return df.withColumn(mark, F.when(place == 1, 1).otherwise(0))


class Weights:
    """Sums over the joined rows, written on one row per order.

    ``paid`` is False where payments are not part of the join. With ``dedupe`` nothing
    counts more than once: each item, review and payment is one, and so is each order
    wherever the report counts joined rows.
    """

    def __init__(self, paid: bool = True, dedupe: bool = False):
        def rows(column: str) -> Column:
            # A left join keeps one row where the order has no review or payment.
            return F.coalesce(F.col(column), F.lit(1)).cast(WHOLE)

        self.n = rows("line_rows")
        self.r = rows("review_rows")
        one = F.lit(1).cast(WHOLE)
        self.p = rows("payment_rows") if paid else one
        self.joined = one if dedupe else self.n * self.r * self.p
        self.per_line = one if dedupe else self.r * self.p
        self.per_score = one if dedupe else self.n * self.p
        self.per_installment = one if dedupe else self.n * self.r

    def rows(self, when: Column | None = None) -> Column:
        """Joined rows; with ``when``, those of the orders it holds for."""
        if when is None:
            return total(self.joined)
        return total(F.when(when, self.joined).otherwise(F.lit(0).cast(WHOLE)))

    def lines(self, column: str) -> Column:
        return total(F.col(column).cast(WHOLE) * self.per_line)

    def scores(self, column: str) -> Column:
        return total(F.col(column).cast(WHOLE) * self.per_score)

    def installments(self, column: str) -> Column:
        return total(F.col(column).cast(WHOLE) * self.per_installment)

    def line_rows_total(self) -> Column:
        """Sum of the order's item count over the joined rows."""
        return total(self.n * self.joined)

    def money(self, column: str) -> Column:
        """Weighted sum of a cents column, in money."""
        return self.lines(column).cast("double") / CENTS
