"""The shop's tables as views over the check tables (a TPC-H-like star).

``oracle.VIEWS`` says the same in SQL.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

AS_OF = datetime(2001, 7, 15)
UNTRANSLATED = ("Brand#24", "Brand#25")

# Declared, so that building a query does not start a job per file.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_nationkey int",
    "part": "p_partkey bigint, p_brand string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, "
    "o_orderdate timestamp_ntz",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_tax double, l_returnflag string, l_shipdate timestamp_ntz",
}


def _person(custkey: str) -> F.Column:
    """Two accounts share a person."""
    return F.col(custkey) - F.col(custkey) % 2


def _money(x: F.Column) -> F.Column:
    return F.round((x / 10000).cast("decimal(18,6)"), 2).cast("decimal(18,2)")


class StarShop:
    """``ShopTables`` whose tables are built when a query first asks for them."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    stored = False

    def shared(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        return build()

    def _table(self, name: str) -> DataFrame:
        return self.spark.read.schema(SCHEMAS[name]).parquet(f"{self.sf_dir}/{name}.parquet")

    @cached_property
    def customers(self) -> DataFrame:
        nations = self._table("nation").join(
            self._table("region"), F.col("n_regionkey") == F.col("r_regionkey")
        )
        return (
            self._table("customer")
            .join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
            .select(
                F.col("c_custkey").alias("customer_id"),
                F.concat(F.lit("u"), _person("c_custkey").cast("string")).alias(
                    "customer_unique_id"
                ),
                F.col("n_name").alias("customer_city"),
                F.col("r_name").alias("customer_state"),
            )
        )

    @cached_property
    def orders(self) -> DataFrame:
        last_shipped = (
            self._table("lineitem")
            .groupBy("l_orderkey")
            .agg(F.max("l_shipdate").alias("shipped"))
        )
        hour = (F.col("o_orderkey") % 24).cast("int")
        status = F.when(F.col("o_orderstatus") == "P", "canceled").otherwise("delivered")
        return (
            self._table("orders")
            .join(last_shipped, F.col("o_orderkey") == F.col("l_orderkey"), "left")
            .select(
                F.col("o_orderkey").alias("order_id"),
                F.col("o_custkey").alias("customer_id"),
                status.alias("order_status"),
                F.timestamp_add("HOUR", hour, F.col("o_orderdate")).alias(
                    "order_purchase_timestamp"
                ),
                F.col("shipped").alias("order_delivered_customer_date"),
                F.timestamp_add("DAY", F.lit(1000), F.col("o_orderdate")).alias(
                    "order_estimated_delivery_date"
                ),
            )
        )

    @cached_property
    def order_items(self) -> DataFrame:
        return self._table("lineitem").select(
            F.col("l_orderkey").alias("order_id"),
            F.col("l_linenumber").alias("order_item_id"),
            F.col("l_partkey").alias("product_id"),
            _money(F.col("l_extendedprice")).alias("price"),
            _money(F.col("l_extendedprice") * F.col("l_tax")).alias("freight_value"),
        )

    @cached_property
    def _ordered_lines(self) -> DataFrame:
        orders = self._table("orders").select("o_orderkey", "o_custkey")
        return self._table("lineitem").join(orders, F.col("l_orderkey") == F.col("o_orderkey"))

    @cached_property
    def reviews(self) -> DataFrame:
        return self._ordered_lines.where(
            (F.col("l_returnflag") == "R") & (_person("o_custkey") % 14 != 0)
        ).select(
            F.col("l_orderkey").alias("order_id"),
            (F.col("l_quantity").cast("int") % 5 + 1).alias("review_score"),
        )

    @cached_property
    def payments(self) -> DataFrame:
        return (
            self._ordered_lines.where(
                F.col("l_returnflag").isin("A", "N") & (_person("o_custkey") % 22 != 0)
            )
            .groupBy(
                F.col("l_orderkey").alias("order_id"),
                F.col("l_returnflag").alias("payment_type"),
            )
            .agg(F.count("*").cast("int").alias("payment_installments"))
        )

    @cached_property
    def products(self) -> DataFrame:
        return self._table("part").select(
            F.col("p_partkey").alias("product_id"),
            F.col("p_brand").alias("product_category_name"),
        )

    @cached_property
    def category_translation(self) -> DataFrame:
        return (
            self._table("part")
            .where(~F.col("p_brand").isin(*UNTRANSLATED))
            .select("p_brand")
            .distinct()
            .select(
                F.col("p_brand").alias("product_category_name"),
                F.concat(F.lit("cat_"), F.substring("p_brand", 7, 100)).alias(
                    "product_category_name_english"
                ),
            )
        )


def text_dated_orders(orders: DataFrame) -> DataFrame:
    """``orders`` with dates as text in mixed layouts, some of them unusable."""

    def mixed(name: str) -> F.Column:
        ts = F.col(name)
        layout = F.col("order_id") % 11
        return (
            F.when(layout == 0, F.date_format(ts, "yyyy-MM-dd"))
            .when(layout == 1, F.date_format(ts, "dd-MM-yyyy HH:mm"))
            .when(layout == 2, F.date_format(ts, "dd-MM-yyyy HH:mm:ss"))
            .when(layout == 3, F.date_format(ts, "dd/MM/yyyy HH:mm"))
            .when(layout == 4, F.date_format(ts, "yyyy-99-dd"))
            .when(layout == 5, F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"))
            .when(layout == 6, F.date_format(ts, "yyyy/MM/dd HH:mm"))
            .when(layout == 7, F.date_format(ts, "d-M-yyyy H:mm"))
            .when(layout == 8, F.date_format(ts, "yyyy-MM-dd HH:mm:ss.SSS"))
            .when(layout == 9, F.date_format(ts, "yyyy-MM-dd HH:mm:ss'+00:00'"))
            .otherwise(F.date_format(ts, "MM.dd.yyyy"))
        )

    names = (
        "order_purchase_timestamp",
        "order_delivered_customer_date",
        "order_estimated_delivery_date",
    )
    return orders.select("order_id", *[mixed(n).alias(n) for n in names])
