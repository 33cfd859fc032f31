"""Small shops in the source schema, as pandas frames, Spark tables and DuckDB tables."""

from __future__ import annotations

import random
from datetime import datetime, timedelta
from decimal import Decimal

import duckdb
import pandas as pd
from pyspark.sql import SparkSession

from checks import oracle
from stayline.sources.tables import ShopTables

SCHEMAS = {
    "customers": "customer_id string, customer_unique_id string, customer_city string, "
    "customer_state string",
    "orders": "order_id string, customer_id string, order_status string, "
    "order_purchase_timestamp timestamp_ntz, order_delivered_customer_date timestamp_ntz, "
    "order_estimated_delivery_date timestamp_ntz",
    "order_items": "order_id string, order_item_id int, product_id string, "
    "price decimal(18,2), freight_value decimal(18,2)",
    "payments": "order_id string, payment_type string, payment_installments int",
    "reviews": "order_id string, review_score int",
    "products": "product_id string, product_category_name string",
    "category_translation": "product_category_name string, product_category_name_english string",
}
# Names the checks' SQL uses for the tables.
SQL_NAMES = {
    "customers": "v_customers",
    "orders": "v_orders",
    "order_items": "v_items",
    "payments": "v_payments",
    "reviews": "v_reviews",
    "products": "v_products",
    "category_translation": "v_cat",
}
SQL_TYPES = {"string": "varchar", "timestamp_ntz": "timestamp"}

Rows = dict[str, list[tuple]]


def spark_tables(spark: SparkSession, rows: Rows) -> ShopTables:
    return ShopTables(
        **{name: spark.createDataFrame(rows[name], SCHEMAS[name]) for name in SCHEMAS}
    )


def duckdb_tables(rows: Rows) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name, schema in SCHEMAS.items():
        columns = []
        for column in schema.replace("(18,2)", "#").split(", "):
            column_name, kind = column.split(" ")
            columns.append(f"{column_name} {SQL_TYPES.get(kind, kind)}".replace("#", "(18,2)"))
        con.execute(f"create table {SQL_NAMES[name]} ({', '.join(columns)})")
        if rows[name]:
            marks = ", ".join("?" * len(columns))
            con.executemany(f"insert into {SQL_NAMES[name]} values ({marks})", rows[name])
    return con


def sql_rows(con: duckdb.DuckDBPyConnection, query: str) -> pd.DataFrame:
    """A registered query on the shop's own tables instead of the check views."""
    common, final = oracle.PARTS[query]
    return con.execute(f"with {common} {final}" if common else final).df()


def money(x: float) -> Decimal:
    return Decimal(f"{x:.2f}")


def random_shop(seed: int, orders: int = 300, hot: str = "c o pr") -> Rows:
    """A shop with gaps and repeats; of each kind in ``hot``, one key holds a third.

    With a hot order keep ``orders`` small: the plain SQL joins grow with its cube.
    """
    hot_kinds = hot.split()
    r = random.Random(seed)

    def maybe(value, chance=0.05):
        return None if r.random() < chance else value

    def key(prefix: str, n: int) -> str:
        return f"{prefix}0" if prefix in hot_kinds and r.random() < 1 / 3 else f"{prefix}{r.randrange(n)}"

    def moment() -> datetime:
        return datetime(2001, 1, 1) + timedelta(seconds=r.randrange(200 * 86400))

    customers = [
        (f"c{i}", maybe(f"p{i // 2}", 0.03), maybe(f"city{i % 5}"), maybe(f"st{i % 3}"))
        for i in range(60)
    ]
    customers += customers[:2]
    order_rows = []
    for i in range(orders):
        bought = maybe(moment(), 0.03)
        promised = maybe(moment())
        status = r.choice(["delivered"] * 8 + ["canceled", "shipped"])
        order_rows.append((f"o{i}", key("c", 60), status, bought, maybe(moment(), 0.1), promised))
    order_rows += order_rows[:5]  # loaded twice
    order_rows += [("o7", "c9", "delivered", moment(), moment(), moment())]  # disagrees with o7
    items = [
        (
            key("o", orders) if i % 2 else f"o{r.randrange(orders)}",
            maybe(i % 4 + 1),
            key("pr", 40),
            maybe(money(r.uniform(0, 90))),
            maybe(money(r.uniform(0, 9))),
        )
        for i in range(orders * 2)
    ]
    payments = [
        (key("o", orders), maybe(r.choice(["card", "slip", "voucher"])), maybe(r.randint(1, 10)))
        for _ in range(orders)
    ]
    reviews = [(key("o", orders), maybe(r.randint(1, 5))) for _ in range(orders)]
    products = [(f"pr{i}", maybe(f"cat{i % 9}")) for i in range(40)]
    translation = [(f"cat{i}", f"English {i}") for i in range(6)]
    translation += [("cat6", None), ("cat0", "English 0 again")]
    return {
        "customers": customers,
        "orders": order_rows,
        "order_items": items,
        "payments": payments,
        "reviews": reviews,
        "products": products,
        "category_translation": translation,
    }


def ts(text: str) -> datetime:
    return datetime.fromisoformat(text)
