"""The shop's tables: schemas, and readers for CSV and Parquet folders."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, fields

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from stayline.functions.dates import parse_date_text, to_date_text
from stayline.sources.bucketed import BucketStore
from stayline.sources.quoted_csv import read_quoted_csv

# Input file names, date columns and the text read as missing.
CSV_FILES = {
    "customers": "olist_customers_dataset.csv",
    "orders": "olist_orders_dataset.csv",
    "order_items": "olist_order_items_dataset.csv",
    "payments": "olist_order_payments_dataset.csv",
    "reviews": "olist_order_reviews_dataset.csv",
    "products": "olist_products_dataset.csv",
    "sellers": "olist_sellers_dataset.csv",
    "geolocation": "olist_geolocation_dataset.csv",
    "category_translation": "product_category_name_translation.csv",
}
DATE_COLUMNS = (
    "order_purchase_timestamp",
    "order_approved_at",
    "order_delivered_carrier_date",
    "order_delivered_customer_date",
    "order_estimated_delivery_date",
    "shipping_limit_date",
    "review_creation_date",
    "review_answer_timestamp",
)
MISSING_TEXT = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)
NUMBER_COLUMNS = {
    "order_item_id": "int",
    "price": "decimal(18,2)",
    "freight_value": "decimal(18,2)",
    "payment_installments": "int",
    "review_score": "int",
}
# Texts of each kind that have no more digits than it.
PLAIN_NUMBER = {"int": r"^-?[0-9]{1,9}\z", "decimal(18,2)": r"^-?[0-9]{1,16}(\.[0-9]{1,2})?\z"}

# Review comments hold line breaks inside quotes.
MULTI_LINE_TABLES = frozenset({"reviews"})


@dataclass(frozen=True)
class ShopTables:
    """One DataFrame per table; the last two are loaded but no plan reads them."""

    customers: DataFrame
    orders: DataFrame
    order_items: DataFrame
    payments: DataFrame
    reviews: DataFrame
    products: DataFrame
    category_translation: DataFrame
    sellers: DataFrame | None = None
    geolocation: DataFrame | None = None

    def named(self) -> dict[str, DataFrame]:
        pairs = ((f.name, getattr(self, f.name)) for f in fields(self))
        return {name: df for name, df in pairs if df is not None}

    def shared(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        """A table that several plans start from; here it is part of each plan."""
        return build()

    @property
    def stored(self) -> bool:
        """Whether shared tables are made once and lie in buckets of their order."""
        return False

    def register(self) -> None:
        """Make every table a temporary view, for ``spark.sql``."""
        for name, df in self.named().items():
            df.createOrReplaceTempView(name)


class StoredShop(ShopTables):
    """Shop tables whose shared tables are made once and kept in a store bucketed by order."""

    @classmethod
    def over(cls, tables: ShopTables, store: BucketStore) -> StoredShop:
        shop = cls(**tables.named())
        shop.__dict__["_store"] = store
        return shop

    def shared(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        return self.__dict__["_store"].keep(name, build)

    @property
    def stored(self) -> bool:
        return True


def _present(name: str) -> Column:
    text = F.col(f"`{name}`")
    return F.when(~text.isin(*MISSING_TEXT), text)


def read_csv_text(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """CSV with all columns as text. Only the header line is read ahead.

    Quotes are escaped by doubling. A file whose header differs from the first
    one's fails instead of shifting columns. ``multi_line`` files may have line breaks
    inside quotes; they are read by many tasks too.
    """
    if multi_line:
        raw = read_quoted_csv(spark, path)
    else:
        reader = spark.read.option("header", True).option("escape", '"').option("enforceSchema", False)
        raw = reader.csv(path)
    return raw.select([_present(c).alias(c) for c in raw.columns])


def typed(raw: DataFrame) -> DataFrame:
    """Dates and numbers from text; a date in no known layout becomes NULL."""

    def column(name: str) -> Column:
        text = F.col(f"`{name}`")
        if name in DATE_COLUMNS:
            return parse_date_text(text).alias(name)
        if name in NUMBER_COLUMNS:
            # Whole numbers may be written "1.0" when the column has gaps.
            kind = NUMBER_COLUMNS[name]
            exact = text.cast("decimal(38,10)")
            number = exact.cast(kind)
            wrong = F.raise_error(F.concat(F.lit(f"{name} needs more digits than {kind} has: "), text))
            # A plain number that fits is cast as it stands; only others go through 38 digits.
            return (
                F.when(text.rlike(PLAIN_NUMBER[kind]), text.cast(kind))
                .when(number != exact, wrong.cast(kind))
                .otherwise(number)
                .alias(name)
            )
        return text

    return raw.select([column(c) for c in raw.columns])


def typed_and_checked(raw: DataFrame) -> tuple[DataFrame, Observation | None]:
    """``typed(raw)``, and per date column the texts that name no moment, counted as the rows are written.

    None for a table without date columns.
    """
    dates = [c for c in raw.columns if c in DATE_COLUMNS]
    if not dates:
        return typed(raw), None
    seen = Observation()
    both = typed(raw.select("*", *[F.col(f"`{c}`").alias(f"{c} text") for c in dates]))
    bad = [F.count_if(F.col(f"`{c} text`").isNotNull() & F.col(f"`{c}`").isNull()).alias(c) for c in dates]
    return both.observe(seen, *bad).select(*[F.col(f"`{c}`") for c in raw.columns]), seen


def read_csv_folder(spark: SparkSession, folder: str) -> ShopTables:
    """The nine tables from CSV files (or folders of part files) under ``folder``."""
    folder = folder.rstrip("/")
    return ShopTables(
        **{
            name: typed(read_csv_text(spark, f"{folder}/{file}", name in MULTI_LINE_TABLES))
            for name, file in CSV_FILES.items()
        }
    )


def read_parquet_folder(spark: SparkSession, folder: str) -> ShopTables:
    """The nine tables as written by ``sinks.write_tables``."""
    folder = folder.rstrip("/")
    return ShopTables(**{name: spark.read.parquet(f"{folder}/{name}") for name in CSV_FILES})


def date_quality(raw_orders: DataFrame) -> DataFrame:
    """Per date column of ``raw_orders`` (text): rows, texts, parsed, unparsed, range."""
    names = [c for c in raw_orders.columns if c in DATE_COLUMNS]
    each = F.explode(
        F.array(
            *[
                F.struct(
                    F.lit(c).alias("date_column"),
                    F.col(c).alias("text"),
                    parse_date_text(F.col(c)).alias("ts"),
                )
                for c in names
            ]
        )
    ).alias("d")
    bad = F.col("text").isNotNull() & F.col("ts").isNull()
    return (
        raw_orders.select(each)
        .select("d.*")
        .groupBy("date_column")
        .agg(
            F.count("*").alias("total_rows"),
            F.count("text").alias("text_values"),
            F.count("ts").alias("parsed_values"),
            F.count_if(bad).alias("unparsed_values"),
            F.min("ts").alias("first_ts"),
            F.max("ts").alias("last_ts"),
        )
        .select(
            "date_column",
            "total_rows",
            "text_values",
            "parsed_values",
            "unparsed_values",
            to_date_text(F.col("first_ts")).alias("first_date"),
            to_date_text(F.col("last_ts")).alias("last_date"),
        )
    )


def date_sample(orders: DataFrame, rows: int = 5) -> DataFrame:
    """A few parsed dates to look at."""
    return orders.select(
        "order_purchase_timestamp",
        "order_delivered_customer_date",
        "order_estimated_delivery_date",
    ).limit(rows)
