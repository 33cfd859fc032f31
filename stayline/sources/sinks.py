"""Table and CSV output. Every write replaces what was there."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from stayline.functions.dates import OUTPUT_TEXT


def write_table(df: DataFrame, path: str) -> int:
    """Write Parquet and return the row count, counted while writing."""
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(path)
    return seen.get["rows"]


def write_csv(df: DataFrame, path: str, order_by: Sequence[Column] = ()) -> int:
    """Write a folder of CSV part files with header and return the row count."""
    seen = Observation()
    # Counted after the sort: sorting samples its input, which would count twice.
    rows = df.orderBy(*order_by) if order_by else df
    (
        rows.observe(seen, F.count(F.lit(1)).alias("rows"))
        .write.mode("overwrite")
        .option("header", True)
        .option("escape", '"')
        .option("timestampNTZFormat", OUTPUT_TEXT)
        .csv(path)
    )
    return seen.get["rows"]


def write_tables(tables: Mapping[str, DataFrame], folder: str) -> dict[str, int]:
    folder = folder.rstrip("/")
    return {name: write_table(df, f"{folder}/{name}") for name, df in tables.items()}


def export_marts(
    marts: Mapping[str, DataFrame],
    folder: str,
    order_by: Mapping[str, Sequence[Column]] | None = None,
) -> dict[str, tuple[int, int]]:
    """Write each mart as CSV under its name; rows and columns per mart."""
    folder = folder.rstrip("/")
    order_by = order_by or {}
    return {
        name: (write_csv(df, f"{folder}/{name}", order_by.get(name, ())), len(df.columns))
        for name, df in marts.items()
    }
