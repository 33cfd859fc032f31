"""Stratified split with exact class shares and no sort of a whole class."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BUCKET_DIGITS = 4  # 16^4 buckets per class


def stratified_split(
    df: DataFrame, label: str, key: str, test_share: float = 0.2, seed: int = 42
) -> DataFrame:
    """Add ``is_test``: the first ``round(test_share * n)`` rows of each class.

    Rows are ordered by the hash of key and seed, so the split depends neither
    on partitioning nor on row order. Instead of ranking a class in one task,
    rows are counted per hash prefix; only the bucket that holds the boundary
    (1/65,536 of the class) is ranked, and its last test hash is compared with
    every row. ``df`` is read three times: pass a stored table.
    """
    text = F.concat(F.coalesce(F.col(key), F.lit("")), F.lit(str(seed)))
    rows = df.withColumn("split_hash", F.md5(text))
    marked = rows.select(
        F.col(label).alias("class"),
        "split_hash",
        F.substring("split_hash", 1, BUCKET_DIGITS).alias("bucket"),
    )

    of_class = Window.partitionBy("class")
    boundary = (
        marked.groupBy("class", "bucket")
        .agg(F.count("*").alias("n"))
        .withColumns(
            {
                "upto": F.sum("n").over(of_class.orderBy("bucket")),
                "wanted": F.round(F.sum("n").over(of_class) * test_share),
            }
        )
        .where((F.col("upto") >= F.col("wanted")) & (F.col("upto") - F.col("n") < F.col("wanted")))
        .select("class", "bucket", (F.col("wanted") - (F.col("upto") - F.col("n"))).alias("take"))
    )
    # One row per class on both broadcast sides.
    last = (
        marked.join(F.broadcast(boundary), ["class", "bucket"])
        .withColumn("place", F.row_number().over(of_class.orderBy("split_hash")))
        .where(F.col("place") <= F.col("take"))
        .groupBy("class")
        .agg(F.max("split_hash").alias("last_hash"))
    )
    is_test = F.coalesce(F.col("split_hash") <= F.col("last_hash"), F.lit(False))
    return (
        rows.join(F.broadcast(last), F.col(label) == F.col("class"), "left")
        .withColumn("is_test", is_test)
        .drop("class", "last_hash", "split_hash")
    )
