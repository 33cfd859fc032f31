"""Global row numbers without a single-task sort."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stayline.sources.staging import stage

_LOW = (1 << 33) - 1


def numbered(df: DataFrame, keys: list[Column], name: str = "row_number") -> DataFrame:
    """``df`` with ``name``: 0, 1, 2, ... in the order of ``keys``.

    Rows are dealt out by key range and sorted in their partition; each
    partition's numbers start where the one before ends. Rows equal in all keys
    are told apart by their place in the input, so equal rows spread over
    partitions; which of them comes first is not defined. The numbered rows are
    staged once, so a repeated task cannot number them anew.
    """
    tie, place = "_tie", "_place"
    dealt = (
        df.withColumn(tie, F.monotonically_increasing_id())
        .repartitionByRange(*keys, F.col(tie))
        .sortWithinPartitions(*keys, F.col(tie))
        .drop(tie)
        .withColumn(place, F.monotonically_increasing_id())
    )
    kept = stage(dealt, "numbered").withColumn("_part", F.shiftright(place, 33))
    sizes = kept.groupBy("_part").agg(F.count("*").alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # One row per partition of one shuffle: bounded by the session's partition count.
    starts = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    return (
        kept.join(F.broadcast(starts), "_part")
        .withColumn(name, F.col("_start") + F.col(place).bitwiseAND(F.lit(_LOW)))
        .drop("_part", "_start", place)
    )
