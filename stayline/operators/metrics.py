"""Evaluation of a 0/1 classifier from counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stayline.functions import ratio
from stayline.sources.staging import stage


def class_balance(df: DataFrame, label: str) -> DataFrame:
    """Counts of both classes, share of positives, and negatives per positive."""
    positives = F.sum(F.col(label).cast("bigint"))
    negatives = F.count_if(F.col(label) == 0)
    return df.agg(
        F.count("*").alias("total_rows"),
        positives.alias("positives"),
        negatives.alias("negatives"),
        (ratio(positives, F.count(label)) * 100).alias("positive_pct"),
        ratio(negatives, positives).alias("positive_weight"),
    )


def _cells(df: DataFrame, label: str, prediction: str) -> DataFrame:
    def cell(actual: int, predicted: int) -> Column:
        return F.count_if((F.col(label) == actual) & (F.col(prediction) == predicted))

    return df.agg(
        cell(0, 0).alias("tn"), cell(0, 1).alias("fp"), cell(1, 0).alias("fn"), cell(1, 1).alias("tp")
    )


def confusion_matrix(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """Four rows: actual class, predicted class, rows."""
    cells = [(0, 0, "tn"), (0, 1, "fp"), (1, 0, "fn"), (1, 1, "tp")]
    each = F.inline(
        F.array(
            *[
                F.struct(
                    F.lit(actual).alias("actual"),
                    F.lit(predicted).alias("predicted"),
                    F.col(name).alias("row_count"),
                )
                for actual, predicted, name in cells
            ]
        )
    )
    return _cells(df, label, prediction).select(each)


def classification_report(
    df: DataFrame, label: str, prediction: str, names: Sequence[str] = ("Active", "Churned")
) -> DataFrame:
    """Precision, recall, F1 and support per class, accuracy, and both averages.

    A ratio over no rows is 0.
    """

    def share(part: Column, whole: Column) -> Column:
        return F.coalesce(ratio(part, whole), F.lit(0.0))

    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    total = tn + fp + fn + tp

    def scores(hit: Column, false_alarm: Column, missed: Column) -> list[Column]:
        return [
            share(hit, hit + false_alarm),
            share(hit, hit + missed),
            share(hit * 2, hit * 2 + false_alarm + missed),
        ]

    negative, positive = scores(tn, fn, fp), scores(tp, fp, fn)
    n0, n1 = tn + fp, fn + tp
    macro = [(a + b) / 2 for a, b in zip(negative, positive)]
    weighted = [share(a * n0 + b * n1, total) for a, b in zip(negative, positive)]
    accuracy = [share(tn + tp, total)] * 3

    def line(name: str, values: list[Column], support: Column) -> Column:
        columns = zip(("precision", "recall", "f1_score"), values)
        return F.struct(
            F.lit(name).alias("class_name"),
            *[v.alias(c) for c, v in columns],
            support.alias("support"),
        )

    lines = [
        line(names[0], negative, n0),
        line(names[1], positive, n1),
        line("accuracy", accuracy, total),
        line("macro avg", macro, total),
        line("weighted avg", weighted, total),
    ]
    return _cells(df, label, prediction).select(F.inline(F.array(*lines)))


def auc_of_scores(df: DataFrame, label: str, score: str) -> DataFrame:
    """Area under the ROC curve of any score, ties counted half; rows without a score are left out.

    Rows are first counted per score. The distinct scores are dealt out by range
    and kept, so the running count of negatives is made per range and needs one
    number from every range before it; no task sees all scores.
    """
    wide = "decimal(38,0)"
    by_score = (
        df.where(F.col(score).isNotNull())
        .groupBy(F.col(score).cast("double").alias("score"))
        .agg(
            F.count_if(F.col(label) == 1).cast(wide).alias("pos"),
            F.count_if(F.col(label) == 0).cast(wide).alias("neg"),
        )
    )
    ranges = stage(
        by_score.repartitionByRange("score").withColumn("range", F.spark_partition_id()), "scores"
    )
    earlier = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    # One row per range: as many as the session has shuffle partitions.
    starts = (
        ranges.groupBy("range")
        .agg(F.sum("neg").alias("neg"))
        .select("range", F.coalesce(F.sum("neg").over(earlier), F.lit(0)).cast(wide).alias("start"))
    )
    within = Window.partitionBy("range").orderBy("score")
    below = F.col("start") + F.sum("neg").over(within) - F.col("neg")
    twice = F.sum((F.col("pos") * (F.col("below") * 2 + F.col("neg"))).cast(wide))
    pairs = F.sum("pos").cast("double") * F.sum("neg").cast("double") * 2
    counted = ranges.join(F.broadcast(starts), "range").withColumn("below", below.cast(wide))
    return counted.agg(ratio(twice, pairs).alias("auc_roc"))
