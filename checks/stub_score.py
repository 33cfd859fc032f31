"""A stand-in for the model's score that SQL can compute too.

For checks only: half the share of late deliveries, half a hash of the id. The
real score comes from ``stayline.plans.churn``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayline.plans.churn import risk_segment


def add_stub_score(features: DataFrame) -> DataFrame:
    hashed = F.conv(F.substring(F.md5("customer_unique_id"), 1, 4), 16, 10).cast("int") % 1001
    tenths = F.col("late_delivery_pct").cast("decimal(18,2)") * 10 + hashed
    score = F.round(tenths / 20, 1).cast("double")
    return features.withColumn("churn_risk_score", score).withColumn(
        "risk_segment", risk_segment(F.col("churn_risk_score"))
    )


def add_stub_prediction(scored: DataFrame) -> DataFrame:
    return scored.withColumn("predicted", (F.col("churn_risk_score") >= 50).cast("int"))
