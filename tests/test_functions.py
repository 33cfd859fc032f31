from __future__ import annotations

import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from stayline.functions import dates
from stayline.functions import cut, days_between, fixed, half_up, moment, parse_date_text, ratio
from stayline.plans.churn import risk_segment
from stayline.plans.marts import HIGH_VALUE, ONE_TIME, rfm_segment, revenue_at_risk, spend_tier


def column_of(spark, values, kind, make):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    return [r[0] for r in df.orderBy("i").select(make(F.col("x"))).collect()]


def test_dates_in_both_layouts(spark):
    texts = {
        "2017-10-02 10:56:33": datetime(2017, 10, 2, 10, 56, 33),
        "2017-10-02 10:56": datetime(2017, 10, 2, 10, 56),
        "2017-10-02": datetime(2017, 10, 2),
        "02-10-2017 10:56": datetime(2017, 10, 2, 10, 56),
        "02-10-2017 10:56:33": datetime(2017, 10, 2, 10, 56, 33),
        "25-12-2017": datetime(2017, 12, 25),
        " 2017-10-02 ": datetime(2017, 10, 2),
        "2017-02-30": None,
        "31-04-2017 10:00": None,
        "10/02/2017": datetime(2017, 2, 10),
        "2017-10-02T10:56:33": datetime(2017, 10, 2, 10, 56, 33),
        "2017-10-02 10:56:33.000": datetime(2017, 10, 2, 10, 56, 33),
        "2017-10-02 10:56:33.123456789": datetime(2017, 10, 2, 10, 56, 33, 123456),
        "2017/10/02 10:56": datetime(2017, 10, 2, 10, 56),
        "02/10/2017 10:56": datetime(2017, 10, 2, 10, 56),
        "2-10-2017 9:56": datetime(2017, 10, 2, 9, 56),
        "2/1/2017": datetime(2017, 1, 2),
        "2017-10-02 10:56:33+00:00": datetime(2017, 10, 2, 10, 56, 33),
        "2017-10-02T01:00:00Z": datetime(2017, 10, 2, 1),
        "2017-10-02 01:30:00 +0200": datetime(2017, 10, 1, 23, 30),
        "2017-10-02 25:00": None,
        "10/25/2017": None,
        "soon": None,
        "": None,
        None: None,
    }
    assert column_of(spark, list(texts), "string", parse_date_text) == list(texts.values())


def test_plain_dates_need_no_match_per_part(spark, monkeypatch):
    monkeypatch.setattr(dates, "YEAR_FIRST_TEXT", "^none$")
    texts = {
        "2017-10-02 10:56:33": datetime(2017, 10, 2, 10, 56, 33),
        " 2016-02-29 00:00:00 ": datetime(2016, 2, 29),
        "2017-02-30 10:00:00": None,
        "2017-10-02 25:00:00": None,
    }
    assert column_of(spark, list(texts), "string", dates.parse_date_text) == list(texts.values())


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_days_keep_fraction_and_sign(spark, zone):
    moments = ["2018-06-02 12:00:00", "2018-09-02 12:00:00", "2018-03-01 00:00:00", None]
    df = spark.createDataFrame([(i, m) for i, m in enumerate(moments)], "i int, m string")
    gap = days_between(F.col("m").cast("timestamp_ntz"), moment(datetime(2018, 9, 1)))
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        rows = df.orderBy("i").select(gap.alias("days"), gap.cast("int").alias("whole")).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert [r.days for r in rows] == [90.5, -1.5, 184.0, None]
    assert [r.whole for r in rows] == [90, -1, 184, None]


def test_half_up_and_ratio(spark):
    values = [1.005, 0.285, 2.675, -1.005, None]
    assert column_of(spark, values, "double", lambda x: half_up(x, 2)) == [
        1.01,
        0.29,
        2.68,
        -1.01,
        None,
    ]
    assert spark.range(1).select(ratio(F.lit(1), F.lit(0))).first()[0] is None


@pytest.mark.parametrize("digits", [0, 1])
def test_fixed_prints_like_the_binary_value(spark, digits):
    r = random.Random(digits)
    values = [i / 100 for i in range(0, 1000)] + [0.125, 0.25, 2.5, 3.5, 99.95, 100.0]
    values += [r.uniform(0, 1e6) for _ in range(500)] + [r.randrange(10**8) / 20 for _ in range(500)]
    got = column_of(spark, values, "double", lambda x: fixed(x, digits))
    assert got == [f"{v:.{digits}f}" for v in values]


def test_fixed_money(spark):
    values = [0.0, 1.1, 1234567.89, 99.99]
    assert column_of(spark, values, "double", lambda x: fixed(x, 2)) == [
        f"{v:.2f}" for v in values
    ]


def test_bins_are_right_closed(spark):
    scores = [0.0, 0.1, 40.0, 40.1, 65.0, 65.1, 80.0, 80.1, 100.0, 100.1, -1.0, None]
    assert column_of(spark, scores, "double", risk_segment) == [
        None,
        "Low",
        "Low",
        "Medium",
        "Medium",
        "High",
        "High",
        "Critical",
        "Critical",
        None,
        None,
        None,
    ]
    values = [0.0, 50.0, 50.01, 150.0, 500.0, 500.01, 99999.0, 100000.0, None]
    assert column_of(spark, values, "double", spend_tier) == [
        None,
        "Low (<$50)",
        "Mid ($50-150)",
        "Mid ($50-150)",
        "High ($150-500)",
        "Premium (>$500)",
        "Premium (>$500)",
        None,
        None,
    ]


def test_bins_must_increase():
    with pytest.raises(ValueError):
        cut(F.lit(1), [0, 2, 1], ["a", "b"])
    with pytest.raises(ValueError):
        cut(F.lit(1), [0, 1], ["a", "b"])


def test_score_65_is_medium_but_at_risk(spark):
    scores = [64.9, 65.0, 100.0, None]
    risk = column_of(spark, scores, "double", lambda x: revenue_at_risk(x, F.lit(10.0)))
    assert risk == [0.0, 10.0, 10.0, 0.0]


def test_segments_in_order(spark):
    rows = [(2, 180, 1.0), (2, 181, 1.0), (1, 10, 1.0), (1, 10, 9.0), (5, 500, 9.0), (3, None, 1.0)]
    df = spark.createDataFrame(rows, "f int, r int, v double")
    got = [
        r[0]
        for r in df.select(
            rfm_segment(F.col("f"), F.col("r"), F.col("v"), F.lit(9.0))
        ).collect()
    ]
    assert got == ["Loyal Customer", "At-Risk Loyal", ONE_TIME, HIGH_VALUE, HIGH_VALUE, ONE_TIME]
