from __future__ import annotations

from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from stayline.sources import sinks, staging
from stayline.sources.tables import (
    CSV_FILES,
    NUMBER_COLUMNS,
    PLAIN_NUMBER,
    date_quality,
    date_sample,
    read_csv_folder,
    read_csv_text,
    read_parquet_folder,
    typed,
)
from tests.csv_shop import write_csv_shop
from tests.shops import random_shop


def test_csv_text_types_and_gaps(spark, tmp_path):
    path = tmp_path / "orders.csv"
    path.write_text(
        "﻿order_id,order_purchase_timestamp,price,review_score,note\n"
        'o1,2017-10-02 10:56:33,58.90,4.0,"said ""fine"", thanks"\n'
        "o2,02-10-2017 10:56,NaN,,NA\n"
        "o3,never,0.1,5,\n",
        encoding="utf-8",
    )
    rows = typed(read_csv_text(spark, str(path))).orderBy("order_id").collect()
    assert [tuple(r) for r in rows] == [
        ("o1", datetime(2017, 10, 2, 10, 56, 33), Decimal("58.90"), 4, 'said "fine", thanks'),
        ("o2", datetime(2017, 10, 2, 10, 56), None, None, None),
        ("o3", None, Decimal("0.10"), 5, None),
    ]


def test_line_breaks_inside_quotes(spark, tmp_path):
    path = tmp_path / "reviews.csv"
    path.write_text('order_id,review_score,comment\no1,5,"two\nlines"\no2,1,one\n')
    rows = typed(read_csv_text(spark, str(path), multi_line=True)).orderBy("order_id").collect()
    assert [(r.order_id, r.review_score, r.comment) for r in rows] == [
        ("o1", 5, "two\nlines"),
        ("o2", 1, "one"),
    ]


def test_plain_and_other_numbers(spark, tmp_path):
    """Plain numbers are cast as they stand, others through 38 digits: the same values and errors."""
    path = tmp_path / "items.csv"
    path.write_text("price,review_score\n12.3,7\n-0.05,-3\n1234567890123456.78,123456789\n1e2,2147483647\n 5.50 ,4.0\n.5,+2\n")
    rows = typed(read_csv_text(spark, str(path))).collect()
    assert {tuple(r) for r in rows} == {
        (Decimal("12.30"), 7), (Decimal("-0.05"), -3), (Decimal("1234567890123456.78"), 123456789),
        (Decimal("100.00"), 2147483647), (Decimal("5.50"), 4), (Decimal("0.50"), 2),
    }
    assert PLAIN_NUMBER.keys() == set(NUMBER_COLUMNS.values())
    for line in ("1.005,1", "1,1.5"):
        path.write_text(f"price,review_score\n{line}\n")
        with pytest.raises(Exception, match="needs more digits"):
            typed(read_csv_text(spark, str(path))).collect()


def test_bad_number_is_an_error(spark, tmp_path):
    path = tmp_path / "items.csv"
    path.write_text("order_id,price\no1,cheap\n")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT|cheap"):
        typed(read_csv_text(spark, str(path))).collect()


def test_date_quality_and_sample(spark):
    raw = spark.createDataFrame(
        [("o1", "2017-10-02"), ("o2", "02-11-2017 10:00"), ("o3", "soon"), ("o4", None)],
        "order_id string, order_purchase_timestamp string",
    )
    row = date_quality(raw).first()
    assert (row.total_rows, row.text_values, row.parsed_values, row.unparsed_values) == (4, 3, 2, 1)
    assert (row.first_date, row.last_date) == ("2017-10-02 00:00:00", "2017-11-02 10:00:00")
    wide = typed(raw).withColumns(
        {
            "order_delivered_customer_date": F.lit(None).cast("timestamp_ntz"),
            "order_estimated_delivery_date": F.lit(None).cast("timestamp_ntz"),
        }
    )
    assert date_sample(wide, 2).count() == 2


def test_tables_round_trip(spark, tmp_path):
    rows = random_shop(11, orders=40)
    write_csv_shop(rows, tmp_path / "csv")
    tables = read_csv_folder(spark, str(tmp_path / "csv"))
    counts = sinks.write_tables(tables.named(), str(tmp_path / "tables"))
    assert set(counts) == set(CSV_FILES)
    assert counts["orders"] == len(rows["orders"])
    stored = read_parquet_folder(spark, str(tmp_path / "tables"))
    assert {tuple(r) for r in stored.order_items.collect()} == set(rows["order_items"])
    stored.register()
    total = spark.sql("select count(*) from orders where order_status = 'delivered'").first()[0]
    assert total == sum(o[2] == "delivered" for o in rows["orders"])


def test_csv_export_counts_order_and_replace(spark, tmp_path):
    df = spark.range(100).select(
        F.concat(F.lit("m"), F.col("id")).alias("name"),
        (F.col("id") % 7).alias("revenue"),
        F.lit(None).cast("string").alias("gap"),
    )
    out = str(tmp_path / "marts")
    for _ in range(2):  # the second run replaces the first
        shapes = sinks.export_marts({"a.csv": df}, out, {"a.csv": [F.desc("revenue")]})
    assert shapes == {"a.csv": (100, 3)}
    lines = []
    for part in sorted((tmp_path / "marts" / "a.csv").glob("part-*")):
        head, *body = part.read_text().splitlines()
        assert head == "name,revenue,gap"
        lines += body
    revenues = [int(line.split(",")[1]) for line in lines]
    assert len(lines) == 100 and revenues == sorted(revenues, reverse=True)


def test_stage_uses_the_folder_the_cluster_names(spark):
    root = staging.checkpoint_root(spark)
    named = spark.conf.get("spark.checkpoint.dir", None)
    assert named is None or root == named
    assert spark.sparkContext.getCheckpointDir()
    staged = staging.stage(spark.range(10), "ten")
    assert staged.count() == 10
    assert all(f.startswith(f"file://{root}/stayline/") for f in staged.inputFiles())
