from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import functions as F

from stayline.llm import sharding
from tests.llm import brute


@pytest.mark.parametrize("n", [1, 2, 3, 5, 16, 17, 100, 1023, 5000])
def test_permutation_is_a_bijection_with_an_inverse(spark, n):
    rows = spark.range(n).select("id", sharding.permuted(F.col("id"), n, 3).alias("at"))
    got = rows.select("id", "at", sharding.original(F.col("at"), n, 3).alias("back")).collect()
    assert sorted(r["at"] for r in got) == list(range(n))
    assert all(r["id"] == r["back"] for r in got)


def test_places_are_even_gapless_and_reproducible(spark):
    rows = brute.documents()
    docs = brute.table(spark, rows)
    one = sharding.shard_documents(docs, 16).collect()
    other = sharding.shard_documents(docs.repartition(3), 16).collect()
    key = lambda r: tuple((x is not None, x or 0) for x in (r["doc_id"], r["size"], r["text_crc32"], r["shard"], r["slot"]))
    assert sorted(map(key, one)) == sorted(map(key, other))
    assert len(one) == len(rows)
    sizes = Counter(r["shard"] for r in one)
    assert max(sizes.values()) - min(sizes.values()) <= 1 and len(sizes) == 16
    for shard, n in sizes.items():
        assert sorted(r["slot"] for r in one if r["shard"] == shard) == list(range(n))
    assert Counter((r["doc_id"], r["size"]) for r in one) == Counter((d, len((t or "").encode()) + 1) for d, t in rows)
    assert sharding.shard_documents(docs.filter("false"), 16).count() == 0


def test_row_at_a_place_is_computed(spark):
    df = spark.range(57).withColumn("slot", F.lit("x"))
    placed = sharding.shard_rows(df, [F.col("id")], 4, seed=9)
    back = placed.withColumn("found", sharding.row_at(F.col("shard"), F.col("slot"), 57, 4, 9)).collect()
    assert all(r["found"] == r["row_number"] == r["id"] for r in back)
