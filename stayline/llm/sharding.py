"""A reproducible shuffle into shards: a Feistel permutation with cycle walking.

Row number x of N becomes position p(x); its shard is p mod shards and its slot
p div shards, so shard sizes differ by one row at most, and both the place of a
row and the row at a place can be computed without a lookup.

The permutation works on a grid of a x b cells with a = ceil(sqrt(N)) and
b = ceil(N / a), so fewer than a cells lie outside [0, N). A value that lands
there is permuted again until it is inside (cycle walking).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayline.llm.rows import numbered

ROUNDS = 6
#: Steps of a walk before the query stops with an error. With N rows a step lands outside
#: with a chance below 1 / sqrt(N), and a walk is never longer than sqrt(N).
WALK = 64


def _grid(n: int) -> tuple[int, int]:
    a = max(1, math.isqrt(max(n - 1, 0)) + 1)
    return a, max(1, -(-n // a))


def _noise(seed: int, turn: int, x: Column, size: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(seed), F.lit(turn), x), F.lit(size))


def _once(x: Column, n: int, seed: int, back: bool) -> Column:
    a, b = _grid(n)
    right = F.pmod(x, F.lit(b))
    left = F.call_function("div", x - right, F.lit(b).cast("long"))
    sign = -1 if back else 1
    for turn in reversed(range(ROUNDS)) if back else range(ROUNDS):
        if turn % 2 == 0:
            left = F.pmod(left + sign * _noise(seed, turn, right, a), F.lit(a))
        else:
            right = F.pmod(right + sign * _noise(seed, turn, left, b), F.lit(b))
    return left * F.lit(b) + right


def _walk(x: Column, n: int, seed: int, back: bool) -> Column:
    a, b = _grid(n)
    out = _once(x.cast("long"), n, seed, back)
    if a * b == n:
        return out
    steps = F.sequence(F.lit(1), F.lit(min(WALK, a * b - n)))
    out = F.when(out < n, out).otherwise(
        F.aggregate(
            steps, out, lambda at, _: F.when(at < n, at).otherwise(_once(at, n, seed, back))
        )
    )
    return F.when(out < n, out).otherwise(F.raise_error(F.lit("cycle walk too long")).cast("long"))


def permuted(row: Column, n: int, seed: int = 0) -> Column:
    """Position of row number ``row`` among ``n``: a bijection on 0 .. n - 1."""
    return _walk(row, n, seed, False)


def original(position: Column, n: int, seed: int = 0) -> Column:
    """The row number that ``permuted`` sends to ``position``."""
    return _walk(position, n, seed, True)


def shard_rows(
    df: DataFrame, keys: list[Column], shards: int, seed: int = 0
) -> DataFrame:
    """``df`` with row_number, shard and slot.

    Rows are numbered in the order of ``keys`` (nulls first); the same rows,
    keys, seed and shard count always give the same places, rows equal in all
    keys being interchangeable. An empty table gives an empty result. Columns of
    those names in ``df`` are replaced.
    """
    ids = numbered(df.drop("row_number", "shard", "slot"), keys)
    n = ids.count()
    at = permuted(F.col("row_number"), max(n, 1), seed)
    return (
        ids.withColumn("_at", at)
        .withColumn("shard", F.pmod("_at", F.lit(shards)).cast("int"))
        .withColumn("slot", F.call_function("div", F.col("_at"), F.lit(shards).cast("long")))
        .drop("_at")
    )


def row_at(shard: Column, slot: Column, n: int, shards: int, seed: int = 0) -> Column:
    """Row number that lies at (shard, slot)."""
    return original(slot.cast("long") * shards + shard, n, seed)


def shard_documents(docs: DataFrame, shards: int, seed: int = 0) -> DataFrame:
    """doc_id, size, text_crc32, shard and slot of each document.

    ``size`` is the UTF-8 length plus 1 and a null text counts as empty. Rows
    are numbered by id, then checksum and size, so the order of the input files
    does not matter; repeated rows each get a place of their own.
    """
    raw = F.encode(F.coalesce(F.col("text"), F.lit("")), "UTF-8")
    small = docs.select(
        "doc_id",
        (F.octet_length(raw) + 1).cast("long").alias("size"),
        F.crc32(raw).alias("text_crc32"),
    )
    keys = [F.col("doc_id"), F.col("text_crc32"), F.col("size")]
    return shard_rows(small, keys, shards, seed)
