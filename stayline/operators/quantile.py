"""Exact interpolated quantiles of any numbers, without holding a column in one task.

``percentile`` keeps every distinct value in one task's memory. Here each value
is mapped to a 64-bit whole number that sorts as the values do (the bits of an IEEE
double, negated below zero), and the two ranks around the quantile are searched over
these numbers: each pass deals the range still open into at most 2^21 equal
buckets and counts rows per bucket, so a pass never returns more than 2^22 rows per
column, whatever the data, and hot values collapse before the shuffle. A bucket that
holds one value only ends the search, which on prices or scores is the first
pass.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DIGIT_BITS = 21
# Layout of IEEE doubles.
FRACTION_BITS = 52
EXPONENT_BIAS = 1023
LEAST_EXPONENT = -1022
_FRACTION = 1 << FRACTION_BITS
_INFINITE = (2 * EXPONENT_BIAS + 1) * _FRACTION
# Half of the way between 1 and the least positive double, 2**-1074.
_HALF_WAY = 2.0**537


def _power(exponent: Column) -> Column:
    """2 to a whole number: exact, as Java's pow is for whole results."""
    return F.pow(F.lit(2.0), exponent.cast("double"))


def sortable(x: Column) -> Column:
    """A whole number per double that sorts as the doubles do; NULL for NULL and NaN.

    Equal to the double's bits for positive numbers and to their negation below
    zero; both zeros give 0. Found by arithmetic on powers of two, which is
    exact: Spark has no function that reads the bits.
    """
    x = x.cast("double")
    size = F.abs(x)
    # The logarithm may miss a whole exponent by one near powers of two.
    near = F.floor(F.log2(size)).cast("int")
    exponent = F.greatest(
        F.when(_power(near) > size, near - 1).when(_power(near + 1) <= size, near + 1).otherwise(near),
        F.lit(LEAST_EXPONENT),
    )
    normal = (exponent + EXPONENT_BIAS).cast("bigint") * F.lit(_FRACTION) + (
        (size / _power(exponent) - 1) * float(_FRACTION)
    ).cast("bigint")
    below = (size * _HALF_WAY * _HALF_WAY).cast("bigint")
    bits = (
        F.when(size == float("inf"), F.lit(_INFINITE))
        .when(size < 2.0**LEAST_EXPONENT, below)
        .otherwise(normal)
    )
    return F.when(F.isnan(x), None).when(x < 0, -bits).otherwise(bits)


def unsorted(number: int) -> float:
    """The double that ``sortable`` maps to ``number``."""
    exponent, fraction = divmod(abs(number), _FRACTION)
    if exponent > 2 * EXPONENT_BIAS:
        size = float("inf")
    elif exponent == 0:
        size = fraction / _HALF_WAY / _HALF_WAY
    else:
        size = (1 + fraction / _FRACTION) * 2.0 ** (exponent - EXPONENT_BIAS)
    return -size if number < 0 else size


@dataclass
class _Search:
    """The ``rank``-th of the numbers of a column that lie between ``low`` and ``high``."""

    column: int
    rank: int
    low: int
    high: int

    @property
    def shift(self) -> int:
        """Bits within a bucket, so that the range has at most 2^DIGIT_BITS buckets."""
        return max((self.high - self.low).bit_length() - DIGIT_BITS, 0)


def _narrow(numbers: DataFrame, searches: Sequence[_Search]) -> None:
    """One pass over ``numbers`` (column, number): each search goes on in the bucket of its rank."""
    spans = sorted({(s.column, s.low, s.high, s.shift) for s in searches})
    # At most two spans per column of the table.
    open_spans = numbers.sparkSession.createDataFrame(
        [(i, *span) for i, span in enumerate(spans)], "span int, of int, low bigint, high bigint, shift int"
    )
    inside = (F.col("column") == F.col("of")) & F.col("number").between(F.col("low"), F.col("high"))
    # A span may be wider than a bigint, so it is cut at zero: no difference then overflows.
    step = F.col("number") - F.col("low")
    counts = (
        numbers.join(F.broadcast(open_spans), inside)
        .groupBy("span", F.call_function("shiftright", step, F.col("shift")).alias("bucket"))
        .agg(F.count("*").alias("rows"), F.min("number").alias("least"), F.max("number").alias("most"))
    )
    counts = counts.withColumn("upto", F.sum("rows").over(Window.partitionBy("span").orderBy("bucket")))
    before = F.col("upto") - F.col("rows")
    wanted = F.lit(False)
    for s in searches:
        here = spans.index((s.column, s.low, s.high, s.shift))
        wanted |= (F.col("span") == here) & (before <= s.rank) & (F.col("upto") > s.rank)
    # One row per search.
    found = counts.where(wanted).select("span", before.alias("before"), "upto", "least", "most").collect()
    for s in searches:
        here = spans.index((s.column, s.low, s.high, s.shift))
        row = next(r for r in found if r["span"] == here and r["before"] <= s.rank < r["upto"])
        s.rank, s.low, s.high = s.rank - row["before"], row["least"], row["most"]


def quantile_values(df: DataFrame, columns: Sequence[str], p: float) -> list[float | None]:
    """The ``p`` quantile of each column: linear, NULL and NaN skipped, None without any value.

    ``df`` is read once for the ranges and once per pass, together for all columns: pass a
    stored table. Values count as doubles.
    """
    if not 0 <= p <= 1:
        raise ValueError(f"no quantile: {p}")
    keys = [f"key{i}" for i in range(len(columns))]
    keyed = df.select(*[sortable(F.col(f"`{c}`")).alias(k) for c, k in zip(columns, keys)])
    # Negative and other numbers apart: the distance between them may pass 64 bits.
    least = [f for k in keys for f in (F.count(k), F.count_if(F.col(k) < 0), F.min(k), F.max(k))]
    near_zero = [f for k in keys for f in (F.max(F.when(F.col(k) < 0, F.col(k))), F.min(F.when(F.col(k) >= 0, F.col(k))))]
    facts = list(keyed.agg(*least, *near_zero).first())
    numbers = keyed.select(
        F.inline(F.array(*[F.struct(F.lit(i).alias("column"), F.col(k).alias("number")) for i, k in enumerate(keys)]))
    ).where(F.col("number").isNotNull())

    found: list[tuple[_Search, _Search, float] | None] = []
    for i in range(len(columns)):
        rows, below, low, high = facts[4 * i : 4 * i + 4]
        last, first = facts[4 * len(keys) + 2 * i :][:2]
        if not rows:
            found.append(None)
            continue
        place = (rows - 1) * float(p)
        sides = []
        for rank in (int(place), min(int(place) + (place > int(place)), rows - 1)):
            if rank < below:
                sides.append(_Search(i, rank, low, last))
            else:
                sides.append(_Search(i, rank - below, first, high))
        found.append((*sides, place - int(place)))

    searches = [s for f in found if f for s in f[:2]]
    while left := [s for s in searches if s.low < s.high]:
        _narrow(numbers, left)

    def value(low: _Search, high: _Search, part: float) -> float:
        a, b = unsorted(low.low), unsorted(high.low)
        return a if a == b or not part else a * (1 - part) + b * part

    return [None if f is None else value(*f) for f in found]


def quantiles(df: DataFrame, columns: Sequence[str], p: float) -> DataFrame:
    """``quantile_values`` as a table of one row, with the names of ``columns``."""
    values = quantile_values(df, columns, p)
    return df.sparkSession.range(1).select(*[F.lit(v).cast("double").alias(c) for v, c in zip(values, columns)])
