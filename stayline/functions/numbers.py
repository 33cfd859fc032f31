"""Rounding, ratios and fixed-point text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def half_up(x: Column, digits: int) -> Column:
    """Round to ``digits`` decimals, ties away from zero, as a double.

    The detour over a decimal makes 1.005 round to 1.01: a plain double round
    depends on how the engine prints the double.
    """
    return F.round(x.cast("decimal(38,9)"), digits).cast("double")


def ratio(total: Column, rows: Column) -> Column:
    """``total / rows`` as a double, NULL over no rows (ANSI mode would raise)."""
    return total.cast("double") / F.nullif(rows.cast("double"), F.lit(0.0))


def fixed(x: Column, digits: int) -> Column:
    """Text of a double with ``digits`` decimals, rounded on its exact binary value.

    ``format_string`` alone rounds the printed decimal half up (4.35 -> "4.4"),
    while the binary double is slightly below 4.35 and must give "4.3". Ties
    that are exact in binary go to the even digit (2.5 -> "2").
    """
    x = x.cast("double")
    if digits == 0:
        return F.format_string("%.0f", F.rint(x))
    if digits == 1:
        # 10x = 2 * (4x + x). 4x and the doubling are exact, so the only error
        # is that of the sum; it is recovered exactly and settles ties.
        quad = x * 4
        five = quad + x
        lost = (quad - (five - (five - quad))) + (x - (five - quad))
        tenfold = five * 2
        below = F.floor(tenfold).cast("double")
        tenths = (
            F.when(tenfold - below != 0.5, F.rint(tenfold))
            .when(lost > 0, below + 1)
            .when(lost < 0, below)
            .otherwise(F.rint(tenfold))
        )
        return F.format_string("%.1f", tenths / 10)
    # Only used on amounts that already carry ``digits`` decimals.
    return F.format_string(f"%.{digits}f", x)
