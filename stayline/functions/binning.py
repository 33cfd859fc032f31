"""Binning of a number into labelled ranges."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def cut(x: Column, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """Label of the right-closed bin ``(edges[i], edges[i + 1]]`` that holds ``x``.

    NULL outside the bins, and at the lowest edge itself.
    """
    if len(edges) != len(labels) + 1 or list(edges) != sorted(set(edges)):
        raise ValueError("edges must increase and number one more than labels")
    bins = list(zip(edges, edges[1:], labels))

    def inside(low: float, high: float) -> Column:
        return (x > low) & (x <= high)

    low, high, label = bins[0]
    return reduce(
        lambda chain, b: chain.when(inside(b[0], b[1]), F.lit(b[2])),
        bins[1:],
        F.when(inside(low, high), F.lit(label)),
    )
