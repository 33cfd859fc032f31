"""Names for columns that an operator adds on the way, beside whatever columns the caller has."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def unused(df: DataFrame, name: str) -> str:
    """``name``, or with underscores before it as long as a column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def aside(df: DataFrame, kept: Sequence[str], needed: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """Only ``needed`` and ``kept`` of ``df``, the latter under names that no operator uses, and these names.

    Operators then join and group tables whose columns are all their own. A needed column is not
    sent twice: it keeps its name.
    """
    names = [c if c in needed else f"_kept_{i}" for i, c in enumerate(kept)]
    own = [F.col(f"`{c}`").alias(n) for c, n in zip(kept, names) if n not in needed]
    return df.select(*[F.col(f"`{c}`") for c in needed], *own), names


def back(kept: Sequence[str], names: Sequence[str]) -> list[Column]:
    """The kept columns under the names they had."""
    return [F.col(f"`{n}`").alias(c) for c, n in zip(kept, names)]
