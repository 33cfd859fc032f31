"""Timestamp helpers. All timestamps are TIMESTAMP_NTZ, so no session zone enters."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accepted text: year first or day first, dashes or slashes, one or two digits for day, month
# and hour, a blank or T before the time, fractions of a second, a zone.
_TIME = r"(?:[ T](\d{1,2}):(\d{2})(?::(\d{2})(\.\d{1,9})?)?)? ?(Z|[+-]\d{2}:?\d{2})?$"
YEAR_FIRST_TEXT = r"^(\d{4})[-/](\d{1,2})[-/](\d{1,2})" + _TIME
DAY_FIRST_TEXT = r"^(\d{1,2})[-/](\d{1,2})[-/](\d{4})" + _TIME
# The layout of CSV output, which the cast reads as it stands.
PLAIN_TEXT = r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}\z"
# Fixed value: the layout of timestamps in CSV output.
OUTPUT_TEXT = "yyyy-MM-dd HH:mm:ss"

SECONDS_IN = {"DAY": 86_400, "HOUR": 3_600, "MINUTE": 60, "SECOND": 1}


def parse_date_text(text: Column) -> Column:
    """Timestamp from year-first or day-first text; text that names no moment gives NULL.

    A time with a zone is moved to UTC; digits beyond microseconds are cut.
    """
    text = F.trim(text)

    def read(pattern: str, year: int, month: int, day: int) -> Column:
        def part(group: int) -> Column:
            return F.regexp_extract(text, pattern, group)

        def two(group: int) -> Column:
            return F.lpad(part(group), 2, "0")

        moment = F.concat(
            part(year), F.lit("-"), two(month), F.lit("-"), two(day), F.lit(" "), two(4), F.lit(":"),
            F.lpad(part(5), 2, "0"), F.lit(":"), two(6), F.substring(part(7), 1, 7),
        )
        zone = F.regexp_replace(part(8), ":", "")
        sign = F.when(F.substring(zone, 1, 1) == "-", -1).otherwise(1)
        minutes = F.when(
            F.length(zone) == 5,
            sign * (F.substring(zone, 2, 2).cast("int") * 60 + F.substring(zone, 4, 2).cast("int")),
        ).otherwise(0)
        return moment.try_cast("timestamp_ntz") - F.make_dt_interval(mins=minutes)

    # Most texts have the plain layout; they need one match instead of one per part.
    return (
        F.when(text.rlike(PLAIN_TEXT), text.try_cast("timestamp_ntz"))
        .when(text.rlike(YEAR_FIRST_TEXT), read(YEAR_FIRST_TEXT, 1, 2, 3))
        .when(text.rlike(DAY_FIRST_TEXT), read(DAY_FIRST_TEXT, 3, 2, 1))
    )


def to_date_text(ts: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss``; ``date_format`` would go through the session zone."""
    return F.substring(ts.cast("string"), 1, 19)


def month_of(ts: Column) -> Column:
    return F.substring(ts.cast("string"), 1, 7)


def moment(at: datetime) -> Column:
    """A literal; passing the datetime itself would go through two time zones."""
    return F.lit(at.isoformat(sep=" ")).cast("timestamp_ntz")


def days_between(start: Column, end: Column) -> Column:
    """Days from ``start`` to ``end`` with their fraction, negative if reversed.

    From the interval's parts: ``timestamp_diff`` would go through the session
    zone and lose an hour where its clocks change.
    """
    gap = end - start
    parts = [F.extract(F.lit(unit), gap) * seconds for unit, seconds in SECONDS_IN.items()]
    return sum(parts[1:], parts[0]).cast("double") / float(SECONDS_IN["DAY"])
