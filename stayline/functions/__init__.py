"""Column expressions shared by the plans."""

from stayline.functions.binning import cut
from stayline.functions.dates import days_between, moment, month_of, parse_date_text, to_date_text
from stayline.functions.numbers import fixed, half_up, ratio

__all__ = [
    "cut",
    "days_between",
    "fixed",
    "half_up",
    "moment",
    "month_of",
    "parse_date_text",
    "ratio",
    "to_date_text",
]
