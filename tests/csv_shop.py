"""Write a small shop as the nine CSV files."""

from __future__ import annotations

import csv
from datetime import datetime
from pathlib import Path

from stayline.sources.tables import CSV_FILES
from tests.shops import SCHEMAS, Rows

EXTRA = {
    "sellers": ("seller_id", [("s1",), ("s2",)]),
    "geolocation": ("geolocation_city,geolocation_state", [("city1", "st1")]),
}


def _names(table: str) -> list[str]:
    if table in EXTRA:
        return EXTRA[table][0].split(",")
    return [c.split(" ")[0] for c in SCHEMAS[table].replace("(18,2)", "").split(", ")]


def _text(value, day_first: bool) -> str:
    if value is None:
        return ""
    if isinstance(value, datetime):
        return value.strftime("%d-%m-%Y %H:%M:%S" if day_first else "%Y-%m-%d %H:%M:%S")
    return str(value)


def write_csv_shop(rows: Rows, folder: Path) -> None:
    """Dates alternate between both layouts."""
    folder.mkdir(parents=True)
    for table, file in CSV_FILES.items():
        body = EXTRA[table][1] if table in EXTRA else rows[table]
        with open(folder / file, "w", newline="") as out:
            writer = csv.writer(out)
            writer.writerow(_names(table))
            writer.writerows([_text(v, i % 2 == 1) for v in row] for i, row in enumerate(body))
