"""Run queries in Spark and their SQL in DuckDB and compare all rows.

    python -m checks.compare [FOLDER [QUERY ...]]
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
import pandas as pd
from pyspark.sql import SparkSession

from checks.oracle import ORACLE
from checks.queries import QUERIES
from stayline.session import build_session

LOCAL = {
    "spark.master": "local[8]",
    "spark.driver.memory": "8g",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.shuffle.partitions": "8",
}


def oracle_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"create view {file.stem} as select * from read_parquet('{file}')")
    return con


def _sorted(frame: pd.DataFrame) -> pd.DataFrame:
    frame = frame[sorted(frame.columns)]
    return frame.sort_values(list(frame.columns), ignore_index=True)


def mismatch(spark_rows: pd.DataFrame, oracle_rows: pd.DataFrame) -> str | None:
    """What differs, or None. Values must be equal, floats to the last bit."""
    ours, theirs = _sorted(spark_rows), _sorted(oracle_rows)
    if list(ours.columns) != list(theirs.columns):
        return f"columns {list(ours.columns)} != {list(theirs.columns)}"
    if len(ours) != len(theirs):
        return f"{len(ours)} rows != {len(theirs)}"
    for name in ours.columns:
        a, b = ours[name], theirs[name]
        if pd.api.types.is_numeric_dtype(a) != pd.api.types.is_numeric_dtype(b):
            return f"{name}: {a.dtype} != {b.dtype}"
        wrong = ~((a == b) | (a.isna() & b.isna()))
        if wrong.any():
            i = wrong.idxmax()
            return f"{name}: {wrong.sum()} values differ, first {a[i]!r} != {b[i]!r}"
        # A whole-number column with gaps becomes float on one side only.
        if str(a.dtype).lower() != str(b.dtype).lower() and not a.isna().any() and len(a):
            if not {str(a.dtype), str(b.dtype)} <= {"object", "str", "string"}:
                return f"{name}: type {a.dtype} != {b.dtype}"
    return None


def check(spark: SparkSession, name: str, sf_dir: str) -> tuple[str, int, float]:
    """Verdict, Spark rows and Spark seconds of one query."""
    start = time.time()
    rows = QUERIES[name](spark, sf_dir).toPandas()
    seconds = time.time() - start
    if name not in ORACLE:
        return "rows only", len(rows), seconds
    with oracle_connection(sf_dir) as con:
        return mismatch(rows, con.execute(ORACLE[name]).df()) or "equal", len(rows), seconds


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("checks", **LOCAL)
    spark.sparkContext.setLogLevel("ERROR")
    for name in sys.argv[2:] or QUERIES:
        verdict, rows, seconds = check(spark, name, sf_dir)
        print(f"{name:28s} {seconds:6.2f}s {rows:7d} rows  {verdict}", flush=True)


if __name__ == "__main__":
    main()
