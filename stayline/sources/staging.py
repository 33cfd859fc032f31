"""Intermediate tables kept on shared storage.

A staged table is computed once and read many times. It lies in the folder the
cluster names in ``spark.checkpoint.dir``, so a lost executor costs nothing but
a new read, and Parquet keeps column pruning and size statistics for the plans
that read it.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession


def checkpoint_root(spark: SparkSession) -> str:
    """Shared scratch folder of this session; also made MLlib's checkpoint folder."""
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not root:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="stayline-")
    if not context.getCheckpointDir():
        context.setCheckpointDir(root)
    return root


_batch: ContextVar[str] = ContextVar("batch", default="")


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Tables staged inside are removed at the end: write results elsewhere before."""
    name = f"batch-{uuid.uuid4().hex[:12]}"
    token = _batch.set(f"{name}/")
    try:
        yield
    finally:
        _batch.reset(token)
        folder = spark._jvm.org.apache.hadoop.fs.Path(f"{checkpoint_root(spark).rstrip('/')}/stayline/{name}")
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once and return it as a table scan."""
    spark = df.sparkSession
    run = f"{_batch.get()}{spark.sparkContext.applicationId}-{uuid.uuid4().hex[:12]}"
    path = f"{checkpoint_root(spark).rstrip('/')}/stayline/{run}/{name}"
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
