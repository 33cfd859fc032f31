"""Arrays kept as files on the storage that all executors share."""

from __future__ import annotations

import uuid
from collections import OrderedDict
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayline.sources.staging import checkpoint_root, stage


def save(folder: str, parts: list[np.ndarray]) -> str:
    """Write the arrays one after the other to a new file below ``folder``; return its path.

    A task that is run again writes another file, so a reader that goes by the
    returned path never meets a half-written one.
    """
    store, root = fs.FileSystem.from_uri(folder)
    store.create_dir(root, recursive=True)
    name = uuid.uuid4().hex
    with store.open_output_stream(f"{root}/{name}", compression=None) as out:
        for part in parts:
            out.write(np.ascontiguousarray(part).data)
    return f"{folder}/{name}"


def load(path: str) -> np.ndarray:
    """The bytes of a file: mapped where the store is a mounted folder, else read."""
    store, at = fs.FileSystem.from_uri(path)
    if isinstance(store, fs.LocalFileSystem):
        return np.memmap(at, np.uint8, "r")
    with store.open_input_file(at) as source:
        return np.frombuffer(source.read(), np.uint8)


class Shelf:
    """The files a worker has open, at most ``most`` of them."""

    def __init__(self, most: int = 4096):
        self.most, self.open = most, OrderedDict()

    def get(self, path: str) -> np.ndarray:
        if path not in self.open:
            while len(self.open) >= self.most:
                self.open.popitem(last=False)
            self.open[path] = load(path)
        return self.open[path]


@dataclass
class KeyFiles:
    """Distinct 64-bit keys as one sorted file per bucket."""

    buckets: int
    places: dict[int, tuple[str, int]]

    def held(self, keys: np.ndarray, shelf: Shelf) -> np.ndarray:
        """Whether each key is in the files."""
        out = np.zeros(len(keys), bool)
        bucket = keys % self.buckets
        for b in np.unique(bucket).tolist():
            if b in self.places:
                path, n = self.places[b]
                stored = shelf.get(path)[: 8 * n].view(np.int64)
                at = np.flatnonzero(bucket == b)
                found = np.minimum(np.searchsorted(stored, keys[at]), n - 1)
                out[at] = stored[found] == keys[at]
        return out


def key_files(keys: DataFrame, column: str) -> KeyFiles:
    """Write the distinct values of a long column; one small file per shuffle partition."""
    spark = keys.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    folder = f"{checkpoint_root(spark).rstrip('/')}/keys-{uuid.uuid4().hex[:12]}"

    def write(table: pa.Table) -> pa.Table:
        found = np.unique(table.column("key").to_numpy())
        return pa.table(
            [table.column("bucket").slice(0, 1), pa.array([save(folder, [found])]), pa.array([len(found)])],
            ["bucket", "path", "size"],
        )

    bucket = F.pmod(F.col(column), F.lit(buckets)).cast("int").alias("bucket")
    rows = keys.select(F.col(column).alias("key"), bucket).distinct()
    written = stage(rows.groupBy("bucket").applyInArrow(write, "bucket int, path string, size long"), "key_files")
    return KeyFiles(buckets, {r["bucket"]: (r["path"], r["size"]) for r in written.collect()})
