"""Tables stored in buckets of one key, so that joins and aggregates on it need no shuffle.

Spark keeps the bucket layout in its catalog, not in the files: every table here is an
external one with a name of its own, registered for the session's time. Its files stay
when the name is dropped, and can be registered again by a later run.

A table consists of deliveries, one partition each, numbered from 0. A later delivery holds
all rows of the keys that it changes. Partitions of earlier stores are read where they lie: a
store writes its own delivery only, and hides the changed keys of the earlier ones by an
anti-join that needs no shuffle either.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stayline.sources.publish import Folder

DELIVERY = "delivery"
CHANGED = "changed_keys"


class BucketStore:
    """Tables below ``path``, hashed by ``key`` into ``buckets`` files, each sorted by it.

    A table that an earlier run has written to its end is taken as it is. A store of ``delivery`` 1
    or more goes on from the one at the path ``earlier`` (with the same buckets); ``changed`` then
    gives the keys of which this delivery holds all rows.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        key: str,
        buckets: int,
        delivery: int = 0,
        earlier: str | None = None,
        changed: Callable[[], DataFrame] | None = None,
    ):
        if not (delivery > 0) == (earlier is not None) == (changed is not None):
            raise ValueError("a later delivery needs the earlier store and the changed keys, and only such a one")
        self.spark, self.key, self.buckets, self.delivery = spark, key, buckets, delivery
        self.folder = Folder(spark, path)
        self.earlier = Folder(spark, earlier) if earlier else None
        self._changed = changed
        self._names: dict[str, str] = {}

    def keep(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        """The table ``name``; this delivery's rows are written from ``build()`` if they are not there yet."""
        rows = self._table(name, build)
        if self.delivery == 0:
            return rows.drop(DELIVERY)
        changes = self._table(CHANGED, lambda: self._changed().select(self.key).distinct())
        later = changes.select(F.col(self.key).alias("_key"), F.col(DELIVERY).alias("_delivery"))
        hidden = (F.col(self.key) == F.col("_key")) & (F.col(DELIVERY) < F.col("_delivery"))
        return rows.join(later, hidden, "left_anti").drop(DELIVERY)

    def _table(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        if name not in self._names:
            made = self.folder.read(f"{name}.json")
            if made is None:
                made = self._write(name, build())
            self._register(name, made)
        return self.spark.table(self._names[name])

    def _write(self, name: str, df: DataFrame) -> dict:
        before = self.earlier.read(f"{name}.json") if self.earlier else None
        parts, number = before["parts"] if before else {}, self.delivery
        self.folder.delete(name)
        table = f"stayline_{uuid.uuid4().hex}"
        # One task per bucket, so one file per bucket.
        (
            df.withColumn(DELIVERY, F.lit(number))
            .repartition(self.buckets, self.key)
            .write.partitionBy(DELIVERY)
            .bucketBy(self.buckets, self.key)
            .sortBy(self.key)
            .format("parquet")
            .option("compression", "zstd")
            .option("path", f"{self.folder.path}/{name}")
            .saveAsTable(table)
        )
        self.spark.sql(f"DROP TABLE {table}")
        # Without rows there is no folder.
        own = {str(number): f"{self.folder.path}/{name}/{DELIVERY}={number}"}
        parts = {**parts, **(own if self.folder.names(f"{name}/{DELIVERY}={number}") else {})}
        made = {"key": self.key, "buckets": self.buckets, "schema": df.schema.jsonValue(), "parts": parts}
        self.folder.create(f"{name}.json", made, replace=True)
        return made

    def _register(self, name: str, made: dict) -> None:
        table = f"stayline_{uuid.uuid4().hex}"
        columns = ", ".join(
            f"`{f.name}` {f.dataType.simpleString()}" for f in T.StructType.fromJson(made["schema"]).fields
        )
        self.spark.sql(
            f"CREATE TABLE {table} ({columns}, {DELIVERY} int) USING parquet PARTITIONED BY ({DELIVERY})"
            f" CLUSTERED BY (`{made['key']}`) SORTED BY (`{made['key']}`) INTO {made['buckets']} BUCKETS"
            f" LOCATION '{self.folder.path}/{name}'"
        )
        self._names[name] = table
        for number, path in made["parts"].items():
            self.spark.sql(f"ALTER TABLE {table} ADD PARTITION ({DELIVERY} = {number}) LOCATION '{path}'")

    def close(self) -> None:
        """Forget the names; the files stay."""
        for table in self._names.values():
            self.spark.sql(f"DROP TABLE IF EXISTS {table}")
        self._names.clear()
