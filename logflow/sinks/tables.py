"""A table keyed by id that streams and batches upsert into."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logflow.versions import Versions


def newest(rows: DataFrame, keys: list[str], version: list[str]) -> DataFrame:
    """One row per key, the one of the highest version."""
    rest = [c for c in rows.columns if c not in keys]
    row = F.max_by(F.struct(*rest), F.struct(*version)).alias("_row")
    return rows.groupBy(*keys).agg(row).select(*keys, "_row.*").select(*rows.columns)


class KeyedTable:
    """Rows by key in hash buckets, replaced version by version.

    A manifest names the folder of each bucket.  An upsert reads and rewrites only the buckets of its keys, into new
    folders, and publishes the next manifest last: readers see all of it or nothing, also when the writer dies.  The
    manifest also keeps each writer's last batch id, so a batch that is run again changes nothing.  Of rows with one
    key the highest ``version`` wins, whatever the order of arrival.
    """

    def __init__(
        self, spark: SparkSession, root: str, schema: T.StructType | str, keys: list[str], version: list[str], buckets: int = 64
    ) -> None:
        self.spark, self.root, self.keys, self.version = spark, root, keys, version
        self.schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
        self._manifest = Versions(spark, f"{root}/_manifest")
        self._buckets = buckets

    def _state(self) -> tuple[int, dict]:
        number, state = self._manifest.latest()
        return number, state or {"buckets": self._buckets, "folders": {}, "batches": {}}

    def _bucket(self, buckets: int) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(buckets)).cast("int")

    def _read(self, folders: list[str]) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*[f"{self.root}/{f}" for f in folders])

    def read(self) -> DataFrame:
        """The rows of the newest version."""
        return self._read(list(self._state()[1]["folders"].values()))

    def upsert(self, rows: DataFrame, batch_id: int | None = None, writer: str = "") -> int:
        """Insert or overwrite by key; returns the version in force afterwards.

        With ``batch_id``, batches of one ``writer`` that are not newer than its last one are left out.
        """
        number, state = self._state()
        if batch_id is not None and batch_id <= state["batches"].get(writer, -1):
            return number
        buckets, folders, batches = state["buckets"], dict(state["folders"]), dict(state["batches"])
        bucketed = newest(rows.select(*self.schema.names), self.keys, self.version)
        bucketed = bucketed.withColumn("_bucket", self._bucket(buckets))
        touched = sorted(r[0] for r in bucketed.select("_bucket").distinct().collect())  # at most all buckets
        if touched:
            old = self._read([folders[str(b)] for b in touched if str(b) in folders])
            merged = newest(old.unionByName(bucketed.drop("_bucket")), self.keys, self.version)
            folder = f"data-{uuid.uuid4().hex[:12]}"
            merged = merged.withColumn("_bucket", self._bucket(buckets)).hint("rebalance", "_bucket")
            merged.write.partitionBy("_bucket").parquet(f"{self.root}/{folder}")
            folders |= {str(b): f"{folder}/_bucket={b}" for b in touched}
        if batch_id is not None:
            batches[writer] = batch_id
        return self._manifest.publish(number, {"buckets": buckets, "folders": folders, "batches": batches})

    def sink(self, writer: str = ""):
        """A ``foreachBatch`` function that upserts each micro-batch once."""

        def write(df: DataFrame, batch_id: int) -> None:
            self.upsert(df, batch_id, writer)

        return write
