"""A stored table of schema versions: what a subject's versions were, and which may follow."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logflow.operators.schemas import MODES, SCHEMA_COLUMNS, compatibility_report, subject_versions
from logflow.scratch import materialize
from logflow.versions import Versions


class IncompatibleSchema(ValueError):
    """A schema version that its subject's mode does not allow, or that differs from the stored one."""


class SchemaStore:
    """Schemas by subject and version, one row per field; a version is written once and never changes.

    A registration writes the new versions to a folder of their own and publishes the list of folders last, by
    compare-and-set: readers see all of them or none, and of two writers at once one fails and may try again.
    """

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root
        self._manifest = Versions(spark, f"{root}/_manifest")

    def _read(self, folders: list[str]) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], SCHEMA_COLUMNS)
        return self.spark.read.schema(SCHEMA_COLUMNS).parquet(*[f"{self.root}/{f}" for f in folders])

    def read(self) -> DataFrame:
        """All stored versions: SCHEMA_COLUMNS."""
        return self._read(self._manifest.latest()[1].get("folders", []))

    def versions(self) -> DataFrame:
        """Versions per subject and the latest one."""
        return subject_versions(self.read())

    def register(self, schemas: DataFrame, mode: str = "backward") -> int:
        """Store the versions that are not there yet; returns the state's number afterwards.

        A stored version may come again with the same fields (that is nothing new) but not with other ones.  Each
        change from a new version's predecessor must be allowed in ``mode``; otherwise nothing is stored.  A new
        version below a stored one is checked against both neighbours.
        """
        if mode not in MODES:
            raise ValueError(f"unknown compatibility mode {mode!r}")
        number, state = self._manifest.latest()
        stored, version = self._read(state.get("folders", [])), ["subject", "version"]
        given = materialize(schemas.select(*stored.columns), "schemas")
        known = stored.select(*version).distinct()
        again = given.join(known, version, "left_semi")
        before = stored.join(given.select(*version).distinct(), version, "left_semi")
        if not again.exceptAll(before).isEmpty() or not before.exceptAll(again).isEmpty():
            raise IncompatibleSchema("a stored version came again with other fields")
        fresh = given.join(known, version, "left_anti")
        if fresh.isEmpty():
            return number
        both = stored.unionByName(fresh)
        if mode != "none":
            after = fresh.select(*version).distinct()
            following = F.expr("lag(version) OVER (PARTITION BY subject ORDER BY version)").alias("_from")
            steps = both.select(*version).distinct().select(*version, following)
            new = after.withColumn("_new", F.lit(True))
            steps = steps.join(new, version, "left").join(
                new.select("subject", F.col("version").alias("_from"), F.col("_new").alias("_new_from")),
                ["subject", "_from"],
                "left",
            )
            touched = steps.where(F.coalesce("_new", "_new_from").isNotNull()).select(*version)
            refused = compatibility_report(both).where(~F.col(mode)).join(touched, version, "left_semi")
            if found := refused.select(*version, "field", "change").orderBy(*version, "field").take(10):
                raise IncompatibleSchema("; ".join(f"{r.subject} {r.version}: {r.change} {r.field}" for r in found))
        folder = f"data-{uuid.uuid4().hex[:12]}"
        fresh.write.parquet(f"{self.root}/{folder}")
        return self._manifest.publish(number, {"folders": [*state.get("folders", []), folder]})
