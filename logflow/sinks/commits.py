"""Committed positions of consumer groups: an append-only log, written after what was processed."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logflow.operators.offsets import commit_offsets
from logflow.sources.log import newest_commits
from logflow.versions import VersionConflict, Versions

COMMITS = "consumer_group STRING, topic STRING, partition INT, offset BIGINT, updated_at TIMESTAMP, sequence BIGINT"


class CommitLog:
    """Commits in the order in which they were made: every append has the next ``sequence``.

    The newest commit of a partition counts, also where it lies before an older one: a group that was set back
    reads again from there.
    """

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root
        self._versions = Versions(spark, f"{root}/_sequence")

    def append(self, commits: DataFrame) -> int:
        """Add commits (consumer_group, topic, partition, offset, updated_at); returns their sequence number.

        The number is taken first and the rows are written under it, so numbers never repeat; a writer that dies in
        between leaves a number without rows.
        """
        while True:
            number = self._versions.latest()[0]
            try:
                sequence = self._versions.publish(number, {})
                break
            except VersionConflict:
                continue
        columns = ["consumer_group", "topic", "partition", "offset", "updated_at"]
        rows = commits.select(*columns, F.lit(sequence).cast("bigint").alias("sequence"))
        rows.write.mode("append").parquet(f"{self.root}/commits")
        return sequence

    def read(self) -> DataFrame:
        """All commits ever made; none before the first."""
        if not self._versions.latest()[0]:
            return self.spark.createDataFrame([], COMMITS)
        return self.spark.read.schema(COMMITS).parquet(f"{self.root}/commits")

    def latest(self) -> DataFrame:
        """The commit in force per group, topic and partition."""
        return newest_commits(self.read())

    def after(self, sink: Callable[[DataFrame, int], None], group: str) -> Callable[[DataFrame, int], None]:
        """A ``foreachBatch`` sink that commits what it wrote, once it is written.

        A crash between the two repeats the batch; the sink must stand that, as those keyed by batch id do.
        """

        def write(df: DataFrame, batch_id: int) -> None:
            sink(df, batch_id)
            self.append(commit_offsets(df, group, F.current_timestamp()))

        return write
