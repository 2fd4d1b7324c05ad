"""Reading logs: by topic, pattern, partition, offset, committed position, and as a stream.

A log store is a Parquet folder laid out as ``topic=<t>/partition=<p>/slice=<s>/``, a slice being a range of
LOG_SLICE offsets.  Topic and partition conditions prune folders, starting positions of many partitions prune each
partition's own slices, and offset conditions reach the Parquet row-group filter.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logflow.operators.slices import SLICE_WIDTH, rank_by
from logflow.records import RECORD_SCHEMA
from logflow.scratch import folder_bytes, materialize
from logflow.versions import Versions


#: Offsets per slice folder of a log partition.
LOG_SLICE = 1 << 20


def slice_number(offset: str = "offset") -> Column:
    return F.expr(f"{offset} div {LOG_SLICE}")


def slice_name(number: Column) -> Column:
    """Folder name of a slice.  It names topic and partition, too: joins prune by one column at a time, and a number
    alone would select the slices that any partition needs."""
    return F.concat_ws("-", "topic", F.col("partition").cast("string"), number.cast("string"))


def with_extras(extras: str | None = None) -> T.StructType:
    """The record schema plus extra columns given as DDL, and the slice folder."""
    more = T.StructType.fromDDL(extras).fields if extras else []
    return T.StructType(RECORD_SCHEMA.fields + more + [T.StructField("slice", T.StringType())])


def read_log(spark: SparkSession, root: str, extras: str | None = None) -> DataFrame:
    return spark.read.schema(with_extras(extras)).parquet(root)


def topic_matches(pattern: str) -> Column:
    """The whole topic name matches the regular expression."""
    return F.col("topic").rlike(f"^(?:{pattern})$")


def scan(
    spark: SparkSession,
    root: str,
    topics: list[str] | None = None,
    pattern: str | None = None,
    partitions: list[int] | None = None,
    extras: str | None = None,
) -> DataFrame:
    """Records of the listed or matching topics.  Folders are listed per read, so new topics join."""
    log = read_log(spark, root, extras)
    if topics is not None:
        log = log.where(F.col("topic").isin(topics))
    if pattern is not None:
        log = log.where(topic_matches(pattern))
    if partitions is not None:
        log = log.where(F.col("partition").isin(partitions))
    return log


def seek(log: DataFrame, partition: int, offset: int) -> DataFrame:
    return log.where((F.col("partition") == partition) & (F.col("offset") >= offset))


def bounds(log: DataFrame) -> DataFrame:
    """First offset and end offset (the next one to be written) per topic and partition."""
    return log.groupBy("topic", "partition").agg(
        F.min("offset").alias("begin_offset"), (F.max("offset") + 1).alias("end_offset")
    )


def _sized(positions: DataFrame) -> DataFrame:
    """Positions as a written table, so that Spark's broadcast decision sees their true size."""
    return materialize(positions, "positions")


def newest_commits(commits: DataFrame) -> DataFrame:
    """The commit in force per (group, topic, partition): the last one made, by ``sequence`` (or ``updated_at``).

    It may lie before an earlier one, where a group was set back.  A table with neither column has one commit each.
    """
    made = [c for c in ("sequence", "updated_at") if c in commits.columns]
    key = ["consumer_group", "topic", "partition"]
    rest = F.struct(*[c for c in commits.columns if c not in key])
    # Equal times go to the larger offset, so that reruns agree.
    newest = F.max_by(rest, F.struct(*made, "offset")).alias("_row")
    return commits.groupBy(*key).agg(newest).select(*key, "_row.*").select(*commits.columns)


def end_index(spark: SparkSession, root: str) -> Versions:
    """The store's index: the end offset of every partition, published by writers before they write."""
    return Versions(spark, f"{root}/_ends")


def store_bounds(spark: SparkSession, root: str) -> DataFrame:
    """First and end offset per topic and partition from the store's own index: reads no record."""
    rows = [(topic, int(p), 0, int(end)) for topic, p, end in end_index(spark, root).latest()[1].get("ends", [])]
    return spark.createDataFrame(rows, "topic STRING, partition INT, begin_offset BIGINT, end_offset BIGINT")


def from_positions(log: DataFrame, positions: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """Records at or after ``start`` of their (topic, partition), the smallest of several.

    With ``known`` bounds of a stored log it is read by slices: each partition's own slices from its start to its
    known end are joined to the slice folders, so a partition that starts early does not make the others read more.
    The bounds must be as new as the log: slices that begin after a known end are not read.
    """
    wanted = positions.groupBy("topic", "partition").agg(F.min("start").alias("_start"))
    keys = ["topic", "partition"]
    by_slice = known is not None and "slice" in log.columns and not log.isStreaming
    if by_slice:
        ends = known.select("topic", "partition", F.col("end_offset").alias("_end"))
        wanted = wanted.join(ends, keys)
    wanted = _sized(wanted)
    if by_slice:
        numbers = F.sequence(slice_number("_start"), slice_number("(_end - 1)"))
        wanted = wanted.where("_start < _end").withColumn("_number", F.explode(numbers))
        wanted = wanted.withColumn("slice", slice_name(F.col("_number"))).drop("_end", "_number")
        keys.append("slice")
    joined = log.join(wanted, keys).where(F.col("offset") >= F.col("_start"))
    return joined.select(*log.columns)


def with_position(df: DataFrame, positions: DataFrame, column: str, out: str) -> DataFrame:
    """Add a per-(topic, partition) number to every record, the largest of several."""
    known = _sized(positions.groupBy("topic", "partition").agg(F.max(column).alias(out)))
    return df.join(known, ["topic", "partition"], "left").select(*df.columns, out)


def seek_beginning(log: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """Everything from the first offset on; ``known`` bounds (``store_bounds``) save reading them off the log."""
    known = bounds(log) if known is None else known
    return from_positions(log, known.withColumn("start", F.col("begin_offset")), known)


def seek_end(log: DataFrame, known: DataFrame | None = None) -> DataFrame:
    known = bounds(log) if known is None else known
    return from_positions(log, known.withColumn("start", F.col("end_offset")), known)


def group_positions(
    known: DataFrame, commits: DataFrame, subscriptions: list[tuple[str, str]], ends: DataFrame | None = None
) -> DataFrame:
    """Where consumer groups start on every partition of ``known`` bounds: adds consumer_group, policy and start.

    ``subscriptions`` are (group, policy).  The newest commit of a group wins, also one that set it back.  Otherwise
    ``earliest`` starts at the first record, ``latest`` at the end offset known when the group subscribed (``ends``;
    default: the end now), ``none`` fails.
    """
    asked = F.array(*[F.struct(F.lit(g).alias("consumer_group"), F.lit(p).alias("policy")) for g, p in subscriptions])
    known = known.withColumn("_latest", F.col("end_offset"))
    if ends is not None:
        ends = ends.select("topic", "partition", F.col("end_offset").alias("_subscribed"))
        known = known.join(ends, ["topic", "partition"], "left")
        known = known.withColumn("_latest", F.coalesce("_subscribed", F.lit(0).cast("bigint")))
    mine = newest_commits(commits).select("consumer_group", "topic", "partition", F.col("offset").alias("_committed"))
    asking = known.withColumn("_asked", F.explode(asked)).select("*", "_asked.*")
    failing = F.raise_error(
        F.format_string("group has no committed offset on %s-%d", F.col("topic"), F.col("partition"))
    ).cast("bigint")
    fallback = F.when(F.col("policy") == "earliest", F.col("begin_offset"))
    fallback = fallback.when(F.col("policy") == "latest", F.col("_latest")).otherwise(failing)
    start = F.when(F.col("_committed").isNotNull(), F.col("_committed")).otherwise(fallback)
    return asking.join(mine, ["consumer_group", "topic", "partition"], "left").select(
        "consumer_group", "policy", "topic", "partition", start.alias("start")
    )


def start_positions(
    log: DataFrame,
    commits: DataFrame,
    group: str,
    policy: str,
    ends: DataFrame | None = None,
    known: DataFrame | None = None,
) -> DataFrame:
    """Where one consumer group starts on every partition of the log."""
    if policy not in {"earliest", "latest", "none"}:
        raise ValueError(f"unknown reset policy {policy!r}")
    known = bounds(log) if known is None else known
    return group_positions(known, commits, [(group, policy)], ends).select("topic", "partition", "start")


def resume(
    log: DataFrame, commits: DataFrame, group: str, policy: str = "earliest", known: DataFrame | None = None
) -> DataFrame:
    """Records the group has not processed yet."""
    known = bounds(log) if known is None else known
    return from_positions(log, start_positions(log, commits, group, policy, known=known), known)


def polls(log: DataFrame, max_records: int = 500, width: int = SLICE_WIDTH) -> DataFrame:
    """Cut every partition into polls of at most ``max_records``: adds ``poll``."""
    ranked = rank_by(log, ["topic", "partition"], ["offset"], "_position", width)
    return ranked.withColumn("poll", F.expr(f"_position div {max_records}")).drop("_position")


def skip_offsets(log: DataFrame, bad: DataFrame) -> DataFrame:
    """Everything but the listed (topic, partition, offset)."""
    return log.join(bad.select("topic", "partition", "offset"), ["topic", "partition", "offset"], "left_anti")


def first_k(log: DataFrame, k: int) -> DataFrame:
    """The first ``k`` records of each partition; tasks keep only ``k`` rows before the shuffle."""
    w = Window.partitionBy("topic", "partition").orderBy("offset")
    return log.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= k).drop("_rn")


#: Bytes that one core should get of a micro-batch of a backlog, and the least number of batches of one.
BACKLOG_BYTES_PER_CORE, BACKLOG_BATCHES = 512 << 20, 4


def backlog_bytes(spark: SparkSession, root: str) -> str:
    """Bytes per micro-batch for reading what a store holds: work for every core, but several batches of any store."""
    fair = spark.sparkContext.defaultParallelism * BACKLOG_BYTES_PER_CORE
    return str(max(1, min(fair, folder_bytes(spark, root) // BACKLOG_BATCHES)))


def stream_log(
    spark: SparkSession,
    root: str,
    extras: str | None = None,
    files_per_trigger: int | None = None,
    bytes_per_trigger: str | None = None,
    topics: list[str] | None = None,
    pattern: str | None = None,
) -> DataFrame:
    """Unbounded read of a log store; new files arrive in later micro-batches, also those of topics that appear later.

    ``topics`` or a ``pattern`` for the whole topic name select topics.  Listed topics are given to the file source
    as a path pattern, so the folders of other ones are never listed; a pattern is a condition on the folder.  Names
    of listed topics are letters, digits, dots, dashes and underscores.
    """
    reader = spark.readStream.schema(with_extras(extras))
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    if bytes_per_trigger:
        reader = reader.option("maxBytesPerTrigger", bytes_per_trigger)
    if topics is not None:
        if strange := [topic for topic in topics if not re.fullmatch(r"[\w.-]+", topic, re.ASCII)]:
            raise ValueError(f"not names of topics: {strange}")
        log = reader.option("basePath", root).parquet(f"{root}/topic={{{','.join(topics)}}}")
    else:
        log = reader.parquet(root)
    return log if pattern is None else log.where(topic_matches(pattern))
