"""Running streaming queries to the end of what is there, with idempotent outputs."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.readwriter import DataStreamWriter
from pyspark.sql.utils import AnalysisException


def finish(query: StreamingQuery) -> StreamingQuery:
    """Wait for a bounded run and raise its error, if any."""
    query.awaitTermination()
    return query


def drain(writer: DataStreamWriter, checkpoint: str) -> StreamingQuery:
    """Process everything available now, then stop; a later run on the checkpoint continues."""
    return finish(writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def batch_folder(path: str) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` sink that owns one folder per batch id.

    A batch that is run again after a crash overwrites its own folder, so nothing is doubled.
    """

    def write(df: DataFrame, batch_id: int) -> None:
        df.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return write


def read_batches(spark: SparkSession, path: str, df_schema: T.StructType) -> DataFrame:
    """Rows of all batches written so far, with their ``batch``; none before the first batch."""
    schema = T.StructType(list(df_schema.fields) + [T.StructField("batch", T.LongType())])
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def latest_update(batches: DataFrame, keys: list[str]) -> DataFrame:
    """Current value per key from the updates of all batches."""
    rest = [c for c in batches.columns if c not in (*keys, "batch")]
    newest = F.max_by(F.struct(*rest), "batch").alias("_row")
    return batches.groupBy(*keys).agg(newest).select(*keys, "_row.*")


def updated_table(stream: DataFrame, keys: list[str], path: str, checkpoint: str) -> DataFrame:
    """Drain an aggregation in update mode and return its current table."""
    drain(stream.writeStream.outputMode("update").foreachBatch(batch_folder(path)), checkpoint)
    return latest_update(read_batches(stream.sparkSession, path, stream.schema), keys)


def appended_table(stream: DataFrame, path: str, checkpoint: str, *partition_by: str) -> DataFrame:
    """Drain a stream into the file sink (exactly once) and return the table."""
    writer = stream.writeStream.outputMode("append").format("parquet").option("path", path)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    drain(writer, checkpoint)
    return stream.sparkSession.read.schema(stream.schema).parquet(path)


def run_stream(
    stream: DataFrame,
    fn: Callable[[DataFrame], DataFrame],
    path: str,
    checkpoint: str,
    every: str | None = None,
) -> StreamingQuery:
    """Apply a batch operator to each micro-batch, one folder per batch.

    With ``every`` (such as ``"10 seconds"``) the query keeps running; otherwise it drains.
    """
    sink = batch_folder(path)
    writer = stream.writeStream.foreachBatch(lambda df, batch_id: sink(fn(df), batch_id))
    if every:
        return writer.option("checkpointLocation", checkpoint).trigger(processingTime=every).start()
    return drain(writer, checkpoint)


# Delivery modes of a writer.
EXACTLY_ONCE, AT_LEAST_ONCE = "exactly_once", "at_least_once"


def deliver(stream: DataFrame, path: str, checkpoint: str, mode: str) -> StreamingQuery:
    """Write a stream with the given guarantee.

    ``exactly_once`` keys the output by batch id; ``at_least_once`` appends, so a batch repeated
    after a crash appears twice.  At-most-once is not offered: it loses records.
    """
    if mode == EXACTLY_ONCE:
        sink = batch_folder(path)
    elif mode == AT_LEAST_ONCE:

        def sink(df: DataFrame, batch_id: int) -> None:
            df.withColumn("batch", F.lit(batch_id)).write.mode("append").partitionBy("batch").parquet(path)

    else:
        raise ValueError(f"unknown delivery mode {mode!r}")
    return drain(stream.writeStream.foreachBatch(sink), checkpoint)
