"""Writing logs: append, transactions, dead letters, upserts and file formats."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from logflow.operators.offsets import assign_offsets
from logflow.operators.slices import SLICE_WIDTH
from logflow.records import empty_headers
from logflow.scratch import folder_bytes, materialize
from logflow.sinks.tables import newest
from logflow.sources.log import bounds, end_index, slice_name, slice_number, with_extras
from logflow.versions import VersionConflict


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a Parquet folder with at least one data file is there."""
    try:
        spark.read.parquet(path).schema
        return True
    except AnalysisException as error:  # any other error must not make offsets start again
        if error.getCondition() not in {"PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"}:
            raise
        return False


def append(
    records: DataFrame,
    root: str,
    order: list[str],
    width: int = SLICE_WIDTH,
    ends: DataFrame | None = None,
) -> None:
    """Append produced records (with ``partition`` set) to a log store; offsets continue per partition.

    The store's index hands out the offsets: a writer adds its records per partition to the end offsets and publishes
    them before it writes.  So an append reads no data file, and two writers never get the same offset: the one that
    publishes second starts again from the other's ends.  A writer that dies after publishing leaves a gap.
    ``ends`` (topic, partition, end_offset) are the least offsets to go on from.  The records are read twice, so they
    must come out the same.  Rows are clustered by partition and slice, sorted by offset.
    """
    spark = records.sparkSession
    index = end_index(spark, root)
    counts = {(r[0], r[1]): r[2] for r in records.groupBy("topic", "partition").count().collect()}
    given = {} if ends is None else {(r[0], r[1]): r[2] for r in ends.select("topic", "partition", "end_offset").collect()}
    while True:
        version, state = index.latest()
        known = {(topic, p): end for topic, p, end in state.get("ends", [])}
        if not version and ends is None and exists(spark, root):  # written by something without an index
            known = {(r[0], r[1]): r[3] for r in bounds(spark.read.schema(with_extras()).parquet(root)).collect()}
        first = {place: max(known.get(place, 0), given.get(place, 0)) for place in {*known, *given}}
        after = first | {place: first.get(place, 0) + n for place, n in counts.items()}
        try:
            index.publish(version, {"ends": sorted([*place, end] for place, end in after.items())})
            break
        except VersionConflict:
            continue
    # Only partitions that already have records: the others start at 0.
    begins = [(*place, first[place]) for place in counts if first.get(place)]
    begins = spark.createDataFrame(begins, "topic STRING, partition INT, end_offset BIGINT") if begins else None
    assigned = assign_offsets(records, order, begins, width=width).withColumn("slice", slice_name(slice_number()))
    folders = ["topic", "partition", "slice"]
    clustered = assigned.hint("rebalance", *folders).sortWithinPartitions(*folders, "offset")
    clustered.write.mode("append").partitionBy(*folders).parquet(root)


def produce(
    records: DataFrame,
    root: str,
    partitioner: Column,
    order: list[str],
    interceptors: list[Callable[[DataFrame], DataFrame]] | None = None,
    width: int = SLICE_WIDTH,
) -> None:
    """Send records: interceptors in order, then the partition, then the append with offsets."""
    for step in interceptors or []:
        records = records.transform(step)
    append(records.withColumn("partition", partitioner), root, order, width)


def reset_topic(spark: SparkSession, root: str, topic: str) -> None:
    """Leave the topic empty: its folder is overwritten with no rows, other topics are untouched."""
    rest = T.StructType([f for f in with_extras().fields if f.name != "topic"])
    nothing = spark.createDataFrame([], rest)
    nothing.write.mode("overwrite").partitionBy("partition", "slice").parquet(f"{root}/topic={topic}")
    index = end_index(spark, root)
    version, state = index.latest()
    index.publish(version, {"ends": [end for end in state.get("ends", []) if end[0] != topic]})


def send_report(
    outcomes: DataFrame, batch: Column, failed: Column, first: int = 5
) -> DataFrame:
    """Per batch: sent, succeeded, failed and the first few offsets (as text).

    Only the ``first`` lowest offsets of a batch are ever put into an array.
    """
    tagged = outcomes.withColumns({"batch": batch, "_failed": failed})
    counts = tagged.groupBy("topic", "partition", "batch").agg(
        F.count("*").alias("sent"),
        F.count_if(~F.col("_failed")).alias("succeeded"),
        F.count_if(F.col("_failed")).alias("failed"),
    )
    w = Window.partitionBy("topic", "partition", "batch").orderBy("offset")
    heads = (
        tagged.select("topic", "partition", "batch", "offset")
        .withColumn("_rn", F.row_number().over(w))
        .where(F.col("_rn") <= first)
        .groupBy("topic", "partition", "batch")
        .agg(F.array_join(F.array_sort(F.collect_list("offset")), ",").alias("first_offsets"))
    )
    return counts.join(heads, ["topic", "partition", "batch"])


def split_by_error(
    checked: DataFrame, path: str, error: str = "error"
) -> tuple[DataFrame, DataFrame]:
    """One pass that writes good and bad rows side by side; returns (good, bad) readers."""
    outcome = F.when(F.col(error).isNull(), "good").otherwise("bad")
    checked.withColumn("outcome", outcome).write.mode("overwrite").partitionBy("outcome").parquet(path)
    back = checked.sparkSession.read.schema(
        checked.withColumn("outcome", outcome).schema
    ).parquet(path)
    return (
        back.where(F.col("outcome") == "good").drop("outcome"),
        back.where(F.col("outcome") == "bad").drop("outcome"),
    )


def dead_letters(bad: DataFrame, error: str = "error", retry_count: Column | None = None) -> DataFrame:
    """Quarantine rows: original key and value, the error, and where the record came from."""
    return bad.select(
        F.col("key").alias("original_key"),
        F.col("value").alias("original_value"),
        F.col(error).alias("error"),
        F.unix_millis("timestamp").alias("timestamp_ms"),
        "topic",
        "partition",
        "offset",
        (retry_count if retry_count is not None else F.lit(0)).cast("int").alias("retry_count"),
    )


def dead_letter_records(dlt: DataFrame, topic: str) -> DataFrame:
    """Dead letters as records of their own topic, under the original key."""
    body = F.to_json(
        F.struct(
            F.col("original_key").alias("originalKey"),
            F.col("original_value").alias("originalValue"),
            "error",
            F.col("timestamp_ms").alias("timestamp"),
        )
    )
    return dlt.select(F.lit(topic).alias("topic"), F.col("original_key").alias("key"), body.alias("value"))


def replay(
    dlt: DataFrame,
    repair: Column,
    valid: Callable[[str], Column],
    replayed: DataFrame | None = None,
    carry: list[str] | None = None,
) -> DataFrame:
    """Repaired dead letters that now pass ``valid``, minus those already replayed."""
    place = ["topic", "partition", "offset"]
    fixed = dlt.withColumn("value", repair).where(F.coalesce(valid("value"), F.lit(False)))
    if replayed is not None:
        fixed = fixed.join(replayed.select(*place), place, "left_anti")
    return fixed.select(*place, F.col("original_key").alias("key"), "value", *(carry or []))


def replay_into(
    dlt: DataFrame, repair: Column, valid: Callable[[str], Column], root: str, state: str, partitioner: Column
) -> str | None:
    """Write repaired dead letters back to their topics, each once; returns the transaction's id, None without any.

    One transaction appends the records to the log, then the places of the dead letters to the ledger under
    ``state``, then its commit.  A run that dies before the commit leaves records that no committed reader sees and
    ledger rows that count for nothing, so the next run replays the same letters; a run after it adds none.
    Records carry ``txn_id`` and ``replay_of``, the partition and offset that the dead letter came from.
    """
    spark = dlt.sparkSession
    txn_id = f"replay-{uuid.uuid4().hex[:12]}"
    fixed = replay(dlt, repair, valid, replayed(spark, state), carry=["timestamp_ms"])
    fixed = materialize(fixed.withColumn("txn_id", F.lit(txn_id)), "replay")
    if fixed.isEmpty():
        return None
    records = fixed.select(
        "topic",
        "key",
        "value",
        F.timestamp_millis("timestamp_ms").alias("timestamp"),
        empty_headers().alias("headers"),
        "txn_id",
        F.format_string("%d@%d", "partition", "offset").alias("replay_of"),
        F.col("offset").alias("_order"),
    )
    append(records.withColumn("partition", partitioner), root, ["_order", "replay_of"])
    fixed.select("topic", "partition", "offset", "txn_id").write.mode("append").parquet(f"{state}/ledger")
    committed = spark.createDataFrame([(txn_id, "committed")], "txn_id STRING, status STRING")
    committed.write.mode("append").parquet(f"{state}/txn_log")
    return txn_id


def replayed(spark: SparkSession, state: str) -> DataFrame | None:
    """Places of the dead letters that committed replays have written back; None before the first."""
    if not (exists(spark, f"{state}/ledger") and exists(spark, f"{state}/txn_log")):
        return None
    return committed_transactions(spark.read.parquet(f"{state}/ledger"), spark.read.parquet(f"{state}/txn_log"))


def upsert(target: DataFrame, batch: DataFrame, keys: list[str], version: list[str]) -> DataFrame:
    """Insert or overwrite by key; the highest version wins, so a replay changes nothing.

    A function of two frames; ``tables.KeyedTable`` is the stored table with this rule.
    """
    return newest(target.unionByName(batch.select(*target.columns)), keys, version)


# --- transactions -----------------------------------------------------------------------------


def order_transaction(orders: DataFrame) -> DataFrame:
    """Three records per order: the order, its stock adjustment and the customer's notification.

    Needs order_id, product_id, customer_id, quantity, txn_id, seq and timestamp.
    """
    order = F.to_json(
        F.struct(
            F.col("order_id").alias("orderId"),
            F.col("customer_id").alias("customerId"),
            F.col("product_id").alias("productId"),
            "quantity",
            F.lit("CONFIRMED").alias("status"),
        )
    )
    stock = F.to_json(
        F.struct(
            F.col("product_id").alias("productId"),
            (-F.col("quantity")).alias("adjustment"),
            F.concat(F.lit("Order "), F.col("order_id")).alias("reason"),
        )
    )
    note = F.to_json(
        F.struct(
            F.col("customer_id").alias("customerId"),
            F.lit("ORDER_CONFIRMATION").alias("type"),
            F.col("order_id").alias("orderId"),
        )
    )

    def rec(topic: str, key: str, value: Column) -> Column:
        return F.struct(
            F.lit(topic).alias("topic"), F.col(key).alias("key"), value.alias("value")
        )

    three = F.array(
        rec("orders", "order_id", order),
        rec("inventory", "product_id", stock),
        rec("notifications", "customer_id", note),
    )
    return orders.select("txn_id", "seq", "timestamp", F.explode(three).alias("r")).select(
        "r.*", "timestamp", "txn_id", "seq"
    )


def write_transactions(
    records: DataFrame,
    decisions: DataFrame,
    root: str,
    txn_log: str,
    order: list[str],
    width: int = SLICE_WIDTH,
) -> None:
    """Write the records of many transactions, then their outcomes.

    ``decisions`` (txn_id, status) is appended last: until it is there, a committed read sees none
    of the records, so a crash in between exposes nothing.
    """
    append(records, root, order, width)
    decisions.select("txn_id", "status").write.mode("append").parquet(txn_log)


def read_committed(log: DataFrame, txn_log: DataFrame) -> DataFrame:
    """Records of committed transactions and records outside any transaction."""
    outside = log.where(F.col("txn_id").isNull())
    return outside.unionByName(committed_transactions(log, txn_log))


def committed_transactions(log: DataFrame, txn_log: DataFrame) -> DataFrame:
    committed = txn_log.where(F.col("status") == "committed").select("txn_id")
    return log.where(F.col("txn_id").isNotNull()).join(committed, ["txn_id"], "left_semi").select(*log.columns)


# --- files ------------------------------------------------------------------------------------

MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"

CODECS = ["none", "gzip", "snappy", "lz4", "zstd"]


def codec_report(df: DataFrame, root: str, codecs: list[str] | None = None) -> DataFrame:
    """Write the same rows with each codec and compare the folder sizes."""
    spark = df.sparkSession
    sizes = []
    for codec in codecs or CODECS:
        df.write.option("compression", codec).parquet(f"{root}/{codec}")
        records = spark.read.parquet(f"{root}/{codec}").count()
        sizes.append((codec, records, folder_bytes(spark, f"{root}/{codec}")))
    return spark.createDataFrame(sizes, "codec STRING, records BIGINT, bytes BIGINT")


def write_files(df: DataFrame, path: str, fmt: str) -> DataFrame:
    """Write as json, csv or parquet and return a reader with the same schema."""
    options = {} if fmt == "parquet" else {"timestampFormat": MICROS}
    if fmt == "csv":
        options |= {"header": "true", "nullValue": "\\N"}
    df.write.format(fmt).options(**options).save(path)
    return df.sparkSession.read.format(fmt).schema(df.schema).options(**options).load(path)
