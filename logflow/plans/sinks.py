"""Produce, transaction, quarantine, upsert, progress and file-format queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logflow.functions import partitioners, payloads
from logflow.functions.parsing import is_json, not_json
from logflow.operators.offsets import checkpoints, recover
from logflow.plans.base import (
    EVENT_EXTRAS,
    HASH,
    PARTITIONS,
    event_records,
    events_log,
    events_store,
    query,
    staged,
    table,
    with_log,
    with_rec,
)
from logflow.plans.scans import BOUNDS, COMMITS, commit_log
from logflow.scratch import fresh_dir
from logflow.sinks import log as sink
from logflow.sinks.tables import KeyedTable
from logflow.sources.log import backlog_bytes, read_log, stream_log
from logflow.streaming.operators import first_arrivals
from logflow.streaming.runs import AT_LEAST_ONCE, EXACTLY_ONCE, batch_folder, deliver, drain, read_batches


@query("produce_append", with_log('SELECT part AS "partition", off AS "offset", key, event_id FROM log'))
def produce_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    records, root = event_records(spark, sf_dir), fresh_dir(spark, "append")
    middle = records.agg(F.max("event_id") / 2).first()[0]
    sink.append(records.where(F.col("event_id") <= middle), root, ["event_id"])
    sink.append(records.where(F.col("event_id") > middle), root, ["event_id"])
    return read_log(spark, root, EVENT_EXTRAS).select("partition", "offset", "key", "event_id")


@query(
    "send_report",
    with_log(
        """SELECT part AS "partition", off // 100 AS batch, count(*) AS sent,
        count(*) FILTER (event_type <> 'error') AS succeeded,
        count(*) FILTER (event_type = 'error') AS failed,
        string_agg(off::VARCHAR, ',' ORDER BY off) FILTER (off % 100 < 5) AS first_offsets
        FROM log GROUP BY ALL"""
    ),
)
def send_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = events_log(spark, sf_dir)
    return sink.send_report(log, F.expr("offset div 100"), F.col("event_type") == "error").drop("topic")


def order_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.concat(F.lit("ORD-"), F.col("o_orderkey")).alias("orderId"),
        F.concat(F.lit("CUST-"), F.col("o_custkey")).alias("customerId"),
        F.col("o_orderpriority").alias("product"),
        (F.col("o_orderkey") % 5 + 1).cast("int").alias("quantity"),
        F.col("o_totalprice").cast("decimal(10,2)").alias("price"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_orderdate").cast("timestamp").alias("createdAt"),
    )


ORDER_FIELDS = [f.name for f in payloads.ORDER_SCHEMA.fields]
ORDER_SQL = """'ORD-' || o_orderkey AS order_id, 'CUST-' || o_custkey AS customer_id,
  (o_orderkey % 5 + 1)::INTEGER AS quantity, o_totalprice::DECIMAL(10,2)::VARCHAR AS price,
  strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS created_at"""


def order_columns(struct: str) -> list:
    return [
        F.col(f"{struct}.orderId").alias("order_id"),
        F.col(f"{struct}.customerId").alias("customer_id"),
        F.col(f"{struct}.quantity").alias("quantity"),
        F.col(f"{struct}.price").cast("string").alias("price"),
        F.date_format(f"{struct}.createdAt", "yyyy-MM-dd HH:mm:ss").alias("created_at"),
    ]


@query("json_values", f"SELECT {ORDER_SQL} FROM orders")
def json_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    written = order_json(spark, sf_dir).select(payloads.json_value(*ORDER_FIELDS).alias("value"))
    return written.select(F.from_json("value", payloads.ORDER_SCHEMA).alias("o")).select(*order_columns("o"))


@query(
    "envelope_wrap",
    f"""SELECT 'wrapped-ORD-' || o_orderkey AS key, 'Order' AS type, '1.0' AS version,
    strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S.000Z') AS wrapped_at, {ORDER_SQL} FROM orders""",
)
def envelope_wrap(spark: SparkSession, sf_dir: str) -> DataFrame:
    instant = F.date_format("createdAt", payloads.ISO_MILLIS)
    wrapped = order_json(spark, sf_dir).select(
        F.concat(F.lit("wrapped-"), F.col("orderId")).alias("key"),
        payloads.envelope("Order", F.struct(*ORDER_FIELDS), instant).alias("value"),
    )
    opened = payloads.unwrap(wrapped, {"Order": payloads.ORDER_SCHEMA})
    return opened.select(
        "key",
        "type",
        "version",
        F.get_json_object("value", "$.timestamp").alias("wrapped_at"),
        *order_columns("Order"),
    )


@query(
    "csv_value",
    """SELECT 'ORD-' || o_orderkey AS order_id, o_orderpriority AS product,
    (o_orderkey % 5 + 1)::INTEGER AS quantity, o_totalprice::DECIMAL(10,2)::VARCHAR AS price FROM orders""",
)
def csv_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    header = ["orderId", "product", "quantity", "price"]
    written = order_json(spark, sf_dir).select(payloads.csv_value(header, *header).alias("value"))
    line = payloads.parse_csv_value("value", "orderId STRING, product STRING, quantity INT, price DECIMAL(10,2)")
    return written.select(line.alias("r")).select(
        F.col("r.orderId").alias("order_id"),
        "r.product",
        "r.quantity",
        F.col("r.price").cast("string").alias("price"),
    )


@query("topic_reset", "SELECT 'events' AS topic, count(*) AS records_before, 0::BIGINT AS records_after FROM events")
def topic_reset(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = fresh_dir(spark, "reset")
    sink.append(event_records(spark, sf_dir).drop(*["num", "props", "body"]), root, ["event_id"])
    before = read_log(spark, root).count()
    sink.reset_topic(spark, root, "events")
    return read_log(spark, root).agg(
        F.lit("events").alias("topic"),
        F.lit(before).cast("bigint").alias("records_before"),
        F.count("*").alias("records_after"),
    )


# --- transactions -----------------------------------------------------------------------------

TXN_EXTRAS = "txn_id STRING, seq BIGINT"


def txn_store(spark: SparkSession, sf_dir: str) -> str:
    """Every order as one transaction of three records; every fifth one aborts.

    Every seventh order's records are written outside any transaction.
    """

    def build(path: str) -> None:
        key = F.col("o_orderkey")
        orders = table(spark, sf_dir, "orders").select(
            F.concat(F.lit("ORD-"), key).alias("order_id"),
            F.concat(F.lit("PROD-"), key % 100).alias("product_id"),
            F.concat(F.lit("CUST-"), F.col("o_custkey")).alias("customer_id"),
            (key % 5 + 1).cast("int").alias("quantity"),
            F.when(key % 7 != 0, F.concat(F.lit("txn-"), key)).alias("txn_id"),
            key.alias("seq"),
            F.col("o_orderdate").cast("timestamp").alias("timestamp"),
        )
        records = sink.order_transaction(orders).withColumn("partition", partitioners.by_key(PARTITIONS))
        status = F.when(F.col("seq") % 5 == 0, "aborted").otherwise("committed")
        decisions = orders.where(F.col("txn_id").isNotNull()).select("txn_id", status.alias("status"))
        sink.write_transactions(records, decisions, f"{path}/log", f"{path}/txn_log", ["seq"])

    return staged(spark, sf_dir, "transactions", build)


def txn_log_frames(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    path = txn_store(spark, sf_dir)
    return read_log(spark, f"{path}/log", TXN_EXTRAS), spark.read.parquet(f"{path}/txn_log")


TXN = f"""
o AS (SELECT *, 'ORD-' || o_orderkey AS order_id, 'PROD-' || (o_orderkey % 100) AS product_id,
  'CUST-' || o_custkey AS customer_id, o_orderkey % 5 + 1 AS quantity,
  CASE WHEN o_orderkey % 7 <> 0 THEN 'txn-' || o_orderkey END AS txn_id FROM orders),
txn_records AS (
  SELECT 'orders' AS topic, order_id AS key, txn_id, o_orderkey AS seq, quantity AS n FROM o
  UNION ALL SELECT 'inventory', product_id, txn_id, o_orderkey, -quantity FROM o
  UNION ALL SELECT 'notifications', customer_id, txn_id, o_orderkey, 0 FROM o),
txns AS (SELECT *, {HASH.format("key")} AS part,
  txn_id IS NOT NULL AND seq % 5 <> 0 AS committed, txn_id IS NOT NULL AND seq % 5 = 0 AS aborted
  FROM txn_records),
txn_off AS (SELECT *, row_number() OVER (PARTITION BY topic, part ORDER BY seq) - 1 AS off FROM txns)
"""


@query(
    "atomic_multi_log_write",
    f"""WITH {TXN} SELECT topic, part AS "partition", off AS "offset", key, txn_id, n::INTEGER AS change
    FROM txn_off WHERE committed""",
)
def atomic_multi_log_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    log, txn_log = txn_log_frames(spark, sf_dir)
    change = F.coalesce(
        F.get_json_object("value", "$.adjustment"), F.get_json_object("value", "$.quantity"), F.lit("0")
    )
    return sink.committed_transactions(log, txn_log).select(
        "topic", "partition", "offset", "key", "txn_id", change.cast("int").alias("change")
    )


@query(
    "txn_abort",
    f"""WITH {TXN} SELECT topic, count(*) FILTER (aborted) AS written,
    0::BIGINT AS visible FROM txn_off GROUP BY topic""",
)
def txn_abort(spark: SparkSession, sf_dir: str) -> DataFrame:
    log, txn_log = txn_log_frames(spark, sf_dir)
    aborted = txn_log.where(F.col("status") == "aborted").select("txn_id")

    def of_aborted(records: DataFrame) -> DataFrame:
        return records.join(aborted, ["txn_id"], "left_semi").groupBy("topic").agg(F.count("*").alias("n"))

    written = of_aborted(log).withColumnRenamed("n", "written")
    visible = of_aborted(sink.read_committed(log, txn_log)).withColumnRenamed("n", "visible")
    return written.join(visible, "topic", "left").select(
        "topic", "written", F.coalesce("visible", F.lit(0)).alias("visible")
    )


@query(
    "read_committed",
    f"""WITH {TXN} SELECT 'read_uncommitted' AS isolation, topic, count(*) AS records FROM txn_off GROUP BY topic
    UNION ALL SELECT 'read_committed', topic, count(*) FROM txn_off WHERE NOT aborted GROUP BY topic""",
)
def read_committed_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    log, txn_log = txn_log_frames(spark, sf_dir)

    def counts(records: DataFrame, isolation: str) -> DataFrame:
        by_topic = records.groupBy("topic").agg(F.count("*").alias("records"))
        return by_topic.select(F.lit(isolation).alias("isolation"), "topic", "records")

    return counts(log, "read_uncommitted").unionByName(
        counts(sink.read_committed(log, txn_log), "read_committed")
    )


@query(
    "committed_transactions",
    f"""WITH {TXN} SELECT topic, part AS "partition", off AS "offset", key FROM txn_off WHERE committed""",
)
def committed_transactions_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    log, txn_log = txn_log_frames(spark, sf_dir)
    return sink.committed_transactions(log, txn_log).select("topic", "partition", "offset", "key")


# --- upserts and the event table --------------------------------------------------------------


@query(
    "upsert_by_id",
    """SELECT event_id AS id, user_id,
    CASE WHEN event_id % 2 = 0 THEN value + 1 ELSE value END AS amount,
    CASE WHEN event_id % 2 = 0 THEN 2 ELSE 1 END AS version
    FROM events WHERE event_id % 3 <> 0 OR event_id % 2 = 0""",
)
def upsert_by_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")

    def rows(part, amount, version: int) -> DataFrame:
        return events.where(part).select(
            F.col("event_id").alias("id"), "user_id", amount.alias("amount"), F.lit(version).alias("version")
        )

    schema = "id BIGINT, user_id BIGINT, amount DOUBLE, version INT"
    target = KeyedTable(spark, fresh_dir(spark, "keyed"), schema, ["id"], ["version"], buckets=8)
    target.upsert(rows(F.col("event_id") % 3 != 0, F.col("value"), 1), batch_id=0)
    batch = rows(F.col("event_id") % 2 == 0, F.col("value") + 1, 2)
    target.upsert(batch, batch_id=1)
    target.upsert(batch.withColumn("amount", F.lit(0.0)), batch_id=1)  # a repeated batch id changes nothing
    target.upsert(rows(F.col("event_id") % 2 == 0, F.col("value") - 1, 1), batch_id=2)  # nor does an older version
    return target.read()


LATER = 1 << 40


def write_duplicated(spark: SparkSession, sf_dir: str, path: str) -> None:
    """The events, and then every seventh one a second time as a later arrival.

    Two appends: streams read files in the order they were written, so the copies come later there.
    """
    records = event_records(spark, sf_dir).withColumn("arrival", F.col("event_id"))
    sink.append(records, path, ["arrival"])
    again = records.where(F.col("event_id") % 7 == 0).withColumn("arrival", F.col("event_id") + LATER)
    sink.append(again, path, ["arrival"])


DUP_EXTRAS = EVENT_EXTRAS + ", arrival BIGINT"


def duplicates_store(spark: SparkSession, sf_dir: str) -> str:
    return staged(
        spark, sf_dir, "duplicated-log", lambda path: write_duplicated(spark, sf_dir, path)
    )


DUP = f"""
dup_rec AS (SELECT *, event_id AS arrival FROM rec
  UNION ALL SELECT *, event_id + {LATER} FROM rec WHERE event_id % 7 = 0),
dup AS (SELECT *, action || ':' || amount_text AS value,
  row_number() OVER (PARTITION BY part ORDER BY arrival) - 1 AS off FROM dup_rec)"""


@query(
    "event_table_sink",
    with_rec(
        """SELECT event_id::VARCHAR AS event_id, topic, part AS "partition", off AS log_offset, value AS data
        FROM (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY arrival) AS rn FROM dup)
        WHERE rn = 1"""
    ).replace("\nSELECT event_id::VARCHAR", f",{DUP}\nSELECT event_id::VARCHAR"),
)
def event_table_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every micro-batch writes only ids that no batch before it had; the state store tells them."""
    root = duplicates_store(spark, sf_dir)
    stream = stream_log(spark, root, DUP_EXTRAS, bytes_per_trigger=backlog_bytes(spark, root))
    rows = stream.select(
        F.col("event_id").cast("string").alias("event_id"),
        "topic",
        "partition",
        F.col("offset").alias("log_offset"),
        F.col("value").alias("data"),
    )
    first = first_arrivals(rows, "event_id", F.col("log_offset"), rows.columns)
    path = fresh_dir(spark, "event-table")
    writer = first.writeStream.outputMode("update").foreachBatch(batch_folder(path))
    drain(writer, fresh_dir(spark, "event-table-ckpt"))
    return read_batches(spark, path, rows.schema).drop("batch")


@query(
    "codec_report",
    """SELECT codec, count(*) AS records, codec <> 'none' AS smaller FROM events
    CROSS JOIN (VALUES ('none'), ('gzip'), ('snappy'), ('lz4'), ('zstd')) c(codec) GROUP BY codec""",
)
def codec_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records read back per codec, and whether its folder is smaller than the uncompressed one."""
    report = sink.codec_report(table(spark, sf_dir, "events"), fresh_dir(spark, "codecs"))
    plain = report.where(F.col("codec") == "none").first()["bytes"]
    return report.select("codec", "records", (F.col("bytes") < plain).alias("smaller"))


# --- quarantine -------------------------------------------------------------------------------


def checked_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log with JSON bodies as values and an error on the broken ones."""
    bodies = events_log(spark, sf_dir).withColumn("value", F.col("body")).drop("body", "props", "num")
    return bodies.withColumn("error", F.when(not_json("value"), "not_json"))


def quarantined(spark: SparkSession, sf_dir: str) -> DataFrame:
    def build(path: str) -> None:
        _, bad = sink.split_by_error(checked_log(spark, sf_dir), f"{path}/split")
        sink.dead_letters(bad).write.parquet(f"{path}/dlt")

    return spark.read.parquet(staged(spark, sf_dir, "quarantine", build) + "/dlt")


@query(
    "dead_letter",
    with_log(
        """SELECT key AS original_key, body AS original_value, 'not_json' AS error, (epoch_us(ts) // 1000) AS timestamp_ms,
        topic, part AS "partition", off AS "offset", 0 AS retry_count FROM log WHERE NOT json_valid(body)"""
    ),
)
def dead_letter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quarantined(spark, sf_dir)


REPLAY_EXTRAS = EVENT_EXTRAS + ", txn_id STRING, replay_of STRING"


@query(
    "dlt_replay",
    with_log(
        """SELECT topic, part AS "partition", 'live' AS origin, off AS "offset", key, body AS value FROM log
          WHERE json_valid(body)
        UNION ALL
        SELECT topic, part, part || '@' || off, e + row_number() OVER (PARTITION BY part ORDER BY off % 3 <> 0, off) - 1, key,
          body || '}' FROM log JOIN bounds USING (part) WHERE NOT json_valid(body)""",
        BOUNDS,
    ),
)
def dlt_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main topic after its dead letters were repaired and written back, in two runs and an idle third one."""
    dlt, root, state = quarantined(spark, sf_dir), fresh_dir(spark, "main"), fresh_dir(spark, "replays")
    bodies = event_records(spark, sf_dir).withColumn("value", F.col("body")).drop("body", "props", "num")
    sink.append(bodies, root, ["event_id"])
    repaired = F.concat(F.col("original_value"), F.lit("}"))
    for letters in (dlt.where(F.col("offset") % 3 == 0), dlt, dlt):
        sink.replay_into(letters, repaired, is_json, root, state, partitioners.by_key(PARTITIONS))
    log = sink.read_committed(read_log(spark, root, REPLAY_EXTRAS), spark.read.parquet(f"{state}/txn_log"))
    origin = F.coalesce("replay_of", F.lit("live")).alias("origin")
    return log.where(is_json("value")).select("topic", "partition", origin, "offset", "key", "value")


# --- progress ---------------------------------------------------------------------------------


@query(
    "commit_offsets",
    with_log(
        """SELECT grp AS consumer_group, 'events' AS topic, part AS "partition", committed AS "offset"
        FROM commits""",
        COMMITS,
    ),
)
def commit_offsets_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return commit_log(spark, sf_dir).latest().drop("updated_at", "sequence")


CHECKPOINTS = """
saved AS (SELECT part, off // 1000 AS bucket, max(off) + 1 AS upto, count(*) AS n, sum(amount)::BIGINT AS s
  FROM log GROUP BY ALL),
running AS (SELECT part, upto, (sum(n) OVER w)::BIGINT AS state_count, (sum(s) OVER w)::BIGINT AS state_sum
  FROM saved WINDOW w AS (PARTITION BY part ORDER BY bucket))"""

CHECKPOINT_SQL = """'audit' AS consumer_group, 'events' AS topic, part AS "partition", upto AS "offset",
  state_count, state_sum"""


def event_checkpoints(spark: SparkSession, sf_dir: str) -> DataFrame:
    amount = F.when(F.col("event_type") == "signup", 0).otherwise(F.floor("num"))
    return checkpoints(events_log(spark, sf_dir), "audit", 1000, amount)


@query("checkpoint_table", with_log(f"SELECT {CHECKPOINT_SQL} FROM running", CHECKPOINTS))
def checkpoint_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_checkpoints(spark, sf_dir).drop("state_json", "updated_at")


@query(
    "checkpoint_recovery",
    with_log(
        f"""SELECT {CHECKPOINT_SQL}, '{{"count":' || state_count || ',"sum":' || state_sum || '}}' AS state_json
        FROM running QUALIFY row_number() OVER (PARTITION BY part ORDER BY upto DESC) = 1""",
        CHECKPOINTS,
    ),
)
def checkpoint_recovery(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recover(event_checkpoints(spark, sf_dir)).drop("updated_at")


@query(
    "delivery_mode",
    """SELECT mode, count(*) AS records, count(DISTINCT event_id) AS distinct_records
    FROM events CROSS JOIN (VALUES ('exactly_once'), ('at_least_once')) m(mode) GROUP BY mode""",
)
def delivery_mode(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = []
    for mode in (EXACTLY_ONCE, AT_LEAST_ONCE):
        stream = stream_log(spark, events_store(spark, sf_dir), EVENT_EXTRAS).select("event_id", "key")
        path = fresh_dir(spark, mode)
        deliver(stream, path, fresh_dir(spark, f"{mode}-ckpt"), mode)
        counts.append(
            read_batches(spark, path, stream.schema).agg(
                F.count("*").alias("records"), F.count_distinct("event_id").alias("distinct_records")
            ).select(F.lit(mode).alias("mode"), "*")
        )
    return counts[0].unionByName(counts[1])


# --- file formats -----------------------------------------------------------------------------

FILE_SQL = with_rec(
    """SELECT event_id, key, action || ':' || amount_text AS value, num, body,
    strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts FROM rec"""
)


def _round_trip(spark: SparkSession, sf_dir: str, fmt: str) -> DataFrame:
    rows = event_records(spark, sf_dir).select("event_id", "key", "value", "num", "body", "timestamp")
    back = sink.write_files(rows, fresh_dir(spark, fmt), fmt)
    return back.select(
        "event_id", "key", "value", "num", "body", F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("ts")
    )


@query("json_sink", FILE_SQL)
def json_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _round_trip(spark, sf_dir, "json")


@query("csv_sink", FILE_SQL)
def csv_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _round_trip(spark, sf_dir, "csv")


@query("parquet_sink", FILE_SQL)
def parquet_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _round_trip(spark, sf_dir, "parquet")


@query(
    "first_offsets",
    with_log(
        """SELECT part AS "partition", off // 100 AS batch,
        string_agg(off::VARCHAR, ',' ORDER BY off) FILTER (off % 100 < 5) AS first_offsets
        FROM log GROUP BY ALL"""
    ),
)
def first_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = sink.send_report(events_log(spark, sf_dir), F.expr("offset div 100"), F.lit(False))
    return report.select("partition", "batch", "first_offsets")
