"""Structured Streaming queries: each drains a stored log as a stream and returns the final table.

Micro-batches are sized by the store and the cluster (``backlog_bytes``).  A backlog is read in file order, not in
time order, so these runs use no watermark; a live reader sets one that covers the disorder of its source.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import StreamingQueryException

from logflow.functions import partitioners
from logflow.functions.parsing import not_json
from logflow.operators import joins, statemachines
from logflow.operators.routing import retry_decision
from logflow.plans.analytics import (
    BALANCES_SQL,
    CUSTOMER_FALLBACK,
    ENRICH_SQL,
    ROUTE_SQL,
    known_customers,
    routed,
)
from logflow.plans.base import (
    EVENT_EXTRAS,
    PARTITIONS,
    event_records,
    events_store,
    query,
    staged,
    with_log,
    with_rec,
)
from logflow.plans.scans import TOPICS, events_bounds, topics_store
from logflow.plans.sinks import TXN, TXN_EXTRAS, DUP_EXTRAS, duplicates_store, txn_log_frames, txn_store
from logflow.plans.values import ERROR_NAMES, ERROR_SQL, error_name
from logflow.scratch import fresh_dir
from logflow.sinks import log as sink
from logflow.sources.log import backlog_bytes, stream_log
from logflow.streaming import operators as stream_ops
from logflow.streaming import runs
from logflow.streaming.retries import RetryLoop
from logflow.streaming.watch import ProgressTable, backlog

def events_stream(spark: SparkSession, sf_dir: str, batches: bool = True) -> DataFrame:
    """The events' log as a stream, in one batch only where the operator orders rows over the whole log."""
    root = events_store(spark, sf_dir)
    return stream_log(spark, root, EVENT_EXTRAS, bytes_per_trigger=backlog_bytes(spark, root) if batches else None)


def paths(spark: SparkSession, label: str) -> tuple[str, str]:
    return fresh_dir(spark, label), fresh_dir(spark, f"{label}-ckpt")


def window_text(df: DataFrame) -> DataFrame:
    return df.withColumn("window_start", F.date_format("window_start", "yyyy-MM-dd HH:mm"))


@query(
    "stream_tumbling",
    """SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M') AS window_start, event_type,
    count(*) AS records, sum(floor(value))::BIGINT AS amount FROM events GROUP BY ALL""",
)
def stream_tumbling(spark: SparkSession, sf_dir: str) -> DataFrame:
    windowed = stream_ops.tumbling(
        events_stream(spark, sf_dir),
        "1 hour",
        None,
        [F.count("*").alias("records"), F.sum(F.floor("num")).alias("amount")],
        "event_type",
    )
    final = runs.updated_table(windowed, ["window_start", "event_type"], *paths(spark, "tumbling"))
    return window_text(final)


@query(
    "stream_sliding",
    """SELECT strftime(w, '%Y-%m-%d %H:%M') AS window_start, count(*) AS records,
      sum(floor(value))::BIGINT AS amount
    FROM (SELECT value, unnest([time_bucket(INTERVAL 15 MINUTE, ts),
        time_bucket(INTERVAL 15 MINUTE, ts) - INTERVAL 15 MINUTE,
        time_bucket(INTERVAL 15 MINUTE, ts) - INTERVAL 30 MINUTE,
        time_bucket(INTERVAL 15 MINUTE, ts) - INTERVAL 45 MINUTE]) AS w FROM events) GROUP BY 1""",
)
def stream_sliding(spark: SparkSession, sf_dir: str) -> DataFrame:
    windowed = stream_ops.sliding(
        events_stream(spark, sf_dir),
        "1 hour",
        "15 minutes",
        None,
        [F.count("*").alias("records"), F.sum(F.floor("num")).alias("amount")],
    )
    return window_text(runs.updated_table(windowed, ["window_start"], *paths(spark, "sliding")))


@query("stream_balances", BALANCES_SQL)
def stream_balances(spark: SparkSession, sf_dir: str) -> DataFrame:
    balances = stream_ops.balances(events_stream(spark, sf_dir))
    return runs.updated_table(balances, ["key"], *paths(spark, "balances"))


@query("stream_dedup", with_rec("SELECT event_id, key, action || ':' || amount_text AS value FROM rec"))
def stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = duplicates_store(spark, sf_dir)
    stream = stream_log(spark, root, DUP_EXTRAS, bytes_per_trigger=backlog_bytes(spark, root))
    unique = stream_ops.dedup(stream, "event_id").select("event_id", "key", "value")
    return runs.appended_table(unique, *paths(spark, "dedup"))


# --- state machines ---------------------------------------------------------------------------


def sequenced(records: DataFrame) -> DataFrame:
    """Every user is a producer numbering its events; some are resent at once, some much later."""
    base = records.select(
        F.col("key").cast("bigint").alias("producer_id"),
        "partition",
        F.col("event_id").alias("sequence"),
        (F.col("event_id") * 10).alias("arrival"),
    )
    at_once = F.when(F.col("sequence") % 7 == 0, F.col("arrival") + 1)
    later = F.when(F.col("sequence") % 11 == 0, F.col("arrival") + 50_002)
    arrivals = F.array_compact(F.array(F.col("arrival"), at_once, later))
    return base.withColumn("arrival", F.explode(arrivals))


SEQUENCES_SQL = with_rec(
    """SELECT * FROM marked""",
).replace(
    "\nSELECT * FROM marked",
    """,
arrivals AS (
  SELECT user_id AS producer_id, part, event_id AS sequence, event_id * 10 AS arrival FROM rec
  UNION ALL SELECT user_id, part, event_id, event_id * 10 + 1 FROM rec WHERE event_id % 7 = 0
  UNION ALL SELECT user_id, part, event_id, event_id * 10 + 50002 FROM rec WHERE event_id % 11 = 0),
numbered AS (SELECT *, row_number() OVER (PARTITION BY producer_id, part ORDER BY arrival) AS rn FROM arrivals),
fold AS (
  SELECT producer_id, part, 0::BIGINT AS rn, 0::BIGINT AS sequence, 0::BIGINT AS arrival,
    false AS duplicate, []::BIGINT[] AS recent
  FROM numbered WHERE rn = 1
  UNION ALL
  SELECT n.producer_id, n.part, n.rn, n.sequence, n.arrival, list_contains(f.recent, n.sequence),
    CASE WHEN list_contains(f.recent, n.sequence) THEN f.recent
      ELSE list_append(f.recent, n.sequence)[-5:] END
  FROM fold f JOIN numbered n ON n.producer_id = f.producer_id AND n.part = f.part AND n.rn = f.rn + 1)
SELECT producer_id, part AS "partition", sequence, arrival, duplicate FROM fold WHERE rn > 0""",
).replace("WITH", "WITH RECURSIVE", 1)


@query("sequence_dedup", SEQUENCES_SQL)
def sequence_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return statemachines.mark_duplicate_sequences(sequenced(event_records(spark, sf_dir)))


@query("stream_sequence_dedup", SEQUENCES_SQL)
def stream_sequence_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = stream_ops.mark_duplicate_sequences(sequenced(events_stream(spark, sf_dir, batches=False)))
    return runs.appended_table(marked, *paths(spark, "sequences"))


def calls(records: DataFrame) -> DataFrame:
    """Calls to eight dependencies; a third of them goes to the first one."""
    hot = F.when(F.col("event_id") % 3 == 0, F.lit(0)).otherwise(F.col("event_id") % 8)
    return records.select(
        F.concat(F.lit("dep-"), hot).alias("dependency"),
        F.col("event_id").alias("seq"),
        F.unix_millis("timestamp").alias("ts_ms"),
        (F.col("num") > 35).alias("failed"),
    )


BREAKER_SQL = """WITH RECURSIVE calls AS (
  SELECT 'dep-' || CASE WHEN event_id % 3 = 0 THEN 0 ELSE event_id % 8 END AS dependency, event_id AS seq,
    epoch_us(ts) // 1000 AS ts_ms, value > 35 AS failed FROM events),
numbered AS (SELECT *, row_number() OVER (PARTITION BY dependency ORDER BY seq) AS rn FROM calls),
fold AS (
  SELECT dependency, 0::BIGINT AS rn, 0::BIGINT AS seq, 0::BIGINT AS ts_ms, false AS failed, true AS allowed,
    'CLOSED' AS state, []::INTEGER[] AS recent, 0::BIGINT AS opened_at, 0 AS successes
  FROM numbered WHERE rn = 1
  UNION ALL
  SELECT dependency, rn, seq, ts_ms, failed, allowed, state,
    CASE WHEN state = 'CLOSED' AND was = 'CLOSED' THEN window10 ELSE [] END,
    CASE WHEN state = 'OPEN' AND was <> 'OPEN' THEN ts_ms ELSE opened_at END,
    CASE WHEN state = 'HALF_OPEN' THEN probes ELSE 0 END
  FROM (
    SELECT *, was <> 'OPEN' AS allowed,
      CASE was WHEN 'OPEN' THEN 'OPEN'
        WHEN 'HALF_OPEN' THEN CASE WHEN failed THEN 'OPEN' WHEN probes = 2 THEN 'CLOSED' ELSE 'HALF_OPEN' END
        ELSE CASE WHEN len(window10) = 10 AND list_sum(window10) >= 5 THEN 'OPEN' ELSE 'CLOSED' END
      END AS state
    FROM (
      SELECT n.*, f.opened_at, list_append(f.recent, n.failed::INTEGER)[-10:] AS window10,
        CASE WHEN f.state = 'OPEN' AND n.ts_ms - f.opened_at >= 30000 THEN 'HALF_OPEN' ELSE f.state END AS was,
        CASE WHEN f.state = 'HALF_OPEN' THEN f.successes ELSE 0 END
          + CASE WHEN n.failed THEN 0 ELSE 1 END AS probes
      FROM fold f JOIN numbered n ON n.dependency = f.dependency AND n.rn = f.rn + 1)))
SELECT dependency, seq, ts_ms, failed, allowed, state FROM fold WHERE rn > 0"""


@query("circuit_breaker", BREAKER_SQL)
def circuit_breaker(spark: SparkSession, sf_dir: str) -> DataFrame:
    return statemachines.circuit_breaker(calls(event_records(spark, sf_dir)))


@query("stream_circuit_breaker", BREAKER_SQL)
def stream_circuit_breaker(spark: SparkSession, sf_dir: str) -> DataFrame:
    states = stream_ops.circuit_breaker(calls(events_stream(spark, sf_dir, batches=False)))
    return runs.appended_table(states, *paths(spark, "breaker"))


# --- outputs ----------------------------------------------------------------------------------


@query(
    "retry_routing",
    f"WITH {ERROR_SQL}"
    + with_log(
        """SELECT event_id, outcome, CASE WHEN outcome = 'retry' THEN (epoch_us(ts) // 1000)
          + least(100 * power(2, attempt - 1), 10000)::BIGINT ELSE -1 END AS not_before_ms
        FROM (SELECT event_id, ts, event_id % 4 + 1 AS attempt,
            CASE WHEN event_type <> 'error' THEN 'done' WHEN retriable AND event_id % 4 + 1 < 3 THEN 'retry'
              ELSE 'dlt' END AS outcome
          FROM log JOIN error_names ON idx = event_id % """
        + str(len(ERROR_NAMES))
        + ")"
    ).replace("WITH ", ", ", 1),
)
def retry_routing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Processed records go on, retriable failures to a retry log with a due time, the rest to the DLT."""
    stream = events_stream(spark, sf_dir).withColumns(
        {
            "error": F.when(F.col("event_type") == "error", error_name()),
            "attempt": F.col("event_id") % 4 + 1,
        }
    ).select("event_id", "key", "value", "timestamp", "error", "attempt")
    path, checkpoint = paths(spark, "retries")
    runs.drain(
        stream.writeStream.foreachBatch(stream_ops.split_batches(path, retry_decision, "outcome")), checkpoint
    )
    return spark.read.parquet(path).select(
        "event_id", "outcome", F.coalesce("not_before_ms", F.lit(-1)).alias("not_before_ms")
    )


@query(
    "periodic_emit",
    "SELECT event_type, count(*) AS records, sum(floor(value))::BIGINT AS amount FROM events GROUP BY 1",
)
def periodic_emit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Running aggregates, emitted again after every micro-batch that changed them."""
    running = events_stream(spark, sf_dir).groupBy("event_type").agg(
        F.count("*").alias("records"), F.sum(F.floor("num")).alias("amount")
    )
    return runs.updated_table(running, ["event_type"], *paths(spark, "emit"))


@query("fan_out", with_log(f'SELECT {ROUTE_SQL} AS route, key, part AS "partition", off AS "offset" FROM log'))
def fan_out(spark: SparkSession, sf_dir: str) -> DataFrame:
    stream = routed(events_stream(spark, sf_dir)).select("route", "key", "partition", "offset", "value")
    table = runs.appended_table(stream, *paths(spark, "fan-out"), "route")
    return table.select("route", "key", "partition", "offset")


@query("stop_resume", with_log('SELECT part AS "partition", off AS "offset", event_id FROM log'))
def stop_resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stop after the first half of the log, append the rest meanwhile, resume on the checkpoint."""
    records, root = event_records(spark, sf_dir), fresh_dir(spark, "growing")
    path, checkpoint = paths(spark, "resumed")
    middle = records.agg(F.max("event_id") / 2).first()[0]

    def run() -> DataFrame:
        stream = stream_log(spark, root, EVENT_EXTRAS).select("partition", "offset", "event_id")
        return runs.appended_table(stream, path, checkpoint)

    sink.append(records.where(F.col("event_id") <= middle), root, ["event_id"])
    run()
    sink.append(records.where(F.col("event_id") > middle), root, ["event_id"])
    return run()


def resent_store(spark: SparkSession, sf_dir: str) -> str:
    """The transactions' log, and every eleventh order's records a second time, as from a producer that retried."""

    def build(path: str) -> None:
        log = txn_log_frames(spark, sf_dir)[0].drop("partition", "offset", "slice")
        log = log.withColumn("partition", partitioners.by_key(PARTITIONS))
        sink.append(log, path, ["seq"])
        sink.append(log.where(F.col("seq") % 11 == 0), path, ["seq"])

    return staged(spark, sf_dir, "resent", build)


@query(
    "exactly_once_flow",
    f"""WITH {TXN} SELECT topic, part AS "partition", off AS "offset", key FROM txn_off WHERE NOT aborted""",
)
def exactly_once_flow(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Committed records of all topics, validated, each once, although the writer dies after its first batch.

    It dies between the write and the commit of the batch; the restarted query runs that batch again.
    """
    root, txn_log = resent_store(spark, sf_dir), txn_log_frames(spark, sf_dir)[1]
    stream = stream_log(spark, root, TXN_EXTRAS, bytes_per_trigger=backlog_bytes(spark, root))
    outside, decided = stream.where(F.col("txn_id").isNull()), sink.committed_transactions(stream, txn_log)
    valid = outside.unionByName(decided).where(F.col("key").isNotNull() & ~not_json("value"))
    message = valid.withColumn("message_id", F.concat_ws("-", "topic", F.col("seq").cast("string")))
    columns = ["message_id", "topic", "partition", "offset", "key"]
    first = stream_ops.first_arrivals(message, "message_id", F.col("offset"), columns)
    path, checkpoint = paths(spark, "once")
    write, crashes = runs.batch_folder(path), [0]

    def write_and_die(df: DataFrame, batch_id: int) -> None:
        write(df, batch_id)
        if crashes and crashes.pop() == batch_id:
            raise RuntimeError("died before the commit")

    for sink_function in (write_and_die, write):
        try:
            runs.drain(first.writeStream.outputMode("update").foreachBatch(sink_function), checkpoint)
        except StreamingQueryException as error:
            if "died before the commit" not in str(error):
                raise
    return runs.read_batches(spark, path, first.schema).select("topic", "partition", "offset", "key")


@query(
    "retry_loop",
    f"WITH {ERROR_SQL}"
    + with_log(
        """SELECT event_id, outcome, attempt, (epoch_us(ts) // 1000) + 100 * (power(2, attempt - 1) - 1)::BIGINT AS due_ms
        FROM (SELECT event_id, ts, CASE WHEN fails = 0 OR (retriable AND fails < 3) THEN 'done' ELSE 'dlt' END AS outcome,
            CASE WHEN fails > 0 AND NOT retriable THEN 1 ELSE least(fails + 1, 3) END::INTEGER AS attempt
          FROM (SELECT *, CASE WHEN event_type = 'error' THEN event_id % 5 ELSE 0 END AS fails FROM log) l
          JOIN error_names ON idx = event_id % """
        + str(len(ERROR_NAMES))
        + ")"
    ).replace("WITH ", ", ", 1),
)
def retry_loop(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Failing records until they are done or dead: those of error events fail up to four times."""
    stream = events_stream(spark, sf_dir).select("event_id", "event_type", "timestamp")
    still = (F.col("event_type") == "error") & (F.col("attempt") <= F.col("event_id") % 5)

    def handle(df: DataFrame) -> DataFrame:
        return df.withColumn("error", F.when(still, error_name()))

    loop = RetryLoop(stream, handle, *paths(spark, "retry-loop"))
    ended = loop.finished(loop.run())
    return ended.select("event_id", "outcome", "attempt", F.unix_millis("timestamp").alias("due_ms"))


@query(
    "stream_dead_letter",
    with_log(
        """SELECT CASE WHEN json_valid(body) THEN 'main' ELSE 'dlt' END AS outcome, part AS "partition",
        off AS "offset", key, body AS value FROM log"""
    ),
)
def stream_dead_letter(spark: SparkSession, sf_dir: str) -> DataFrame:
    stream = events_stream(spark, sf_dir).select("partition", "offset", "key", F.col("body").alias("value"))
    path, checkpoint = paths(spark, "dlt")

    def outcome(df: DataFrame) -> DataFrame:
        return df.withColumn("outcome", F.when(not_json(), "dlt").otherwise("main"))

    runs.drain(stream.writeStream.foreachBatch(stream_ops.split_batches(path, outcome, "outcome")), checkpoint)
    return spark.read.parquet(path).select("outcome", "partition", "offset", "key", "value")


@query(
    "parallel_streams",
    with_log("SELECT topic, part AS \"partition\", off AS \"offset\", key FROM topics WHERE topic <> 'lineitem'", TOPICS.lstrip(",\n")),
)
def parallel_streams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two topics consumed at the same time by two queries with their own progress."""
    root, started = topics_store(spark, sf_dir), []
    for topic in ("orders", "events"):
        path, checkpoint = paths(spark, f"parallel-{topic}")
        stream = stream_log(spark, root, bytes_per_trigger=backlog_bytes(spark, root), topics=[topic])
        stream = stream.select("topic", "partition", "offset", "key")
        writer = stream.writeStream.format("parquet").option("path", path)
        started.append(
            (writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start(), path, stream.schema)
        )
    tables = []
    for running, path, schema in started:
        runs.finish(running)
        tables.append(spark.read.schema(schema).parquet(path))
    return tables[0].unionByName(tables[1])


@query(
    "stream_progress",
    "SELECT count(*) AS input_rows, 0::BIGINT AS backlog, true AS several_batches FROM events",
)
def stream_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every batch's report from a table that a listener writes: the rows read, and what was left after the last one."""
    stream = events_stream(spark, sf_dir).select("partition", "offset", "key")
    waiting = events_bounds(spark, sf_dir).agg(F.sum(F.col("end_offset") - F.col("begin_offset"))).first()[0]
    path, checkpoint = paths(spark, "progress")
    reports = ProgressTable(spark, fresh_dir(spark, "reports"))
    try:
        reports.wait(runs.drain(stream.writeStream.format("parquet").option("path", path), checkpoint))
    finally:
        reports.close()
    return backlog(reports.read(), waiting).agg(
        F.sum("input_rows").alias("input_rows"),
        F.min("backlog").alias("backlog"),
        (F.count("*") > 1).alias("several_batches"),
    )


@query("stream_static_enrich", ENRICH_SQL)
def stream_static_enrich(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = topics_store(spark, sf_dir)
    stream = stream_log(spark, root, "o_orderkey BIGINT", topics=["orders"])
    orders = stream.select("o_orderkey", F.col("key").cast("bigint").alias("o_custkey"))
    customers = known_customers(spark, sf_dir)
    enriched = joins.enrich_with_fallback(orders, customers, "o_custkey", "c_custkey", CUSTOMER_FALLBACK)
    return runs.appended_table(enriched.drop("o_custkey"), *paths(spark, "enriched"))


@query(
    "stream_event_counts",
    'SELECT event_type AS route, count(*) AS records FROM events GROUP BY 1',
)
def stream_event_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch operator applied to every micro-batch; the per-batch results are added up."""

    def per_batch(df: DataFrame) -> DataFrame:
        return df.groupBy(F.col("event_type").alias("route")).agg(F.count("*").alias("records"))

    path, checkpoint = paths(spark, "per-batch")
    runs.run_stream(events_stream(spark, sf_dir), per_batch, path, checkpoint)
    return spark.read.parquet(path).groupBy("route").agg(F.sum("records").alias("records"))
