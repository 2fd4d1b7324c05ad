"""Scan, seek, partitioning and ordering queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logflow.functions import partitioners
from logflow.functions.headers import header
from logflow.operators.offsets import (
    assign_offsets,
    commit_offsets,
    key_partition_map,
    order_violations,
)
from logflow.operators.slices import rank_by
from logflow.plans.base import (
    EVENT_EXTRAS,
    HASH,
    PARTITIONS,
    at,
    event_records,
    events_log,
    events_store,
    query,
    staged,
    table,
    with_log,
    with_rec,
)
from logflow.records import as_records, describe, record_metadata
from logflow.scratch import fresh_dir, materialize
from logflow.sinks.commits import CommitLog
from logflow.sinks.log import append
from logflow.sources.log import (
    backlog_bytes,
    bounds,
    first_k,
    from_positions,
    group_positions,
    polls,
    resume,
    scan,
    seek,
    seek_beginning,
    seek_end,
    skip_offsets,
    store_bounds,
    stream_log,
)
from logflow.streaming.runs import appended_table

# --- stores and commits shared by several queries ---------------------------------------------


def order_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    value = F.concat_ws(" ", "o_orderstatus", F.col("o_orderkey").cast("string"))
    records = as_records(
        orders, "orders", F.col("o_custkey"), value, F.col("o_orderdate"), keep=["o_orderkey", "o_custkey"]
    )
    return records.withColumn("partition", partitioners.by_key(PARTITIONS))


LINE_ORDER = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


def lineitem_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "lineitem")
    value = F.concat_ws(":", *[F.col(c).cast("string") for c in ["l_linenumber", "l_partkey", "l_suppkey"]])
    lines = as_records(items, "lineitem", F.col("l_orderkey"), value, F.col("l_shipdate"), keep=LINE_ORDER)
    return lines.withColumn("partition", partitioners.by_key(PARTITIONS))


def topics_store(spark: SparkSession, sf_dir: str) -> str:
    """A store with three topics: orders, lineitem and events."""

    def build(path: str) -> None:
        append(order_records(spark, sf_dir).drop("o_custkey"), path, ["o_orderkey"])
        append(lineitem_records(spark, sf_dir), path, LINE_ORDER)
        append(event_records(spark, sf_dir), path, ["event_id"])

    return staged(spark, sf_dir, "topics", build)


TOPICS = f""",
orders_log AS (
  SELECT 'orders' AS topic, part, row_number() OVER (PARTITION BY part ORDER BY o_orderkey) - 1 AS off,
    key, value, o_orderkey
  FROM (SELECT *, o_custkey::VARCHAR AS key, {HASH.format("o_custkey::VARCHAR")} AS part,
          o_orderstatus || ' ' || o_orderkey AS value FROM orders)
),
lineitem_log AS (
  SELECT 'lineitem' AS topic, part,
    row_number() OVER (PARTITION BY part ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey) - 1 AS off,
    key, value
  FROM (SELECT *, l_orderkey::VARCHAR AS key, {HASH.format("l_orderkey::VARCHAR")} AS part,
          l_linenumber || ':' || l_partkey || ':' || l_suppkey AS value FROM lineitem)
),
topics AS (
  SELECT topic, part, off, key, value FROM orders_log
  UNION ALL SELECT topic, part, off, key, value FROM lineitem_log
  UNION ALL SELECT topic, part, off, key, value FROM log
)"""

SUBSCRIBED_AT = "2024-01-20 00:00:00"
AUDITED_UNTIL = "2024-01-10 00:00:00"


def commit_log(spark: SparkSession, sf_dir: str) -> CommitLog:
    """Progress of two groups: ``billing`` read up to 20 January; ``audit`` did, too, and was then set back to 10
    January, and never read partition 3."""

    def build(path: str) -> None:
        log, saved = events_log(spark, sf_dir), CommitLog(spark, path)
        before = log.where(F.col("timestamp") < at(SUBSCRIBED_AT))
        saved.append(commit_offsets(before, "billing"))
        saved.append(commit_offsets(before.where(F.col("partition") != 3), "audit"))
        audited = log.where((F.col("timestamp") < at(AUDITED_UNTIL)) & (F.col("partition") != 3))
        saved.append(commit_offsets(audited, "audit"))

    return CommitLog(spark, staged(spark, sf_dir, "commits", build))


def commits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return commit_log(spark, sf_dir).read()


def events_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return store_bounds(spark, events_store(spark, sf_dir))


COMMITS = f"""
commits AS (
  SELECT 'billing' AS grp, part, max(off) + 1 AS committed FROM log
  WHERE ts < TIMESTAMP '{SUBSCRIBED_AT}' GROUP BY part
  UNION ALL
  SELECT 'audit' AS grp, part, max(off) + 1 AS committed FROM log
  WHERE ts < TIMESTAMP '{AUDITED_UNTIL}' AND part <> 3 GROUP BY part
)"""

BOUNDS = """
bounds AS (SELECT part, min(off) AS b, max(off) + 1 AS e FROM log GROUP BY part)"""

RECORD = ["topic", "partition", "offset", "key", "value"]
RECORD_SQL = 'topic, part AS "partition", off AS "offset", key, value'


# --- scans ------------------------------------------------------------------------------------


@query("log_scan", with_log(f"SELECT {RECORD_SQL} FROM log"))
def log_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(spark, events_store(spark, sf_dir), ["events"]).select(*RECORD)


@query("log_scan_multi", with_log(f"SELECT {RECORD_SQL} FROM topics", TOPICS.lstrip(",\n")))
def log_scan_multi(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(spark, topics_store(spark, sf_dir), ["orders", "lineitem", "events"]).select(*RECORD)


@query(
    "log_scan_pattern",
    with_log(
        f"SELECT {RECORD_SQL} FROM topics WHERE regexp_full_match(topic, 'ord.*|ev.*')",
        TOPICS.lstrip(",\n"),
    ),
)
def log_scan_pattern(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(spark, topics_store(spark, sf_dir), pattern="ord.*|ev.*").select(*RECORD)


@query("log_scan_partition", with_log(f"SELECT {RECORD_SQL} FROM log WHERE part IN (1, 3)"))
def log_scan_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(spark, events_store(spark, sf_dir), ["events"], partitions=[1, 3]).select(*RECORD)


@query("log_seek_offset", with_log(f"SELECT {RECORD_SQL} FROM log WHERE part = 2 AND off >= 5"))
def log_seek_offset(spark: SparkSession, sf_dir: str) -> DataFrame:
    return seek(events_log(spark, sf_dir), partition=2, offset=5).select(*RECORD)


@query("log_seek_beginning", with_log(f"SELECT {RECORD_SQL} FROM log WHERE off < 3"))
def log_seek_beginning(spark: SparkSession, sf_dir: str) -> DataFrame:
    return first_k(seek_beginning(events_log(spark, sf_dir), events_bounds(spark, sf_dir)), 3).select(*RECORD)


@query(
    "log_seek_end",
    with_log(
        'SELECT part AS "partition", e AS end_offset, 0::BIGINT AS records_after_end FROM bounds', BOUNDS
    ),
)
def log_seek_end(spark: SparkSession, sf_dir: str) -> DataFrame:
    log, known = events_log(spark, sf_dir), events_bounds(spark, sf_dir)
    after = seek_end(log, known).groupBy("topic", "partition").agg(F.count("*").alias("_n"))
    return known.join(after, ["topic", "partition"], "left").select(
        "partition", "end_offset", F.coalesce("_n", F.lit(0)).alias("records_after_end")
    )


@query(
    "offset_reset",
    with_log(
        """
    SELECT grp AS consumer_group, policy, l.part AS "partition", count(*) AS records,
      min(l.off) AS first_offset
    FROM (SELECT g.grp, p.policy, b.part, coalesce(c.committed,
            CASE p.policy WHEN 'earliest' THEN b.b ELSE coalesce(s.e, 0) END) AS start
          FROM (VALUES ('audit'), ('newcomer')) g(grp)
          CROSS JOIN (VALUES ('earliest'), ('latest')) p(policy)
          CROSS JOIN bounds b
          LEFT JOIN commits c ON c.grp = g.grp AND c.part = b.part
          LEFT JOIN subscribed s ON s.part = b.part) st
    JOIN log l ON l.part = st.part AND l.off >= st.start
    GROUP BY ALL""",
        BOUNDS,
        COMMITS,
        f"""subscribed AS (SELECT part, max(off) + 1 AS e FROM log
          WHERE ts < TIMESTAMP '{SUBSCRIBED_AT}' GROUP BY part)""",
    ),
)
def offset_reset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four subscriptions, one scan: the positions of all of them are joined to the log at once."""
    log, saved = events_log(spark, sf_dir), commits(spark, sf_dir)
    subscribed = bounds(log.where(F.col("timestamp") < at(SUBSCRIBED_AT)))
    asked = [(group, policy) for group in ("audit", "newcomer") for policy in ("earliest", "latest")]
    known = events_bounds(spark, sf_dir)
    starts = materialize(group_positions(known, saved, asked, subscribed), "starts")
    least = from_positions(log, starts, known).select("topic", "partition", "offset")
    read = least.join(starts, ["topic", "partition"]).where(F.col("offset") >= F.col("start"))
    return read.groupBy("consumer_group", "policy", "partition").agg(
        F.count("*").alias("records"), F.min("offset").alias("first_offset")
    )


@query(
    "resume_from_committed",
    with_log(
        f"""SELECT {RECORD_SQL.replace("part AS", "l.part AS")} FROM log l
        LEFT JOIN commits c ON c.grp = 'audit' AND c.part = l.part
        WHERE off >= coalesce(committed, 0)""",
        COMMITS,
    ),
)
def resume_from_committed(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = events_bounds(spark, sf_dir)
    return resume(events_log(spark, sf_dir), commits(spark, sf_dir), "audit", known=known).select(*RECORD)


@query(
    "bounded_poll",
    with_log('SELECT part AS "partition", off // 500 AS poll, count(*) AS records FROM log GROUP BY ALL'),
)
def bounded_poll(spark: SparkSession, sf_dir: str) -> DataFrame:
    polled = polls(events_log(spark, sf_dir).select("topic", "partition", "offset"), 500)
    return polled.groupBy("partition", "poll").agg(F.count("*").alias("records"))


@query(
    "skip_poison_offset",
    with_log('SELECT part AS "partition", off AS "offset", key FROM log WHERE json_valid(body)'),
)
def skip_poison_offset(spark: SparkSession, sf_dir: str) -> DataFrame:
    from logflow.functions.parsing import is_json

    log = events_log(spark, sf_dir)
    poison = log.where(~is_json("body"))
    return skip_offsets(log.select("topic", "partition", "offset", "key"), poison).drop("topic")


@query(
    "record_metadata",
    with_log(
        """SELECT topic, part AS "partition", off AS "offset", (epoch_us(ts) // 1000) AS ts_ms,
        CASE WHEN event_id % 11 <> 0 THEN strlen(key) ELSE -1 END AS key_size, strlen(value) AS value_size
        FROM log"""
    ),
)
def record_metadata_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = events_log(spark, sf_dir).withColumn("key", F.when(F.col("event_id") % 11 != 0, F.col("key")))
    sizes = record_metadata(log).withColumn("ts_ms", F.unix_millis("timestamp")).drop("timestamp")
    return sizes.withColumn("key_size", F.coalesce("key_size", F.lit(-1)))  # -1 shows "no key"


@query(
    "headers_extract",
    with_log(
        """SELECT part AS "partition", off AS "offset", 'corr-' || event_id AS correlation_id,
        'events' AS source,
        CASE WHEN event_id % 5 <> 0 THEN CASE WHEN event_id % 2 = 0 THEN 'high' ELSE 'normal' END END
          AS priority,
        NULL::VARCHAR AS tenant FROM log"""
    ),
)
def headers_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events_log(spark, sf_dir).select(
        "partition",
        "offset",
        header("correlation-id").alias("correlation_id"),
        header("source").alias("source"),
        header("priority").alias("priority"),
        header("tenant").alias("tenant"),
    )


@query(
    "record_describe",
    with_log(
        """SELECT part AS "partition", off AS "offset", value || ' | Topic: ' || topic || ' | Partition: '
        || part || ' | Offset: ' || off AS description FROM log"""
    ),
)
def record_describe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events_log(spark, sf_dir).select("partition", "offset", describe().alias("description"))


@query("stream_log_scan", with_log(f"SELECT {RECORD_SQL} FROM log"))
def stream_log_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = events_store(spark, sf_dir)
    stream = stream_log(spark, root, EVENT_EXTRAS, bytes_per_trigger=backlog_bytes(spark, root)).select(*RECORD)
    return appended_table(stream, fresh_dir(spark, "scan"), fresh_dir(spark, "scan-ckpt"))


@query("first_k_per_partition", with_log(
    'SELECT topic, part AS "partition", off AS "offset", key FROM topics WHERE off < 3', TOPICS.lstrip(",\n")
))
def first_k_per_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    return first_k(scan(spark, topics_store(spark, sf_dir)), 3).select("topic", "partition", "offset", "key")


@query("union_topics", with_log(
    "SELECT topic, key, value FROM topics", TOPICS.lstrip(",\n")
))
def union_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    shape = ["topic", "key", "value"]
    orders = order_records(spark, sf_dir).select(*shape)
    both = orders.unionByName(event_records(spark, sf_dir).select(*shape))
    return both.unionByName(lineitem_records(spark, sf_dir).select(*shape))


# --- partitioning and order -------------------------------------------------------------------


@query("partition_by_key", with_rec('SELECT event_id, key, part AS "partition" FROM rec'))
def partition_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_records(spark, sf_dir).select("event_id", "key", "partition")


@query(
    "partition_round_robin",
    """SELECT o_orderkey, ((row_number() OVER (ORDER BY o_orderkey) - 1) % 4)::INTEGER AS partition_even,
    (((row_number() OVER (ORDER BY o_orderkey) - 1) // 16) % 4)::INTEGER AS partition_sticky FROM orders""",
)
def partition_round_robin(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey")
    position = F.col("_position")
    return rank_by(orders, [], ["o_orderkey"], "_position").select(
        "o_orderkey",
        partitioners.turn(position, PARTITIONS).alias("partition_even"),
        partitioners.turn(position, PARTITIONS, batch=16).alias("partition_sticky"),
    )


@query("partition_explicit", 'SELECT event_id, (event_id % 4)::INTEGER AS "partition" FROM events')
def partition_explicit(spark: SparkSession, sf_dir: str) -> DataFrame:
    chosen = table(spark, sf_dir, "events").select("event_id", (F.col("event_id") % 4).alias("_chosen"))
    return chosen.select("event_id", partitioners.explicit(PARTITIONS, "_chosen").alias("partition"))


@query(
    "partition_by_region",
    """SELECT o_orderkey,
      CASE o_orderkey % 5 WHEN 0 THEN 0 WHEN 1 THEN 1 WHEN 2 THEN 2 ELSE 3 END AS partition_of_4,
      CASE o_orderkey % 5 WHEN 0 THEN 0 WHEN 1 THEN 1 WHEN 2 THEN 0 ELSE 1 END AS partition_of_2
    FROM orders""",
)
def partition_by_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("o_orderkey") % 5
    prefix = (
        F.when(kind == 0, "US-").when(kind == 1, "EU-").when(kind == 2, "APAC-").when(kind == 3, "LATAM-")
    )
    keyed = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.concat(prefix, F.col("o_orderkey").cast("string")).alias("key")
    )
    return keyed.select(
        "o_orderkey",
        partitioners.by_region(4).alias("partition_of_4"),
        partitioners.by_region(2).alias("partition_of_2"),
    )


@query("assign_offsets", with_log('SELECT event_id, part AS "partition", off AS "offset" FROM log'))
def assign_offsets_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = event_records(spark, sf_dir).select("topic", "partition", "event_id")
    return assign_offsets(records, ["event_id"]).drop("topic")


@query("per_key_order", with_rec("SELECT key, count(*) AS records, 0::BIGINT AS violations FROM rec GROUP BY key"))
def per_key_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_violations(events_log(spark, sf_dir), "event_id")


@query(
    "partition_distribution",
    with_rec('SELECT part AS "partition", count(*) AS records FROM rec GROUP BY part'),
)
def partition_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_records(spark, sf_dir).groupBy("partition").agg(F.count("*").alias("records"))


@query(
    "key_partition_map",
    with_rec(
        """SELECT key, min(part) AS "partition", count(DISTINCT part) > 1 AS violation
        FROM rec GROUP BY key"""
    ),
)
def key_partition_map_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return key_partition_map(event_records(spark, sf_dir))


@query(
    "partitions_read",
    with_rec(
        """SELECT event_type AS reader, string_agg(DISTINCT part::VARCHAR, ',' ORDER BY part::VARCHAR)
        AS partitions FROM rec GROUP BY event_type"""
    ),
)
def partitions_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_records(spark, sf_dir).groupBy(F.col("event_type").alias("reader")).agg(
        F.array_join(F.array_sort(F.collect_set("partition")), ",").alias("partitions")
    )
