"""Query registry, the driver tables seen as logs, and log stores staged once per session."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logflow.functions import partitioners
from logflow.functions.headers import make_headers
from logflow.functions.parsing import text_record
from logflow.records import as_records
from logflow.scratch import fresh_dir
from logflow.session import configure
from logflow.sinks.log import append
from logflow.sources.log import read_log

Run = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Run] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Run], Run]:
    """Register a query and, where SQL can say the same, its check."""

    def register(fn: Run) -> Run:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(configure(spark), sf_dir)

        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_staged: dict[tuple[str, str, str], str] = {}


def staged(spark: SparkSession, sf_dir: str, label: str, build: Callable[[str], None]) -> str:
    """Path of a store derived from the tables, written once per session."""
    key = (spark.sparkContext.applicationId, sf_dir, label)
    if key not in _staged:
        path = fresh_dir(spark, label)
        build(path)
        _staged[key] = path
    return _staged[key]


def at(instant: str) -> Column:
    return F.lit(instant).cast("timestamp")


def day_text(c: Column | str, pattern: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    return F.date_format(c, pattern)


PARTITIONS = 4
EVENT_EXTRAS = "event_id BIGINT, event_type STRING, num DOUBLE, props STRING, body STRING"
EXTRA_NAMES = ["event_id", "event_type", "num", "props", "body"]


def action() -> Column:
    t = F.col("event_type")
    return (
        F.when(t == "purchase", "ORDER")
        .when(t == "error", "REFUND")
        .when(t == "signup", "DELIVERY")
        .otherwise("PAYMENT")
    )


def event_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as produced records on four partitions, keyed by user, valued ``ACTION:amount``.

    ``body`` is the JSON text of the event; every tenth one is cut short and no longer parses.
    """
    cut = F.expr("substr(props, 1, length(props) - 1)")
    events = table(spark, sf_dir, "events").select(
        "*",
        F.col("value").alias("num"),
        F.when(F.col("event_id") % 10 == 0, cut).otherwise(F.col("props")).alias("body"),
    )
    amount = F.when(F.col("event_type") == "signup", "complete").otherwise(
        F.floor("num").cast("string")
    )
    records = as_records(
        events,
        "events",
        key=F.col("user_id"),
        value=F.concat(action(), F.lit(":"), amount),
        timestamp=F.col("ts"),
        headers=make_headers(
            correlation_id=F.concat(F.lit("corr-"), F.col("event_id")),
            source=F.lit("events"),
            priority=F.when(
                F.col("event_id") % 5 != 0,
                F.when(F.col("event_id") % 2 == 0, "high").otherwise("normal"),
            ),
        ),
        keep=EXTRA_NAMES,
    )
    return records.withColumn("partition", partitioners.by_key(PARTITIONS))


def events_store(spark: SparkSession, sf_dir: str) -> str:
    return staged(
        spark, sf_dir, "events-log", lambda path: append(event_records(spark, sf_dir), path, ["event_id"])
    )


def events_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events as a stored log with offsets."""
    return read_log(spark, events_store(spark, sf_dir), EVENT_EXTRAS)


def text_value() -> Column:
    """A typed text record made of an event's columns."""
    t = F.col("event_type")
    kind = F.when(t == "purchase", "ORDER").when(t == "error", "ALERT").otherwise("NOTIFICATION")
    home = F.pmod(F.col("event_id"), F.lit(3))
    region = F.when(home == 0, "US").when(home == 1, "EU").otherwise("ASIA")
    return text_record(kind, region, F.col("event_id"), F.unix_millis("timestamp"))


# --- the same views for the SQL check ---------------------------------------------------------

HASH = "(('0x' || substr(md5({0}), 1, 8))::BIGINT % 4)::INTEGER"

REC = f"""
rec AS (
  SELECT 'events' AS topic, user_id::VARCHAR AS key,
    {HASH.format("user_id::VARCHAR")} AS part,
    CASE event_type WHEN 'purchase' THEN 'ORDER' WHEN 'error' THEN 'REFUND'
      WHEN 'signup' THEN 'DELIVERY' ELSE 'PAYMENT' END AS action,
    CASE WHEN event_type = 'signup' THEN 'complete' ELSE floor(value)::BIGINT::VARCHAR END AS amount_text,
    CASE WHEN event_type = 'signup' THEN 0 ELSE floor(value)::BIGINT END AS amount,
    ts, event_id, user_id, event_type, value AS num, props,
    CASE WHEN event_id % 10 = 0 THEN substr(props, 1, length(props) - 1) ELSE props END AS body,
    '[' || CASE event_type WHEN 'purchase' THEN 'ORDER' WHEN 'error' THEN 'ALERT' ELSE 'NOTIFICATION' END
      || '] Region: ' || CASE event_id % 3 WHEN 0 THEN 'US' WHEN 1 THEN 'EU' ELSE 'ASIA' END
      || ' | Message #' || event_id || ' | Timestamp: ' || (epoch_us(ts) // 1000) AS txt
  FROM events
)"""

LOG = (
    REC
    + """,
log AS (
  SELECT *, action || ':' || amount_text AS value,
    row_number() OVER (PARTITION BY part ORDER BY event_id) - 1 AS off
  FROM rec
)"""
)


def with_rec(sql: str) -> str:
    return f"WITH {REC}\n{sql}"


def with_log(sql: str, *more: str) -> str:
    return "WITH " + ",\n".join([LOG, *more]) + "\n" + sql
