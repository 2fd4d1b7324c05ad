"""Joins, aggregates, windows, event sourcing and schema queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logflow.functions import payloads
from logflow.functions.parsing import is_json, parse_action
from logflow.operators import eventsourcing as es
from logflow.operators import joins, metrics, routing, schemas, windows
from logflow.operators.offsets import consumer_lag, lag_bands, lag_summary, lag_trend
from logflow.operators.slices import running_totals
from logflow.plans.base import at, event_records, events_log, query, staged, table, with_log, with_rec
from logflow.plans.scans import BOUNDS, COMMITS, TOPICS, commits, events_bounds, topics_store
from logflow.sinks.schemas import SchemaStore
from logflow.sources.log import scan

# --- joins ------------------------------------------------------------------------------------

ENRICH_SQL = """SELECT o_orderkey, coalesce(c_name, 'Unknown') AS c_name,
  coalesce(c_mktsegment, 'Unknown') AS c_mktsegment
  FROM orders LEFT JOIN (SELECT * FROM customer WHERE c_custkey % 10 <> 0) ON o_custkey = c_custkey"""

CUSTOMER_FALLBACK = {"c_name": "Unknown", "c_mktsegment": "Unknown"}


def known_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").where(F.col("c_custkey") % 10 != 0)


@query("enrich_with_fallback", ENRICH_SQL)
def enrich_with_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    customers = known_customers(spark, sf_dir)
    enriched = joins.enrich_with_fallback(orders, customers, "o_custkey", "c_custkey", CUSTOMER_FALLBACK)
    return enriched.drop("o_custkey")


def _batch_and_seen(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    events = table(spark, sf_dir, "events").select("event_id", "user_id")
    return events, events.where(F.col("event_id") % 3 == 0)


@query("dedup_against_log", "SELECT event_id, user_id FROM events WHERE event_id % 3 <> 0")
def dedup_against_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return joins.not_seen(*_batch_and_seen(spark, sf_dir), "event_id")


@query("duplicates_seen", "SELECT event_id, user_id FROM events WHERE event_id % 3 = 0")
def duplicates_seen(spark: SparkSession, sf_dir: str) -> DataFrame:
    return joins.already_seen(*_batch_and_seen(spark, sf_dir), "event_id")


GROUPS = ["billing", "audit", "newcomer"]

LAGS = """
lags AS (SELECT g.grp AS consumer_group, 'events' AS topic, b.part AS part, b.e AS end_offset,
    coalesce(c.committed, b.b) AS committed, b.e - coalesce(c.committed, b.b) AS lag
  FROM (VALUES ('billing'), ('audit'), ('newcomer')) g(grp) CROSS JOIN bounds b
  LEFT JOIN commits c ON c.grp = g.grp AND c.part = b.part)"""


def lags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return consumer_lag(events_bounds(spark, sf_dir), commits(spark, sf_dir), *GROUPS)


@query(
    "consumer_lag",
    with_log(
        'SELECT consumer_group, topic, part AS "partition", end_offset, committed, lag FROM lags',
        BOUNDS,
        COMMITS,
        LAGS,
    ),
)
def consumer_lag_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lags(spark, sf_dir)


@query(
    "lag_band",
    with_log(
        """SELECT consumer_group, part AS "partition", lag, CASE WHEN lag < 1000 THEN 'none'
        WHEN lag < 10000 THEN 'monitor' WHEN lag <= 100000 THEN 'scale soon' ELSE 'emergency' END AS action
        FROM lags""",
        BOUNDS,
        COMMITS,
        LAGS,
    ),
)
def lag_band(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lag_bands(lags(spark, sf_dir)).select("consumer_group", "partition", "lag", "action")


@query(
    "lag_summary",
    with_log(
        """SELECT consumer_group, sum(lag)::BIGINT AS total_lag, max(lag) AS max_lag,
        arg_max(part, lag * 1000 - part) AS worst_partition FROM lags GROUP BY consumer_group""",
        BOUNDS,
        COMMITS,
        LAGS,
    ),
)
def lag_summary_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lag_summary(lags(spark, sf_dir))


# --- aggregates -------------------------------------------------------------------------------


@query(
    "topic_counts",
    with_log("SELECT topic, count(*) AS records FROM topics GROUP BY topic", TOPICS.lstrip(",\n")),
)
def topic_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.count_by(scan(spark, topics_store(spark, sf_dir)), "topic")


@query(
    "running_batch_aggregates",
    """SELECT batch, (sum(n) OVER w)::BIGINT AS "count", (sum(s) OVER w)::BIGINT AS "sum",
      round((sum(s) OVER w)::DOUBLE / (sum(n) OVER w), 6) AS "avg"
    FROM (SELECT event_id // 500 AS batch, count(*) AS n, sum(floor(value)::BIGINT) AS s
          FROM events GROUP BY 1) WINDOW w AS (ORDER BY batch)""",
)
def running_batch_aggregates(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select(F.expr("event_id div 500").alias("batch"), "value")
    running = metrics.running_batch_aggregates(events, "batch", F.floor("value"))
    return running.withColumn("avg", F.round("avg", 6))


@query(
    "count_by_value",
    with_rec("SELECT action || ':' || amount_text AS value, count(*) AS records FROM rec GROUP BY 1"),
)
def count_by_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.count_by(event_records(spark, sf_dir), "value")


BALANCES_SQL = with_rec(
    """SELECT key, sum(CASE action WHEN 'ORDER' THEN amount WHEN 'REFUND' THEN -amount ELSE 0 END)::BIGINT
    AS balance FROM rec GROUP BY key"""
)


@query("user_balances", BALANCES_SQL)
def user_balances(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = parse_action(event_records(spark, sf_dir))
    return metrics.user_balances(parsed.where(F.col("error").isNull()))


def sends(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Send outcomes: every seventh send failed; the latency is derived from the id."""
    return event_records(spark, sf_dir).withColumns(
        {
            "failed": F.col("event_id") % 7 == 0,
            "latency_ms": F.col("event_id") * 37 % 500,
        }
    )


@query(
    "send_metrics",
    with_rec(
        """SELECT event_type, count(*) AS sent, count(*) FILTER (event_id % 7 <> 0) AS success,
        count(*) FILTER (event_id % 7 = 0) AS failed,
        sum(strlen(key) + strlen(action || ':' || amount_text))::BIGINT AS total_bytes,
        min(greatest(1, event_id * 37 % 500)) FILTER (event_id % 7 <> 0) AS min_latency_ms,
        max(greatest(1, event_id * 37 % 500)) FILTER (event_id % 7 <> 0) AS max_latency_ms,
        round(count(*) FILTER (event_id % 7 <> 0) * 100.0::DOUBLE / count(*), 1) AS success_pct,
        (sum(greatest(1, event_id * 37 % 500)) FILTER (event_id % 7 <> 0)
          // count(*) FILTER (event_id % 7 <> 0))::BIGINT AS avg_latency_ms
        FROM rec GROUP BY event_type"""
    ),
)
def send_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.send_metrics(sends(spark, sf_dir), "event_type")


@query(
    "outcome_summary",
    """SELECT user_id, count(*) FILTER (NOT contains(event_type, 'error')) AS succeeded,
    count(*) FILTER (contains(event_type, 'error')) AS failed FROM events GROUP BY user_id""",
)
def outcome_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    return metrics.outcome_summary(events, F.col("event_type").contains("error"), "user_id")


@query(
    "error_rate_alerts",
    """SELECT strftime(date_trunc('minute', ts), '%Y-%m-%d %H:%M') AS "minute", count(*) AS records,
      count(*) FILTER (event_type = 'error') AS dlt_records,
      round(count(*) FILTER (event_type = 'error') * 100.0::DOUBLE / count(*), 6) AS error_pct,
      count(*) FILTER (event_type = 'error') * 100.0 / count(*) > 1 AS alert,
      count(*) FILTER (event_type = 'error') * 100.0 / count(*) > 5 AS page,
      count(*) FILTER (event_type = 'error') > 100 AS escalate
    FROM events GROUP BY 1""",
)
def error_rate_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    alerts = metrics.error_rate_alerts(events, F.col("event_type") == "error", "ts")
    return alerts.withColumns(
        {"minute": F.date_format("minute", "yyyy-MM-dd HH:mm"), "error_pct": F.round("error_pct", 6)}
    )


@query(
    "throughput_stats",
    with_rec(
        """SELECT event_type, records, bytes, duration_ms,
        round(records * 1000.0::DOUBLE / duration_ms, 9) AS records_per_sec,
        round(bytes::DOUBLE / duration_ms / 1000.0::DOUBLE, 12) AS mb_per_sec,
        round(duration_ms::DOUBLE / records, 6) AS mean_gap_ms
        FROM (SELECT event_type, count(*) AS records, sum(strlen(props))::BIGINT AS bytes,
            max(epoch_us(ts) // 1000) - min(epoch_us(ts) // 1000) AS duration_ms FROM rec GROUP BY 1)"""
    ),
)
def throughput_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = event_records(spark, sf_dir).select(
        "event_type",
        F.unix_millis("timestamp").alias("ts_ms"),
        F.octet_length("props").cast("bigint").alias("size"),
    )
    stats = metrics.throughput(rows, "event_type")
    return stats.withColumns(
        {
            "records_per_sec": F.round("records_per_sec", 9),
            "mb_per_sec": F.round("mb_per_sec", 12),
            "mean_gap_ms": F.round("mean_gap_ms", 6),
        }
    )


@query(
    "latency_percentiles",
    """SELECT event_type, count(*) AS n, round(quantile_cont(event_id * 37 % 500, 0.5), 6) AS p50,
    round(quantile_cont(event_id * 37 % 500, 0.95), 6) AS p95,
    round(quantile_cont(event_id * 37 % 500, 0.99), 6) AS p99 FROM events GROUP BY event_type""",
)
def latency_percentiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    exact = metrics.latency_percentiles(sends(spark, sf_dir), "event_type")
    return exact.withColumns({p: F.round(p, 6) for p in ("p50", "p95", "p99")})


ROUTE_SQL = "CASE event_type WHEN 'error' THEN 'errors' WHEN 'purchase' THEN 'analytics' ELSE 'info' END"


def routed(df: DataFrame) -> DataFrame:
    t = F.col("event_type")
    return routing.route(df, [(t == "error", "errors"), (t == "purchase", "analytics")], "info")


@query("route_counts", f"SELECT {ROUTE_SQL} AS route, count(*) AS records FROM events GROUP BY 1")
def route_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return routing.route_counts(routed(table(spark, sf_dir, "events")))


@query(
    "capacity_plan",
    """SELECT event_type, rate, 300 AS per_consumer, ceil(rate / 300.0)::BIGINT AS required,
      ceil(ceil(rate / 300.0) * 130 / 100.0)::BIGINT AS reserved,
      ceil(ceil(rate / 300.0) * 130 / 100.0)::BIGINT AS min_partitions
    FROM (SELECT event_type, count(*) AS rate FROM events GROUP BY 1)""",
)
def capacity_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    rates = table(spark, sf_dir, "events").groupBy("event_type").agg(F.count("*").alias("rate"))
    return metrics.capacity_plan(rates.withColumn("per_consumer", F.lit(300)))


@query(
    "stability_metrics",
    """SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H') AS hour, count(*) AS events,
      sum(event_id * 13 % 40000)::BIGINT AS total_ms, max(event_id * 13 % 40000) AS max_ms,
      epoch_us(TIMESTAMP '2024-02-01') // 1000 - epoch_us(max(ts)) // 1000 AS since_last_ms,
      count(*) > 1 AS unstable
    FROM events WHERE event_type = 'error' GROUP BY 1""",
)
def stability_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    watched = table(spark, sf_dir, "events").where(F.col("event_type") == "error").select(
        F.col("ts").cast("timestamp").alias("timestamp"),
        (F.col("event_id") * 13 % 40000).alias("duration_ms"),
    )
    stats = metrics.stability(watched, F.unix_millis(at("2024-02-01")))
    return stats.withColumn("hour", F.date_format("hour", "yyyy-MM-dd HH"))


@query(
    "health_status",
    with_log(
        """SELECT part AS "partition", lag,
        epoch_us(TIMESTAMP '2024-01-20') // 1000 - last_poll < 600000 AS alive,
        part <> 1 AND lag < 2000 AND error_rate < 0.21 AS ready
        FROM lags JOIN (SELECT part, max(epoch_us(ts) // 1000) AS last_poll,
            count(*) FILTER (event_type = 'error') / count(*)::DOUBLE AS error_rate
          FROM log WHERE ts < TIMESTAMP '2024-01-20' GROUP BY part) USING (part)
        WHERE consumer_group = 'billing'""",
        BOUNDS,
        COMMITS,
        LAGS,
    ),
)
def health_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    log, saved = events_log(spark, sf_dir), commits(spark, sf_dir)
    polled = log.where(F.col("timestamp") < at("2024-01-20")).groupBy("topic", "partition").agg(
        F.unix_millis(F.max("timestamp")).alias("last_poll_ms"),
        (F.count_if(F.col("event_type") == "error") / F.count("*")).alias("error_rate"),
    )
    progress = consumer_lag(events_bounds(spark, sf_dir), saved, "billing").join(polled, ["topic", "partition"])
    progress = progress.withColumn("rebalancing", F.col("partition") == 1)
    checked = metrics.health(progress, F.unix_millis(at("2024-01-20")), 2000, 0.21, max_idle_ms=600_000)
    return checked.select("partition", "lag", "alive", "ready")


@query(
    "distinct_keys",
    with_rec('SELECT part AS "partition", count(DISTINCT key) AS distinct_keys FROM rec GROUP BY part'),
)
def distinct_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.distinct_keys(event_records(spark, sf_dir), "partition")


@query(
    "dlt_breakdown",
    with_rec(
        """SELECT strftime(m, '%Y-%m-%d %H:%M') AS "minute", 'not_json' AS error, dlt_records, input_records,
        round(dlt_records / input_records::DOUBLE, 6) AS share,
        strftime(oldest, '%Y-%m-%d %H:%M:%S.%f') AS oldest
        FROM (SELECT date_trunc('minute', ts) AS m, count(*) AS input_records,
            count(*) FILTER (NOT json_valid(body)) AS dlt_records,
            min(ts) FILTER (NOT json_valid(body)) AS oldest FROM rec GROUP BY 1) WHERE dlt_records > 0"""
    ),
)
def dlt_breakdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = event_records(spark, sf_dir).withColumn("error", F.when(~is_json("body"), "not_json"))
    found = metrics.dlt_breakdown(records.select("timestamp", "error"))
    return found.withColumns(
        {
            "minute": F.date_format("minute", "yyyy-MM-dd HH:mm"),
            "share": F.round("share", 6),
            "oldest": F.date_format("oldest", "yyyy-MM-dd HH:mm:ss.SSSSSS"),
        }
    )


# --- windows ----------------------------------------------------------------------------------

TREND = """
steps AS (SELECT epoch_us(date_trunc('minute', ts)) // 60000000 AS at_minute,
    date_trunc('day', ts) AS day, count(*) FILTER (event_type <> 'signup') AS n FROM events GROUP BY 1, 2),
lag_at AS (SELECT at_minute, (sum(n) OVER (PARTITION BY day ORDER BY at_minute))::BIGINT AS lag FROM steps),
stepped AS (SELECT *, lag - lag(lag) OVER (ORDER BY at_minute) AS step FROM lag_at)"""


@query(
    "lag_trend",
    f"""WITH {TREND} SELECT at_minute AS minute, lag,
      CASE WHEN lag = 0 THEN 'zero' WHEN step > 0 THEN 'growing' WHEN step < 0 THEN 'shrinking'
        ELSE 'stable' END AS trend,
      coalesce(min(step) OVER w > 0 AND count(step) OVER w = 5, false) AS growing_alert
    FROM stepped WINDOW w AS (ORDER BY at_minute ROWS 4 PRECEDING)""",
)
def lag_trend_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A group that commits once a day: its lag grows through the day and falls at midnight."""
    per_minute = (
        table(spark, sf_dir, "events")
        .groupBy(
            F.expr("unix_seconds(CAST(ts AS TIMESTAMP)) div 60").alias("minute"),
            F.to_date("ts").alias("day"),
        )
        .agg(F.count_if(F.col("event_type") != "signup").alias("_n"))
    )
    behind = running_totals(per_minute, ["day"], ["minute"], {"lag": F.col("_n")})
    return lag_trend(behind.select("minute", "lag"))


@query(
    "count_window",
    with_log(
        """SELECT event_id, key, count(*) OVER w AS records, (sum(amount) OVER w)::BIGINT AS amount
        FROM log WINDOW w AS (PARTITION BY key ORDER BY off ROWS 4 PRECEDING)"""
    ),
)
def count_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    amount = F.when(F.col("event_type") == "signup", 0).otherwise(F.floor("num"))
    log = events_log(spark, sf_dir).select("event_id", "key", "offset", amount.alias("_amount"))
    windowed = windows.count_window(
        log, ["key"], ["offset"], 5, {"records": F.count(F.lit(1)), "amount": F.sum("_amount")}
    )
    return windowed.select("event_id", "key", "records", "amount")


@query(
    "time_range_window",
    """SELECT event_id, user_id, count(*) OVER w AS records, (sum(floor(value)) OVER w)::BIGINT AS amount
    FROM (SELECT *, epoch_us(ts) // 1000000 AS sec FROM events)
    WINDOW w AS (PARTITION BY user_id ORDER BY sec RANGE BETWEEN 3600 PRECEDING AND CURRENT ROW)""",
)
def time_range_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select(
        "event_id",
        "user_id",
        F.unix_seconds(F.col("ts").cast("timestamp")).alias("sec"),
        F.floor("value").alias("_amount"),
    )
    windowed = windows.time_range_window(
        events,
        ["user_id"],
        "sec",
        3600,
        {"records": ("count", F.lit(1)), "amount": ("sum", F.col("_amount"))},
    )
    return windowed.select("event_id", "user_id", "records", "amount")


@query(
    "rolling_failure_rate",
    with_log(
        """SELECT event_id, failures, round(failures / seen::DOUBLE, 6) AS failure_rate,
        seen = 10 AND failures >= 5 AS tripped
        FROM (SELECT event_id, count(*) OVER w AS seen,
            (sum((event_type = 'error')::INTEGER) OVER w)::BIGINT AS failures
          FROM log WINDOW w AS (PARTITION BY part ORDER BY off ROWS 9 PRECEDING))"""
    ),
)
def rolling_failure_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = events_log(spark, sf_dir).select(
        "event_id", "partition", "offset", (F.col("event_type") == "error").alias("failed")
    )
    rolled = windows.rolling_failure_rate(log, ["partition"], ["offset"], "failed")
    return rolled.select(
        "event_id", "failures", F.round("failure_rate", 6).alias("failure_rate"), "tripped"
    )


@query(
    "latest_per_key",
    with_log(
        """SELECT key, part AS "partition", off AS "offset", value FROM log
        QUALIFY row_number() OVER (PARTITION BY key ORDER BY off DESC) = 1"""
    ),
)
def latest_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = events_log(spark, sf_dir).select("key", "partition", "offset", "value")
    return windows.latest_per_key(log, ["key"], ["offset"])


DELTA_SQL = "CASE action WHEN 'ORDER' THEN amount WHEN 'REFUND' THEN -amount ELSE 0 END"


@query(
    "balance_history",
    with_log(
        f"""SELECT key, event_id, (sum({DELTA_SQL}) OVER w)::BIGINT AS balance, count(*) OVER w AS version
        FROM log WINDOW w AS (PARTITION BY key ORDER BY off ROWS UNBOUNDED PRECEDING)"""
    ),
)
def balance_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = parse_action(events_log(spark, sf_dir).select("key", "event_id", "offset", "value"))
    running = windows.running_balance(parsed, ["key"], ["offset"], metrics.balance_delta())
    return running.select("key", "event_id", "balance", "version")


# --- event sourcing ---------------------------------------------------------------------------


def account_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = F.col("event_type")
    kind = (
        F.when(t == "signup", es.OPENED)
        .when(t == "purchase", es.DEPOSITED)
        .when(t == "error", es.WITHDRAWN)
        .when(t == "view", es.INTEREST)
        .otherwise(es.CLOSED)
    )
    return table(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").alias("account_id"),
        F.col("event_id").alias("seq"),
        kind.alias("type"),
        F.floor("value").alias("amount"),
        F.col("ts").cast("timestamp").alias("timestamp"),
    )


ACCOUNTS = """
acc AS (SELECT user_id::VARCHAR AS account_id, event_id AS seq, ts, floor(value)::BIGINT AS amount,
    CASE event_type WHEN 'signup' THEN 'OPENED' WHEN 'purchase' THEN 'DEPOSITED'
      WHEN 'error' THEN 'WITHDRAWN' WHEN 'view' THEN 'INTEREST' ELSE 'CLOSED' END AS type
  FROM events {where}),
marked AS (SELECT *, CASE type WHEN 'WITHDRAWN' THEN -amount WHEN 'CLOSED' THEN 0 ELSE amount END AS effect,
    sum((type = 'OPENED')::INTEGER) OVER (PARTITION BY account_id ORDER BY seq) AS epoch FROM acc),
hist AS (SELECT *, (sum(effect) OVER (PARTITION BY account_id, epoch ORDER BY seq))::BIGINT AS balance,
    row_number() OVER (PARTITION BY account_id ORDER BY seq) AS version FROM marked),
state AS (SELECT account_id, balance, version, seq AS last_seq, type = 'CLOSED' AS closed,
    strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS updated_at
  FROM hist QUALIFY row_number() OVER (PARTITION BY account_id ORDER BY seq DESC) = 1)"""

ALL_ACCOUNTS = ACCOUNTS.format(where="")
STATE_COLUMNS = "account_id, balance, version, last_seq, closed, updated_at"


def _state(df: DataFrame) -> DataFrame:
    return df.withColumn("updated_at", F.date_format("updated_at", "yyyy-MM-dd HH:mm:ss.SSSSSS"))


@query("account_projection", f"WITH {ALL_ACCOUNTS} SELECT {STATE_COLUMNS} FROM state")
def account_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _state(es.account_projection(account_events(spark, sf_dir)))


@query(
    "account_history",
    f"WITH {ALL_ACCOUNTS} SELECT account_id, seq, type, version, balance FROM hist",
)
def account_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    history = es.account_history(account_events(spark, sf_dir))
    return history.select("account_id", "seq", "type", "version", "balance")


AS_OF = "2024-01-15 12:00:00"


@query(
    "state_as_of",
    "WITH "
    + ACCOUNTS.format(where=f"WHERE ts <= TIMESTAMP '{AS_OF}'")
    + f" SELECT {STATE_COLUMNS} FROM state",
)
def state_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _state(es.state_as_of(account_events(spark, sf_dir), at(AS_OF)))


@query(
    "cqrs_views",
    f"""WITH {ALL_ACCOUNTS}
    SELECT 'type' AS view, type AS item, count(*) AS events, sum(amount)::BIGINT AS amount FROM acc GROUP BY type
    UNION ALL
    SELECT 'day', strftime(ts, '%Y-%m-%d'), count(*),
      sum(CASE WHEN type = 'OPENED' THEN 0 ELSE effect END)::BIGINT FROM marked GROUP BY 2""",
)
def cqrs_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    views = es.views(account_events(spark, sf_dir))
    by_type = views["by_type"].select(F.lit("type").alias("view"), F.col("type").alias("item"), "events", "amount")
    daily = views["daily"].select(
        F.lit("day").alias("view"),
        F.date_format("day", "yyyy-MM-dd").alias("item"),
        "events",
        F.col("net_flow").alias("amount"),
    )
    return by_type.unionByName(daily)


@query("rebuild_state", f"WITH {ALL_ACCOUNTS} SELECT {STATE_COLUMNS} FROM state")
def rebuild_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Snapshot at the middle of the log, plus the tail."""
    events = account_events(spark, sf_dir)
    middle = int(events.agg(F.max("seq")).first()[0] // 2)
    return _state(es.rebuild_state(es.snapshot(events, middle), events, middle))


@query(
    "aggregate_versions",
    f"""WITH {ALL_ACCOUNTS} SELECT account_id AS aggregate_id, version, updated_at,
    '{{"balance":' || balance || ',"closed":' || closed::VARCHAR || '}}' AS state FROM state""",
)
def aggregate_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _state(es.aggregate_versions(account_events(spark, sf_dir))).select(
        "aggregate_id", "version", "state", "updated_at"
    )


# --- schemas ----------------------------------------------------------------------------------


def versioned_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as JSON in two versions: the second one adds a shipping address."""
    key = F.col("o_orderkey")
    fields = [
        F.concat(F.lit("ORD-"), key).alias("orderId"),
        F.concat(F.lit("CUST-"), F.col("o_custkey")).alias("customerId"),
        F.col("o_orderpriority").alias("product"),
        (key % 5 + 1).cast("int").alias("quantity"),
        F.col("o_totalprice").alias("totalPrice"),
        F.col("o_orderstatus").alias("status"),
        F.unix_millis(F.col("o_orderdate").cast("timestamp")).alias("timestamp"),
    ]
    address = F.concat(F.lit("Street "), key).alias("shippingAddress")
    first, second = F.to_json(F.struct(*fields)), F.to_json(F.struct(*fields, address))
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", F.when(key % 2 == 0, first).otherwise(second).alias("value")
    )


@query(
    "evolve_read",
    """SELECT o_orderkey, 'ORD-' || o_orderkey AS order_id, (o_orderkey % 5 + 1)::INTEGER AS quantity,
    o_totalprice AS total_price, CASE WHEN o_orderkey % 2 = 1 THEN 'Street ' || o_orderkey END AS address
    FROM orders""",
)
def evolve_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = schemas.evolve_read(versioned_orders(spark, sf_dir), payloads.ORDER_V2)
    return read.select(
        "o_orderkey",
        F.col("orderId").alias("order_id"),
        "quantity",
        F.col("totalPrice").alias("total_price"),
        F.col("shippingAddress").alias("address"),
    )


def subject_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order records of four schema versions under one subject, and customers under another.

    Version 2 adds an optional address and a status symbol, version 3 turns the quantity into text
    and drops the address, version 4 adds a required channel and drops the price.
    """
    key = F.col("o_orderkey")
    version = (key % 4 + 1).cast("int")
    quantity = (key % 5 + 1).cast("int")
    status = F.when((version == 1) & (F.col("o_orderstatus") == "P"), "O").otherwise(F.col("o_orderstatus"))
    base = [
        F.concat(F.lit("ORD-"), key).alias("orderId"),
        status.alias("status"),
    ]
    price = F.col("o_totalprice").cast("decimal(10,2)").alias("price")
    maybe = F.when(key % 3 == 0, F.concat(F.lit("Street "), key)).alias("address")
    written = {"ignoreNullFields": "false"}
    bodies = {
        1: F.to_json(F.struct(*base, quantity.alias("quantity"), price), written),
        2: F.to_json(F.struct(*base, quantity.alias("quantity"), price, maybe), written),
        3: F.to_json(F.struct(*base, quantity.cast("string").alias("quantity"), price), written),
        4: F.to_json(
            F.struct(*base, quantity.cast("string").alias("quantity"), F.lit("web").alias("channel")), written
        ),
    }
    body = bodies[4]
    for v in (3, 2, 1):
        body = F.when(version == v, bodies[v]).otherwise(body)
    orders = table(spark, sf_dir, "orders").select(
        F.lit("orders-value").alias("subject"), version.alias("version"), body.alias("value")
    )
    customers = table(spark, sf_dir, "customer").select(
        F.lit("customer-value").alias("subject"),
        F.lit(1).alias("version"),
        F.to_json(F.struct("c_name", "c_mktsegment"), written).alias("value"),
    )
    return orders.unionByName(customers)


def schema_store(spark: SparkSession, sf_dir: str) -> SchemaStore:
    """The versions seen in the records, registered once; they hold changes that no mode but ``none`` allows."""

    def build(path: str) -> None:
        found = schemas.observed_schemas(
            subject_records(spark, sf_dir), "subject", "version", "value", enum_fields=["status"]
        )
        SchemaStore(spark, path).register(found, mode="none")

    return SchemaStore(spark, staged(spark, sf_dir, "schema-store", build))


SUBJECTS = """
raw AS (SELECT *, o_orderkey % 4 + 1 AS v, o_orderkey % 5 + 1 AS qty,
    CASE WHEN o_orderkey % 4 = 0 AND o_orderstatus = 'P' THEN 'O' ELSE o_orderstatus END AS status,
    CASE WHEN o_orderkey % 3 = 0 THEN 'Street' END AS address FROM orders),
fields AS (
  SELECT v, 'orderId' AS field, 'string' AS type, 1 AS here, NULL::VARCHAR AS symbol FROM raw
  UNION ALL SELECT v, 'status', 'string', 1, status FROM raw
  UNION ALL SELECT v, 'quantity', CASE WHEN v <= 2 THEN 'integer' ELSE 'string' END, 1, NULL FROM raw
  UNION ALL SELECT v, 'price', 'number', 1, NULL FROM raw WHERE v <= 3
  UNION ALL SELECT v, 'address', 'string', (address IS NOT NULL)::INTEGER, NULL FROM raw WHERE v = 2
  UNION ALL SELECT v, 'channel', 'string', 1, NULL FROM raw WHERE v = 4),
schemas AS (
  SELECT 'orders-value' AS subject, v::INTEGER AS version, field, max(type) AS type, min(here) = 1 AS required,
    coalesce(string_agg(DISTINCT symbol, ',' ORDER BY symbol), '') AS symbols FROM fields GROUP BY v, field
  UNION ALL SELECT DISTINCT 'customer-value', 1, f, 'string', true, ''
  FROM customer CROSS JOIN (VALUES ('c_name'), ('c_mktsegment')) t(f))"""


@query("observed_schemas", f"WITH {SUBJECTS} SELECT * FROM schemas")
def observed_schemas(spark: SparkSession, sf_dir: str) -> DataFrame:
    return schema_store(spark, sf_dir).read().drop("alias_of")


RULES_SQL = "rules(change, backward, forward, \"full\", \"none\") AS (VALUES " + ", ".join(
    f"('{c}', {b}, {f}, {u}, {n})" for c, b, f, u, n in schemas.COMPATIBILITY_RULES
) + ")"


@query(
    "compatibility_report",
    f"""WITH {SUBJECTS}, {RULES_SQL},
    pairs AS (
      SELECT coalesce(n.version, o.version + 1) AS version, coalesce(n.field, o.field) AS field,
        o.field IS NULL AS added, n.field IS NULL AS removed, n.required AS nr, o.required AS orq,
        n.type AS nt, o.type AS ot, n.symbols AS ns, o.symbols AS os
      FROM (SELECT * FROM schemas WHERE subject = 'orders-value' AND version > 1) n
      FULL JOIN (SELECT * FROM schemas WHERE subject = 'orders-value' AND version < 4) o
        ON n.version = o.version + 1 AND n.field = o.field),
    changes AS (
      SELECT version, field, CASE WHEN nr THEN 'add required field' ELSE 'add optional field' END AS change
      FROM pairs WHERE added
      UNION ALL SELECT version, field,
        CASE WHEN orq THEN 'remove required field' ELSE 'remove optional field' END FROM pairs WHERE removed
      UNION ALL SELECT version, field, 'change field type' FROM pairs WHERE NOT added AND NOT removed AND nt <> ot
      UNION ALL SELECT version, field, 'add enum symbol' FROM pairs WHERE ns <> '' AND os <> ''
        AND NOT list_has_all(string_split(os, ','), string_split(ns, ','))
      UNION ALL SELECT version, field, 'remove enum symbol' FROM pairs WHERE ns <> '' AND os <> ''
        AND NOT list_has_all(string_split(ns, ','), string_split(os, ',')))
    SELECT 'orders-value' AS subject, version::INTEGER AS version, field, change, backward, forward,
      "full", "none" FROM changes JOIN rules USING (change)""",
)
def compatibility_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return schemas.compatibility_report(schema_store(spark, sf_dir).read())


@query(
    "subject_versions",
    """SELECT 'orders-value' AS subject, max(o_orderkey % 4 + 1)::INTEGER AS latest_version,
      string_agg(DISTINCT (o_orderkey % 4 + 1)::VARCHAR, ',' ORDER BY (o_orderkey % 4 + 1)::VARCHAR) AS versions
    FROM orders
    UNION ALL SELECT DISTINCT 'customer-value', 1, '1' FROM customer""",
)
def subject_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return schema_store(spark, sf_dir).versions()


@query(
    "wire_frame_split",
    """SELECT coalesce(schema_id, -1) AS schema_id, count(*) AS records, sum(n)::BIGINT AS payload_bytes
    FROM (SELECT CASE WHEN event_id % 20 = 0 THEN NULL ELSE user_id * 1000 + 7 END AS schema_id,
            CASE WHEN event_id % 20 = 0 THEN 0 ELSE strlen(props) END AS n FROM events)
    GROUP BY 1""",
)
def wire_frame_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every twentieth value is not framed."""
    framed = payloads.frame(F.col("user_id") * 1000 + 7, F.col("props"))
    values = table(spark, sf_dir, "events").select(
        F.when(F.col("event_id") % 20 == 0, F.col("props").cast("binary")).otherwise(framed).alias("value")
    )
    return payloads.unframe(values).groupBy(
        F.coalesce("schema_id", F.lit(-1)).alias("schema_id")
    ).agg(
        F.count("*").alias("records"),
        F.sum(F.coalesce(F.octet_length("payload"), F.lit(0))).alias("payload_bytes"),
    )
