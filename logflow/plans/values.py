"""Filters, parsing, validation, headers, ids and error handling of record values."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logflow.functions import errors as err
from logflow.functions import headers as hdr
from logflow.functions import parsing, payloads
from logflow.plans.base import (
    at,
    event_records,
    events_log,
    query,
    table,
    text_value,
    with_log,
    with_rec,
)
from logflow.plans.scans import SUBSCRIBED_AT, events_bounds
from logflow.sources.log import bounds, from_positions, start_positions


def text_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_records(spark, sf_dir).withColumn("value", text_value())


@query("filter_type", with_rec("SELECT event_id, txt AS value FROM rec WHERE contains(txt, '[ORDER]')"))
def filter_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    return text_events(spark, sf_dir).where(parsing.has_type("ORDER")).select("event_id", "value")


@query(
    "filter_type_report",
    with_rec("SELECT count(*) AS total, count(*) FILTER (contains(txt, '[ORDER]')) AS kept FROM rec"),
)
def filter_type_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return text_events(spark, sf_dir).agg(
        F.count("*").alias("total"), F.count_if(parsing.has_type("ORDER")).alias("kept")
    )


US_ORDER = "contains(txt, '[ORDER]') AND contains(txt, 'US')"


@query("filter_type_region", with_rec(f"SELECT event_id, txt AS value FROM rec WHERE {US_ORDER}"))
def filter_type_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    wanted = parsing.has_type("ORDER") & parsing.mentions("US")
    return text_events(spark, sf_dir).where(wanted).select("event_id", "value")


def _filtered_from(spark: SparkSession, sf_dir: str, policy: str) -> DataFrame:
    """US orders for a new group that starts by ``policy``."""
    log = events_log(spark, sf_dir)
    subscribed = bounds(log.where(F.col("timestamp") < at(SUBSCRIBED_AT)))
    nobody = spark.createDataFrame(
        [], "consumer_group STRING, topic STRING, partition INT, offset BIGINT"
    )
    known = events_bounds(spark, sf_dir)
    starts = start_positions(log, nobody, "new", policy, subscribed, known)
    wanted = parsing.has_type("ORDER") & parsing.mentions("US")
    texts = from_positions(log, starts, known).withColumn("value", text_value())
    return texts.where(wanted).select("partition", "offset", "value")


@query(
    "backfill_filter",
    with_log(f'SELECT part AS "partition", off AS "offset", txt AS value FROM log WHERE {US_ORDER}'),
)
def backfill_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _filtered_from(spark, sf_dir, "earliest")


@query(
    "live_filter",
    with_log(
        f"""SELECT part AS "partition", off AS "offset", txt AS value FROM log
        WHERE {US_ORDER} AND ts >= TIMESTAMP '{SUBSCRIBED_AT}'"""
    ),
)
def live_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _filtered_from(spark, sf_dir, "latest")


@query(
    "parse_action",
    with_rec(
        """SELECT event_id, action, raw AS amount_text,
      coalesce(CASE WHEN raw = 'complete' THEN 0 ELSE try_cast(raw AS INTEGER) END, -1)::BIGINT AS amount,
      CASE WHEN raw <> 'complete' AND try_cast(raw AS INTEGER) IS NULL
        THEN 'not a number: ' || raw END AS error
    FROM (SELECT *, CASE event_id % 10 WHEN 0 THEN '0' WHEN 5 THEN '0' WHEN 3 THEN 'x1'
            ELSE amount_text END AS raw FROM rec)"""
    ),
)
def parse_action(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind, word = F.col("event_id") % 10, F.split("value", ":")[0]
    damaged = (
        F.when(kind == 0, F.concat(word, F.lit(":")))
        .when(kind == 5, word)
        .when(kind == 3, F.concat(word, F.lit(":x1")))
        .otherwise(F.col("value"))
    )
    parsed = parsing.parse_action(event_records(spark, sf_dir).withColumn("value", damaged))
    return parsed.select(
        "event_id", "action", "amount_text", F.coalesce("amount", F.lit(-1)).alias("amount"), "error"
    )


@query(
    "parse_text_record",
    with_rec(
        r"""SELECT event_id, regexp_extract(txt, '^\[([^\]]*)\]', 1) AS type,
      regexp_extract(txt, 'Region: (\w+)', 1) AS region,
      event_id AS message_no, (epoch_us(ts) // 1000) AS ts_ms FROM rec"""
    ),
)
def parse_text_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parsing.parse_text_record(text_events(spark, sf_dir)).select(
        "event_id", "type", "region", "message_no", "ts_ms"
    )


@query(
    "parse_txn",
    """SELECT o_custkey, count(*) AS transfers,
      sum(CASE WHEN o_orderkey % 3 = 0 THEN floor(o_totalprice) ELSE -floor(o_totalprice) END)::BIGINT
        AS signed_sum
    FROM orders GROUP BY o_custkey""",
)
def parse_txn(spark: SparkSession, sf_dir: str) -> DataFrame:
    direction = F.when(F.col("o_orderkey") % 3 == 0, "credit").otherwise("debit")
    texts = table(spark, sf_dir, "orders").select(
        "o_custkey",
        F.concat_ws(":", F.lit("TXN"), direction, F.floor("o_totalprice").cast("string")).alias("value"),
    )
    return parsing.parse_transfer(texts).groupBy("o_custkey").agg(
        F.count("*").alias("transfers"), F.sum("signed_amount").alias("signed_sum")
    )


MIXED_SQL = "CASE WHEN event_id % 10 = 1 THEN 'plain text' ELSE body END"


def mixed_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bodies of three kinds: JSON, cut JSON and plain text."""
    kind = F.col("event_id") % 10
    return event_records(spark, sf_dir).withColumn(
        "value", F.when(kind == 1, "plain text").otherwise(F.col("body"))
    )


@query(
    "json_check_simple",
    with_rec(
        f"""SELECT event_id, starts_with(v, '{{') AND NOT contains(v, '}}') AS malformed
        FROM (SELECT event_id, {MIXED_SQL} AS v FROM rec)"""
    ),
)
def json_check_simple(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixed_bodies(spark, sf_dir).select("event_id", parsing.looks_malformed().alias("malformed"))


@query(
    "json_check_strict",
    with_rec(f"SELECT event_id, NOT json_valid({MIXED_SQL}) AS malformed FROM rec"),
)
def json_check_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixed_bodies(spark, sf_dir).select("event_id", (~parsing.is_json()).alias("malformed"))


@query(
    "json_decode",
    """SELECT event_id, CASE WHEN event_id % 10 IN (3, 4) THEN -1 ELSE user_id END::INTEGER AS id,
      CASE WHEN event_id % 10 <> 4 THEN event_type END AS name, event_id % 10 = 4 AS corrupt FROM events""",
)
def json_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("event_id") % 10
    number = F.when(kind == 3, '"x"').otherwise(F.col("user_id").cast("string"))
    text = F.concat(F.lit('{"id": '), number, F.lit(', "name": "'), F.col("event_type"), F.lit('"'))
    values = table(spark, sf_dir, "events").select(
        "event_id", F.when(kind == 4, text).otherwise(F.concat(text, F.lit("}"))).alias("value")
    )
    decoded = parsing.decode(values, T.StructType().add("id", "integer").add("name", "string"))
    return decoded.select(
        "event_id",
        F.coalesce("decoded.id", F.lit(-1)).alias("id"),
        "decoded.name",
        (F.size("errors") > 0).alias("corrupt"),
    )


@query(
    "validate_record",
    """SELECT o_orderkey, concat_ws(',',
      CASE WHEN o_orderkey % 17 = 1 THEN 'not_json' END,
      CASE WHEN o_orderkey % 17 <> 1 AND (o_orderkey % 13 = 0) THEN 'order_id_not_positive' END,
      CASE WHEN o_orderkey % 17 <> 1 AND o_orderkey % 50 = 0 THEN 'quantity_missing' END) AS errors
    FROM orders""",
)
def validate_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey")
    body = F.to_json(
        F.struct(
            F.when(key % 13 == 0, -key).otherwise(key).alias("orderId"),
            F.when(key % 50 != 0, key % 5 + 1).alias("quantity"),
        )
    )
    values = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.when(key % 17 == 1, F.lit("{broken")).otherwise(body).alias("value")
    )
    schema = T.StructType().add("orderId", "long").add("quantity", "integer")
    rules = [
        ("order_id_not_positive", F.col("decoded.orderId") <= 0),
        ("quantity_missing", F.col("decoded.quantity").isNull()),
    ]
    decoded = parsing.decode(values, schema, rules)
    return decoded.select("o_orderkey", F.array_join("errors", ",").alias("errors"))


def _decoded_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    values = event_records(spark, sf_dir).select("event_id", F.col("body").alias("value"))
    return parsing.decode(values, T.StructType().add("k", "integer"))


@query(
    "decode_or_default",
    with_rec(
        """SELECT event_id, CASE WHEN json_valid(body) THEN (props->>'$.k')::INTEGER ELSE -1 END AS k FROM rec"""
    ),
)
def decode_or_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    decoded = _decoded_bodies(spark, sf_dir)
    fixed = parsing.on_error(decoded, "default", default=F.struct(F.lit(-1).alias("k")))
    return fixed.select("event_id", "decoded.k")


@query(
    "decode_policies",
    with_rec(
        """SELECT 'skip' AS policy, count(*) FILTER (json_valid(body)) AS records FROM rec
        UNION ALL SELECT 'dlt', count(*) FILTER (NOT json_valid(body)) FROM rec"""
    ),
)
def decode_policies(spark: SparkSession, sf_dir: str) -> DataFrame:
    decoded = _decoded_bodies(spark, sf_dir)

    def kept(policy: str) -> DataFrame:
        rows = parsing.on_error(decoded, policy).agg(F.count("*").alias("records"))
        return rows.select(F.lit(policy).alias("policy"), "records")

    return kept("skip").unionByName(kept("dlt"))


@query(
    "envelope_route",
    """SELECT event_id, CASE event_type WHEN 'purchase' THEN 'Order' WHEN 'signup' THEN 'User'
        ELSE 'Other' END AS type, '1.0' AS version,
      CASE WHEN event_type = 'purchase' THEN 'ORD-' || event_id END AS order_id,
      CASE WHEN event_type = 'signup' THEN 'USR-' || user_id END AS user_id FROM events""",
)
def envelope_route(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = F.col("event_type")
    kind = F.when(t == "purchase", "Order").when(t == "signup", "User").otherwise("Other")
    payload = F.struct(
        F.when(t == "purchase", F.concat(F.lit("ORD-"), F.col("event_id"))).alias("orderId"),
        F.when(t == "signup", F.concat(F.lit("USR-"), F.col("user_id"))).alias("userId"),
    )
    values = table(spark, sf_dir, "events").select(
        "event_id", payloads.envelope(kind, payload, F.lit("2024-01-01T00:00:00Z")).alias("value")
    )
    opened = payloads.unwrap(
        values,
        {"Order": T.StructType().add("orderId", "string"), "User": T.StructType().add("userId", "string")},
    )
    return opened.select(
        "event_id",
        "type",
        "version",
        F.col("Order.orderId").alias("order_id"),
        F.col("User.userId").alias("user_id"),
    )


# --- headers and ids --------------------------------------------------------------------------

HEADER_COUNT = "(CASE WHEN event_id % 5 <> 0 THEN 3 ELSE 2 END)"
ISO_SQL = "strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ')"
TRACE_SQL = "substr(md5('events|' || event_id), 1, 16)"


@query(
    "add_timestamp_header",
    with_rec(f"SELECT event_id, {HEADER_COUNT} + 1 AS header_count, {ISO_SQL} AS x_timestamp FROM rec"),
)
def add_timestamp_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    stamped = event_records(spark, sf_dir).transform(hdr.add_timestamp_header(F.col("timestamp")))
    return stamped.select(
        "event_id", F.size("headers").alias("header_count"), hdr.header("X-Timestamp").alias("x_timestamp")
    )


@query("add_trace_header", with_rec(f"SELECT event_id, {TRACE_SQL} AS x_trace_id FROM rec"))
def add_trace_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    traced = event_records(spark, sf_dir).transform(hdr.add_trace_header(F.col("topic"), F.col("event_id")))
    return traced.select("event_id", hdr.header("X-Trace-Id").alias("x_trace_id"))


@query(
    "enrich_chain",
    with_rec(
        f"""SELECT event_id, CASE WHEN event_id % 5 <> 0 THEN 'correlation-id,source,priority,'
          ELSE 'correlation-id,source,' END || 'X-Timestamp,X-Trace-Id,X-K' AS names,
        {TRACE_SQL} AS trace, CASE WHEN json_valid(body) THEN props->>'$.k' END AS k FROM rec"""
    ),
)
def enrich_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last step fails on broken bodies: those records lose that value and keep the rest."""

    def body_header(df: DataFrame) -> DataFrame:
        k = parsing.json_field("k", "int", "body")
        return df.withColumn("headers", hdr.append_header("X-K", k))

    chained = hdr.enrich_chain(
        event_records(spark, sf_dir),
        [
            hdr.add_timestamp_header(F.col("timestamp")),
            hdr.add_trace_header(F.col("topic"), F.col("event_id")),
            body_header,
        ],
    )
    return chained.select(
        "event_id",
        F.array_join("headers.key", ",").alias("names"),
        hdr.header("X-Trace-Id").alias("trace"),
        hdr.header("X-K").alias("k"),
    )


@query(
    "make_ids",
    """SELECT o_orderkey, 'ORD-' || substr(md5(o_orderkey::VARCHAR), 1, 8) AS order_id,
    'USR-' || substr(md5(o_custkey::VARCHAR), 1, 8) AS user_id FROM orders""",
)
def make_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        payloads.prefixed_id("ORD-", F.col("o_orderkey").cast("string")).alias("order_id"),
        payloads.prefixed_id("USR-", F.col("o_custkey").cast("string")).alias("user_id"),
    )


@query(
    "synthetic_records",
    """SELECT event_id, '{"id":' || event_id || ',"timestamp":' || (epoch_us(ts) // 1000)
      || ',"data":"' || repeat('short filler text of a record, ', 5) || 'end"}' AS value,
    strlen('{"timestamp":' || (epoch_us(ts) // 1000) || ',"data":"' || repeat('X', 400)
      || '","metadata":{"source":"benchmark","version":"1.0"}}')::INTEGER AS large_bytes FROM events""",
)
def synthetic_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    millis = F.unix_millis(F.col("ts").cast("timestamp"))
    return table(spark, sf_dir, "events").select(
        "event_id",
        payloads.small_payload(F.col("event_id"), millis).alias("value"),
        F.octet_length(payloads.large_payload(millis)).alias("large_bytes"),
    )


# --- errors and retries -----------------------------------------------------------------------

ERROR_NAMES = [name for name, _, _ in err.ERROR_CLASSES] + ["SomethingElseException"]


def error_name():
    names = F.array(*[F.lit(n) for n in ERROR_NAMES])
    return F.get(names, (F.col("event_id") % len(ERROR_NAMES)).cast("int"))


ERROR_SQL = (
    "error_names(idx, error, retriable, advice) AS (VALUES "
    + ", ".join(f"({i}, '{n}', {r}, '{a}')" for i, (n, r, a) in enumerate(err.ERROR_CLASSES))
    + f", ({len(err.ERROR_CLASSES)}, 'SomethingElseException', false, 'unknown error, do not retry'))"
)


@query(
    "classify_error",
    f"""WITH {ERROR_SQL} SELECT event_id, error, retriable, advice FROM events
    JOIN error_names ON idx = event_id % {len(ERROR_NAMES)} WHERE event_type = 'error'""",
)
def classify_error(spark: SparkSession, sf_dir: str) -> DataFrame:
    failed = table(spark, sf_dir, "events").where(F.col("event_type") == "error")
    named = failed.select("event_id", error_name().alias("error"))
    return err.classify_error(named)


@query(
    "backoff_schedule",
    """SELECT event_id, (event_id % 10 + 1)::INTEGER AS attempt,
    least(100 * power(2, event_id % 10), 10000)::BIGINT AS delay_ms, event_id % 10 + 1 >= 3 AS gives_up,
    true AS jitter_ok FROM events""",
)
def backoff_schedule(spark: SparkSession, sf_dir: str) -> DataFrame:
    attempt, delay = F.col("attempt"), F.col("delay_ms")
    shaken = err.jittered(delay, F.col("event_id"), attempt)
    return (
        table(spark, sf_dir, "events")
        .select("event_id", (F.col("event_id") % 10 + 1).cast("int").alias("attempt"))
        .withColumn("delay_ms", err.backoff_ms(attempt))
        .withColumn("gives_up", err.gives_up(attempt))
        .withColumn("jitter_ok", F.abs(shaken - delay) <= delay * err.JITTER_SHARE)
    )


@query(
    "fixed_backoff_timeline",
    """SELECT event_id, attempt::INTEGER AS attempt, attempt * 100 AS at_ms,
      250 >= (event_id % 4) * 100 + 50 AS config_ok
    FROM (SELECT event_id, unnest(range(0, event_id % 4 + 1)) AS attempt FROM events
          WHERE event_type = 'error') WHERE attempt * 100 <= 250""",
)
def fixed_backoff_timeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    failed = table(spark, sf_dir, "events").where(F.col("event_type") == "error")
    retries, pause, timeout = F.col("event_id") % 4, F.lit(100), F.lit(250)
    timeline = err.fixed_backoff_timeline(failed.select("event_id"), retries, pause, timeout)
    return timeline.withColumn("config_ok", err.delivery_timeout_ok(timeout, retries, pause, F.lit(50)))


# --- typed records ----------------------------------------------------------------------------


def order_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order events with an enum status and a nullable attribute map."""
    key, s = F.col("o_orderkey"), F.col("o_orderstatus")
    status = F.when(s == "O", "PENDING").when(s == "F", "DELIVERED").otherwise("UNDER_REVIEW")
    attributes = payloads.attributes(
        ip=F.concat(F.lit("10.0.0."), key % 256),
        userAgent=F.lit("Mozilla/5.0"),
        sessionId=F.concat(F.lit("s-"), F.col("o_custkey")),
    )
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.concat(F.lit("ORD-"), key).alias("orderId"),
        F.when(key % 19 != 0, F.concat(F.lit("CUST-"), F.col("o_custkey"))).alias("customerId"),
        (key % 5 + 1).cast("int").alias("quantity"),
        F.col("o_totalprice").cast("decimal(10,2)").alias("price"),
        status.alias("status"),
        F.date_trunc("millisecond", F.col("o_orderdate").cast("timestamp")).alias("createdAt"),
        F.when(key % 4 != 0, attributes).alias("metadata"),
    )


@query(
    "typed_order",
    """SELECT o_orderkey, o_totalprice::DECIMAL(10,2)::VARCHAR AS price, (epoch_us(o_orderdate) // 1000) AS created_ms,
    o_orderstatus IN ('O', 'F') AS status_known,
    CASE WHEN o_orderkey % 4 <> 0 THEN '10.0.0.' || (o_orderkey % 256) END AS ip FROM orders""",
)
def typed_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_events(spark, sf_dir).select(
        "o_orderkey",
        F.col("price").cast("string").alias("price"),
        F.unix_millis("createdAt").alias("created_ms"),
        F.col("status").isin(payloads.ORDER_STATUS).alias("status_known"),
        F.try_element_at("metadata", F.lit("ip")).alias("ip"),
    )


@query(
    "typed_user_event",
    """SELECT event_id, epoch_us(ts) // 1000 AS created_ms, epoch_us(ts) // 1000 // 86400000 AS day,
    concat_ws(',', CASE WHEN event_id % 23 = 0 THEN 'userId_missing' END,
      CASE WHEN event_type NOT IN ('signup', 'click', 'purchase', 'view') THEN 'eventType_unknown' END) AS errors,
    event_type = 'view' AS is_logout,
    CASE WHEN event_id % 3 <> 0 THEN event_type END AS kind,
    CASE WHEN event_id % 3 <> 0 THEN 2 ELSE 0 END AS attribute_count FROM events""",
)
def typed_user_event(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User events written as JSON and read back typed; some have no user, some a type outside the enum."""
    key, t = F.col("event_id"), F.col("event_type")
    user = F.concat(F.lit("u-"), F.col("user_id"))
    symbols = {"signup": "CREATED", "click": "LOGIN", "purchase": "UPDATED", "view": "LOGOUT"}
    symbol = F.lit("OTHER")
    for name, meaning in symbols.items():
        symbol = F.when(t == name, meaning).otherwise(symbol)
    value = payloads.json_value(
        F.when(key % 23 != 0, user).alias("userId"),
        F.concat(user, F.lit("@example.com")).alias("email"),
        F.concat(F.lit("User "), F.col("user_id")).alias("name"),
        symbol.alias("eventType"),
        F.unix_millis(F.col("ts").cast("timestamp")).alias("timestamp"),
        F.when(key % 3 != 0, payloads.attributes(agent=user, kind=t)).alias("attributes"),
    )
    records = payloads.user_events(table(spark, sf_dir, "events").select("event_id", value.alias("value")))
    required = ["userId", "email", "name", "eventType", "timestamp"]
    codes = parsing.required_errors(required, {"eventType": payloads.USER_EVENT_TYPES})
    created = F.unix_millis("timestamp")
    return records.select(
        "event_id",
        created.alias("created_ms"),
        F.expr("unix_millis(timestamp) div 86400000").alias("day"),
        F.array_join(codes, ",").alias("errors"),
        (F.col("eventType") == "LOGOUT").alias("is_logout"),
        F.try_element_at("attributes", F.lit("kind")).alias("kind"),
        F.coalesce(F.size(F.map_keys("attributes")), F.lit(0)).alias("attribute_count"),
    )


@query(
    "required_fields",
    """SELECT o_orderkey, concat_ws(',', CASE WHEN o_orderkey % 19 = 0 THEN 'customerId_missing' END,
    CASE WHEN o_orderstatus = 'P' THEN 'status_unknown' END) AS errors FROM orders""",
)
def required_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    required = ["orderId", "customerId", "quantity", "price", "status", "createdAt"]
    codes = parsing.required_errors(required, {"status": payloads.ORDER_STATUS})
    return order_events(spark, sf_dir).select("o_orderkey", F.array_join(codes, ",").alias("errors"))


ATTRIBUTES_SQL = """SELECT o_orderkey, unnest(['ip', 'userAgent', 'sessionId']) AS name,
  unnest(['10.0.0.' || (o_orderkey % 256), 'Mozilla/5.0', 's-' || o_custkey]) AS value
  FROM orders WHERE o_orderkey % 4 <> 0"""


@query("map_attributes", ATTRIBUTES_SQL)
def map_attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_events(spark, sf_dir).select("o_orderkey", F.explode("metadata").alias("name", "value"))


@query(
    "complex_types",
    """SELECT event_id, upper(event_type) AS event_kind, event_type IN ('signup', 'click') AS known,
    CASE WHEN event_id % 3 <> 0 THEN 2 ELSE 0 END AS attribute_count,
    CASE WHEN event_id % 3 <> 0 THEN 'u-' || user_id END AS agent FROM events""",
)
def complex_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User events with an enum type and a nullable map, written as JSON and read back."""
    t = F.col("event_type")
    symbol = F.when(t == "signup", "CREATED").when(t == "click", "LOGIN").otherwise("OTHER")
    events = table(spark, sf_dir, "events").select(
        "event_id",
        F.upper("event_type").alias("event_kind"),
        F.to_json(
            F.struct(
                F.col("user_id").cast("string").alias("userId"),
                symbol.alias("eventType"),
                F.when(
                    F.col("event_id") % 3 != 0,
                    payloads.attributes(agent=F.concat(F.lit("u-"), F.col("user_id")), kind=t),
                ).alias("metadata"),
            )
        ).alias("value"),
    )
    record = F.from_json("value", "userId STRING, eventType STRING, metadata MAP<STRING,STRING>")
    return events.withColumn("r", record).select(
        "event_id",
        "event_kind",
        F.col("r.eventType").isin(payloads.USER_EVENT_TYPES_INLINE).alias("known"),
        F.coalesce(F.size(F.map_keys("r.metadata")), F.lit(0)).alias("attribute_count"),
        F.try_element_at("r.metadata", F.lit("agent")).alias("agent"),
    )
