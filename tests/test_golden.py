"""Hand-worked cases on tiny literal inputs."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logflow.functions import errors, headers, parsing, partitioners, payloads
from logflow.operators import eventsourcing as es
from logflow.operators import metrics, offsets, routing, windows
from logflow.records import as_records, describe, record_metadata
from logflow.sinks import log as sink
from logflow.sources import log as source


def values(spark, *texts, name="value"):
    return spark.createDataFrame([(t,) for t in texts], f"{name} STRING")


def column(df, name):
    return [r[name] for r in df.collect()]


def test_balances(spark):
    sent = [
        ("user-1", "ORDER:100"),
        ("user-1", "PAYMENT:100"),
        ("user-2", "ORDER:50"),
        ("user-2", "REFUND:25"),
        ("user-1", "DELIVERY:complete"),
        ("user-3", "PAYMENT:5"),
    ]
    parsed = parsing.parse_action(spark.createDataFrame(sent, "key STRING, value STRING"))
    got = {r.key: r.balance for r in metrics.user_balances(parsed).collect()}
    assert got == {"user-1": 100, "user-2": 25, "user-3": 0}


def test_parse_action_edges(spark):
    parsed = parsing.parse_action(values(spark, "ORDER", "ORDER:", "ORDER:x", "ORDER:7:8", "SHIP:complete", None))
    got = [(r.action, r.amount_text, r.amount, r.error) for r in parsed.collect()]
    assert got[:2] == [("ORDER", "0", 0, None)] * 2
    assert got[2] == ("ORDER", "x", None, "not a number: x")
    assert got[3] == ("ORDER", "7", 7, None)
    assert got[4] == ("SHIP", "complete", 0, None)


def test_text_records(spark):
    types = ["ORDER", "ORDER", "NOTIFICATION", "ORDER", "ALERT", "ORDER", "NOTIFICATION", "ALERT", "ORDER", "NOTIFICATION"]
    regions = ["US", "EU", "ASIA", "US", "EU", "ASIA", "US", "EU", "ASIA", "US"]
    rows = [(i + 1, t, r) for i, (t, r) in enumerate(zip(types, regions, strict=True))]
    df = spark.createDataFrame(rows, "n BIGINT, t STRING, r STRING").select(
        parsing.text_record(F.col("t"), F.col("r"), F.col("n"), F.lit(1700000000000)).alias("value")
    )
    parsed = parsing.parse_text_record(df)
    assert {r["type"]: r["count"] for r in parsed.groupBy("type").count().collect()} == {
        "ORDER": 5,
        "NOTIFICATION": 3,
        "ALERT": 2,
    }
    assert df.where(parsing.has_type("ORDER")).count() == 5
    wanted = parsed.where(parsing.has_type("ORDER") & parsing.mentions("US"))
    assert sorted(column(wanted, "message_no")) == [1, 4]
    assert column(parsed, "region") == regions
    assert column(parsing.parse_text_record(values(spark, "no record")), "type") == [None]


def test_region_partitions(spark):
    keys = ["US-order-001", "EU-order-002", "APAC-order-003", "US-order-004", "EU-order-005", "LATAM-1", None]
    df = values(spark, *keys, name="key")
    assert column(df.select(partitioners.by_region(4).alias("p")), "p") == [0, 1, 2, 0, 1, 3, 3]
    assert column(df.select(partitioners.by_region(2).alias("p")), "p") == [0, 1, 0, 0, 1, 1, 1]


def test_explicit_partition_is_checked(spark):
    df = spark.createDataFrame([(0,), (3,)], "p INT")
    assert column(df.select(partitioners.explicit(4, "p").alias("q")), "q") == [0, 3]
    with pytest.raises(Exception, match="partition 3"):
        df.select(partitioners.explicit(3, "p").alias("q")).collect()


def test_round_robin(spark):
    df = spark.range(20)
    even = partitioners.round_robin(df, 3, ["id"], width=4).orderBy("id")
    assert column(even, "partition") == [i % 3 for i in range(20)]
    sticky = partitioners.round_robin(df, 3, ["id"], batch=5, width=4).orderBy("id")
    assert column(sticky, "partition") == [i // 5 % 3 for i in range(20)]


def test_one_partition_per_key(spark):
    keys = [f"user-{n}" for n in ("alice", "bob", "charlie", "alice", "bob", "alice")]
    df = values(spark, *keys, name="key").withColumn("partition", partitioners.by_key(3))
    assert not any(column(offsets.key_partition_map(df), "violation"))


def test_malformed_checks(spark):
    df = values(spark, "Hello there", '{"id":1,"name":"Alice"}', "{invalid json")
    assert column(df.select(parsing.looks_malformed().alias("m")), "m") == [False, False, True]
    assert column(df.select((~parsing.is_json()).alias("m")), "m") == [True, False, True]


def test_decode_and_policies(spark):
    df = values(spark, '{"orderId":5,"quantity":1}', '{"orderId":0}', "{bad")
    schema = T.StructType().add("orderId", "long").add("quantity", "integer")
    rules = [
        ("order_id_not_positive", F.col("decoded.orderId") <= 0),
        ("quantity_missing", F.col("decoded.quantity").isNull()),
    ]
    decoded = parsing.decode(df, schema, rules)
    assert column(decoded, "errors") == [[], ["order_id_not_positive", "quantity_missing"], ["not_json"]]
    assert parsing.on_error(decoded, "skip").count() == 1
    assert parsing.on_error(decoded, "dlt").count() == 2
    default = F.struct(F.lit(-1).cast("bigint").alias("orderId"), F.lit(0).alias("quantity"))
    fixed = parsing.on_error(decoded, "default", default=default)
    assert [r.decoded.orderId for r in fixed.collect()] == [5, -1, -1]
    with pytest.raises(Exception, match="bad record"):
        parsing.on_error(decoded, "fail").collect()


def test_transfers(spark):
    df = values(spark, "TXN:debit:100", "TXN:credit:50", "TXN:debit:75", "OTHER:1")
    assert parsing.parse_transfer(df).agg(F.sum("signed_amount")).first()[0] == -125


def test_csv_value(spark):
    df = values(spark, "orderId,product,quantity,price\nORD-001,Widget,10,29.99")
    row = df.select(
        payloads.parse_csv_value("value", "orderId STRING, product STRING, quantity INT, price DECIMAL(10,2)").alias("r")
    ).first()["r"]
    assert row.asDict() == {"orderId": "ORD-001", "product": "Widget", "quantity": 10, "price": Decimal("29.99")}


def test_headers(spark):
    df = spark.createDataFrame([(1,), (2,), (3,)], "i INT").select(
        "i",
        headers.make_headers(
            correlation_id=F.concat(F.lit("corr-"), F.col("i").cast("string")),
            source=F.lit("test"),
            priority=F.when(F.col("i") % 2 == 0, "high").otherwise("normal"),
        ).alias("headers"),
    )
    got = df.select(
        headers.header("correlation-id").alias("c"), headers.header("priority").alias("p"), headers.header("x").alias("x")
    )
    assert [tuple(r) for r in got.collect()] == [
        ("corr-1", "normal", None),
        ("corr-2", "high", None),
        ("corr-3", "normal", None),
    ]
    twice = df.withColumn("headers", headers.append_header("source", F.lit("again")))
    assert twice.select(F.size("headers").alias("n"), headers.header("source").alias("s")).first() == (4, "test")
    bare = df.withColumn("headers", F.lit(None).cast(df.schema["headers"].dataType))
    chained = headers.enrich_chain(bare, [headers.add_trace_header(F.col("i"))])
    assert len(chained.select(headers.header("X-Trace-Id").alias("t")).first()["t"]) == 16


def test_envelope_round_trip(spark):
    df = spark.createDataFrame([("ORD-1", 3)], "orderId STRING, quantity INT").select(
        payloads.envelope("Order", F.struct("orderId", "quantity"), F.lit("2024-01-01T00:00:00Z")).alias("value")
    )
    opened = payloads.unwrap(
        df,
        {
            "Order": T.StructType().add("orderId", "string").add("quantity", "integer"),
            "User": T.StructType().add("userId", "string"),
        },
    ).first()
    assert (opened.type, opened.version, opened.Order.orderId, opened.Order.quantity, opened.User) == (
        "Order",
        "1.0",
        "ORD-1",
        3,
        None,
    )


def test_frames(spark):
    df = spark.createDataFrame([(1,), (70000,), (2**31,)], "id BIGINT").select(
        "id", payloads.frame(F.col("id"), F.lit("body")).alias("value")
    )
    got = payloads.unframe(df).collect()
    assert [(r.magic, r.schema_id, bytes(r.payload)) for r in got] == [
        (0, 1, b"body"),
        (0, 70000, b"body"),
        (0, 2**31, b"body"),
    ]
    odd = spark.createDataFrame([(bytearray(b"\x01abcdef"),), (bytearray(b"\x00a"),)], "value BINARY")
    assert [r.schema_id for r in payloads.unframe(odd).collect()] == [None, None]


def test_backoff(spark):
    df = spark.createDataFrame([(a,) for a in (1, 2, 3, 7, 8, 60)], "a INT")
    got = df.select(errors.backoff_ms(F.col("a")).alias("d"), errors.gives_up(F.col("a")).alias("g"))
    assert column(got, "d") == [100, 200, 400, 6400, 10000, 10000]
    assert column(got, "g") == [False, False, True, True, True, True]
    jitter = spark.range(500).select(errors.jittered(F.lit(1000), F.col("id")).alias("j"))
    spread = column(jitter, "j")
    assert min(spread) >= 950 and max(spread) <= 1050 and len(set(spread)) > 50


def test_fixed_backoff_timeline(spark):
    df = spark.createDataFrame([(3,)], "retries INT")
    line = errors.fixed_backoff_timeline(df, F.col("retries"), F.lit(100), F.lit(1000))
    assert sorted(column(line, "at_ms")) == [0, 100, 200, 300]
    cut = errors.fixed_backoff_timeline(df, F.col("retries"), F.lit(100), F.lit(150))
    assert sorted(column(cut, "at_ms")) == [0, 100]


def test_error_classes(spark):
    df = values(spark, "TimeoutException", "SerializationException", "NoSuchThing", name="error")
    assert column(errors.classify_error(df), "retriable") == [True, False, False]


def test_capacity(spark):
    df = spark.createDataFrame([(100_000, 10_000), (100_001, 10_000)], "rate BIGINT, per_consumer BIGINT")
    got = metrics.capacity_plan(df).collect()
    assert [(r.required, r.reserved) for r in got] == [(10, 13), (11, 15)]


def test_lag_bands(spark):
    df = spark.createDataFrame([(x,) for x in (0, 999, 1000, 10000, 100000, 100001)], "lag BIGINT")
    assert column(offsets.lag_bands(df), "action") == [
        "none",
        "none",
        "monitor",
        "scale soon",
        "scale soon",
        "emergency",
    ]


def test_lag_trend(spark):
    lag = [0, 1, 2, 3, 4, 5, 6, 6, 2, 0]
    df = spark.createDataFrame(list(enumerate(lag)), "minute BIGINT, lag BIGINT")
    got = offsets.lag_trend(df).orderBy("minute").collect()
    assert [r.trend for r in got] == ["zero"] + ["growing"] * 6 + ["stable", "shrinking", "zero"]
    assert [r.growing_alert for r in got] == [False] * 5 + [True, True, False, False, False]


def test_lag_without_commit_counts_from_the_first_record(spark):
    log = spark.createDataFrame([("t", 0, o) for o in range(5, 9)] + [("t", 1, 0)], "topic STRING, partition INT, offset BIGINT")
    commits = spark.createDataFrame([("g", "t", 1, 1)], "consumer_group STRING, topic STRING, partition INT, offset BIGINT")
    got = {r.partition: (r.committed, r.lag) for r in offsets.consumer_lag(source.bounds(log), commits, "g").collect()}
    assert got == {0: (5, 4), 1: (1, 0)}


def test_accounts(spark):
    rows = [("a", 1, "OPENED", 1000), ("a", 2, "WITHDRAWN", 100), ("b", 3, "DEPOSITED", 7), ("b", 4, "OPENED", 50), ("b", 5, "CLOSED", 9)]
    events = spark.createDataFrame(rows, "account_id STRING, seq BIGINT, type STRING, amount BIGINT").withColumn(
        "timestamp", F.timestamp_seconds(F.col("seq"))
    )

    def state(df):
        return {r.account_id: (r.balance, r.version, r.closed) for r in df.collect()}

    final = {"a": (900, 2, False), "b": (50, 3, True)}
    assert state(es.account_projection(events, width=2)) == final
    assert state(es.state_as_of(events, F.timestamp_seconds(F.lit(1)))) == {"a": (1000, 1, False)}
    for middle in range(6):
        saved = es.snapshot(events, middle, width=2)
        assert state(es.rebuild_state(saved, events, middle, width=2)) == final
    history = es.account_history(events, width=2).orderBy("seq")
    assert [(r.version, r.balance) for r in history.collect()] == [(1, 1000), (2, 900), (1, 7), (2, 50), (3, 50)]


def test_failure_rate_needs_a_full_window(spark):
    df = spark.createDataFrame([("d", i, i < 9) for i in range(20)], "k STRING, i BIGINT, failed BOOLEAN")
    got = windows.rolling_failure_rate(df, ["k"], ["i"], "failed", width=6, block=10).orderBy("i").collect()
    assert [r.tripped for r in got] == [False] * 9 + [True] * 5 + [False] * 6


def test_order_transaction(spark):
    order = spark.createDataFrame(
        [("ORD-1", "PROD-001", "CUST-001", 2, "t1", 1, None)],
        "order_id STRING, product_id STRING, customer_id STRING, quantity INT, txn_id STRING, seq BIGINT, timestamp TIMESTAMP",
    )
    got = {r.topic: (r.key, r.value) for r in sink.order_transaction(order).collect()}
    assert set(got) == {"orders", "inventory", "notifications"}
    assert got["inventory"] == ("PROD-001", '{"productId":"PROD-001","adjustment":-2,"reason":"Order ORD-1"}')
    assert got["notifications"][0] == "CUST-001"


def test_record_metadata_and_description(spark):
    df = spark.createDataFrame([("a", "é"), (None, "xyz")], "k STRING, v STRING")
    log = as_records(df, "t", F.col("k"), F.col("v")).withColumns(
        {"partition": F.lit(1), "offset": F.lit(7).cast("bigint")}
    )
    assert [(r.key_size, r.value_size) for r in record_metadata(log).collect()] == [(1, 2), (None, 3)]
    assert log.select(describe().alias("d")).first()["d"] == "é | Topic: t | Partition: 1 | Offset: 7"


def test_send_metrics(spark):
    rows = [("k", "abc", False, 0), (None, "x", False, 9), ("k", None, True, 99)]
    df = spark.createDataFrame(rows, "key STRING, value STRING, failed BOOLEAN, latency_ms BIGINT")
    got = metrics.send_metrics(df).first().asDict()
    assert got == {
        "sent": 3,
        "success": 2,
        "failed": 1,
        "total_bytes": 6,
        "min_latency_ms": 1,
        "max_latency_ms": 9,
        "success_pct": 66.7,
        "avg_latency_ms": 5,
    }


def test_retry_decision(spark):
    rows = [(None, 1), ("TimeoutException", 1), ("TimeoutException", 3), ("SerializationException", 1)]
    df = spark.createDataFrame(rows, "error STRING, attempt INT").withColumn("timestamp", F.timestamp_millis(F.lit(1000)))
    got = routing.retry_decision(df).collect()
    assert [(r.outcome, r.not_before_ms) for r in got] == [("done", None), ("retry", 1100), ("dlt", None), ("dlt", None)]


def test_required_fields(spark):
    df = spark.createDataFrame([("a", "PENDING"), (None, "SENT"), ("b", None)], "orderId STRING, status STRING")
    codes = parsing.required_errors(["orderId", "status"], {"status": payloads.ORDER_STATUS})
    assert column(df.select(codes.alias("e")), "e") == [[], ["orderId_missing", "status_unknown"], ["status_missing"]]


def test_health(spark):
    df = spark.createDataFrame(
        [(1000, False, 5, 0.0), (1000, True, 5, 0.0), (-100_000, False, 50, 0.0), (1000, False, 5, 0.5)],
        "last_poll_ms BIGINT, rebalancing BOOLEAN, lag BIGINT, error_rate DOUBLE",
    )
    got = metrics.health(df, F.lit(2000), max_lag=10, max_error_rate=0.1).collect()
    assert [(r.alive, r.ready) for r in got] == [(True, True), (True, False), (False, False), (True, False)]
