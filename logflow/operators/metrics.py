"""Aggregates over logs: counts, balances, throughput, error rates, capacity and health."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logflow.operators.slices import SLICE_WIDTH, exact_quantiles, running_totals


def count_by(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("records"))


def balance_delta(action: str = "action", amount: str = "amount") -> Column:
    """An order adds its amount, a refund takes it away, anything else leaves the balance."""
    a = F.col(action)
    return (
        F.when(a == "ORDER", F.col(amount)).when(a == "REFUND", -F.col(amount)).otherwise(F.lit(0))
    ).cast("bigint")


def user_balances(parsed: DataFrame) -> DataFrame:
    """Balance per key from parsed actions; a key with only neutral actions has balance 0."""
    return parsed.groupBy("key").agg(F.sum(balance_delta()).alias("balance"))


def running_batch_aggregates(
    df: DataFrame, batch: str, value: Column, width: int = SLICE_WIDTH
) -> DataFrame:
    """Count, sum and average over all batches up to and including each one."""
    per_batch = df.groupBy(batch).agg(F.count("*").alias("_n"), F.sum(value).alias("_s"))
    running = running_totals(
        per_batch, [], [batch], {"count": F.col("_n"), "sum": F.coalesce("_s", F.lit(0))}, width
    )
    mean = F.when(F.col("count") > 0, F.col("sum") / F.col("count")).otherwise(F.lit(0.0))
    return running.select(batch, "count", "sum", mean.cast("double").alias("avg"))


def send_metrics(sent: DataFrame, *keys: str) -> DataFrame:
    """Counts, bytes, success rate and latency of sends.

    Needs key, value, ``failed`` and ``latency_ms``; a null key or value counts 0 bytes, a latency
    below 1 ms counts as 1, and failures have no latency.
    """
    size = F.coalesce(F.octet_length("key"), F.lit(0)) + F.coalesce(F.octet_length("value"), F.lit(0))
    latency = F.when(~F.col("failed"), F.greatest(F.lit(1), F.col("latency_ms")))
    return (
        sent.withColumns({"_size": size.cast("bigint"), "_latency": latency})
        .groupBy(*keys)
        .agg(
            F.count("*").alias("sent"),
            F.count_if(~F.col("failed")).alias("success"),
            F.count_if(F.col("failed")).alias("failed"),
            F.sum("_size").alias("total_bytes"),
            F.sum("_latency").alias("_total"),
            F.min("_latency").alias("min_latency_ms"),
            F.max("_latency").alias("max_latency_ms"),
        )
        .withColumns(
            {
                "success_pct": F.when(
                    F.col("sent") > 0, F.round(F.col("success") * 100.0 / F.col("sent"), 1)
                )
                .otherwise(F.lit(0.0))
                .cast("double"),
                "avg_latency_ms": F.when(F.col("success") > 0, F.expr("_total div success")),
            }
        )
        .drop("_total")
    )


def outcome_summary(df: DataFrame, failed: Column, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(
        F.count_if(~failed).alias("succeeded"), F.count_if(failed).alias("failed")
    )


# Alert thresholds.
ERROR_ALERT_PCT = 1.0
ERROR_PAGE_PCT = 5.0
DLT_PER_MINUTE = 100


def error_rate_alerts(df: DataFrame, failed: Column, ts: str = "timestamp") -> DataFrame:
    """Error share and quarantined rows per minute, with alert, page and escalation flags."""
    per_minute = df.groupBy(F.date_trunc("minute", ts).alias("minute")).agg(
        F.count("*").alias("records"), F.count_if(failed).alias("dlt_records")
    )
    pct = F.col("dlt_records") * 100.0 / F.col("records")
    return per_minute.withColumn("error_pct", pct.cast("double")).withColumns(
        {
            "alert": F.col("error_pct") > ERROR_ALERT_PCT,
            "page": F.col("error_pct") > ERROR_PAGE_PCT,
            "escalate": F.col("dlt_records") > DLT_PER_MINUTE,
        }
    )


def throughput(
    df: DataFrame, *keys: str, ts_ms: str = "ts_ms", size: str = "size"
) -> DataFrame:
    """Messages and megabytes per second over the recorded span of each group.

    ``mean_gap_ms`` is the span divided by the count: a mean time between records, not a latency.
    """
    spans = df.groupBy(*keys).agg(
        F.count("*").alias("records"),
        F.sum(size).alias("bytes"),
        (F.max(ts_ms) - F.min(ts_ms)).alias("duration_ms"),
    )
    d = F.nullif(F.col("duration_ms"), F.lit(0))
    return spans.withColumns(
        {
            "records_per_sec": F.col("records") * 1000.0 / d,
            "mb_per_sec": F.col("bytes") / d / 1000.0,
            "mean_gap_ms": d / F.col("records"),
        }
    )


def latency_percentiles(df: DataFrame, *keys: str, latency: str = "latency_ms") -> DataFrame:
    """Exact p50, p95 and p99 of an integral latency."""
    return exact_quantiles(df, list(keys), latency, {"p50": 0.5, "p95": 0.95, "p99": 0.99})


def approx_latency_percentiles(
    df: DataFrame, *keys: str, latency: str = "latency_ms", accuracy: int = 10000
) -> DataFrame:
    """One-pass estimate of the same percentiles."""
    return df.groupBy(*keys).agg(
        *[
            F.percentile_approx(latency, p, accuracy).alias(name)
            for name, p in (("p50", 0.5), ("p95", 0.95), ("p99", 0.99))
        ]
    )


def capacity_plan(
    rates: DataFrame, rate: str = "rate", per_consumer: str = "per_consumer", headroom_pct: int = 130
) -> DataFrame:
    """Consumers needed for a rate, and with headroom; partitions must be at least that many."""
    required = F.ceil(F.col(rate) / F.col(per_consumer))
    return rates.withColumn("required", required).withColumn(
        "reserved", F.ceil(F.col("required") * headroom_pct / 100)
    ).withColumn("min_partitions", F.col("reserved"))


# Fixed value: more events of the watched kind per hour than this is unstable.
UNSTABLE_PER_HOUR = 1


def stability(
    df: DataFrame, now_ms: Column, *keys: str, ts: str = "timestamp", duration: str = "duration_ms"
) -> DataFrame:
    """Watched events per hour, their durations, time since the hour's last one, instability flag."""
    per_hour = df.groupBy(*keys, F.date_trunc("hour", ts).alias("hour")).agg(
        F.count("*").alias("events"),
        F.sum(duration).alias("total_ms"),
        F.max(duration).alias("max_ms"),
        (now_ms - F.unix_millis(F.max(ts))).alias("since_last_ms"),
    )
    return per_hour.withColumn("unstable", F.col("events") > UNSTABLE_PER_HOUR)


def health(
    progress: DataFrame, now_ms: Column, max_lag: int, max_error_rate: float, max_idle_ms: int = 60000
) -> DataFrame:
    """``alive`` and ``ready`` from last poll, rebalance state, lag and error rate."""
    alive = now_ms - F.col("last_poll_ms") < max_idle_ms
    ready = ~F.col("rebalancing") & (F.col("lag") < max_lag) & (F.col("error_rate") < max_error_rate)
    return progress.withColumns({"alive": alive, "ready": ready})


def distinct_keys(df: DataFrame, *keys: str, key: str = "key", approximate: bool = False) -> DataFrame:
    count = F.approx_count_distinct(key) if approximate else F.count_distinct(F.col(key))
    return df.groupBy(*keys).agg(count.alias("distinct_keys"))


def dlt_breakdown(checked: DataFrame, error: str = "error", ts: str = "timestamp") -> DataFrame:
    """Quarantined rows per error and minute, their share of that minute's input, oldest one."""
    minute = F.date_trunc("minute", ts).alias("minute")
    per_error = checked.groupBy(minute, error).agg(
        F.count("*").alias("_n"), F.min(ts).alias("_oldest")
    )
    # Few rows per minute remain here: one per error class and one for the good records.
    inputs = per_error.groupBy("minute").agg(F.sum("_n").alias("input_records"))
    return (
        per_error.where(F.col(error).isNotNull())
        .join(inputs, "minute")
        .select(
            "minute",
            error,
            F.col("_n").alias("dlt_records"),
            "input_records",
            (F.col("_n") / F.col("input_records")).alias("share"),
            F.col("_oldest").alias("oldest"),
        )
    )
