"""Routing records to destinations and splitting off failures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logflow.functions.errors import backoff_ms, classify_error, gives_up


def route(df: DataFrame, cases: list[tuple[Column, str]], default: str) -> DataFrame:
    """Add ``route``: the destination of the first case that holds."""
    chosen = F.lit(default)
    for condition, destination in reversed(cases):
        chosen = F.when(condition, F.lit(destination)).otherwise(chosen)
    return df.withColumn("route", chosen)


def route_counts(routed: DataFrame) -> DataFrame:
    return routed.groupBy("route").agg(F.count("*").alias("records"))


def write_routes(routed: DataFrame, path: str, mode: str = "append") -> None:
    """One pass, one folder per destination."""
    routed.write.mode(mode).partitionBy("route").parquet(path)


def retry_decision(failed: DataFrame, error: str = "error", attempt: str = "attempt") -> DataFrame:
    """Where a processed record goes: ``done``, ``retry`` (with ``not_before``) or ``dlt``.

    ``error`` is null for a success.  A retriable error is tried again until the attempts run out.
    """
    classified = classify_error(failed, error)
    again = F.col("retriable") & ~gives_up(F.col(attempt))
    outcome = F.when(F.col(error).isNull(), "done").when(again, "retry").otherwise("dlt")
    due = F.unix_millis("timestamp") + backoff_ms(F.col(attempt))
    return classified.withColumn("outcome", outcome).withColumn(
        "not_before_ms", F.when(F.col("outcome") == "retry", due)
    )
