"""Record headers: lookup, appending and chains of enrichment steps."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def header(name: str, headers: str = "headers") -> Column:
    """First value of the named header, null when it is missing."""
    return F.get(F.filter(F.col(headers), lambda h: h["key"] == name), F.lit(0))["value"]


def make_headers(**values: Column) -> Column:
    """Headers from name → value (underscores become dashes); a null value leaves its header out."""
    pairs = [
        F.when(
            v.isNotNull(),
            F.struct(F.lit(k.replace("_", "-")).alias("key"), v.cast("string").alias("value")),
        )
        for k, v in values.items()
    ]
    return F.array_compact(F.array(*pairs))


def append_header(name: str, value: Column, headers: str = "headers") -> Column:
    added = F.array(F.struct(F.lit(name).alias("key"), value.cast("string").alias("value")))
    return F.concat(F.coalesce(F.col(headers), F.slice(added, 1, 0)), added)


def add_timestamp_header(instant: Column) -> Callable[[DataFrame], DataFrame]:
    """Append ``X-Timestamp`` with the ISO form of ``instant`` (passed in, so reruns agree)."""
    text = F.date_format(instant, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    return lambda df: df.withColumn("headers", append_header("X-Timestamp", text))


def trace_id(*parts: Column) -> Column:
    """16 hex characters, the same for the same record."""
    return F.substring(F.md5(F.concat_ws("|", *[p.cast("string") for p in parts])), 1, 16)


def add_trace_header(*parts: Column) -> Callable[[DataFrame], DataFrame]:
    return lambda df: df.withColumn("headers", append_header("X-Trace-Id", trace_id(*parts)))


def live_trace_header() -> Callable[[DataFrame], DataFrame]:
    """Random ids for live use; a recomputed task draws new ones, so write the result before reuse."""
    fresh = F.substring(F.regexp_replace(F.uuid(), "-", ""), 1, 16)
    return lambda df: df.withColumn("headers", append_header("X-Trace-Id", fresh))


def enrich_chain(df: DataFrame, steps: list[Callable[[DataFrame], DataFrame]]) -> DataFrame:
    """Apply the steps in order, each on the output of the one before.

    A step that computes something fallible should use ``try_*`` expressions, so that a bad row
    loses that one field and keeps the others.
    """
    for step in steps:
        df = df.transform(step)
    return df
