"""Lookups against tables: enrichment with fallback, deduplication against a log of seen ids.

No broadcast hints: Spark broadcasts a side only below its own size threshold, and splits skewed
join partitions at run time otherwise.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def enrich_with_fallback(
    facts: DataFrame, table: DataFrame, fact_key: str, table_key: str, fallback: dict[str, str]
) -> DataFrame:
    """Left join; a missing row yields the fallback text in each looked-up column."""
    looked_up = table.select(F.col(table_key).alias("_lookup"), *fallback)
    joined = facts.join(looked_up, facts[fact_key] == F.col("_lookup"), "left")
    filled = {c: F.coalesce(F.col(c), F.lit(text)) for c, text in fallback.items()}
    return joined.drop("_lookup").withColumns(filled)


def not_seen(batch: DataFrame, seen: DataFrame, key: str) -> DataFrame:
    """Rows whose id is not in the log of processed ids."""
    return batch.join(seen.select(key), [key], "left_anti")


def already_seen(batch: DataFrame, seen: DataFrame, key: str) -> DataFrame:
    return batch.join(seen.select(key), [key], "left_semi")


def first_arrivals(df: DataFrame, key: str, order: Column, columns: list[str]) -> DataFrame:
    """One row per id, the earliest; pre-aggregated before the shuffle, so copies cost nothing."""
    rest = [c for c in columns if c != key]
    return df.groupBy(key).agg(F.min_by(F.struct(*rest), order).alias("_row")).select(key, "_row.*")
