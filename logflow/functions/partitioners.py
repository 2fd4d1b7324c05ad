"""Column functions that choose a record's partition."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logflow.operators.slices import SLICE_WIDTH, rank_by


def key_hash(key: Column) -> Column:
    """32-bit hash of a string key that any SQL engine can recompute: first 8 hex digits of md5."""
    return F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("bigint")


def by_key(n: int, key: str = "key") -> Column:
    """Same key, same partition.  A null key gives null: combine with another rule."""
    return F.pmod(key_hash(F.col(key)), F.lit(n)).cast("int")


def explicit(n: int, chosen: str) -> Column:
    """The caller's partition, or an error when it does not exist."""
    p = F.col(chosen)
    return F.when((p >= 0) & (p < n), p.cast("int")).otherwise(
        F.raise_error(F.format_string("partition %s is not in [0, %d)", p.cast("string"), F.lit(n)))
    )


# Key prefix of a region and its partition before the modulo.
REGION_PREFIXES = [("US-", 0), ("EU-", 1), ("APAC-", 2)]
OTHER_REGION = 3


def by_region(n: int, key: str = "key") -> Column:
    """Partition by the region prefix of the key; null keys go to the last partition."""
    k = F.col(key)
    rule = F.when(k.isNull(), F.lit(n - 1))
    for prefix, home in REGION_PREFIXES:
        rule = rule.when(k.startswith(prefix), F.lit(home % n))
    return rule.otherwise(F.lit(OTHER_REGION % n)).cast("int")


def turn(position: Column, n: int, batch: int = 1) -> Column:
    """Partition of the record at a 0-based position; ``batch`` neighbours stay together."""
    return F.pmod(F.floor(position / batch), F.lit(n)).cast("int")


def round_robin(
    df: DataFrame, n: int, order: list[str], batch: int = 1, width: int = SLICE_WIDTH
) -> DataFrame:
    """Spread records evenly in ``order``; ``batch`` > 1 keeps that many neighbours together."""
    ranked = rank_by(df, [], order, "_position", width)
    return ranked.withColumn("partition", turn(F.col("_position"), n, batch)).drop("_position")
