"""Error classes, retry delays and delivery-time checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Error name, whether a retry can help, recommended action.
ERROR_CLASSES = [
    ("NetworkException", True, "retry later"),
    ("LeaderNotAvailableException", True, "wait for the leader election"),
    ("NotEnoughReplicasException", True, "wait for replicas"),
    ("TimeoutException", True, "check health, may have been delivered"),
    ("OffsetOutOfRangeException", True, "refresh metadata"),
    ("UnknownMemberIdException", True, "wait for the rebalance"),
    ("SerializationException", False, "fix the data"),
    ("RecordTooLargeException", False, "reduce the message size"),
    ("InvalidTopicException", False, "fix the topic name"),
    ("AuthorizationException", False, "fix permissions"),
    ("GroupAuthorizationException", False, "fix permissions"),
    ("OffsetMetadataTooLargeException", False, "shrink the metadata"),
    ("GroupCoordinatorNotAvailableException", False, "escalate"),
]

MAX_ATTEMPTS = 3
BASE_BACKOFF_MS = 100
MAX_BACKOFF_MS = 10000
JITTER_SHARE = 0.05


def classify_error(df: DataFrame, error: str = "error") -> DataFrame:
    """Add ``retriable`` and ``advice``; an unknown error is not retried."""
    known = F.create_map(
        *[x for n, r, a in ERROR_CLASSES for x in (F.lit(n), F.struct(F.lit(r).alias("r"), F.lit(a).alias("a")))]
    )
    hit = F.try_element_at(known, F.col(error))
    return df.withColumns(
        {
            "retriable": F.coalesce(hit["r"], F.lit(False)),
            "advice": F.coalesce(hit["a"], F.lit("unknown error, do not retry")),
        }
    )


def backoff_ms(
    attempt: Column, base: int = BASE_BACKOFF_MS, cap: int = MAX_BACKOFF_MS
) -> Column:
    """Delay after the given failed attempt (1, 2, …): doubling from ``base`` up to ``cap``."""
    return F.least(F.lit(float(base)) * F.pow(F.lit(2.0), attempt - 1), F.lit(float(cap))).cast("bigint")


def jittered(delay: Column, *seed: Column, share: float = JITTER_SHARE) -> Column:
    """``delay`` moved by up to ±``share``, decided by a hash of ``seed`` so that reruns agree."""
    unit = F.pmod(F.xxhash64(*seed), F.lit(1_000_001)) / F.lit(1_000_000.0)
    return F.greatest(F.lit(0), delay + (delay * share * (unit * 2 - 1)).cast("bigint"))


def gives_up(attempt: Column, max_attempts: int = MAX_ATTEMPTS) -> Column:
    return attempt >= max_attempts


def fixed_backoff_timeline(
    df: DataFrame, retries: Column, backoff: Column, delivery_timeout: Column
) -> DataFrame:
    """One row per attempt at 0, backoff, 2·backoff … while it starts inside the delivery timeout."""
    return (
        df.withColumn("attempt", F.explode(F.sequence(F.lit(0), retries.cast("int"))))
        .withColumn("at_ms", (F.col("attempt") * backoff).cast("bigint"))
        .where(F.col("at_ms") <= delivery_timeout)
    )


def delivery_timeout_ok(
    delivery_timeout: Column, retries: Column, backoff: Column, request_timeout: Column
) -> Column:
    return delivery_timeout >= retries * backoff + request_timeout
