"""Event-sourced accounts: fold an account's events into its state, at any point in time.

Events have account_id, seq (unique, increasing), type, amount and timestamp.  Opening sets the
balance, deposits and interest add, withdrawals subtract, closing leaves it.  The history of an
account stays in rows (``account_history``); nothing collects it into one array.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logflow.operators.slices import SLICE_WIDTH, cuts, rank_by, running_since, running_totals

# Event types and their effect.
OPENED, DEPOSITED, WITHDRAWN, INTEREST, CLOSED = "OPENED", "DEPOSITED", "WITHDRAWN", "INTEREST", "CLOSED"


def effect() -> Column:
    """Amount an event contributes to the balance of its epoch."""
    kind = F.col("type")
    return (
        F.when(kind.isin(OPENED, DEPOSITED, INTEREST), F.col("amount"))
        .when(kind == WITHDRAWN, -F.col("amount"))
        .otherwise(F.lit(0))
    )


def _epochs(events: DataFrame, width: int) -> DataFrame:
    """Number the stretches between openings: an opening starts a new one and discards the old sum."""
    return running_totals(
        events, ["account_id"], ["seq"], {"_epoch": (F.col("type") == OPENED).cast("bigint")}, width
    )


def _fold(per_epoch: DataFrame) -> DataFrame:
    newest = F.max_by("_balance", "_epoch")
    return per_epoch.groupBy("account_id").agg(
        newest.alias("balance"),
        F.sum("_events").alias("version"),
        F.max("_last_seq").alias("last_seq"),
        F.max("_updated_at").alias("updated_at"),
        F.max_by("_closed", "_last_seq").alias("closed"),
    )


def _per_epoch(events: DataFrame, width: int) -> DataFrame:
    return _epochs(events, width).groupBy("account_id", "_epoch").agg(
        F.sum(effect()).alias("_balance"),
        F.count("*").alias("_events"),
        F.max("seq").alias("_last_seq"),
        F.max("timestamp").alias("_updated_at"),
        F.max_by(F.col("type") == CLOSED, "seq").alias("_closed"),
    )


def account_projection(events: DataFrame, width: int = SLICE_WIDTH) -> DataFrame:
    """Current state per account: balance, version (events applied), last event, closed or not."""
    return _fold(_per_epoch(events, width))


def state_as_of(events: DataFrame, instant: Column, width: int = SLICE_WIDTH) -> DataFrame:
    """State from the events up to and including ``instant``."""
    return account_projection(events.where(F.col("timestamp") <= instant), width)


def account_history(events: DataFrame, width: int = SLICE_WIDTH) -> DataFrame:
    """Every event with the version and balance it produced."""
    opened = F.col("type") == OPENED
    cut = cuts(events, ["account_id"], "seq", width)
    numbered = rank_by(events, ["account_id"], ["seq"], "version", width, cut)
    numbered = numbered.withColumn("version", F.col("version") + 1)
    return running_since(numbered, ["account_id"], ["seq"], opened, {"balance": effect()}, width, cut)


def snapshot(events: DataFrame, upto_seq: int, width: int = SLICE_WIDTH) -> DataFrame:
    """Saved state after all events with ``seq <= upto_seq``."""
    return account_projection(events.where(F.col("seq") <= upto_seq), width)


def rebuild_state(
    saved: DataFrame, events: DataFrame, after_seq: int, width: int = SLICE_WIDTH
) -> DataFrame:
    """Snapshot plus the events after it; equals the projection of all events."""
    tail = _per_epoch(events.where(F.col("seq") > after_seq), width)
    base = saved.select(
        "account_id",
        F.lit(0).cast("bigint").alias("_epoch"),
        F.col("balance").alias("_balance"),
        F.col("version").alias("_events"),
        F.col("last_seq").alias("_last_seq"),
        F.col("updated_at").alias("_updated_at"),
        F.col("closed").alias("_closed"),
    )
    merged = base.unionByName(tail).groupBy("account_id", "_epoch").agg(
        F.sum("_balance").alias("_balance"),
        F.sum("_events").alias("_events"),
        F.max_by("_closed", "_last_seq").alias("_closed"),
        F.max("_last_seq").alias("_last_seq"),
        F.max("_updated_at").alias("_updated_at"),
    )
    return _fold(merged)


def aggregate_versions(events: DataFrame, width: int = SLICE_WIDTH) -> DataFrame:
    """(aggregate_id, version, state, updated_at): the latest state of each aggregate as JSON."""
    state = F.to_json(F.struct("balance", "closed"))
    return account_projection(events, width).select(
        F.col("account_id").alias("aggregate_id"),
        "version",
        state.alias("state"),
        "balance",
        "closed",
        "updated_at",
    )


def views(events: DataFrame) -> dict[str, DataFrame]:
    """Independent read models of one log: totals by event type, and daily flow."""
    by_type = events.groupBy("type").agg(
        F.count("*").alias("events"), F.sum("amount").alias("amount")
    )
    daily = events.groupBy(F.to_date("timestamp").alias("day")).agg(
        F.count("*").alias("events"),
        F.sum(F.when(F.col("type") != OPENED, effect()).otherwise(F.lit(0))).alias("net_flow"),
    )
    return {"by_type": by_type, "daily": daily}
