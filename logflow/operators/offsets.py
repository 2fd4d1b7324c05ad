"""Offset assignment, committed progress, checkpoints and lag."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logflow.operators.slices import SLICE_WIDTH, over_last_rows, rank_by, running_totals
from logflow.sources.log import newest_commits, with_position


def assign_offsets(
    df: DataFrame,
    order: list[str],
    ends: DataFrame | None = None,
    width: int = SLICE_WIDTH,
) -> DataFrame:
    """Dense offsets per (topic, partition) in arrival ``order``, after the existing ``ends``."""
    ranked = rank_by(df, ["topic", "partition"], order, "offset", width)
    if ends is None:
        return ranked
    placed = with_position(ranked, ends, "end_offset", "_end")
    return placed.withColumn("offset", F.col("offset") + F.coalesce("_end", F.lit(0))).drop("_end")


def commit_offsets(processed: DataFrame, group: str, at: Column | None = None) -> DataFrame:
    """Progress after processing: the position of the next record per (group, topic, partition)."""
    return processed.groupBy("topic", "partition").agg((F.max("offset") + 1).alias("offset")).select(
        F.lit(group).alias("consumer_group"),
        "topic",
        "partition",
        "offset",
        (at if at is not None else F.lit(None)).cast("timestamp").alias("updated_at"),
    )


def checkpoints(
    log: DataFrame, group: str, every: int, count_and_sum: Column, width: int = SLICE_WIDTH
) -> DataFrame:
    """State saved after every ``every`` records of a partition and at its end.

    The state is the running record count and the running sum of ``count_and_sum``.
    """
    saved = (
        log.withColumn("_bucket", F.expr(f"offset div {every}"))
        .groupBy("topic", "partition", "_bucket")
        .agg(
            (F.max("offset") + 1).alias("offset"),
            F.count("*").alias("_n"),
            F.coalesce(F.sum(count_and_sum), F.lit(0)).alias("_s"),
            F.max("timestamp").alias("updated_at"),
        )
    )
    running = running_totals(
        saved,
        ["topic", "partition"],
        ["_bucket"],
        {"state_count": F.col("_n"), "state_sum": F.col("_s")},
        width,
    )
    return running.select(
        F.lit(group).alias("consumer_group"),
        "topic",
        "partition",
        "offset",
        "state_count",
        "state_sum",
        F.to_json(
            F.struct(F.col("state_count").alias("count"), F.col("state_sum").alias("sum"))
        ).alias("state_json"),
        "updated_at",
    )


def recover(saved: DataFrame) -> DataFrame:
    """The last checkpoint per (group, topic, partition)."""
    rest = [c for c in saved.columns if c not in ("consumer_group", "topic", "partition")]
    return saved.groupBy("consumer_group", "topic", "partition").agg(
        F.max_by(F.struct(*rest), "offset").alias("_last")
    ).select("consumer_group", "topic", "partition", "_last.*")


def consumer_lag(ends: DataFrame, commits: DataFrame, *groups: str) -> DataFrame:
    """End offset, committed offset and lag per group and partition; no commit counts from the first record.

    ``ends`` are the bounds of the log's partitions (``bounds`` or ``store_bounds``), read once for all groups.
    Commits may be an append-only history: the newest one of a partition counts.
    """
    mine = newest_commits(commits).select("consumer_group", "topic", "partition", F.col("offset").alias("_committed"))
    asked = ends.withColumn("consumer_group", F.explode(F.array(*map(F.lit, groups))))
    committed = F.coalesce("_committed", "begin_offset")
    return asked.join(mine, ["consumer_group", "topic", "partition"], "left").select(
        "consumer_group",
        "topic",
        "partition",
        "end_offset",
        committed.alias("committed"),
        (F.col("end_offset") - committed).alias("lag"),
    )


# Lag bands, lower bound included, upper bound excluded.
LAG_BANDS = [
    (0, 1000, "none"),
    (1000, 10000, "monitor"),
    (10000, 100001, "scale soon"),
    (100001, None, "emergency"),
]


def lag_bands(df: DataFrame, lag: str = "lag") -> DataFrame:
    """Add the ``action`` of the band each lag falls into.

    The bands are few and fixed, so this is an expression over the row and not a range join.
    """
    action = F.lit(None).cast("string")
    for low, high, name in LAG_BANDS:
        inside = F.col(lag) >= low
        if high is not None:
            inside &= F.col(lag) < high
        action = F.when(inside, name).otherwise(action)
    return df.withColumn("action", action)


def lag_summary(lags: DataFrame) -> DataFrame:
    """Total lag and the worst partition (lowest number on a tie) per group."""
    return lags.groupBy("consumer_group").agg(
        F.sum("lag").alias("total_lag"),
        F.max("lag").alias("max_lag"),
        F.max_by("partition", F.struct(F.col("lag"), -F.col("partition"))).alias("worst_partition"),
    )


def lag_trend(lag_per_minute: DataFrame, run: int = 5) -> DataFrame:
    """Direction of the lag from minute to minute and an alert after ``run`` growing minutes in a row.

    Input is one row per minute (``minute`` as epoch minutes, ``lag``), already aggregated.
    """

    def step(w):
        return {"_step": F.col("lag") - F.lag("lag").over(w)}

    def alert(w):
        last = w.rowsBetween(-(run - 1), 0)
        return {
            "growing_alert": (F.min("_step").over(last) > 0) & (F.count("_step").over(last) == run)
        }

    flagged = over_last_rows(lag_per_minute, [], ["minute"], run, [step, alert])
    trend = (
        F.when(F.col("lag") == 0, "zero")
        .when(F.col("_step") > 0, "growing")
        .when(F.col("_step") < 0, "shrinking")
        .otherwise("stable")
    )
    return flagged.select(
        "minute", "lag", trend.alias("trend"), F.coalesce("growing_alert", F.lit(False)).alias("growing_alert")
    )


def key_partition_map(log: DataFrame) -> DataFrame:
    """Each key's partition and whether it was ever seen on another one."""
    return log.groupBy("key").agg(
        F.min("partition").alias("partition"),
        (F.min("partition") != F.max("partition")).alias("violation"),
    )


def order_violations(
    log: DataFrame, arrival: str, width: int = SLICE_WIDTH
) -> DataFrame:
    """Per key: its record count and how often arrival order disagrees with offset order."""
    stepped = over_last_rows(
        log.select("key", "offset", arrival),
        ["key"],
        ["offset"],
        1,
        lambda w: {"_previous": F.lag(arrival).over(w)},
        width,
    )
    return stepped.groupBy("key").agg(
        F.count("*").alias("records"),
        F.count_if(F.col("_previous") > F.col(arrival)).alias("violations"),
    )
