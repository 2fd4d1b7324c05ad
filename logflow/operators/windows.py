"""Windows over keyed records, all safe for keys of any size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logflow.operators.slices import BLOCK_ROWS, SLICE_WIDTH, over_last_rows, running_totals


def count_window(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    n: int,
    aggregates: dict[str, Column],
    width: int = SLICE_WIDTH,
    block: int = BLOCK_ROWS,
) -> DataFrame:
    """Aggregates over the last ``n`` records of the key, this one included."""
    return over_last_rows(
        df,
        keys,
        order,
        max(n - 1, 1),
        lambda w: {name: a.over(w.rowsBetween(-(n - 1), 0)) for name, a in aggregates.items()},
        width,
        block,
    )


PARTIAL = {"sum": F.sum, "count": F.count, "min": F.min, "max": F.max}
MERGE = {"sum": F.sum, "count": F.sum, "min": F.min, "max": F.max}


def time_range_window(
    df: DataFrame,
    keys: list[str],
    seconds_col: str,
    n: int,
    aggregates: dict[str, tuple[str, Column]],
    block_seconds: int = 6 * 3600,
) -> DataFrame:
    """Aggregates over the last ``n`` seconds before each record (same second included).

    ``aggregates`` maps a name to ("sum" | "count" | "min" | "max", column).  Rows are first reduced
    to one per key and second, so a task sees at most ``block_seconds + n`` rows of a key whatever
    its rate; the windows run over those, in time blocks that also get the tail of the block before.  A row
    without a time gets nulls.
    """
    group, second = "_group", "_second"
    rows = df.select("*", F.struct(*keys).alias(group), F.col(seconds_col).alias(second))
    per_second = rows.groupBy(group, second).agg(
        *[PARTIAL[kind](column).alias(name) for name, (kind, column) in aggregates.items()]
    )
    size = max(block_seconds, n)
    own = F.expr(f"({second} - pmod({second}, {size})) div {size}")
    spill = F.pmod(second, F.lit(size)) >= size - n
    homes = F.when(spill, F.array(own, own + 1)).otherwise(F.array(own))
    spread = per_second.withColumn("_block", F.explode(homes)).withColumn("_copy", F.col("_block") != own)
    w = Window.partitionBy(group, "_block").orderBy(second).rangeBetween(-n, 0)
    windowed = spread.withColumns(
        {name: MERGE[kind](name).over(w) for name, (kind, _) in aggregates.items()}
    ).where(~F.col("_copy"))
    found = windowed.select(group, second, *aggregates)
    return rows.join(found, [group, second], "left").drop(group, second)


def rolling_failure_rate(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    failed: str,
    n: int = 10,
    trip_at: float = 0.5,
    width: int = SLICE_WIDTH,
    block: int = BLOCK_ROWS,
) -> DataFrame:
    """Failure share of the last ``n`` records and whether it trips (only with ``n`` records there)."""
    flag = F.col(failed).cast("int")
    windowed = count_window(
        df, keys, order, n, {"_seen": F.count(F.lit(1)), "failures": F.sum(flag)}, width, block
    )
    return windowed.withColumns(
        {
            "failure_rate": F.col("failures") / F.col("_seen"),
            "tripped": (F.col("_seen") == n) & (F.col("failures") >= trip_at * n),
        }
    ).drop("_seen")


def latest_per_key(df: DataFrame, keys: list[str], version: list[str]) -> DataFrame:
    """The newest row per key; reduced before the shuffle, whatever the number of versions."""
    rest = [c for c in df.columns if c not in keys]
    newest = F.max_by(F.struct(*rest), F.struct(*version)).alias("_row")
    return df.groupBy(*keys).agg(newest).select(*keys, "_row.*")


def running_balance(
    df: DataFrame, keys: list[str], order: list[str], delta: Column, width: int = SLICE_WIDTH
) -> DataFrame:
    """Balance and 1-based version after every record of the key."""
    return running_totals(
        df, keys, order, {"balance": delta, "version": F.lit(1).cast("bigint")}, width
    )
