"""Ordered computations over groups of any size.

``sum(...) OVER (PARTITION BY key ORDER BY id)`` sorts a whole key in one task, so one hot key (or
a log with four partitions) stops scaling.  The helpers here leave groups of up to ``width`` rows whole and cut
larger ones into slices of their order column, work inside slices in parallel and connect the slices with a
prefix sum over their totals.  Only large groups have totals, at most about one for every ``width`` / 64 rows,
however many groups are interleaved.  Results equal the plain window.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logflow.scratch import materialize

#: Rows of a group that one task sorts: larger groups are cut into slices of about as many rows or less.
SLICE_WIDTH = 1 << 16

#: Rows of one group handled together by the look-back windows.
BLOCK_ROWS = 1 << 15

#: Ranges between quantiles of the order column that a large group is cut into before it is cut evenly.
RANGES = 64

#: Numbers of the slices inside one range lie below this.
RANGE_SPAN = 1 << 40

#: Rows without an order value sort first, as ascending order does.
NULL_SLICE = -(1 << 62)


def _ranges(order: Column, width: int) -> list[Column]:
    """Aggregates of one large group: where its ranges start, and the step of the slices inside each.

    Ranges hold about equal shares of the rows, wherever these lie; a range is cut evenly, so that a slice has
    about ``width`` rows or less.
    """
    spots = F.array(*[F.lit(i / RANGES) for i in range(1, RANGES)])
    inner = F.coalesce(F.percentile_approx(order, spots, F.lit(20 * RANGES)), F.array().cast("array<bigint>"))
    parts = F.ceil(F.count("*") / F.lit(RANGES * width)).cast("double")
    first, last = F.concat(F.array(F.min(order)), inner), F.concat(inner, F.array(F.max(order)))
    steps = F.zip_with(
        first, last, lambda a, b: F.greatest((b.cast("double") - a.cast("double")) / parts, F.lit(1.0))
    )
    return [first.alias("_firsts"), steps.alias("_steps")]


@dataclass(frozen=True)
class Cuts:
    """How the groups of a table are cut: ``table`` has the ranges of large groups (none: there are no large ones).

    Without keys the table is one group, whose ranges are the literals ``firsts`` and ``steps``.
    """

    keys: list[str]
    order: str
    table: DataFrame | None = None
    firsts: list[int] | None = None
    steps: list[float] | None = None

    @property
    def any(self) -> bool:
        return self.table is not None or self.firsts is not None

    def apply(self, df: DataFrame, extra: list[Column]) -> DataFrame:
        """Add ``_group``, ``_slice``, ``_large`` (the group is cut) and the ``extra`` columns."""
        group = (F.struct(*self.keys) if self.keys else F.lit(0)).alias("_group")
        rows = df.select("*", group, *extra)
        if not self.any:
            return rows.select("*", F.lit(0).cast("bigint").alias("_slice"), F.lit(False).alias("_large"))
        if self.table is None:
            firsts = F.array(*[F.lit(v) for v in self.firsts]).cast("array<bigint>")
            steps = F.array(*[F.lit(v) for v in self.steps]).cast("array<double>")
        else:
            rows = rows.join(self.table, "_group", "left")
            firsts, steps = F.col("_firsts"), F.col("_steps")
        order = F.col(self.order).cast("bigint")
        at = F.size(F.filter(firsts, lambda first: first <= order))
        inside = (order.cast("double") - F.get(firsts, at - 1).cast("double")) / F.get(steps, at - 1)
        piece = (
            F.when(firsts.isNull(), F.lit(0))
            .when(order.isNull(), F.lit(NULL_SLICE))
            .otherwise(at.cast("bigint") * RANGE_SPAN + F.floor(inside))
        )
        cut = rows.select("*", piece.cast("bigint").alias("_slice"), firsts.isNotNull().alias("_large"))
        return cut.drop("_firsts", "_steps")


def cuts(df: DataFrame, keys: list[str], order: str, width: int = SLICE_WIDTH) -> Cuts:
    """Find the groups of more than ``width`` rows and their quantiles; reads only keys and order column.

    Rows are counted per key first (partial sums before the shuffle); quantiles are merged sketches of the large
    groups alone.  The large groups, at most one for every ``width`` rows, are a table in the shared folder, which
    Spark broadcasts below its own threshold and joins by shuffle beyond it.
    """
    at = F.col(order).cast("bigint").alias("_at")
    if not keys:
        row = df.select(at).agg(*_ranges(F.col("_at"), width)).first()
        known = row["_firsts"][0] is not None
        return Cuts(keys, order, None, row["_firsts"] if known else [0], row["_steps"] if known else [1.0])
    rows = df.select(F.struct(*keys).alias("_group"), at)
    large = materialize(
        rows.groupBy("_group").agg(F.count("*").alias("_n")).where(F.col("_n") > width).select("_group"), "large"
    )
    if large.isEmpty():
        return Cuts(keys, order)
    ranges = rows.join(large, "_group", "left_semi").groupBy("_group").agg(*_ranges(F.col("_at"), width))
    known = F.get("_firsts", F.lit(0)).isNotNull()
    return Cuts(keys, order, materialize(ranges.where(known), "ranges"))


def running_totals(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    sums: dict[str, Column],
    width: int = SLICE_WIDTH,
    cut: Cuts | None = None,
) -> DataFrame:
    """Add inclusive running sums per ``keys`` in ``order``; ``lit(1)`` gives a 1-based dense rank.

    ``order[0]`` must be an integral column whose values spread the rows (an id, an offset, epoch
    seconds); the whole list must order rows uniquely.  Null keys form their own group, because the
    group travels as a struct.  Null values add nothing.  The big side is shuffled once, on (group, slice).
    ``cut`` is how groups are cut, where that is known already.
    """
    group, piece = "_group", "_slice"
    local = {name: f"_local_{name}" for name in sums}
    start = {name: f"_start_{name}" for name in sums}
    cut = cut or cuts(df, keys, order[0], width)
    sliced = cut.apply(df, [expr.alias(local[name]) for name, expr in sums.items()])
    inside = (
        Window.partitionBy(group, piece)
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    ranked = sliced.withColumns({local[n]: F.sum(local[n]).over(inside) for n in sums})
    if not cut.any:
        return ranked.select(*df.columns, *[F.col(local[n]).alias(n) for n in sums])
    before = Window.partitionBy(group).orderBy(piece).rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        sliced.where("_large")
        .groupBy(group, piece)
        .agg(*[F.sum(local[name]).alias(start[name]) for name in sums])
        .select(
            group,
            piece,
            *[F.sum(start[n]).over(before).alias(start[n]) for n in sums],
        )
    )
    return ranked.join(starts, [group, piece], "left").select(
        *df.columns, *[_added(F.col(local[n]), F.col(start[n])).alias(n) for n in sums]
    )


def _added(a: Column, b: Column) -> Column:
    """Sum that takes a null for nothing; null only if both are."""
    return F.coalesce(a + b, a, b)


def running_since(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    restart: Column,
    sums: dict[str, Column],
    width: int = SLICE_WIDTH,
    cut: Cuts | None = None,
) -> DataFrame:
    """Running sums that start over at every row where ``restart`` holds (that row included).

    A slice hands on what it summed since its last restart; a later slice adds it up to its own
    first restart.  A null ``restart`` is none.  ``cut`` is as in ``running_totals``.
    """
    group, piece, stretch = "_group", "_slice", "_stretch"
    local = {name: f"_local_{name}" for name in sums}
    start = {name: f"_start_{name}" for name in sums}
    inside = (
        Window.partitionBy(group, piece)
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    since = (
        Window.partitionBy(group, piece, stretch)
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    cut = cut or cuts(df, keys, order[0], width)
    since_start = F.coalesce(restart, F.lit(False)).cast("bigint").alias("_restart")
    sliced = cut.apply(df, [since_start, *[expr.alias(local[name]) for name, expr in sums.items()]])
    sliced = sliced.withColumn(stretch, F.sum("_restart").over(inside))
    summed = sliced.withColumns({local[n]: F.sum(local[n]).over(since) for n in sums})
    if not cut.any:
        return summed.select(*df.columns, *[F.col(local[n]).alias(n) for n in sums])
    # What each slice hands on: its last stretch, which is all of it when nothing restarted.
    tails = (
        sliced.where("_large")
        .groupBy(group, piece, stretch)
        .agg(*[F.sum(local[n]).alias(start[n]) for n in sums])
        .groupBy(group, piece)
        .agg(
            F.max(stretch).alias("_restarts"),
            *[F.max_by(start[n], stretch).alias(start[n]) for n in sums],
        )
    )
    by_slice = Window.partitionBy(group).orderBy(piece)
    upto = by_slice.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    era = tails.withColumn("_era", F.count_if(F.col("_restarts") > 0).over(upto))
    in_era = Window.partitionBy(group, "_era").orderBy(piece)
    carried = era.withColumns(
        {start[n]: F.sum(start[n]).over(in_era.rowsBetween(Window.unboundedPreceding, 0)) for n in sums}
    )
    starts = carried.select(
        group,
        piece,
        *[F.lag(start[n]).over(by_slice).alias(start[n]) for n in sums],
    )
    carry = F.col(stretch) == 0
    return summed.join(starts, [group, piece], "left").select(
        *df.columns,
        *[_added(F.col(local[n]), F.when(carry, F.col(start[n]))).alias(n) for n in sums],
    )


def lookback_blocks(df: DataFrame, rank: str, lookback: int, block: int = BLOCK_ROWS) -> DataFrame:
    """Give every row a ``_block``, and copy the last ``lookback`` rows of a block into the next one.

    A window over (key, _block) then sees all the rows it may look back to.  Copies carry
    ``_copy = true`` and are dropped after the window.  ``rank`` is dense per group (from 0).
    """
    if not 0 < lookback <= block:
        raise ValueError("lookback must be between 1 and the block size")
    own = F.expr(f"`{rank}` div {block}")
    spill = F.col(rank) % block >= block - lookback
    homes = F.when(spill, F.array(own, own + 1)).otherwise(F.array(own))
    return df.withColumn("_block", F.explode(homes)).withColumn("_copy", F.col("_block") != own)


def rank_by(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    out: str = "rank",
    width: int = SLICE_WIDTH,
    cut: Cuts | None = None,
) -> DataFrame:
    """Dense 0-based rank per group."""
    ranked = running_totals(df, keys, order, {out: F.lit(1).cast("bigint")}, width, cut)
    return ranked.withColumn(out, F.col(out) - 1)


def over_last_rows(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    lookback: int,
    outputs,
    width: int = SLICE_WIDTH,
    block: int = BLOCK_ROWS,
) -> DataFrame:
    """Window expressions that look back at most ``lookback`` rows, safe for hot keys.

    ``outputs(w)`` gets the window (partitioned and ordered, no frame) and returns name → Column.
    A list of such functions is applied in turn, each over the columns of the one before; then
    ``lookback`` must cover their look-backs together.
    """
    ranked = lookback_blocks(rank_by(df, keys, order, "_rank", width), "_rank", lookback, block)
    w = Window.partitionBy(*keys, "_block").orderBy("_rank")
    for stage in outputs if isinstance(outputs, list) else [outputs]:
        ranked = ranked.withColumns(stage(w))
    return ranked.where(~F.col("_copy")).drop("_rank", "_block", "_copy")


def exact_quantiles(
    df: DataFrame,
    keys: list[str],
    value: str,
    probabilities: dict[str, float],
    width: int = SLICE_WIDTH,
) -> DataFrame:
    """Exact linearly interpolated quantiles of an integral column.

    Rows are first counted per distinct value, then the counts are prefix-summed, so neither a hot
    key nor a wide value range ends in one task's memory.
    """
    rows = df.where(F.col(value).isNotNull())
    if not keys:  # one group: the same joins and sums, over a constant key
        whole = exact_quantiles(rows.withColumn("_all", F.lit(0)), ["_all"], value, probabilities, width)
        return whole.drop("_all")
    counts = rows.groupBy(*keys, value).agg(F.count("*").alias("_n"))
    cumulative = running_totals(counts, keys, [value], {"_upto": F.col("_n")}, width)
    sizes = counts.groupBy(*keys).agg(F.sum("_n").alias("_total"))
    same = [cumulative[k].eqNullSafe(sizes[k]) for k in keys]
    joined = cumulative.join(sizes, same).select(
        *[cumulative[k] for k in keys], value, "_upto", "_total"
    )
    picks = []
    for name, p in probabilities.items():
        spot = (F.col("_total") - 1) * F.lit(p)
        picks.append(F.min(F.when(F.col("_upto") > F.floor(spot), F.col(value))).alias(f"_lo_{name}"))
        picks.append(F.min(F.when(F.col("_upto") > F.ceil(spot), F.col(value))).alias(f"_hi_{name}"))
    picked = joined.groupBy(*keys).agg(F.max("_total").alias("_total"), *picks)
    out = []
    for name, p in probabilities.items():
        spot = (F.col("_total") - 1) * F.lit(p)
        low, high = F.col(f"_lo_{name}"), F.col(f"_hi_{name}")
        out.append((low + (high - low) * (spot - F.floor(spot))).alias(name))
    return picked.select(*keys, F.col("_total").alias("n"), *out)
