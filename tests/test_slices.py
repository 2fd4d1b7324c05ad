"""Sliced computations must equal the plain windows they replace, hot keys and nulls included."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from logflow.operators import slices
from logflow.operators.windows import count_window, time_range_window


@pytest.fixture(scope="module")
def skewed(spark):
    """3000 rows; one key has over a third of them, some keys are null, ids have gaps."""
    rng = random.Random(7)
    rows, id_ = [], 0
    for _ in range(3000):
        id_ += rng.choice([1, 1, 1, 2, 9])
        key = "hot" if rng.random() < 0.4 else rng.choice(["a", "b", "c", None])
        rows.append((key, id_, rng.randrange(-50, 100), 1_700_000_000 + rng.randrange(40_000)))
    return spark.createDataFrame(rows, "k STRING, id BIGINT, v BIGINT, sec BIGINT").cache()


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.mark.parametrize("width", [10, 97, 1 << 18])
@pytest.mark.parametrize("keys", [["k"], []])
def test_running_totals(skewed, width, keys):
    got = slices.running_totals(skewed, keys, ["id"], {"s": F.col("v"), "n": F.lit(1)}, width)
    w = Window.partitionBy(*keys).orderBy("id").rowsBetween(Window.unboundedPreceding, 0)
    want = skewed.withColumns({"s": F.sum("v").over(w), "n": F.count("*").over(w)})
    assert rows_of(got.select("id", "s", "n")) == rows_of(want.select("id", "s", "n"))


@pytest.mark.parametrize("width", [2, 97])
def test_null_values_add_nothing(skewed, width):
    rows = skewed.withColumn("v", F.when(F.col("id") % 3 > 0, F.col("v")))
    got = slices.running_totals(rows, ["k"], ["id"], {"s": F.col("v")}, width)
    w = Window.partitionBy("k").orderBy("id").rowsBetween(Window.unboundedPreceding, 0)
    assert rows_of(got.select("id", "s")) == rows_of(rows.select("id", F.sum("v").over(w)))
    got = slices.running_since(rows, ["k"], ["id"], F.col("v") > 90, {"s": F.col("v")}, width)
    turn = rows.withColumn("turn", F.count_if(F.col("v") > 90).over(w))
    w = Window.partitionBy("k", "turn").orderBy("id").rowsBetween(Window.unboundedPreceding, 0)
    assert rows_of(got.select("id", "s")) == rows_of(turn.select("id", F.sum("v").over(w)))


@pytest.mark.parametrize("width", [10, 97, 1 << 18])
@pytest.mark.parametrize("every", [3, 400, 5000])
def test_running_since(skewed, width, every):
    restart = F.col("id") % every == 0
    got = slices.running_since(skewed, ["k"], ["id"], restart, {"s": F.col("v"), "n": F.lit(1)}, width)
    w = Window.partitionBy("k").orderBy("id").rowsBetween(Window.unboundedPreceding, 0)
    epochs = skewed.withColumn("e", F.sum(restart.cast("int")).over(w))
    v = Window.partitionBy("k", "e").orderBy("id").rowsBetween(Window.unboundedPreceding, 0)
    want = epochs.withColumns({"s": F.sum("v").over(v), "n": F.count("*").over(v)})
    assert rows_of(got.select("id", "s", "n")) == rows_of(want.select("id", "s", "n"))


def test_running_totals_keep_rows_without_order_value(spark):
    df = spark.createDataFrame([("a", None), ("a", 3), ("a", 1)], "k STRING, id BIGINT")
    got = slices.rank_by(df, ["k"], ["id"], "r", width=2)
    assert rows_of(got.select("id", "r")) == [(1, 1), (3, 2), (None, 0)]


def test_rank_is_dense(skewed):
    ranks = slices.rank_by(skewed, ["k"], ["id"], "r", width=50).groupBy("k").agg(
        F.count("*").alias("n"), F.count_distinct("r").alias("d"), F.max("r").alias("m"), F.min("r").alias("z")
    )
    for row in ranks.collect():
        assert row.n == row.d == row.m + 1 and row.z == 0


@pytest.mark.parametrize("n", [1, 2, 5, 20])
def test_count_window(skewed, n):
    aggregates = {"s": F.sum("v"), "c": F.count(F.lit(1))}
    got = count_window(skewed, ["k"], ["id"], n, aggregates, width=100, block=20)
    w = Window.partitionBy("k").orderBy("id").rowsBetween(-(n - 1), 0)
    want = skewed.withColumns({"s": F.sum("v").over(w), "c": F.count("*").over(w)})
    assert rows_of(got.select("id", "s", "c")) == rows_of(want.select("id", "s", "c"))


def test_lookback_longer_than_block_is_refused(skewed):
    with pytest.raises(ValueError):
        count_window(skewed, ["k"], ["id"], 50, {"s": F.sum("v")}, block=20)


@pytest.mark.parametrize("block_seconds", [60, 1000])
def test_time_range_window(skewed, block_seconds):
    names = {"s": "sum", "n": "count", "lo": "min", "hi": "max"}
    aggregates = {name: (kind, F.col("v")) for name, kind in names.items()}
    got = time_range_window(skewed, ["k"], "sec", 500, aggregates, block_seconds)
    w = Window.partitionBy("k").orderBy("sec").rangeBetween(-500, 0)
    want = skewed.withColumns(
        {"s": F.sum("v").over(w), "n": F.count("v").over(w), "lo": F.min("v").over(w), "hi": F.max("v").over(w)}
    )
    assert rows_of(got.select("id", *names)) == rows_of(want.select("id", *names))


@pytest.mark.parametrize("keys", [["k"], []])
def test_exact_quantiles(skewed, keys):
    got = slices.exact_quantiles(skewed, keys, "v", {"p50": 0.5, "p95": 0.95, "p0": 0.0, "p100": 1.0}, width=7)
    want = skewed.groupBy(*keys).agg(
        F.count("*").alias("n"), *[F.percentile("v", p).alias(f"q{p}") for p in (0.5, 0.95, 0.0, 1.0)]
    )
    a = [tuple(round(x, 6) if isinstance(x, float) else x for x in r) for r in rows_of(got)]
    b = [tuple(round(x, 6) if isinstance(x, float) else x for x in r) for r in rows_of(want)]
    assert a == b


def test_one_key_is_spread_over_tasks(spark):
    """A single hot key must not end in one task: the shuffle is on (key, slice)."""
    one_key = spark.range(20_000).select(F.lit("x").alias("k"), F.col("id"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        ranked = slices.rank_by(one_key, ["k"], ["id"], "r", width=100)
        per_task = ranked.groupBy(F.spark_partition_id().alias("p")).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(per_task) > 1
    assert max(r["count"] for r in per_task) < 20_000 * 0.6


def test_interleaved_keys_have_no_totals(spark):
    """Many keys that take turns: none is large, so there is nothing to add up between slices."""
    rows = spark.range(300_000).select((F.col("id") % 100_000).alias("k"), (F.col("id") * 1000).alias("id"))
    cut = slices.cuts(rows, ["k"], "id")
    assert not cut.any
    got = slices.rank_by(rows, ["k"], ["id"], "r", cut=cut)
    assert "Join" not in got._jdf.queryExecution().executedPlan().toString()
    assert got.where(F.col("r") != F.expr("id div 100000000")).count() == 0


def test_slices_of_a_large_key_hold_about_equal_rows(spark):
    """Order values in dense and sparse stretches; the other keys stay whole."""
    id_ = F.col("id")
    spread = F.when(id_ < 20_000, id_).when(id_ < 21_000, id_ * 10_000_000_000).otherwise(id_ + (1 << 55))
    rows = spark.range(60_000).select(F.when(id_ % 6 > 0, "hot").otherwise(F.concat(F.lit("k"), id_ % 600)).alias("k"), spread.alias("at"))
    cut = slices.cuts(rows, ["k"], "at", 1000)
    sizes = cut.apply(rows, []).groupBy("k", "_slice", "_large").count().toPandas()
    assert set(sizes[sizes._large].k) == {"hot"} and sizes[~sizes._large].groupby("k").size().max() == 1
    hot = sizes[sizes._large]["count"]
    assert hot.sum() == 50_000 and hot.max() <= 1100 and len(hot) < 130
    got = slices.rank_by(rows, ["k"], ["at"], "r", 1000, cut)
    want = rows.withColumn("r", F.row_number().over(Window.partitionBy("k").orderBy("at")) - 1)
    assert rows_of(got) == rows_of(want)


def test_no_rows_and_only_null_order(spark):
    none = spark.createDataFrame([], "k STRING, id BIGINT")
    for keys in (["k"], []):
        assert slices.rank_by(none, keys, ["id"], "r", width=2).count() == 0
    nulls = spark.createDataFrame([("a", None, n) for n in range(5)], "k STRING, id BIGINT, n INT")
    for keys in (["k"], []):
        got = slices.rank_by(nulls, keys, ["id", "n"], "r", width=2)
        assert rows_of(got.select("n", "r")) == [(n, n) for n in range(5)]
