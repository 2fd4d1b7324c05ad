"""Plans at a glance: what must and must not appear in them."""

from pyspark.sql import functions as F

from __spark_entry__ import queries
from logflow import scratch
from logflow.operators import joins, metrics
from logflow.operators.slices import rank_by
from logflow.sources.log import first_k

SF_DIR = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_balances_need_one_shuffle_of_partial_sums(spark):
    text = plan(queries()["user_balances"](spark, SF_DIR))
    assert text.count("Exchange") == 1 and "partial_sum" in text
    assert "ReadSchema: struct<user_id:bigint,event_type:string,value:double>" in text


def test_global_rank_moves_rows_by_slice(spark):
    """Only the slice totals meet in one partition, not the rows."""
    text = plan(rank_by(spark.range(1000), [], ["id"], "r", width=10))
    data_side = text.split("BroadcastExchange")[0]
    assert "hashpartitioning(_slice" in data_side and "SinglePartition" not in data_side


def test_first_k_is_limited_before_the_shuffle(spark):
    part = F.col("id") % 3
    df = spark.range(100).select(part.cast("string").alias("topic"), part.alias("partition"), F.col("id").alias("offset"))
    assert plan(first_k(df, 3)).count("WindowGroupLimit") == 2


def test_large_dimension_is_not_broadcast(spark):
    facts = spark.range(1000).withColumnRenamed("id", "k")
    table = spark.range(1000).withColumn("name", F.lit("n"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "100")
    try:
        text = plan(joins.enrich_with_fallback(facts, table, "k", "id", {"name": "Unknown"}))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in text and "Broadcast" not in text


def test_percentiles_pre_aggregate(spark):
    df = spark.range(1000).select((F.col("id") % 7).alias("latency_ms"), F.lit("a").alias("k"))
    assert "partial_count" in plan(metrics.latency_percentiles(df, "k"))


def test_scratch_follows_the_cluster_setting(spark, shared_dir):
    assert scratch.scratch_root(spark) == shared_dir
    kept = scratch.materialize(spark.range(5), "numbers")
    assert kept.inputFiles()[0].startswith(f"file://{shared_dir}/numbers-")
    assert kept.count() == 5
