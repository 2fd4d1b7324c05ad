"""A stated set of query vectors against all vectors, in blocks of bounded size."""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logflow.session import ship_package

Search = Callable[[pa.Table, pa.Table], pa.Table]


def vectors(embeddings: DataFrame, usable: Callable[[Column], Column]) -> DataFrame:
    """``vec_id, v`` (double components) of the rows that take part."""
    v = F.col("embedding").cast("array<double>")
    return embeddings.select("vec_id", v.alias("v")).where(F.col("vec_id").isNotNull() & usable(F.col("v")))


def search_grid(
    rows: DataFrame, queries: DataFrame, search: Search, k: int, score_type: str, shard_rows: int, query_rows: int
) -> DataFrame:
    """Run ``search(shard of rows, block of queries)`` for every pair and keep each query's ``k`` best hits.

    Shards and blocks hold about ``shard_rows`` and ``query_rows`` rows whatever the size of the table, as their
    numbers follow from counts.  A query id on several rows is asked once, for the smallest of its vectors.
    Returns ``query_id, rank, vec_id, score``, best first, ties to the smaller vec_id.
    """
    ship_package(rows.sparkSession)
    asked = queries.groupBy("vec_id").agg(F.min("v").alias("v"))
    shards = -(-max(1, rows.count()) // shard_rows)
    blocks = -(-max(1, asked.count()) // query_rows)

    def dealt(df: DataFrame, own: str, parts: int, other: str, copies: int) -> DataFrame:
        part = F.pmod(F.xxhash64("vec_id", "v"), F.lit(parts)).cast("int").alias(own)
        return df.select("*", part, F.explode(F.sequence(F.lit(0), F.lit(copies - 1))).alias(other))

    left = dealt(rows, "shard", shards, "block", blocks).groupBy("shard", "block")
    right = dealt(asked, "block", blocks, "shard", shards).groupBy("shard", "block")
    schema = f"query_id long, vec_id long, score {score_type}"
    hits = left.cogroup(right).applyInArrow(search, schema)
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return hits.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
