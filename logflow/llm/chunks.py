"""Documents stored in chunks of bounded size, so that several passes over texts need no shuffle of them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from logflow.scratch import fresh_dir, release
from logflow.session import ship_package

#: Spark's own limit for buckets is twice this; more chunks share buckets.
MOST_BUCKETS = 50_000
#: Most rows of a chunk, so that rows without text do not pile up in one.
CHUNK_ROWS = 100_000


def store_chunks(documents: DataFrame, chunk_bytes: int) -> DataFrame:
    """Write documents as ``row`` (all columns), ``rid`` (unique) and ``chunk``, bucketed by chunk, and read them.

    A chunk holds at most CHUNK_ROWS consecutive rows of one task with about ``chunk_bytes`` bytes of text, a longer
    text alone.
    Rows are written where they are read; grouping or co-grouping by chunk later reads whole buckets and moves
    only the other side.
    """
    spark = documents.sparkSession
    ship_package(spark)
    least = chunk_bytes // CHUNK_ROWS + 1  # what a row counts at least
    size = documents.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(-(-size // chunk_bytes), int(spark.conf.get("spark.sql.shuffle.partitions")))

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, before, count = TaskContext.get().partitionId(), 0, 0
        for batch in batches:
            sizes = pc.fill_null(pc.binary_length(pc.struct_field(batch.column("row"), "text")), 0)
            sizes = np.maximum(sizes.to_numpy(zero_copy_only=False).astype(np.int64), least)
            ends = before + np.cumsum(sizes)
            rid = (task << 40) + count + np.arange(batch.num_rows)
            arrays = [batch.column("row"), pa.array(rid), pa.array((task << 24) + ends // chunk_bytes)]
            yield pa.RecordBatch.from_arrays(arrays, names=["row", "rid", "chunk"])
            before, count = int(ends[-1]) if len(ends) else before, count + batch.num_rows

    rows = documents.select(F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("row"))
    schema = rows.withColumns({"rid": F.lit(0).cast("long"), "chunk": F.lit(0).cast("long")}).schema
    path = fresh_dir(spark, "chunks")
    writer = rows.mapInArrow(number, schema).write.bucketBy(min(buckets, MOST_BUCKETS), "chunk")
    writer.option("compression", "zstd").option("path", path).saveAsTable(table_name(path))
    return spark.table(table_name(path))


def table_name(path: str) -> str:
    """The catalog's name of stored chunks."""
    return path.rsplit("/", 1)[1].replace("-", "_")


def release_tables(spark: SparkSession, paths: list[str]) -> None:
    """Delete working folders that no frame reads any more, and the catalog's entries of stored chunks among them."""
    for path in paths:
        if path.rsplit("/", 1)[1].startswith("chunks-"):
            spark.sql(f"DROP TABLE IF EXISTS {table_name(path)}")
    release(spark, paths)


def without_rows(store: DataFrame, gone: DataFrame, schema: StructType) -> DataFrame:
    """The documents of stored chunks, of ``schema``, but those in ``gone (chunk, rid)``; only ``gone`` is shuffled."""

    def stay(docs: pa.Table, gone: pa.Table) -> pa.Table:
        keep = ~np.isin(docs["rid"].to_numpy(), gone["rid"].to_numpy())
        return pa.Table.from_struct_array(docs["row"]).filter(pa.array(keep))

    gone = gone.select("chunk", "rid").groupBy("chunk")
    return store.groupBy("chunk").cogroup(gone).applyInArrow(stay, schema)
