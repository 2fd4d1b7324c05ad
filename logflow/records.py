"""The record schema shared by every log, and small helpers around it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

HEADER_TYPE = T.ArrayType(
    T.StructType([T.StructField("key", T.StringType()), T.StructField("value", T.StringType())])
)

#: topic/partition identify a log slice, offset the position inside it.  Headers are an array
#: because names may repeat and their order is kept.
RECORD_SCHEMA = T.StructType(
    [
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("key", T.StringType()),
        T.StructField("value", T.StringType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("headers", HEADER_TYPE),
    ]
)

RECORD_COLUMNS = [f.name for f in RECORD_SCHEMA.fields]


def empty_headers() -> Column:
    return F.array().cast(HEADER_TYPE)


def as_records(
    df: DataFrame,
    topic: str,
    key: Column,
    value: Column,
    timestamp: Column | None = None,
    headers: Column | None = None,
    keep: list[str] | None = None,
) -> DataFrame:
    """Project any table to the produced-record shape (no partition and offset yet).

    ``keep`` names extra columns to carry along; Parquet prunes them when nobody reads them.
    """
    return df.select(
        F.lit(topic).alias("topic"),
        key.cast("string").alias("key"),
        value.cast("string").alias("value"),
        (timestamp if timestamp is not None else F.lit(None)).cast("timestamp").alias("timestamp"),
        (headers if headers is not None else empty_headers()).alias("headers"),
        *(keep or []),
    )


def record_metadata(df: DataFrame) -> DataFrame:
    """Where each record landed and how large its key and value are; a null field has null size."""
    return df.select(
        "topic",
        "partition",
        "offset",
        "timestamp",
        F.octet_length("key").cast("bigint").alias("key_size"),
        F.octet_length("value").cast("bigint").alias("value_size"),
    )


def describe() -> Column:
    """One line of text per record: the value and where it came from."""
    return F.concat(
        F.coalesce("value", F.lit("null")),
        F.lit(" | Topic: "),
        F.col("topic"),
        F.lit(" | Partition: "),
        F.col("partition").cast("string"),
        F.lit(" | Offset: "),
        F.col("offset").cast("string"),
    )
