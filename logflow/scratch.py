"""Shared working folders for written tables, stream checkpoints and lineage cuts."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_local_roots: dict[str, str] = {}
_recorders: list[list[str]] = []


def scratch_root(spark: SparkSession) -> str:
    """The folder every executor can reach.

    It is the cluster's ``spark.checkpoint.dir``.  Only a local-mode session without that
    setting (tests) gets a folder on this machine.
    """
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if root:
        return root.rstrip("/")
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if sc.applicationId not in _local_roots:
        _local_roots[sc.applicationId] = tempfile.mkdtemp(prefix="logflow-")
    return _local_roots[sc.applicationId]


def fresh_dir(spark: SparkSession, label: str) -> str:
    """A new, unused path under the shared folder (not created yet)."""
    path = f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex[:12]}"
    for made in _recorders:
        made.append(path)
    return path


@contextmanager
def recorded() -> Iterator[list[str]]:
    """The paths that ``fresh_dir`` gives out inside."""
    made: list[str] = []
    _recorders.append(made)
    try:
        yield made
    finally:
        _recorders.remove(made)


def release(spark: SparkSession, paths: Iterable[str]) -> None:
    """Delete working folders that no frame reads any more."""
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for path in paths:
        hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        hadoop.getFileSystem(conf).delete(hadoop, True)


def materialize(df: DataFrame, label: str, *partition_by: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: a lineage cut that survives executor loss."""
    spark = df.sparkSession
    path = fresh_dir(spark, label)
    df.write.partitionBy(*partition_by).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def folder_bytes(spark: SparkSession, path: str) -> int:
    """Size of all files under a folder."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.getContentSummary(hadoop).getLength()
