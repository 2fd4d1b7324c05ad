"""Session settings the operators are written for."""

from __future__ import annotations

import shutil
import tempfile
from pathlib import Path

from pyspark.sql import SparkSession

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
STATE_STORE = "spark.sql.streaming.stateStore.providerClass"

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    STATE_STORE: ROCKSDB,  # large keyed state stays off the heap
}


def configure(spark: SparkSession) -> SparkSession:
    """What results and state size depend on: UTC, and a state store on disk unless one was chosen."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    chosen = spark.conf.get(STATE_STORE, "")
    if not chosen or chosen.endswith("HDFSBackedStateStoreProvider"):
        spark.conf.set(STATE_STORE, ROCKSDB)
    return spark


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application (two operators need it there)."""
    sc = spark.sparkContext
    if sc.applicationId not in _shipped:
        package = Path(__file__).resolve().parent
        target = Path(tempfile.mkdtemp(prefix="logflow-package-")) / "logflow"
        archive = shutil.make_archive(str(target), "zip", package.parent, package.name)
        sc.addPyFile(archive)
        _shipped.add(sc.applicationId)


def local_session(
    cores: int | str = "*",
    shuffle_partitions: int = 8,
    memory: str = "8g",
    settings: dict[str, str] | None = None,
) -> SparkSession:
    """A local session for tests and timing runs."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("logflow")
        .config("spark.sql.shuffle.partitions", shuffle_partitions)
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.python.unix.domain.socket.enabled", "true")
    )
    for key, value in (SETTINGS | (settings or {})).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
