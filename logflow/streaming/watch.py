"""Metrics of running streams: per-batch observations and a progress listener."""

from __future__ import annotations

import json
import time

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

PROGRESS = (
    "query STRING, run STRING, batch BIGINT, at STRING, input_rows BIGINT, input_rows_per_sec DOUBLE, "
    "processed_rows_per_sec DOUBLE, duration_ms BIGINT, state_rows BIGINT"
)


def observe_sends(stream: DataFrame, failed: Column, name: str = "sends") -> DataFrame:
    """Count records, failures and value bytes of each micro-batch in passing; adds no shuffle."""
    return stream.observe(
        name,
        F.count(F.lit(1)).alias("sent"),
        F.count_if(failed).alias("failed"),
        F.coalesce(F.sum(F.octet_length("value")), F.lit(0)).alias("bytes"),
    )


def observations(spark: SparkSession, query: StreamingQuery, name: str = "sends") -> DataFrame:
    """The observed metrics of the recent micro-batches as rows."""
    rows = []
    for p in query.recentProgress:
        seen = (p["observedMetrics"] or {}).get(name)
        if seen is not None:
            rows.append((int(p["batchId"]), int(seen["sent"]), int(seen["failed"]), int(seen["bytes"])))
    return spark.createDataFrame(rows, "batch BIGINT, sent BIGINT, failed BIGINT, bytes BIGINT")


class ProgressLog(StreamingQueryListener):
    """Keeps the latest progress per query of a long-lived application, for health checks."""

    def __init__(self) -> None:
        self.latest: dict[str, dict] = {}
        self.failures: dict[str, str] = {}

    def onQueryStarted(self, event) -> None:
        self.latest[str(event.id)] = {"batch": -1, "input_rows": 0, "rows_per_sec": 0.0}

    def onQueryProgress(self, event) -> None:
        p = event.progress
        self.latest[str(p.id)] = {
            "batch": p.batchId,
            "input_rows": p.numInputRows,
            "rows_per_sec": p.processedRowsPerSecond,
        }

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        if event.exception:
            self.failures[str(event.id)] = event.exception


class ProgressTable(StreamingQueryListener):
    """Writes every progress report of the session's streams to a table, one file per report.

    Nothing is kept in memory, so a run of any length loses none.  Reports of batches without input are left out:
    idle triggers would only pile up files.  Add it with ``spark.streams.addListener``, and call ``close`` in the end.
    """

    def __init__(self, spark: SparkSession, path: str) -> None:
        sc = spark.sparkContext
        self.spark, self.path = spark, path
        self._Path = sc._jvm.org.apache.hadoop.fs.Path
        self._fs = self._Path(path).getFileSystem(sc._jsc.hadoopConfiguration())
        self._fs.mkdirs(self._Path(path))
        spark.streams.addListener(self)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        # Reports come in order, so all of this run's are written now.
        self._write(f"{event.runId}.ended", {})

    def onQueryProgress(self, event) -> None:
        p = event.progress
        if not p.numInputRows:
            return
        row = {
            "query": str(p.id),
            "run": str(p.runId),
            "batch": p.batchId,
            "at": p.timestamp,
            "input_rows": p.numInputRows,
            "input_rows_per_sec": p.inputRowsPerSecond or 0.0,
            "processed_rows_per_sec": p.processedRowsPerSecond or 0.0,
            "duration_ms": p.durationMs.get("triggerExecution", 0),
            "state_rows": sum(s.numRowsTotal for s in p.stateOperators),
        }
        self._write(f"{p.runId}-{p.batchId:012d}.json", row)

    def _write(self, name: str, row: dict) -> None:
        stream = self._fs.create(self._Path(f"{self.path}/{name}"), True)
        stream.write(json.dumps(row).encode())
        stream.close()

    def wait(self, query: StreamingQuery, seconds: float = 60.0) -> None:
        """Wait until the reports of a terminated run are written; they come after its end."""
        ended = self._Path(f"{self.path}/{query.runId}.ended")
        until = time.monotonic() + seconds
        while not self._fs.exists(ended):
            if time.monotonic() > until:
                raise TimeoutError(f"no report of the end of {query.runId}")
            time.sleep(0.05)

    def close(self) -> None:
        self.spark.streams.removeListener(self)

    def read(self) -> DataFrame:
        """The reports so far, PROGRESS' columns."""
        return self.spark.read.schema(PROGRESS).option("pathGlobFilter", "*.json").json(self.path)


def backlog(progress: DataFrame, waiting: int) -> DataFrame:
    """Adds ``backlog``: of ``waiting`` records at the start of a bounded run, how many are left after each batch."""
    upto = Window.partitionBy("query").orderBy("batch")
    return progress.withColumn("backlog", F.lit(waiting) - F.sum("input_rows").over(upto))
