"""Retrying failed records: the retry log is read back as a stream until every record is done or dead."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from logflow.operators.routing import retry_decision
from logflow.streaming.operators import split_batches
from logflow.streaming.runs import drain

Handler = Callable[[DataFrame], DataFrame]


class RetryLoop:
    """Passes over a stream of records (with ``timestamp`` and whatever the handler needs), kept under ``path``.

    ``handle`` adds ``error``, null for a success.  A pass writes every record of its input under its outcome: done,
    retry with the time before which it must not be tried again, or dlt.  The next pass reads the retry log of the
    one before as a stream and tries the records that are due by ``now`` with their attempt raised and their due time
    as ``timestamp``; the others wait, unchanged, in its own retry log.  Each pass has a checkpoint, and each batch
    its folder, so a pass that died goes on where it was.
    """

    def __init__(self, source: DataFrame, handle: Handler, path: str, checkpoint: str) -> None:
        self.spark = source.sparkSession
        self.handle, self.path, self.checkpoint = handle, path, checkpoint
        self.source = source.withColumns({"attempt": F.lit(1), "not_before_ms": F.lit(None).cast("bigint")})
        self.schema = self._outcomes(self.source).schema

    def _outcomes(self, tried: DataFrame) -> DataFrame:
        decided = retry_decision(self.handle(tried.drop("not_before_ms")))
        return decided.drop("retriable", "advice")

    def _pass(self, number: int) -> str:
        return f"{self.path}/pass={number}"

    def run_pass(self, number: int, now_ms: int | None = None) -> None:
        """Pass 0 tries the source, pass n the retry log of pass n - 1; ``now_ms`` None takes every record as due."""
        if number:
            log = self.spark.readStream.schema(self.schema).parquet(self._pass(number - 1))
            stream = log.where(F.col("outcome") == "retry")
        else:
            stream = self.source

        def tried(df: DataFrame) -> DataFrame:
            if not number:
                return self._outcomes(df).select(*self.schema.names)
            due = F.lit(True) if now_ms is None else F.col("not_before_ms") <= now_ms
            again = df.where(due).drop("error", "outcome").withColumns(
                {"attempt": F.col("attempt") + 1, "timestamp": F.timestamp_millis("not_before_ms")}
            )
            waiting = df.where(~due).select(*self.schema.names)
            return self._outcomes(again).select(*self.schema.names).unionByName(waiting)

        sink = split_batches(self._pass(number), tried, "outcome")
        drain(stream.writeStream.foreachBatch(sink), f"{self.checkpoint}/pass={number}")

    def written(self, number: int) -> DataFrame:
        """All outcomes of a pass; none before it has run."""
        try:
            return self.spark.read.schema(self.schema).parquet(self._pass(number))
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], self.schema)

    def run(self, now_ms: int | None = None, passes: int = 100) -> int:
        """Run passes until none leaves a record to retry, or only waiting ones; returns the number of passes."""
        for number in range(passes):
            self.run_pass(number, now_ms)
            left = self.written(number).where(F.col("outcome") == "retry")
            if now_ms is not None:
                left = left.where(F.col("not_before_ms") <= now_ms)
            if left.isEmpty():
                return number + 1
        return passes

    def finished(self, passes: int) -> DataFrame:
        """Records that are done or dead, with ``pass``, ``attempt`` and ``error``."""
        schema = T.StructType([*self.schema.fields, T.StructField("pass", T.IntegerType())])
        log = self.spark.read.schema(schema).parquet(self.path)
        return log.where((F.col("pass") < passes) & F.col("outcome").isin("done", "dlt"))

