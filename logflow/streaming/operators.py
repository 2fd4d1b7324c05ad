"""Streaming forms of the log operators.  Each takes a streaming DataFrame and returns one."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from logflow.functions.parsing import parse_action
from logflow.operators.metrics import balance_delta
from logflow.operators.statemachines import (
    BREAKER,
    BREAKER_COLUMNS,
    SEQUENCE_COLUMNS,
    SEQUENCES,
    Machine,
    advance,
    pack,
)
from logflow.session import ship_package


def tumbling(
    stream: DataFrame, length: str, delay: str | None, aggregates: list[Column], *keys: str, ts: str = "timestamp"
) -> DataFrame:
    """Aggregates per fixed window.  ``delay`` bounds the state: it must cover the stream's disorder,
    as later rows are dropped.  Without one no row is dropped, and the state keeps every window: the choice
    for a finished log whose files come in any order."""
    window = F.window(ts, length)
    return _windowed(stream, window, delay, aggregates, keys, ts)


def sliding(
    stream: DataFrame,
    length: str,
    slide: str,
    delay: str | None,
    aggregates: list[Column],
    *keys: str,
    ts: str = "timestamp",
) -> DataFrame:
    """Aggregates per overlapping window."""
    return _windowed(stream, F.window(ts, length, slide), delay, aggregates, keys, ts)


def _windowed(stream, window, delay, aggregates, keys, ts) -> DataFrame:
    marked = stream.withWatermark(ts, delay) if delay else stream
    grouped = marked.groupBy(window.alias("w"), *keys).agg(*aggregates)
    return grouped.select(F.col("w.start").alias("window_start"), *grouped.columns[1:])


def balances(stream: DataFrame) -> DataFrame:
    """Balance per key as running state; records that do not parse count for nothing, as in the batch operator."""
    parsed = parse_action(stream).where(F.col("error").isNull())
    return parsed.groupBy("key").agg(F.sum(balance_delta()).alias("balance"))


def dedup(stream: DataFrame, key: str, delay: str | None = None, ts: str = "timestamp") -> DataFrame:
    """Drop repeats of a message id that arrive within ``delay`` of the first one; without one, all repeats."""
    if not delay:
        return stream.dropDuplicates([key])
    return stream.withWatermark(ts, delay).dropDuplicatesWithinWatermark([key])


def first_arrivals(stream: DataFrame, key: str, order: Column, columns: list[str]) -> DataFrame:
    """The first row of every id, for update mode: a later copy, in whatever batch, is not emitted again.

    The state store keeps one row per id, so a micro-batch looks up its own ids and never reads earlier output.  Of
    copies in one batch the one with the least ``order`` counts.  An id is new if the batch that updates it is the
    one that brought it; a batch that is run again keeps its time and so emits the same rows.
    """
    rest = [c for c in columns if c != key]
    seen = stream.withColumn("_batch", F.current_timestamp()).groupBy(key).agg(
        F.min_by(F.struct(*rest), order).alias("_row"), F.min("_batch").alias("_first"), F.max("_batch").alias("_last")
    )
    return seen.where("_first = _last").select(key, "_row.*").select(*columns)


def stateful(stream: DataFrame, keys: list[str], order: str, machine: Machine) -> DataFrame:
    """Run a state machine per key over the stream; the state lives in the state store.

    Rows of a key are put in order inside each micro-batch, whose size ``maxFilesPerTrigger`` or
    ``maxBytesPerTrigger`` bounds.
    """

    def update(_key, chunks: Iterator[pd.DataFrame], state: GroupState):
        rows = pd.concat(list(chunks), ignore_index=True).sort_values(order, kind="stable")
        before = json.loads(state.get[0]) if state.exists else machine.initial
        out, after = advance(rows, before, machine)
        state.update((pack(after),))
        yield out

    ship_package(stream.sparkSession)
    return stream.groupBy(*keys).applyInPandasWithState(
        update,
        machine.output_schema(stream.schema),
        "state STRING",
        "append",
        GroupStateTimeout.NoTimeout,
    )


def mark_duplicate_sequences(stream: DataFrame) -> DataFrame:
    rows = stream.select(*SEQUENCE_COLUMNS)
    return stateful(rows, ["producer_id", "partition"], "arrival", SEQUENCES)


def circuit_breaker(stream: DataFrame) -> DataFrame:
    return stateful(stream.select(*BREAKER_COLUMNS), ["dependency"], "seq", BREAKER)


def split_batches(
    path: str, outcome: Callable[[DataFrame], DataFrame], column: str
) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` sink that writes every outcome of a micro-batch in one pass.

    ``outcome`` adds ``column``; the output is ``batch=<id>/<column>=<value>/``.
    """

    def write(df: DataFrame, batch_id: int) -> None:
        outcome(df).write.mode("overwrite").partitionBy(column).parquet(f"{path}/batch={batch_id}")

    return write
