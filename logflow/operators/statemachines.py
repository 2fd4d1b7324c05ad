"""Order-dependent state machines over keyed records, split so that no key has to fit one task.

A machine has a small JSON-friendly state and a function ``step(state, *inputs) -> (state, outputs)``
for one record.  ``run_machine`` cuts every key into blocks and runs all the blocks at once from a
guessed start state.  It then compares each block's start with the true end of the block before
and re-runs from the blocks that guessed wrong, until all links agree: exactly the result of one
pass over the whole key.  Machines that forget their past settle at once.  For those that do not,
each round carries a correction over stretches twice as long as the last one (streamed, so never
held in memory), which bounds the rounds by the logarithm of the number of blocks.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logflow.operators.slices import BLOCK_ROWS, SLICE_WIDTH, rank_by
from logflow.scratch import materialize
from logflow.session import ship_package

LINK_DDL = "_group STRING, _block BIGINT, _state_in STRING, _state_out STRING"
LINK_COLUMNS = ["_group", "_block", "_state_in", "_state_out"]


@dataclass(frozen=True)
class Machine:
    """``inputs`` are the columns a step reads, ``outputs`` the (name, type) columns it adds."""

    inputs: tuple[str, ...]
    outputs: tuple[tuple[str, str], ...]
    initial: Any
    step: Callable[..., tuple[Any, tuple]]

    @property
    def output_names(self) -> list[str]:
        return [name for name, _ in self.outputs]

    def output_schema(self, rows: T.StructType) -> T.StructType:
        schema = T.StructType(list(rows.fields))
        for name, type_name in self.outputs:
            schema.add(name, type_name)
        return schema


def pack(state: Any) -> str:
    return json.dumps(state, sort_keys=True)


def _inputs(pdf: pd.DataFrame, machine: Machine) -> list[list]:
    return [pdf[c].tolist() for c in machine.inputs]


def advance(pdf: pd.DataFrame, state: Any, machine: Machine) -> tuple[pd.DataFrame, Any]:
    """Run the machine over ordered rows of one key; returns the rows with the added columns."""
    added = []
    for values in zip(*_inputs(pdf, machine), strict=True):
        state, outputs = machine.step(state, *values)
        added.append(outputs)
    extra = pd.DataFrame(added, columns=machine.output_names, index=pdf.index)
    return pd.concat([pdf, extra], axis=1), state


def run_machine(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    machine: Machine,
    block: int = BLOCK_ROWS,
    width: int = SLICE_WIDTH,
) -> DataFrame:
    """Add the machine's outputs to every row, running it per key in ``order``."""
    spark = df.sparkSession
    ship_package(spark)
    start = pack(machine.initial)
    ranked = rank_by(df, keys, order, "_rank", width).withColumns(
        {
            "_group": F.to_json(F.struct(*keys)) if keys else F.lit(""),
            "_block": F.expr(f"_rank div {block}"),
        }
    )
    rows = materialize(ranked, "machine-rows")
    columns = df.columns
    # Python work is spread over a fixed number of tasks; small inputs would be coalesced into one.
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def walk(batches: Iterator[pd.DataFrame], keep_rows: bool) -> Iterator[pd.DataFrame]:
        """Stream through stretches of blocks in order, taking up ``_state_in`` where one begins;
        emit the links of the blocks passed, or the rows with their outputs."""
        here, state, began, links = None, None, None, []
        for pdf in batches:
            group, stretch, number = pdf["_group"], pdf["_stretch"], pdf["_block"]
            heads = ((number != number.shift()) | (group != group.shift())).tolist()
            added = []
            for i, (is_head, *values) in enumerate(zip(heads, *_inputs(pdf, machine), strict=True)):
                head = (group.iat[i], stretch.iat[i], number.iat[i]) if is_head else here
                if head != here:
                    if here is not None:
                        links.append((here[0], here[2], began, pack(state)))
                    if here is None or head[:2] != here[:2]:
                        state = json.loads(pdf["_state_in"].iat[i])
                    here, began = head, pack(state)
                state, outputs = machine.step(state, *values)
                if keep_rows:
                    added.append(outputs)
            if keep_rows:
                extra = pd.DataFrame(added, columns=machine.output_names, index=pdf.index)
                yield pd.concat([pdf[columns], extra], axis=1)
            elif links:
                yield pd.DataFrame(links, columns=LINK_COLUMNS)
                links = []
        if here is not None and not keep_rows:
            yield pd.DataFrame([(here[0], here[2], began, pack(state))], columns=LINK_COLUMNS)

    def in_order(stretched: DataFrame) -> DataFrame:
        by = ["_group", "_stretch"]
        return stretched.repartition(tasks, *by).sortWithinPartitions(*by, "_rank")

    def links_of(stretched: DataFrame) -> DataFrame:
        needed = dict.fromkeys(["_group", "_stretch", "_block", "_rank", "_state_in", *machine.inputs])
        ordered = in_order(stretched.select(*needed))
        return ordered.mapInPandas(lambda batches: walk(batches, keep_rows=False), LINK_DDL)

    each_block = rows.withColumn("_stretch", F.col("_block"))
    done = materialize(links_of(each_block.withColumn("_state_in", F.lit(start))), "machine-round")
    chain = Window.partitionBy("_group").orderBy("_block")
    length = 1
    while True:
        length *= 2
        stretch = F.expr(f"_block div {length}").alias("_stretch")
        expected = F.coalesce(F.lag("_state_out").over(chain), F.lit(start))
        # One row per stretch that has to be run again, from its first wrong block on.
        wrong = materialize(
            done.withColumn("_true_in", expected)
            .where(F.col("_true_in") != F.col("_state_in"))
            .groupBy("_group", stretch)
            .agg(F.min("_block").alias("_from"), F.min_by("_true_in", "_block").alias("_state_in")),
            "machine-wrong",
        )
        if wrong.isEmpty():
            break
        again = rows.select("*", stretch).join(wrong, ["_group", "_stretch"])
        fixed = links_of(again.where(F.col("_block") >= F.col("_from")))
        marks = wrong.select("_group", "_stretch", "_from")
        kept = done.select("*", stretch).join(marks, ["_group", "_stretch"], "left")
        kept = kept.where(F.col("_from").isNull() | (F.col("_block") < F.col("_from")))
        done = materialize(kept.select(*LINK_COLUMNS).unionByName(fixed), "machine-round")

    stated = each_block.join(done.select("_group", "_block", "_state_in"), ["_group", "_block"])
    schema = machine.output_schema(df.schema)
    return in_order(stated).mapInPandas(lambda batches: walk(batches, keep_rows=True), schema)


# --- duplicate sequences ------------------------------------------------------------------------

REMEMBERED = 5


def sequence_step(recent: list[int], sequence: int) -> tuple[list[int], tuple[bool]]:
    """A sequence number is a duplicate when it is among the last five accepted ones."""
    if sequence in recent:
        return recent, (True,)
    return [*recent, sequence][-REMEMBERED:], (False,)


SEQUENCES = Machine(("sequence",), (("duplicate", "boolean"),), [], sequence_step)
SEQUENCE_COLUMNS = ["producer_id", "partition", "sequence", "arrival"]


def mark_duplicate_sequences(df: DataFrame, block: int = BLOCK_ROWS, width: int = SLICE_WIDTH) -> DataFrame:
    """Per (producer_id, partition), in ``arrival`` order: is this a resend of a recent sequence?

    Repeats older than the last five accepted sequences pass, as the memory is bounded.
    """
    rows = df.select(*SEQUENCE_COLUMNS)
    return run_machine(rows, ["producer_id", "partition"], ["arrival"], SEQUENCES, block, width)


# --- circuit breaker ----------------------------------------------------------------------------

# Trip at half of the last ten, probe after thirty seconds, two successes close.
WINDOW, TRIP_FAILURES, OPEN_MS, CLOSE_AFTER = 10, 5, 30_000, 2

CLOSED, OPEN, HALF_OPEN = "CLOSED", "OPEN", "HALF_OPEN"


def breaker_step(state: list, ts_ms: int, failed: bool) -> tuple[list, tuple[bool, str]]:
    """One call outcome.  The state is [mode, memory]: recent outcomes while closed, the opening
    time while open, successes so far while half open.  Calls are refused while it is open."""
    mode, memory = state
    if mode == OPEN:
        if ts_ms - memory < OPEN_MS:
            return state, (False, OPEN)
        mode, memory = HALF_OPEN, 0
    if mode == HALF_OPEN:
        if failed:
            after = [OPEN, ts_ms]
        elif memory + 1 == CLOSE_AFTER:
            after = [CLOSED, []]
        else:
            after = [HALF_OPEN, memory + 1]
    else:
        recent = [*memory, int(failed)][-WINDOW:]
        tripped = len(recent) == WINDOW and sum(recent) >= TRIP_FAILURES
        after = [OPEN, ts_ms] if tripped else [CLOSED, recent]
    return after, (True, after[0])


BREAKER = Machine(
    ("ts_ms", "failed"), (("allowed", "boolean"), ("state", "string")), [CLOSED, []], breaker_step
)
BREAKER_COLUMNS = ["dependency", "seq", "ts_ms", "failed"]


def circuit_breaker(df: DataFrame, block: int = BLOCK_ROWS, width: int = SLICE_WIDTH) -> DataFrame:
    """Breaker history per dependency, by event time, from call outcomes in ``seq`` order."""
    return run_machine(df.select(*BREAKER_COLUMNS), ["dependency"], ["seq"], BREAKER, block, width)
