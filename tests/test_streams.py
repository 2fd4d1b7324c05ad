"""Streams: equal to batch, restart without loss or repeats, state machines across batches."""

import pytest
from pyspark.sql import functions as F

from logflow.operators import statemachines as sm
from logflow.sinks import log as sink
from logflow.sources import log as source
from logflow.streaming import operators as ops
from logflow.streaming import runs, watch
from tests.test_log_store import records


def test_resume_reads_only_new_records(spark, tmp_path, root):
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "ckpt")

    def run():
        stream = source.stream_log(spark, root, "id BIGINT").select("id", "partition", "offset")
        return runs.appended_table(stream, out, checkpoint)

    sink.append(records(spark, "t", 0, 30), root, ["id"])
    assert run().count() == 30
    assert run().count() == 30
    sink.append(records(spark, "t", 30, 12), root, ["id"])
    table = run()
    assert table.count() == 42 and table.select("id").distinct().count() == 42


def test_a_repeated_batch_is_not_doubled(spark, tmp_path):
    path = str(tmp_path / "out")
    write = runs.batch_folder(path)
    df = spark.range(10)
    write(df, 0)
    write(df, 0)  # the crash came after the write and before the commit
    write(df, 1)
    assert runs.read_batches(spark, path, df.schema).count() == 20


def test_failed_batch_is_retried_once(spark, tmp_path, root):
    sink.append(records(spark, "t", 0, 30), root, ["id"])
    path, checkpoint = str(tmp_path / "out"), str(tmp_path / "ckpt")
    sinkfn, failures = runs.batch_folder(path), [1]

    def write(df, batch_id):
        sinkfn(df, batch_id)
        if failures:
            failures.pop()
            raise RuntimeError("crash after the write")

    def run():
        stream = source.stream_log(spark, root, "id BIGINT").select("id")
        runs.drain(stream.writeStream.foreachBatch(write), checkpoint)
        return stream.schema

    with pytest.raises(Exception, match="crash after the write"):
        run()
    assert runs.read_batches(spark, path, run()).count() == 30


def test_delivery_modes(spark, tmp_path, root):
    sink.append(records(spark, "t", 0, 9), root, ["id"])
    with pytest.raises(ValueError):
        runs.deliver(source.stream_log(spark, root), str(tmp_path / "o"), str(tmp_path / "c"), "at_most_once")
    for mode in (runs.EXACTLY_ONCE, runs.AT_LEAST_ONCE):
        stream = source.stream_log(spark, root).select("offset")
        runs.deliver(stream, str(tmp_path / mode), str(tmp_path / f"{mode}-c"), mode)
        assert runs.read_batches(spark, str(tmp_path / mode), stream.schema).count() == 9


def test_balances_over_many_batches(spark, tmp_path, root):
    def send(first, rows):
        df = spark.createDataFrame([(first + i, k, v) for i, (k, v) in enumerate(rows)], "id BIGINT, key STRING, value STRING")
        sink.append(df.withColumns({"topic": F.lit("t"), "partition": F.lit(0), "timestamp": F.timestamp_seconds("id")}), root, ["id"])

    def run():
        stream = ops.balances(source.stream_log(spark, root, files_per_trigger=1))
        table = runs.updated_table(stream, ["key"], str(tmp_path / "o"), str(tmp_path / "c"))
        return {r.key: r.balance for r in table.collect()}

    send(0, [("user-1", "ORDER:100"), ("user-1", "PAYMENT:100"), ("user-2", "ORDER:50")])
    assert run() == {"user-1": 100, "user-2": 50}
    send(3, [("user-2", "REFUND:25"), ("user-1", "DELIVERY:complete"), ("user-3", "ORDER:oops")])
    assert run() == {"user-1": 100, "user-2": 25}  # a key whose records all fail has no balance, as in the batch operator


def test_windows_equal_batch(spark, tmp_path, root):
    for first in (0, 5000, 9000):
        sink.append(records(spark, "t", first, 2000), root, ["id"])
    stream = ops.sliding(
        source.stream_log(spark, root, files_per_trigger=1), "1 hour", "15 minutes", "10 days", [F.count("*").alias("n")]
    )
    got = runs.updated_table(stream, ["window_start"], str(tmp_path / "o"), str(tmp_path / "c"))
    log = source.read_log(spark, root)
    want = log.groupBy(F.window("timestamp", "1 hour", "15 minutes").alias("w")).count().select("w.start", "count")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_dedup(spark, tmp_path, root):
    sink.append(records(spark, "t", 0, 50), root, ["id"])
    sink.append(records(spark, "t", 30, 50), root, ["id"])
    stream = ops.dedup(source.stream_log(spark, root, "id BIGINT", files_per_trigger=2), "id", "10 days").select("id")
    table = runs.appended_table(stream, str(tmp_path / "o"), str(tmp_path / "c"))
    assert sorted(r.id for r in table.collect()) == list(range(80))


def test_machine_state_survives_batches_and_restarts(spark, tmp_path):
    source_dir = str(tmp_path / "in")
    sequences = [0, 0, 1, 2, 2, 3, 4, 5, 0, 5]
    rows = [(1, 0, s, i) for i, s in enumerate(sequences)]
    ddl = "producer_id BIGINT, partition INT, sequence BIGINT, arrival BIGINT"

    def run():
        stream = spark.readStream.schema(ddl).option("maxFilesPerTrigger", 1).parquet(source_dir)
        marked = ops.mark_duplicate_sequences(stream)
        return runs.appended_table(marked, str(tmp_path / "o"), str(tmp_path / "c"))

    for part in (rows[:3], rows[3:5], rows[5:]):
        spark.createDataFrame(part, ddl).coalesce(1).write.mode("append").parquet(source_dir)
        table = run()
    got = [r.duplicate for r in table.orderBy("arrival").collect()]
    batch = sm.mark_duplicate_sequences(spark.createDataFrame(rows, ddl), block=3, width=4)
    assert got == [r.duplicate for r in batch.orderBy("arrival").collect()]
    assert got == [False, True, False, False, True, False, False, False, False, True]


def test_observed_metrics_and_listener(spark, tmp_path, root):
    sink.append(records(spark, "t", 0, 20), root, ["id"])
    log = watch.ProgressLog()
    spark.streams.addListener(log)
    try:
        stream = watch.observe_sends(source.stream_log(spark, root, "id BIGINT"), F.col("id") % 4 == 0)
        query = runs.drain(
            stream.select("key").writeStream.format("parquet").option("path", str(tmp_path / "o")), str(tmp_path / "c")
        )
        seen = watch.observations(spark, query).agg(F.sum("sent"), F.sum("failed")).first()
        assert tuple(seen) == (20, 5)
    finally:
        spark.streams.removeListener(log)
    assert not log.failures


def test_split_batches_keeps_every_record(spark, tmp_path, root):
    sink.append(records(spark, "t", 0, 40), root, ["id"])
    path = str(tmp_path / "o")

    def outcome(df):
        return df.withColumn("outcome", F.when(F.col("id") % 3 == 0, "dlt").otherwise("main"))

    stream = source.stream_log(spark, root, "id BIGINT", files_per_trigger=1)
    runs.drain(stream.writeStream.foreachBatch(ops.split_batches(path, outcome, "outcome")), str(tmp_path / "c"))
    counts = {r.outcome: r["count"] for r in spark.read.parquet(path).groupBy("outcome").count().collect()}
    assert counts == {"dlt": 14, "main": 26}


def test_new_matching_topics_join_a_running_log(spark, tmp_path, root):
    def run():
        stream = source.stream_log(spark, root, "id BIGINT").where(source.topic_matches("shop-.*"))
        table = runs.appended_table(stream.select("topic", "id"), str(tmp_path / "o"), str(tmp_path / "c"))
        return {r.topic: r["count"] for r in table.groupBy("topic").count().collect()}

    sink.append(records(spark, "shop-a", 0, 5), root, ["id"])
    sink.append(records(spark, "other", 0, 5), root, ["id"])
    assert run() == {"shop-a": 5}
    sink.append(records(spark, "shop-b", 0, 7), root, ["id"])
    assert run() == {"shop-a": 5, "shop-b": 7}


def test_latest_group_sees_only_later_records(spark, tmp_path, root):
    sink.append(records(spark, "t", 0, 30), root, ["id"])
    nobody = spark.createDataFrame([], "consumer_group STRING, topic STRING, partition INT, offset BIGINT")
    log = source.read_log(spark, root)
    starts = source.start_positions(log, nobody, "g", "latest")
    saved = spark.createDataFrame(starts.collect(), starts.schema)  # kept with the group's checkpoint

    def run():
        stream = source.from_positions(source.stream_log(spark, root, "id BIGINT"), saved)
        return runs.appended_table(stream.select("id"), str(tmp_path / "o"), str(tmp_path / "c"))

    assert run().isEmpty()
    sink.append(records(spark, "t", 30, 8), root, ["id"])
    assert sorted(r.id for r in run().collect()) == list(range(30, 38))
