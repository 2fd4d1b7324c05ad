"""Versioned states, end-offset index, slices, commit log, keyed table, replay ledger, retry loop, progress table."""

import pytest
from pyspark.sql import functions as F

from logflow.functions import partitioners
from logflow.functions.parsing import is_json
from logflow.operators import offsets
from logflow.records import as_records
from logflow.sinks import log as sink
from logflow.sinks.commits import CommitLog
from logflow.sinks.tables import KeyedTable
from logflow.sources import log as source
from logflow.streaming import operators as live
from logflow.streaming import runs
from logflow.streaming.retries import RetryLoop
from logflow.streaming.watch import ProgressTable, backlog
from logflow.versions import VersionConflict, Versions


def records(spark, topic, first, n, partitions=3):
    df = spark.range(first, first + n)
    value = F.concat(F.lit('{"n":'), F.col("id").cast("string"), F.lit("}"))
    out = as_records(df, topic, F.col("id") % 7, value, F.timestamp_seconds(F.col("id")), keep=["id"])
    return out.withColumn("partition", F.pmod("id", F.lit(partitions)).cast("int"))


def test_versions_are_compare_and_set(spark, tmp_path):
    states = Versions(spark, str(tmp_path / "states"), keep=3)
    assert states.latest() == (0, {})
    assert states.publish(0, {"a": "é"}) == 1
    with pytest.raises(VersionConflict):
        states.publish(0, {"a": 2})
    assert states.latest() == (1, {"a": "é"})
    for n in range(1, 6):
        states.publish(n, {"n": n})
    assert states.latest() == (6, {"n": 5}) and len(list((tmp_path / "states").glob("v*"))) == 3
    assert not list((tmp_path / "states").glob("_*"))


def test_a_second_append_reads_no_data_file(spark, root, monkeypatch):
    sink.append(records(spark, "t", 0, 30), root, ["id"])
    monkeypatch.setattr(sink, "bounds", None)  # offsets come from the index alone
    monkeypatch.setattr(sink, "exists", None)
    sink.append(records(spark, "t", 30, 31), root, ["id"])
    log = source.read_log(spark, root, "id BIGINT")
    assert log.agg(F.count_distinct("partition", "offset"), F.count("*")).first()[:] == (61, 61)
    ends = {r.partition: (r.begin_offset, r.end_offset) for r in source.store_bounds(spark, root).collect()}
    assert ends == {r.partition: (r.begin_offset, r.end_offset) for r in source.bounds(log).collect()}


def test_two_writers_never_get_one_offset(spark, root, monkeypatch):
    """Another writer appends between this one's look at the index and its claim."""
    sink.append(records(spark, "t", 0, 20), root, ["id"])
    publish, others = Versions.publish, [records(spark, "t", 100, 50), records(spark, "u", 200, 7)]

    def overtaken(self, after, state):
        if others:
            sink.append(others.pop(), root, ["id"])
        return publish(self, after, state)

    monkeypatch.setattr(Versions, "publish", overtaken)
    sink.append(records(spark, "t", 20, 40), root, ["id"])
    log = source.read_log(spark, root, "id BIGINT")
    assert not others and log.count() == 117
    assert log.select("topic", "partition", "offset").distinct().count() == 117
    assert log.groupBy("topic", "partition").agg((F.max("offset") + 1 - F.count("*")).alias("gap")).where("gap <> 0").count() == 0


def test_reset_starts_again_at_zero(spark, root):
    sink.append(records(spark, "a", 0, 9), root, ["id"])
    sink.append(records(spark, "b", 0, 9), root, ["id"])
    sink.reset_topic(spark, root, "a")
    sink.append(records(spark, "a", 0, 6), root, ["id"])
    ends = {(r.topic, r.partition): r.end_offset for r in source.store_bounds(spark, root).collect()}
    assert ends == {("a", p): 2 for p in range(3)} | {("b", p): 3 for p in range(3)}
    assert source.read_log(spark, root).where("topic = 'a'").agg(F.max("offset")).first()[0] == 1


def files_read(df):
    """Files that the scans of a finished query read."""
    plan = df._jdf.queryExecution().executedPlan()
    df.collect()
    text = plan.toString()
    assert "dynamicpruning" in text.lower()
    total = 0
    stack = [plan]
    while stack:
        node = stack.pop()
        if node.nodeName() == "AdaptiveSparkPlan":
            stack.append(node.executedPlan())
            continue
        if node.nodeName().endswith("QueryStage"):
            stack.append(node.plan())
            continue
        if node.nodeName().startswith("Scan parquet") and "partition" in node.toString():
            metrics = node.metrics()
            if metrics.contains("numFiles") and "slice" in node.toString():
                total += metrics.apply("numFiles").value()
        children = node.children()
        stack.extend(children.apply(i) for i in range(children.length()))
    return total


def test_a_lagging_partition_does_not_make_others_read_whole(spark, root, monkeypatch):
    monkeypatch.setattr(source, "LOG_SLICE", 10)
    sink.append(records(spark, "t", 0, 300), root, ["id"])  # ten slices in each of three partitions
    log, known = source.read_log(spark, root, "id BIGINT"), source.store_bounds(spark, root)
    positions = known.withColumn("start", F.when(F.col("partition") == 1, 0).otherwise(95).cast("bigint"))
    rest = source.from_positions(log, positions, known)
    assert files_read(rest) == 12
    assert rest.count() == 100 + 5 + 5
    assert source.from_positions(log, positions).count() == 110  # without bounds, by partitions only
    assert source.seek_end(log, known).count() == 0 and source.seek_beginning(log, known).count() == 300


def test_newest_commit_counts_also_when_set_back(spark, root, tmp_path):
    sink.append(records(spark, "t", 0, 100, partitions=1), root, ["id"])
    log, known = source.read_log(spark, root), source.store_bounds(spark, root)
    saved = CommitLog(spark, str(tmp_path / "commits"))
    assert saved.read().collect() == []

    def commit(offset, group="g"):
        row = [(group, "t", 0, offset, None)]
        return saved.append(spark.createDataFrame(row, "consumer_group STRING, topic STRING, partition INT, offset BIGINT, updated_at TIMESTAMP"))

    assert [commit(90), commit(40, "h"), commit(10)] == [1, 2, 3]
    lags = {r.consumer_group: r.lag for r in offsets.consumer_lag(known, saved.read(), "g", "h", "nobody").collect()}
    assert lags == {"g": 90, "h": 60, "nobody": 100}
    assert {r.consumer_group: r.offset for r in saved.latest().collect()} == {"g": 10, "h": 40}
    assert source.resume(log, saved.read(), "g", known=known).count() == 90


def test_commits_follow_the_sink(spark, root, tmp_path):
    sink.append(records(spark, "t", 0, 20, partitions=2), root, ["id"])
    saved, path = CommitLog(spark, str(tmp_path / "commits")), str(tmp_path / "out")
    failing = [True]

    def write(df, batch_id):
        runs.batch_folder(path)(df, batch_id)
        if failing.pop():
            raise RuntimeError("died")

    stream = source.stream_log(spark, root).select("topic", "partition", "offset")
    with pytest.raises(Exception, match="died"):
        runs.drain(stream.writeStream.foreachBatch(saved.after(write, "g")), str(tmp_path / "ckpt"))
    assert saved.read().collect() == []
    failing.append(False)
    runs.drain(stream.writeStream.foreachBatch(saved.after(write, "g")), str(tmp_path / "ckpt"))
    assert {r.partition: r.offset for r in saved.latest().collect()} == {0: 10, 1: 10}


def test_keyed_table(spark, tmp_path, monkeypatch):
    schema = "id BIGINT, text STRING, version INT"
    table = KeyedTable(spark, str(tmp_path / "table"), schema, ["id"], ["version"], buckets=4)

    def rows(*values):
        return spark.createDataFrame(list(values), schema)

    def now():
        return {r.id: (r.text, r.version) for r in table.read().collect()}

    assert now() == {}
    table.upsert(rows((1, "a", 1), (2, "b", 1), (3, None, 1), (1, "older", 0)), batch_id=0)
    before = dict(table._state()[1]["folders"])
    table.upsert(rows((2, "b2", 2), (2, "b0", 0)), batch_id=1)
    after = table._state()[1]["folders"]
    assert sum(before[b] != after[b] for b in before) == 1  # only the bucket of key 2 was rewritten
    want = {1: ("a", 1), 2: ("b2", 2), 3: (None, 1)}
    assert now() == want
    table.upsert(rows((1, "again", 9)), batch_id=1)  # the batch was there already
    table.upsert(rows((1, "late", 0)), batch_id=2)
    assert now() == want
    table.upsert(rows((1, "other writer", 2)), batch_id=0, writer="w")
    assert now()[1] == ("other writer", 2)
    with monkeypatch.context() as broken:  # dies after the data, before the manifest

        def die(self, after, state):
            raise OSError("died")

        broken.setattr(Versions, "publish", die)
        with pytest.raises(OSError):
            table.upsert(rows((1, "lost", 7), (4, "lost", 1)), batch_id=3)
    assert now() == want | {1: ("other writer", 2)}
    table.upsert(rows((1, "kept", 7), (4, "kept", 1)), batch_id=3)
    assert now()[1] == ("kept", 7) and now()[4] == ("kept", 1)
    assert table.upsert(rows(), batch_id=4) and now()[4] == ("kept", 1)


def test_keyed_table_as_a_stream_sink(spark, root, tmp_path):
    sink.append(records(spark, "t", 0, 40), root, ["id"])
    sink.append(records(spark, "t", 100, 40), root, ["id"])
    table = KeyedTable(spark, str(tmp_path / "t"), "key STRING, id BIGINT", ["key"], ["id"], buckets=3)
    stream = source.stream_log(spark, root, "id BIGINT", files_per_trigger=1).select("key", "id")
    runs.drain(stream.writeStream.foreachBatch(table.sink()), str(tmp_path / "ckpt"))
    last = source.read_log(spark, root, "id BIGINT").groupBy("key").agg(F.max("id")).collect()
    assert {r[0]: r[1] for r in last} == {r.key: r.id for r in table.read().collect()}


def test_first_arrivals_over_many_batches(spark, root, tmp_path):
    """Every id once, from its first batch, with the least offset; a batch costs the same however many came before."""
    for i in range(6):
        sink.append(records(spark, "t", 10 * i, 20, partitions=2), root, ["id"])  # half of each append was there before
    stream = source.stream_log(spark, root, "id BIGINT", files_per_trigger=2)
    first = live.first_arrivals(stream, "id", F.col("offset"), ["id", "partition", "offset"])
    path, fails = str(tmp_path / "out"), [True, False]
    folder = runs.batch_folder(path)

    def write(df, batch_id):
        folder(df, batch_id)
        if batch_id == 2 and fails and fails.pop(0):
            raise RuntimeError("died")

    writer = first.writeStream.outputMode("update").foreachBatch(write)
    with pytest.raises(Exception, match="died"):
        runs.drain(writer, str(tmp_path / "ckpt"))
    query = runs.drain(writer, str(tmp_path / "ckpt"))
    got = runs.read_batches(spark, path, first.schema).collect()
    assert sorted(r.id for r in got) == list(range(70))
    want = source.read_log(spark, root, "id BIGINT").groupBy("id").agg(F.min("offset").alias("o")).collect()
    assert {r.id: r.offset for r in got} == {r.id: r.o for r in want}
    reads = [p["numInputRows"] for p in query.recentProgress if p["numInputRows"]]
    assert set(reads) == {20}  # the sink reads its own batch only


def test_replay_writes_each_letter_once(spark, root, tmp_path, monkeypatch):
    bad = records(spark, "t", 0, 30).withColumn("value", F.expr("IF(id % 3 = 0, substr(value, 1, length(value) - 1), value)"))
    sink.append(bad, root, ["id"])
    letters = sink.dead_letters(source.read_log(spark, root).where(~is_json("value")).withColumn("error", F.lit("not_json")))
    state, repair = str(tmp_path / "state"), F.concat("original_value", F.lit("}"))
    letters.cache()

    def replay():
        return sink.replay_into(letters, repair, is_json, root, state, partitioners.by_key(3))

    def visible():
        log = source.read_log(spark, root, "txn_id STRING, replay_of STRING")
        outcome = spark.read.parquet(f"{state}/txn_log") if sink.exists(spark, f"{state}/txn_log") else None
        log = log.where("txn_id IS NULL") if outcome is None else sink.read_committed(log, outcome)
        return log.where(is_json("value") & F.col("replay_of").isNotNull()).count()

    real = sink.replayed

    def die(*_):
        raise OSError("died")

    with monkeypatch.context() as broken:  # dies after the append, before the ledger
        appended = sink.append

        def append_and_die(*a, **k):
            appended(*a, **k)
            die()

        broken.setattr(sink, "append", append_and_die)
        with pytest.raises(OSError):
            replay()
    assert visible() == 0 and real(spark, state) is None
    assert replay() and visible() == 10
    assert replay() is None and visible() == 10


def test_retry_loop_reaches_an_end(spark, root, tmp_path):
    sink.append(records(spark, "t", 0, 60), root, ["id"])
    stream = source.stream_log(spark, root, "id BIGINT", files_per_trigger=1).select("id", "key", "timestamp")

    def handle(df):
        failing = F.col("attempt") <= F.col("id") % 5
        name = F.when(F.col("id") % 2 == 0, "NetworkException").otherwise("SerializationException")
        return df.withColumn("error", F.when(failing, name))

    loop = RetryLoop(stream, handle, str(tmp_path / "out"), str(tmp_path / "ckpt"))
    assert loop.run() == 3
    ended = {r.id: r for r in loop.finished(3).collect()}
    assert len(ended) == 60 and loop.finished(3).count() == 60
    for i, r in ended.items():
        fails, retriable = i % 5, i % 2 == 0
        if fails and not retriable:
            assert (r.outcome, r.attempt) == ("dlt", 1)
        else:
            assert (r.outcome, r.attempt) == ("done" if fails < 3 else "dlt", min(fails + 1, 3))
            assert r.timestamp.timestamp() == pytest.approx(i + 0.1 * (2 ** (r.attempt - 1) - 1))
    # Records whose time has not come wait, with their attempt as it was.
    early = RetryLoop(stream, handle, str(tmp_path / "early"), str(tmp_path / "early-ckpt"))
    assert early.run(now_ms=20_000) <= 4
    last = max(n for n in range(6) if early.written(n).count())
    waiting = early.written(last).where("outcome = 'retry'").collect()
    assert waiting and all(r.not_before_ms > 20_000 for r in waiting)
    early.run_pass(last + 1, now_ms=10**9)
    assert early.written(last + 1).where("outcome = 'retry' AND attempt = 1").count() == 0


def test_progress_of_a_long_run(spark, root, tmp_path):
    for i in range(40):  # three files each
        spark.range(i * 6, i * 6 + 6, 1, 3).write.mode("append").parquet(root)
    files = len(spark.read.parquet(root).inputFiles())
    reports = ProgressTable(spark, str(tmp_path / "reports"))
    stream = spark.readStream.schema("id BIGINT").option("maxFilesPerTrigger", 1).parquet(root)
    query = runs.drain(stream.writeStream.format("noop"), str(tmp_path / "ckpt"))
    reports.wait(query)
    reports.close()
    rows = backlog(reports.read(), 240).orderBy("batch").collect()
    assert [r.batch for r in rows] == list(range(files)) and files == 120
    assert sum(r.input_rows for r in rows) == 240 and rows[-1].backlog == 0
    assert all(a.backlog > b.backlog for a, b in zip(rows, rows[1:], strict=False))


def test_streams_of_listed_topics_and_of_a_pattern(spark, root, tmp_path):
    for topic in ("shop-a", "shop-b", "other"):
        sink.append(records(spark, topic, 0, 6), root, ["id"])

    def read(label, **how):
        stream = source.stream_log(spark, root, **how).select("topic", "offset")
        table = runs.appended_table(stream, str(tmp_path / label), str(tmp_path / f"{label}-ckpt"))
        return {r.topic: r["count"] for r in table.groupBy("topic").count().collect()}

    assert read("list", topics=["shop-a", "other", "later"]) == {"shop-a": 6, "other": 6}
    assert read("pattern", pattern="shop-.*") == {"shop-a": 6, "shop-b": 6}
    sink.append(records(spark, "shop-c", 0, 3), root, ["id"])
    sink.append(records(spark, "later", 0, 3), root, ["id"])
    assert read("list", topics=["shop-a", "other", "later"]) == {"shop-a": 6, "other": 6, "later": 3}
    assert read("pattern", pattern="shop-.*") == {"shop-a": 6, "shop-b": 6, "shop-c": 3}
    with pytest.raises(ValueError, match="not names"):
        source.stream_log(spark, root, topics=["a,b"])
