"""Stored logs: appends, seeks, pruning, transactions, dead letters, upserts."""

import pytest
from pyspark.sql import functions as F

from logflow.functions import headers, partitioners
from logflow.functions.parsing import is_json
from logflow.operators import joins, offsets
from logflow.records import as_records
from logflow.sinks import log as sink
from logflow.sources import log as source
from logflow.streaming import runs


def records(spark, topic, first, n, keys=5):
    df = spark.range(first, first + n)
    return as_records(
        df,
        topic,
        F.concat(F.lit("k"), (F.col("id") % keys).cast("string")),
        F.concat(F.lit("v"), F.col("id").cast("string")),
        F.timestamp_seconds(F.col("id") + 1_700_000_000),
        keep=["id"],
    ).withColumn("partition", partitioners.by_key(3))


def dense(log):
    rows = log.groupBy("topic", "partition").agg(
        F.count("*").alias("n"), F.count_distinct("offset").alias("d"), F.min("offset").alias("a"), F.max("offset").alias("z")
    )
    return all(r.n == r.d == r.z - r.a + 1 for r in rows.collect())


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture()
def store(spark, root):
    for topic in ("shop-orders", "shop-payments", "audit"):
        sink.append(records(spark, topic, 0, 60), root, ["id"], width=10)
    return root


def test_appends_continue_offsets_and_keep_order(spark, root):
    for first in (0, 40, 41):
        sink.append(records(spark, "t", first, 40 if first != 40 else 1), root, ["id"], width=7)
    log = source.read_log(spark, root, "id BIGINT")
    assert log.count() == 81 and dense(log)
    assert log.agg(F.min("offset")).first()[0] == 0
    assert offsets.order_violations(log, "id", width=9).agg(F.sum("violations")).first()[0] == 0


def test_only_a_missing_store_counts_as_none(spark, tmp_path):
    (tmp_path / "empty").mkdir()
    assert not sink.exists(spark, str(tmp_path / "none")) and not sink.exists(spark, str(tmp_path / "empty"))
    assert runs.read_batches(spark, str(tmp_path / "none"), spark.range(0).schema).collect() == []
    with pytest.raises(Exception, match="nowhere"):
        sink.exists(spark, "nowhere://store/log")


def test_a_new_topic_starts_at_zero(spark, store):
    sink.append(records(spark, "late", 0, 5), store, ["id"])
    begins = source.bounds(source.scan(spark, store, ["late"])).agg(F.max("begin_offset")).first()[0]
    assert begins == 0


def test_topics_by_list_and_pattern(spark, store):
    def seen(**how):
        return sorted(r.topic for r in source.scan(spark, store, **how).select("topic").distinct().collect())

    assert seen(topics=["audit", "shop-orders"]) == ["audit", "shop-orders"]
    assert seen(pattern="shop-.*") == ["shop-orders", "shop-payments"]
    assert seen(pattern="shop") == []  # the whole name has to match
    sink.append(records(spark, "shop-returns", 0, 3), store, ["id"])
    assert seen(pattern="shop-.*") == ["shop-orders", "shop-payments", "shop-returns"]


def test_scans_prune_folders_and_push_offsets(spark, store):
    one = source.seek(source.scan(spark, store, ["audit"]), partition=1, offset=5)
    text = plan(one)
    assert "PartitionFilters: [isnotnull(topic" in text and "(partition#" in text
    assert "GreaterThanOrEqual(offset,5)" in text
    narrow = plan(source.scan(spark, store, ["audit"]).select("offset"))
    assert "ReadSchema: struct<offset:bigint>" in narrow


def test_seek_end_is_empty_and_first_k(spark, store):
    log = source.scan(spark, store)
    assert source.seek_end(log).count() == 0
    assert source.seek_beginning(log).count() == 180
    heads = source.first_k(log, 2)
    assert heads.count() == 2 * source.bounds(log).count()
    assert heads.agg(F.max("offset")).first()[0] == 1


def test_reset_policies(spark, store):
    log = source.scan(spark, store, ["audit"])
    first = source.bounds(log).orderBy("partition").first()
    commits = spark.createDataFrame(
        [("g", "audit", first.partition, 4)], "consumer_group STRING, topic STRING, partition INT, offset BIGINT"
    )

    def count(policy, group="g"):
        return source.from_positions(log, source.start_positions(log, commits, group, policy)).count()

    assert count("earliest") == 60 - 4
    assert count("latest") == first.end_offset - 4
    assert count("earliest", "nobody") == 60
    assert count("latest", "nobody") == 0
    with pytest.raises(Exception, match="no committed offset"):
        count("none", "nobody")
    assert source.resume(log, commits, "g").count() == 56


def test_number_and_repetition_of_positions_do_not_matter(spark, store):
    log = source.scan(spark, store)
    positions = source.bounds(log).select("topic", "partition", F.lit(3).cast("bigint").alias("start"))
    want = log.where("offset >= 3").count()
    assert source.from_positions(log, positions).count() == want
    later = positions.withColumn("start", F.col("start") + 1)
    strange = spark.range(1000).select(
        F.lit("nowhere").alias("topic"), F.col("id").cast("int").alias("partition"), F.lit(4).cast("bigint").alias("start")
    )
    many = positions.unionByName(later).unionByName(strange)
    assert source.from_positions(log, many).count() == want
    known = source.with_position(log, many, "start", "at")
    assert known.columns == [*log.columns, "at"]
    assert known.count() == log.count() and known.where("at <> 4").count() == 0
    assert source.from_positions(log, positions.limit(0)).count() == 0
    more = records(spark, "audit", 60, 10)
    sink.append(more, store, ["id"])
    assert dense(source.read_log(spark, store))
    ends = source.bounds(source.scan(spark, store)).select("topic", "partition", "end_offset").collect()
    known = spark.createDataFrame(ends, "topic STRING, partition INT, end_offset BIGINT")
    sink.append(records(spark, "audit", 70, 10), store, ["id"], ends=known)
    assert dense(source.read_log(spark, store)) and source.scan(spark, store, ["audit"]).count() == 80


def test_polls_are_bounded_even_with_gaps(spark, store):
    log = source.scan(spark, store, ["audit"]).where(F.col("offset") % 3 != 1)
    sizes = source.polls(log, 4, width=5).groupBy("partition", "poll").count().collect()
    assert max(r["count"] for r in sizes) == 4
    assert sum(r["count"] for r in sizes) == log.count()


def test_skip_poison(spark, store):
    log = source.scan(spark, store, ["audit"])
    bad = log.where(F.col("offset") == 2)
    rest = source.skip_offsets(log, bad)
    assert rest.count() == 60 - bad.count() and rest.where(F.col("offset") == 2).isEmpty()


def test_produce_runs_interceptors_first(spark, root):
    stamp = headers.add_trace_header(F.col("key"))
    sink.produce(records(spark, "t", 0, 10).drop("partition"), root, partitioners.by_key(2), ["id"], [stamp])
    log = source.read_log(spark, root)
    assert log.where(headers.header("X-Trace-Id").isNull()).isEmpty()
    assert {r.partition for r in log.select("partition").distinct().collect()} <= {0, 1}


def test_reset_topic_leaves_the_others(spark, store):
    sink.reset_topic(spark, store, "audit")
    assert source.scan(spark, store, ["audit"]).isEmpty()
    assert source.scan(spark, store).count() == 120
    sink.append(records(spark, "audit", 0, 4), store, ["id"])
    assert source.scan(spark, store, ["audit"]).agg(F.min("offset")).first()[0] == 0


def test_commits_and_checkpoints(spark, store):
    log = source.scan(spark, store, ["audit"])
    saved = offsets.commit_offsets(log.where(F.col("offset") < 10), "g")
    assert {r.offset for r in saved.collect()} == {10}
    later = saved.unionByName(offsets.commit_offsets(log, "g"))
    ends = {r.partition: r.end_offset for r in source.bounds(log).collect()}
    assert {r.partition: r.offset for r in source.newest_commits(later).collect()} == ends
    points = offsets.checkpoints(log, "g", 7, F.lit(2), width=2)
    assert points.where(F.col("state_sum") != F.col("state_count") * 2).isEmpty()
    last = offsets.recover(points)
    assert {r.partition: r.offset for r in last.collect()} == ends
    assert {r.partition: r.state_count for r in last.collect()} == ends


# --- transactions -----------------------------------------------------------------------------


def transactions(spark, n):
    orders = spark.range(n).select(
        F.concat(F.lit("ORD-"), F.col("id")).alias("order_id"),
        F.lit("P").alias("product_id"),
        F.lit("C").alias("customer_id"),
        F.lit(2).alias("quantity"),
        F.concat(F.lit("txn-"), F.col("id")).alias("txn_id"),
        F.col("id").alias("seq"),
        F.timestamp_seconds(F.col("id")).alias("timestamp"),
    )
    records_ = sink.order_transaction(orders).withColumn("partition", partitioners.by_key(2))
    status = F.when(F.col("seq") % 4 == 0, "aborted").otherwise("committed")
    return records_, orders.select("txn_id", status.alias("status"))


EXTRAS = "txn_id STRING, seq BIGINT"


def test_committed_readers_see_all_or_nothing(spark, tmp_path):
    written, decisions = transactions(spark, 8)
    log_path, txn_path = str(tmp_path / "log"), str(tmp_path / "txn")
    # A crash after the records and before the outcomes: nothing is visible.
    sink.append(written, log_path, ["seq"])
    none_yet = decisions.limit(0)
    log = source.read_log(spark, log_path, EXTRAS)
    assert log.count() == 24
    assert sink.read_committed(log, none_yet).count() == 0
    decisions.write.parquet(txn_path)
    visible = sink.read_committed(log, spark.read.parquet(txn_path))
    per_txn = visible.groupBy("txn_id").count().collect()
    assert len(per_txn) == 6 and {r["count"] for r in per_txn} == {3}
    outside = log.withColumn("txn_id", F.when(F.col("seq") != 0, F.col("txn_id")))
    assert sink.read_committed(outside, spark.read.parquet(txn_path)).count() == 21


def test_write_transactions(spark, tmp_path):
    written, decisions = transactions(spark, 5)
    sink.write_transactions(written, decisions, str(tmp_path / "log"), str(tmp_path / "txn"), ["seq"])
    log = source.read_log(spark, str(tmp_path / "log"), EXTRAS)
    txn_log = spark.read.parquet(str(tmp_path / "txn"))
    assert sink.committed_transactions(log, txn_log).count() == 9
    assert dense(log)


# --- quarantine, upsert, dedup ----------------------------------------------------------------


def test_good_and_bad_are_a_partition_of_the_input(spark, store, tmp_path):
    log = source.scan(spark, store, ["audit"])
    body = F.when(F.col("offset") % 4 == 0, F.lit('{"a": "q\\"uote')).otherwise(F.lit('{"a":1}'))
    checked = log.withColumn("value", body).withColumn("error", F.when(~is_json(), "not_json"))
    good, bad = sink.split_by_error(checked, str(tmp_path / "split"))
    assert good.count() + bad.count() == 60
    assert good.join(bad, ["partition", "offset"], "left_semi").isEmpty()
    dlt = sink.dead_letters(bad, retry_count=F.lit(2))
    assert {r.retry_count for r in dlt.collect()} == {2}
    as_log = sink.dead_letter_records(dlt, "dlt")
    opened = as_log.select("key", F.from_json("value", "originalKey STRING, originalValue STRING").alias("j"))
    assert opened.where((F.col("key") != F.col("j.originalKey")) | (F.col("j.originalValue") != '{"a": "q\\"uote')).isEmpty()
    repaired = sink.replay(dlt, F.concat(F.col("original_value"), F.lit('"}')), is_json)
    assert repaired.count() == dlt.count()
    assert sink.replay(dlt, F.concat(F.col("original_value"), F.lit('"}')), is_json, repaired).isEmpty()
    assert sink.replay(dlt, F.col("original_value"), is_json).isEmpty()  # still broken


def test_upsert_replay_changes_nothing(spark):
    target = spark.createDataFrame([(1, "a", 1), (2, "b", 1)], "id INT, v STRING, version INT")
    batch = spark.createDataFrame([(2, "c", 2), (3, "d", 2), (1, "old", 0)], "id INT, v STRING, version INT")
    once = sink.upsert(target, batch, ["id"], ["version"])
    twice = sink.upsert(once, batch, ["id"], ["version"])
    want = [(1, "a", 1), (2, "c", 2), (3, "d", 2)]
    assert sorted(map(tuple, once.collect())) == want == sorted(map(tuple, twice.collect()))


def test_dedup_joins(spark):
    batch = spark.createDataFrame([(1, "x"), (2, "y"), (2, "z")], "id INT, v STRING")
    seen = spark.createDataFrame([(1,), (1,)], "id INT")
    assert sorted(r.v for r in joins.not_seen(batch, seen, "id").collect()) == ["y", "z"]
    assert [r.v for r in joins.already_seen(batch, seen, "id").collect()] == ["x"]
    first = joins.first_arrivals(batch, "id", F.col("v"), ["id", "v"])
    assert sorted(map(tuple, first.collect())) == [(1, "x"), (2, "y")]


def test_enrichment_falls_back(spark):
    orders = spark.createDataFrame([(1, 10), (2, 99), (3, None)], "o INT, c INT")
    customers = spark.createDataFrame([(10, "Ann", None)], "id INT, name STRING, city STRING")
    got = joins.enrich_with_fallback(orders, customers, "c", "id", {"name": "Unknown", "city": "Unknown"})
    assert sorted((r.o, r.name, r.city) for r in got.collect()) == [
        (1, "Ann", "Unknown"),
        (2, "Unknown", "Unknown"),
        (3, "Unknown", "Unknown"),
    ]


def test_first_offsets_report(spark, store):
    log = source.scan(spark, store, ["audit"])
    report = sink.send_report(log, F.expr("offset div 8"), F.col("offset") % 2 == 0).collect()
    for r in report:
        assert r.sent == r.succeeded + r.failed
        assert r.first_offsets == ",".join(str(r.batch * 8 + i) for i in range(min(5, r.sent)))


@pytest.mark.parametrize("fmt", ["json", "csv", "parquet"])
def test_files_keep_nulls_and_text(spark, tmp_path, fmt):
    df = spark.createDataFrame([(1, None, 0.1), (2, "", 1e-7), (3, 'a "b", c', None)], "i INT, s STRING, d DOUBLE")
    back = sink.write_files(df, str(tmp_path / fmt), fmt)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))


def test_codecs(spark, tmp_path):
    df = spark.range(5000).withColumn("s", F.repeat(F.lit("x"), 50))
    report = {r.codec: (r.records, r.bytes) for r in sink.codec_report(df, str(tmp_path / "c")).collect()}
    assert set(report) == {"none", "gzip", "snappy", "lz4", "zstd"}
    assert {n for n, _ in report.values()} == {5000} and all(b > 0 for _, b in report.values())
