"""Histogram sort against the law of near-equal bytes, on rows with nulls, copies, ties and odd columns."""

import random
from collections import defaultdict

import pytest

from logflow.llm.sharding import ROW_BYTES, shard_documents

DOCS = "doc_id long, text string, lang string, size string, shard int, slot string, k0 int, `row` int, `range` string"


def rows_of(rng, n):
    """A third of the rows is one text, a tenth one whole row; then nulls, an empty and a very long text."""
    rows = [(i, "copy " * 30 if i % 3 == 0 else "w" * rng.randrange(400) + str(i), "en", "s", 1, "t", 2, 3, "r") for i in range(n)]
    rows += [(7, "again", "de", None, None, None, None, None, None)] * (n // 10)
    return rows + [(None, None, None, "s", 1, "t", 2, 3, "r")] * 5 + [(n + 1, "", "en", "s", 1, "t", 2, 3, "r"), (n + 2, "ü" * 30_000, "fr", "s", 1, "t", 2, 3, "r")]


def check(rows, got, shards, tolerance, columns):
    assert sorted((repr((r.doc_id, r.text, r.lang)) for r in got)) == sorted(repr(r[:3]) for r in rows)
    by_shard = defaultdict(list)
    for r in got:
        assert r.law == "bytes" and 0 <= r.shard < shards
        assert r.size == len((r.text or "").encode()) + ROW_BYTES
        by_shard[r.shard].append(r)
    longest, total = max(r.size for r in got), sum(r.size for r in got)
    for i in range(shards):
        own = sorted(by_shard[i], key=lambda r: r.slot)
        assert [r.slot for r in own] == list(range(len(own)))
        assert abs(sum(r.size for r in own) - total / shards) <= longest + 2 * tolerance * total / shards
    # Equal texts follow each other over all shards.
    texts = [r.text for i in range(shards) for r in sorted(by_shard[i], key=lambda r: r.slot)]
    changes = sum(a != b for a, b in zip(texts, texts[1:], strict=False)) + 1
    assert changes == len(set(texts))
    assert set(columns) - {"size", "shard", "slot"} <= set(got[0].asDict())


@pytest.mark.parametrize(
    ("n", "shards", "settings"),
    [
        (600, 5, {}),
        (600, 7, {"range_bytes": 4_000}),  # several ranges in a shard
        (600, 4, {"first_probes": 3, "probes": 4}),  # many rounds, down to the doc_id and the place of copies
        (600, 4, {"range_bytes": 4_000, "most_ranges": 8}),
        (6, 20, {}),  # fewer rows than shards
    ],
)
def test_near_equal_bytes(spark, n, shards, settings):
    rows = rows_of(random.Random(n), n)
    df = spark.createDataFrame(rows, DOCS).repartition(3)
    got = shard_documents(df, shards, **settings).collect()
    check(rows, got, shards, 0.001, df.columns)


def test_one_text_is_split(spark):
    df = spark.createDataFrame([(i % 2, "same") for i in range(4000)], "doc_id long, text string").repartition(4)
    got = shard_documents(df, 8, first_probes=16, probes=16).groupBy("shard").count().collect()
    assert sorted(r["shard"] for r in got) == list(range(8))
    assert all(abs(r["count"] - 500) <= 2 for r in got)


def test_empty_table_and_null_rows(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert shard_documents(df).collect() == []
    assert shard_documents(df).columns == ["doc_id", "text", "size", "law", "shard", "slot"]
    nulls = spark.createDataFrame([(None, None)] * 50, "doc_id long, text string")
    got = shard_documents(nulls, 5).groupBy("shard").count().collect()
    assert sorted((r["shard"], r["count"]) for r in got) == [(i, 10) for i in range(5)]


def test_native(spark):
    """No Python in the plan of the exchange or of the slots."""
    df = spark.createDataFrame(rows_of(random.Random(1), 100), DOCS)
    plan = shard_documents(df, 3)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
