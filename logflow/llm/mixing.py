"""Mixing sources to target weights."""

from __future__ import annotations

import re
from itertools import islice

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from logflow.llm.chunks import store_chunks
from logflow.llm.common import word_count
from logflow.scratch import materialize

#: Documents of one source that are sorted together; a source has as many ranges of random keys as this needs.
RANGE_ROWS = 5_000
#: Text bytes of the documents that one task repeats at a time.
CHUNK_BYTES = 8 << 20


def ranked_sources(sizes: DataFrame, weights: list[float]) -> DataFrame:
    """``source, n_docs, source_size, weight``: weights repeat over the sources by code point, null last.

    Sources are ranked without meeting in one task: by a range per first character's code, ranked inside, plus
    the number of sources in the ranges before.
    """
    sources = sizes.groupBy("source").agg(F.count("*").alias("n_docs"), F.sum("size").alias("source_size"))
    # The first three bytes of the name as a number keep the order of names; null comes last.
    lead = F.when(F.col("source").isNull(), F.lit("~")).otherwise(F.hex(F.substring(F.encode("source", "UTF-8"), 1, 3)))
    sources = materialize(sources.withColumn("lead", F.rpad(lead, 6, "0")), "sources")
    order = Window.partitionBy("lead").orderBy(F.asc_nulls_last("source"))
    leads = sources.groupBy("lead").agg(F.count("*").alias("n"))
    before = leads.select("lead", (F.sum("n").over(Window.orderBy("lead")) - F.col("n")).alias("before"))
    weight = F.element_at(
        F.array(*[F.lit(float(w)) for w in weights]),
        ((F.col("before") + F.row_number().over(order) - 1) % len(weights) + 1).cast("int"),
    )
    return sources.join(before, "lead").select("source", "n_docs", "source_size", weight.alias("weight"))


def with_targets(sources: DataFrame, budget_ratio: float, max_epochs: float) -> DataFrame:
    """Adds ``target``: the budget shared by weight, at most ``max_epochs`` times a source's size.

    Rounds move the excess of sources at their limit to the others until none is above; each round reads
    three sums.  A source without words has the target 0.
    """
    limit = F.col("source_size") * F.lit(float(max_epochs))
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    rate, full = 0.0, -1
    while total:
        capped = limit <= F.col("weight") * F.lit(rate)
        now, held, weight = sources.agg(
            F.coalesce(F.sum(capped.cast("long")), F.lit(0)),
            F.coalesce(F.sum(F.when(capped, limit)), F.lit(0.0)),
            F.coalesce(F.sum(F.when(~capped, F.col("weight"))), F.lit(0.0)),
        ).first()
        if now == full or weight == 0:
            break
        full, rate = now, (budget_ratio * total - held) / weight
    return sources.withColumn("target", F.least(limit, F.col("weight") * F.lit(rate)))


def mix(
    documents: DataFrame,
    weights: tuple[float, ...] = (3.0, 1.0, 2.0),
    budget_ratio: float = 1.5,
    max_epochs: float = 2.0,
    seed: int = 42,
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """Words to take of each document: ``doc_id, source, size, source_size, target, taken`` and ``carry``.

    Sources share ``budget_ratio`` times all words by weight (see ``with_targets``).  A source is read whole as
    often as its target holds it; of one more pass, documents are taken by hash-random key until the words
    left, which cut the last of them.  Keys are sorted in ranges of the key within each source; a prefix sum
    over the ranges' totals joins them, so neither a source nor a range has to be small.

    Null texts have size 0; a null source is a source of its own.  Repeated rows are documents of their own.
    Other columns are ignored.  An empty table gives no rows.  The same rows and seed give the same mix.
    """
    key = F.xxhash64(F.lit(seed), "doc_id", F.col("size"))
    sizes = documents.select("doc_id", "source", word_count(F.col("text")).alias("size"), *carry).withColumn("key", key)
    sizes = materialize(sizes, "sizes")
    sources = with_targets(ranked_sources(sizes, list(weights)), budget_ratio, max_epochs)
    sources = sources.withColumn("ranges", F.ceil(F.col("n_docs") / RANGE_ROWS).cast("long"))

    # Each source's keys in equal ranges: the upper 31 bits, scaled by the number of ranges.
    place = (F.shiftrightunsigned("key", 33) * F.col("ranges") / F.lit(1 << 31)).cast("long")
    parts = sources.select(F.col("source").alias("of"), "ranges")
    dealt = sizes.join(parts, F.col("source").eqNullSafe(F.col("of"))).withColumn("range", place).drop("of", "ranges")
    unsigned = [F.shiftrightunsigned("key", 33), F.col("key"), F.col("doc_id"), F.col("size")]
    inside = Window.partitionBy("source", "range").orderBy(*unsigned).rowsBetween(Window.unboundedPreceding, -1)
    dealt = dealt.withColumn("inside", F.coalesce(F.sum("size").over(inside), F.lit(0)))

    before = Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    totals = sizes.join(parts, F.col("source").eqNullSafe(F.col("of"))).groupBy("source", place.alias("range"))
    totals = totals.agg(F.sum("size").alias("range_size"))
    totals = totals.withColumn("before", F.coalesce(F.sum("range_size").over(before), F.lit(0)))
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    left = F.round(F.col("target") - F.col("epochs") * F.col("source_size")).cast("long")
    plan = (
        totals.join(sources.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of")))
        .withColumn("epochs", epochs.cast("long"))
        .select(
            F.col("source").alias("of"),
            F.col("range").alias("of_range"),
            "before",
            "source_size",
            "target",
            "epochs",
            left.alias("left"),
        )
    )
    rest = F.col("left") - F.col("before") - F.col("inside")
    taken = F.col("epochs") * F.col("size") + F.greatest(F.lit(0), F.least(rest, F.col("size")))
    joined = dealt.join(plan, F.col("source").eqNullSafe(F.col("of")) & (F.col("range") == F.col("of_range")))
    return joined.select("doc_id", "source", "size", "source_size", "target", taken.cast("long").alias("taken"), *carry)


def first_words(text: str, n: int) -> str:
    """A text up to the end of its ``n``-th word, white space unchanged."""
    data = text.encode("utf-8", "surrogatepass")
    last = next(islice(re.finditer(rb"[^\x20\x09-\x0D]+", data), n - 1, None))
    return data[: last.end()].decode("utf-8", "surrogatepass")


def take(documents: DataFrame, **options) -> DataFrame:
    """The mix itself: every document as often as ``mix`` takes it, all columns as they are.

    Of a document that is not taken whole, the text ends after the last word taken, and ``n_chars``, if there is
    such a column, follows.  Documents without words are in no mix.
    """
    store = store_chunks(documents, CHUNK_BYTES)
    rows = store.select("row.doc_id", "row.source", "row.text", "chunk", "rid")
    plan = mix(rows, carry=("chunk", "rid"), **options).where("taken > 0").select("chunk", "rid", "size", "taken")

    def repeat(docs: pa.Table, plan: pa.Table) -> pa.Table:
        share = {r: (s, t) for r, s, t in zip(*(plan[c].to_pylist() for c in ("rid", "size", "taken")), strict=True)}
        times, cut = [], []
        for i, rid in enumerate(docs["rid"].to_pylist()):
            size, taken = share.get(rid, (1, 0))
            times += [i] * (taken // size)
            if taken % size:
                cut.append((i, taken % size))
        rows = pa.Table.from_struct_array(docs["row"])
        part = rows.take(pa.array([i for i, _ in cut], pa.int64()))
        at, kind = rows.schema.get_field_index("text"), rows.schema.field("text").type
        texts = [first_words(t, n) for t, (_, n) in zip(part["text"].to_pylist(), cut, strict=True)]
        part = part.set_column(at, "text", pa.array(texts, kind))
        if "n_chars" in rows.schema.names:
            at, kind = rows.schema.get_field_index("n_chars"), rows.schema.field("n_chars").type
            part = part.set_column(at, "n_chars", pa.array([len(t) for t in texts], kind))
        whole = rows.take(pa.array(times, pa.int64()))
        return pa.concat_tables([whole, part.cast(whole.schema)])

    return store.groupBy("chunk").cogroup(plan.groupBy("chunk")).applyInArrow(repeat, documents.schema)
