"""Documents to training sequences: quality, near-duplicates, repeated passages, mix, packing."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logflow.llm import mixing, neardup, packing, passages, perplexity
from logflow.llm.chunks import release_tables, store_chunks, without_rows
from logflow.llm.common import table
from logflow.llm.queries import tokenizer_path
from logflow.scratch import fresh_dir, materialize, recorded, release

#: The models, estimates and alignments of these stages have no SQL form.  No test compares run() or a document's
#: perplexity with plain Python; tests cover the operators and the last and the near-duplicates stage.
ORACLE_SQL = None
#: Text bytes of a chunk of documents, in near_duplicates.
CHUNK_BYTES = 16 << 20

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
#: Working folders of the last stage, by application.
_left: dict[str, list[str]] = {}


def stage(fn: Stage) -> Stage:
    """A stage that first deletes the working tables of the one before, which its stored result does not need.

    Folders that ``docs`` still reads, as where the result was not stored, stay.
    """

    @functools.wraps(fn)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        app = spark.sparkContext.applicationId
        files, left = docs.inputFiles(), _left.pop(app, [])
        used = [path for path in left if any(f"/{path.rsplit('/', 1)[1]}/" in file for file in files)]
        release_tables(spark, [path for path in left if path not in used])
        with recorded() as made:
            out = fn(spark, docs, sf_dir)
        _left[app] = used + made
        return out

    return run_stage


@stage
def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose perplexity is within their language's threshold."""
    return perplexity.filter_quality(docs, table(spark, sf_dir, "labels"))


@stage
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, the one with the smallest id; of equal and null ids, one row.

    Every row is a document of its own here, whatever its id.
    """
    store = store_chunks(docs, CHUNK_BYTES)
    groups = neardup.near_duplicates(store.select(F.col("rid").alias("doc_id"), F.col("row.text").alias("text")))
    ids = store.select("chunk", "rid", F.col("row.doc_id").alias("doc_id"))
    groups = materialize(groups.select(F.col("doc_id").alias("rid"), "component_id").join(ids, "rid"), "groups")
    rank = F.struct(F.col("doc_id").isNull().alias("without_id"), "doc_id", "rid")
    stays = groups.groupBy("component_id").agg(F.min(rank).alias("first")).select(F.col("first.rid").alias("rid"))
    return without_rows(store, groups.join(stays, "rid", "left_anti"), docs.schema)


@stage
def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of 50 words or more that an earlier document has."""
    cut = passages.remove_repeats(docs)
    if "n_chars" in docs.columns:
        cut = cut.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return cut.select(docs.columns)


@stage
def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them; of the last one of a source, only the words within its budget."""
    return mixing.take(docs)


@stage
def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their ids, in sequences of 1024 ids."""
    return packing.pack_documents(docs, tokenizer_path("byte_bpe_50k.json"))


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("mix", mix),
    ("pack", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; the result of each is a stored table that the next one reads."""
    docs, before = table(spark, sf_dir, "documents"), None
    for name, one in STAGES[:-1]:
        path = fresh_dir(spark, name)
        out = one(spark, docs, sf_dir)
        out.write.parquet(path)
        docs = spark.read.schema(out.schema).parquet(path)
        if before:
            release(spark, [before])
        before = path
    return STAGES[-1][1](spark, docs, sf_dir)
