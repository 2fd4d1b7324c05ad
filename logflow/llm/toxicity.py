"""Toxicity: gradient-boosted trees over dense text features, with isotonic calibration."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logflow.scratch import materialize
from logflow.session import ship_package

#: Second-person words, and what symbols stand for in disguised words.
SECOND_PERSON = frozenset(
    "you your yours yourself u ur ya tu te toi ton ta tes vous votre vos du dich dir dein deine deiner "
    "ihr euch euer tú ti tus usted ustedes vos vosotros".split()
)
DISGUISES = str.maketrans("013457@$!|+", "oieastasiit")

EDGES = "\"'`.,;:!?()[]{}<>*#%&$~_-/\\|«»“”‘’…¡¿"
STEM = 5
NEAR = 5
MIXED_WORD = re.compile(r"[^\W\d_][0-9@$!|+*.\-_]+[^\W\d_]")
LONG_RUN = re.compile(r"([^\W\d_])\1{3,}")

FEATURES = [
    "words", "hits", "hit_rate", "stem_hits", "stem_rate", "disguised", "disguised_rate", "near_you", "near_you_rate",
    "you_rate", "densest", "capitals", "capital_words", "exclamations", "questions", "symbols", "digits", "obfuscated",
    "stretched",
]


def split(text: str | None) -> list[str]:
    """Lower-case words without the punctuation around them."""
    return [w.strip(EDGES) for w in (text or "").lower().split()]


def terms_of(text: str | None) -> set[str]:
    """A text's words, and its words' first letters as stems (with a mark in front)."""
    words = {w for w in split(text) if w}
    return words | {"^" + w[:STEM] for w in words if len(w) > STEM}


def features_of(text: str | None, lexicon: frozenset[str], stems: frozenset[str]) -> list[float]:
    """FEATURES of one text; all are 0 for null and empty ones."""
    text = text or ""
    words = split(text)
    n = len(words)
    if not n:
        return [0.0] * len(FEATURES)
    full = [i for i, w in enumerate(words) if w in lexicon]
    part = [i for i, w in enumerate(words) if w[:STEM] in stems and len(w) > STEM]
    plain = {*full, *part}
    disguised = [
        i
        for i, w in enumerate(words)
        if w and not w.isalpha() and i not in plain and _bare(w) in lexicon
    ]
    found = np.array(sorted({*plain, *disguised}))
    you = np.array([i for i, w in enumerate(words) if w in SECOND_PERSON])
    near = 0
    if len(found) and len(you):
        after = np.searchsorted(you, found)
        ahead = np.abs(you[np.minimum(after, len(you) - 1)] - found)
        behind = np.abs(you[np.maximum(after - 1, 0)] - found)
        near = int((np.minimum(ahead, behind) <= NEAR).sum())
    densest = int((np.searchsorted(found, found + 50) - np.arange(len(found))).max()) if len(found) else 0
    raw = np.bincount(np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8), minlength=256)
    letters = max(1, int(raw[65:91].sum() + raw[97:123].sum()))
    size = len(text)
    return [
        float(np.log1p(n)),
        float(len(full)), len(full) / n, float(len(part)), len(part) / n, float(len(disguised)), len(disguised) / n,
        float(near), near / n, len(you) / n, float(densest),
        raw[65:91].sum() / letters, sum(map(str.isupper, text.split())) / n,
        raw[33] / size, raw[63] / size, raw[[35, 36, 37, 38, 42, 64]].sum() / size, raw[48:58].sum() / size,
        len(MIXED_WORD.findall(text)) / n, len(LONG_RUN.findall(text)) / n,
    ]


def _bare(word: str) -> str:
    return re.sub(r"[\W_]", "", word.translate(DISGUISES))


def learn_lexicon(sample: DataFrame, limit: int) -> tuple[frozenset[str], frozenset[str]]:
    """Words and stems that toxic texts of ``sample (text, toxic)`` have far more often; at most ``limit``."""

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part, terms, marks = batch.slice(at, 512), [], []
                for text, toxic in zip(part.column("text"), part.column("toxic").to_pylist(), strict=True):
                    own = terms_of(text.as_py())
                    terms += own
                    marks += [toxic] * len(own)
                yield pa.RecordBatch.from_arrays([pa.array(terms, pa.string()), pa.array(marks, pa.int32())], names=["term", "toxic"])

    bad, all_ = sample.agg(F.sum("toxic"), F.count("*")).first()
    counts = sample.mapInArrow(explode, "term string, toxic int").groupBy("term")
    counts = counts.agg(F.sum("toxic").alias("a"), F.count("*").alias("n")).where("a >= 2")
    a, b = F.col("a") + 0.5, F.col("n") - F.col("a") + 0.5
    odds = F.log(a / (F.lit(bad + 1.0) - a)) - F.log(b / (F.lit(all_ - bad + 1.0) - b))
    z = odds / F.sqrt(1 / a + 1 / b)
    best = counts.select("term", z.alias("z"), odds.alias("odds")).where("z > 2 AND odds > 2")
    terms = [r.term for r in best.orderBy(F.desc("z"), "term").limit(limit).collect()]
    return frozenset(t for t in terms if t[0] != "^"), frozenset(t[1:] for t in terms if t[0] == "^")


def with_features(documents: DataFrame, lexicon: frozenset[str], stems: frozenset[str]) -> DataFrame:
    """``doc_id`` and FEATURES of every row, from its whole text."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                rows = np.array([features_of(t.as_py(), lexicon, stems) for t in part.column("text")], float)
                columns = [pa.array(c) for c in rows.reshape(-1, len(FEATURES)).T.copy()]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), *columns], names=["doc_id", *FEATURES])

    schema = "doc_id long, " + ", ".join(f"{c} double" for c in FEATURES)
    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(work, schema)


def score(
    documents: DataFrame, labels: DataFrame, sample_rows: int = 20_000, lexicon_terms: int = 200, trees: int = 20, depth: int = 4
) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every document; ``score`` is the calibrated chance of ``toxic = 1``.

    Rows whose crc32(doc_id as text) mod 5 is 0 are held out.  Of the labels of the others, ``sample_rows`` chosen
    by hash are used: two fifths to find the lexicon (words and stems), two fifths for the trees, one for the
    calibration, so none of the three judges rows that another has learned from.  Inputs of a score are features
    of the text alone.  The calibrated score keeps the order of the trees' own within its steps, by a thousandth.

    Null and empty texts have features of 0 and are scored like others.  A row without doc_id counts as held out.
    Null labels are left out; of several labels of one id the largest counts.  Without labels of both kinds in
    every part, all scores are the share of toxic labels (0 without any).  Other columns are ignored.
    """
    ship_package(documents.sparkSession)
    held = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    known = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").where(~held).groupBy("doc_id")
    known = known.agg(F.max("toxic").cast("int").alias("toxic")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows)
    part = F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(5)).cast("int").alias("part")
    # At most sample_rows rows of three numbers: small enough to send to every executor.
    known = F.broadcast(materialize(known.select(F.col("doc_id").cast("long").alias("doc_id"), "toxic", part), "labelled"))
    keyed = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    sample = materialize(keyed.join(known, "doc_id"), "sample")
    kind = F.when(F.col("part") < 2, 0).when(F.col("part") < 4, 1).otherwise(2)
    seen = {(r[0], r[1]): r[2] for r in sample.groupBy(kind.alias("kind"), "toxic").count().collect()}
    id_out = ["doc_id", F.coalesce(held, F.lit(True)).alias("held_out")]
    if any((k, t) not in seen for k in range(3) for t in range(2)):
        share = sum(n for (_, t), n in seen.items() if t) / max(1, sum(seen.values()))
        return keyed.select(*id_out, F.lit(float(share)).alias("score"), F.lit(int(share >= 0.5)).alias("predicted"))
    lexicon, stems = learn_lexicon(sample.where("part < 2").select("text", "toxic"), lexicon_terms)

    assemble = VectorAssembler(inputCols=FEATURES, outputCol="features")
    fit = with_features(sample, lexicon, stems).dropDuplicates(["doc_id"]).join(known, "doc_id")
    fit = assemble.transform(materialize(fit.where("part >= 2"), "features"))
    trained = GBTClassifier(featuresCol="features", labelCol="toxic", maxIter=trees, maxDepth=depth, seed=7).fit(
        fit.where("part < 4").select("features", "toxic").coalesce(4)
    )

    def rated(df: DataFrame) -> DataFrame:
        return trained.transform(df).withColumn("raw", vector_to_array("probability")[1])

    steps = IsotonicRegression(featuresCol="raw", labelCol="toxic", predictionCol="calibrated").fit(
        rated(fit.where("part = 4")).select("raw", "toxic")
    )
    rows = rated(assemble.transform(with_features(documents, lexicon, stems)))
    value = 0.999 * F.least(F.lit(1.0), F.greatest(F.lit(0.0), "calibrated")) + 0.001 * F.col("raw")
    rows = steps.transform(rows.select("doc_id", "raw")).select(*id_out, value.alias("score"))
    return rows.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
