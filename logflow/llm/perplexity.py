"""Quality classifier: perplexity under an interpolated modified Kneser-Ney model of characters.

The model is a table of n-gram counts from trusted text.  It is never loaded anywhere as a whole: counts and
probabilities are joined by n-gram, and every chunk of documents gets the probabilities of its own n-grams.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logflow.llm.chunks import store_chunks, without_rows
from logflow.llm.common import mixed
from logflow.scratch import materialize

#: Text bytes of the documents of one chunk, and code points that are counted at a time.
CHUNK_BYTES = 16 << 20
PIECE = 1 << 20
#: Stands before the first character of a text.
START = "\x02"
#: Characters of the base distribution, known or not: all of Unicode.
ALPHABET = 0x110000
#: Thresholds are looked for in steps of 1/200 of the logarithm, so what is sorted does not grow with the labels.
STEPS = 200
#: Fewest labelled documents of a kind for a threshold of a language's own.
LEAST_LABELS = 20

_STEP = np.uint64(0x9E3779B97F4A7C15)


def gram_keys(points: np.ndarray, order: int) -> np.ndarray:
    """A 64-bit key for each run of ``order`` code points."""
    n, key = len(points) - order + 1, np.zeros(max(0, len(points) - order + 1), np.uint64)
    wide = points.astype(np.uint64) + np.uint64(1)
    for i in range(order):
        key = key * _STEP + wide[i : i + n]
    return mixed(key)


def pieces(texts: list[str | None], order: int) -> Iterator[tuple[np.ndarray, str, np.ndarray, np.ndarray]]:
    """Texts in pieces of bounded size: which texts, all characters, n-gram starts, and the text of each n-gram.

    A long text is cut so that its pieces overlap and every character is the end of one n-gram.
    """
    lead, part, owners, size = START * (order - 1), [], [], 0

    def piece():
        line, starts, of, at = "".join(part), [], [], 0
        for owner, text in zip(owners, part, strict=True):
            n = len(text) - order + 1
            starts.append(np.arange(at, at + n))
            of.append(np.full(n, owner))
            at += len(text)
        return line, np.concatenate(starts), np.concatenate(of)

    for i, text in enumerate(texts):
        text = lead + (text or "")
        for at in range(0, len(text) - order + 1, PIECE):
            part.append(text[at : at + PIECE + order - 1])
            owners.append(i)
            size += len(part[-1])
            if size >= PIECE:
                yield piece()
                part, owners, size = [], [], 0
    if part:
        yield piece()


def points_of(line: str) -> np.ndarray:
    return np.frombuffer(line.encode("utf-32-le", "surrogatepass"), np.uint32)


def count_grams(texts: list[str | None], trusted: np.ndarray, order: int) -> tuple[list[str], np.ndarray]:
    """Distinct n-grams of all texts, and how often each stands in the trusted ones."""
    keys, grams, counts = [], [], []
    for line, starts, of in pieces(texts, order):
        all_keys = gram_keys(points_of(line), order)[starts]
        codes, unique = pd.factorize(all_keys)
        first = np.empty(len(unique), np.int64)
        first[codes[::-1]] = starts[::-1]
        keys.append(unique)
        grams.append(np.array([line[i : i + order] for i in first.tolist()], object))
        counts.append(np.bincount(codes, trusted[of], len(unique)))
    if not keys:
        return [], np.zeros(0, np.int64)
    codes, unique = pd.factorize(np.concatenate(keys))
    names = np.empty(len(unique), object)
    names[codes] = np.concatenate(grams)
    return names.tolist(), np.bincount(codes, np.concatenate(counts), len(unique)).astype(np.int64)


def prefix(gram: str, n: int) -> Column:
    return F.substring(gram, 1, n)


def suffix(gram: str, n: int) -> Column:
    return F.substring(gram, -n, n) if n else F.lit("")


def discounts(counts: DataFrame) -> list[float]:
    """The three discounts of modified Kneser-Ney from the numbers of n-grams that occur once to four times."""
    n1, n2, n3, n4 = (
        counts.agg(*[F.sum((F.col("c") == i).cast("long")) for i in range(1, 5)]).first() or (0, 0, 0, 0)
    )
    if not (n1 and n2 and n3 and n4):
        return [0.5, 1.0, 1.5]  # too few n-grams to estimate them
    y = n1 / (n1 + 2 * n2)
    found = [1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3]
    return [min(max(d, 0.0), float(i + 1)) for i, d in enumerate(found)]


def probabilities(wanted: DataFrame, counts: DataFrame, order: int) -> DataFrame:
    """``lang, gram, logp``: the natural logarithm of P(last character | those before) for ``wanted (lang, gram)``.

    ``counts (lang, gram, c)`` are counts of the highest order; lower orders count in how many different ways an
    n-gram continues to the left.  Each order is discounted and interpolated with the next lower one, the
    lowest with equal chances for all characters.
    """
    levels = {order: materialize(counts, "counts")}
    for n in range(order - 1, 0, -1):
        lower = levels[n + 1].groupBy("lang", suffix("gram", n).alias("gram")).agg(F.count("*").alias("c"))
        levels[n] = materialize(lower, "counts")
    queries = {order: wanted}
    for n in range(order - 1, 0, -1):
        queries[n] = queries[n + 1].select("lang", suffix("gram", n).alias("gram")).distinct()
    below = None
    for n in range(1, order + 1):
        d1, d2, d3 = discounts(levels[n])
        cut = F.when(F.col("c") == 1, d1).when(F.col("c") == 2, d2).otherwise(d3)
        context = levels[n].groupBy("lang", prefix("gram", n - 1).alias("context"))
        context = context.agg(F.sum("c").alias("total"), F.sum(F.least(cut, F.col("c"))).alias("freed"))
        own = levels[n].select("lang", "gram", F.greatest(F.lit(0.0), F.col("c") - cut).alias("kept"))
        rows = queries[n].withColumn("context", prefix("gram", n - 1))
        rows = rows.join(own, ["lang", "gram"], "left").join(context, ["lang", "context"], "left")
        if below is None:
            base = F.lit(1.0 / ALPHABET)
        else:
            rows = rows.withColumn("rest", suffix("gram", n - 1)).join(below, ["lang", "rest"])
            base = F.col("base")
        p = F.when(
            F.col("total") > 0, (F.coalesce("kept", F.lit(0.0)) + F.col("freed") * base) / F.col("total")
        ).otherwise(base)
        level = materialize(rows.select("lang", "gram", p.alias("p")), "level")
        below = level.select("lang", F.col("gram").alias("rest"), F.col("p").alias("base"))
    return level.select("lang", "gram", F.ln("p").alias("logp"))


def thresholds(labelled: DataFrame, quantile: float) -> DataFrame:
    """``lang, threshold`` for every language of ``labelled (lang, perplexity, kind)`` with learnt text.

    A threshold minimizes the share of the ``clean`` documents above it plus the share of the ``junk`` ones below it
    and lies in the middle, by logarithm, of the gap there; of equal ones the highest.  Without enough junk it is
    the ``quantile`` of the clean ones, without enough clean ones that of all languages together, which is null if
    there is no clean document at all.
    """
    count = lambda kind: F.count(F.when(F.col("kind") == kind, 1)).alias(kind)
    step = F.floor(F.ln("perplexity") * STEPS).alias("step")
    steps = labelled.groupBy("lang", step).agg(count("learnt"), count("clean"), count("junk"))
    steps = materialize(steps, "steps")
    pooled = steps.groupBy("step").agg(F.sum("clean").alias("clean"), F.sum("junk").alias("junk"))
    rows = steps.select("lang", "step", "clean", "junk").unionByName(pooled.withColumn("lang", F.lit(None).cast("string")))
    whole = Window.partitionBy("lang")
    upward = whole.orderBy("step").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.where("clean + junk > 0").select(
        "lang",
        "step",
        F.lead("step").over(whole.orderBy("step")).alias("next"),
        F.sum("clean").over(whole).alias("n_clean"),
        F.sum("junk").over(whole).alias("n_junk"),
        F.sum("clean").over(upward).alias("clean_in"),
        F.sum("junk").over(upward).alias("junk_in"),
    )
    lost, missed = F.col("n_clean") - F.col("clean_in"), F.col("junk_in")
    cost = lost * F.col("n_junk") + missed * F.col("n_clean")
    middle = (F.col("step") + 1 + F.coalesce("next", F.col("step") + 1)) / 2
    within = F.when(F.col("clean_in") >= quantile * F.col("n_clean"), F.col("step") + 1)
    limits = rows.groupBy("lang").agg(
        F.max("n_clean").alias("n_clean"),
        F.max("n_junk").alias("n_junk"),
        F.exp(F.min_by(middle, F.struct(cost, -F.col("step"))) / STEPS).alias("between"),
        F.exp(F.min(within) / STEPS).alias("of_clean"),
    )
    least = F.when(F.col("lang").isNull(), 1).otherwise(LEAST_LABELS)
    limit = F.when(F.col("n_junk") >= least, F.col("between")).otherwise(F.col("of_clean"))
    limits = limits.where(F.col("n_clean") >= least).select("lang", limit.alias("threshold"))
    pooled = limits.where("lang IS NULL").select(F.col("threshold").alias("pooled"))
    learnt = steps.groupBy("lang").agg(F.sum("learnt").alias("learnt")).where("learnt > 0").select("lang")
    both = learnt.join(limits, "lang", "left").join(F.broadcast(pooled), how="left")
    return both.select("lang", F.coalesce("threshold", "pooled").alias("threshold"))


def score(documents: DataFrame, labels: DataFrame, order: int = 4, quantile: float = 0.99):
    """Chunked documents, and ``chunk, rid, doc_id, lang, n_chars, perplexity, threshold, keep`` of each row.

    Trusted text are the documents labelled ``quality = 1``; of these, those whose crc32(doc_id as text) mod 5 is
    0 are held out, and the model of a language counts the n-grams of all others.  The threshold of a language
    parts its held-out documents' perplexities from those of its documents labelled ``quality = 0`` that are not
    held out, see ``thresholds``.  Documents above it are rejected.

    Null and empty texts have no perplexity and are rejected.  A null lang is a language of its own.  A language
    without trusted text has no model, so no threshold, and its texts are kept.  Repeated rows are scored alike; a
    doc_id with several labels is trusted only if all are 1, and junk only if all are 0.  Other columns are ignored
    here and kept in the chunks.
    """
    store = store_chunks(documents, CHUNK_BYTES)
    held = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    good = F.min(F.coalesce("quality", F.lit(0))) == 1
    bad = F.max(F.coalesce("quality", F.lit(1))) == 0
    kind = F.when(F.col("good") & held, "clean").when(F.col("good"), "learnt").when(F.col("bad") & ~held, "junk")
    kinds = labels.where("doc_id IS NOT NULL").groupBy("doc_id").agg(good.alias("good"), bad.alias("bad"))
    kinds = kinds.select(F.col("doc_id").cast("long").alias("doc_id"), kind.alias("kind")).where("kind IS NOT NULL")
    row = F.col("row")
    slim = store.select(
        "chunk",
        "rid",
        row["doc_id"].cast("long").alias("doc_id"),
        F.coalesce(row["lang"], F.lit("")).alias("lang"),
        row["text"].alias("text"),
    )
    labelled = slim.select("chunk", "rid", "doc_id").join(kinds, "doc_id").select("chunk", "rid", "kind")
    labelled = materialize(labelled, "labelled")

    def grams_of(docs: pa.Table, own: pa.Table) -> pa.Table:
        langs, texts = np.array(docs["lang"].to_pylist(), object), docs["text"].to_pylist()
        use = np.isin(docs["rid"].to_numpy(), own["rid"].to_numpy()).astype(float)
        out = [([], [], np.zeros(0, np.int64))]
        for lang in sorted(set(langs)):
            at = np.flatnonzero(langs == lang)
            names, counts = count_grams([texts[i] for i in at], use[at], order)
            out.append(([lang] * len(names), names, counts))
        langs_out, names, counts = zip(*out, strict=True)
        chunk = docs["chunk"][0].as_py() if docs.num_rows else None
        n = sum(map(len, names))
        columns = [pa.array([chunk] * n, pa.int64()), pa.array(sum(langs_out, []), pa.string())]
        columns += [pa.array(sum(names, []), pa.string()), pa.array(np.concatenate(counts))]
        return pa.table(columns, names=["chunk", "lang", "gram", "c"])

    learn = labelled.where("kind = 'learnt'").select("chunk", "rid").groupBy("chunk")
    grams = slim.groupBy("chunk").cogroup(learn).applyInArrow(grams_of, "chunk long, lang string, gram string, c long")
    grams = materialize(grams, "grams")
    totals = materialize(grams.groupBy("lang", "gram").agg(F.sum("c").alias("c")), "totals")
    known = probabilities(totals.select("lang", "gram"), totals.where("c > 0"), order)
    own = grams.select("chunk", "lang", "gram").join(known, ["lang", "gram"])

    def perplexities(docs: pa.Table, known: pa.Table) -> pa.Table:
        langs, texts = np.array(docs["lang"].to_pylist(), object), docs["text"].to_pylist()
        sums, counts = np.zeros(len(texts)), np.zeros(len(texts))
        of_known = known["lang"].to_pandas()
        for lang in sorted(set(langs)):
            at, mask = np.flatnonzero(langs == lang), (of_known == lang).to_numpy()
            names = known["gram"].to_pandas()[mask]
            logp = known["logp"].to_numpy()[mask]
            keys = pd.Index(gram_keys(points_of("".join(names)), order)[::order])
            for line, starts, of in pieces([texts[i] for i in at], order):
                place = keys.get_indexer(gram_keys(points_of(line), order)[starts])
                if (place < 0).any():
                    raise ValueError("a chunk has an n-gram that was not counted")
                sums += np.bincount(at[of], logp[place], len(texts))
                counts += np.bincount(at[of], minlength=len(texts))
        with np.errstate(invalid="ignore", divide="ignore"):
            value = np.exp(-sums / counts)
        columns = [docs[c] for c in ("chunk", "rid", "doc_id", "lang")]
        columns += [pa.array(counts.astype(np.int64)), pa.array(value, mask=counts == 0)]
        return pa.table(columns, names=["chunk", "rid", "doc_id", "lang", "n_chars", "perplexity"])

    schema = "chunk long, rid long, doc_id long, lang string, n_chars long, perplexity double"
    scored = slim.groupBy("chunk").cogroup(own.groupBy("chunk")).applyInArrow(perplexities, schema)
    scored = materialize(scored, "scored")
    limits = thresholds(scored.where("perplexity IS NOT NULL").join(labelled, ["chunk", "rid"]), quantile)
    keep = F.col("perplexity").isNotNull() & F.coalesce(F.col("perplexity") <= F.col("threshold"), F.lit(True))
    return store, scored.join(limits, "lang", "left").withColumn("keep", keep)


def filter_quality(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that ``score`` keeps, with all their columns."""
    store, scored = score(documents, labels)
    return without_rows(store, scored.where("NOT keep"), documents.schema)
