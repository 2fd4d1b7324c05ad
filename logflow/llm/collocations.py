"""Collocations from a weighted de Bruijn graph of phrases.

Only the longest phrases are counted in the texts: they are the edges between the overlapping phrases of one word
less.  Every word of a text starts one of them or, near the end of its piece, a shorter one that is kept as a
correction.  A shorter phrase's count is the flow out of it: all edges and corrections that begin with it.  Edges
that follow each other through nodes with no other way in or out carry one flow, so they are compacted into paths,
whose inner nodes need no look-up.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logflow.scratch import fresh_dir, materialize
from logflow.session import ship_package

#: Words of one language whose phrases a task counts together before it passes them on.
BLOCK_WORDS = 1 << 19
#: Rows that a task passes on at a time.
OUT_ROWS = 1 << 16
#: Text bytes whose phrases a task of the shuffle counts together, and most tasks of it.
TASK_BYTES, MOST_TASKS = 8 << 20, 50_000

#: What ends a piece; what lies between words.
PIECE_ENDS, BLANKS = b".,;:!?\n\x0b\x0c\r", b" \t"

_CLEAN = bytes.maketrans(PIECE_ENDS + b"\tABCDEFGHIJKLMNOPQRSTUVWXYZ", b"." * len(PIECE_ENDS) + b" abcdefghijklmnopqrstuvwxyz")


class Block:
    """Words of texts of one language as numbers; 0 stands between pieces."""

    def __init__(self) -> None:
        self.number: dict[bytes, int] = {b".": 0}
        self.parts: list[np.ndarray] = []
        self.size = 0

    def add(self, text: bytes) -> None:
        number = self.number
        words = text.translate(_CLEAN).replace(b".", b" . ").split(b" ")
        part = [number.setdefault(w, len(number)) for w in words if w]
        self.parts.append(np.array([*part, 0], np.int64))
        self.size += len(part) + 1

    def counted(self, longest: int) -> Iterator[tuple[pa.Array, int, pa.Array]]:
        """Phrases, their number of words, and how often they start at a word and are not part of a longer one from there."""
        x = np.concatenate([*self.parts, np.zeros(longest, np.int64)])
        words = pa.array(list(self.number), pa.binary())
        reach = np.zeros(len(x) - longest, np.int64)  # words of the piece from here on, at most ``longest``
        inside = np.ones(len(reach), bool)
        for k in range(longest):
            inside &= x[k : k + len(reach)] > 0
            reach += inside
        for k in range(longest, 0, -1):
            at = np.flatnonzero(reach == k)
            # Numbers of the phrases of 1, 2, ... words, so that they fit 64 bits whatever the number of words.
            code = x[at]
            for j in range(1, k):
                if len(words) ** (j + 1) >= 1 << 62:
                    code = np.unique(code, return_inverse=True)[1]
                code = code * len(words) + x[at + j]
            _, first, n = np.unique(code, return_index=True, return_counts=True)
            columns = [words.take(pa.array(x[at[first] + j])) for j in range(k)]
            yield (pc.binary_join_element_wise(*columns, b" ") if k > 1 else columns[0]), k, pa.array(n)


def count_phrases(documents: DataFrame, longest: int) -> DataFrame:
    """``lang, words, gram, n``: phrases of ``longest`` words, and shorter ones that end a piece, in all texts."""
    ship_package(documents.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks: dict[str, Block] = {}

        def rows(lang: str) -> Iterator[pa.RecordBatch]:
            for gram, words, n in blocks.pop(lang).counted(longest):
                size = len(gram)
                columns = [pa.repeat(lang, size), pa.repeat(pa.scalar(words, pa.int32()), size), gram.view(pa.string()), n]
                batch = pa.RecordBatch.from_arrays(columns, names=["lang", "words", "gram", "n"])
                for at in range(0, size, OUT_ROWS):
                    yield batch.slice(at, OUT_ROWS)

        for batch in batches:
            texts = batch.column("text").cast(pa.binary())
            for lang, text in zip(batch.column("lang").to_pylist(), texts, strict=True):
                block = blocks.setdefault(lang, Block())
                block.add(text.as_py())
                if block.size >= BLOCK_WORDS:
                    yield from rows(lang)
        for lang in list(blocks):
            yield from rows(lang)

    texts = documents.select(F.coalesce("lang", F.lit("und")).alias("lang"), "text").where("text IS NOT NULL")
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    tasks = max(min(-(-size // TASK_BYTES), MOST_TASKS), int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    grams = texts.mapInArrow(count, "lang string, words int, gram string, n long")
    # A phrase has at most one row from each block, and few rows of a task are equal: no second count before the shuffle.
    grams = grams.repartition(tasks, "lang", "words", "gram")
    return grams.groupBy("lang", "words", "gram").agg(F.sum("n").alias("n"))


def first_words(k: int, gram: str = "gram") -> Column:
    return F.substring_index(gram, " ", k)


def last_words(k: int, gram: str = "gram") -> Column:
    return F.substring_index(gram, " ", -k)


def compact(edges: DataFrame, unary: DataFrame, longest: int) -> DataFrame:
    """Paths ``lang, path`` (words) and ``a`` of ``edges (lang, gram, a)`` joined at the ``unary (lang, gram)`` nodes.

    Edges look back along their path twice as far in every round, so the rounds grow with the logarithm of the
    longest path.  There are no rings of unary nodes: a text has to enter one somewhere.
    """
    edges = materialize(edges.withColumn("id", F.monotonically_increasing_id()), "edges")
    into = edges.select("lang", last_words(longest - 1).alias("gram"), F.col("id").alias("back"))
    out = edges.select("lang", first_words(longest - 1).alias("gram"), "id")
    links = unary.join(into, ["lang", "gram"]).join(out, ["lang", "gram"])
    links = materialize(links.select("id", "back", F.lit(1).alias("steps"), F.lit(True).alias("moved")), "links")
    while not links.where("moved").isEmpty():
        further = links.select(F.col("id").alias("back"), F.col("back").alias("to"), F.col("steps").alias("more"))
        links = links.join(further, "back", "left").select(
            "id",
            F.coalesce("to", "back").alias("back"),
            (F.col("steps") + F.coalesce("more", F.lit(0))).alias("steps"),
            F.col("to").isNotNull().alias("moved"),
        )
        links = materialize(links, "links")
    placed = edges.join(links.drop("moved"), "id", "left")
    start = F.coalesce("back", "id").alias("start")
    step = F.struct(F.coalesce("steps", F.lit(0)).alias("at"), F.col("gram"))
    paths = placed.groupBy("lang", start).agg(F.max("a").alias("a"), F.array_sort(F.collect_list(step)).alias("steps"))
    later = F.transform(F.slice("steps", 2, F.greatest(F.size("steps") - 1, F.lit(1))), lambda s: F.substring_index(s["gram"], " ", -1))
    return paths.select("lang", F.concat(F.split(F.col("steps")[0]["gram"], " "), later).alias("path"), "a")


class PhraseGraph(NamedTuple):
    """Frequent phrases (``lang, gram, a``) by their number of words, compacted paths, and words per language.

    Phrases shorter than the longest also have ``into`` and ``out``, the largest count of a frequent phrase of one
    word more that ends or begins with them (null: none).
    """

    phrases: dict[int, DataFrame]
    paths: DataFrame
    totals: DataFrame


def phrase_graph(documents: DataFrame, longest: int = 3, least: int = 10) -> PhraseGraph:
    """The graph of phrases of up to ``longest`` words (2 or more) that occur ``least`` times or more in a language."""
    path = fresh_dir(documents.sparkSession, "phrases")
    count_phrases(documents, longest).write.option("compression", "zstd").parquet(path)
    counted = documents.sparkSession.read.schema("lang string, words int, gram string, n long").parquet(path)
    totals = materialize(counted.groupBy("lang").agg(F.sum("n").alias("n")), "totals")
    edges = counted.where(F.col("words") == longest).select("lang", "gram", F.col("n").alias("a")).where(F.col("a") >= least)
    phrases = {longest: materialize(edges, "edges")}
    for k in range(longest - 1, 0, -1):
        flow = counted.where(F.col("words") >= k).groupBy("lang", first_words(k).alias("gram")).agg(F.sum("n").alias("a"))
        longer = phrases[k + 1]
        none = F.lit(None).cast("long")
        ends = longer.select("lang", last_words(k).alias("gram"), F.col("a").alias("into"), none.alias("out"))
        begins = longer.select("lang", first_words(k).alias("gram"), none.alias("into"), F.col("a").alias("out"))
        near = ends.unionByName(begins).groupBy("lang", "gram").agg(F.max("into").alias("into"), F.max("out").alias("out"))
        phrases[k] = materialize(flow.where(F.col("a") >= least).join(near, ["lang", "gram"], "left"), "nodes")
    # All of a unary node's occurrences come from one edge and go on to one edge.
    unary = phrases[longest - 1].where("into = a AND out = a").select("lang", "gram")
    return PhraseGraph(phrases, materialize(compact(phrases[longest], unary, longest), "paths"), totals)


def with_count(rows: DataFrame, phrases: DataFrame, gram: Column, count: str) -> DataFrame:
    """Adds the count of the frequent phrase that ``gram`` names."""
    known = phrases.select("lang", F.col("gram").alias("_gram"), F.col("a").alias(count))
    return rows.withColumn("_gram", gram).join(known, ["lang", "_gram"]).drop("_gram")


def edge_counts(graph: PhraseGraph, longest: int) -> DataFrame:
    """The longest phrases with the counts of their first and last words but one: path ends look them up, inner nodes have the path's."""
    nodes, ends = graph.phrases[longest - 1], F.size("path") - longest
    joined = lambda start: F.concat_ws(" ", F.slice("path", start, longest - 1))
    paths = with_count(graph.paths, nodes, joined(F.lit(1)), "before")
    paths = with_count(paths, nodes, joined(ends + 2), "after")
    paths = paths.withColumn("at", F.explode(F.sequence(F.lit(0), ends)))
    gram = F.concat_ws(" ", F.slice("path", F.col("at") + 1, longest))
    first = F.when(F.col("at") == 0, F.col("before")).otherwise(F.col("a"))
    last = F.when(F.col("at") == ends, F.col("after")).otherwise(F.col("a"))
    return paths.select("lang", gram.alias("gram"), "a", first.alias(f"l{longest - 1}"), last.alias("r1"))


def score(a: Column, left: Column, right: Column) -> Column:
    """floor(1000000 * a * a / (left * right)), exact while the product has at most 38 digits."""
    a, left, right = (c.cast("decimal(38,0)") for c in (a, left, right))
    return F.call_function("div", a * a * F.lit(1_000_000).cast("decimal(38,0)"), left * right).cast("long")


def collocations(graph: PhraseGraph, shortest: int = 2, contained: int = 50) -> DataFrame:
    """``lang, phrase, a, l, r, score`` of all frequent phrases of ``shortest`` words or more that no longer one stands for.

    A phrase cut after its first words gives the counts ``l`` and ``r`` of its parts; the cut with the lowest score
    counts, of equal ones the first.  A phrase goes if a longer frequent one contains it and occurs at least
    ``contained`` percent as often; then one of just one word more does, too.
    """
    longest = max(graph.phrases)
    found = []
    for k in range(shortest, longest + 1):
        if k == longest:
            rows = edge_counts(graph, longest)
        else:
            most = F.greatest(F.coalesce("into", F.lit(0)), F.coalesce("out", F.lit(0)))
            rows = graph.phrases[k].where(100 * most < contained * F.col("a")).select("lang", "gram", "a")
        cuts = []
        for cut in range(1, k):
            for count, words, gram in ((f"l{cut}", cut, first_words(cut)), (f"r{cut}", k - cut, last_words(k - cut))):
                if count not in rows.columns:
                    rows = with_count(rows, graph.phrases[words], gram, count)
            left, right = F.col(f"l{cut}"), F.col(f"r{cut}")
            cuts.append(F.struct(score(F.col("a"), left, right).alias("score"), F.lit(cut).alias("cut"), left.alias("l"), right.alias("r")))
        rows = rows.withColumn("best", F.array_min(F.array(*cuts)))
        found.append(rows.select("lang", F.col("gram").alias("phrase"), "a", "best.l", "best.r", "best.score"))
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def strongest_collocations(documents: DataFrame, longest: int = 3, least: int = 10, contained: int = 50, most: int = 2000) -> DataFrame:
    """Each language's first ``most`` collocations: ``lang, rank, phrase, a, l, r, n, score``.

    A-Z become lower case; PIECE_ENDS end a piece and BLANKS part its words, which are otherwise unchanged.  ``n`` is
    the number of words of the language, a null language is ``und``.  Order: score, then count, both descending, then
    phrase by its UTF-8 bytes.  Null and empty texts have no words; repeated rows count as often as they occur; a
    table without words gives no rows; other columns are ignored.
    """
    graph = phrase_graph(documents, longest, least)
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    first = collocations(graph, contained=contained).withColumn("rank", F.row_number().over(order).cast("long"))
    first = first.where(F.col("rank") <= most).join(graph.totals, "lang")
    return first.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
