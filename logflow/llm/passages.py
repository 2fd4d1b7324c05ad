"""Repeated passages: every window of words that also starts in a document with a smaller id is removed.

Content decides where windows are compared: the k-word phrase with the smallest hash inside a window (its
anchor) is the same wherever the window occurs.  Neighbouring windows with one anchor form a segment, so a
document has one segment for some twenty windows, and copies of a segment are settled by one hash.  Only
segments that differ around one anchor are compared window by window, and each text of them only once.

A segment that a document holds several times is one row with all its starts.  Its first document goes to one row
for each chunk that has it, and from there to the places within the chunk, so that the places of a common segment
never meet in one task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logflow.llm.chunks import store_chunks
from logflow.llm.common import rolling, word_hashes
from logflow.scratch import materialize
from logflow.session import ship_package

#: Text bytes of the documents that one task holds at a time.
CHUNK_BYTES = 8 << 20

SEGMENTS = "anchor long, seg_a long, seg_b long, windows int, chunk long, rid long, doc_id long, starts array<int>"
WINDOWS = "win_a long, win_b long, chunk long, rid long, doc_id long, start int"


def text_words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").split()


class Anchors:
    """Hashes, anchors and segments of one text."""

    def __init__(self, words: list[bytes], window: int, phrase: int) -> None:
        n = len(words)
        self.words, self.window, self.count = words, window, max(0, n - window + 1)
        if not self.count:
            return
        self.hashes = word_hashes(words)
        at = np.arange(n - phrase + 1)
        self.grams = rolling(self.hashes, at, at + phrase)
        inside = np.lib.stride_tricks.sliding_window_view(self.grams, window - phrase + 1)
        place = np.arange(self.count) + inside.argmin(1)
        self.starts = np.flatnonzero(np.r_[True, place[1:] != place[:-1]])
        self.ends = np.r_[self.starts[1:], self.count]
        self.places = place[self.starts]

    def wide(self, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Two 64-bit hashes of each slice of words, from independent hashes of the words."""
        return rolling(self.hashes, starts, ends), rolling(word_hashes(self.words, seed=1), starts, ends)


def find_phrases(texts: list[Anchors], marked: np.ndarray, phrase: int) -> Iterator[np.ndarray]:
    """For each text, the segments whose anchor is a recurring phrase.

    The phrases that anchor marked segments of this chunk are compiled into one automaton, and every text of
    the chunk is streamed through it; a segment counts where the automaton finds its phrase, word by word.
    """
    import ahocorasick

    phrases, marked = ahocorasick.Automaton(), np.sort(marked)
    for text in texts:
        if text.count and len(marked):
            own = text.grams[text.places].view(np.int64)
            at = np.minimum(np.searchsorted(marked, own), len(marked) - 1)
            for p in text.places[marked[at] == own].tolist():
                own = b" " + b" ".join(text.words[p : p + phrase]) + b" "
                own = own.decode("utf-8", "surrogatepass")
                phrases.add_word(own, len(own))
    if len(phrases):
        phrases.make_automaton()
    for text in texts:
        if not text.count or not len(phrases):
            yield np.zeros(0, np.int64)
            continue
        line = (b" " + b" ".join(text.words) + b" ").decode("utf-8", "surrogatepass")
        first = [end - size + 1 for end, size in phrases.iter(line)]
        if not first:
            yield np.zeros(0, np.int64)
            continue
        spaces = np.flatnonzero(np.frombuffer(line.encode("utf-32-le", "surrogatepass"), np.uint32) == 32)
        found = np.zeros(len(text.words) + 1, bool)
        found[np.searchsorted(spaces, first)] = True
        yield np.flatnonzero(found[text.places])


def _longs(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def places_by_row(spans: pa.Table) -> dict[int, np.ndarray]:
    """For each rid, the start and the number of windows of each of its spans, in order."""
    counts = pc.list_value_length(spans["starts"]).to_numpy()
    rids, windows = (np.repeat(spans[c].to_numpy(), counts) for c in ("rid", "windows"))
    places = np.column_stack((pc.list_flatten(spans["starts"]).to_numpy(), windows))
    order = np.lexsort((places[:, 0], rids))
    ids, first = np.unique(rids[order], return_index=True)
    return dict(zip(ids.tolist(), np.split(places[order], first[1:]), strict=False))


def remove_repeats(documents: DataFrame, window: int = 50, phrase: int = 8) -> DataFrame:
    """Documents without the words of repeated windows, with ``n_words, n_removed, kept_sha256``.

    Words are split at ASCII white space and unchanged.  A word is removed if a window of ``window`` consecutive
    words covers it whose sequence also starts in a document with a smaller doc_id; windows are judged on the
    input.  A text that loses words becomes its other words, joined by single spaces; other texts, null ones
    included, stay as they are.  ``kept_sha256`` is of the kept words joined by single spaces (UTF-8).

    Null and empty texts and texts of fewer words have no windows.  Repeats within one document, or between rows
    of one doc_id, stay.  Rows with a null doc_id stay whole and make nothing else go.  Other columns are kept;
    input columns with the names of the three results are replaced.
    """
    spark = documents.sparkSession
    ship_package(spark)
    results = ["n_words", "n_removed", "kept_sha256"]
    documents = documents.drop(*results)
    texts = store_chunks(documents, CHUNK_BYTES)
    slim = texts.select("chunk", "rid", F.col("row.doc_id").cast("long").alias("doc_id"), F.col("row.text").alias("text"))

    def anchors_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part, anchors, own = batch.slice(at, 512), [], []
                for i, text in enumerate(part.column("text")):
                    a = Anchors(text_words(text.as_py()), window, phrase)
                    if a.count:
                        anchors.append(np.unique(a.grams[a.places]))
                        own.append(np.full(len(anchors[-1]), i))
                rows = pa.array(np.concatenate(own)) if own else pa.array([], pa.int64())
                values = _longs(np.concatenate(anchors)) if own else pa.array([], pa.int64())
                ids = [part.column(c).take(rows) for c in ("chunk", "doc_id")]
                yield pa.RecordBatch.from_arrays([values, *ids], names=["anchor", "chunk", "doc_id"])

    usable = slim.where("doc_id IS NOT NULL")
    anchors = usable.mapInArrow(anchors_of, "anchor long, chunk long, doc_id long")
    anchors = materialize(anchors, "anchors")
    several = anchors.groupBy("anchor").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"))
    marks = anchors.join(several.where("low < high").select("anchor"), "anchor").select("chunk", "anchor").distinct()

    def segments_of(docs: pa.Table, marked: pa.Table) -> pa.Table:
        texts = [Anchors(text_words(t.as_py()), window, phrase) for t in docs["text"]]
        wanted, out, rows = marked["anchor"].to_numpy(), [], []
        for i, (a, keep) in enumerate(zip(texts, find_phrases(texts, wanted, phrase), strict=True)):
            if len(keep):
                s, e = a.starts[keep], a.ends[keep]
                seg_a, seg_b = a.wide(s, e - 1 + window)
                out.append((a.grams[a.places[keep]], seg_a, seg_b, s, e - s))
                rows.append(np.full(len(keep), i))
        if not out:
            return segments_schema.empty_table()
        anchor, seg_a, seg_b, start, windows = (np.concatenate(c) for c in zip(*out, strict=True))
        own = [docs[c].take(pa.array(np.concatenate(rows))) for c in ("chunk", "rid", "doc_id")]
        start, windows = (pa.array(c.astype(np.int32)) for c in (start, windows))
        keys = segments_schema.names[:-1]
        places = pa.table([*map(_longs, (anchor, seg_a, seg_b)), windows, *own, start], names=[*keys, "start"])
        places = places.group_by(keys, use_threads=False).aggregate([("start", "list")])
        return places.select([*keys, "start_list"]).rename_columns(segments_schema.names)

    segments_schema = pa.schema(
        [(c, pa.int64()) for c in ("anchor", "seg_a", "seg_b")]
        + [("windows", pa.int32()), ("chunk", pa.int64()), ("rid", pa.int64()), ("doc_id", pa.int64())]
        + [("starts", pa.list_(pa.int32()))]
    )
    segments = usable.groupBy("chunk").cogroup(marks.groupBy("chunk")).applyInArrow(segments_of, SEGMENTS)
    segments = materialize(segments, "segments")

    distinct = segments.groupBy("seg_a", "seg_b").agg(F.min("doc_id").alias("first"), F.first("anchor").alias("of"))
    several = distinct.groupBy("of").agg(F.count("*").alias("n")).where("n > 1").select(F.col("of").alias("anchor"))
    in_chunks = segments.select("chunk", "seg_a", "seg_b").distinct()
    firsts = in_chunks.join(distinct.drop("of"), ["seg_a", "seg_b"])
    judged = segments.join(firsts, ["chunk", "seg_a", "seg_b"])
    judged = judged.select("anchor", "chunk", "rid", "doc_id", "starts", "windows", "first")
    judged = materialize(judged, "judged")
    whole = judged.where("first < doc_id").select("chunk", "rid", "starts", "windows")
    open_segments = judged.where("first = doc_id").join(several, "anchor").select("chunk", "rid", "starts", "windows")

    def windows_in(docs: pa.Table, segments: pa.Table) -> pa.Table:
        by_row, out, rows = places_by_row(segments), [], []
        for i, (rid, text) in enumerate(zip(docs["rid"].to_pylist(), docs["text"], strict=True)):
            if rid in by_row:
                a = Anchors(text_words(text.as_py()), window, phrase)
                at = np.concatenate([np.arange(s, s + n) for s, n in by_row[rid].tolist()])
                out.append((*a.wide(at, at + window), at))
                rows.append(np.full(len(at), i))
        if not out:
            return windows_schema.empty_table()
        win_a, win_b, start = (np.concatenate(c) for c in zip(*out, strict=True))
        own = [docs[c].take(pa.array(np.concatenate(rows))) for c in ("chunk", "rid", "doc_id")]
        return pa.table([_longs(win_a), _longs(win_b), *own, pa.array(start.astype(np.int32))], schema=windows_schema)

    windows_schema = pa.schema(
        [("win_a", pa.int64()), ("win_b", pa.int64()), ("chunk", pa.int64())]
        + [("rid", pa.int64()), ("doc_id", pa.int64()), ("start", pa.int32())]
    )
    singles = usable.groupBy("chunk").cogroup(open_segments.groupBy("chunk")).applyInArrow(windows_in, WINDOWS)
    singles = materialize(singles, "windows")
    low = singles.groupBy("win_a", "win_b").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
    again = singles.join(low.where("first < last"), ["win_a", "win_b"]).where("first < doc_id")
    again = again.select("chunk", "rid", F.array("start").alias("starts"), F.lit(1).alias("windows"))

    schema = T.StructType(
        [*documents.schema, T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType())]
        + [T.StructField("kept_sha256", T.StringType())]
    )
    columns = documents.columns

    def kept(docs: pa.Table, spans: pa.Table) -> pa.Table:
        by_row, rows = places_by_row(spans), pa.Table.from_struct_array(docs["row"])
        new, sizes, removed, digests = [], [], [], []
        for rid, text in zip(docs["rid"].to_pylist(), rows["text"], strict=True):
            text = text.as_py()
            words = text_words(text)
            sizes.append(len(words))
            if rid in by_row:
                change = np.zeros(len(words) + 1, np.int64)
                starts, windows = by_row[rid].T
                np.add.at(change, starts, 1)
                np.add.at(change, starts + windows - 1 + window, -1)
                stays = np.cumsum(change)[:-1] == 0
                words = [w for w, stay in zip(words, stays.tolist(), strict=True) if stay]
                text = b" ".join(words).decode("utf-8", "surrogatepass")
            new.append(text)
            removed.append(sizes[-1] - len(words))
            digests.append(hashlib.sha256(b" ".join(words)).hexdigest())
        rows = rows.set_column(columns.index("text"), "text", pa.array(new, rows.schema.field("text").type))
        rows = rows.append_column("n_words", pa.array(sizes, pa.int64()))
        return rows.append_column("n_removed", pa.array(removed, pa.int64())).append_column("kept_sha256", pa.array(digests))

    spans = whole.unionByName(again)
    return texts.groupBy("chunk").cogroup(spans.groupBy("chunk")).applyInArrow(kept, schema)
