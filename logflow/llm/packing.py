"""Packing documents into sequences by multiway differencing (Karmarkar-Karp)."""

from __future__ import annotations

import heapq
import json
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logflow.scratch import materialize
from logflow.session import ship_package

#: Fixed value: the pattern that splits text before merges.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

#: Fixed value: white space of the pattern above.
WHITE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
#: Longer runs of white space are encoded apart: the pattern looks ahead once for every character of a run.
LONG_RUN = 10_000

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, uid long"


def byte_level_encoder(vocabulary: str):
    """The byte-level BPE of a ``tokenizers`` file as a function from text to ids.

    ``tiktoken`` merges by the same ranks several times as fast; tests compare the ids of both.
    """
    import tiktoken

    with open(vocabulary, encoding="utf-8") as file:
        data = json.load(file)
    # Printable Latin-1 characters stand for their own byte, the others for 256 and up, in order.
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte_of = {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(sorted({*range(256)} - {*own}))}
    special = {word["content"]: word["id"] for word in data["added_tokens"]}
    vocab = data["model"]["vocab"].items()
    ranks = {bytes(byte_of[c] for c in word): i for word, i in vocab if word not in special}
    bpe = tiktoken.Encoding("byte_level", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens=special)
    one_piece = tiktoken.Encoding("one_piece", pat_str=r"[\s\S]+", mergeable_ranks=ranks, special_tokens={})
    long_run = re.compile(f"[{WHITE}]{{{LONG_RUN},}}")

    def encode(text: str) -> np.ndarray:
        out, at = [], 0
        for run in long_run.finditer(text):
            # The pattern gives a run to one piece, but for its last character where a word follows.
            end = run.end() - (run.end() < len(text) and not text.startswith(tuple(special), run.end()))
            out.append(bpe.encode_to_numpy(text[at : run.start()], allowed_special="all"))
            out.append(one_piece.encode_to_numpy(text[run.start() : end]))
            at = end
        out.append(bpe.encode_to_numpy(text[at:], allowed_special="all"))
        return np.concatenate(out) if len(out) > 1 else out[0]

    return encode


def cuts(length: int, capacity: int, parts: int) -> list[int]:
    """Lengths of a document's pieces: whole windows, then the rest halved until there are ``parts`` pieces.

    Differencing evens out large pieces with small ones, so it needs pieces of all sizes.
    """
    whole, rest = divmod(length, capacity)
    out = [capacity] * whole
    while rest:
        out.append(rest if len(out) - whole == parts - 1 else rest - rest // 2)
        rest -= out[-1]
    return out


def token_pieces(
    documents: DataFrame, vocabulary: str, end_id: int = 0, capacity: int = 1024, parts: int = 5, keep_ids: bool = False
) -> DataFrame:
    """Pieces of each document's ids and a final ``end_id``: PIECES' columns, and ``ids`` with ``keep_ids``.

    ``vocabulary`` is a path that every executor has.  A null text is an empty one: its only id is the final one.
    ``uid`` numbers the pieces of a stored table; repeated rows give pieces of their own.
    """
    ship_package(documents.sparkSession)
    names = [c.split()[0] for c in PIECES.split(", ")] + ["ids"] * keep_ids

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, uid, rows = byte_level_encoder(vocabulary), TaskContext.get().partitionId() << 40, []

        def out() -> pa.RecordBatch:
            columns = [list(c) for c in zip(*rows, strict=True)] if rows else [[] for _ in names]
            types = [pa.int64()] * 6 + [pa.list_(pa.int32())] * keep_ids
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)

        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                ids = np.append(encode(text.as_py() or ""), end_id).astype("<u4")
                at = 0
                for n in cuts(len(ids), capacity, parts):
                    part = ids[at : at + n]
                    row = (doc_id, at, n, zlib.crc32(part.tobytes()), len(ids), uid)
                    rows.append(row + ((part.astype(np.int32),) if keep_ids else ()))
                    at, uid = at + n, uid + 1
                if len(rows) >= 4096:
                    yield out()
                    rows.clear()
        yield out()

    schema = PIECES + ", ids array<int>" * keep_ids
    return documents.select("doc_id", "text").mapInArrow(split, schema)


def difference(lengths: np.ndarray, windows: int) -> np.ndarray:
    """Karmarkar-Karp: the window of each item, with near-equal sums of windows.

    Starting from one partial partition for each item, the two with the largest spread are merged, the
    fullest windows of one with the emptiest of the other, until one partition is left.  Merges keep only
    sums; going back over them then tells every item its window.
    """
    heap = []
    for i, n in enumerate(lengths.tolist()):
        sums = np.zeros(windows, np.int64)
        sums[-1] = n
        heap.append((-n, i, sums))
    heapq.heapify(heap)
    merges = []
    for serial in range(len(lengths), 2 * len(lengths) - 1):
        (_, one, sums), (_, other, more) = heapq.heappop(heap), heapq.heappop(heap)
        sums = sums + more[::-1]
        order = np.argsort(sums, kind="stable")
        sums = sums[order] - sums[order[0]]  # only differences matter
        merges.append((one, other, order))
        heapq.heappush(heap, (-int(sums[-1]), serial, sums))
    # Which window each place of a partial partition ends in, from the last merge to the items.
    place: dict[int, np.ndarray] = {2 * len(lengths) - 2: np.arange(windows)}
    for serial in range(2 * len(lengths) - 2, len(lengths) - 1, -1):
        one, other, order = merges.pop()
        before = np.empty(windows, np.int64)
        before[order] = place.pop(serial)
        place[one], place[other] = before, before[::-1]
    return np.array([place[i][-1] for i in range(len(lengths))], np.int64)


def windows_of(lengths: np.ndarray, capacity: int) -> np.ndarray:
    """The window of each item: as few windows as hold all items, more whenever one is too full."""
    total = int(lengths.sum())
    windows = max(1, -(-total // capacity))
    while True:
        window = difference(lengths, windows)
        excess = int(np.bincount(window, lengths, windows).max(initial=0)) - capacity
        if excess <= 0:
            return window
        windows = max(windows + 1, -(-total // max(1, total // windows - excess)) if excess < total // windows else 0)


def pack(pieces: DataFrame, capacity: int = 1024, group_rows: int = 2048) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to stored pieces of at most ``capacity`` ids.

    A piece of full capacity is a sequence of its own.  The others are dealt at random, by uid, into groups of
    about ``group_rows`` pieces, and each group is packed by differencing; its last, partly filled window is the
    padding, so larger groups pad less.  No group depends on a document, so long documents are no hot spot.
    """
    ship_package(pieces.sparkSession)
    groups = -(-max(1, pieces.where(F.col("length") < capacity).count()) // group_rows)
    dealt = F.pmod(F.xxhash64("uid"), F.lit(groups)).alias("dealt")
    columns = pieces.columns
    schema = pieces.withColumns({"sequence_id": F.lit(0).cast("long"), "offset": F.lit(0).cast("long")}).schema

    def place(group: pa.Table) -> pa.Table:
        group = group.take(pa.compute.sort_indices(group["uid"]))
        lengths = group["length"].to_numpy()
        window = windows_of(lengths, capacity)
        order = np.argsort(window, kind="stable")
        sums = np.cumsum(lengths[order]) - lengths[order]
        first = np.searchsorted(window[order], window[order])
        offset = np.empty(len(lengths), np.int64)
        offset[order] = sums - sums[first]
        # The least uid of a window names it: unique, as each piece is in one window.
        name = group["uid"].to_numpy()[order][first]
        sequence = np.empty(len(lengths), np.int64)
        sequence[order] = name
        group = group.select(columns)
        return group.append_column("sequence_id", pa.array(sequence)).append_column("offset", pa.array(offset))

    full = pieces.where(F.col("length") >= capacity)
    full = full.withColumns({"sequence_id": F.col("uid"), "offset": F.lit(0).cast("long")})
    rest = pieces.where(F.col("length") < capacity).withColumn("dealt", dealt).groupBy("dealt")
    return full.unionByName(rest.applyInArrow(place, schema))


def pack_documents(documents: DataFrame, vocabulary: str, capacity: int = 1024) -> DataFrame:
    """Documents as packed pieces: PIECES' columns and ``ids`` with ``sequence_id`` and ``offset``.

    Every id lies in exactly one piece, and pieces fill a sequence from offset 0 without gaps: a sequence is the ids
    of its pieces by offset.  An empty table gives no pieces; other columns are ignored.
    """
    pieces = materialize(token_pieces(documents, vocabulary, capacity=capacity, keep_ids=True), "pieces")
    return pack(pieces, capacity).drop("uid")
