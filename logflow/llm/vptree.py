"""Approximate nearest neighbours with vantage-point trees."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logflow.llm.common import finite_vector, matrix, same_width
from logflow.llm.grid import search_grid, vectors

SCHEMA = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])


class Tree:
    """A vantage-point tree over the rows of ``x``: leaves of rows, and distance bands on the way to them."""

    def __init__(self, x: np.ndarray, leaf_rows: int) -> None:
        self.vantage: list[np.ndarray] = []
        self.bands: list[tuple[int, int, float, float]] = []  # parent band, vantage point, nearest, farthest
        self.leaves: list[tuple[int, np.ndarray]] = []  # band, rows
        todo = [(-1, np.arange(len(x)))]
        while todo:
            band, rows = todo.pop()
            if len(rows) <= leaf_rows:
                self.leaves.append((band, rows))
                continue
            # The row farthest from the mean sees the others at the most different distances.
            part = x[rows]
            point = part[((part - part.mean(0)) ** 2).sum(1).argmax()]
            away = np.sqrt(((part - point) ** 2).sum(1))
            order = np.argsort(away, kind="stable")
            self.vantage.append(point)
            for half in (order[: len(order) // 2], order[len(order) // 2 :]):
                self.bands.append((band, len(self.vantage) - 1, away[half].min(), away[half].max()))
                todo.append((len(self.bands) - 1, rows[half]))

    def bounds(self, q: np.ndarray) -> np.ndarray:
        """For each query and leaf: no row of the leaf is nearer than this, by the triangle inequality."""
        below = np.zeros((len(self.bands) + 1, len(q)))  # the last one is the root's
        if self.vantage:
            points = np.stack(self.vantage)
            squares = (q**2).sum(1)[:, None] + (points**2).sum(1) - 2 * q @ points.T
            away = np.sqrt(np.maximum(squares, 0)).T
            for i, (parent, point, near, far) in enumerate(self.bands):
                below[i] = np.maximum(below[parent], np.maximum(near - away[point], away[point] - far))
        return below[[band for band, _ in self.leaves]].T


#: Candidates kept beyond the k best while scores are rounded products.
SPARE = 8
#: More than a product of two vectors can be off, as a share of the product of their lengths.
ROUNDING = 1e-9


def distinct_rows(v: np.ndarray, ids: np.ndarray, most: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """Each vector once, and the ``most`` smallest ids that have it."""
    whole = np.ascontiguousarray(v).view(np.dtype((np.void, v.dtype.itemsize * max(1, v.shape[1])))).ravel()
    _, first, of = np.unique(whole, return_index=True, return_inverse=True)
    order = np.lexsort((ids, of))
    own = np.split(ids[order], np.searchsorted(of[order], np.arange(1, len(first))))
    return v[first], [i[:most] for i in own]


def leaves_and_bounds(v: np.ndarray, q: np.ndarray, factor: float, leaf_rows: int) -> tuple[list[np.ndarray], np.ndarray]:
    """Leaves of rows, and for each query and leaf the largest product that the leaf can hold, if ``factor`` is 1."""
    lengths, asked_lengths = np.sqrt((v**2).sum(1)), np.sqrt((q**2).sum(1))
    # Rows of similar length share a tree, so that one long row does not blur the distances of all others.
    leaves, most = [], []
    for power in np.unique(np.frexp(lengths)[1]):
        own = np.flatnonzero(np.frexp(lengths)[1] == power)
        longest = lengths[own].max()
        # One more component makes all rows as long as the longest; with queries of that length, too, the nearest
        # row is the one of largest product.
        tree = Tree(np.column_stack([v[own], np.sqrt(np.maximum(longest**2 - lengths[own] ** 2, 0))]), leaf_rows)
        below = tree.bounds(np.column_stack([q * (longest / asked_lengths)[:, None], np.zeros(len(q))]))
        below = np.maximum(below - 1e-7 * longest, 0) * factor  # less what rounding can add
        most.append((longest * (1 + ROUNDING) - below**2 / (2 * longest)) * asked_lengths[:, None])
        leaves += [own[rows] for _, rows in tree.leaves]
    return leaves, np.concatenate(most, 1)


def search_shard(
    docs: pa.Table, queries: pa.Table, k: int, factor: float, leaf_rows: int, seen: list[int] | None = None
) -> pa.Table:
    """The k nearest rows found in this shard for each query of this block.

    Leaves are visited in rounds, a query's most promising ones first, each leaf by all queries that it may still
    serve at once.  ``seen`` gets the number of pairs scored and of all pairs.
    """
    if not docs.num_rows or not queries.num_rows:
        return SCHEMA.empty_table()
    asked = queries["vec_id"].to_numpy()
    v, q = same_width(matrix(docs["v"]), matrix(queries["v"]))
    v, ids = distinct_rows(v, docs["vec_id"].to_numpy(), k + 1)
    leaves, most = leaves_and_bounds(v, q, factor, leaf_rows)
    lengths, asked_lengths = ROUNDING * np.sqrt((v**2).sum(1)), np.sqrt((q**2).sum(1))
    kept = min(len(v), k + 1 + SPARE)
    scores, rows = np.full((len(q), kept), -np.inf), np.zeros((len(q), kept), np.int64)
    # The k-th hit is no worse than this, whatever the rounding: one of the k + 1 best vectors may be the query's own.
    kth = np.full(len(q), -np.inf)
    rank = np.argsort(np.argsort(-most, axis=1, kind="stable"), axis=1)
    scored, start = 0, 0
    while start < len(leaves):
        stop = max(2 * start, len(leaves) // 16 + 1)
        for leaf, own in enumerate(leaves):
            turn = (rank[:, leaf] >= start) & (rank[:, leaf] < stop) & (most[:, leaf] >= kth)
            turn = np.flatnonzero(turn)
            if not len(turn):
                continue
            scored += len(turn) * len(own)
            both = np.concatenate([scores[turn], q[turn] @ v[own].T], axis=1)
            names = np.concatenate([rows[turn], np.broadcast_to(own, (len(turn), len(own)))], axis=1)
            best = np.argpartition(-both, kept - 1, axis=1)[:, :kept]
            scores[turn], rows[turn] = np.take_along_axis(both, best, 1), np.take_along_axis(names, best, 1)
            if kept > k:
                sure = scores[turn] - lengths[rows[turn]] * asked_lengths[turn, None]
                kth[turn] = np.partition(sure, kept - k - 1, axis=1)[:, kept - k - 1]
        start = stop
    if seen is not None:
        seen += [scored, len(q) * len(v)]
    out = []
    for i, own in enumerate(asked):
        near = rows[i][scores[i] + lengths[rows[i]] * asked_lengths[i] >= kth[i]]
        if kept < len(v) and len(near) == kept:  # more ties than are kept: look at all rows
            near = np.flatnonzero(v @ q[i] + lengths * asked_lengths[i] >= kth[i])
        value = (v[near] * q[i]).sum(1)
        found = np.concatenate([ids[r] for r in near]) if len(near) else np.zeros(0, np.int64)
        value = np.repeat(value, [len(ids[r]) for r in near])
        found, value = found[found != own], value[found != own]
        best = np.lexsort((found, -value))[:k]
        out.append((np.full(len(best), own), found[best], value[best]))
    ids_out = [pa.array(np.concatenate(c).astype(np.int64)) for c in list(zip(*out, strict=True))[:2]]
    return pa.table([*ids_out, pa.array(np.concatenate([s for _, _, s in out]))], schema=SCHEMA)


def nonzero_vector(v):
    return finite_vector(v) & F.exists(v, lambda x: x != 0)


#: Factors to choose from, and the sample that decides: rows, queries, and the recall that it has to show.
FACTORS = [8.0, 6.0, 4.0, 3.0, 2.0, 1.5, 1.0]
SAMPLE_ROWS, SAMPLE_QUERIES, SAMPLE_RECALL = 4096, 64, 0.97


def tuned_factor(rows: DataFrame, k: int, leaf_rows: int) -> float:
    """The largest of FACTORS with a recall of SAMPLE_RECALL among SAMPLE_ROWS rows chosen by hash.

    Vectors with many equally important components stand a large factor, those with few lose their neighbours by it.
    """
    order = F.xxhash64("vec_id", "v")
    sample = rows.orderBy(order, "vec_id").limit(SAMPLE_ROWS).toArrow()
    if not sample.num_rows:
        return FACTORS[-1]
    asked = sample.slice(0, SAMPLE_QUERIES)
    hits = {}
    for factor in [*reversed(FACTORS)]:
        found = search_shard(sample, asked, k, factor, leaf_rows).to_pydict()
        hits[factor] = set(zip(found["query_id"], found["vec_id"], strict=True))
    right = hits[1.0]
    return next(f for f in FACTORS if len(hits[f] & right) >= SAMPLE_RECALL * len(right))


def nearest(
    embeddings: DataFrame,
    k: int = 20,
    every: int = 20,
    factor: float | None = None,
    shard_rows: int = 16_384,
    query_rows: int = 4096,
    leaf_rows: int = 32,
) -> DataFrame:
    """The ``k`` nearest rows by inner product found for every query among all other rows of ``embeddings``.

    Queries are the rows whose vec_id is divisible by ``every``.  Every row is in the tree of its shard, and every
    shard is asked.  A leaf is left out if the distance that the triangle inequality leaves it, times ``factor``,
    is more than the k-th nearest found so far: with factor 1 the search is exact, larger ones leave out more.
    Without one, a bounded sample decides (``tuned_factor``).
    Where vectors have no structure at all, distances hardly differ, and even large factors leave out little.

    Vectors that are null, zero or hold null or non-finite components, and rows without a vec_id, take no part.
    Shorter vectors count as padded with zeros.  Rows with the query's own id are no candidates; other repeated
    rows all are.  Scores are products of the original vectors in double precision, ties go to the smaller id.
    """

    rows = vectors(embeddings, nonzero_vector)
    if factor is None:
        factor = tuned_factor(rows, k, leaf_rows)

    def search(docs: pa.Table, queries: pa.Table) -> pa.Table:
        return search_shard(docs, queries, k, factor, leaf_rows)

    return search_grid(rows, rows.where(F.col("vec_id") % every == 0), search, k, "double", shard_rows, query_rows)
