"""Exact top-k search by block-at-a-time pruning."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logflow.llm.common import finite_vector, matrix, same_width
from logflow.llm.grid import search_grid, vectors

SCHEMA = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])


def document_order(v: np.ndarray, block_rows: int) -> list[np.ndarray]:
    """Document ranges of at most ``block_rows`` rows: cut in halves along the component that varies most."""
    done, todo = [], [np.arange(len(v))]
    while todo:
        rows = todo.pop()
        if len(rows) <= block_rows:
            done.append(rows)
            continue
        part = v[rows]
        rows = rows[np.argsort(part[:, part.var(0).argmax()], kind="stable")]
        todo += [rows[len(rows) // 2 :], rows[: len(rows) // 2]]
    return done


def whole_product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact products of integral matrices: doubles where all sums fit their 53 bits, else Python's integers."""
    peak = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * a.shape[1]
    if peak < 2**53:
        return (a @ b.T).astype(np.int64)
    wide = np.vectorize(int, otypes=[object])
    exact = wide(a) @ wide(b).T
    return np.clip(exact, -(2**63), 2**63 - 1).astype(np.int64)


def search_shard(docs: pa.Table, queries: pa.Table, k: int, scale: float, block_rows: int) -> pa.Table:
    """The k best documents of this shard for each query of this block."""
    if not docs.num_rows or not queries.num_rows:
        return SCHEMA.empty_table()
    ids, asked = docs["vec_id"].to_numpy(), queries["vec_id"].to_numpy()
    v, q = (np.floor(m * scale) for m in same_width(matrix(docs["v"]), matrix(queries["v"])))
    ranges = document_order(v, block_rows)
    order = np.concatenate(ranges)
    v, ids = v[order], ids[order]
    stops = np.cumsum([len(r) for r in ranges])
    starts = stops - [len(r) for r in ranges]
    high, low = np.maximum.reduceat(v, starts), np.minimum.reduceat(v, starts)
    first_id = np.minimum.reduceat(ids, starts)
    # A term's maximum over a block, for either sign of the query's weight.
    bounds = whole_product(np.maximum(q, 0), high) + whole_product(np.minimum(q, 0), low)
    out = []
    for i, own in enumerate(asked):
        found, scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for b in np.argsort(-bounds[i], kind="stable"):
            if len(found) == k:
                if bounds[i, b] < scores[-1]:
                    break
                if bounds[i, b] == scores[-1] and first_id[b] > found[-1]:
                    continue
            rows = slice(starts[b], stops[b])
            new, value = ids[rows], whole_product(v[rows], q[i : i + 1])[:, 0]
            if (new == own).any():
                new, value = new[new != own], value[new != own]
            found, scores = np.concatenate([found, new]), np.concatenate([scores, value])
            best = np.lexsort((found, -scores))[:k]
            found, scores = found[best], scores[best]
        out.append((np.full(len(found), own), found, scores))
    return pa.table([pa.array(np.concatenate(c).astype(np.int64)) for c in zip(*out, strict=True)], schema=SCHEMA)


def top_k(
    embeddings: DataFrame,
    k: int = 5,
    every: int = 50,
    scale: float = 256.0,
    shard_rows: int = 4096,
    query_rows: int = 4096,
    block_rows: int = 32,
) -> DataFrame:
    """The ``k`` highest integer inner products of every query over all other rows of ``embeddings``.

    Components become ``floor(scale * x)``.  Queries are the rows whose vec_id is divisible by ``every``.
    Each shard orders its document ranges by the sum over terms of the range's best contribution and scores
    ranges, through their own rows, until that bound falls below the k-th score.  Results are exact; a shard's
    bound only decides how much it scores.

    Vectors that are null or hold null or non-finite components, and rows without a vec_id, take no part.
    Vectors shorter than others count as padded with zeros.  Rows with the query's own id are no candidates;
    other repeated rows all are.  Scores beyond a long are set to its limits.  Ties go to the smaller vec_id.
    """

    def search(docs: pa.Table, queries: pa.Table) -> pa.Table:
        return search_shard(docs, queries, k, scale, block_rows)

    rows = vectors(embeddings, finite_vector)
    return search_grid(rows, rows.where(F.col("vec_id") % every == 0), search, k, "long", shard_rows, query_rows)
