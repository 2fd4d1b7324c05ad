"""What the operators of this subpackage share."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

#: A word: a run of characters other than ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def word_count(text: Column) -> Column:
    """Number of words of a text; null counts as no text."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def finite_vector(v: Column) -> Column:
    """True for arrays without null, NaN or infinite components (an empty array passes)."""
    good = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    return v.isNotNull() & F.coalesce(good, F.lit(False))


def matrix(column: pa.ChunkedArray) -> np.ndarray:
    """Rows of a list column as one float64 matrix; shorter rows are padded with zeros."""
    flat = column.combine_chunks()
    if isinstance(flat, pa.ChunkedArray):
        flat = pa.concat_arrays(flat.chunks) if flat.num_chunks else pa.array([], column.type)
    lengths = np.diff(flat.offsets.to_numpy()) if len(flat) else np.zeros(0, np.int64)
    width = int(lengths.max()) if len(lengths) else 0
    values = flat.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    if (lengths == width).all():
        return values.reshape(len(flat), width)
    out = np.zeros((len(flat), width))
    out[np.repeat(np.arange(len(flat)), lengths), np.concatenate([np.arange(n) for n in lengths])] = values
    return out


def same_width(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both matrices with as many columns, padded with zeros."""
    width = max(a.shape[1], b.shape[1])
    return tuple(np.pad(m, ((0, 0), (0, width - m.shape[1]))) for m in (a, b))


#: The multiplier of the polynomial hash (odd) and of the mixing step.
_BASE = 0x9E3779B97F4A7C15
_MIX = np.uint64(0xD6E8FEB86659FD93)


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values."""
    x = (x ^ (x >> np.uint64(32))) * _MIX
    x = (x ^ (x >> np.uint64(29))) * _MIX
    return x ^ (x >> np.uint64(32))


class Powers:
    """Powers of the hash's multiplier and of its inverse modulo 2**64, grown as needed."""

    def __init__(self) -> None:
        self.n = 0
        self.grow(1 << 12)

    def grow(self, n: int) -> None:
        if n > self.n:
            self.n = max(n, 2 * self.n)
            inverse = pow(_BASE, -1, 1 << 64)
            self.up = np.cumprod(np.full(self.n, _BASE, np.uint64))
            self.down = np.cumprod(np.full(self.n, inverse, np.uint64))


_POWERS = Powers()


def rolling(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of each slice ``values[starts:ends]`` of 64-bit values; equal slices have equal hashes."""
    _POWERS.grow(len(values) + 1)
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * _POWERS.up[: len(values)], out=sums[1:])
    return mixed((sums[ends] - sums[starts]) * _POWERS.down[starts])


def word_hashes(words: list[bytes], seed: int = 0) -> np.ndarray:
    """A 64-bit hash of each word, the same in every process; another seed gives an independent one."""
    return np.fromiter((xxh3_64_intdigest(w, seed) for w in words), np.uint64, len(words))
