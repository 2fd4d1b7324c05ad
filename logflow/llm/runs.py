"""Periodic runs of words: the branching-tandem test on an enhanced suffix array.

Texts are numbered word by word and sorted by suffix, many texts at a time (suffixes of different texts never meet).
An interval of the suffix array whose suffixes share exactly their first ``d`` words holds a branching square
``ww`` with ``|w| = d`` at ``i`` just if ``i`` and ``i + d`` lie in different children of it.  So the members of all
children but the largest look up where ``i + d`` and ``i - d`` are sorted: O(n log n) look-ups, without a tree.
The branching square is the right end of a maximal repetition; rotating it to the left gives the whole run.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logflow.session import ship_package

#: Words whose suffixes are sorted together; a longer text is sorted alone.
BLOCK_WORDS = 1 << 18
#: Runs are at least this long and have at least this many periods.
LEAST_LENGTH, LEAST_PERIODS = 6, 4


class SuffixArray:
    """Suffixes of several texts in order, their common prefixes, and ranks by the first 1, 2, 4, ... words.

    ``words`` numbers the words of all texts, each text followed by one number of its own, which ends all matches.
    """

    def __init__(self, words: np.ndarray, text_of: np.ndarray) -> None:
        n = self.n = len(words)
        # Texts stay together, so no suffix has a neighbour of another text in its group.
        order = np.lexsort((words, text_of))
        new = np.r_[True, (words[order][1:] != words[order][:-1]) | (text_of[order][1:] != text_of[order][:-1])]
        self.levels: list[np.ndarray] = []
        self.parted = np.where(new, 0, -1)  # the level at which a suffix first differs from the one before
        rank = np.empty(n, np.int32)
        rank[order] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
        level, reach = 0, 1
        while True:
            self.levels.append(rank)
            # Places in groups of several suffixes, which are sorted by the words after the shared ones.
            open_at = np.flatnonzero(~new | np.r_[~new[1:], False])
            if not len(open_at):
                break
            suffix = order[open_at]
            head, after = rank[suffix], rank[np.minimum(suffix + reach, n - 1)]
            by = np.lexsort((after, head))
            suffix, head, after = suffix[by], head[by], after[by]
            order[open_at] = suffix
            level, reach = level + 1, reach * 2
            parts = np.r_[True, (head[1:] != head[:-1]) | (after[1:] != after[:-1])]
            now = open_at[parts & ~new[open_at]]
            new[now] = True
            self.parted[now] = level
            rank = rank.copy()
            rank[suffix] = np.maximum.accumulate(np.where(parts, open_at, 0))
        self.order, self.rank = order, rank  # suffixes by place, places by suffix
        self.common = self._common_prefixes()

    def _common_prefixes(self) -> np.ndarray:
        """Words that the suffix at each place shares with the one before."""
        common = np.zeros(self.n, np.int64)
        at = np.flatnonzero(self.parted > 0)
        if len(at):
            a, b, parted = self.order[at - 1], self.order[at], self.parted[at]
            same = np.left_shift(np.int64(1), parted.astype(np.int64) - 1)
            for level in range(len(self.levels) - 2, -1, -1):
                rank, last = self.levels[level], self.n - 1
                more = (level < parted - 1) & (rank[np.minimum(a + same, last)] == rank[np.minimum(b + same, last)])
                same += more.astype(np.int64) << level
            common[at] = same
        return common

    def backward(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many words before ``a`` and before ``b`` are the same."""
        back = np.zeros(len(a), np.int64)
        for level in range(len(self.levels) - 1, -1, -1):
            step, rank = 1 << level, self.levels[level]
            inside = np.minimum(a, b) - back >= step
            before_a, before_b = np.maximum(a - back - step, 0), np.maximum(b - back - step, 0)
            back += np.where(inside & (rank[before_a] == rank[before_b]), step, 0)
        return back


def nearest_smaller(values: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each place ``at``, the last place before and the first one after it with a smaller value (-1 and n if none)."""
    least = [values]
    while 2 << (len(least) - 1) <= len(values):
        half = 1 << (len(least) - 1)
        least.append(np.minimum(least[-1][:-half], least[-1][half:]))
    own, before, after = values[at], at.copy(), at + 1
    for level in range(len(least) - 1, -1, -1):
        step, table = 1 << level, least[level]
        fits = before - step >= 0
        before -= np.where(fits & (table[np.where(fits, before - step, 0)] >= own), step, 0)
        fits = after + step <= len(values)
        after += np.where(fits & (table[np.where(fits, after, 0)] >= own), step, 0)
    return before - 1, after


def branching_squares(sa: SuffixArray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(i, d)`` of every branching square: ``places`` are whole texts' places in suffix order, in order."""
    common = sa.common[places]
    at = np.flatnonzero(common > 0)
    if not len(at):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    before, after = nearest_smaller(common, at)
    # An interval starts at the place before its first common prefix, which is its nearest smaller one.
    by = np.lexsort((at, after, before))
    at, before, after = at[by], before[by], after[by]
    first = np.r_[True, (before[1:] != before[:-1]) | (after[1:] != after[:-1])]
    interval = np.cumsum(first) - 1
    left, right, depth = before[first], after[first], common[at[first]]
    # Children lie between the interval's start, its places of least common prefix, and its end.
    child_start = np.insert(at, np.flatnonzero(first), left)
    child_of = np.insert(interval, np.flatnonzero(first), interval[first])
    last = np.r_[child_of[1:] != child_of[:-1], True]
    child_end = np.where(last, right[child_of], np.r_[child_start[1:], 0])
    size = child_end - child_start
    largest_first = np.lexsort((-size, child_of))
    small = np.ones(len(size), bool)
    small[largest_first[np.r_[True, child_of[largest_first][1:] != child_of[largest_first][:-1]]]] = False
    child_start, child_of, size = child_start[small], child_of[small], size[small]
    member = np.repeat(child_start - np.r_[0, np.cumsum(size)[:-1]], size) + np.arange(size.sum())
    start, end, of = np.repeat(child_start, size), np.repeat(child_start + size, size), np.repeat(child_of, size)
    d, lower, upper = depth[of], left[of], right[of]
    suffix = sa.order[places[member]]
    place_of = np.full(sa.n, -1, np.int64)  # by suffix, its place among ``places``
    place_of[sa.order[places]] = np.arange(len(places))
    squares = []
    for other, i in ((suffix + d, suffix), (suffix - d, suffix - d)):
        there = (other >= 0) & (other < sa.n)
        place = place_of[np.where(there, other, 0)]
        hit = there & (place >= lower) & (place < upper) & ((place < start) | (place >= end))
        squares.append(np.stack([i[hit], d[hit]]))
    i, d = np.unique(np.concatenate(squares, 1), axis=1)
    return i, d


def runs_of(texts: list[list[bytes]]) -> list[np.ndarray]:
    """For each text its runs ``(start, length, period)``, by start, then period."""
    number: dict[bytes, int] = {}
    lengths = np.array([len(t) for t in texts], np.int64)
    text_of = np.repeat(np.arange(len(texts)), lengths + 1)
    begin = np.cumsum(lengths + 1) - lengths - 1
    words = np.empty(len(text_of), np.int64)
    for i, text in enumerate(texts):
        words[begin[i] : begin[i] + lengths[i]] = [number.setdefault(w, len(number)) for w in text]
    words[begin + lengths] = -1  # once in each text
    sa = SuffixArray(words, text_of)
    # A run of period q and length m makes two suffixes of its text share m - q words: others have no run.
    least = min(max(LEAST_LENGTH, LEAST_PERIODS * q) - q for q in range(1, LEAST_LENGTH + 1))
    longest = np.zeros(len(texts), np.int64)
    place_text = text_of[sa.order]
    np.maximum.at(longest, place_text, sa.common)
    i, d = branching_squares(sa, np.flatnonzero(longest[place_text] >= least))
    back = sa.backward(i, i + d)
    start, length = i - back, 2 * d + back
    keep = (length >= LEAST_LENGTH) & (length >= LEAST_PERIODS * d)
    start, length, d = start[keep], length[keep], d[keep]
    # A stretch that keeps several periods has the smallest one.
    by = np.lexsort((d, length, start))
    start, length, d = start[by], length[by], d[by]
    new = np.r_[True, (start[1:] != start[:-1]) | (length[1:] != length[:-1])][: len(start)]
    start, length, d = start[new], length[new], d[new]
    by = np.lexsort((d, start))
    found = np.stack([start - begin[text_of[start]], length, d], 1)[by] if len(start) else np.zeros((0, 3), np.int64)
    cuts = np.searchsorted(text_of[start[by]] if len(start) else start, np.arange(1, len(texts)))
    return np.split(found, cuts)


def collapsed(words: list[bytes], runs: np.ndarray) -> list[bytes]:
    """The words without those that a run contains after its first period."""
    if not len(runs):
        return words
    change = np.zeros(len(words) + 1, np.int64)
    np.add.at(change, runs[:, 0] + runs[:, 2], 1)
    np.add.at(change, runs[:, 0] + runs[:, 1], -1)
    return [w for w, inside in zip(words, np.cumsum(change)[:-1].tolist(), strict=True) if not inside]


def strongest(runs: np.ndarray) -> list[int | None]:
    """Start, length, period and floor(1000 * length / period) of the run with the greatest length/period."""
    best = None
    for start, length, period in runs.tolist():  # by start, then period: the first of equal ones stays
        if best is None or length * best[2] > best[1] * period:
            best = [start, length, period]
    return [*best, 1000 * best[1] // best[2]] if best else [None] * 4


RUN_FIELDS = ["start", "length", "period"]
ADDED = "n_words long, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string"


def find_runs(documents: DataFrame, keep_runs: bool = True) -> DataFrame:
    """Adds each text's periodic runs, the strongest one, and the text with every run reduced to one period.

    Words are split at ASCII white space and unchanged.  A run is a stretch of words with smallest period q and a
    length of at least LEAST_LENGTH and LEAST_PERIODS * q that no neighbouring word extends.  ``runs`` lists them by
    start, then period; ``collapsed`` is the text without the words that some run contains after its first q words,
    joined by single spaces (null for a null text).  ``runs_sha256`` is of the lines ``start,length,period``,
    ``collapsed_sha256`` of the collapsed text (UTF-8, empty for null).  ``keep_runs=False`` leaves ``runs`` and
    ``collapsed`` out.

    Null and empty texts have no words and no runs; the strongest run is then four nulls.  Ties go to the smaller
    start, then period.  Repeated rows are answered each; an empty table gives no rows.  Input columns named like the
    results are replaced.  A task holds the words of about BLOCK_WORDS, or of one longer text, at a time.
    """
    ship_package(documents.sparkSession)
    names = [c.split()[0] for c in ADDED.split(", ")]
    documents = documents.drop(*names, "runs", "collapsed")
    packed = documents.select(F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("row"))
    more = ", runs array<struct<start: long, length: long, period: long>>, collapsed string" * keep_runs
    run_type = pa.list_(pa.struct([(c, pa.int64()) for c in RUN_FIELDS]))
    types = [pa.int64()] * 6 + [pa.string()] * 2 + [run_type, pa.string()] * keep_runs

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("row").field("text")
            at = 0
            while at < len(texts):
                block, size, first = [], 0, at
                while at < len(texts) and (size < BLOCK_WORDS or at == first):
                    block.append((texts[at].as_py() or "").encode("utf-8", "surrogatepass").split())
                    size, at = size + len(block[-1]), at + 1
                rows = [answer(words, runs) for words, runs in zip(block, runs_of(block), strict=True)]
                columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)]
                own = batch.slice(first, at - first)
                if keep_runs:
                    null = texts.slice(first, at - first).is_null()
                    columns[-1] = pa.compute.if_else(null, pa.scalar(None, pa.string()), columns[-1])
                yield pa.RecordBatch.from_arrays([own.column("row"), *columns], names=["row", *names, *["runs", "collapsed"][: 2 * keep_runs]])

    def answer(words: list[bytes], runs: np.ndarray) -> tuple:
        lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs.tolist())
        left = b" ".join(collapsed(words, runs))
        out = (len(words), len(runs), *strongest(runs), hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(left).hexdigest())
        if not keep_runs:
            return out
        return (*out, [dict(zip(RUN_FIELDS, r, strict=True)) for r in runs.tolist()], left.decode("utf-8", "surrogatepass"))

    return packed.mapInArrow(search, f"row {packed.schema['row'].dataType.simpleString()}, {ADDED}{more}").select("row.*", *names, *["runs", "collapsed"][: 2 * keep_runs])
