"""Documents in shards of near-equal bytes: a histogram sort.

Every row has a key: hashes of its text, of its doc_id and of its place in the input, in this order, so equal texts
are neighbours and a group of copies of any size can still be cut.  The driver proposes key boundaries, one
distributed pass counts the exact bytes between them, and only the intervals in which a shard has to end are divided
again, until every boundary is near enough to its target.  Then all rows move once.
"""

from __future__ import annotations

from bisect import bisect_right
from itertools import accumulate
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logflow.scratch import materialize

#: Bytes that every row counts beside its text.
ROW_BYTES = 16
#: Keys are three numbers below this.
KEY_LIMIT = 1 << 62

Key = tuple[int, int, int]
LEVELS = ["k0", "k1", "k2"]


def size_of(text: str = "text") -> Column:
    """UTF-8 bytes of a text, none for null, and ROW_BYTES."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + ROW_BYTES).cast("long")


def key_columns() -> list[Column]:
    """Hashes of text, doc_id and place; the place only parts rows that are equal in both."""
    parts = [F.col("text"), F.col("doc_id"), F.monotonically_increasing_id()]
    return [F.shiftrightunsigned(F.xxhash64(p), 2).alias(c) for p, c in zip(parts, LEVELS, strict=True)]


def longs(values: list[int]) -> Column:
    """A constant array, folded once for the whole plan."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast("array<bigint>")


def at_or_below(starts: list[Key]) -> Column:
    """How many of the sorted ``starts`` are not above the row's key, by binary search."""
    columns = [longs([s[i] for s in starts]) for i in range(3)]
    steps = [1 << i for i in range(len(starts).bit_length() - 1, -1, -1)]

    def next_place(place: Column, step: Column) -> Column:
        a, b, c = (F.get(values, (place + step - 1).cast("int")) for values in columns)
        k0, k1, k2 = map(F.col, LEVELS)
        below = (a < k0) | ((a == k0) & ((b < k1) | ((b == k1) & (c <= k2))))
        return F.when((place + step <= len(starts)) & below, place + step).otherwise(place)

    return F.aggregate(longs(steps), F.lit(0).cast("long"), next_place)


class Interval(NamedTuple):
    """Keys from ``start`` to the next interval; ``low`` and ``high`` bound each part of the keys in it."""

    start: Key
    low: Key
    high: Key
    size: int

    @property
    def level(self) -> int:
        """The first part in which its keys differ; 3 for a single key."""
        return next((i for i in range(3) if self.low[i] != self.high[i]), 3)


def divide(keys: DataFrame, intervals: list[Interval], probes: int) -> list[list[Interval]]:
    """Cut each interval at ``probes`` evenly spaced keys and count the exact bytes of its parts; empty ones are left out."""
    levels = [i.level for i in intervals]
    lows = [i.low[n] for i, n in zip(intervals, levels, strict=True)]
    widths = [(i.high[n] - i.low[n]) // probes + 1 for i, n in zip(intervals, levels, strict=True)]
    inside = keys.withColumn("at", (at_or_below([i.start for i in intervals]) - 1).cast("int")).where("at >= 0")
    # Keys behind an interval and before the next one of the list are beyond its highest ones.
    for n, c in enumerate(LEVELS):
        ends = [longs([bound[n] for bound in bounds]) for bounds in ([i.low for i in intervals], [i.high for i in intervals])]
        inside = inside.where(F.col(c).between(*(F.get(end, F.col("at")) for end in ends)))
    level, low, width = (F.get(longs(values), F.col("at")) for values in (levels, lows, widths))
    part = F.when(level == 0, F.col("k0")).when(level == 1, F.col("k1")).otherwise(F.col("k2"))
    inside = inside.withColumns({"offset": part - low, "width": width}).withColumn("part", F.expr("offset div width"))
    bounds = [of(c).alias(f"{name}_{c}") for name, of in (("low", F.min), ("high", F.max)) for c in LEVELS]
    counted = inside.groupBy("at", "part").agg(F.sum("size").alias("size"), *bounds)
    out: list[list[Interval]] = [[] for _ in intervals]
    for row in sorted(counted.collect(), key=lambda r: (r["at"], r["part"])):
        at, n = row["at"], levels[row["at"]]
        start = intervals[at].low[:n] + (lows[at] + row["part"] * widths[at],) + (0,) * (2 - n)
        low_key, high_key = (tuple(row[f"{name}_{c}"] for c in LEVELS) for name in ("low", "high"))
        out[at].append(Interval(start, low_key, high_key, row["size"]))
    return out


def splitters(keys: DataFrame, targets: list[float], slack: list[float], first_probes: int, probes: int) -> list[Key]:
    """The key at which each of the ascending ``targets`` (bytes below) is met within its ``slack``.

    A target inside the bytes of a single key, as within one long text, gets the nearer end of that key.  At most
    ``first_probes`` counts, later ``probes`` or two for each target, come to the driver in a round.
    """
    everything = Interval((0, 0, 0), (0, 0, 0), (KEY_LIMIT - 1,) * 3, 0)
    intervals = divide(keys, [everything], first_probes)[0]
    while True:
        below = [0, *accumulate(i.size for i in intervals)]
        chosen: list[Key] = []
        active: set[int] = set()
        for target, near in zip(targets, slack, strict=True):
            at = min(bisect_right(below, target), len(intervals)) - 1
            before, after = target - below[at], below[at + 1] - target
            if min(before, after) > near and intervals[at].level < 3:
                active.add(at)
            end = intervals[at + 1].start if at + 1 < len(intervals) else (KEY_LIMIT, 0, 0)
            chosen.append(intervals[at].start if before <= after else end)
        if not active:
            return chosen
        open_ones = sorted(active)
        parts = divide(keys, [intervals[i] for i in open_ones], max(2, probes // len(open_ones)))
        refined = dict(zip(open_ones, parts, strict=True))
        intervals = [part for i, own in enumerate(intervals) for part in refined.get(i, [own])]


def shard_documents(
    documents: DataFrame,
    shards: int = 40,
    tolerance: float = 0.001,
    range_bytes: int = 128 << 20,
    most_ranges: int = 10_000,
    first_probes: int = 4096,
    probes: int = 16_384,
) -> DataFrame:
    """All columns of ``documents`` with ``size``, ``law`` ("bytes"), ``shard`` and ``slot``, its place in the shard.

    A row's size is the UTF-8 bytes of its text, none for a null one, and ROW_BYTES.  Shards end within
    ``tolerance`` of a shard's bytes of equal shares, or at the nearer end of a longer row.  Equal texts are
    neighbours: a group of them is in one shard, or in consecutive ones where a shard ends inside it.

    A task sorts about ``range_bytes`` of a shard, more only when there would be over ``most_ranges`` of them, and
    the rows are written once, where slots are read off.  Rows equal in text and doc_id (null ones included) are told
    apart by their place in the input.  With fewer rows than shards some shards are empty; an empty table gives no
    rows.  Columns of the input named like the four results are replaced.
    """
    results = ["size", "law", "shard", "slot"]
    documents = documents.drop(*results)
    keys = materialize(documents.select(*key_columns(), size_of().alias("size")), "keys")
    total = keys.agg(F.sum("size")).first()[0] or 0
    parts = max(1, min(-(-total // (shards * range_bytes)), most_ranges // shards))
    share = total / (shards * parts)
    # Only shards have to end where they should; the ranges inside them may be uneven.
    slack = [share * parts * tolerance if i % parts == 0 else share / 4 for i in range(1, shards * parts)]
    ends: list[Key] = []
    if total and slack:
        ends = splitters(keys, [share * i for i in range(1, shards * parts)], slack, max(first_probes, 4 * shards * parts), probes)
    place = at_or_below(ends).cast("int") if ends else F.lit(0)
    packed = documents.select(F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("row"), *key_columns(), size_of().alias("size"))
    ranged = packed.withColumn("range", place).repartitionById(shards * parts, "range")
    order = Window.partitionBy("range").orderBy(*LEVELS)
    ranged = ranged.withColumn("at", F.row_number().over(order).cast("long") - 1).drop(*LEVELS)
    ranged = materialize(ranged, "shards")
    rows = dict(ranged.groupBy("range").count().collect())
    first: list[int] = []
    for i in range(shards * parts):
        first.append(first[-1] + rows.get(i - 1, 0) if i % parts else 0)
    slot = F.get(longs(first), F.col("range")) + F.col("at")
    shard = F.expr(f"range div {parts}").cast("int")
    return ranged.select("row.*", "size", F.lit("bytes").alias("law"), shard.alias("shard"), slot.alias("slot"))
