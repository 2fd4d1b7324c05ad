"""Near-duplicate documents by b-bit MinHash."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logflow.llm.common import mixed, rolling, word_hashes
from logflow.llm.components import components
from logflow.scratch import materialize
from logflow.session import ship_package

#: 32 bands of four minima: two sets of similarity 0.8 share no band once in twenty million times.
BANDS, BAND_ROWS = 32, 4
HASHES = BANDS * BAND_ROWS
#: Two low bits of each minimum are kept, as two planes of bits.
BITS = 2
#: An estimate from 128 minima of a similarity s has a deviation of 0.042 at s = 0.8; six of them below are cut.
DEVIATIONS = 6

#: Most rows and shingles of a block; a bucket's blocks are compared two at a time.
BLOCK_ROWS, BLOCK_GRAMS = 2048, 1 << 20

PRINTS = "doc_id long, digest binary, n_shingles long, bands array<long>, planes array<long>"


def shingles(words: list[bytes], k: int) -> np.ndarray:
    """Distinct hashes of ``k`` consecutive words; of fewer words, one hash of all; without words, none."""
    if not words:
        return np.zeros(0, np.uint64)
    starts = np.arange(max(1, len(words) - k + 1))
    return np.unique(rolling(word_hashes(words), starts, np.minimum(starts + k, len(words))))


def words_of(text: str | None) -> list[bytes]:
    """Words with A-Z in lower case; ``bytes`` split at just the ASCII white space."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def digest_of(words: list[bytes]) -> bytes:
    return hashlib.blake2b(b" ".join(words), digest_size=16).digest()


def hash_family() -> tuple[np.ndarray, np.ndarray]:
    seeds = np.arange(1, 2 * HASHES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    values = mixed(seeds)
    return values[:HASHES], values[HASHES:] | np.uint64(1)


def minima(grams: np.ndarray) -> np.ndarray:
    """The smallest value of each hash function over a set."""
    flip, times = hash_family()
    low = np.full(HASHES, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(grams), 1024):
        np.minimum(low, ((grams[at : at + 1024, None] ^ flip) * times).min(0), out=low)
    return low


def band_keys(low: np.ndarray) -> np.ndarray:
    """One 64-bit key for each band of minima; the band's number is part of it."""
    keys = np.arange(BANDS, dtype=np.uint64)
    for part in low.reshape(BANDS, BAND_ROWS).T:
        keys = mixed(keys ^ part) * np.uint64(0x9E3779B97F4A7C15)
    return keys.view(np.int64)


def bit_planes(low: np.ndarray) -> np.ndarray:
    """The low bits of all minima, packed: for each bit one plane of 128 bits in two longs."""
    spread = mixed(low)
    planes = [np.packbits(((spread >> np.uint64(i)) & np.uint64(1)).astype(np.uint8)) for i in range(BITS)]
    return np.concatenate(planes).view(np.int64)


def prints(documents: DataFrame, k: int) -> DataFrame:
    """PRINTS' columns for every document: digest of its words, size of its set, band keys and packed bits."""
    ship_package(documents.sparkSession)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part, rows = batch.slice(at, 1024), []
                for text in part.column("text"):
                    words = words_of(text.as_py())
                    grams = shingles(words, k)
                    low = minima(grams) if len(grams) else None
                    empty = np.zeros(0, np.int64)
                    rows.append(
                        (digest_of(words), len(grams), empty if low is None else band_keys(low), empty if low is None else bit_planes(low))
                    )
                digests, sizes, bands, planes = zip(*rows, strict=True) if rows else ((),) * 4
                longs = pa.list_(pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        pa.array(digests, pa.binary()),
                        pa.array(sizes, pa.int64()),
                        pa.array(list(bands), longs),
                        pa.array(list(planes), longs),
                    ],
                    names=["doc_id", "digest", "n_shingles", "bands", "planes"],
                )

    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(work, PRINTS)


def shingle_sets(documents: DataFrame, wanted: DataFrame, k: int) -> DataFrame:
    """``node, grams`` of the ``wanted (node, digest)`` documents: their whole sets."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part, nodes, sets = batch.slice(at, 1024), [], []
                for node, text, digest in zip(*(part.column(c) for c in ("node", "text", "digest")), strict=True):
                    words = words_of(text.as_py())
                    if digest_of(words) == digest.as_py():
                        nodes.append(node.as_py())
                        sets.append(shingles(words, k).view(np.int64))
                arrays = [pa.array(nodes, pa.int64()), pa.array(sets, pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays(arrays, names=["node", "grams"])

    texts = documents.select(F.col("doc_id").cast("long").alias("node"), "text").join(wanted, "node")
    return texts.mapInArrow(work, "node long, grams array<long>").dropDuplicates(["node", "grams"])


def compare_blocks(rows: pa.Table, percent: int, least: float) -> pa.Table:
    """Links ``a, b`` between the components in two blocks of a bucket (or in one), enough to join those that touch.

    Classes outside the block's largest component are compared with those of other components, if this bucket is
    the first that both share, by their sizes, their packed bits and at last their whole sets.  Components that are
    joined already are not compared again.
    """
    rows = rows.combine_chunks()
    node, size, shared, own = (rows[c].to_numpy() for c in ("node", "size", "shared", "own"))
    key, crossed = rows["key"][0].as_py(), rows["low"][0].as_py() != rows["high"][0].as_py()
    bands, planes = (
        rows[c].combine_chunks().flatten().to_numpy().reshape(len(node), -1) for c in ("bands", "planes")
    )
    planes = planes.view(np.uint64)
    grams = rows["grams"].combine_chunks()
    ids = np.unique(grams.flatten().to_numpy(), return_inverse=True)[1]
    ends = np.cumsum(pc.list_value_length(grams).to_numpy())
    starts = ends - np.diff(ends, prepend=0)
    label = np.unique(rows["label"].to_numpy(), return_inverse=True)[1]
    outside = label != np.bincount(label).argmax()
    longs, chance, found = HASHES // 64, 2.0**-BITS, []
    mark = np.zeros(ids.max() + 1, np.int64)
    for i in np.flatnonzero(outside):
        most = np.minimum(shared, shared[i])
        can = (label != label[i]) & (most * 100 >= (size + size[i] - most) * percent)
        can &= np.minimum(size, size[i]) * 100 >= np.maximum(size, size[i]) * percent
        can[: i + 1] &= ~outside[: i + 1]
        if crossed:
            can &= own != own[i]
        at = np.flatnonzero(can)
        differ = np.bitwise_or.reduce((planes[at] ^ planes[i]).reshape(len(at), BITS, longs), axis=1)
        equal = 1 - np.bitwise_count(differ).sum(1) / HASHES
        at = at[(equal - chance) / (1 - chance) >= least]
        same = bands[at] == bands[i]
        at = at[bands[i, same.argmax(1)] == key]
        if not len(at):
            continue
        mark[ids[starts[i] : ends[i]]] = 1
        both = np.add.reduceat(
            mark[np.concatenate([ids[starts[j] : ends[j]] for j in at])],
            np.cumsum(ends[at] - starts[at]) - (ends[at] - starts[at]),
        )
        mark[ids[starts[i] : ends[i]]] = 0
        at = at[both * 100 >= (size[i] + size[at] - both) * percent]
        for j in at:
            if label[j] != label[i]:
                found.append((node[i], node[j]))
                label[label == label[j]] = label[i]
    a, b = zip(*found, strict=True) if found else ((), ())
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def estimate(a: Column, b: Column) -> Column:
    """Similarity from the counts of equal b-bit minima, less the share that is equal by chance."""
    longs = HASHES // 64
    differ = [
        F.bit_count(
            F.reduce(
                F.array(*[a[i + longs * p].bitwiseXOR(b[i + longs * p]) for p in range(BITS)]),
                F.lit(0).cast("long"),
                lambda x, y: x.bitwiseOR(y),
            )
        )
        for i in range(longs)
    ]
    equal = 1 - sum(differ[1:], differ[0]) / HASHES
    chance = 2.0**-BITS
    return (equal - chance) / (1 - chance)


def still_mixed(buckets: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows of the buckets that hold several components, with their component as ``label``; a written table."""
    rows = buckets.drop("label").join(labels, "node", "left")
    rows = rows.withColumn("label", F.coalesce("component", "node")).drop("component")
    keys = rows.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high"))
    return materialize(rows.join(keys.where("low < high").select("key"), "key"), "buckets")


class Verifier:
    """Decides pairs of classes: first by the estimate, then on whole sets."""

    def __init__(self, classes: DataFrame, sets: DataFrame, percent: int) -> None:
        self.planes = classes.select("node", "planes", "n_shingles")
        self.bits = classes.select("node", "planes", "bands")
        self.sets, self.percent = sets, percent
        similarity = percent / 100
        chance = 2.0**-BITS
        equal = similarity + (1 - similarity) * chance
        deviation = (equal * (1 - equal) / HASHES) ** 0.5 / (1 - chance)
        self.least = similarity - DEVIATIONS * deviation

    def possible(self, size_a: Column, shared_a: Column, size_b: Column, shared_b: Column) -> Column:
        """Whether two sets can be similar enough if at most ``shared`` of their elements stand in other sets."""
        most = F.least(shared_a, shared_b)
        return most * 100 >= (size_a + size_b - most) * self.percent

    def with_shared(self, buckets: DataFrame) -> DataFrame:
        """Adds each class's ``size`` and how many of its shingles are ``shared`` with any other class here."""
        grams = self.sets.join(buckets.select("node").distinct(), "node").select("node", F.explode("grams").alias("gram"))
        single = grams.groupBy("gram").agg(F.count("*").alias("n"), F.first("node").alias("node")).where("n = 1")
        single = single.groupBy("node").agg(F.count("*").alias("own"))
        sizes = self.planes.select("node", F.col("n_shingles").alias("size")).join(single, "node", "left")
        sizes = sizes.select("node", "size", (F.col("size") - F.coalesce("own", F.lit(0))).alias("shared"))
        return buckets.join(sizes, "node")

    def without_isolated(self, buckets: DataFrame) -> DataFrame:
        """Rows but those that can be linked with no class of a bucket, whose sets all have a least size."""
        least = buckets.groupBy("key").agg(F.min("size").alias("least"))
        # The best partner has as many elements as are shared, or the least size if that is more.
        partner = F.greatest("least", "shared")
        can = self.possible(F.col("size"), F.col("shared"), partner, partner)
        return buckets.join(least, "key").where(can).drop("least")

    def candidates(self, buckets: DataFrame, other: DataFrame) -> DataFrame:
        """Pairs of classes of different components in one bucket that can be links: ``a < b``."""
        other = other.select("key", *[F.col(c).alias(f"{c}_2") for c in ("node", "label", "size", "shared")])
        can = self.possible(F.col("size"), F.col("shared"), F.col("size_2"), F.col("shared_2"))
        pairs = buckets.join(other, "key").where((F.col("label") != F.col("label_2")) & can)
        return pairs.select(F.least("node", "node_2").alias("a"), F.greatest("node", "node_2").alias("b")).distinct()

    def links(self, pairs: DataFrame) -> DataFrame:
        """Those of ``pairs (a, b)`` whose sets are similar enough, as a written table."""
        side = lambda of: self.planes.select(
            F.col("node").alias(of), F.col("planes").alias(f"planes_{of}"), F.col("n_shingles").alias(f"n_{of}")
        )
        likely = (
            pairs.join(side("a"), "a")
            .join(side("b"), "b")
            .where(F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * self.percent)
            .where(estimate(F.col("planes_a"), F.col("planes_b")) >= self.least)
            .select("a", "b")
        )
        grams = lambda of: self.sets.select(F.col("node").alias(of), F.col("grams").alias(f"grams_{of}"))
        both = F.size(F.array_intersect("grams_a", "grams_b"))
        union = F.size("grams_a") + F.size("grams_b") - both
        sure = likely.join(grams("a"), "a").join(grams("b"), "b").where(both * 100 >= union * self.percent)
        return materialize(sure.select("a", "b").distinct(), "links")

    def links_between(self, buckets: DataFrame) -> DataFrame:
        """Links between the components of each bucket, as a written table.

        Every pair of classes of different components is compared, but inside tasks, block by block: a bucket's rows
        are copied once for each of its blocks, not once for each partner, and only links leave a task.
        """
        percent, least = self.percent, self.least
        total = buckets.groupBy("key").agg(F.count("*").alias("n"), F.sum("size").alias("grams"))
        most = F.greatest(F.ceil(F.col("n") / BLOCK_ROWS), F.ceil(F.col("grams") / BLOCK_GRAMS))
        rows = buckets.join(total.select("key", most.cast("int").alias("blocks")), "key")
        rows = rows.withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
        rows = rows.join(self.bits, "node").join(self.sets, "node")
        rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        rows = rows.withColumns({"low": F.least("own", "other"), "high": F.greatest("own", "other")})
        links = rows.drop("blocks", "other").groupBy("key", "low", "high")
        links = links.applyInArrow(lambda part: compare_blocks(part, percent, least), "a long, b long")
        return materialize(links.distinct(), "links")


def near_duplicates(documents: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """Components of near-duplicate documents: ``doc_id, n_shingles, component_id, kept``.

    A document's set holds its distinct shingles of ``k`` words (A-Z in lower case, split at ASCII white space);
    one with fewer words has its whole sequence as one shingle.  Documents are linked if 100 times the
    intersection is at least ``percent`` times the union; component_id is the smallest doc_id that links reach.
    Null and empty texts have empty sets and are linked with nothing.  Rows with equal ids count as linked; a null
    id has the component of its text's other rows, if there are any.  Other columns are ignored.

    Equal word sequences form one class first, so copies never meet in pairs.  Classes that share a band are
    candidates.  A bucket is first searched as a star around its smallest class.  Buckets that still hold several
    components go on without the classes that cannot be linked there, as too many of their shingles stand in no
    other class left (see ``possible``): first as stars around the class with the fewest such shingles, then
    around classes chosen by hash, while that saves comparisons; then the pairs left of different components are
    compared in blocks.  So no pair of one component is compared in vain, and no pair that could be a link is left out.
    """
    marks = materialize(prints(documents, k), "prints")
    full = marks.where("n_shingles > 0")
    classes = full.groupBy("digest").agg(
        F.min("doc_id").alias("node"), *[F.first(c).alias(c) for c in ("n_shingles", "bands", "planes")]
    )
    classes = materialize(classes, "classes")
    named = classes.where("node IS NOT NULL")
    keys = named.select("node", F.explode("bands").alias("key"))
    centers = keys.groupBy("key").agg(F.min("node").alias("center"), F.max("node").alias("last")).where("center < last")
    buckets = materialize(keys.join(centers.select("key", "center"), "key"), "buckets")
    wanted = buckets.select("node").distinct().join(named.select("node", "digest"), "node")
    check = Verifier(named, materialize(shingle_sets(documents, wanted, k), "sets"), percent)

    stars = buckets.groupBy("node").agg(F.min("center").alias("a")).where("a < node")
    links = check.links(stars.select("a", F.col("node").alias("b")))
    labels = materialize(components(links), "labels")
    buckets = check.with_shared(still_mixed(buckets.select("key", "node"), labels))
    before, turn = None, 0
    while True:
        buckets = still_mixed(check.without_isolated(buckets), labels)
        size = buckets.groupBy("key", "label").agg(F.count("*").alias("n")).groupBy("key")
        size = size.agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("n")).alias("inside"))
        rows, pairs = size.agg(F.sum("n"), F.sum((F.col("n") * F.col("n") - F.col("inside")) / 2)).first()
        if not pairs:
            break
        last = pairs <= 2 * rows or (before is not None and pairs > 0.8 * before)
        turn, before = turn + 1, pairs
        if last:
            found = check.links_between(buckets)
        else:
            rank = F.col("size") - F.col("shared") if turn == 1 else F.xxhash64("node", F.lit(turn))
            middle = F.min_by(F.struct("node", "label", "size", "shared"), F.struct(rank, "node")).alias("m")
            found = check.links(check.candidates(buckets, buckets.groupBy("key").agg(middle).select("key", "m.*")))
        links = links.unionByName(found)
        labels = materialize(components(links), "labels")
        if last:
            break
    own = classes.select(F.col("digest").alias("of"), F.col("node"))
    joined = marks.join(own, (F.col("digest") == F.col("of")) & (F.col("n_shingles") > 0), "left").join(labels, "node", "left")
    component = F.coalesce("component", "node", "doc_id")
    return joined.select("doc_id", "n_shingles", component.alias("component_id")).withColumn(
        "kept", F.col("doc_id").eqNullSafe(F.col("component_id"))
    )
