"""Near-duplicate documents by b-bit MinHash: banded candidates, packed low bits, exact confirmation."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from operator import add

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import components, rows, slices, stored

HASHES, BITS, BAND = 128, 4, 4  # minima, the low bits kept of each, minima in one band
LONGS = HASHES * BITS // 64
SLACK = 0.15  # what an estimate may lie below the threshold: over four standard deviations
CROWD = 16  # members of a bucket from which on its pairs are thinned out by their shingles
RARE = 16  # documents of crowded buckets that a rare shingle is in at most
SHINGLES_AT_ONCE = 1 << 12
KNOWN = 1 << 18  # hashes of words a task remembers at once

_draw = np.random.default_rng(20_240_601)
_FACTOR = _draw.integers(0, 1 << 63, HASHES, np.uint64) * np.uint64(2) + np.uint64(1)
_OFFSET = _draw.integers(0, 1 << 63, HASHES, np.uint64)
_LANES = sum(1 << (BITS * i) for i in range(64 // BITS))


def mixed(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Shingles:
    """Texts to the sorted distinct 64-bit hashes of their shingles."""

    def __init__(self, width: int):
        self.width = width
        self.known: dict[bytes, int] = {}

    def of(self, text: str | None) -> np.ndarray:
        words = (text or "").encode("utf-8", "surrogatepass").lower().split()
        if not words:
            return np.zeros(0, np.uint64)
        if len(self.known) > KNOWN:
            self.known = {}
        known = self.known
        for w in set(words):
            if w not in known:
                known[w] = xxhash.xxh64_intdigest(w)
        h = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        width = min(self.width, len(words))
        n = len(words) - width + 1
        out = np.full(n, width, np.uint64)
        for i in range(width):
            out = mixed(out + h[i : n + i])
        return np.unique(out)


def minima(shingles: np.ndarray) -> np.ndarray:
    """For each hash function the smallest value over a set that is not empty."""
    out = np.full(HASHES, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(shingles), SHINGLES_AT_ONCE):
        part = shingles[at : at + SHINGLES_AT_ONCE, None] * _FACTOR
        part += _OFFSET
        np.minimum(out, part.min(0), out=out)
    return mixed(out)


def packed(low: np.ndarray) -> np.ndarray:
    """The lowest ``BITS`` bits of each minimum, side by side in ``LONGS`` numbers."""
    lanes = (low & np.uint64((1 << BITS) - 1)).reshape(LONGS, -1)
    return (lanes << (np.arange(lanes.shape[1], dtype=np.uint64) * np.uint64(BITS))).sum(1, dtype=np.uint64).view(np.int64)


def signed(docs: DataFrame, width: int) -> DataFrame:
    """``(doc_id, body, n, node, bands, sig)`` for each row of ``(doc_id, text)``.

    ``node`` is a digest of the whole set, ``body`` one of the text, ``n`` the size of the set;
    ``bands`` are the bucket keys and ``sig`` the packed low bits. Empty sets have none of them.
    """

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingles(width)
        names = np.arange(HASHES // BAND, dtype=np.uint64)
        for batch in slices(batches, "text"):
            out = []
            for (text,) in rows(batch, "text"):
                found = shingles.of(text)
                if not len(found):
                    out.append((0, None, None, None))
                    continue
                low = minima(found)
                key = names.copy()
                for column in low.reshape(-1, BAND).T:
                    key = mixed(key + column)
                out.append((len(found), xxhash.xxh3_128_digest(found.tobytes()), key.view(np.int64), packed(low)))
            columns = [pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int64())))] if out else None
            if columns:
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("body"), *columns], names=["doc_id", "body", "n", "node", "bands", "sig"])

    given = docs.select("doc_id", F.md5("text").alias("body"), "text")
    kind = given.schema["doc_id"].dataType.simpleString()
    return given.mapInArrow(apply, f"doc_id {kind}, body string, n bigint, node binary, bands array<bigint>, sig array<bigint>")


def full_sets(texts: DataFrame, width: int) -> DataFrame:
    """``(node, hashes)`` of ``(node, text)``: the whole set as sorted 64-bit numbers."""

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingles(width)
        for batch in slices(batches, "text", 4_000_000):
            found = [shingles.of(t).view(np.int64) for (t,) in rows(batch, "text")]
            yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(found, pa.list_(pa.int64()))], names=["node", "hashes"])

    return texts.select("node", "text").mapInArrow(apply, "node binary, hashes array<bigint>")


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs ``(a, b)`` whose full sets have ``100 * intersection >= percent * union``."""

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("x"), batch.column("y"), strict=True):
                x, y = x.values.to_numpy(), y.values.to_numpy()
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    both = pairs.join(sets.toDF("a", "x"), "a").join(sets.toDF("b", "y"), "b")
    return both.select("a", "b", "x", "y").mapInArrow(apply, "a binary, b binary")


def differing(x: str, y: str) -> Column:
    """In how many of the minima's low bits two packed signatures differ, by bit counts."""

    def lanes(i: int) -> Column:
        apart = F.get(f"{x}.sig", F.lit(i)).bitwiseXOR(F.get(f"{y}.sig", F.lit(i)))
        step = BITS // 2
        while step:
            apart = apart.bitwiseOR(F.shiftrightunsigned(apart, step))
            step //= 2
        return F.bit_count(apart.bitwiseAND(F.lit(_LANES)))

    return reduce(add, (lanes(i) for i in range(LONGS)))


def _maybe(x: str, y: str, percent: int) -> Column:
    """The sizes allow enough similarity, and so does its estimate.

    Minima that differ agree in their low bits once in ``2 ** BITS``: the estimate of the
    similarity is the share of equal low bits with those chance hits taken out.
    """
    n, m = F.col(f"{x}.n"), F.col(f"{y}.n")
    sizes = 100 * F.least(n, m) >= percent * F.greatest(n, m)
    chance = 2.0**-BITS
    most = HASHES * (1 - (max(0.0, percent / 100 - SLACK) * (1 - chance) + chance))
    return sizes & (differing(x, y) <= F.lit(most))


def near_links(nodes: DataFrame, sets_of, percent: int) -> DataFrame:
    """``(node, root)`` of the nodes of ``(node, n, sig, bands)`` that chains of links connect.

    First each member of a bucket is compared with the one that has fewest shingles of its
    own, which for copies of one text is the text or one near it: a pair for each member. Of
    members that are then still in different groups all pairs are compared, unless something rules
    them out before they leave the join: sizes, the packed bits, and in a crowded bucket, of
    more than ``CROWD`` members, their shingles. Two documents of crowded buckets that share
    a shingle which at most ``RARE`` of these have are found by that shingle; if they share
    none, all they have in common are other shingles, and both need enough of those. So
    copies that are too much changed to be linked do not meet each other. ``sets_of`` gives the
    full sets of nodes.
    """
    buckets = stored(nodes.select("node", F.explode("bands").alias("key")), "minhash-buckets")
    sizes = buckets.groupBy("key").agg(F.count(F.lit(1)).alias("m")).filter("m > 1").select("key", (F.col("m") > CROWD).alias("crowded"))
    members = stored(buckets.join(sizes, "key"), "minhash-members")
    used = stored(members.groupBy("node").agg(F.max("crowded").alias("crowded")), "minhash-used")
    sets = stored(sets_of(used.select("node")), "minhash-sets")

    spread = sets.join(used.filter("crowded").select("node"), "node", "left_semi").select("node", F.explode("hashes").alias("h"))
    spread = stored(spread, "minhash-spread")
    held = spread.join(spread.groupBy("h").agg(F.count(F.lit(1)).alias("times")), "h")
    held = stored(held.filter("times > 1"), "minhash-held")
    common = held.groupBy("node").agg(F.count_if(F.col("times") > RARE).alias("common"))
    known = nodes.select("node", "n", "sig", "bands").join(used.select("node"), "node").join(common, "node", "left")
    known = stored(known.withColumn("common", F.coalesce("common", F.lit(0))), "minhash-known")

    ends = [F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b")]
    own = F.struct("node", "n", "sig")
    told = members.join(known.select("node", "n", "sig", "common"), "node")
    middle = F.min(F.struct(F.col("n") - F.col("common"), F.xxhash64("node"), "node", "n", "sig"))
    chosen = told.groupBy("key").agg(middle.alias("y"))
    beside = told.select("key", own.alias("x")).join(chosen, "key")
    pairs = stored(beside.filter((F.col("x.node") != F.col("y.node")) & _maybe("x", "y", percent)).select(*ends).distinct(), "minhash-pairs")
    links = stored(confirmed(pairs, sets, percent), "minhash-links")
    roots = stored(components(links), "minhash-roots")

    rooted = stored(known.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node")), "minhash-rooted")
    grouped = stored(members.join(rooted, "node"), "minhash-grouped")
    apart = grouped.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high")).filter("low < high").select("key")
    left = stored(grouped.join(apart, "key"), "minhash-left")
    x, y = left.alias("x"), left.alias("y")
    n = F.col("x.n") + F.col("y.n")
    enough = ~F.col("x.crowded") | ((100 + percent) * F.least("x.common", "y.common") >= percent * n)
    # a pair that shares several bands comes out of the first one only
    shared = F.filter(F.zip_with("x.bands", "y.bands", lambda a, b: F.when(a == b, a)), lambda k: k.isNotNull())
    maybe = (F.col("x.root") < F.col("y.root")) & _maybe("x", "y", percent)
    near = x.join(y, (F.col("x.key") == F.col("y.key")) & maybe & enough & (F.get(shared, F.lit(0)) == F.col("x.key"))).select(*ends)
    rare = held.filter(F.col("times") <= RARE).join(rooted.select("node", "n", "sig", "root"), "node")
    x, y = rare.alias("x"), rare.alias("y")
    near = near.unionByName(x.join(y, (F.col("x.h") == F.col("y.h")) & maybe).select(*ends))
    more = confirmed(stored(near.distinct(), "minhash-pairs"), sets, percent)
    return components(more.unionByName(links))


def minhash_groups(
    docs: DataFrame,
    *,
    width: int = 5,
    percent: int = 80,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """``(id, n_shingles, component_id, kept)`` for each row: the size of its set and the smallest id that links reach.

    A document's set holds the distinct shingles of ``width`` words in lower case (A-Z), or
    its whole sequence if it has fewer words. Two documents are linked if ``100 *
    intersection >= percent * union``, which is confirmed on the full sets (64-bit hashes of
    the shingles). Candidates share a band of minima: with 32 bands of 4 minima a pair of
    similarity 0.85 shares none with a probability of 6e-11, one of 0.8 of 5e-8.

    Documents with equal sets are one class from the start. A null text or one without
    words has an empty set and is linked with nothing, not even with its like. Texts of any
    length are read whole. Repeated rows are rows of one id. A null id never names a group
    that has another id; a group of null ids only has a null ``component_id``, and all of
    its rows are kept. Other columns are not looked at and not returned.
    """
    given = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))
    marked = stored(signed(given, width), "minhash-signed")
    nodes = marked.filter("node is not null").groupBy("node").agg(
        F.min("doc_id").alias("least"), F.first("n").alias("n"), F.first("sig").alias("sig"), F.first("bands").alias("bands"), F.min("body").alias("body")
    )
    nodes = stored(nodes, "minhash-nodes")

    def sets_of(wanted: DataFrame) -> DataFrame:
        bodies = stored(nodes.select("node", "body").join(wanted, "node", "left_semi"), "minhash-bodies")
        texts = given.select(F.md5("text").alias("body"), "text").join(bodies, "body")
        found = full_sets(texts, width)
        return found.dropDuplicates(["node"])

    roots = near_links(nodes.select("node", "n", "sig", "bands"), sets_of, percent)
    rooted = nodes.select("node", "least").join(roots, "node", "left").select("node", "least", F.coalesce("root", "node").alias("root"))
    rooted = stored(rooted, "minhash-rooted")
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    of_node = stored(rooted.join(least, "root").select("node", "component_id"), "minhash-groups")
    found = marked.join(of_node, "node", "left")
    component = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id")
    return found.select(F.col("doc_id").alias(id_column), F.col("n").alias("n_shingles"), component).withColumn(
        "kept", F.col(id_column).eqNullSafe(F.col("component_id"))
    )
