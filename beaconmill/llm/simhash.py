"""SimHash fingerprints of documents, and groups of documents whose fingerprints are near."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import components, rows, slices, stored, unused

SHINGLES_AT_ONCE = 1 << 18


def fingerprint(text: str | None, width: int = 3, seed: int = 42) -> int:
    """64 bits, unsigned. A bit is 1 if it is set in over half of the shingles' XXH64."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    n = max(1, len(words) - width + 1)
    counts = np.zeros(64, np.int64)
    for at in range(0, n, SHINGLES_AT_ONCE):
        part = range(at, min(n, at + SHINGLES_AT_ONCE))
        hashes = np.array([xxhash.xxh64_intdigest(b" ".join(words[i : i + width]), seed) for i in part], dtype=">u8")
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > n).tobytes(), "big")


def fingerprints(docs: DataFrame, *, width: int = 3, seed: int = 42, text_column: str = "text") -> DataFrame:
    """The columns of ``docs`` but for the text, and ``fp``, the fingerprint as a signed number."""
    kept = [c for c in docs.columns if c not in (text_column, "fp")]
    body = unused(kept, "text")

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, body):
            found = np.array([fingerprint(t, width, seed) for (t,) in rows(batch, body)], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), pa.array(found)], names=[*kept, "fp"])

    return docs.select(*kept, F.col(text_column).alias(body)).mapInArrow(apply, docs.select(kept).schema.add("fp", "long"))


class BKTree:
    """Numbers in a tree by Hamming distance: a child hangs on the edge of its distance to the parent."""

    def __init__(self) -> None:
        self.root: list | None = None

    def add(self, value: int) -> None:
        if self.root is None:
            self.root = [value, {}]
            return
        node = self.root
        while d := (node[0] ^ value).bit_count():
            child = node[1].get(d)
            if child is None:
                node[1][d] = [value, {}]
                return
            node = child

    def within(self, value: int, radius: int) -> list[int]:
        """The numbers in the tree at a distance of at most ``radius``: only edges from ``d - radius`` to ``d + radius`` can lead to one."""
        found, ahead = [], [self.root] if self.root else []
        while ahead:
            held, children = ahead.pop()
            d = (held ^ value).bit_count()
            if d <= radius:
                found.append(held)
            if children:
                ahead += [c for e, c in children.items() if d - radius <= e <= d + radius]
        return found


class Joined:
    """Which values are known to be connected, to emit one edge for each new connection only, and all of them to the smallest value."""

    def __init__(self) -> None:
        self.up: dict[int, int] = {}

    def find(self, a: int) -> int:
        while (b := self.up.get(a, a)) != a:
            self.up[a] = self.up.get(b, b)
            a = self.up[a]
        return a

    def join(self, a: int, b: int) -> bool:
        a, b = self.find(a), self.find(b)
        if a != b:
            self.up[max(a, b)] = min(a, b)
        return a != b

    def stars(self) -> list[tuple[int, int]]:
        return [(a, self.find(a)) for a in list(self.up)]


EDGE = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def near_edges(prints: DataFrame, *, radius: int = 3, shard_size: int = 256) -> DataFrame:
    """Edges ``(a, b)`` that connect just those of the distinct ``fp`` which chains of links of at most ``radius`` bits connect.

    Two fingerprints that differ in ``radius`` bits agree in one of ``radius + 1`` blocks of
    bits, so a shard is a block's value. A shard with more than ``shard_size`` members is
    split into trees of about that size, and each tree is given to the shard's other
    members, each of which looks into the trees after its own. A task holds one tree, and
    which of the values that looked into it are connected. It emits an edge from each of them
    to the smallest one that it is connected with, not to the one that it met: the edges are as
    many as the members, not as their pairs, and there are no long chains, so connecting them
    takes fewer rounds.
    """
    blocks, bits = radius + 1, 64 // (radius + 1)
    mask = (1 << bits) - 1

    def part(i: int):
        # the last block also takes the bits that are left over
        moved = F.shiftrightunsigned("fp", i * bits)
        return moved if i == blocks - 1 else moved.bitwiseAND(F.lit(mask))

    keyed = prints.select("fp", F.posexplode(F.array(*(part(i) for i in range(blocks)))).alias("block", "value"))
    sizes = stored(keyed.groupBy("block", "value").count().filter("count > 1"), "shards")
    shards = F.ceil(F.col("count") / shard_size).cast("int")
    home = F.pmod(F.xxhash64("fp"), F.col("shards")).cast("int")
    members = (
        keyed.join(sizes, ["block", "value"])
        .withColumn("shards", shards)
        .withColumn("home", home)
        .select("block", "value", "fp", "home", F.explode(F.expr("sequence(home, shards - 1)")).alias("shard"))
        .withColumn("asks", F.col("shard") > F.col("home"))
        .drop("home")
    )
    key = ["block", "value", "shard"]
    dealt = members.repartition(*key).sortWithinPartitions(*key, "asks", "fp")

    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def members() -> Iterator[tuple]:
            for batch in batches:
                yield from rows(batch, "block", "value", "shard", "asks", "fp")

        found: list[tuple[int, int]] = []
        for _, shard in groupby(members(), key=lambda r: r[:3]):
            tree, joined = BKTree(), Joined()
            for *_, asks, fp in shard:
                value = fp & 0xFFFFFFFFFFFFFFFF
                for other in tree.within(value, radius):
                    joined.join(value, other)
                if not asks:
                    tree.add(value)
            found += joined.stars()
            if len(found) > 50_000:
                yield _edges(found)
                found = []
        yield _edges(found)

    return dealt.mapInArrow(links, "a bigint, b bigint")


def _edges(found: list[tuple[int, int]]) -> pa.RecordBatch:
    a = np.array([x for x, _ in found], np.uint64).view(np.int64)
    b = np.array([y for _, y in found], np.uint64).view(np.int64)
    return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], schema=EDGE)


def simhash_groups(
    docs: DataFrame,
    *,
    width: int = 3,
    radius: int = 3,
    seed: int = 42,
    shard_size: int = 256,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """``(id, fp, component_id)`` for each row: the fingerprint and the smallest id that links reach.

    Equal fingerprints are linked, and those that differ in at most ``radius`` bits. A null
    text counts as empty; texts without a word have fingerprint zero and are linked like any
    others. Repeated rows are rows of one id. A null id never names a component that has
    another id; a component of null ids only has a null ``component_id``.
    """
    ids = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))
    marked = stored(fingerprints(ids, width=width, seed=seed), "prints")
    prints = stored(marked.groupBy("fp").agg(F.min("doc_id").alias("least")), "fps")
    roots = components(near_edges(prints, radius=radius, shard_size=shard_size))
    rooted = stored(prints.join(roots, prints.fp == roots.node, "left").select("fp", "least", F.coalesce("root", "fp").alias("root")), "roots")
    least = stored(rooted.groupBy("root").agg(F.min("least").alias("component_id")), "least")
    of_print = stored(rooted.join(least, "root").select("fp", "component_id"), "groups")
    return marked.join(of_print, "fp").select(F.col("doc_id").alias(id_column), "fp", "component_id")
