"""Winnowing fingerprints of documents, and how alike a text is to its edit and to the next document."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import rows, slices

BASE = np.uint64(0x9E3779B97F4A7C15)  # odd, so that its powers can be divided out again
INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
PLACES = 24  # bits of an entry for its position; the other 40 are the hash
CHUNK = 1 << 20  # positions that are worked on at a time


@cache
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of the base and of its inverse, modulo 2 ** 64."""
    out = []
    for base in (BASE, INVERSE):
        with np.errstate(over="ignore"):
            p = np.full(n, base, np.uint64)
            p[0] = 1
            out.append(np.cumprod(p))
    return out[0], out[1]


def gram_hashes(codes: np.ndarray, k: int) -> np.ndarray:
    """40-bit hashes of all ``k``-grams of code points: differences of one running sum, mixed."""
    n = len(codes)
    up, down = _powers(1 << max(12, int(n).bit_length()))
    with np.errstate(over="ignore"):
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum((codes.astype(np.uint64) + np.uint64(1)) * up[:n], out=sums[1:])
        h = (sums[k:] - sums[:-k]) * down[: n - k + 1]
        h ^= h >> np.uint64(31)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(29)
        h *= np.uint64(0x94D049BB133111EB)
    return h >> np.uint64(PLACES)


def winnow(text: str, k: int = 12, window: int = 64) -> np.ndarray:
    """``(hash, position)`` rows: of each ``window`` successive ``k``-grams the smallest hash, the rightmost if several are.

    Any passage of ``window + k - 1`` code points that two texts share leaves an entry in
    both. In a short text the window is an eighth of it, at least 4 grams: the smallest of
    a wide window is also that of each narrower one around it, so the guarantee stands. A
    text shorter than ``k`` is a single gram.
    """
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    if not len(codes):
        return np.zeros((0, 2), np.uint64)
    k = min(k, len(codes))
    grams = len(codes) - k + 1
    w = min(window, max(4, grams // 8), grams)
    found = []
    for at in range(0, grams - w + 1, CHUNK):
        end = min(grams - w + 1, at + CHUNK) + w - 1  # grams of this chunk's windows
        h = gram_hashes(codes[at : end + k - 1], k)
        # the larger the position, the smaller the entry: ties go to the right
        entry = (h << np.uint64(PLACES)) | (np.uint64((1 << PLACES) - 1) - np.arange(len(h), dtype=np.uint64))
        width = 1
        while 2 * width <= w:
            entry = np.minimum(entry[:-width], entry[width:])
            width *= 2
        if width < w:
            entry = np.minimum(entry[: len(entry) - (w - width)], entry[w - width :])
        entry = entry[np.concatenate([[True], entry[1:] != entry[:-1]])]
        position = np.uint64((1 << PLACES) - 1) - (entry & np.uint64((1 << PLACES) - 1)) + np.uint64(at)
        found.append(np.column_stack([entry >> np.uint64(PLACES), position]))
    out = np.concatenate(found)
    return out[np.concatenate([[True], (out[1:] != out[:-1]).any(1)])] if len(found) > 1 else out


def written(entries: np.ndarray) -> str:
    """16 hexadecimal digits for each entry: 10 of its hash, 6 of its position (modulo 2 ** 24)."""
    if not len(entries):
        return ""
    return ((entries[:, 0] << np.uint64(PLACES)) | (entries[:, 1] & np.uint64((1 << PLACES) - 1))).astype(">u8").tobytes().hex()


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """The share of common hashes among all of two fingerprints (distinct ones); 1 for two empty ones."""
    if not len(a) and not len(b):
        return 1.0
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both)


def edited(text: str, following: str) -> str:
    """``text`` with its last quarter replaced by as many characters from the start of ``following``."""
    n = len(text) // 4
    return text[: len(text) - n] + following[:n]


RESULT = (
    "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
)


def _part(order: Column, bounds: list[int]) -> Column:
    """How many of the sorted bounds are below the id: the number of its range."""
    if not bounds:
        return F.lit(0)
    place = F.array_position(F.transform(F.lit(bounds), lambda b: b >= order), F.lit(True))
    return F.when(order.isNull(), 0).when(place == 0, len(bounds)).otherwise(place - 1).cast("int")


def fingerprint_neighbours(
    docs: DataFrame,
    *,
    k: int = 12,
    window: int = 64,
    parts: int | None = None,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Each document's fingerprint, that of its edited text, and their likenesses.

    The next document is that with the next larger id; after the last comes the first.
    Texts are shuffled once, by ranges of ids (``parts``, bounds from a quantile sketch), and
    each range is read in order, with the range's first successor added to it. Ranges are as
    even as ids are distinct: rows that repeat one id, or have none, share a range. Those
    rows follow each other in the order of a hash of their texts; null ids come first. A null
    text is empty; an empty text has an empty fingerprint. A single document follows itself.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col(id_column).cast("bigint").alias("id"), F.coalesce(F.col(text_column), F.lit("")).alias("text"))
    texts = texts.withColumn("hash", F.xxhash64("text"))
    parts = parts or 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    steps = [i / parts for i in range(1, parts)]
    bounds = (texts.agg(F.percentile_approx("id", steps, 20 * parts)).first()[0] if steps else []) or []
    placed = texts.withColumn("part", _part(F.col("id"), sorted(set(bounds))))
    # the first row of each range, one for each range, goes to the end of the range before it as well
    heads = placed.groupBy("part").agg(F.min(F.struct(F.coalesce("id", F.lit(-(1 << 63))).alias("key"), "hash", "id")).alias("at"))
    around = Window.orderBy("part")  # as many rows as ranges
    last = F.max("part").over(around.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    heads = heads.select("at", F.coalesce(F.lag("part").over(around), last).alias("before"))
    first = heads.select(F.col("at.id").alias("fid"), F.col("at.hash").alias("fhash"), "before")
    successor = texts.join(F.broadcast(first), texts.id.eqNullSafe(F.col("fid")) & (texts.hash == F.col("fhash")))
    successor = successor.dropDuplicates(["before"]).select("id", "text", "hash", F.col("before").alias("part"), F.lit(1).alias("extra"))
    dealt = placed.withColumn("extra", F.lit(0)).unionByName(successor).repartition(parts, "part")
    dealt = dealt.sortWithinPartitions("part", "extra", "id", "hash")

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in RESULT.split(", ")]
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
        last, out = None, []
        for batch in slices(batches, "text"):
            for part, extra, doc_id, text in rows(batch, "part", "extra", "id", "text"):
                entries = winnow(text, k, window)
                own = np.unique(entries[:, 0])
                if last is not None and last[0] == part:
                    before_id, before, entries_before, own_before = last[1:]
                    other = edited(before, text)
                    changed = winnow(other, k, window)
                    digest = hashlib.sha256(other.encode()).hexdigest()
                    near = likeness(own_before, np.unique(changed[:, 0])), likeness(own_before, own)
                    out.append((before_id, len(before), digest, written(entries_before), written(changed), *near))
                last = None if extra else (part, doc_id, text, entries, own)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)], names=names)
                out = []

    return dealt.select("part", "extra", "id", "text").mapInArrow(apply, RESULT)
