"""Collocations of two to five words: padded longest windows, counted once and rolled up to their prefixes."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import rows, slices, stored
from .minhash import mixed

SLOTS = 1 << 25  # counters by hash, which rule out words and pairs that are too rare
BLOCK = 1 << 16  # counters in one row
BUCKETS = 1 << 10  # rows that the windows of a slice are packed into
HELD = 400_000  # windows that a task adds up at once
SPREAD = 64  # tasks that rank one language before the last one does
NO_LANG = "und"
# The bytes that end a piece.
ENDS = b".,;:!?\n\x0b\x0c\r"
_TABLE = bytes(10 if b in ENDS else b + 32 if 65 <= b <= 90 else b for b in range(256))


class Vocabulary:
    """Words of one task as numbers, with a hash for each."""

    def __init__(self) -> None:
        self.ids: dict[bytes, int] = {}
        self.words: list[bytes] = []

    def number(self, words: list[bytes]) -> np.ndarray:
        ids = self.ids
        for w in set(words):
            if w not in ids:
                ids[w] = len(ids)
                self.words.append(w)
        return np.fromiter(map(ids.__getitem__, words), np.int32, len(words))

    def hashes(self) -> np.ndarray:
        return np.fromiter(map(xxhash.xxh64_intdigest, self.words), np.uint64, len(self.words))


def pieces(text: str | None) -> list[list[bytes]]:
    """The words of each piece of a text, in UTF-8."""
    data = (text or "").encode("utf-8", "surrogatepass").translate(_TABLE)
    return [p.split() for p in data.split(b"\n")]


def tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, np.ndarray, np.ndarray, Vocabulary]]:
    """For each slice of the texts and each language ``(lang, ids, follows, vocabulary)``.

    ``follows`` is true where the next word is of the same piece. Numbers hold within a slice.
    """
    for batch in slices(batches, "text"):
        of_lang: dict[str, list[list[bytes]]] = {}
        for lang, text in rows(batch, "lang", "text"):
            of_lang.setdefault(lang, []).extend(p for p in pieces(text) if p)
        for lang, cut in of_lang.items():
            if cut:
                known = Vocabulary()
                ids = known.number(list(chain.from_iterable(cut)))
                follows = np.ones(len(ids), bool)
                follows[np.cumsum([len(p) for p in cut]) - 1] = False
                yield lang, ids, follows, known


def _hashes(lang: str, ids: np.ndarray, known: Vocabulary) -> np.ndarray:
    return mixed(known.hashes() + np.uint64(xxhash.xxh64_intdigest(lang)))[ids]


def _longer(so_far: np.ndarray, words: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Hashes of phrases that are followed by the words at ``at``."""
    return mixed(so_far * np.uint64(0x9E3779B97F4A7C15) + words[at])


def _often(bits: np.ndarray, h: np.ndarray, slots: int) -> np.ndarray:
    slot = h & np.uint64(slots - 1)
    return (bits[slot >> np.uint64(3)] >> (np.uint64(7) - (slot & np.uint64(7))).astype(np.uint8) & 1).astype(bool)


def _pairs(h: np.ndarray, follows: np.ndarray, bits: np.ndarray, slots: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Which words may be frequent, and the positions and hashes of the pairs that may."""
    kept = _often(bits, h, slots)
    at = np.flatnonzero(follows[:-1] & kept[:-1] & kept[1:])
    two = _longer(h[at], h, at + 1)
    frequent = _often(bits, two, slots)
    return kept, at[frequent], two[frequent]


def _counters(docs: DataFrame, least: int, slots: int, longest: int = 2, pairs=None) -> DataFrame:
    """``(lang, n, block, counts)``: words for each language, and each task's counters, which stop at ``least``.

    Words and pairs are counted, or with the broadcast bits of ``pairs`` all phrases of 3 to
    ``longest`` words whose pairs may be frequent.
    """
    kind = np.uint8 if least < 256 else np.uint32
    block = min(BLOCK, slots)

    def phrases(h: np.ndarray, follows: np.ndarray) -> Iterator[np.ndarray]:
        if pairs is None:
            yield h
            at = np.flatnonzero(follows)
            yield _longer(h[at], h, at + 1)
            return
        _, at, so_far = _pairs(h, follows, pairs.value, slots)
        linked = np.zeros(len(h) + longest, bool)
        linked[at] = True
        for k in range(3, longest + 1):
            goes_on = linked[at + k - 2]
            at, so_far = at[goes_on], so_far[goes_on]
            so_far = _longer(so_far, h, at + k - 1)
            yield so_far

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, n = np.zeros(slots, kind), {}
        for lang, ids, follows, known in tokens(batches):
            n[lang] = n.get(lang, 0) + len(ids)
            for found in phrases(_hashes(lang, ids, known), follows):
                slot, more = np.unique(found & np.uint64(slots - 1), return_counts=True)
                counts[slot] = np.minimum(counts[slot] + more, least)
        out = [(lang, found, None, None) for lang, found in n.items()]
        for at in range(0, slots, block) if n else ():
            part = counts[at : at + block]
            if part.any():
                out.append((None, None, at // block, zlib.compress(part.tobytes(), 1)))
        kinds = (pa.string(), pa.int64(), pa.int32(), pa.binary())
        for at in range(0, len(out), 1024):
            columns = [pa.array(c, t) for c, t in zip(zip(*out[at : at + 1024]), kinds)]
            yield pa.RecordBatch.from_arrays(columns, names=["lang", "n", "block", "counts"])

    return docs.mapInArrow(apply, "lang string, n bigint, block int, counts binary")


def _frequent(counters: DataFrame, least: int, slots: int) -> np.ndarray:
    """A bit for each counter: whether all tasks together reach ``least``. At most ``slots`` bits are collected."""
    kind = np.uint8 if least < 256 else np.uint32
    block = min(BLOCK, slots)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, np.ndarray] = {}
        for batch in batches:
            for at, counts in rows(batch, "block", "counts"):
                more = np.frombuffer(zlib.decompress(counts), kind)
                found[at] = np.minimum(found[at] + more.astype(np.uint32), least) if at in found else more.astype(np.uint32)
        for at, counts in found.items():
            bits = np.packbits(counts >= least).tobytes()
            yield pa.RecordBatch.from_arrays([pa.array([at], pa.int32()), pa.array([bits])], names=["block", "bits"])

    bits = np.zeros(slots, bool)
    parts = counters.filter("block is not null").select("block", "counts").repartition("block")
    for at, packed in parts.mapInArrow(apply, "block int, bits binary").collect():
        bits[at * block : (at + 1) * block] = np.unpackbits(np.frombuffer(packed, np.uint8), count=block).astype(bool)
    return np.packbits(bits)


def windows(docs: DataFrame, longest: int, pairs, longer, slots: int) -> DataFrame:
    """``(lang, bucket, packed)``: how often each padded longest window occurs, added up in each slice.

    ``w1`` is a word and the columns after it the words that follow, null from the end of the
    piece on. What is surely too rare, by the broadcast bits, ends the window too: no phrase
    that is frequent enough goes across it. The windows of a slice are dealt into ``BUCKETS`` by
    their first words, each bucket packed into one row.
    """

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, ids, follows, known in tokens(batches):
            h = _hashes(lang, ids, known)
            kept, at, so_far = _pairs(h, follows, pairs.value, slots)
            linked = np.zeros(len(h) + longest, bool)
            linked[at] = True
            size = kept.astype(np.int8)  # words of the window that begins here
            size[at] = 2
            for k in range(3, longest + 1):
                goes_on = linked[at + k - 2]
                at, so_far = at[goes_on], so_far[goes_on]
                so_far = _longer(so_far, h, at + k - 1)
                frequent = _often(longer.value, so_far, slots)
                at, so_far = at[frequent], so_far[frequent]
                size[at] = k
            padded = np.concatenate([ids, np.full(longest, -1, np.int32)])
            start = np.flatnonzero(kept)
            columns = [np.where(size[start] > i, padded[start + i], -1).astype(np.int32) for i in range(longest)]
            order = np.lexsort(columns)
            columns = [c[order] for c in columns]
            new = np.ones(len(order), bool)
            if len(order):
                new[1:] = np.any([c[1:] != c[:-1] for c in columns], axis=0)
            first = np.flatnonzero(new)
            times = np.diff(np.append(first, len(order)))
            heads = mixed(h[start[order[first]]] + np.where(columns[1][first] >= 0, h[np.minimum(start[order[first]] + 1, len(h) - 1)], 0))
            bucket = (heads % np.uint64(BUCKETS)).astype(np.int64)
            by_bucket = np.argsort(bucket, kind="stable")
            texts = [known.words[i] for i in columns[0][first].tolist()]
            for column in columns[1:]:
                texts = [t + b" " + known.words[i] if i >= 0 else t for t, i in zip(texts, column[first].tolist(), strict=True)]
            lines = [b"%s\t%d" % pair for pair in zip(texts, times.tolist(), strict=True)]
            lines = list(map(lines.__getitem__, by_bucket.tolist()))
            found, ends = np.unique(bucket, return_counts=True)
            ends = np.cumsum(ends).tolist()
            out = [zlib.compress(b"\n".join(lines[a:b]), 1) for a, b in zip([0, *ends], ends, strict=False)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(out), pa.string()), pa.array(found.astype(np.int32)), pa.array(out, pa.binary())], names=["lang", "bucket", "packed"]
            )

    return docs.mapInArrow(apply, "lang string, bucket int, packed binary")


def unpacked(packed: DataFrame, longest: int) -> DataFrame:
    """``(lang, w1 .. wN, c)`` of packed windows, summed where the rows of a bucket meet.

    ``w1`` is a word and the columns after it the words that follow, null where the window
    ends before. A task that holds ``HELD`` windows passes them on and begins anew.
    """
    names = [f"w{i}" for i in range(1, longest + 1)]

    def batch(found: dict[tuple[str, bytes], int]) -> pa.RecordBatch:
        cut = [text.decode("utf-8", "surrogatepass").split(" ") for _, text in found]
        columns = [pa.array([w[i] if len(w) > i else None for w in cut], pa.string()) for i in range(longest)]
        return pa.RecordBatch.from_arrays([pa.array([lang for lang, _ in found], pa.string()), *columns, pa.array(found.values(), pa.int64())], names=["lang", *names, "c"])

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[tuple[str, bytes], int] = {}
        for part in batches:
            for lang, data in rows(part, "lang", "packed"):
                for line in zlib.decompress(data).split(b"\n"):
                    text, _, times = line.rpartition(b"\t")
                    found[lang, text] = found.get((lang, text), 0) + int(times)
                if len(found) >= HELD:
                    yield batch(found)
                    found = {}
        if found:
            yield batch(found)

    dealt = packed.repartition("lang", "bucket").select("lang", "packed")
    return dealt.mapInArrow(apply, "lang string, " + "".join(f"{n} string, " for n in names) + "c bigint")


def _frequencies(counted: DataFrame, longest: int, least: int) -> DataFrame:
    """``(lang, words, f)`` of all phrases of up to ``longest`` words that occur ``least`` times, by ROLLUP over the windows.

    Each occurrence of a phrase begins one window, so summing the windows over their last
    columns gives the frequencies of their prefixes.
    """
    names = [f"w{i}" for i in range(1, longest + 1)]
    rolled = counted.rollup("lang", *names).agg(F.sum("c").alias("f"), F.grouping_id().alias("gid")).filter(F.col("f") >= least)
    # gid has a one for each column that is summed over; k words are left with longest - k ones
    k = longest - F.bit_count("gid")
    words = F.array_compact(F.array(*names))
    return rolled.filter((k > 0) & (F.size(words) == k)).select("lang", words.alias("words"), "f")


def _text(words: Column) -> Column:
    return F.array_join(words, " ")


def collocations(
    docs: DataFrame,
    *,
    least: int = 100,
    longest: int = 5,
    top: int = 2000,
    slots: int = SLOTS,
    lang_column: str = "lang",
    text_column: str = "text",
) -> DataFrame:
    """``(lang, rank, phrase, a, l, r, n, score)``: the ``top`` phrases of each language that hold together best.

    Texts are cut into pieces at ``.,;:!?`` and line ends, pieces into words at blanks and
    tabs, in lower case (A-Z). A phrase has 2 to ``longest`` words of one piece and occurs ``a >=
    least`` times. Cut after its first words it has parts that occur ``l`` and ``r`` times; the
    score is ``floor(1000 * a * n / (l * r))`` of the lowest cut, the first of equal ones, where
    ``n`` is the number of all words of the language. Phrases inside a longer one with ``least``
    occurrences that is as frequent are left out. Ranks go by score, ``a`` and phrase.

    The counters by hash, first of words and pairs, then of longer phrases made of frequent
    pairs, only rule out what is surely too rare. Once a corpus has far more than
    ``least * slots`` words they rule out less, and the windows that are shuffled come near one
    for each word; the result is the same. A null language reads ``und`` and shares its counts, a
    null or empty text has no words, repeated rows count as often as they occur, and texts of
    any length are read whole, in slices. An empty table gives no rows. Other columns are not
    looked at.
    """
    given = docs.select(F.coalesce(F.col(lang_column), F.lit(NO_LANG)).alias("lang"), F.col(text_column).alias("text"))
    counters = stored(_counters(given, least, slots), "phrase-counters")
    total = counters.filter("n is not null").groupBy("lang").agg(F.sum("n").alias("n"))
    spread = given.sparkSession.sparkContext.broadcast
    pairs = spread(_frequent(counters, least, slots))
    longer = spread(_frequent(stored(_counters(given, least, slots, longest, pairs), "phrase-counters"), least, slots))
    counted = unpacked(windows(given, longest, pairs, longer, slots), longest)
    found = stored(_frequencies(counted, longest, least).withColumn("phrase", _text(F.col("words"))), "phrases")
    candidates = found.filter(F.size("words") > 1)

    # all that lies inside a candidate, with the highest frequency of one that holds it
    size = F.size("words")
    spans = F.flatten(
        F.transform(F.sequence(F.lit(2), F.greatest(size - 1, F.lit(2))), lambda k: F.transform(F.sequence(F.lit(1), size - k + 1), lambda i: F.slice("words", i, k)))
    )
    inner = candidates.filter(size > 2).select("lang", F.explode(spans).alias("inside"), "f")
    inner = inner.groupBy("lang", _text(F.col("inside")).alias("phrase")).agg(F.max("f").alias("longer"))
    own = candidates.join(inner, ["lang", "phrase"], "left").filter("longer is null or longer < f").drop("longer")

    cuts = own.select("lang", "phrase", "words", "f", F.explode(F.sequence(F.lit(1), size - 1)).alias("cut"))
    cuts = cuts.select(
        "lang", "phrase", "f", "cut", _text(F.slice("words", F.lit(1), F.col("cut"))).alias("head"), _text(F.slice("words", F.col("cut") + 1, size)).alias("tail")
    )
    parts = found.select("lang", F.col("phrase").alias("part"), F.col("f").alias("times"))
    heads, tails = parts.toDF("lang", "head", "l"), parts.toDF("lang", "tail", "r")
    both = cuts.join(heads, ["lang", "head"]).join(tails, ["lang", "tail"]).join(total, "lang")
    score = F.expr("(cast(1000 * cast(f as decimal(19, 0)) as decimal(22, 0)) * cast(n as decimal(16, 0))) div (cast(l as decimal(19, 0)) * cast(r as decimal(19, 0)))")
    lowest = both.groupBy("lang", "phrase").agg(F.first("f").alias("a"), F.first("n").alias("n"), F.min(F.struct(score.alias("score"), "cut", "l", "r")).alias("low"))
    scored = lowest.select("lang", "phrase", "a", "n", "low.score", "low.l", "low.r")

    order = [F.desc("score"), F.desc("a"), F.col("phrase")]
    spread = F.pmod(F.xxhash64("phrase"), F.lit(SPREAD))
    first = scored.withColumn("part", spread).withColumn("nth", F.row_number().over(W.partitionBy("lang", "part").orderBy(*order)))
    ranked = first.filter(F.col("nth") <= top).withColumn("rank", F.row_number().over(W.partitionBy("lang").orderBy(*order)).cast("bigint"))
    return ranked.filter(F.col("rank") <= top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
