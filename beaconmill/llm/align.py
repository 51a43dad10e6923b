"""Two tokenizers side by side: which of their tokens cover the same bytes, and how often each pair does in the corpus.

The corpus statistics are an inverted index: for each pair of ids a compressed bitmap of the
documents of a block that hold it linked, and planes with the bits of the number of links.
"""

from __future__ import annotations

import functools
import hashlib
import re
from array import array
from collections.abc import Iterator
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from .common import rows, slices, stored
from .words import byte_letters

BYTE_FILE, PIECE_FILE = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
BLOCK = 1 << 12  # documents at most in one block of the index: a bitmap has as many bits
BLOCK_BYTES = 12_000_000  # of text, unless a single one is longer
KNOWN = 400_000  # chunks a task remembers at once
SPARSE = BLOCK // 16  # up to so many documents are listed in two bytes each, more are a bitmap
_CUT = re.compile(r"(?<=\S)(?= )")
_SPACED = re.compile(r"\s ")


def chunks(text: str) -> list[str]:
    """A blank and ``text``, cut before each blank that follows anything but white space, without the blank that each chunk begins with."""
    if _SPACED.search(text) or text[0] == " ":
        return [c[1:] for c in _CUT.split(" " + text)]
    return text.split(" ")  # no blank follows white space: the same, in a quarter of the time


def grouped(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """The group of each token of A and of B, and the number of groups, from the byte offsets where tokens end."""
    common = np.intersect1d(ends_a, ends_b, assume_unique=True)
    return np.searchsorted(common, ends_a), np.searchsorted(common, ends_b), len(common)


def within(counts: np.ndarray) -> np.ndarray:
    """0, 1, ... for each of ``counts``, one after the other."""
    return np.arange(int(counts.sum())) - np.repeat(np.cumsum(counts) - counts, counts)


def linked(a: np.ndarray, b: np.ndarray, of_a: np.ndarray, of_b: np.ndarray, groups: int) -> tuple[np.ndarray, np.ndarray]:
    """All pairs ``a << 32 | b`` of tokens of one group, and the number of them in each group."""
    n_a, n_b = np.bincount(of_a, minlength=groups), np.bincount(of_b, minlength=groups)
    first_b = np.cumsum(n_b) - n_b
    times = n_b[of_a]
    return np.repeat(a, times) << 32 | b[np.repeat(first_b[of_a], times) + within(times)], n_a * n_b


class Aligner:
    """Texts to aligned tokens. Texts are cut before a blank that follows anything but white space:
    no word of the byte-level pattern and no piece goes across, as no piece has the mark of a
    blank behind another character. So each distinct chunk is encoded once."""

    def __init__(self, byte_file: str, piece_file: str):
        self.a = Tokenizer.from_file(byte_file)
        self.a.encode_special_tokens = True
        self.a.no_truncation()
        self.a.no_padding()
        self.b = sentencepiece.SentencePieceProcessor(model_file=piece_file)
        letters = {c: b for b, c in enumerate(byte_letters())}
        size = self.a.get_vocab_size()
        self.a_bytes = [bytes(letters[c] for c in t) if (t := self.a.id_to_token(i)) and all(c in letters for c in t) else None for i in range(size)]
        self.b_bytes = [self._piece(i) for i in range(self.b.get_piece_size())]
        self.a_sizes, self.b_sizes = (np.array([len(t or b"") for t in x], np.int64) for x in (self.a_bytes, self.b_bytes))
        text = list(map(str, range(max(len(self.a_bytes), len(self.b_bytes)))))
        self.a_next, self.a_last, self.b_last = ([t + mark for t in text] for mark in ",|;")
        self.b_next = self.a_next
        self.forget()

    def forget(self) -> None:
        """Of each chunk whether its bytes come back, its tokens, groups and links, the links, and the groups as text, a semicolon behind each."""
        self.ids: dict[str, int] = {}
        self.counts = array("q")  # five numbers for each
        self.links: list[bytes] = []
        self.texts: list[str] = []

    def _piece(self, i: int) -> bytes:
        piece = self.b.id_to_piece(i)
        return bytes([int(piece[3:-1], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode()

    def numbers(self, texts: list[str | None]) -> list[list[int]]:
        """For each text the numbers of its chunks, which hold until they are forgotten."""
        ids = self.ids
        cut = [chunks(t) if t else [] for t in texts]
        fresh: set[str] = set()
        for own in cut:
            fresh.update(set(own).difference(ids))
        new = list(fresh)
        for at in range(0, len(new), 50_000):
            self._learn(new[at : at + 50_000])
        return [list(map(ids.__getitem__, own)) for own in cut]

    def _learn(self, new: list[str]) -> None:
        """Encode and align chunks, all of them as one text: each ends in a byte offset common to both sides."""
        spaced = [" " + c for c in new]
        of_a = [e.ids for e in self.a.encode_batch_fast(spaced, add_special_tokens=False)]
        of_b = self.b.encode(new, num_threads=1)
        if "" in new:  # a blank at the end: the library makes nothing of a text without characters
            of_b[new.index("")] = [self.b.piece_to_id("▁")]
        data = [c.encode() for c in spaced]
        a_bytes, b_bytes = self.a_bytes.__getitem__, self.b_bytes.__getitem__
        joined = b"".join(data)
        whole = range(len(new))
        n_a, n_b, a, b = _flat(of_a, of_b, whole)
        ends = np.cumsum(np.fromiter(map(len, data), np.int64, len(data)))
        # equal as one text, and as long in each chunk; else one by one
        if not all(
            b"".join(map(of, flat.tolist())) == joined and np.array_equal(np.append(0, np.cumsum(sizes[flat]))[np.cumsum(n)], ends)
            for of, sizes, n, flat in ((a_bytes, self.a_sizes, n_a, a), (b_bytes, self.b_sizes, n_b, b))
        ):
            whole = [i for i, d in enumerate(data) if b"".join(map(a_bytes, of_a[i])) == d == b"".join(map(b_bytes, of_b[i]))]
            n_a, n_b, a, b = _flat(of_a, of_b, whole)
        ends_a, ends_b = np.cumsum(self.a_sizes[a]), np.cumsum(self.b_sizes[b])
        last = np.cumsum(n_a) - 1  # no chunk is empty
        at_a, at_b, groups = grouped(ends_a, ends_b)
        links, n_links = linked(a, b, at_a, at_b, groups)
        n_groups = np.diff(at_a[last] + 1, prepend=0) if len(last) else n_a
        of_chunk = np.add.reduceat(n_links, np.cumsum(n_groups) - n_groups) if len(last) else n_a
        # the groups as text: ids in order, A before B, each with what follows it
        end_a, end_b = (np.append(x[1:] != x[:-1], True) if len(x) else np.zeros(0, bool) for x in (at_a, at_b))
        parts = [self.a_last[i] if e else self.a_next[i] for i, e in zip(a.tolist(), end_a.tolist(), strict=True)]
        parts += [self.b_last[i] if e else self.b_next[i] for i, e in zip(b.tolist(), end_b.tolist(), strict=True)]
        order = np.argsort(np.concatenate([at_a * 2, at_b * 2 + 1]), kind="stable").tolist()
        parts = list(map(parts.__getitem__, order))
        ends = np.cumsum(n_a + n_b).tolist()
        link_ends = (np.cumsum(of_chunk) * 8).tolist()
        raw = links.tobytes()
        first = len(self.texts)
        self.ids.update(zip([new[i] for i in whole], range(first, first + len(whole)), strict=True))
        self.counts.extend(np.stack([np.ones_like(n_a), n_a, n_b, n_groups, of_chunk], 1).ravel().tolist())
        self.links += [raw[x:y] for x, y in zip([0, *link_ends], link_ends, strict=False)]
        self.texts += ["".join(parts[x:y]) for x, y in zip([0, *ends], ends, strict=False)]
        for i in sorted({*range(len(new))}.difference(whole)):
            self.ids[new[i]] = len(self.texts)
            self.counts.extend([0] * 5)
            self.links.append(b"")
            self.texts.append("")


def _flat(of_a: list[list[int]], of_b: list[list[int]], whole: list[int] | range) -> list[np.ndarray]:
    """How many ids each of the chunks ``whole`` has on both sides, and the ids of all, one after the other."""
    counts = [np.fromiter((len(x[i]) for i in whole), np.int64, len(whole)) for x in (of_a, of_b)]
    return counts + [np.fromiter(chain.from_iterable(x[i] for i in whole), np.int64, int(n.sum())) for x, n in zip((of_a, of_b), counts, strict=True)]


@functools.cache
def aligner(byte_file: str, piece_file: str) -> Aligner:
    return Aligner(byte_file, piece_file)


def compressed(at: np.ndarray) -> bytes:
    """A bitmap of ``BLOCK`` bits from the sorted numbers of those that are set: few are listed."""
    if len(at) <= SPARSE:
        return at.astype("<u2").tobytes()
    bits = np.zeros(BLOCK, bool)
    bits[at] = True
    return b"\0" + np.packbits(bits, bitorder="little").tobytes()  # an odd length tells it from a list


def members(data: bytes) -> np.ndarray:
    """The sorted numbers of the bits that are set."""
    if len(data) % 2 == 0:
        return np.frombuffer(data, "<u2").astype(np.int64)
    return np.flatnonzero(np.unpackbits(np.frombuffer(data, np.uint8, offset=1), bitorder="little"))


def postings(pairs: np.ndarray, docs: np.ndarray, times: np.ndarray) -> Iterator[tuple[int, list[bytes]]]:
    """``(pair, bitmaps)`` for rows sorted by pair and document.

    The first bitmap has the documents, which is what the planes after it have or-ed. Plane
    ``i`` has those whose number of links has bit ``i``; there are none where all have one link.
    """
    starts = np.flatnonzero(np.append(True, pairs[1:] != pairs[:-1])) if len(pairs) else np.zeros(0, np.int64)
    most = np.maximum.reduceat(times, starts) if len(starts) else starts
    for first, last, pair, high in zip(starts.tolist(), np.append(starts[1:], len(pairs)).tolist(), pairs[starts].tolist(), most.tolist(), strict=True):
        at = docs[first:last]
        bits = times[first:last]
        yield pair, [compressed(at), *(compressed(at[(bits >> i & 1).astype(bool)]) for i in range(int(high).bit_length() if high > 1 else 0))]


DOC = "id {kind}, block bigint, nth int, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, pair bigint, planes array<binary>"


def aligned(docs: DataFrame, byte_file: str, piece_file: str) -> DataFrame:
    """A row for each document, ``pair`` null, and a row for each pair and block, ``nth`` null.

    Both come from one pass, and a block's number from the task and its batches, so the
    result has to be stored: a second run of a task may number its documents otherwise.
    """
    from pyspark import TaskContext

    kind = docs.schema["id"].dataType.simpleString()

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        maker = aligner(byte_file, piece_file)
        task = TaskContext.get().partitionId()
        turn = 0
        for batch in slices(batches, "text", BLOCK_BYTES):
            for at in range(0, batch.num_rows, BLOCK):
                part = batch.slice(at, BLOCK)
                yield from _block(part, maker, task << 32 | turn)
                turn += 1

    return docs.select("id", "text").mapInArrow(apply, DOC.format(kind=kind))


def _block(batch: pa.RecordBatch, maker: Aligner, block: int) -> Iterator[pa.RecordBatch]:
    if len(maker.ids) > KNOWN:
        maker.forget()
    numbers = [own for part in slices(iter([batch]), "text", 2_000_000) for own in maker.numbers(part.column("text").to_pylist())]
    per_chunk = np.array(maker.counts, np.int64).reshape(-1, 5)  # a copy: the array may not grow while it is viewed
    size = np.array([len(own) for own in numbers], np.int64)
    used = np.fromiter(chain.from_iterable(numbers), np.int64, int(size.sum()))
    of_doc = np.repeat(np.arange(len(numbers)), size)
    sums = np.stack([np.bincount(of_doc, weights=c[used], minlength=len(numbers)) for c in per_chunk.T], 1).astype(np.int64)
    whole = (sums[:, 0] == size) & (size > 0)
    sums[~whole] = 0
    found = [
        (*counts, hashlib.sha256("".join(map(maker.texts.__getitem__, own))[:-1].encode()).hexdigest() if same else "")
        for own, counts, same in zip(numbers, sums[:, 1:].tolist(), whole.tolist(), strict=True)
    ]
    used, of_doc = used[whole[of_doc]], of_doc[whole[of_doc]]
    n = batch.num_rows
    counts = [pa.array(c, t) for c, t in zip(zip(*found), [pa.int64()] * 4 + [pa.string()], strict=True)]
    names = ["id", "block", "nth", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pair", "planes"]
    planes_kind = pa.list_(pa.binary())
    yield pa.RecordBatch.from_arrays(
        [batch.column("id"), pa.array([block] * n, pa.int64()), pa.array(range(n), pa.int32()), *counts, pa.nulls(n, pa.int64()), pa.nulls(n, planes_kind)], names=names
    )
    if not len(used):
        return
    # the links of each chunk that is used, once for each time it is, with the document
    distinct = np.unique(used)
    place = np.zeros(len(per_chunk), np.int64)
    place[distinct] = np.arange(len(distinct))
    at = place[used]
    size = per_chunk[distinct, 4]
    start = np.cumsum(size) - size
    flat = np.frombuffer(b"".join(map(maker.links.__getitem__, distinct.tolist())), np.int64)
    pairs, code = np.unique(flat, return_inverse=True)
    many = size[at]
    both = code[np.repeat(start[at], many) + within(many)].astype(np.int64) * n + np.repeat(of_doc, many)
    key, times = np.unique(both, return_counts=True)
    held = list(postings(pairs[key // n], key % n, times))
    for a in range(0, len(held), 20_000):
        part = held[a : a + 20_000]
        m = len(part)
        empty = [pa.nulls(m, t) for t in (pa.int64(),) * 4 + (pa.string(),)]
        yield pa.RecordBatch.from_arrays(
            [pa.nulls(m, batch.column("id").type), pa.array([block] * m, pa.int64()), pa.nulls(m, pa.int32()), *empty,
             pa.array([p for p, _ in part], pa.int64()), pa.array([x for _, x in part], planes_kind)], names=names
        )


def popcount(bitmap: Column) -> Column:
    """How many bits a compressed bitmap has: half the bytes of a list, or those that are set."""
    size = F.octet_length(bitmap)
    return F.when(size % 2 == 0, F.floor(size / 2)).otherwise(F.bitmap_count(F.substring(bitmap, 2, 1 + BLOCK // 8)))


def pair_counts(index: DataFrame) -> DataFrame:
    """``(pair, docs, links, best)``: documents that hold a pair linked, links of it, and whether no other pair of its first id is in more.

    Blocks hold different documents, so their counts add up, partially before the shuffle.
    """
    each = index.select("pair", F.explode(F.transform("planes", lambda p, i: F.struct(p.alias("bitmap"), i.alias("nth")))).alias("b"), F.size("planes").alias("n"))
    count = popcount(F.col("bitmap"))
    weight = F.when(F.col("n") == 1, count).when(F.col("nth") > 0, F.expr("shiftleft(1L, nth - 1)") * count).otherwise(0)
    each = each.select("pair", "b.bitmap", "b.nth", "n")
    counts = each.select("pair", F.when(F.col("nth") == 0, count).otherwise(0).alias("docs"), weight.alias("links"))
    counts = counts.groupBy("pair").agg(F.sum("docs").alias("docs"), F.sum("links").alias("links"))
    counts = stored(counts.withColumn("a", F.shiftright("pair", 32)), "align-counts")
    high = counts.groupBy("a").agg(F.max("docs").alias("high"))
    return counts.join(high, "a").select("pair", "docs", "links", (F.col("docs") == F.col("high")).alias("best"))


def scores(index: DataFrame, counts: DataFrame) -> DataFrame:
    """``(block, nth, n_best, count_sum)``: each posting returns the score of its pair to its documents, by block."""
    scored = index.join(counts.select("pair", "docs", "best"), "pair").select("block", "docs", "best", "planes")

    def apply(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best, total = np.zeros(BLOCK, np.int64), np.zeros(BLOCK, np.int64)
        for batch in batches:
            for docs, high, planes in rows(batch, "docs", "best", "planes"):
                for i, plane in enumerate(planes[1:] or planes):
                    at = members(plane)
                    total[at] += docs << i
                    if high:
                        best[at] += 1 << i
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array([key[0].as_py()] * len(at), pa.int64()), pa.array(at, pa.int32()), pa.array(best[at]), pa.array(total[at])],
            names=["block", "nth", "n_best", "count_sum"],
        )

    return scored.groupBy("block").applyInArrow(apply, "block bigint, nth int, n_best bigint, count_sum bigint")


def align_documents(
    docs: DataFrame, *, byte_file: str = BYTE_FILE, piece_file: str = PIECE_FILE, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """For each row ``(id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256)``.

    A is the byte-level tokenizer, given the text with a blank before it, B the piece
    tokenizer, which adds one itself; special tokens in a text are plain text. Byte offsets
    at which tokens of both end cut them into groups, and all pairs of a group are links. The count
    of a pair is the number of rows that hold it linked; ``n_best`` are the links whose
    count is the highest of their A id, ties included, and ``count_sum`` adds up the counts of a row's links.

    A null or empty text, and one whose tokens do not give back its bytes, has zeros and an
    empty digest. Texts of any length are read whole; repeated rows and rows that share an
    id, or have none, are documents of their own. An empty table gives no rows. Other
    columns are not looked at and not returned.
    """
    given = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    both = stored(aligned(given, byte_file, piece_file), "aligned")
    index = both.filter("pair is not null").select("pair", "block", "planes")
    found = scores(index, stored(pair_counts(index), "align-scores"))
    of_docs = both.filter("pair is null").join(found, ["block", "nth"], "left")
    counts = [F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c) for c in ("n_best", "count_sum")]
    return of_docs.select(F.col("id").alias(id_column), "n_a", "n_b", "n_groups", "n_links", *counts, "groups_sha256")
