"""Byte-pair encoding and decoding over a table of distinct words."""

from __future__ import annotations

import hashlib
import math
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import rows, stored
from .words import words_of

BLOCK_CHARS = 4_000_000
WORDS_A_PART = 2_000_000


def common_words(docs: DataFrame, path: str, most: int, text_column: str = "text") -> tuple[DataFrame, int]:
    """``(word, ids)`` of words that make up at least one in ``most`` of all, and the number of all words.

    There can be no more than ``most`` of them. What is that common in the corpus is so in
    a task, so each task counts all its words, but sends only those that are common in it.
    """
    spark = docs.sparkSession

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, counts, given_up = words_of(path), Counter(), 0
        for texts in _blocks(batches, ["text"]):
            found = [w for (text,) in texts for w in words.split(text or "")]
            counts.update(found)
            if len(counts) > 4 * most:  # what has been rare so far is given up, it can only be counted too low
                all_so_far = counts.total() + given_up
                counts = Counter({w: n for w, n in counts.items() if n >= all_so_far / most})
                given_up = all_so_far - counts.total()
        total = counts.total() + given_up
        kept = [(w, n) for w, n in counts.items() if n >= total / most]
        kept.append((None, total))
        yield pa.RecordBatch.from_pydict({"word": pa.array([w for w, _ in kept], pa.string()), "n": pa.array([n for _, n in kept], pa.int64())})

    counted = docs.select(F.col(text_column).alias("text")).mapInArrow(count, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    counted = stored(counted, "words")
    total = counted.filter("word is null").agg(F.sum("n")).first()[0] or 0
    table = counted.filter(F.col("word").isNotNull() & (F.col("n") >= math.ceil(total / most)))
    return table.mapInArrow(_encoder(path), "word string, ids binary"), total


def _encoder(path: str):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = words_of(path)
        for batch in batches:
            ids = [np.array(words.encode_word(w), "<u4").tobytes() for w in batch.column("word").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("word"), pa.array(ids, pa.binary())], names=["word", "ids"])

    return encode


def _blocks(batches: Iterator[pa.RecordBatch], columns: list[str], most: int = BLOCK_CHARS) -> Iterator[list[tuple]]:
    """Successive rows with about ``most`` characters of text, the last of the columns, or with one longer text."""
    block, size = [], 0
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            for row in rows(batch.slice(at, 256), *columns):
                n = len(row[-1] or "")
                if block and size + n > most:
                    yield block
                    block, size = [], 0
                block.append(row)
                size += n
    if block:
        yield block


class Common:
    """The common words' places and ids, in one table."""

    def __init__(self, words: pa.Table):
        self.place = {w: i for i, w in enumerate(words.column("word").to_pylist())}
        self.ids = words.column("ids").combine_chunks()


RESULT = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
ENCODED = "doc_id bigint, ids binary"


def encode_documents(
    docs: DataFrame,
    *,
    tokenizer: str | None = None,
    most_common: int = 1 << 20,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """``(doc_id, ids)``: the ids of each whole text, little-endian unsigned 32-bit numbers.

    Texts are split into words in Spark, and each distinct word is encoded once. A word that
    makes up at least one in ``most_common`` of all words is common: there can be no more
    than ``most_common`` of them, so their ids are broadcast. All others are dealt out by
    the word, encoded where the same words meet, and their ids joined to the blocks of
    documents that hold them, where all ids are put back by position. A block is a run of
    documents with about four million characters, or one longer document.

    A null text is empty and has no ids. Repeated rows are encoded each; a null id stays
    null. No rows give none.
    """
    path = tokenizer or public_tokenizers.path("byte_bpe_50k.json")
    chosen = docs.select(F.col(id_column).cast("bigint").alias("id"), F.col(text_column).alias("text"))
    table, total = common_words(chosen, path, most_common)
    common = docs.sparkSession.sparkContext.broadcast(Common(table.toArrow()))
    parts = max(16, total // WORDS_A_PART)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[tuple], list[str], np.ndarray, np.ndarray, list[int]]]:
        """Blocks as their documents, their distinct words, each word's place among the common ones, and all words in order."""
        part, words = TaskContext.get().partitionId(), words_of(path)
        place = common.value.place
        for n, block in enumerate(_blocks(batches, ["id", "text"])):
            order: dict[str, int] = {}
            codes, sizes = [], []
            for _, text in block:
                found = words.split(text or "")
                sizes.append(len(found))
                codes.append(np.fromiter((order.setdefault(w, len(order)) for w in found), np.int32, len(found)))
            known = np.fromiter((place.get(w, -1) for w in order), np.int32, len(order))
            yield part << 32 | n, [d for d, _ in block], list(order), known, np.concatenate(codes), sizes

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, ids, _, known, codes, sizes in cut(batches):
            yield pa.RecordBatch.from_pydict({
                "block": [number], "docs": pa.array([ids], pa.list_(pa.int64())), "sizes": pa.array([sizes], pa.list_(pa.int64())),
                "known": [zstandard.compress(_planes(known), 3)], "codes": [zstandard.compress(_planes(codes), 3)],
            })

    def rare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The rare words of each block, a row for each part of all words that they fall in."""
        task, words, place = TaskContext.get().partitionId(), words_of(path), common.value.place
        for n, block in enumerate(_blocks(batches, ["id", "text"])):
            number, by_part = task << 32 | n, {}
            order = dict.fromkeys(chain.from_iterable(words.split(text or "") for _, text in block))  # as in ``cut``
            for at, word in enumerate(order):
                if word not in place:
                    by_part.setdefault(zlib.crc32(word.encode()) % parts, []).append((word, at))
            found = [(p, sorted(pairs)) for p, pairs in sorted(by_part.items())]
            yield pa.RecordBatch.from_pydict({
                "part": pa.array([p for p, _ in found], pa.int64()), "block": pa.array([number] * len(found), pa.int64()),
                "at": pa.array([zstandard.compress(_planes(np.array([a for _, a in w], np.int32)), 1) for _, w in found], pa.binary()),
                "words": pa.array([_packed(pa.array([x for x, _ in w], pa.string())) for _, w in found], pa.binary()),
            })

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows of one part follow each other, so each of its distinct words is encoded once."""
        words, part, known = words_of(path), None, {}
        for batch in batches:
            out = []
            for p, packed in rows(batch, "part", "words"):
                if p != part:
                    part, known = p, {}
                found = _unpacked(packed).to_pylist()
                for w in found:
                    if w not in known:
                        known[w] = np.array(words.encode_word(w), "<u4").tobytes()
                out.append(_packed(pa.array([known[w] for w in found], pa.binary())))
            yield pa.RecordBatch.from_arrays([batch.column("block"), batch.column("at"), pa.array(out, pa.binary())], names=["block", "at", "ids"])

    asked = chosen.mapInArrow(rare, "part bigint, block bigint, at binary, words binary")
    given = asked.repartition("part").sortWithinPartitions("part").mapInArrow(encode, "block bigint, at binary, ids binary")
    held = chosen.mapInArrow(blocks, "block bigint, docs array<bigint>, sizes array<bigint>, known binary, codes binary")

    def together(block: pa.Table, words: pa.Table) -> pa.Table:
        known = _unplaned(zstandard.decompress(block.column("known")[0].as_py()))
        codes = _unplaned(zstandard.decompress(block.column("codes")[0].as_py()))
        # ids of the block's words: the common ones in order of their places, then the rare ones
        is_known = known >= 0
        spots = np.full(len(known), -1, np.int64)
        spots[is_known] = np.arange(is_known.sum())
        ids, n = [common.value.ids.take(pa.array(known[is_known]))], int(is_known.sum())
        for at, packed in zip(words.column("at").to_pylist(), words.column("ids").to_pylist(), strict=True):
            at = _unplaned(zstandard.decompress(at))
            ids.append(_unpacked(packed))
            spots[at] = n + np.arange(len(at))
            n += len(at)
        ids = pa.concat_arrays(ids)
        out, at = [], 0
        for n in block.column("sizes")[0].as_py():
            out.append(_joined(ids, spots[codes[at : at + n]]))
            at += n
        return pa.table({"doc_id": block.column("docs")[0].values, "ids": pa.array(out, pa.binary())})

    return held.groupBy("block").cogroup(given.groupBy("block")).applyInArrow(together, ENCODED)


def _packed(values: pa.Array) -> bytes:
    sink = pa.BufferOutputStream()
    batch = pa.RecordBatch.from_arrays([values], names=["v"])
    with pa.ipc.new_stream(sink, batch.schema) as writer:
        writer.write_batch(batch)
    return zstandard.compress(sink.getvalue(), 1)


def _unpacked(data: bytes) -> pa.Array:
    return pa.ipc.open_stream(zstandard.decompress(data)).read_all().column("v").combine_chunks()


def _planes(codes: np.ndarray) -> bytes:
    """The numbers byte by byte, all low bytes first, which compresses better."""
    return codes.astype("<i4").view(np.uint8).reshape(-1, 4).T.tobytes()


def _unplaned(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(4, -1).T).view("<i4").ravel()


def _joined(values: pa.Array, at: np.ndarray) -> bytes:
    """The binary values at these places, one after the other."""
    if not len(at):
        return b""
    taken = values.take(pa.array(at))
    offsets = np.frombuffer(taken.buffers()[1], np.int32)
    return taken.buffers()[2][int(offsets[taken.offset]) : int(offsets[taken.offset + len(at)])].to_pybytes()


class Pieces:
    """What each id stands for, in a table that is as long as the vocabulary."""

    def __init__(self, path: str):
        pieces = words_of(path).pieces()
        self.bytes = pa.array(pieces, pa.binary())
        self.decimal = pa.array([f"{i},".encode() for i in range(len(pieces))], pa.binary())


_PIECES: dict[str, Pieces] = {}


def pieces_of(path: str) -> Pieces:
    if path not in _PIECES:
        _PIECES[path] = Pieces(path)
    return _PIECES[path]


def decode_ids(ids: bytes, path: str) -> str:
    """The text of ids: their pieces joined; what is no UTF-8 becomes U+FFFD. Ids beyond the vocabulary are skipped."""
    at = np.frombuffer(ids, "<u4").astype(np.int64)
    pieces = pieces_of(path).bytes
    return _joined(pieces, at[at < len(pieces)]).decode("utf-8", "replace")


def digests(encoded: DataFrame, *, tokenizer: str | None = None) -> DataFrame:
    """Each document's number of ids, and the SHA-256 of its ids in decimal and of its decoded text; no shuffle."""
    path = tokenizer or public_tokenizers.path("byte_bpe_50k.json")

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decimal = pieces_of(path).decimal
        for batch in batches:
            n, a, b = [], [], []
            for (ids,) in rows(batch, "ids"):
                at = np.frombuffer(ids, "<u4").astype(np.int64)
                n.append(len(at))
                a.append(hashlib.sha256(_joined(decimal, at)[:-1]).hexdigest())
                b.append(hashlib.sha256(decode_ids(ids, path).encode()).hexdigest())
            out = [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(a, pa.string()), pa.array(b, pa.string())]
            yield pa.RecordBatch.from_arrays(out, names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return encoded.mapInArrow(apply, RESULT)
