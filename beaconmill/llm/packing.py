"""Token sequences of bounded length from documents: bounded-space online packing."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import rows, slices, stored
from .words import words_of

PIECE = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint"
COLUMNS = [c.split()[0] for c in PIECE.split(", ")]
OPEN = f"{PIECE}, part bigint, ids binary"


class Packer:
    """Windows of ``size`` tokens, of which at most ``windows`` are open.

    A piece goes into the open window that it leaves fullest. If none has room, the
    fullest is emitted: a gap of at least ``slack`` tokens is first filled with the head of
    the piece, a smaller one is left to padding.
    """

    def __init__(self, first_id: int, size: int, windows: int, slack: int):
        self.size, self.windows, self.slack = size, windows, slack
        self.next_id, self.open, self.done = first_id, [], []

    def add(self, doc_id, start: int, ids: bytes, doc_tokens: int) -> None:
        while len(ids) >= 4 * self.size:
            self.emit([0, [(doc_id, start, ids[: 4 * self.size], doc_tokens)]])
            start, ids = start + self.size, ids[4 * self.size :]
        while n := len(ids) // 4:
            fit = max((w for w in self.open if w[0] + n <= self.size), key=lambda w: w[0], default=None)
            if fit is None and len(self.open) < self.windows:
                self.open.append(fit := [0, []])
            if fit is not None:
                self.put(fit, (doc_id, start, ids, doc_tokens))
                return
            fullest = max(self.open, key=lambda w: w[0])
            gap = self.size - fullest[0]
            if gap >= self.slack:
                self.put(fullest, (doc_id, start, ids[: 4 * gap], doc_tokens))
                start, ids = start + gap, ids[4 * gap :]
            else:
                self.close(fullest)

    def put(self, window: list, piece: tuple) -> None:
        window[0] += len(piece[2]) // 4
        window[1].append(piece)
        if window[0] == self.size:
            self.close(window)

    def close(self, window: list) -> None:
        self.open = [w for w in self.open if w is not window]
        self.emit(window)

    def emit(self, window: list) -> None:
        at = 0
        for doc_id, start, ids, doc_tokens in window[1]:
            n = len(ids) // 4
            self.done.append((doc_id, start, n, zlib.crc32(ids), doc_tokens, self.next_id, at, None, None))
            at += n
        self.next_id += 1

    def finish(self) -> None:
        """Closes what is open: whole windows, and the rest in windows whose lengths are powers of two, which need no padding."""
        rest = [p for w in self.open for p in w[1]]
        self.open = []
        left = sum(len(p[2]) // 4 for p in rest)
        while left:
            room = self.size if left >= self.size else 1 << (left.bit_length() - 1)
            left -= room
            window: list = [room, []]
            while room:
                doc_id, start, ids, doc_tokens = rest.pop(0)
                n = min(room, len(ids) // 4)
                window[1].append((doc_id, start, ids[: 4 * n], doc_tokens))
                if 4 * n < len(ids):
                    rest.insert(0, (doc_id, start + n, ids[4 * n :], doc_tokens))
                room -= n
            self.emit(window)

    def taken(self, part: int | None = None) -> list[tuple]:
        """What is finished; with ``part`` also the pieces of open windows, with their ids."""
        out, self.done = self.done, []
        for window in self.open if part is not None else []:
            out += [(d, s, len(ids) // 4, zlib.crc32(ids), n, None, None, part, ids) for d, s, ids, n in window[1]]
        return out


def _batch(found: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*found, strict=True)) if found else [[]] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


SCHEMA = pa.schema([*((c, pa.int64()) for c in [*COLUMNS, "part"]), ("ids", pa.binary())])


def pack(
    docs: DataFrame,
    *,
    tokenizer: str | None = None,
    end_id: int = 2,
    size: int = 4096,
    windows: int = 16,
    slack: int = 32,
    fan: int = 32,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """One row for each piece of a document in a sequence of at most ``size`` tokens.

    A document is the ids of its text (null: empty) and ``end_id``. Each partition packs
    its documents as they come, with ``windows`` open at a time. What is open at the end of
    a partition is merged, ``fan`` partitions at a time and with the same rule, until one
    group is left; its rest is cut into windows of a power of two. A task holds one batch
    and its open windows; a merge holds ``fan * windows`` windows.

    Repeated rows are packed once each; a null id stays null. No rows give no pieces. Other
    columns of ``docs`` are ignored.
    """
    path = tokenizer or public_tokenizers.path("word_bpe_49k.json")
    end = np.array([end_id], dtype="<u4").tobytes()

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        words, packer = words_of(path), Packer(part << 32, size, windows, slack)
        for batch in slices(batches, "text"):
            for doc_id, text in rows(batch, "id", "text"):
                ids = words.encode(text or "") + end
                packer.add(doc_id, 0, ids, len(ids) // 4)
            yield _batch(packer.taken(), SCHEMA)
        yield _batch(packer.taken(part), SCHEMA)

    def merge(level: int, last: bool):
        def of_group(table: pa.Table) -> pa.Table:
            table = table.sort_by([(c, "ascending") for c in ("part", "doc_id", "start", "ids_crc32")])
            group = table.column("group")[0].as_py()
            packer = Packer(level << 57 | group << 32, size, windows, slack)
            for piece in rows(table, "doc_id", "start", "ids", "doc_tokens"):
                packer.add(*piece)
            if last:
                packer.finish()
            return pa.Table.from_batches([_batch(packer.taken(group), SCHEMA)])

        return of_group

    chosen = docs.select(F.col(id_column).cast("bigint").alias("id"), F.col(text_column).alias("text"))
    step = stored(chosen.mapInArrow(first, OPEN), "packing")
    parts, level = (step.agg(F.max("part")).first()[0] or 0) + 1, 0
    done = step.filter("ids is null")
    while True:
        level += 1
        parts = -(-parts // fan)
        left = step.filter("ids is not null").withColumn("group", F.floor(F.col("part") / fan).cast("bigint"))
        step = stored(left.groupBy("group").applyInArrow(merge(level, parts <= 1), OPEN), "packing")
        done = done.unionByName(step.filter("ids is null"))
        if parts <= 1:
            return done.select(COLUMNS)
