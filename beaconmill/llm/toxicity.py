"""Toxicity of whole texts: a factorization machine over hashed terms."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import remainder, rows, share, slices

TERM = re.compile(r"[^\W\d_]+")


STEM = 4


def words(text: str | None) -> list[str]:
    return TERM.findall((text or "").lower())


def hashed(word: str, bits: int) -> tuple[int, ...]:
    """The buckets of a word's terms: the word itself and, if it is longer, its stem."""
    terms = (word, f"{word[:STEM]}*") if len(word) > STEM else (word,)
    return tuple(xxhash.xxh64_intdigest(t.encode("utf-8", "surrogatepass"), 7) >> (64 - bits) for t in terms)


@dataclass
class Machine:
    """``bias + w.x + sum of <v_i, v_j> x_i x_j over pairs``, over the columns of ``buckets``."""

    buckets: np.ndarray
    bias: float
    linear: np.ndarray
    factors: np.ndarray

    def margin(self, x: np.ndarray) -> np.ndarray:
        mixed = x @ self.factors
        return self.bias + x @ self.linear + 0.5 * (mixed**2 - (x**2) @ self.factors**2).sum(1)

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(x).astype(float), -40, 40)))


@dataclass
class Sparse:
    """Rows of a design: the columns of row ``i`` and their values lie from ``starts[i]`` to ``starts[i + 1]``."""

    starts: np.ndarray
    columns: np.ndarray
    values: np.ndarray

    def __len__(self) -> int:
        return len(self.starts) - 1

    def part(self, rows_: np.ndarray) -> Sparse:
        size = np.diff(self.starts)[rows_]
        starts = np.concatenate([[0], np.cumsum(size)])
        at = np.arange(starts[-1]) - np.repeat(starts[:-1] - self.starts[rows_], size)
        return Sparse(starts, self.columns[at], self.values[at])

    def sums(self, of: np.ndarray) -> np.ndarray:
        """The sum over each row of a number, or a vector, for each entry."""
        total = np.concatenate([np.zeros((1, *of.shape[1:])), np.cumsum(of, 0, dtype=np.float64)])
        return total[self.starts[1:]] - total[self.starts[:-1]]


def margins(machine: Machine, x: Sparse) -> tuple[np.ndarray, np.ndarray]:
    """The margin of each row, and its sum of factors."""
    weighted = machine.factors[x.columns] * x.values[:, None]
    mixed = x.sums(weighted)
    return machine.bias + x.sums(machine.linear[x.columns] * x.values) + 0.5 * (mixed**2 - x.sums(weighted**2)).sum(1), mixed


def scores(machine: Machine, x: Sparse) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(margins(machine, x)[0], -40, 40)))


def fit_machine(
    x: Sparse,
    y: np.ndarray,
    buckets: np.ndarray,
    rank: int,
    epochs: int = 12,
    batch: int = 256,
    rate: float = 0.5,
    lasso: float = 1.3,
    least: int = 20,
    factor_rate: float = 0.05,
    factor_ridge: float = 10.0,
    factor_start: float = 300.0,
    balance: float = 1.0,
) -> Machine:
    """Logistic loss by minibatches over all columns; order and start are fixed.

    Linear weights follow the regularised leader, with a lasso of ``lasso`` times the root of
    the number of rows: a column has a weight once its gradients add up to more than chance
    would, so that the many columns of a few rows do not learn these by heart. Columns of at least ``least``
    rows have factors too, which move by AdaGrad from a small start, slowly and held
    by a ridge: pairs say what weights leave open. The rarer class weighs more: at ``balance``
    1 both weigh the same in total, at 0 each row does.
    """
    n, d = len(x), len(buckets)
    m = Machine(buckets, 0.0, np.zeros(d, np.float32), np.zeros((d, rank), np.float32))
    if not n or not d:
        base = np.clip(y.mean(), 1e-3, 1 - 1e-3)
        m.bias = float(np.log(base / (1 - base)))
        return m
    weight = np.ones(n)
    if 0 < y.sum() < n:
        weight = np.where(y == 1, ((n - y.sum()) / y.sum()) ** balance, 1.0)
        weight /= weight.mean()
    rng = np.random.default_rng(11)
    often = np.bincount(x.columns, minlength=d) >= least
    m.factors[often] = rng.normal(0, 0.02, (int(often.sum()), rank))
    lead, squares, bound = np.zeros(d), np.zeros(d), lasso * n**0.5
    moved, bias_moved = np.full((d, rank), factor_start, np.float32), 1.0

    def summed(columns: np.ndarray, of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        distinct, local = np.unique(columns, return_inverse=True)
        return distinct, np.stack([np.bincount(local, c, len(distinct)) for c in of.T], 1)

    for _ in range(epochs):
        order = rng.permutation(n)
        for at in range(0, n, batch):
            part = x.part(order[at : at + batch])
            margin, mixed = margins(m, part)
            error = weight[order[at : at + batch]] * (1 / (1 + np.exp(-np.clip(margin, -40, 40))) - y[order[at : at + batch]])
            of_row = np.repeat(np.arange(len(part)), np.diff(part.starts))
            push = error[of_row] * part.values
            columns, slope = summed(part.columns, push[:, None])
            slope = slope[:, 0]
            longer = np.sqrt(squares[columns] + slope**2)
            lead[columns] += slope - (longer - np.sqrt(squares[columns])) / rate * m.linear[columns]
            squares[columns] += slope**2
            z = lead[columns]
            m.linear[columns] = np.where(np.abs(z) <= bound, 0, -(z - np.sign(z) * bound) / ((1 + longer) / rate + 1))
            paired = often[part.columns]
            if paired.any():
                own = part.columns[paired]
                toward = push[paired, None] * (mixed[of_row[paired]] - part.values[paired, None] * m.factors[own])
                columns, slopes = summed(own, toward)
                slopes += factor_ridge * m.factors[columns]
                moved[columns] += slopes**2
                m.factors[columns] -= factor_rate * slopes / np.sqrt(moved[columns])
            bias_moved += error.sum() ** 2
            m.bias -= 0.1 * error.sum() / bias_moved**0.5
    told = (m.linear != 0) | often
    return Machine(buckets[told], m.bias, m.linear[told], m.factors[told])


def training_labels(labels: DataFrame, target: str, most: int, id_column: str = "doc_id") -> DataFrame:
    """Labels to learn from: ``crc32(id) % 3 <> 1``, a label of 0 or 1, and at most about ``most`` rows.

    The rows are chosen by a hash of the id, so that the same ones are chosen in every run.
    """
    usable = labels.filter((remainder(id_column, 3) != 1) & F.col(target).isin(0, 1)).select(
        F.col(id_column).alias("label_id"), F.col(target).cast("int").alias("y")
    )
    n = usable.count()
    return usable.filter(share(F.col("label_id"), most / n)) if n > most else usable


def fit_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    *,
    target: str = "toxic",
    max_train: int = 20_000,
    bits: int = 20,
    rank: int = 8,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> Machine:
    """Learns from a bounded sample of labelled rows (``max_train``); its size is proven, so it is broadcast.

    All hashed terms of the sample are columns of the machine, so that pairs of terms tell which
    tell nothing alone; ``bits`` bounds their number. Spark counts them for each row, and the
    sparse rows of the sample are fitted on the driver. Without both classes in the sample it
    learns a constant.
    """
    known = training_labels(labels, target, max_train, id_column)
    sample = docs.select(F.col(id_column).alias("label_id"), F.col(text_column).alias("text")).join(F.broadcast(known), "label_id").select("y", "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Columns(None, bits)
        for batch in slices(batches, "text", 2_000_000):
            x = design(batch.column("text").to_pylist(), 1 << bits, known)
            parts = [(x.columns[a:b].astype(np.int32).tobytes(), x.values[a:b].astype(np.float32).tobytes()) for a, b in zip(x.starts, x.starts[1:])]
            keys = [xxhash.xxh3_64_intdigest(a + b) >> 1 for a, b in parts]
            columns = [pa.array(keys, pa.int64()), pa.array([a for a, _ in parts], pa.binary()), pa.array([b for _, b in parts], pa.binary())]
            yield pa.RecordBatch.from_arrays([batch.column("y"), *columns], names=["y", "key", "at", "x"])

    table = sample.mapInArrow(count, "y int, key bigint, at binary, x binary").toArrow()
    y, key = (table.column(c).to_numpy() for c in ("y", "key"))
    if not len(y) or y.min() == y.max():
        constant = float(y.mean()) if len(y) else 0.0
        return fit_machine(Sparse(np.zeros(1, np.int64), np.zeros(0, np.int64), np.zeros(0)), np.array([constant]), np.zeros(0, np.int64), rank)
    order = np.lexsort((key, y)).tolist()  # the rows arrive in any order, sums must not depend on it
    at, x = ([np.frombuffer(b.as_buffer(), kind) for b in table.column(c)] for c, kind in (("at", np.int32), ("x", np.float32)))
    starts = np.concatenate([[0], np.cumsum([len(at[i]) for i in order])])
    columns, values = (np.concatenate([part[i] for i in order]) for part in (at, x))
    del table, at, x
    place = np.zeros(1 << bits, np.int32)
    place[columns] = 1
    buckets = np.flatnonzero(place)
    place[buckets] = np.arange(len(buckets), dtype=np.int32)
    return fit_machine(Sparse(starts, place[columns], values), y[order].astype(float), buckets, rank)


class Columns(dict):
    """The columns of a word, the buckets themselves where none are given; the words met so far are kept up to a bound."""

    def __init__(self, buckets: np.ndarray | None, bits: int, most: int = 300_000):
        super().__init__()
        self.place = None if buckets is None else dict(zip(buckets.tolist(), range(len(buckets))))
        self.bits, self.most = bits, most

    def __missing__(self, word: str) -> tuple[int, ...]:
        if len(self) > self.most:
            self.clear()
        at = hashed(word, self.bits)
        if self.place is not None:
            at = tuple(self.place[b] for b in at if b in self.place)
        self[word] = at
        return at


def design(texts: list[str | None], width: int, known: Columns) -> Sparse:
    """``log(1 + count)`` of each column's terms, a sparse row for each text."""
    found = [list(chain.from_iterable(map(known.__getitem__, words(text)))) if text else [] for text in texts]
    size = [len(f) for f in found]
    flat = np.fromiter(chain.from_iterable(found), np.int64, sum(size))
    key, times = np.unique(np.repeat(np.arange(len(texts)), size) * width + flat, return_counts=True)
    return Sparse(np.searchsorted(key, np.arange(len(texts) + 1) * width), key % width, np.log1p(times))


def score_toxicity(docs: DataFrame, machine: Machine, *, bits: int = 20, threshold: float = 0.7, text_column: str = "text") -> DataFrame:
    """``docs`` with ``score`` and ``predicted``; one pass, no shuffle.

    A null text counts as empty and, like a text of unknown terms, gets the score of no
    term at all. Repeated rows stay. Columns of ``docs`` named ``score`` or ``predicted``
    are replaced.
    """
    kept = [c for c in docs.columns if c not in ("score", "predicted")]
    schema = docs.select(kept).schema.add("score", "double").add("predicted", "integer")

    held = docs.sparkSession.sparkContext.broadcast(machine)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = held.value
        known = Columns(machine.buckets, bits)
        for batch in slices(batches, text_column, 2_000_000):
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                score = scores(machine, design(part.column(text_column).to_pylist(), max(1, len(machine.buckets)), known))
                out = [*part.columns, pa.array(score), pa.array((score >= threshold).astype(np.int32))]
                yield pa.RecordBatch.from_arrays(out, names=[*kept, "score", "predicted"])

    return docs.select(kept).mapInArrow(apply, schema)
