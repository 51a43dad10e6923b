"""Quality of whole texts: a regularised quadratic discriminant over document statistics."""

from __future__ import annotations

import functools
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import remainder, slices, unused

STATISTICS = [
    "log_chars", "log_words", "word_length", "word_spread", "distinct_words", "commonest_word", "repeated_neighbours",
    "distinct_pairs", "log_lines", "distinct_lines", "line_words", "capitals", "digits", "signs", "odd_signs", "spaces", "ends",
]


@functools.cache
def _byte_classes() -> np.ndarray:
    """One column for each of: capital, digit, sign, sign that prose seldom has, white space, end of a sentence."""
    kinds = np.zeros((256, 6))
    for b in range(128):
        c = chr(b)
        kinds[b] = [c.isupper(), c.isdigit(), c.isprintable() and not c.isalnum() and c != " ", c in "#$%&*+/<=>@[\\]^_`{|}~!", c.isspace(), c in ".!?"]
    return kinds


def statistics(text: str | None) -> np.ndarray:
    """The transformed statistics of one text: logarithms of counts and of odds, so that their tails are short."""
    text = text or ""
    words = text.split()
    lines = [line for line in text.split("\n") if line.strip()]
    n, chars = len(words), max(1, len(text))
    counts = np.bincount(np.frombuffer(text.encode("utf-8", "replace"), np.uint8), minlength=256) @ _byte_classes()
    seen = Counter(words)
    lengths = np.fromiter(map(len, words), float, n) if n else np.zeros(1)
    same = sum(a == b for a, b in zip(words, words[1:], strict=False))
    pairs = len(set(zip(words, words[1:], strict=False)))

    def odds(part: float, whole: float) -> float:
        return np.log((part + 0.5) / (whole - part + 0.5)) if whole >= part else 0.0

    capitals, digits, signs, odd, spaces, ends = counts
    return np.array([
        np.log1p(len(text)), np.log1p(n), np.log1p(lengths.mean()), np.log1p(lengths.std()), odds(len(seen), n), odds(max(seen.values(), default=0), n), odds(same, n),
        odds(pairs, max(0, n - 1)), np.log1p(len(lines)), odds(len(set(lines)), len(lines)), np.log1p(n / max(1, len(lines))),
        odds(capitals, chars), odds(digits, chars), odds(signs, chars), odds(odd, chars), odds(spaces, chars), odds(ends, chars),
    ])


def with_statistics(docs: DataFrame, *, text_column: str = "text") -> DataFrame:
    """The other columns of ``docs`` and ``stats``; one pass, no shuffle."""
    kept = [c for c in docs.columns if c not in (text_column, "stats")]
    own = unused(kept, "text")

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, own):
            found = [statistics(t).tolist() for t in batch.column(own).to_pylist()]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), pa.array(found, pa.list_(pa.float64()))], names=[*kept, "stats"])

    schema = docs.select(kept).selectExpr("*", "array(0D) as stats").schema
    return docs.select(*kept, F.col(text_column).alias(own)).mapInArrow(apply, schema)


@dataclass
class Discriminant:
    """Per class: log prior, mean, inverse of the Cholesky factor of the covariance, log determinant."""

    center: np.ndarray
    scale: np.ndarray
    classes: list[tuple[float, np.ndarray, np.ndarray, float]]
    temperature: float

    def log_density(self, x: np.ndarray, k: int) -> np.ndarray:
        prior, mean, whiten, log_det = self.classes[k]
        z = ((x - self.center) / self.scale - mean) @ whiten.T
        return prior - 0.5 * (log_det + (z**2).sum(1))

    def score(self, x: np.ndarray) -> np.ndarray:
        gap = (self.log_density(x, 1) - self.log_density(x, 0)) / self.temperature
        return 1 / (1 + np.exp(-np.clip(gap, -35, 35)))


def fit_quality(stats: DataFrame, labels: DataFrame, *, target: str = "quality", shrinkage: float = 0.1, floor: float = 0.01, temperature: float = 4.0, id_column: str = "doc_id") -> Discriminant:
    """Learns from all labelled rows with ``crc32(id) % 3 <> 1``: counts, sums and products per class, added up in Spark.

    A class's covariance is shrunk by ``shrinkage`` towards the diagonal of the pooled one,
    and ``floor`` is added to its diagonal, so its factor exists for any number of rows. A
    class without rows takes the pooled mean, and all scores follow from the priors.
    ``temperature`` flattens the scores, which are products over dependent statistics; it
    moves none across 0.5.
    """
    d = len(STATISTICS)
    known = labels.filter((remainder(id_column, 3) != 1) & F.col(target).isin(0, 1)).select(F.col(id_column).alias("_label"), F.col(target).cast("int").alias("y"))
    rows = stats.select(F.col(id_column).alias("_id"), "stats").join(known, F.col("_id") == F.col("_label")).select("y", "stats")

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, d + 1, d + 1))
        for batch in batches:
            y = batch.column("y").to_numpy()
            x = np.column_stack([np.ones(len(y)), batch.column("stats").flatten().to_numpy().reshape(len(y), d)])
            for k in (0, 1):
                total[k] += x[y == k].T @ x[y == k]
        k, i, j = (a.ravel() for a in np.indices(total.shape))
        yield pa.RecordBatch.from_pydict({"k": k.astype(np.int32), "i": i.astype(np.int32), "j": j.astype(np.int32), "v": total.ravel()})

    total = np.zeros((2, d + 1, d + 1))
    for r in rows.mapInArrow(moments, "k int, i int, j int, v double").groupBy("k", "i", "j").agg(F.sum("v").alias("v")).collect():  # 2 (d + 1)^2 rows
        total[r["k"], r["i"], r["j"]] = r["v"]

    def spread(t: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        n = t[0, 0]
        mean = t[0, 1:] / max(n, 1)
        return n, mean, t[1:, 1:] / max(n, 1) - np.outer(mean, mean)

    n, center, pooled = spread(total.sum(0))
    scale = np.sqrt(np.maximum(np.diag(pooled), 1e-8)) if n else np.ones(d)
    diagonal = np.diag(pooled) / scale**2 if n else np.ones(d)
    classes = []
    for t in total:
        m, mean, cov = spread(t)
        own = (1 - shrinkage) * cov / np.outer(scale, scale) + shrinkage * np.diag(diagonal) if m > 1 else np.diag(diagonal)
        factor = np.linalg.cholesky(own + floor * np.eye(d))
        classes.append((np.log((m + 1) / (n + 2)), (mean - center) / scale if m else np.zeros(d), np.linalg.inv(factor), 2 * np.log(np.diag(factor)).sum()))
    return Discriminant(center, scale, classes, temperature)


def score_quality(stats: DataFrame, model: Discriminant) -> DataFrame:
    """The other columns of ``stats``, ``score`` and ``predicted``.

    A null text was counted as empty and has a score like any other; repeated rows stay.
    """
    kept = [c for c in stats.columns if c not in ("stats", "score", "predicted")]

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column("stats").flatten().to_numpy().reshape(batch.num_rows, len(STATISTICS))
            score = model.score(x)
            out = [*(batch.column(c) for c in kept), pa.array(score), pa.array((score >= 0.5).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(out, names=[*kept, "score", "predicted"])

    schema = stats.select(kept).schema.add("score", "double").add("predicted", "integer")
    return stats.select(*kept, "stats").mapInArrow(apply, schema)
