"""Language of whole texts as mixtures: language proportions by expectation maximisation."""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import remainder, share, slices, unused

BITS = 15
UNKNOWN = "und"


@functools.cache
def _letters() -> np.ndarray:
    """For each code point its lower-case letter, or a space for what is no letter."""
    table = np.full(0x110000, 32, np.uint32)
    for c in range(0x110000):
        if chr(c).isalpha():
            low = chr(c).lower()
            table[c] = ord(low) if len(low) == 1 else c
    return table


def gram_counts(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Hashed letter trigrams of a text and how often each occurs; words are set apart by one space."""
    if not text:
        return np.zeros(0, np.int64), np.zeros(0)
    codes = _letters()[np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)]
    if not (codes != 32).any():
        return np.zeros(0, np.int64), np.zeros(0)
    codes = np.concatenate([[32], codes, [32]]).astype(np.uint32)
    codes = codes[(codes != 32) | np.concatenate([[True], codes[:-1] != 32])]
    hashes = codes[:-2] * np.uint32(0x9E3779B1) + codes[1:-1] * np.uint32(0x85EBCA77) + codes[2:] * np.uint32(0xC2B2AE3D)
    hashes ^= hashes >> np.uint32(15)
    grams = (hashes * np.uint32(0x2C1B3C6D)) >> np.uint32(32 - BITS)
    if len(grams) > 1 << 13:
        counts = np.bincount(grams, minlength=1 << BITS)
        found = np.flatnonzero(counts)
        return found, counts[found].astype(float)
    found, counts = np.unique(grams, return_counts=True)
    return found.astype(np.int64), counts.astype(float)


@dataclass
class Languages:
    """``log_p[g, l]``: how likely trigram ``g`` is in language ``l``."""

    names: list[str]
    log_p: np.ndarray

    def proportions(self, grams: np.ndarray, counts: np.ndarray, penalty: float = 1.0, rounds: int = 8) -> np.ndarray:
        """The shares of the languages in one text, 0 for those that its set of languages leaves out.

        Languages join the set in the order of their shares among all, as long as the
        likelihood of the text grows by more than half the logarithm of its length for each,
        times an eighth of the root of its length where that is over one: the trigrams of a
        text are not independent, and by chance a second language gains more the longer it is.
        """
        n, k = counts.sum(), len(self.names)
        log_p = self.log_p[grams]
        top = log_p.max(1)
        p = np.exp(log_p - top[:, None])

        def fit(q: np.ndarray, steps: int) -> tuple[np.ndarray, float]:
            pi = np.full(q.shape[1], 1 / q.shape[1])
            for _ in range(steps):
                weight = q * pi
                whole = weight.sum(1)
                pi = (counts / whole) @ weight / n
            return pi, float(counts @ np.log(np.maximum(q @ pi, 1e-300)))

        order = np.argsort(-fit(p, rounds)[0], kind="stable")
        chosen, best = np.ones(1), float(counts @ np.log(np.maximum(p[:, order[0]], 1e-300)))
        for size in range(2, k + 1):
            pi, value = fit(p[:, order[:size]], rounds)
            if value - best <= penalty * 0.5 * np.log(n + 1) * max(1.0, np.sqrt(n) / 8):
                break
            chosen, best = pi, value
        out = np.zeros(k)
        out[order[: len(chosen)]] = chosen
        return out


def fit_languages(docs: DataFrame, *, max_docs: int = 4000, smoothing: float = 0.3, id_column: str = "doc_id", text_column: str = "text", lang_column: str = "lang") -> Languages:
    """Learns from documents with a language and ``crc32(id) % 5 <> 0``, at most about ``max_docs`` of each language.

    They are chosen by a hash of the id. Trigrams are counted per task and added up in
    Spark; the driver gets at most ``2 ** 15`` sums for each language.
    """
    usable = docs.select(F.col(id_column).alias("id"), F.col(lang_column).cast("string").alias("lang"), F.col(text_column).alias("text")).filter((remainder(id_column, 5) != 0) & F.col("lang").isNotNull())
    sizes = {r["lang"]: r["count"] for r in usable.groupBy("lang").count().collect()}  # one row for each language
    names = sorted(sizes)
    wanted = F.lit(False)
    for name in names:
        wanted = wanted | ((F.col("lang") == name) & share(F.col("id"), max_docs / sizes[name]))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        for batch in slices(batches, "text"):
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True):
                grams, counts = gram_counts(text)
                total.setdefault(lang, np.zeros(1 << BITS))[grams] += counts
        for lang, sums in sorted(total.items()):
            at = np.flatnonzero(sums)
            yield pa.RecordBatch.from_pydict({"lang": pa.array([lang] * len(at), pa.string()), "gram": pa.array(at, pa.int32()), "n": pa.array(sums[at].astype(np.int64))})

    sums = np.zeros((1 << BITS, len(names)))
    if names:
        counted = usable.filter(wanted).select("lang", "text").mapInArrow(count, "lang string, gram int, n bigint").groupBy("lang", "gram").agg(F.sum("n").alias("n")).toPandas()
        sums[counted["gram"].to_numpy(), [names.index(x) for x in counted["lang"]]] = counted["n"].to_numpy()
    p = (sums + smoothing) / (sums.sum(0) + smoothing * (1 << BITS))
    return Languages(names, np.log(p))


def predict_language(docs: DataFrame, model: Languages, *, text_column: str = "text") -> DataFrame:
    """``docs`` without the text, and ``lang_pred``, ``score`` and ``shares``: one pass, no shuffle.

    ``score`` is the predicted language's share of the text, ``shares`` holds those of all
    languages found in it. A null text, one without a letter, and any text when no language
    was learned are ``und`` with score 0. Repeated rows stay; columns of ``docs`` with one of
    these names are replaced.
    """
    kept = [c for c in docs.columns if c not in (text_column, "lang_pred", "score", "shares")]
    own = unused(kept, "text")

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, own):
            langs, scores, shares = [], [], []
            for text in batch.column(own).to_pylist():
                grams, counts = gram_counts(text)
                if not len(grams) or not model.names:
                    langs.append(UNKNOWN), scores.append(0.0), shares.append([])
                    continue
                pi = model.proportions(grams, counts)
                best = int(pi.argmax())
                langs.append(model.names[best]), scores.append(min(1.0, float(pi[best])))
                shares.append([(model.names[i], float(pi[i])) for i in np.flatnonzero(pi)])
            out = [*(batch.column(c) for c in kept), pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array(shares, pa.map_(pa.string(), pa.float64()))]
            yield pa.RecordBatch.from_arrays(out, names=[*kept, "lang_pred", "score", "shares"])

    schema = docs.select(kept).selectExpr("*", "'' as lang_pred", "0D as score", "map('', 0D) as shares").schema
    return docs.select(*kept, F.col(text_column).alias(own)).mapInArrow(apply, schema)
