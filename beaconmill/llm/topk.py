"""Exact top-k search: score histograms locate each query's k-th value, a filter keeps what reaches it."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import stored

BINS = 256


def quantised(vectors: DataFrame, *, scale: int = 64, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """``(id, v)`` with ``floor(scale * x)`` as whole numbers; vectors that are null or hold null or non-finite components are left out."""
    v = F.col(vector_column)
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
    ints = F.transform(v, lambda x: F.floor(x.cast("double") * scale).cast("double"))
    return vectors.filter(v.isNotNull() & ~bad & F.col(id_column).isNotNull()).select(F.col(id_column).cast("bigint").alias("id"), ints.alias("v"))


def _matrix(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    ids, v = batch.column("id").to_numpy(), batch.column("v")
    return ids, v.flatten().to_numpy().reshape(batch.num_rows, -1)


def _histograms(
    cands: DataFrame,
    queries: tuple[np.ndarray, np.ndarray],
    lo: np.ndarray,
    span: np.ndarray,
    width: np.ndarray,
    key: str,
    floor: np.ndarray,
) -> np.ndarray:
    """For each query, how many candidates fall in each of ``BINS`` bins from ``lo``, which cover ``span`` values at least; those beyond ``span`` are not counted.

    ``key`` "score" counts scores; "id" counts the negated ids of candidates whose score is ``floor``.
    """
    ids_q, q = queries

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(ids_q), BINS), np.int64)
        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                ids, v = _matrix(batch.slice(at, 2048))
                scores = (q @ v.T).astype(np.int64)  # whole numbers far below 2 ** 53
                valid = ids_q[:, None] != ids[None, :]
                if key == "id":
                    valid &= scores == floor[:, None]
                    scores = np.broadcast_to(-ids[None, :], scores.shape)
                place = (scores - lo[:, None]) // width[:, None]
                valid &= (scores >= lo[:, None]) & (scores < (lo + span)[:, None])
                flat = (np.arange(len(ids_q))[:, None] * BINS + place)[valid]
                total += np.bincount(flat, minlength=total.size).reshape(total.shape)
        yield pa.RecordBatch.from_pydict({"query": pa.array(np.arange(len(ids_q))), "counts": pa.array([r.tobytes() for r in total], pa.binary())})

    def add(table: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(c, np.int64) for c in table.column("counts").to_pylist())
        return pa.table({"query": table.column("query")[:1], "counts": pa.array([total.tobytes()], pa.binary())})

    schema = "query bigint, counts binary"
    summed = cands.mapInArrow(count, schema).groupBy("query").applyInArrow(add, schema).toPandas()  # a row for each query of the block
    out = np.zeros((len(ids_q), BINS), np.int64)
    for i, c in zip(summed["query"], summed["counts"], strict=True):
        out[i] = np.frombuffer(c, np.int64)
    return out


def _locate(cands: DataFrame, queries, lo: np.ndarray, hi: np.ndarray, k: np.ndarray, key: str, floor: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each query the largest value that at least ``k`` candidates reach (the smallest there is, if fewer do), and how many exceed it.

    Each round divides the range that holds it into ``BINS``, until a bin is one value.
    """
    lo, span = lo.copy(), hi - lo + 1
    above = np.zeros(len(lo), np.int64)
    while (span > 1).any():
        width = np.maximum(1, -(-span // BINS))
        # what lies beyond the range is in ``above`` already, also where the last bin reaches past it
        counts = _histograms(cands, queries, lo, span, width, key, floor)
        down = counts[:, ::-1].cumsum(1)
        reached = down + above[:, None] >= k[:, None]
        last = np.where(reached.any(1), reached.argmax(1), BINS - 1)
        lowest = (counts > 0).argmax(1)
        chosen = np.where(reached.any(1), BINS - 1 - last, lowest)
        over = np.where(chosen < BINS - 1, np.take_along_axis(down, np.maximum(0, BINS - 2 - chosen)[:, None], 1)[:, 0], 0)
        above = above + over
        upper = np.minimum(width, span - chosen * width)
        lo, span = lo + chosen * width, np.maximum(1, upper)
    return lo, above


def top_k(
    vectors: DataFrame,
    *,
    k: int = 20,
    every: int = 20,
    scale: int = 64,
    block: int = 2048,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: for each query the ``k`` largest inner products, ties to the smaller id.

    Queries are the rows whose id is divisible by ``every``; candidates are all others. The
    queries are taken in blocks of ``block`` rows, a size that bounds what the driver and
    each task hold. For a block, tasks score all candidates and send one histogram for each
    query; the driver picks the bin with the k-th value and asks again within it until it is
    one score. Where more candidates have that score than fit, the same search over their ids
    finds the last that does. The filter then keeps ``k`` rows for each query, or all if
    there are fewer candidates. No rows, or none that is a query, give none.

    Null ids, null vectors and vectors with null or non-finite components take no part.
    Vectors must have one length. Rows that repeat an id are candidates each; all but the
    query's own id. If a query's id repeats, each of its vectors is a query, and their
    results are merged under the one id.
    """
    schema = "query_id bigint, rank int, vec_id bigint, score bigint"
    cands = stored(quantised(vectors, scale=scale, id_column=id_column, vector_column=vector_column), "vectors")
    asked = cands.filter(F.col("id") % every == 0)
    reach = cands.agg(F.max(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)).alias("n"), F.min("id").alias("a"), F.max("id").alias("z")).first()
    if reach["n"] is None:
        return vectors.sparkSession.createDataFrame([], schema)
    limit = int(reach["n"]) + 1  # no inner product is larger than the largest squared length
    # blocks are ranges of query ids, from exact counts of ids in order
    n = asked.count()
    ranges = -(-n * 2 // block)
    steps = [i / ranges for i in range(1, ranges)]
    edges = sorted(set(asked.agg(F.percentile_approx("id", steps, 1_000_000)).first()[0])) if n > block else []
    found = []
    for low, high in zip([None, *edges], [*edges, None], strict=True):
        part = asked
        part = part.filter(F.col("id") > low) if low is not None else part
        part = part.filter(F.col("id") <= high) if high is not None else part
        rows = part.toArrow().sort_by("id").combine_chunks()
        for at in range(0, rows.num_rows, block):
            piece = rows.slice(at, block)
            ids = piece.column("id").to_numpy()
            q = piece.column("v").combine_chunks().flatten().to_numpy().reshape(len(ids), -1)
            found.append(_block(cands, (ids, q), k, limit, reach["a"], reach["z"]))
    if not found:
        return vectors.sparkSession.createDataFrame([], schema)
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return out.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _block(cands: DataFrame, queries: tuple[np.ndarray, np.ndarray], k: int, limit: int, first_id: int, last_id: int) -> DataFrame:
    ids_q, q = queries
    n = len(ids_q)
    full = np.full(n, k, np.int64)
    floor, above = _locate(cands, queries, np.full(n, -limit, np.int64), np.full(n, limit, np.int64), full, "score", np.zeros(n, np.int64))
    # among the candidates at the k-th score, the ids that still fit: the k - above smallest
    cut, _ = _locate(cands, queries, np.full(n, -last_id, np.int64), np.full(n, -first_id, np.int64), full - above, "id", floor)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                ids, v = _matrix(batch.slice(at, 2048))
                scores = (q @ v.T).astype(np.int64)
                good = (scores > floor[:, None]) | ((scores == floor[:, None]) & (-ids[None, :] >= cut[:, None]))
                a, b = np.nonzero(good & (ids_q[:, None] != ids[None, :]))
                yield pa.RecordBatch.from_pydict({"query_id": ids_q[a], "vec_id": ids[b], "score": scores[a, b]})

    return stored(cands.mapInArrow(keep, "query_id bigint, vec_id bigint, score bigint"), "top")
