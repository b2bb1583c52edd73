"""Nearest neighbours by cosine, through randomly rotated one-bit codes.

Vectors are scaled to length one and turned by a random rotation. A vector's code is the signs of
its components, one bit each, packed; with it goes one scalar, the inner product of the vector and
its code as a vector of length one. The product of a code and a rotated query, over that scalar,
estimates the cosine without bias; its error is within ``EPSILON * sqrt((1 - s * s) / (s * s * (d -
1)))`` but for a tiny share of pairs. A vector is compared exactly, in double precision, only if
its upper bound reaches the best lower bounds found so far. So every row is searched, and the few
that may be among the nearest are reranked on the original vectors.

The index is a written table ``vec_id, vector, code, scale``, in any partitions. Queries go to it
in blocks of a bounded number; each task gives a block's nearest of its own rows, which are then
ranked over all tasks. Defined cases: vectors that are null, zero, or hold null or non-finite
components take no part, nor do those of another length than most have (of equally many, the
shorter); rows without ``vec_id`` take no part; rows with one ``vec_id`` are candidates of their
own, but none is its own query's candidate; ties go to the smaller ``vec_id``; other columns aren't
read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from .common import arrow_map, slices, stored

SEED = 20240607
#: Standard deviations that the error bound allows for.
EPSILON = 3.0
#: Queries that are sent to the tasks at once: 16 MB of vectors of 1024 components in double precision.
QUERY_BLOCK = 2048
#: Rows of the index that a task looks at in one step.
STEP = 2048

_INDEX = "vec_id bigint, vector array<double>, code binary, scale double"
_FOUND = "query_id bigint, vec_id bigint, score double"


def rotation(size: int, seed: int = SEED) -> np.ndarray:
    """A random rotation, the same in all tasks."""
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((size, size)))
    return q * np.sign(np.diag(r))


def usable(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """``(vec_id, vector)`` of the rows that take part, but for their length."""
    v = F.col(embedding).cast("array<double>")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.select(F.col(vec_id).cast("bigint").alias("vec_id"), v.alias("vector"))
    return rows.where(F.col(vec_id).isNotNull() & v.isNotNull() & finite & F.exists(v, lambda x: x != 0))


def _matrix(column: pa.Array, size: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, size)


def build_index(vectors: DataFrame, seed: int = SEED) -> tuple[DataFrame, int]:
    """Codes of all usable vectors, written, and the common number of components (0 for none)."""
    rows = usable(vectors)
    common = rows.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), "n").first()
    size = common["n"] if common else 0

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turn = rotation(size, seed)
        for batch in slices(batches, STEP):
            x = _matrix(batch.column(1), size)
            x /= np.abs(x).max(axis=1, keepdims=True)  # so that tiny or huge components keep their length
            turned = (x / np.sqrt((x * x).sum(axis=1, keepdims=True))) @ turn
            bits = turned > 0
            scale = np.abs(turned).sum(axis=1) / np.sqrt(size)
            codes = [row.tobytes() for row in np.packbits(bits, axis=1)]
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(codes, pa.binary()), pa.array(scale)], ["vec_id", "vector", "code", "scale"])

    return stored(arrow_map(rows.where(F.size("vector") == size), encode, _INDEX), "codes"), size


def cosines(vectors: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Exact measures, each row summed alike wherever it stands. Vectors whose squares leave the range of doubles are scaled
    first, by a power of two, which changes no digit."""
    def fitting(x: np.ndarray) -> np.ndarray:
        most = np.abs(x).max(axis=1, keepdims=True)
        far = (most > 2.0**400) | (most < 2.0**-400)
        return np.where(far, np.ldexp(x, -np.frexp(most)[1]), x) if far.any() else x

    vectors, query = fitting(vectors), fitting(query[None, :])[0]
    norms = np.sqrt((vectors * vectors).sum(axis=1)) * np.sqrt((query * query).sum())
    return (vectors * query).sum(axis=1) / norms


def _search(index: DataFrame, queries: list[tuple[int, list[float]]], size: int, k: int, seed: int, epsilon: float) -> DataFrame:
    """The k nearest in each task's rows of each query of a block."""
    ids = np.array([q[0] for q in queries], np.int64)
    exact = np.array([q[1] for q in queries], np.float64)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scaled = exact / np.abs(exact).max(axis=1, keepdims=True)
        turned = ((scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))) @ rotation(size, seed)).astype(np.float32)
        best_ids = np.zeros((len(ids), 0), np.int64)
        best = np.zeros((len(ids), 0))
        for batch in slices(batches, STEP):
            keys, x = batch.column("vec_id").to_numpy(), _matrix(batch.column("vector"), size)
            packed = np.frombuffer(b"".join(batch.column("code").to_pylist()), np.uint8).reshape(len(keys), -1)
            signs = np.unpackbits(packed, axis=1, count=size).astype(np.float32) * 2 - 1
            scale = batch.column("scale").to_numpy()
            rough = (turned @ signs.T) / (np.sqrt(size) * scale)
            slack = epsilon * np.sqrt(np.maximum(1 - scale * scale, 0) / max(size - 1, 1)) / scale + 1e-5
            rough[ids[:, None] == keys] = -np.inf
            low = np.concatenate([best, rough - slack], axis=1)
            if low.shape[1] > k:
                bar = np.partition(low, low.shape[1] - k, axis=1)[:, -k]
            else:
                bar = np.full(len(ids), -np.inf)
            chosen = (rough + slack >= bar[:, None]) & np.isfinite(rough)
            new_ids, new = np.zeros((len(ids), k), np.int64), np.full((len(ids), k), -np.inf)
            for nth in range(len(ids)):
                at = np.flatnonzero(chosen[nth])
                score = np.concatenate([best[nth], cosines(x[at], exact[nth])])
                key = np.concatenate([best_ids[nth], keys[at]])
                order = np.lexsort((key, -score))[:k]
                new_ids[nth, : len(order)], new[nth, : len(order)] = key[order], score[order]
            best_ids, best = new_ids, new
        there = np.isfinite(best)
        yield pa.record_batch([pa.array(np.repeat(ids, there.sum(axis=1))), pa.array(best_ids[there]), pa.array(best[there])], ["query_id", "vec_id", "score"])

    return arrow_map(index.select("vec_id", "vector", "code", "scale"), find, _FOUND)


def nearest(vectors: DataFrame, divisor: int = 50, k: int = 5, seed: int = SEED, epsilon: float = EPSILON, block: int = QUERY_BLOCK) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k nearest found of each row whose id the divisor divides."""
    index, size = build_index(vectors, seed)
    spark = vectors.sparkSession
    # Rows with one id are one query: the least of their vectors.
    queries = index.where(F.col("vec_id") % divisor == 0).groupBy("vec_id").agg(F.min("vector").alias("vector"))
    blocks = max(1, -(-queries.count() // block))
    found = None
    for nth in range(blocks):
        # A hash deals queries to blocks of about equal size; equal ids share a block.
        own = [tuple(r) for r in queries.where(F.pmod(F.xxhash64("vec_id"), F.lit(blocks)) == nth).collect()]
        part = _search(index, own, size, k, seed, epsilon) if own else spark.createDataFrame([], _FOUND)
        ranked = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
        top = part.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k)
        top = stored(top, "nearest") if blocks > 1 else top
        found = top if found is None else found.union(top)
    return found.select("query_id", "rank", "vec_id", "score")
