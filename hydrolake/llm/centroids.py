"""Nearest-centroid clustering by progressive search over Walsh-Hadamard coefficients."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from hydrolake.llm.common import written
from hydrolake.session import local_table

#: Scale of components, their bound after it (sums of squares stay exact in 64 bits), vectors of
#: one step, and coefficients known after each level, coarse to fine.
SCALE, BOUND, STEP, LEVELS = 256, 1 << 24, 4096, (4, 8, 16, 32, 64)
DIM = LEVELS[-1]


def sequency() -> np.ndarray:
    """Rows of the 64-point Hadamard matrix in ascending number of sign changes: coarse to fine."""
    h = np.array([[1]])
    while len(h) < DIM:
        h = np.block([[h, h], [h, -h]])
    return (np.diff(h, axis=1) != 0).sum(1).argsort()


_COARSE_FIRST = sequency()


def transform(x: np.ndarray) -> np.ndarray:
    """Unnormalised Walsh-Hadamard transform of each row (64 integers), coarse coefficients first.

    Additions only, so exact; squared distances of coefficients are 64 times those of rows.
    """
    out = x.astype(np.int64)
    width = 1
    while width < DIM:
        pairs = out.reshape(len(x), DIM // (2 * width), 2, width)
        out = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], 2).reshape(len(x), DIM)
        width *= 2
    return out[:, _COARSE_FIRST]


def inverse(y: np.ndarray) -> np.ndarray:
    """Rows from their coefficients."""
    natural = np.empty_like(y)
    natural[:, _COARSE_FIRST] = y
    back = transform(natural)
    out = np.empty_like(back)
    out[:, _COARSE_FIRST] = back
    return out // DIM


def nearest(x: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Number and squared distance (of rows, not coefficients) of each row's nearest centroid, ties
    to the smaller number; and how many coefficient differences were taken.

    Differences are accumulated level by level; their sum only grows. The centroid that leads
    after the first level is finished at once, and its distance is the mark: a centroid whose sum
    lies strictly above it is out. What stays in has all 64 coefficients at the end.
    """
    n, k, work = len(x), len(c), 0
    best, far = np.zeros(n, np.int64), np.zeros(n, np.int64)
    for s in range(0, n, STEP):
        y = x[s:s + STEP]
        m = len(y)
        total = np.zeros((m, k), np.int64)
        for f in range(LEVELS[0]):
            total += (y[:, f, None] - c[None, :, f]) ** 2
        lead = total.argmin(1)
        mark = ((y - c[lead]) ** 2).sum(1)
        work += m * (k * LEVELS[0] + DIM)
        i, j = np.nonzero(total <= mark[:, None])
        sums = total[i, j]
        for a, b in zip(LEVELS, LEVELS[1:]):
            sums = sums + ((y[i, a:b] - c[j, a:b]) ** 2).sum(1)
            work += len(i) * (b - a)
            stay = sums <= mark[i]
            i, j, sums = i[stay], j[stay], sums[stay]
        total[:] = np.iinfo(np.int64).max
        total[i, j] = sums
        best[s:s + m] = total.argmin(1)
        far[s:s + m] = total[np.arange(m), best[s:s + m]] // DIM
    return best, far, work


def coefficients(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", scale: int = SCALE) -> DataFrame:
    """``(vec_id, w)``: the transform of floor(scale * x) of every vector of 64 finite components."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            size = b["v"].value_lengths().fill_null(-1).to_numpy(zero_copy_only=False)
            flat = b["v"].flatten().to_numpy(zero_copy_only=False)
            x = flat[np.repeat(size == DIM, np.maximum(size, 0))].reshape(-1, DIM)
            fine = np.isfinite(x.astype(float)).all(1)
            q = np.floor(scale * x[fine].astype(float))
            if np.abs(q).max(initial=0) >= BOUND:
                raise ValueError(f"components must stay below {BOUND // scale} in absolute value")
            w = transform(q).astype(np.int32)
            ids = b["vec_id"].filter(pa.array(size == DIM)).filter(pa.array(fine))
            yield pa.RecordBatch.from_arrays(
                [ids, pa.ListArray.from_arrays(pa.array(np.arange(0, w.size + 1, DIM, dtype=np.int32)), pa.array(w.ravel()))], ["vec_id", "w"])

    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("v"))
    return rows.mapInArrow(run, "vec_id long, w array<int>")


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    return batch["w"].flatten().to_numpy().reshape(-1, DIM).astype(np.int64)


def cluster(vectors: DataFrame, k: int = 40, rounds: int = 5, seed: int = 2, vec_id: str = "vec_id",
            vector: str = "embedding", scale: int = SCALE) -> DataFrame:
    """``(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256, centroid)`` of every vector.

    Centroids start as the k vectors whose ``seed:vec_id`` has the smallest sha256. Each round gives
    every vector to its nearest centroid and moves centroids to the floored mean of theirs; empty
    ones stay. Coefficients are written once and read each round; a task sends back k sums of 64
    numbers, whatever it read, and the driver holds k * 64. Centroids (k * 64 integers) travel with
    the tasks.

    Vectors that are null, of another length, or hold a null or non-finite component take no part.
    A null id is kept, but starts no centroid before all others. Repeated rows count each; rows that
    share an id start centroids in the order of their coefficients. Fewer than k vectors: as many
    centroids. An empty table gives no rows. Components of 65,536 or more (at scale 256) are an error.
    """
    table = written(coefficients(vectors, vec_id, vector, scale), "coefficients")
    start = table.orderBy(F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256).asc_nulls_last(), "w").limit(k)
    at = inverse(np.array([r.w for r in start.collect()], np.int64).reshape(-1, DIM))

    def totals(centres: np.ndarray) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            n, sums = np.zeros(len(centres), np.int64), np.zeros(centres.shape, np.int64)
            for b in batches:
                x = _matrix(b)
                mine = nearest(x, centres)[0]
                order = mine.argsort(kind="stable")
                there, begin, many = np.unique(mine[order], return_index=True, return_counts=True)
                if len(there):
                    n[there] += many
                    sums[there] += np.add.reduceat(x[order], begin, axis=0)
            at = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(n[at]), pa.array(sums[at].tolist(), pa.list_(pa.int64()))],
                                             ["cluster", "n", "sums"])

        each = table.mapInArrow(run, "cluster int, n long, sums array<long>")
        return each.select("cluster", "n", F.posexplode("sums").alias("i", "x")).groupBy("cluster", "i").agg(
            F.sum("n").alias("n"), F.sum("x").alias("x"))

    for _ in range(rounds if len(at) else 0):
        n, sums = np.zeros(len(at), np.int64), np.zeros(at.shape, np.int64)
        for r in totals(transform(at)).collect():
            n[r.cluster], sums[r.cluster, r.i] = r.n, r.x
        moved = np.where(n[:, None] > 0, inverse(sums) // np.maximum(n, 1)[:, None], at)
        if (moved == at).all():
            break
        at = moved
    centres = transform(at)

    def assigned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            mine, far, _ = nearest(_matrix(b), centres)
            yield pa.RecordBatch.from_arrays([b["vec_id"], pa.array(mine, pa.int32()), pa.array(far)], ["vec_id", "cluster", "distance"])

    done = written(table.mapInArrow(assigned, "vec_id long, cluster int, distance long"), "assigned")
    inertia = {r[0]: r[1] for r in done.groupBy("cluster").agg(F.sum("distance")).collect()}
    about = [(j, d, sum(inertia.values()), hashlib.sha256(",".join(map(str, at[j].tolist())).encode()).hexdigest(), at[j].tolist())
             for j, d in sorted(inertia.items())]
    known = local_table(done.sparkSession, about, "c int, cluster_inertia long, inertia long, centroid_sha256 string, centroid array<long>")
    return done.join(known, F.col("cluster") == F.col("c")).drop("c")
