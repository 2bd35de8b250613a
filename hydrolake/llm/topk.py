"""Exact top-k inner products by pivot-table elimination."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from hydrolake.llm.common import bucket, parts, written

#: Candidates and queries of one block; pivots, and rows they are chosen from; candidates
#: evaluated at a time.
BLOCK, QUERIES, PIVOTS, SAMPLE, STEP = 8192, 4096, 32, 2000, 256


def integers(vector: Column, factor: int = 64) -> Column:
    """floor(factor * x) of each component as a double; null if the vector is null or holds a null
    or a component that is not finite."""
    c = vector.cast("array<double>")
    bad = F.exists(c, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.when(c.isNotNull() & ~bad, F.transform(c, lambda x: F.floor(x * factor).cast("double")))


def pivots(sample: list[list[float]], most: int = PIVOTS) -> dict[int, np.ndarray]:
    """Per dimension: the origin, then points each farthest from those before it."""
    out = {}
    for size in sorted({len(v) for v in sample}):
        x = np.array(sorted(v for v in sample if len(v) == size)).reshape(-1, size)
        far, chosen = np.sqrt((x ** 2).sum(1)), [np.zeros(size)]
        while len(chosen) <= most and far.size and far.max() > 0:
            chosen.append(x[far.argmax()])
            far = np.minimum(far, np.sqrt(((x - chosen[-1]) ** 2).sum(1)))
        out[size] = np.array(chosen)
    return out


def best(q: np.ndarray, qt: np.ndarray, x: np.ndarray, xt: np.ndarray, own: np.ndarray, floor: float, k: int) -> np.ndarray:
    """Positions in x of the k best for one query (fewer if none else reaches ``floor``), ties to
    earlier positions; ``own`` marks positions to pass over.

    For each pivot p, |d(q,p) - d(x,p)| bounds d(q,x) from below; the largest bound over all pivots
    bounds the inner product (|q|^2 + |x|^2 - d^2) / 2 from above (with room for rounding). Of the
    candidates whose bound reaches ``floor``, those of the largest bounds are evaluated first, in
    steps that double, until the next bound lies below the k-th best score. xt: a row per pivot.
    """
    gap = np.abs(xt[0] - qt[0])
    for p in range(1, len(xt)):
        np.maximum(gap, np.abs(xt[p] - qt[p]), out=gap)
    sides = qt[0] ** 2 + xt[0] ** 2
    bound = (sides - gap ** 2) / 2 + 1e-5 * (1 + sides)
    bound[own] = np.nan
    order = np.flatnonzero(bound >= floor)
    order = order[np.argsort(-bound[order])]
    at, scores, s, step = np.zeros(0, np.int64), np.zeros(0, x.dtype), 0, STEP
    while s < len(order) and bound[order[s]] >= floor:
        some = order[s:s + step]
        found = x[some] @ q
        good = found >= floor
        at, scores = np.concatenate([at, some[good]]), np.concatenate([scores, found[good]])
        if len(at) > k:
            keep = np.lexsort((at, -scores))[:k]
            at, scores = at[keep], scores[keep]
        if len(at) == k:
            floor = max(floor, float(scores.min()))
        s, step = s + step, 2 * step
    return at


SCORES = "query_id long, vec_id long, score long"


def top_k(vectors: DataFrame, k: int = 20, every: int = 20, vec_id: str = "vec_id", vector: str = "embedding",
          block: int = BLOCK) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: for each query the k largest integer inner products.

    Queries are the rows whose id is divisible by ``every``, candidates all rows but the query's
    own. Every vector is turned to integers and gets its distances to all pivots once (the pivot
    table, written to the shared folder). Blocks of queries meet blocks of candidates, each meeting
    one task of bounded size; in it each query evaluates candidates in bound order until it may
    stop. A first pass over one block of candidates gives each query a score that its k-th best
    cannot fall below, which prunes the others from their first candidate on. At most k rows per
    query and block are shuffled. Pivots come from a bounded sample; all rows are in the table.

    Vectors that are null or hold null or non-finite components, and null ids, take no part; only
    vectors of one dimension are compared. Rows that repeat an id count once, as the smallest
    vector. Sums are exact below 2^53. An empty table gives no rows.
    """
    q = integers(F.col(vector))
    rows = vectors.select(F.col(vec_id).cast("long").alias("id"), q.alias("v")).where("id IS NOT NULL AND v IS NOT NULL")
    sample = rows.orderBy(F.xxhash64("id"), "id").limit(SAMPLE).select("v")
    points = pivots([list(r[0]) for r in sample.collect()])

    def tabled(batches):
        for b in batches:
            t = [np.sqrt((((points.get(len(v)) if len(v) in points else np.zeros((1, len(v)))) - v) ** 2).sum(1)) for v in
                 (np.array(x, float) for x in b["v"].to_pylist())]
            yield pa.RecordBatch.from_arrays([b["id"], b["v"], pa.array(t, pa.list_(pa.float64()))], ["id", "v", "t"])

    table = rows.groupBy("id").agg(F.min("v").alias("v")).mapInArrow(tabled, "id long, v array<double>, t array<double>")
    table = written(table.withColumn("size", F.size("v")), "pivots")
    wanted = table.where(F.col("id") % every == 0)
    blocks, packs = parts(table.count(), block), parts(wanted.count(), QUERIES)
    table = table.withColumn("block", bucket(blocks, "id"))
    wanted = wanted.withColumn("pack", bucket(packs, "id"))

    def matrix(t: pa.Table, name: str) -> np.ndarray:
        flat = t[name].combine_chunks()
        return flat.flatten().to_numpy(zero_copy_only=False).reshape(t.num_rows, -1)

    def meet(key: tuple, queries: pa.Table, candidates: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if queries.num_rows and candidates.num_rows:
            candidates = candidates.sort_by("id")
            ids, x, qs = candidates["id"].to_numpy(), matrix(candidates, "v"), matrix(queries, "v")
            xt, qts = matrix(candidates, "t").T.astype(np.float32, order="C"), matrix(queries, "t").astype(np.float32)
            if np.abs(x).max(initial=0) * np.abs(qs).max(initial=0) * max(1, x.shape[1]) < 1 << 24:  # sums stay exact
                x, qs = x.astype(np.float32), qs.astype(np.float32)
            for i, (q_id, least) in enumerate(zip(queries["id"].to_pylist(), queries["least"].to_pylist())):
                own = np.flatnonzero(ids == q_id)
                at = best(qs[i], qts[i], x, xt, own, -np.inf if least is None else least, k)
                out += [(q_id, int(ids[j]), int(s)) for j, s in zip(at, x[at] @ qs[i])]
        columns = list(zip(*out)) or [(), (), ()]
        return pa.table({n: pa.array(c, pa.int64()) for n, c in zip(("query_id", "vec_id", "score"), columns)})

    def met(queries: DataFrame, some: list[int]) -> DataFrame:
        """All (query, candidate) blocks whose candidate block is among ``some``."""
        keys, tasks = ["size", "pack", "block"], len(some) * packs
        each = queries.withColumn("block", F.explode(F.array(*map(F.lit, some))))
        each = each.select(*[F.col(c).alias(c) for c in each.columns])  # both sides come from one table
        those = table.where(F.col("block").isin(some)) if len(some) < blocks else table
        those = those.withColumn("pack", F.explode(F.sequence(F.lit(0), F.lit(packs - 1))))
        return each.repartition(tasks, *keys).groupBy(*keys).cogroup(
            those.repartition(tasks, *keys).groupBy(*keys)).applyInArrow(meet, SCORES)

    seeds = written(met(wanted.withColumn("least", F.lit(None).cast("double")), [0]), "seeds")
    found = seeds
    if blocks > 1:
        least = seeds.groupBy("query_id").agg(F.min("score").alias("least"), F.count("*").alias("n")).where(F.col("n") == k)
        known = wanted.join(least, wanted.id == least.query_id, "left").select(
            "id", "v", "t", "size", "pack", F.col("least").cast("double").alias("least"))
        found = seeds.unionByName(met(known, list(range(1, blocks))))
    first = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
