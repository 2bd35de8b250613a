"""SimHash near-duplicates: vantage-point shards, exact pairs within three bits, components."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType
from xxhash import xxh64_intdigest

from hydrolake.llm.common import keyed, nullable, parts, slices, written
from hydrolake.llm.components import components

#: Distinct fingerprints at home in one shard; sample rows per shard that the tree is built on.
SHARD, PER_SHARD, MOST_SAMPLE = 60_000, 64, 1 << 18


def fingerprint(text: bytes, words: int = 3, seed: int = 42) -> int:
    """Majority of each bit over the XXH64 of all word shingles, repeats included."""
    w = text.lower().split()
    if not w:
        return 0
    size = min(words, len(w))
    joined, lens = b" ".join(w), np.fromiter(map(len, w), np.int64, len(w))
    ends = np.cumsum(lens + 1) - 1
    spans = zip((ends - lens).tolist(), ends[size - 1:].tolist())
    h = np.array([xxh64_intdigest(joined[a:b], seed) for a, b in spans], "<u8")
    ones = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(h), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, fp)``; the 64 bits as a signed long. Null or blank text: zero."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            fp = np.array([fingerprint(t or b"") for t in b["text"].to_pylist()], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b["doc_id"], pa.array(fp)], ["doc_id", "fp"])

    return keyed(docs, doc_id, text).mapInArrow(run, "doc_id long, fp long")


def _distance(x: np.ndarray, v: np.uint64) -> np.ndarray:
    return np.bitwise_count(x ^ v).astype(np.int16)


def _vantage(x: np.ndarray, bits: int) -> tuple[np.uint64, int, np.ndarray]:
    """Of a few points of x, that whose median ball leaves least near its border or on one side."""
    best = None
    for v in x[np.linspace(0, len(x) - 1, min(6, len(x))).astype(int)]:
        d = _distance(x, v)
        r = int(np.median(d))
        cost = max((d <= r + bits).sum(), (d > r - bits).sum())
        if best is None or cost < best[0]:
            best = (cost, v, r, d)
    return best[1:]


def build(sample: np.ndarray, leaves: int, bits: int) -> tuple | None:
    """Vantage-point tree over a sample: (point, radius, inside, outside); None is a leaf."""
    if leaves <= 1 or len(np.unique(sample)) < 8:
        return None
    v, r, d = _vantage(sample, bits)
    return v, r, build(sample[d <= r], leaves // 2, bits), build(sample[d > r], leaves - leaves // 2, bits)


def route(tree: tuple | None, x: np.ndarray, bits: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Per leaf: its number, indices of x that are at home there, and indices of those at home in an
    earlier leaf whose ball of ``bits`` reaches this one (triangle bound). Every pair within
    ``bits`` thus meets once, in the later of its two homes."""
    leaf = 0

    def walk(node, home, guests):
        nonlocal leaf
        if node is None:
            yield leaf, home, guests
            leaf += 1
            return
        v, r, inside, outside = node
        dh, dg = _distance(x[home], v), _distance(x[guests], v)
        yield from walk(inside, home[dh <= r], guests[dg <= r + bits])
        yield from walk(outside, home[dh > r], np.concatenate([guests[dg > r - bits], home[(dh <= r) & (dh > r - bits)]]))

    yield from walk(tree, np.arange(len(x)), np.arange(0))


class _Forest:
    """Union-find over positions, whole arrays of pairs at a time."""

    def __init__(self, n: int):
        self.up = np.arange(n)

    def find(self, i: np.ndarray) -> np.ndarray:
        p = self.up[i]
        while not np.array_equal(q := self.up[p], p):
            p = q
        self.up[i] = p
        return p

    def tie(self, i: np.ndarray, j: np.ndarray) -> None:
        while len(i):
            a, b = self.find(i), self.find(j)
            open_ = a != b
            i, j, a, b = i[open_], j[open_], a[open_], b[open_]
            np.minimum.at(self.up, np.maximum(a, b), np.minimum(a, b))


def near(x: np.ndarray, n_home: int, bits: int) -> np.ndarray:
    """Root position of each fingerprint under all links with a home one (the first ``n_home``).

    The shard's own vantage-point tree: pairs inside a ball, pairs outside it, and pairs
    across its border, of which only points within ``bits`` of the border can be part.
    Small or inseparable sets are compared outright, in blocks.
    """
    forest = _Forest(len(x))

    def brute(a: np.ndarray, b: np.ndarray) -> None:
        step = max(1, (1 << 21) // max(1, len(b)))
        for s in range(0, len(a), step):
            i, j = np.nonzero(np.bitwise_count(x[a[s:s + step], None] ^ x[None, b]) <= bits)
            forest.tie(a[s:s + step][i], b[j])

    def cross(a: np.ndarray, b: np.ndarray) -> None:
        if not len(a) or not len(b):
            return
        if len(a) < len(b):
            a, b = b, a
        if len(a) * len(b) <= 1 << 17 or len(a) <= 256:
            return brute(a, b)
        v, r, da = _vantage(x[a], bits)
        db = _distance(x[b], v)
        parts_ = ((a[da <= r], b[db <= r + bits]), (a[da > r], b[db > r - bits]))
        if sum(len(p) * len(q) for p, q in parts_) > 0.95 * len(a) * len(b):
            return brute(a, b)
        for p, q in parts_:
            cross(p, q)

    def own(a: np.ndarray) -> None:
        if len(a) <= 256:
            return brute(a, a)
        v, r, d = _vantage(x[a], bits)
        inside = d <= r
        if min(inside.sum(), (~inside).sum()) < len(a) // 32:
            return brute(a, a)
        own(a[inside])
        own(a[~inside])
        cross(a[inside & (d > r - bits)], a[~inside & (d <= r + bits)])

    own(np.arange(n_home))
    cross(np.arange(n_home), np.arange(n_home, len(x)))
    return forest.find(np.arange(len(x)))


def links(distinct: DataFrame, bits: int, shard: int = SHARD) -> DataFrame:
    """Edges ``(a, b)`` that connect what all pairs within ``bits`` connect: of each shard a
    spanning forest, at most one edge per fingerprint in it, however many pairs there are."""
    leaves = parts(distinct.count(), shard)
    sample = distinct.select("fp").orderBy(F.xxhash64("fp")).limit(min(leaves * PER_SHARD, MOST_SAMPLE)) if leaves > 1 else None
    points = np.array([r[0] for r in sample.collect()] if sample is not None else [], np.int64).view(np.uint64)
    tree = build(points, leaves, bits)

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = b["fp"].to_numpy(zero_copy_only=False).view(np.uint64)
            for leaf, home, guests in route(tree, x, bits):
                fp = x[np.concatenate([home, guests])].view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(fp), leaf, np.int32)), pa.array(fp), pa.array(np.arange(len(fp)) < len(home))], ["leaf", "fp", "home"])

    def linked(table: pa.Table) -> pa.Table:
        home = table["home"].to_numpy(zero_copy_only=False)
        fp = table["fp"].to_numpy()
        fp = np.concatenate([np.sort(fp[home]), np.sort(fp[~home])])
        root = near(fp.view(np.uint64), int(home.sum()), bits)
        tied = root != np.arange(len(fp))
        return pa.table({"a": fp[tied], "b": fp[root[tied]]})

    rows = distinct.select("fp").mapInArrow(dealt, "leaf int, fp long, home boolean")
    return rows.repartition(leaves, "leaf").groupBy("leaf").applyInArrow(linked, "a long, b long")


def grouped(fps: DataFrame, bits: int, shard: int) -> DataFrame:
    """``(fp, root, component)`` of each distinct fingerprint of rows with an id: the smallest
    fingerprint, and the smallest id, reachable over links."""
    distinct = fps.where("doc_id IS NOT NULL").groupBy("fp").agg(F.min("doc_id").alias("first"))
    distinct = written(distinct, "distinct")
    roots = components(links(distinct, bits, shard)).withColumnRenamed("node", "fp")
    least = roots.join(distinct, "fp").groupBy("root").agg(F.min("first").alias("least"))
    reached = distinct.join(roots, "fp", "left").join(least, "root", "left")
    return reached.select("fp", F.coalesce("root", "fp").alias("root"), F.coalesce("least", "first").alias("component"))


def classes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", bits: int = 3, shard: int = SHARD) -> DataFrame:
    """``(doc_id, fingerprint, component_id)`` of every row: the smallest id reachable over links
    between fingerprints that differ in at most ``bits`` bits.

    Copies collapse to one distinct fingerprint by partial aggregation before anything is
    compared. Null and blank texts share fingerprint zero and are linked like any other. Rows that
    repeat an id are judged each by its own text. A null id links nothing and has a null
    component. An empty table gives no rows.
    """
    fps = written(fingerprints(docs, doc_id, text), "fingerprints")
    return fps.join(grouped(fps, bits, shard), "fp", "left").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        F.when(F.col("doc_id").isNotNull(), F.col("component")).alias("component_id"))


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", bits: int = 3, shard: int = SHARD) -> DataFrame:
    """The documents without near copies: of each component one row with its smallest id stays.

    Rows that repeat an id are judged each by its own text: unlike texts stay, and of those of one
    component the smallest text. They are chosen by an aggregation, so an id that a third of all
    rows repeat is no task of its own. Rows without an id stay. Null and blank texts are near
    copies of each other. An empty table gives no rows. Columns may have any name.
    """
    fps = written(fingerprints(docs, doc_id, text), "fingerprints")
    known = written(fps.where("doc_id IS NOT NULL").join(grouped(fps, bits, shard), "fp"), "known")
    ids = known.groupBy("doc_id").agg(F.count("*").alias("n"), F.min(F.col("doc_id") == F.col("component")).alias("stays"))
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"), F.struct("*").alias("row"))
    once = rows.join(ids.where("n = 1 AND stays").select("doc_id"), "doc_id", "left_semi").select("row")
    parts_ = [once, rows.where("doc_id IS NULL").select("row")]
    if not ids.where("n > 1").isEmpty():
        again = rows.join(ids.where("n > 1").select("doc_id"), "doc_id", "left_semi")
        schema = nullable(StructType.fromDDL("doc_id long, fp long, text string").add("row", again.schema["row"].dataType))
        row_type = to_arrow_schema(schema).field("row").type

        def marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in slices(batches, "text"):
                fp = np.array([fingerprint((t or "").encode()) for t in b["text"].to_pylist()], np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays([b["doc_id"], pa.array(fp), b["text"], b["row"].cast(row_type)], ["doc_id", "fp", "text", "row"])

        stay = known.where("doc_id = component").select("doc_id", "fp", "root").distinct()
        again = again.mapInArrow(marked, schema).join(stay, ["doc_id", "fp"])
        parts_.append(again.groupBy("doc_id", "root").agg(F.min_by("row", F.struct(F.col("text").isNotNull(), "text")).alias("row")).select("row"))
    return reduce(DataFrame.unionByName, parts_).select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns])
