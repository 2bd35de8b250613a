"""Repeated passages across documents, found by difference-cover anchors."""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType
from xxhash import xxh3_64_intdigest

from hydrolake.llm.common import CACHES, bucket, nullable, parts, text_bytes

#: Text bytes of one block of documents; anchors or windows of one bucket that meet in a task.
BLOCK_BYTES, BUCKET = 4 << 20, 1 << 20
#: Word hashes kept per worker.
WORDS = 200_000
NO_ID = np.iinfo(np.int64).max
#: Perfect difference sets: any two positions have a common shift below the period that brings
#: both to a position in the set.
COVERS = {3: (0, 1), 7: (0, 1, 3), 13: (0, 1, 3, 9), 21: (0, 1, 4, 14, 16)}


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        h = xxh3_64_intdigest(word)
        if len(self) < WORDS:
            self[word] = h
        return h


_HASHES = _Hashes()
CACHES.append(_HASHES.clear)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


def _rolled(hashes: np.ndarray, at: np.ndarray, size: int, seed: int) -> np.ndarray:
    """Hash of the ``size`` words from each position on: a polynomial over their hashes."""
    base, out = np.uint64(2 * seed + 0x5851F42D4C957F2D), np.zeros(len(at), np.uint64)
    for k in range(size):
        out = (out + hashes[at + k]) * base
    return _mix(out)


class Block:
    """The documents of one block as one row of word hashes."""

    def __init__(self, texts: list[bytes | None], ids: np.ndarray, window: int, period: int, buckets: int):
        self.words = [(t or b"").split() for t in texts]
        self.sizes = np.fromiter(map(len, self.words), np.int64, len(self.words))
        self.firsts = np.cumsum(self.sizes) - self.sizes
        total = int(self.sizes.sum())
        look = _HASHES.__getitem__
        self.hashes = np.fromiter((look(w) for ws in self.words for w in ws), np.uint64, total)
        self.ids, self.window, self.period, self.buckets = ids, window, period, buckets
        self.doc = np.repeat(np.arange(len(texts)), self.sizes)
        self.place = np.arange(total) - self.firsts[self.doc]
        self.size = window - period + 1  # words of an anchor

    def _dealt(self, h: np.ndarray) -> np.ndarray:
        return ((h >> np.uint64(32)) * np.uint64(self.buckets) >> np.uint64(32)).astype(np.int64)

    def anchors(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Positions of all anchors, their buckets and 32-bit marks inside them."""
        covered = np.zeros(self.period, bool)
        covered[list(COVERS[self.period])] = True
        left = self.sizes[self.doc] - self.place
        at = np.flatnonzero(covered[self.place % self.period] & (left >= self.size) & (self.sizes[self.doc] >= self.window))
        h = _rolled(self.hashes, at, self.size, 1)
        return at, self._dealt(h), (h & np.uint64(0xFFFFFFFF)).astype(np.uint32)

    def starts(self, hit: np.ndarray) -> np.ndarray:
        """Starts of all windows that hold one of the anchors at ``hit`` within the first
        ``period`` shifts: every window that repeats elsewhere is among them."""
        marked = np.zeros(len(self.hashes), bool)
        for shift in range(self.period):
            s = hit - shift
            s = s[s >= self.firsts[self.doc[hit]]]
            marked[s] = True
        return np.flatnonzero(marked & (self.sizes[self.doc] - self.place >= self.window))

    def windows(self, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bucket and 64-bit key of each window; the bucket comes from a hash of its own."""
        return self._dealt(_rolled(self.hashes, starts, self.window, 2)), _rolled(self.hashes, starts, self.window, 3)


def _groups(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of rows by several keys: order, start of each distinct row in that order, and each row's group."""
    order = np.lexsort(keys[::-1])
    new = np.ones(len(order), bool)
    if len(order):
        new[1:] = np.any([k[order][1:] != k[order][:-1] for k in keys], axis=0)
    group = np.empty(len(order), np.int64)
    group[order] = np.cumsum(new) - 1
    return order, np.flatnonzero(new), group


def _table(**columns) -> pa.Table:
    return pa.table(columns)


def _by_bucket(block: int, buckets: np.ndarray, *payloads: np.ndarray) -> pa.Table:
    """One row per bucket of sorted distinct entries, each payload packed to bytes."""
    kinds, firsts = np.unique(buckets, return_index=True)
    ends = np.append(firsts[1:], len(buckets))
    packed = {f"p{i}": pa.array([p[a:b].tobytes() for a, b in zip(firsts, ends)], pa.binary()) for i, p in enumerate(payloads)}
    return _table(bucket=pa.array(kinds, pa.int32()), block=pa.array(np.full(len(kinds), block), pa.int32()), **packed)


def _bits(blocks: list[int], sizes: list[int], bucket_: int, flags: np.ndarray) -> pa.Table:
    """The flags of each block's entries as bits, one row per block with any flag set."""
    ends = np.cumsum(sizes)
    rows = [(b, np.packbits(f).tobytes()) for b, e, n in zip(blocks, ends, sizes) if (f := flags[e - n:e]).any()]
    return _table(block=pa.array([r[0] for r in rows], pa.int32()),
                  bucket=pa.array([bucket_] * len(rows), pa.int32()), bits=pa.array([r[1] for r in rows], pa.binary()))


def _flags(table: pa.Table, buckets: np.ndarray) -> np.ndarray:
    """What ``_bits`` said of a block's entries, which lie in order of their buckets."""
    flags = np.zeros(len(buckets), bool)
    for b, bits in zip(table["bucket"].to_pylist(), table["bits"].to_pylist()):
        a, e = np.searchsorted(buckets, [b, b + 1])
        flags[a:e] = np.unpackbits(np.frombuffer(bits, np.uint8), count=e - a).astype(bool)
    return flags


def without(text: bytes, spans: list[list[int]]) -> bytes:
    """A text without some ranges of its words and the white space after each of these words."""
    starts = [m.start() for m in re.finditer(rb"[^\x20\x09-\x0D]+", text)] + [len(text)]
    edges = [0, *(starts[i] for span in spans for i in span), len(text)]
    return b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2]))


def dedup(docs: DataFrame, window: int = 13, period: int = 7, doc_id: str = "doc_id", text: str = "text",
          carry: bool = False, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Every document with the words left that no repeated window covers.

    Words stand between ASCII white space. A window is ``window`` words in a row of one document;
    its words go if the same words also start in a document with a smaller id. Returns
    ``doc_id, n_words, n_removed, kept`` (kept words joined by one space) and ``spans`` (word
    ranges removed, end exclusive). With ``carry`` it returns the columns of ``docs``; a removed word
    takes the white space after it along, and all other bytes of the text stay as they are.

    1. *Anchors.* Each document hashes runs of ``window - period + 1`` words, only at positions
       of a difference cover modulo ``period``. Two equal windows share an aligned anchor, wherever
       they stand. Blocks of documents send each distinct anchor once, as 32 bits in its bucket;
       bits come back for those that another block holds too.
    2. *Extension.* Windows around repeated anchors are hashed whole. Blocks send each distinct one
       once, with its smallest document; bits come back for those with a smaller one elsewhere.
    3. Blocks drop the covered words.

    Texts are shuffled once, to blocks by a hash; all steps are one plan, which reuses that exchange. A
    passage that a third of all documents share is one entry per block and step, however often it
    occurs. No pairs are made. Anchors are only a filter, so 32 bits do; windows are held equal
    by 64 bits and the bucket's own.

    Null text: no words. Null id: counts as larger than any. Repeated ids do not remove each
    other's words. Documents with fewer words than a window are kept whole. Empty table: no rows.
    """
    size = text_bytes(docs, text)
    blocks, buckets = parts(size, block_bytes), parts(size // 14, BUCKET, 8)
    others = [c for c in docs.columns if c != text] if carry else []
    rest = F.struct(*[F.col(c) for c in others]) if others else F.lit(None).cast("int")
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").cast("binary").alias("text"), rest.alias("rest"))
    rows = rows.withColumn("block", bucket(blocks, "doc_id", "text")).repartition(blocks, "block")

    def load(table: pa.Table) -> Block:
        ids = table["doc_id"].to_pandas().fillna(NO_ID).astype(np.int64).to_numpy() if table["doc_id"].null_count else table["doc_id"].to_numpy()
        return Block(table["text"].to_pylist(), ids, window, period, buckets)

    def distinct_anchors(block: Block):
        at, b, mark = block.anchors()
        order, firsts, group = _groups(b, mark)
        return at, b[order][firsts], mark[order][firsts], group

    def distinct_windows(block: Block, masks: pa.Table):
        at, b, _, group = distinct_anchors(block)
        repeated = _flags(masks, b) | (np.bincount(group, minlength=len(b)) > 1) if len(b) else np.zeros(0, bool)
        starts = block.starts(at[repeated[group]])
        b, key = block.windows(starts)
        order, firsts, group = _groups(b, key)
        least = np.minimum.reduceat(block.ids[block.doc[starts]][order], firsts) if len(firsts) else np.zeros(0, np.int64)
        return starts, b[order][firsts], key[order][firsts], least, group

    def send_anchors(key: tuple, table: pa.Table) -> pa.Table:
        _, b, mark, _ = distinct_anchors(load(table))
        return _by_bucket(key[0].as_py(), b, mark)

    def meet_anchors(key: tuple, table: pa.Table) -> pa.Table:
        marks = [np.frombuffer(p, np.uint32) for p in table["p0"].to_pylist()]
        _, firsts, group = _groups(all_ := np.concatenate(marks))
        more = np.bincount(group, minlength=len(firsts)) > 1
        return _bits(table["block"].to_pylist(), list(map(len, marks)), key[0].as_py(), more[group] if len(all_) else more)

    def send_windows(key: tuple, table: pa.Table, masks: pa.Table) -> pa.Table:
        if not table.num_rows:
            return _by_bucket(0, np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64))
        _, b, k, least, _ = distinct_windows(load(table), masks)
        return _by_bucket(key[0].as_py(), b, k, least)

    def meet_windows(key: tuple, table: pa.Table) -> pa.Table:
        keys = [np.frombuffer(p, np.uint64) for p in table["p0"].to_pylist()]
        least = np.concatenate([np.frombuffer(p, np.int64) for p in table["p1"].to_pylist()])
        order, firsts, group = _groups(np.concatenate(keys))
        smaller = np.minimum.reduceat(least[order], firsts)[group] < least
        return _bits(table["block"].to_pylist(), list(map(len, keys)), key[0].as_py(), smaller)

    def cut(key: tuple, table: pa.Table, masks: pa.Table) -> pa.Table:
        if not table.num_rows:
            return empty
        anchors, windows = (masks.filter(pc.equal(masks["step"], s)) for s in (1, 2))
        block = load(table)
        starts, b, _, least, group = distinct_windows(block, anchors)
        gone = _flags(windows, b)[group] | (block.ids[block.doc[starts]] > least[group])
        edge = np.zeros(len(block.hashes) + 1, np.int64)
        edge[starts[gone]] += 1
        np.add.at(edge, starts[gone] + window, -1)
        covered = np.cumsum(edge[:-1]) > 0
        removed = np.bincount(block.doc[covered], minlength=len(block.words))
        kept, spans = [], []
        for words, first, n, lost in zip(block.words, block.firsts, block.sizes, removed):
            if lost:
                c = covered[first:first + n]
                words = [w for w, x in zip(words, c.tolist()) if not x]
                turns = np.flatnonzero(np.diff(np.concatenate([[False], c, [False]]).astype(np.int8)))
                spans.append(turns.reshape(-1, 2).tolist())
            else:
                spans.append([])
            kept.append(b" ".join(words))
        out = {"doc_id": table["doc_id"], "n_words": pa.array(block.sizes), "n_removed": pa.array(removed.astype(np.int64)),
               "kept": pa.array(kept, pa.binary()), "spans": pa.array(spans, pa.list_(pa.list_(pa.int64()))),
               "rest": table["rest"].cast(empty.schema.field("rest").type)}
        if carry:
            out["kept"] = pa.array([without(t, gone) if gone else t for t, gone in zip(table["text"].to_pylist(), spans)], pa.binary())
        return pa.table(out)

    schema = StructType.fromDDL("doc_id long, n_words long, n_removed long, kept binary, spans array<array<long>>")
    schema = nullable(schema.add("rest", rows.schema["rest"].dataType))
    empty = to_arrow_schema(schema).empty_table()
    by_block = rows.groupBy("block")
    sent = by_block.applyInArrow(send_anchors, "bucket int, block int, p0 binary")
    bits = "block int, bucket int, bits binary"
    anchors = sent.repartition(buckets, "bucket").groupBy("bucket").applyInArrow(meet_anchors, bits)
    sent = by_block.cogroup(anchors.repartition(blocks, "block").groupBy("block")).applyInArrow(
        send_windows, "bucket int, block int, p0 binary, p1 binary")
    windows = sent.repartition(buckets, "bucket").groupBy("bucket").applyInArrow(meet_windows, bits)
    masks = anchors.withColumn("step", F.lit(1)).unionByName(windows.withColumn("step", F.lit(2)))
    done = by_block.cogroup(masks.repartition(blocks, "block").groupBy("block")).applyInArrow(cut, schema)
    done = done.withColumn("kept", F.col("kept").cast("string"))
    if not carry:
        return done.drop("rest")
    return done.select(*[F.col("kept").alias(c) if c == text else F.col(f"rest.`{c}`").alias(c) for c in docs.columns])
