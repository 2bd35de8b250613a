"""Vector best-fit packing: tokens, documents and attention cost are three capacities of a sequence."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from hydrolake.llm.common import bucket, keyed, parts, slices, written
from hydrolake.llm.encode import encoder

#: Tokens packed together in one task (each such group leaves about one sequence partly empty),
#: and tokens of repeated rows that stay together.
GROUP_TOKENS, COPIES_TOKENS = 1 << 20, 1 << 16

PIECES = ("doc_id long, piece int, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, "
          "offset long, slot int, ids binary")


@dataclass(frozen=True)
class Capacity:
    """What one sequence holds: tokens, documents, and attention cost.

    A piece of n tokens costs ``linear * n + quadratic * n * n`` (attention stays inside a piece).
    ``weights`` are those of the three residuals when sequences are compared.
    """

    tokens: int = 1024
    documents: int = 1024
    cost: float = 2048.0
    linear: float = 1.0
    quadratic: float = 1.0 / 1024
    weights: tuple[float, float, float] = (1.0, 0.05, 0.2)

    def price(self, n):
        return self.linear * n + self.quadratic * n * n

    @property
    def longest(self) -> int:
        """The longest piece that an empty sequence takes; documents above it are cut."""
        n = np.arange(1, self.tokens + 1)
        fits = int((self.price(n) <= self.cost * (1 + 1e-9)).sum())
        if not fits or self.documents < 1:
            raise ValueError("one token must fit into an empty sequence")
        return fits


def best_fit(lengths: np.ndarray, cap: Capacity, rule: str = "norm") -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Sequence, offset and slot of each piece, and the number of sequences.

    Pieces go longest first (ties: earlier piece). Of the open sequences that can take the piece
    under all three capacities one is chosen by its residuals, each as a share of its capacity:
    ``norm`` takes the smallest weighted norm of what would remain, ``dot`` the largest weighted
    dot product of residual and piece (ties: lower sequence). One is opened only if none fits.
    Under ``norm`` a sequence that took a piece stays the best for the next of that length, so
    equal lengths go in runs.
    """
    w, slack = np.array(cap.weights), cap.cost * 1e-9
    order = np.argsort(-lengths, kind="stable")
    seq, offset, slot = (np.zeros(len(lengths), np.int64) for _ in range(3))
    room, seats, left = np.zeros(64, np.int64), np.zeros(64, np.int64), np.zeros(64)
    n_open, at = 0, 0
    values, counts = np.unique(lengths, return_counts=True)

    for n, m in zip(values[::-1].tolist(), counts[::-1].tolist()):
        price = cap.price(n)
        item = np.array([n / cap.tokens, 1 / cap.documents, price / cap.cost])
        while m:
            a, b, c = room[:n_open], seats[:n_open], left[:n_open]
            fits = np.flatnonzero((a >= n) & (b >= 1) & (c >= price - slack))
            if len(fits):
                shares = np.stack([a[fits] / cap.tokens, b[fits] / cap.documents, c[fits] / cap.cost], 1)
                score = ((shares - item) ** 2) @ w if rule == "norm" else -(shares * item) @ w
                best = int(fits[score.argmin()])
            else:
                best, n_open = n_open, n_open + 1
                if n_open > len(room):
                    room, seats, left = (np.concatenate([x, np.zeros_like(x)]) for x in (room, seats, left))
                room[best], seats[best], left[best] = cap.tokens, cap.documents, cap.cost
            run = m if rule == "norm" else 1
            run = min(run, int(room[best]) // n, int(seats[best]), int((left[best] + slack) / price) if price else run)
            some, k = order[at:at + run], np.arange(run)
            seq[some], offset[some], slot[some] = best, cap.tokens - room[best] + k * n, cap.documents - seats[best] + k
            room[best] -= run * n
            seats[best] -= run
            left[best] -= run * price
            at, m = at + run, m - run
    return seq, offset, slot, n_open


def encoded(docs: DataFrame, tokenizer: str, longest: int, end_id: int, with_ids: bool,
            doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, n, crcs, ids)``: tokens of each row with its end, and crc32 and (if wanted) ids
    of each piece. The first piece is the shorter one. Only these numbers are shuffled, not texts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end = encoder(tokenizer).ids, np.array([end_id], "<u4").tobytes()
        for b in slices(batches, "text"):
            all_ids = [encode((t or b"").decode()) + end for t in b["text"].to_pylist()]
            n = [len(x) // 4 for x in all_ids]
            cut = [[x[max(0, 4 * s):4 * (s + longest)] for s in range(k % longest - longest if k % longest else 0, k, longest)]
                   for x, k in zip(all_ids, n)]
            yield pa.RecordBatch.from_arrays(
                [b["doc_id"], pa.array(n, pa.int64()), pa.array([[zlib.crc32(p) for p in c] for c in cut], pa.list_(pa.int64())),
                 pa.array(cut if with_ids else [None] * len(cut), pa.list_(pa.binary()))], ["doc_id", "n", "crcs", "ids"])

    return keyed(docs, doc_id, text).mapInArrow(run, "doc_id long, n long, crcs array<long>, ids array<binary>")


def pack(docs: DataFrame, tokenizer: str, cap: Capacity = Capacity(), end_id: int = 2, rule: str = "norm",
         with_ids: bool = True, doc_id: str = "doc_id", text: str = "text", group_tokens: int = GROUP_TOKENS) -> DataFrame:
    """Every document's ids, with ``end_id`` after them, in as few sequences as best-fit finds.

    One row per piece: its number and start in its document, where it lies in its sequence, and
    its ids (``with_ids``). Documents that fit into an empty sequence stay whole; longer ones are
    cut into pieces of the greatest length that fits, the first of them shorter. Texts are encoded
    where they are read; token counts are written once and dealt by hash to groups of about
    ``group_tokens``, each packed on its own.

    Null text: an empty document, one end token. Repeated rows are packed each: they travel as one
    row with a count, and a count above ``COPIES_TOKENS`` tokens is split, so no id can crowd a
    group. A null id stays null. An empty table gives no rows. Other columns are not read.
    """
    longest = cap.longest
    table = written(encoded(docs, tokenizer, longest, end_id, with_ids, doc_id, text), "encoded")
    n = parts(table.agg(F.sum("n")).first()[0] or 0, group_tokens)
    each = F.greatest(F.lit(1).cast("long"), F.expr(f"{COPIES_TOKENS} div n"))
    rows = table.groupBy("doc_id", "n", "crcs", "ids").agg(F.count("*").alias("m")).withColumn("each", each)
    rows = rows.withColumn("share", F.explode(F.expr("sequence(0L, (m - 1) div each)")))
    rows = rows.select("doc_id", "n", "crcs", "ids", F.expr("least(each, m - share * each)").alias("m"),
                       bucket(n, "doc_id", "n", "crcs", "share").alias("group"))

    def packed(key: tuple, t: pa.Table) -> pa.Table:
        names, sizes, crcs, ids = (t[c].to_pylist() for c in ("doc_id", "n", "crcs", "ids"))
        row = sorted(range(t.num_rows), key=lambda i: (names[i] is None, names[i] or 0, sizes[i], crcs[i]))
        row = np.repeat(row, np.array(t["m"].to_numpy())[row])
        size = t["n"].to_numpy()[row]
        count = -(-size // longest)
        doc = np.repeat(np.arange(len(row)), count)
        piece = np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)
        first = np.where(size % longest, size % longest, longest)[doc]
        start = np.where(piece, first + (piece - 1) * longest, 0)
        length = np.where(piece, longest, first)
        seq, offset, slot, _ = best_fit(length, cap, rule)
        at = row[doc]
        pick = lambda lists: [lists[i][p] if lists[i] is not None else None for i, p in zip(at.tolist(), piece.tolist())]
        return pa.table({
            "doc_id": t["doc_id"].combine_chunks().take(pa.array(at)), "piece": pa.array(piece, pa.int32()), "start": start, "length": length,
            "ids_crc32": pa.array(pick(crcs), pa.int64()), "doc_tokens": size[doc], "sequence_id": (key[0].as_py() << 32) + seq,
            "offset": offset, "slot": pa.array(slot, pa.int32()), "ids": pa.array(pick(ids), pa.binary())})

    return rows.repartition(n, "group").groupBy("group").applyInArrow(packed, PIECES)
