"""Cost-balanced packing of tokenized documents into fixed-length sequences."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from hydrolake.llm.common import bucket, keyed, parts, text_bytes
from hydrolake.llm.encode import encoder

#: Text bytes packed together in one task. Each such group leaves one sequence partly empty.
GROUP_BYTES = 2 << 20

PIECES = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
          "cost double, ids binary")


def assign(lengths: list[int], size: int, linear: float = 1.0, quadratic: float = 1.0 / 1024):
    """Pieces (document, start, length, sequence, offset) and the cost of each sequence.

    A document longer than a sequence is cut into full sequences and a rest. Rests go, longest
    first, to the sequence of lowest estimated cost (``linear * n + quadratic * n * n`` summed
    over its pieces) that still has room for them; the number of sequences is the least that can
    hold all rests, so at the end a rest may fit nowhere, and is cut over the cheapest with room.
    Ties: earlier document, lower sequence. Only one sequence's worth of room is left in all.
    """
    pieces, cost, rests = [], [], []
    price = lambda n: linear * n + quadratic * n * n
    for doc, n in enumerate(lengths):
        for start in range(0, n - size + 1, size):
            pieces.append((doc, start, size, len(cost), 0))
            cost.append(price(size))
        if n % size:
            rests.append((doc, n - n % size, n % size))
    full, n_rest = len(cost), -(-sum(r[2] for r in rests) // size)
    spent, room = np.zeros(n_rest), np.full(n_rest, size)
    for doc, start, n in sorted(rests, key=lambda r: (-r[2], r[0])):
        while n:
            fits = room >= n
            if not fits.any():
                fits = room > 0
            at = int(np.where(fits, spent, np.inf).argmin())
            take = min(n, int(room[at]))
            pieces.append((doc, start, take, full + at, size - int(room[at])))
            room[at] -= take
            spent[at] += price(take)
            start, n = start + take, n - take
    return pieces, cost + spent.tolist()


def pack(docs: DataFrame, tokenizer: str, size: int = 2048, end_id: int = 1, with_ids: bool = True,
         doc_id: str = "doc_id", text: str = "text", group_bytes: int = GROUP_BYTES) -> DataFrame:
    """Every document's ids, with ``end_id`` after them, in sequences of at most ``size`` tokens.

    One row per piece: where it starts in its document, where it lies in its sequence, its ids
    (``with_ids``), their crc32, and the estimated cost of its sequence. Documents are dealt to
    groups of about ``group_bytes`` by a hash of id and text, so neither copies nor a hot source
    meet in one group, and each group is packed on its own: only texts are shuffled, once.

    Null text: an empty document, one end token. Repeated rows are packed each. A null id stays
    null. An empty table gives no rows. Other columns are not read.
    """
    n = parts(text_bytes(docs, text), group_bytes)
    rows = keyed(docs, doc_id, text).withColumn("group", bucket(n, "doc_id", "text"))

    def packed(key: tuple, table: pa.Table) -> pa.Table:
        encode, end = encoder(tokenizer).ids, np.array([end_id], "<u4").tobytes()
        order = sorted(zip(table["doc_id"].to_pylist(), table["text"].to_pylist()),
                       key=lambda r: (r[0] is not None, r[0] or 0, r[1] or b""))
        ids = [encode((t or b"").decode()) + end for _, t in order]
        pieces, cost = assign([len(x) // 4 for x in ids], size)
        base = key[0].as_py() << 32
        cut = [ids[d][4 * a:4 * (a + k)] for d, a, k, _, _ in pieces]
        columns = [[order[p[0]][0] for p in pieces], [p[1] for p in pieces], [p[2] for p in pieces],
                   [zlib.crc32(x) for x in cut], [len(ids[p[0]]) // 4 for p in pieces],
                   [base + p[3] for p in pieces], [p[4] for p in pieces], [cost[p[3]] for p in pieces],
                   cut if with_ids else [None] * len(cut)]
        kinds = [pa.int64()] * 7 + [pa.float64(), pa.binary()]
        names = [x.split()[0] for x in PIECES.split(", ")]
        return pa.table({c: pa.array(v, t) for c, v, t in zip(names, columns, kinds)})

    return rows.repartition(n, "group").groupBy("group").applyInArrow(packed, PIECES)
