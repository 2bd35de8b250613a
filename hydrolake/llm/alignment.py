"""Alignment of two tokenizers over the bytes of whole texts, by lockstep merging."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F
from sentencepiece import SentencePieceProcessor

from hydrolake.llm.common import CACHES, keyed, slices, written
from hydrolake.llm.encode import _RUN, encoder

#: Text bytes merged together, whose arrays take about a hundred times as much of a worker for a moment;
#: bytes of one lane of the state vector; pieces kept per worker.
BATCH, LANE, KEPT = 2 << 20, 4096, 300_000

#: A space of the vocabulary, and an entry that stands for one byte.
_SPACE, _BYTE = "▁", re.compile(r"<0x([0-9A-F]{2})>")


class Pair:
    """Both tokenizers, and the bytes of every entry of both vocabularies.

    ``encode`` gives the ids that each has for whole texts with a space before them. Where no entry
    of the sentencepiece vocabulary holds a space behind another character, its merges never cross
    into a space, as those of the byte-level side never do (see ``encode.py``); so the ids of a text
    are those of its pieces from space to space, each encoded once per worker, all new ones of a
    batch in one call. Texts with a space beside other white space, or one at the end, are encoded
    whole, and so are all if the vocabulary is another kind.
    """

    def __init__(self, path_a: str, path_b: str):
        self.a, self.b = encoder(path_a, True), SentencePieceProcessor(model_file=path_b)
        letter = {c: n for n, c in self.a.letters.items()}
        shown = [self.a.tok.id_to_token(i) or "" for i in range(self.a.vocab)]
        bytes_a = [bytes(map(letter.__getitem__, t)) if all(c in letter for c in t) else t.encode() for t in shown]
        names = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        bytes_b = [bytes([int(m[1], 16)]) if (m := _BYTE.fullmatch(p)) else p.replace(_SPACE, " ").encode() for p in names]
        self.len_a, self.len_b = (np.array(list(map(len, x)), np.int64) for x in (bytes_a, bytes_b))
        #: of each side all bytes in a row, where an entry starts in them, and its length
        self.spelling = [(np.frombuffer(b"".join(x), np.uint8), np.cumsum(n) - n, n) for x, n in ((bytes_a, self.len_a), (bytes_b, self.len_b))]
        self.apart = self.a.keeps and not any(re.search(f"[^{_SPACE}]{_SPACE}", p) for p in names)
        self.known: dict[str, tuple[bytes, bytes]] = {}
        #: decimal text of A ids before a comma and before the end of their side, then of B ids
        self.size_a, self.size_b = len(shown), len(names)
        self.decimals = np.array([f"{i}{end}" for end, n in ((",", self.size_a), ("|", self.size_a), (",", self.size_b), (";", self.size_b))
                                  for i in range(n)], bytes)
        self.decimals = self.decimals.view(np.uint8).reshape(len(self.decimals), -1)

    def fresh(self, pieces: list[str]) -> dict[str, tuple[bytes, bytes]]:
        """Ids of pieces not known yet, which are kept while there is room."""
        lists = self.b.encode(pieces, num_threads=1)
        flat, ends = np.fromiter(chain.from_iterable(lists), "<u4").tobytes(), np.cumsum([4 * len(x) for x in lists]).tolist()
        new = {p: (self.a.chunk(p), flat[s:e]) for p, s, e in zip(pieces, [0, *ends], ends)}
        if len(self.known) < KEPT:
            self.known.update(new)
        return new

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """All ids of A and all of B, and how many of each every text has; none where a text is empty
        or the bytes of one side's ids do not join to a space and the text."""
        cut = [t.split(" ") if t and self.apart and t[-1] != " " and not _RUN.search(" " + t) else None for t in texts]
        new = self.fresh(list({p for c in cut if c for p in c} - self.known.keys()))
        sides: tuple[list[bytes], list[bytes]] = [], []
        for text, pieces in zip(texts, cut):
            if pieces:
                both = [self.known.get(p) or new[p] for p in pieces]
                ids = [b"".join([x[side] for x in both]) for side in (0, 1)]
            elif text:
                ids = self.a.ids(" " + text), np.array(self.b.encode(text, num_threads=1), "<u4").tobytes()
            else:
                ids = b"", b""
            for side, x in zip(sides, ids):
                side.append(x)
        want = [b" " + t.encode() if t else b"" for t in texts]
        counts = [np.array([len(x) // 4 for x in side], np.int64) for side in sides]
        flat = [np.frombuffer(b"".join(side), "<u4").astype(np.int64) for side in sides]
        fine = self.spelt(flat[0], counts[0], 0, want) & self.spelt(flat[1], counts[1], 1, want)
        if not fine.all():
            flat = [x[np.repeat(fine, n)] for x, n in zip(flat, counts)]
            counts = [np.where(fine, n, 0) for n in counts]
        return flat[0], flat[1], counts[0], counts[1]

    def spelt(self, ids: np.ndarray, counts: np.ndarray, side: int, want: list[bytes]) -> np.ndarray:
        """Of each text, whether the bytes of its ids are these."""
        table, first, size = self.spelling[side]
        many = size[ids]
        place = np.repeat(first[ids] - np.cumsum(many) + many, many)
        place += np.arange(len(place))
        got, text = table[place], np.frombuffer(b"".join(want), np.uint8)
        total = np.concatenate([[0], np.cumsum(many)])[np.concatenate([[0], np.cumsum(counts)])]
        wanted = np.array(list(map(len, want)), np.int64)
        same = np.diff(total) == wanted
        if same.all():
            wrong = np.flatnonzero(got != text)
            same[np.searchsorted(np.cumsum(wanted), wrong, "right")] = False
        else:
            ends = np.cumsum(wanted)
            for d in np.flatnonzero(same):
                same[d] = np.array_equal(got[total[d]:total[d + 1]], text[ends[d] - wanted[d]:ends[d]])
        return same

    def groups(self, ids_a: np.ndarray, ids_b: np.ndarray, cut_a: np.ndarray, cut_b: np.ndarray) -> bytes:
        """``a1,a2|b1;a3|b2,b3`` of one document."""
        group_a, group_b = np.cumsum(cut_a) - cut_a, np.cumsum(cut_b) - cut_b
        many_a, many_b = np.bincount(group_a), np.bincount(group_b)
        codes = np.empty(len(ids_a) + len(ids_b), np.int64)
        codes[np.arange(len(ids_a)) + (np.cumsum(many_b) - many_b)[group_a]] = ids_a + self.size_a * cut_a
        codes[np.arange(len(ids_b)) + np.cumsum(many_a)[group_b]] = 2 * self.size_a + ids_b + self.size_b * cut_b
        shown = self.decimals[codes].ravel()
        return shown[shown != 0].tobytes()[:-1]


@lru_cache(maxsize=1)
def pair(path_a: str, path_b: str) -> Pair:
    """One per worker process."""
    return Pair(path_a, path_b)


CACHES.append(pair.cache_clear)


def _lanes(end_a: np.ndarray, end_b: np.ndarray, ends: np.ndarray, lane: int) -> np.ndarray:
    """Ends of lanes: those of documents, and in long ones the first end that both sides share at or
    after each multiple of ``lane`` bytes. No link crosses a shared end, so lanes are independent."""
    x = np.arange(lane, int(ends[-1]), lane)
    while len(x):
        y = end_b[np.searchsorted(end_b, end_a[np.searchsorted(end_a, x)])]
        if np.array_equal(x, y):
            break
        x = y
    return np.unique(np.concatenate([ends, x]))


def merge(end_a: np.ndarray, end_b: np.ndarray, ends: np.ndarray, lane: int = LANE):
    """Links ``(i, j)`` between tokens whose byte ranges overlap, and marks of the tokens of A and of B
    that end where both end. Ends are offsets in the joined bytes of all documents.

    One state vector holds a pointer into A and one into B for every unfinished lane. Each step
    links what the pointers stand at, moves on the side that ends first (both, at a cut), and
    drops finished lanes.
    """
    last = _lanes(end_a, end_b, ends, lane) if len(ends) else ends
    stop = np.searchsorted(end_a, last) + 1
    i = np.concatenate([[0], stop[:-1]]).astype(np.int32)
    j = np.concatenate([[0], np.searchsorted(end_b, last)[:-1] + 1]).astype(np.int32)
    if not len(ends):
        i = j = stop = np.zeros(0, np.int64)
    cut_a, cut_b = np.zeros(len(end_a), bool), np.zeros(len(end_b), bool)
    left, right = [], []
    while len(i):
        left.append(i)
        right.append(j)
        a, b = end_a[i], end_b[j]
        cut = a == b
        cut_a[i[cut]] = True
        cut_b[j[cut]] = True
        i, j = i + (a <= b), j + (b <= a)
        going = i < stop
        if not going.all():
            i, j, stop = i[going], j[going], stop[going]
    join = lambda x: np.concatenate(x) if x else np.zeros(0, np.int64)
    return join(left), join(right), cut_a, cut_b


ALIGNED = ("doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, groups string, "
           "chunk long, kinds array<int>, times array<long>, pairs array<long>")


def aligned(docs: DataFrame, path_a: str, path_b: str, with_groups: bool = False, doc_id: str = "doc_id",
            text: str = "text", batch: int = BATCH, lane: int = LANE) -> DataFrame:
    """Per document its tokens, groups and links; per chunk of documents its distinct id pairs.

    A row with ``pairs`` is a chunk's: its sorted id pairs (a * 2^32 + b) and how many links have
    each. Other rows are documents: ``kinds`` are the steps between the pairs of the chunk that
    occur in it (in ascending order, from -1), ``times`` their links.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both, chunk = pair(path_a, path_b), TaskContext.get().partitionId() << 32
        for part in slices(batches, "text", batch):
            n = part.num_rows
            flat_a, flat_b, all_a, all_b = both.encode([(t or b"").decode() for t in part["text"].to_pylist()])
            some = np.flatnonzero(all_a)
            n_a, n_b = all_a[some], all_b[some]
            end_a, end_b = np.cumsum(both.len_a[flat_a]), np.cumsum(both.len_b[flat_b])
            last_a, last_b = np.cumsum(n_a), np.cumsum(n_b)
            left, right, cut_a, cut_b = merge(end_a, end_b, end_a[last_a - 1], lane)
            owner = np.repeat(np.arange(len(some)), n_a)
            found = pa.array((flat_a[left] << 32) | flat_b[right]).dictionary_encode()
            pairs = found.dictionary.to_numpy()
            order = pairs.argsort()
            rank = np.empty_like(order)
            rank[order] = np.arange(len(order))
            pairs, kind = pairs[order], rank[found.indices.to_numpy()]
            sums = np.bincount(kind, minlength=len(pairs))
            in_doc, times = np.unique(owner[left] * max(1, len(pairs)) + kind, return_counts=True)
            doc_of, kind = np.divmod(in_doc, max(1, len(pairs)))
            bounds = np.searchsorted(doc_of, np.arange(len(some) + 1))
            step = np.diff(kind, prepend=-1)
            step[bounds[:-1]] = kind[bounds[:-1]] + 1
            shown = [both.groups(flat_a[p - m:p], flat_b[q - k:q], cut_a[p - m:p], cut_b[q - k:q])
                     for p, m, q, k in zip(last_a.tolist(), n_a.tolist(), last_b.tolist(), n_b.tolist())]
            place = np.full(n, -1)
            place[some] = np.arange(len(some))
            kinds_of = np.zeros(n + 1, np.int64)
            kinds_of[some] = np.diff(bounds)
            starts = np.concatenate([[0], np.cumsum(kinds_of)])

            def spread(values: np.ndarray) -> pa.Array:
                out = np.zeros(n + 1, np.int64)
                out[some] = values
                return pa.array(out)

            def lists(starts: np.ndarray, values: np.ndarray, kind: pa.DataType, mask: np.ndarray | None = None) -> pa.Array:
                return pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(values, kind), mask=None if mask is None else pa.array(mask))

            sha = [hashlib.sha256(shown[p]).hexdigest() if p >= 0 else "" for p in place.tolist()]
            yield pa.RecordBatch.from_arrays([
                pa.concat_arrays([part["doc_id"], pa.nulls(1, pa.int64())]), spread(n_a), spread(n_b),
                spread(np.bincount(owner[cut_a], minlength=len(some))), spread(np.bincount(owner[left], minlength=len(some))), pa.array(sha + [""]),
                pa.array([shown[p].decode() if with_groups and p >= 0 else None for p in place.tolist()] + [None], pa.string()),
                pa.array(np.full(n + 1, chunk)), lists(starts, step, pa.int32()),
                lists(np.append(starts[:-1], len(times) + len(sums)), np.concatenate([times, sums]), pa.int64()),
                lists(np.append(np.zeros(n + 1), len(pairs)), pairs, pa.int64(), np.arange(n + 1) < n)],
                [c.split()[0] for c in ALIGNED.split(", ")])
            chunk += 1

    return keyed(docs, doc_id, text).mapInArrow(run, ALIGNED)


def pair_counts(table: DataFrame) -> DataFrame:
    """``(pair, count, best)``: links of each id pair over all documents, and whether no other A id has
    more links with its B id (ties included). A B id has at most as many rows as A has ids."""
    links = table.where("pairs IS NOT NULL").select(F.explode(F.arrays_zip("pairs", "times")).alias("p"))
    counts = links.groupBy(F.col("p.pairs").alias("pair")).agg(F.sum("p.times").alias("count"))
    most = F.max("count").over(Window.partitionBy(F.col("pair").bitwiseAND(0xFFFFFFFF)))
    return counts.select("pair", "count", (F.col("count") == most).alias("best"))


def align(docs: DataFrame, path_a: str, path_b: str, with_groups: bool = False, doc_id: str = "doc_id",
          text: str = "text", batch: int = BATCH) -> DataFrame:
    """``(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256, groups)`` of every row.

    Both tokenizers read ``" " + text`` whole. Offsets where tokens of both end cut them into groups;
    tokens whose byte ranges overlap are linked. A link's count is how many links of the corpus
    join its two ids. ``groups`` (``a1,a2|b1;...``) only where asked for.

    Documents are aligned where they are read and written once. Each chunk of about ``batch`` bytes
    shuffles its distinct pairs, never its links: they meet the counts of the corpus, and those
    come back to the chunk's documents. So no task holds more than one chunk, and a pair that is
    everywhere counts once per chunk.

    Null and empty texts, and texts that either side's tokens do not spell, have zeros and ''.
    Repeated rows count each; a null id stays null. An empty table gives no rows.
    """
    table = written(aligned(docs, path_a, path_b, with_groups, doc_id, text, batch), "aligned")
    own = table.where("pairs IS NOT NULL").select("chunk", F.posexplode("pairs").alias("at", "pair"))
    found = own.join(pair_counts(table), "pair").select("chunk", "at", "count", "best")

    def summed(key: tuple, rows: pa.Table, counts: pa.Table) -> pa.Table:
        count, best = np.zeros(counts.num_rows, np.int64), np.zeros(counts.num_rows, bool)
        at = counts["at"].to_numpy()
        count[at], best[at] = counts["count"].to_numpy(), counts["best"].to_numpy(zero_copy_only=False)
        step, times = (rows[c].combine_chunks() for c in ("kinds", "times"))
        bounds = np.concatenate([[0], np.cumsum(step.value_lengths().to_numpy(zero_copy_only=False))]).astype(np.int64)
        flat, n = step.flatten().to_numpy().astype(np.int64), times.flatten().to_numpy()
        run = np.concatenate([[0], np.cumsum(flat)])
        kind = run[1:] - np.repeat(run[bounds[:-1]], np.diff(bounds)) - 1
        add = lambda x: np.diff(np.concatenate([[0], np.cumsum(x)])[bounds])
        return rows.drop_columns(["chunk", "kinds", "times"]).append_column("n_best", pa.array(add(n * best[kind]))).append_column(
            "count_sum", pa.array(add(n * count[kind])))

    kept = table.where("pairs IS NULL").drop("pairs")
    kept = kept.select(*[F.col(c).alias(c) for c in kept.columns])  # both sides come from one table
    out = [c for c in ALIGNED.split(", ") if c.split()[0] not in ("chunk", "kinds", "times", "pairs")]
    return kept.groupBy("chunk").cogroup(found.groupBy("chunk")).applyInArrow(
        summed, ", ".join(out + ["n_best long", "count_sum long"]))
