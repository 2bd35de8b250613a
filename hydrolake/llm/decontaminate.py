"""Benchmark items inside training documents: BM25, block-max WAND, verified overlap."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from hydrolake.llm.common import bucket, keyed, parts, slices, written

#: Items of one index block; bytes of item text in one index, which every task holds.
BLOCK, INDEX_BYTES = 2, 32 << 20
K1, B = 1.2, 0.75
#: ASCII letters in lower case, digits and non-ASCII bytes stand; all else parts words.
_PLAIN = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
_ANSWER = re.compile(r"(.*[.!?。！？])\s+(\S.*)", re.S)


def words(text: bytes | None) -> list[bytes]:
    """Lower-case words; case is dropped in all scripts."""
    text = text or b""
    return (text if text.isascii() else text.decode().lower().encode()).translate(_PLAIN).split()


def parted(text: str) -> tuple[str, str]:
    """Question and answer of an item that is one text: the answer is its last sentence. An item
    of one sentence is both."""
    m = _ANSWER.match(text.strip())
    return (m[1], m[2]) if m and words(m[1].encode()) and words(m[2].encode()) else (text, text)


def shingles(w: list[bytes], size: int) -> set[tuple]:
    return {tuple(w[i:i + size]) for i in range(len(w) - size + 1)}


class Index:
    """BM25 weights of test items by term, each item's sum scaled to one: a passage with all of an
    item's terms scores 1 on it. Postings lie in item order, cut in blocks that keep their maximum."""

    def __init__(self, items: list[tuple], size: int = 5, one_text: bool = False):
        """items: (id, question, answer), as texts; one_text: both are parts of one text."""
        self.items, self.size = [], size
        bags = []
        for key, question, answer in sorted(items, key=lambda x: (x[0] is None, x[0] or 0, x[1], x[2])):
            q, a = words(question.encode()), words(answer.encode())
            if bag := Counter(q if question == answer else q + a):
                self.items.append((key, q, a, q + a if one_text and question != answer else []))
                bags.append(bag)
        n, mean = len(bags), sum(b.total() for b in bags) / max(1, len(bags))
        seen = Counter(t for b in bags for t in b)
        #: term -> block -> (item, weight) in item order
        self.postings: dict[bytes, dict[int, list[tuple[int, float]]]] = {t: {} for t in seen}
        for i, bag in enumerate(bags):
            weight = {t: math.log(1 + (n - seen[t] + 0.5) / (seen[t] + 0.5)) * f * (K1 + 1)
                      / (f + K1 * (1 - B + B * bag.total() / mean)) for t, f in bag.items()}
            total = sum(weight.values())
            for t, w in weight.items():
                self.postings[t].setdefault(i // BLOCK, []).append((i, w / total))
        self.terms, self.blocks = frozenset(self.postings), -(-n // BLOCK)
        self.peaks = {t: (np.array(list(p)), np.array([max(w for _, w in x) for x in p.values()])) for t, p in self.postings.items()}

    def search(self, terms: list[bytes], least: float) -> list[tuple[int, float]]:
        """All items of score ``least`` or more, by block-max WAND.

        Blocks whose maxima together stay below the threshold are passed over. In the others a
        cursor per term walks the block's postings; the pivot is the first item at which the
        maxima of the cursors up to it reach the threshold, and only pivots are scored.
        """
        least -= 1e-9
        peaks = [self.peaks[t] for t in terms]
        bounds = np.bincount(np.concatenate([p[0] for p in peaks]), np.concatenate([p[1] for p in peaks]), self.blocks)
        found = []
        for block in np.flatnonzero(bounds >= least).tolist():
            lists = [p[block] for t in terms if block in (p := self.postings[t])]
            cursors = [[x[0][0], 0, max(w for _, w in x), x] for x in lists]  # item, place, maximum, postings
            while cursors:
                cursors.sort(key=lambda c: c[0])
                bound, pivot = 0.0, None
                for c in cursors:
                    bound += c[2]
                    if bound >= least:
                        pivot = c[0]
                        break
                if pivot is None:
                    break
                if cursors[0][0] == pivot:
                    score = sum(c[3][c[1]][1] for c in cursors if c[0] == pivot)
                    if score >= least:
                        found.append((pivot, score))
                    pivot += 1
                for c in cursors:
                    while c[0] is not None and c[0] < pivot:
                        c[1] += 1
                        c[0] = c[3][c[1]][0] if c[1] < len(c[3]) else None
                cursors = [c for c in cursors if c[0] is not None]
        return found

    def leaks(self, text: bytes | None, least: float, overlap: float) -> list[tuple]:
        """(item id, score, question overlap, answer overlap) of what a passage holds."""
        w = words(text)
        terms = sorted(self.terms.intersection(w))
        if not terms:
            return []
        out, made = [], {}

        def share(side: list[bytes]) -> float:
            n = min(self.size, len(side))
            if n not in made:
                made[n] = shingles(w, n)
            own = shingles(side, n)
            return len(own & made[n]) / len(own)

        for i, score in self.search(terms, least):
            key, question, answer, whole = self.items[i]
            shares = share(question), share(answer)
            if min(shares) >= overlap or whole and share(whole) >= overlap:
                out.append((key, score, *shares))
        return out


def indexes(items: DataFrame, item_id: str, text: str, question: str | None, answer: str | None) -> Iterator[Index]:
    """Indexes of about INDEX_BYTES of item text each; one for usual benchmarks. However large the
    test set is, no item is left out and no task holds more than one index."""
    cols = [F.col(c).cast("string") for c in ((question, answer) if question else (text, text))]
    rows = items.select(F.col(item_id).cast("long").alias("i"), cols[0].alias("q"), cols[1].alias("a"))
    size = rows.agg(F.sum(F.octet_length("q") + (F.octet_length("a") if question else F.lit(0)))).first()[0] or 0
    n = parts(size, INDEX_BYTES)
    for k in range(n):
        part = rows.where(bucket(n, "i", "q", "a") == k) if n > 1 else rows
        got = [(r[0], r[1] or "", r[2] or "") for r in part.collect()]
        yield Index(got) if question else Index([(i, *parted(q)) for i, q, _ in got], one_text=True)


LEAKS = "doc_id long, item_id long, score double, question_overlap double, answer_overlap double"


def find(docs: DataFrame, items: DataFrame, least: float = 0.6, overlap: float = 0.8, doc_id: str = "doc_id",
         text: str = "text", item_id: str = "item_id", item_text: str = "text", question: str | None = None,
         answer: str | None = None) -> DataFrame:
    """One row per document and benchmark item that it holds: ids, score, overlaps.

    Every whole document queries the inverted index of test items; all items of at least
    ``least`` of their own full BM25 score are retrieved, and kept if at least ``overlap`` of
    their question's and of their answer's five-word shingles stand in the document (shorter
    sides: the whole side). Documents are only scanned: nothing is shuffled, and a hot source is
    as cheap as any. Items without question and answer columns are parted at the last sentence, and
    such an item is also held if ``overlap`` of the shingles of its whole text are: one changed word
    in a short last sentence does not hide it.

    Null text holds nothing. Null ids, of documents and of items, stay null. Repeated rows are
    reported each. Items without words are passed over. Empty tables give no rows.
    """
    def run(index: Index):
        def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in slices(batches, "text"):
                rows = [(d, *x) for d, t in zip(b["doc_id"].to_pylist(), b["text"].to_pylist()) for x in index.leaks(t, least, overlap)]
                kinds = [pa.int64()] * 2 + [pa.float64()] * 3
                columns = [pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "item_id", "score", "question_overlap", "answer_overlap"])
        return mapped

    done, plain = None, keyed(docs, doc_id, text)
    for index in indexes(items, item_id, item_text, question, answer):
        got = plain.mapInArrow(run(index), LEAKS)
        done = got if done is None else written(done, "leaks").unionByName(got)
    return done


def leaking(index: Index, text: str = "text", least: float = 0.6, overlap: float = 0.8) -> Column:
    """Whether a text holds an item of the index."""
    @F.pandas_udf("boolean")
    def run(series: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in series:
            yield pd.Series([bool(index.leaks(t, least, overlap)) for t in texts], dtype=bool)

    return run(F.col(text).cast("string").cast("binary"))


def clean(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The documents that hold no benchmark item, items without id included.

    Null texts hold nothing and stay, and so do repeated rows and null ids. An empty table of
    documents gives no rows, one of items keeps all. Columns may have any name.
    """
    for index in indexes(items, "item_id", "text", None, None):
        docs = docs.where(~leaking(index))
    return docs
