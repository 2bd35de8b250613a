"""Text quality by a generalised additive model with pairwise interactions."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

#: Bins of a feature, and of each side of a pair; pairs kept; labelled rows learned from at most.
BINS, PAIR_BINS, PAIRS, MOST_ROWS = 64, 8, 6, 20_000
FEATURES = ("bytes", "words", "word_length", "upper", "digits", "symbols", "stops", "marks", "blank", "wide", "distinct",
            "repeat", "lines", "line_repeat", "top_word", "long_word", "same_end", "inner_upper")
_CLASS = np.zeros(256, np.int64)  # 0 other symbol, 1 lower, 2 upper, 3 digit, 4 stop or comma, 5 mark, 6 white space, 7 non-ASCII
for _i in range(256):
    _c = chr(_i)
    _CLASS[_i] = 7 if _i > 127 else 1 if _c.islower() else 2 if _c.isupper() else 3 if _c.isdigit() else 4 if _c in ".," else 5 if _c in "!?;:'\"()-" else 6 if _c.isspace() else 0


def features(text: bytes | None) -> list[float]:
    """Shape of a whole text: sizes, shares of kinds of bytes, repetition of words and lines."""
    text = text or b""
    n, w = max(1, len(text)), text.split()
    kinds = np.bincount(_CLASS, np.bincount(np.frombuffer(text, np.uint8), minlength=256), 8) / n
    m, bag = max(1, len(w)), Counter(w)
    lines = [x for x in text.split(b"\n") if x.strip()]
    pairs = max(1, len(w) - 1)
    ends = Counter(x[-1] for x in w).most_common(1)[0][1] if w else 0
    return [len(text), len(w), (len(text) - len(w)) / m, kinds[2], kinds[3], kinds[0], kinds[4], kinds[5], kinds[6], kinds[7],
            len(bag) / m, 1 - len(set(zip(w, w[1:]))) / pairs, len(lines) / m, 1 - len(set(lines)) / max(1, len(lines)),
            max(bag.values(), default=0) / m, max(map(len, bag), default=0), ends / m, sum(x.isupper() for x in bag) / max(1, len(bag))]


@dataclass
class Additive:
    """Bin edges per feature, one table of additions per feature and per pair, and a base."""

    edges: list[np.ndarray]
    tables: list[np.ndarray]
    pairs: list[tuple[int, int]]
    coarse: list[np.ndarray]
    pair_tables: list[np.ndarray]
    base: float

    def binned(self, x: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(edges)], axis=1)

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1: additions looked up by bin, for all rows at once."""
        fine, rough = self.binned(x, self.edges), self.binned(x, self.coarse)
        total = np.full(len(x), self.base)
        for j, t in enumerate(self.tables):
            total += t[fine[:, j]]
        for (a, b), t in zip(self.pairs, self.pair_tables):
            total += t[rough[:, a], rough[:, b]]
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def _quantiles(x: np.ndarray, bins: int) -> list[np.ndarray]:
    return [np.unique(np.quantile(c, np.linspace(0, 1, bins + 1)[1:-1])) for c in x.T]


def _tree(g: np.ndarray, h: np.ndarray, leaves: int = 3, ridge: float = 1.0) -> np.ndarray:
    """A tree over the bins of one feature: the best cut of any leaf, until ``leaves`` are made;
    g, h are gradient and curvature sums per bin. Gives what each bin adds."""
    spans = [(0, len(g))]
    gs, hs = np.concatenate([[0], np.cumsum(g)]), np.concatenate([[0], np.cumsum(h)])
    gain = lambda a, b: (gs[b] - gs[a]) ** 2 / (hs[b] - hs[a] + ridge)
    while len(spans) < leaves:
        best = None
        for k, (a, b) in enumerate(spans):
            if b - a > 1:
                mid = np.arange(a + 1, b)
                won = gain(a, mid) + gain(mid, b) - gain(a, b)
                i = int(won.argmax())
                if won[i] > 1e-9 and (best is None or won[i] > best[0]):
                    best = (won[i], k, int(mid[i]))
        if best is None:
            break
        _, k, mid = best
        a, b = spans[k]
        spans[k:k + 1] = [(a, mid), (mid, b)]
    out = np.zeros(len(g))
    for a, b in spans:
        out[a:b] = (gs[b] - gs[a]) / (hs[b] - hs[a] + ridge)
    return out


def fit(x: np.ndarray, y: np.ndarray, rounds: int = 150, rate: float = 0.15) -> Additive:
    """Cyclic boosting: round by round each feature in turn gets one shallow tree over its bins,
    fitted to what all others leave, so no feature takes what another explains as well. Then
    the pairs of features whose coarse grid gains most get grids of their own, in the same way."""
    edges, coarse = _quantiles(x, BINS), _quantiles(x, PAIR_BINS)
    share = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    model = Additive(edges, [np.zeros(len(e) + 1) for e in edges], [], coarse, [], float(np.log(share / (1 - share))))
    fine, rough = model.binned(x, edges), model.binned(x, coarse)
    total = np.full(len(y), model.base)

    def slopes() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-total))
        return y - p, p * (1 - p)

    for _ in range(rounds):
        for j, t in enumerate(model.tables):
            g, h = slopes()
            add = rate * _tree(np.bincount(fine[:, j], g, len(t)), np.bincount(fine[:, j], h, len(t)))
            t += add
            total += add[fine[:, j]]
    g, h = slopes()
    shape = lambda a, b: (len(coarse[a]) + 1, len(coarse[b]) + 1)
    cell = lambda a, b: rough[:, a] * (len(coarse[b]) + 1) + rough[:, b]
    gains = []
    for a, b in combinations(range(x.shape[1]), 2):
        n = shape(a, b)[0] * shape(a, b)[1]
        gains.append((-(np.bincount(cell(a, b), g, n) ** 2 / (np.bincount(cell(a, b), h, n) + 1)).sum(), a, b))
    model.pairs = [(a, b) for _, a, b in sorted(gains)[:PAIRS]]
    model.pair_tables = [np.zeros(shape(a, b)) for a, b in model.pairs]
    for _ in range(rounds // 5):
        for (a, b), t in zip(model.pairs, model.pair_tables):
            g, h = slopes()
            gb, hb = (np.bincount(cell(a, b), v, t.size).reshape(t.shape) for v in (g, h))
            # a tree on one side, then on the other in each half: cells move by their row and column
            rows = _tree(gb.sum(1), hb.sum(1))
            half = rows > np.median(rows)
            add = np.stack([_tree(gb[half == s].sum(0), hb[half == s].sum(0)) for s in (False, True)])[half.astype(int)]
            t += rate * add
            total += rate * add[rough[:, a], rough[:, b]]
    return model


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows no model learns from: a fifth, by the crc32 of the id as text."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality",
          most: int = MOST_ROWS) -> Additive | None:
    """Learned from at most ``most`` labelled rows that are not held out, those of smallest id hash:
    the documented bound of what the driver holds (some MB of features). Ids labelled both 0 and 1
    and null labels teach nothing. None if no row is left."""
    known = labels.where(~held_out(doc_id) & F.col(label).isin(0, 1)).groupBy(F.col(doc_id).cast("long").alias("i")).agg(
        F.min(label).alias("y"), F.max(label).alias("z")).where("y = z AND i IS NOT NULL")
    ids = known.orderBy(F.xxhash64("i"), "i").limit(most).select("i", "y")
    rows = docs.select(F.col(doc_id).cast("long").alias("i"), F.col(text).cast("string").cast("binary").alias("t"))
    got = rows.join(F.broadcast(ids), "i").select("i", "y", measured("t").alias("x")).orderBy("i", "x").collect()
    if not got:
        return None
    return fit(np.array([r[2] for r in got]), np.array([r[1] for r in got], float))


def measured(text: str) -> Column:
    """``features`` of a binary text column."""
    @F.pandas_udf("array<double>")
    def run(series: pd.Series) -> pd.Series:
        return pd.Series([[float(v) for v in features(t)] for t in series], dtype=object)

    return run(F.col(text))


def quality(model: Additive | None, text: str = "text") -> Column:
    """Score of a text column, 0 to 1; without a model one half. Null counts as empty."""
    @F.pandas_udf("double")
    def run(series: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in series:
            x = np.array([features(t) for t in texts]).reshape(len(texts), len(FEATURES))
            yield pd.Series(model.score(x) if model else np.full(len(texts), 0.5))

    return run(F.col(text).cast("string").cast("binary"))


def scored(docs: DataFrame, labels: DataFrame, least: float = 0.3, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with ``held_out``, ``score`` and ``predicted`` (1 from ``least`` on). Only the whole
    text is an input of a score. Columns of these names are replaced. Empty table: no rows."""
    model = train(docs, labels, doc_id, text)
    return docs.withColumns({"held_out": held_out(doc_id), "score": quality(model, text)}).withColumn(
        "predicted", (F.col("score") >= least).cast("int"))
