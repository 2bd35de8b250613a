"""Language of whole texts: a byte-level convolutional network, trained and applied in numpy."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from hydrolake.llm.common import free, release

#: Bytes of a window; filter widths; filters of each width.
LENGTH, WIDTHS, FILTERS = 128, (2, 3, 4), 8
#: Training rows per language, windows of each, and languages: the bound of what the driver collects.
PER_LANGUAGE, PER_TEXT, LANGUAGES = 600, 3, 200
#: Windows scored at once, and bytes of text cut into windows at once.
CHUNK, STEP = 512, 2 << 20


@dataclass
class ByteNet:
    """Filters over one-hot bytes of several widths, the maximum over a window, softmax.

    ``filters[w]`` has shape (w, 256, FILTERS): what a byte at each place adds to a filter.
    """

    languages: list[str]
    filters: dict[int, np.ndarray]
    bias: np.ndarray
    dense: np.ndarray
    base: np.ndarray

    def tables(self) -> list[tuple[int, list[np.ndarray]]]:
        """Per filter its table of byte pairs, and what follows: a second pair, or a single byte."""
        out = []
        for w, f in self.filters.items():
            for k in range(f.shape[2]):
                one = f[:, :, k]
                pairs = [(one[i][:, None] + one[i + 1][None, :]).ravel() for i in range(0, w - 1, 2)]
                out.append((w, pairs + ([one[w - 1]] if w % 2 else [])))
        return out


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def fit(windows: np.ndarray, labels: np.ndarray, languages: list[str], epochs: int = 8, batch: int = 64,
        rate: float = 0.01, seed: int = 7) -> ByteNet:
    """Cross-entropy by Adam; the gradient of a maximum goes to the place that attains it."""
    rng = np.random.default_rng(seed)
    n, total = len(windows), len(WIDTHS) * FILTERS
    p = {f"f{w}": rng.normal(0, 0.1, (w, 256, FILTERS)).astype(np.float32) for w in WIDTHS}
    p |= {"bias": np.zeros(total, np.float32), "dense": rng.normal(0, 0.3, (total, len(languages))).astype(np.float32),
          "base": np.zeros(len(languages), np.float32)}
    mean = {k: np.zeros_like(v) for k, v in p.items()}
    power = {k: np.zeros_like(v) for k, v in p.items()}
    step = 0
    for _ in range(epochs):
        order = rng.permutation(n)
        for s in range(0, n, batch):
            x, y = windows[order[s:s + batch]], labels[order[s:s + batch]]
            rows, best, tops = np.arange(len(x))[:, None], {}, []
            for w in WIDTHS:
                z = sum(p[f"f{w}"][k][x[:, k:LENGTH - w + 1 + k]] for k in range(w))
                best[w] = z.argmax(axis=1)
                tops.append(np.take_along_axis(z, best[w][:, None, :], axis=1)[:, 0])
            h = np.concatenate(tops, axis=1) + p["bias"]
            r = np.maximum(h, 0)
            d = _softmax(r @ p["dense"] + p["base"])
            d[np.arange(len(x)), y] -= 1
            d /= len(x)
            back = (d @ p["dense"].T) * (h > 0)
            g = {"dense": r.T @ d, "base": d.sum(axis=0), "bias": back.sum(axis=0)}
            for i, w in enumerate(WIDTHS):
                g[f"f{w}"] = np.zeros_like(p[f"f{w}"])
                part = back[:, i * FILTERS:(i + 1) * FILTERS]
                for k in range(w):
                    np.add.at(g[f"f{w}"][k], (x[rows, best[w] + k], np.arange(FILTERS)[None, :]), part)
            step += 1
            for k, v in g.items():
                mean[k] = 0.9 * mean[k] + 0.1 * v
                power[k] = 0.999 * power[k] + 0.001 * v * v
                p[k] -= rate * (mean[k] / (1 - 0.9 ** step)) / (np.sqrt(power[k] / (1 - 0.999 ** step)) + 1e-8)
    return ByteNet(languages, {w: p[f"f{w}"] for w in WIDTHS}, p["bias"], p["dense"], p["base"])


def cut(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts of all windows, how many each text has, and the joined, blank-padded bytes. Windows overlap by the widest
    filter less one byte, so no filter position of the text is left out."""
    step = LENGTH - max(WIDTHS) + 1
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    counts = np.maximum(1, -(-(sizes - max(WIDTHS) + 1) // step))
    pad = b" " * LENGTH
    joined = np.frombuffer(pad.join(texts) + pad, np.uint8)
    firsts = np.cumsum(sizes + LENGTH) - (sizes + LENGTH)
    nth = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    return (np.repeat(firsts, counts) + nth * step), counts, joined


def predict(net: ByteNet, tables: list, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Language number and mean probability of each text over all its windows."""
    starts, counts, joined = cut([t.lower() for t in texts])
    probs = np.empty((len(starts), len(net.languages)))
    places = np.arange(LENGTH)
    for s in range(0, len(starts), CHUNK):
        x = joined[starts[s:s + CHUNK, None] + places].astype(np.intp)
        pair, top = x[:, :-1] * 256 + x[:, 1:], np.empty((len(x), len(tables)), np.float32)
        for i, (w, parts) in enumerate(tables):
            n = LENGTH - w + 1
            z = parts[0].take(pair[:, :n], mode="clip")
            for j, t in enumerate(parts[1:]):
                at = 2 * (j + 1)
                z += t.take((x if t.size == 256 else pair)[:, at:at + n], mode="clip")
            z.max(axis=1, out=top[:, i])
        probs[s:s + CHUNK] = _softmax(np.maximum(top + net.bias, 0) @ net.dense + net.base)
    mean = np.add.reduceat(probs, np.cumsum(counts) - counts, axis=0) / counts[:, None]
    return mean.argmax(axis=1), mean.max(axis=1)


def train(docs: DataFrame, learn: Column, text: str = "text", lang: str = "lang", doc_id: str = "doc_id",
          per_language: int = PER_LANGUAGE, per_text: int = PER_TEXT, languages: int = LANGUAGES) -> ByteNet | None:
    """A network from the rows where ``learn`` holds and the language is not null.

    Bounded sample: of the ``languages`` values with most ids (ties: smaller name; the rest, as a
    dirty column may have, are not learned) each the ``per_language`` ids of smallest hash, of each id
    one row and of it ``per_text`` windows spread over the text by hash. Rows without id are known by
    their text instead, rows without a byte of text teach nothing. None if there is nothing to
    learn from.
    """
    rows = docs.where(learn & F.col(lang).isNotNull()).select(
        F.col(doc_id).alias("i"), F.col(lang).cast("string").alias("l"), F.col(text).cast("string").cast("binary").alias("t")).where(
        F.octet_length("t") > 0)
    known = F.when(F.col("i").isNull(), F.xxhash64("t")).otherwise(F.xxhash64("i"))
    rows = rows.withColumn("h", F.shiftrightunsigned(known, 1))
    # of each language some three times the ids wanted, by hash, before any are put in order
    counts = rows.groupBy("l").agg(F.approx_count_distinct("h").alias("c")).orderBy(F.desc("c"), "l").limit(languages)
    near = rows.select("l", "h").join(F.broadcast(counts), "l").where(F.col("h") / 2.0 ** 63 <= 3.0 * per_language / F.col("c"))
    first = Window.partitionBy("l").orderBy("h")
    ids = near.select("l", "h").distinct().withColumn("n", F.row_number().over(first)).where(F.col("n") <= per_language).select("l", "h")
    picked = rows.join(F.broadcast(ids), ["l", "h"])
    room = F.greatest(F.octet_length("t") - LENGTH + 1, F.lit(1))
    cuts = F.array(*[F.substring("t", (F.pmod(F.xxhash64("i", F.lit(k)), room) + 1).cast("int"), LENGTH) for k in range(per_text)])
    one = picked.select("l", "h", cuts.alias("w")).groupBy("l", "h").agg(F.min("w").alias("w"))
    got = one.select("l", F.explode("w").alias("w")).orderBy("l", "w").collect()
    if not got:
        return None
    names = sorted({r[0] for r in got})
    x = np.frombuffer(b"".join(bytes(r[1]).lower().ljust(LENGTH) for r in got), np.uint8).reshape(-1, LENGTH)
    return fit(x, np.array([names.index(r[0]) for r in got]), names)


def language(net: ByteNet | None, text: str = "text") -> Column:
    """``struct(lang_pred, score)`` of a text column; ``und`` and 0 for a null text or one without
    a letter, and for all texts if nothing was learned. Every byte of a text is read."""
    @F.pandas_udf("lang_pred string, score double")
    def run(series: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        release()
        tables = net.tables() if net else []
        for texts in series:
            pred, score = np.full(len(texts), "und", object), np.zeros(len(texts))
            known = np.flatnonzero(texts.notna().to_numpy()) if net else []
            # some megabytes of text at a time
            part = np.cumsum([len(t) for t in texts.iloc[known]]) // STEP if len(known) else np.zeros(0, int)
            for at in np.split(np.asarray(known, int), np.flatnonzero(np.diff(part)) + 1):
                if len(at):
                    which, score[at] = predict(net, tables, texts.iloc[at].tolist())
                    pred[at] = np.array(net.languages, object)[which]
            yield pd.DataFrame({"lang_pred": pred, "score": score})

    whole = F.col(text).cast("string")
    return run(F.when(whole.rlike(r"\p{L}"), whole.cast("binary")))


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows that no network learns from: a quarter, by the crc32 of the id as text."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def identify(docs: DataFrame, text: str = "text", lang: str = "lang", doc_id: str = "doc_id") -> DataFrame:
    """``docs`` with ``held_out``, ``lang_pred`` and ``score``, by a network learned from its rows
    that are not held out.

    Columns of these three names in ``docs`` are replaced; any other name may stand beside them.
    Null texts and texts without a letter are ``und`` with score 0, empty tables give no rows,
    repeated rows are predicted each, null ids are never held out. Of two languages with the same
    probability the first by name counts.
    """
    net, told = train(docs, ~held_out(doc_id), text, lang, doc_id), free(docs, "told")
    return docs.withColumn(told, language(net, text)).withColumn("held_out", held_out(doc_id)).withColumns(
        {"lang_pred": F.col(f"{told}.lang_pred"), "score": F.col(f"{told}.score")}).drop(told)


def known_language(docs: DataFrame, least: float = 0.4) -> DataFrame:
    """Documents whose language is told: not ``und``, mean probability of at least ``least``.

    If no row has a language to learn from, all texts with a letter stay. Null texts and texts
    without a letter go, repeated rows and null ids are judged each by their text, and columns
    may have any name. An empty table gives no rows.
    """
    net = train(docs, ~held_out())
    if net is None:
        return docs.where(F.col("text").cast("string").rlike(r"\p{L}"))
    told = free(docs, "told")
    known = docs.withColumn(told, language(net)).where((F.col(f"{told}.lang_pred") != "und") & (F.col(f"{told}.score") >= least))
    return known.select(*[F.col(f"`{c}`") for c in docs.columns])
