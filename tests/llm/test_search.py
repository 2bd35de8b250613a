"""Top-k, decontamination, SimHash: brute force and edge cases."""

import math
import random
import re
from collections import Counter

import numpy as np
import xxhash
from pyspark.sql import functions as F

from hydrolake.llm import decontaminate, simhash, topk
from hydrolake.llm.components import components
from tests.llm.conftest import EDGE


def brute_top(rows, k, every):
    best = {}
    for i, v in rows.items():
        if v is not None and all(x is not None and np.isfinite(x) for x in v):
            best[i] = np.floor(64 * np.array(v, float)).astype(int)
    out = set()
    for q, v in best.items():
        if q % every == 0:
            found = sorted(((-int(v @ w), i) for i, w in best.items() if i != q and len(w) == len(v)))[:k]
            out |= {(q, r + 1, i, -s) for r, (s, i) in enumerate(found)}
    return out


def test_top_k_against_brute_force(spark):
    rng = np.random.default_rng(3)
    rows = {i: np.float32(rng.normal(0, 0.2, 8)).tolist() for i in range(300)}
    rows |= {i: rows[7] for i in range(300, 380)}  # many ties
    rows |= {400: None, 401: [1.0, None] + [0.0] * 6, 402: [float("nan")] * 8, 403: [float("inf")] * 8, 404: [0.5, 0.5], 405: [0.1, 0.9], 420: [0.0] * 8}
    df = spark.createDataFrame([(i, v, "x") for i, v in rows.items()] + [(None, [0.1] * 8, "x")], "vec_id long, embedding array<float>, block string")
    for block in (8192, 64):
        got = {tuple(r) for r in topk.top_k(df, k=5, every=20, block=block).collect()}
        assert got == brute_top(rows, 5, 20)


def test_top_k_of_nothing(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert topk.top_k(df).collect() == []


def brute_leaks(docs, items, least, overlap):
    """BM25 of every document against every item, from the formula; then all shingles compared."""
    split = lambda t: re.findall(r"[0-9a-z\u0080-\U0010ffff]+", "".join(c if c.isascii() and c.isupper() is False else c.lower() for c in (t or "")))
    known = []
    for key, text in items:
        m = re.match(r"(.*[.!?。！？])\s+(\S.*)", (text or "").strip(), re.S)
        sides = [split(m[1]), split(m[2])] if m and split(m[1]) and split(m[2]) else [split(text)] * 2
        if split(text):
            known.append((key, split(text), sides, bool(m) and sides[0] != sides[1]))
    n, mean = len(known), sum(len(w) for _, w, *_ in known) / max(1, len(known))
    seen = Counter(t for _, w, *_ in known for t in set(w))
    idf = {t: math.log(1 + (n - c + 0.5) / (c + 0.5)) for t, c in seen.items()}
    runs = lambda w, size: {tuple(w[k:k + size]) for k in range(len(w) - size + 1)}
    out = set()
    for d, text in docs:
        w = split(text)
        for key, own, sides, parted in known:
            weight = {t: idf[t] * f * 2.2 / (f + 1.2 * (0.25 + 0.75 * len(own) / mean)) for t, f in Counter(own).items()}
            if sum(weight[t] for t in weight.keys() & set(w)) >= least * sum(weight.values()) - 1e-9:
                share = lambda s: len(runs(s, min(5, len(s))) & runs(w, min(5, len(s)))) / len(runs(s, min(5, len(s))))
                if min(map(share, sides)) >= overlap or parted and share(own) >= overlap:
                    out.add((d, key))
    return out


def test_leaks_against_brute_force(spark, frame):
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcde") for _ in range(rng.randint(1, 4)))
    items = [(i, " ".join(word() for _ in range(rng.randint(3, 30))) + ". " + " ".join(word() for _ in range(rng.randint(1, 8))) + ".") for i in range(60)]
    docs = []
    for d in range(200):
        text = [word() for _ in range(rng.randint(0, 80))]
        for _ in range(rng.randint(0, 2)):
            piece = rng.choice(items)[1].split()
            for _ in range(rng.choice([0, 0, 1, 3])):
                piece[rng.randrange(len(piece))] = word()
            text[rng.randint(0, len(text)):0] = piece
        docs.append((d, " ".join(text).upper() if d % 9 == 0 else " ".join(text)))
    items += [(None, "no id here at all"), (90, None), (91, " .. "), (92, " ".join(f"q{k}" for k in range(19)) + ". Paris.")]
    docs += [(300, "x no id here at all"), (301, items[-1][1].replace("Paris", "London")), (302, items[-1][1].replace("q9", "zz"))]
    it = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.find(frame(docs + EDGE), it).collect()
    want = brute_leaks(docs + EDGE, items, 0.6, 0.8)
    assert {(300, None), (301, 92)} <= want
    assert {(r.doc_id, r.item_id) for r in got} == want and len(want) > 50
    kept = {r.doc_id for r in decontaminate.clean(frame(docs), it).select("doc_id").collect()}
    assert kept == {d for d, _ in docs} - {d for d, _ in want}


def test_leaks_with_question_and_answer_and_of_nothing(spark, frame):
    it = spark.createDataFrame([(1, "what is the name of the hill", "blue peak")], "item_id long, q string, a string")
    docs = frame([(1, "What is the name of the hill? Blue Peak."), (2, "what is the name of the hill, nobody knows")])
    assert [r.doc_id for r in decontaminate.find(docs, it, least=0.3, question="q", answer="a").collect()] == [1]
    assert decontaminate.find(docs, it.where("false"), question="q", answer="a").collect() == []
    assert decontaminate.find(docs.where("false"), it, question="q", answer="a").collect() == []


def plain_fingerprint(t):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    n = min(3, len(w))
    hs = [xxhash.xxh64_intdigest(" ".join(w[k:k + n]).encode(), 42) for k in range(len(w) - n + 1)] if w else []
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def test_fingerprints():
    for _, t in EDGE:
        assert simhash.fingerprint((t or "").encode()) == plain_fingerprint(t)


def brute_near(x, bits):
    up = list(range(len(x)))

    def find(a):
        while up[a] != a:
            a = up[a]
        return a

    for i in range(len(x)):
        for j in range(i):
            if int(x[i] ^ x[j]).bit_count() <= bits:
                a, b = find(i), find(j)
                up[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(x))]


def clusters(seed=1):
    rng = np.random.default_rng(seed)
    centres = rng.integers(0, 1 << 63, 12, dtype=np.uint64)
    near = [c ^ np.uint64(sum(1 << int(b) for b in rng.choice(64, rng.integers(0, 6), replace=False))) for c in centres for _ in range(60)]
    return np.unique(np.concatenate([np.array(near, np.uint64), rng.integers(0, 1 << 63, 500, dtype=np.uint64)]))


def test_links_find_every_pair_over_many_shards(spark):
    x = clusters()
    df = spark.createDataFrame([(int(v),) for v in x.view(np.int64)], "fp long")
    edges = simhash.links(df, 3, shard=100)
    root = dict(components(edges).collect())
    got = [root.get(int(v), int(v)) for v in x.view(np.int64)]
    want = brute_near(x, 3)
    pairs = {(a, b) for a, b in zip(got, want)}
    assert len(pairs) == len(set(got)) == len(set(want)) < len(x)


def test_near_alone():
    x = clusters(2)
    assert len(set(zip(simhash.near(x, len(x), 3).tolist(), brute_near(x, 3)))) == len(set(brute_near(x, 3)))


def test_classes_edges(frame):
    rows = simhash.classes(frame(EDGE)).collect()
    assert len(rows) == len(EDGE)
    by = {(r.doc_id, r.fingerprint): r.component_id for r in rows}
    assert by[5, f"{plain_fingerprint('alpha beta gamma delta'):016x}"] == 1
    assert by[4, "0" * 16] == 2 and by[3, "0" * 16] == 2
    assert all(c is None for (d, _), c in by.items() if d is None)
    assert simhash.classes(frame([])).collect() == []
    docs = frame(EDGE)
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert Counter(r.doc_id for r in kept.select("doc_id").collect()) == Counter([1, 2, 6, 6, 7, 8, 9, None, None])


def test_one_row_stays_of_each_component(spark):
    """Repeated ids of unlike and of near texts, a hot id, columns of any name."""
    base = " ".join(f"w{k}" for k in range(300))
    near = base.replace("w299", "other")
    assert bin(plain_fingerprint(base) ^ plain_fingerprint(near)).count("1") <= 3
    docs = [(1, base), (1, "quite another text of its own"), (2, near), (3, near), (3, "third of its kind, unlike all"), (3, "third of its kind, unlike all"),
            (5, "twice under five"), (4, "twice under five"), (None, base)] + [(9, "hot id with one text")] * 500
    rows = [(i, t, n, "a", "b", "c") for n, (i, t) in enumerate(docs)]
    df = spark.createDataFrame(rows, "doc_id long, text string, __kept int, __row string, row string, fp string")
    kept = simhash.keep_one(df)
    assert kept.columns == df.columns
    assert Counter((r.doc_id, r.text) for r in kept.collect()) == Counter(
        [(1, base), (1, "quite another text of its own"), (3, "third of its kind, unlike all"), (4, "twice under five"), (None, base), (9, "hot id with one text")])


def test_components_of_a_long_path(spark):
    df = spark.range(200).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    assert {r.root for r in components(df).collect()} == {0}
    assert components(df.where("false")).collect() == []
