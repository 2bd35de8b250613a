"""Substring dedup, shards, licenses, language, quality: brute force and edge cases."""

import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import Row, functions as F

from hydrolake.llm import langid, licenses, quality, shards, substrings
from hydrolake.llm.queries import ORACLE_SQL, QUERIES
from tests.llm.conftest import EDGE


def brute_dedup(docs, window):
    first = {}
    split = {k: re.findall(r"[^\x20\x09-\x0D]+", t or "") for k, (_, t) in enumerate(docs)}
    key = lambda i: float("inf") if i is None else i
    for k, (i, _) in enumerate(docs):
        for p in range(len(split[k]) - window + 1):
            g = tuple(split[k][p:p + window])
            first[g] = min(first.get(g, float("inf")), key(i))
    out = []
    for k, (i, _) in enumerate(docs):
        gone = set()
        for p in range(len(split[k]) - window + 1):
            if first[tuple(split[k][p:p + window])] < key(i):
                gone |= set(range(p, p + window))
        out.append((i, len(split[k]), len(gone), " ".join(w for p, w in enumerate(split[k]) if p not in gone)))
    return Counter(out)


def repeating(seed, n=120):
    rng = random.Random(seed)
    word = lambda: rng.choice("abcdefg")
    lines = [" ".join(word() + word() for _ in range(rng.randint(5, 40))) for _ in range(12)]
    docs = []
    for d in range(n):
        parts = [" ".join(word() + word() for _ in range(rng.randint(0, 30)))] + rng.sample(lines, rng.randint(0, 3))
        rng.shuffle(parts)
        docs.append((d, rng.choice([" ", "\n", "\t "]).join(parts)))
    return docs + [(3, docs[50][1]), (d + 1, docs[9][1]), (d + 2, docs[9][1])]


@pytest.mark.parametrize("window,period", [(13, 7), (5, 3)])
def test_dedup_against_brute_force(frame, window, period):
    docs = repeating(window) + EDGE
    got = substrings.dedup(frame(docs), window, period, block_bytes=2000).collect()
    assert Counter((r.doc_id, r.n_words, r.n_removed, r.kept) for r in got) == brute_dedup(docs, window)
    assert all(sum(b - a for a, b in r.spans) == r.n_removed for r in got)


def brute_spans(docs, window):
    """Per document the numbers of the words that repeated windows cover."""
    split = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in docs]
    key = lambda i: float("inf") if i is None else i
    first = {}
    for (i, _), w in zip(docs, split):
        for p in range(len(w) - window + 1):
            first[tuple(w[p:p + window])] = min(first.get(tuple(w[p:p + window]), float("inf")), key(i))
    return [{q for p in range(len(w) - window + 1) if first[tuple(w[p:p + window])] < key(i) for q in range(p, p + window)} for (i, _), w in zip(docs, split)]


def brute_cut(text, gone):
    """The text without these words and the white space after each."""
    if text is None or not gone:
        return text
    pieces = re.findall(r"([^\x20\x09-\x0D]+)([\x20\x09-\x0D]*)", text)
    lead = re.match(r"[\x20\x09-\x0D]*", text)[0]
    return lead + "".join(w + s for k, (w, s) in enumerate(pieces) if k not in gone)


def test_dedup_carries_columns(frame):
    docs = frame(repeating(1) + EDGE)
    cut = substrings.dedup(docs, carry=True)
    assert cut.columns == docs.columns and cut.count() == docs.count()
    want = [brute_cut(t, gone) for (_, t), gone in zip(repeating(1) + EDGE, brute_spans(repeating(1) + EDGE, 13))]
    assert Counter(r.text for r in cut.collect()) == Counter(want)
    assert substrings.without(b"line one\nline two  gone\n\nline three", [[4, 5]]) == b"line one\nline two  line three"
    assert substrings.dedup(frame([])).collect() == []


def test_covers_align_any_two_positions():
    for period, cover in substrings.COVERS.items():
        for i in range(period):
            for j in range(period):
                assert any((i + s) % period in cover and (j + s) % period in cover for s in range(period))


def test_cuts_are_minimax():
    rng = random.Random(2)
    for _ in range(60):
        sizes, n = [rng.randint(0, 30) for _ in range(rng.randint(1, 14))], rng.randint(1, 5)
        ends = shards.cuts(sizes, n)
        assert len(ends) == n and ends[-1] == len(sizes) and ends == sorted(ends)
        worst = max(sum(sizes[a:b]) for a, b in zip([0] + ends, ends))

        def least(start, left):
            if left == 1:
                return sum(sizes[start:])
            return min(max(sum(sizes[start:e]), least(e, left - 1)) for e in range(start, len(sizes) + 1))

        assert worst == least(0, n)


def test_shards(frame):
    docs = [(i, "copy " * 50 if i % 3 == 0 else f"text {i} " * (i % 40)) for i in range(3000)] + EDGE
    rows = shards.assign(frame(docs)).collect()
    assert len(rows) == len(docs)
    size = lambda t: len((t or "").encode()) + 8
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in rows) == Counter((i, size(t), zlib.crc32((t or "").encode())) for i, t in docs)
    where, slots = {}, {}
    for r in rows:
        where.setdefault((r.size, r.text_crc32), set()).add(r.shard)
        slots.setdefault(r.shard, []).append(r.slot)
        assert r.law == "bytes" and r.grown_shard is None
    assert all(len(s) == 1 for s in where.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and set(slots) <= set(range(24))
    sums = Counter()
    for r in rows:
        sums[r.shard] += r.size
    large = {s for s, n in sums.items() if n > sum(sums.values()) / 24 * 1.5}
    rest = [n for s, n in sums.items() if s not in large]
    assert max(rest) < 1.1 * min(rest)
    assert shards.assign(frame([])).collect() == []


def brute_base(t):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    at = [(i, label) for label, p in licenses.PHRASES.items() for i in range(len(w)) if w[i:i + len(p.split())] == p.split()]
    places = [i for i, _ in at]
    return len(w), len(at), min(places, default=None), max(places, default=None), ",".join(sorted({x for _, x in at}))


def brute_notices(t, least=0.9):
    """All (start, words of the block, template) pairs, each template in blocks by its own length."""
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    out = set()
    for number, (label, text) in enumerate(licenses.TEMPLATES):
        size, step, top = 32, 16, set(text.split())
        while size - step + 1 < 1.5 * len(text.split()):
            size, step = 2 * size, 2 * step
        for s in range(0, len(w), step):
            n = len(top & set(w[s:s + size]))
            if n >= least * len(top) - 1e-9:
                out.add((s, size, number, n / len(top)))
    return out


BOTH = "subject to the terms of the mozilla public license v 2 0 or under the terms of the gnu lesser general public license"
APACHE = "you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"


def test_licenses_against_brute_force(frame):
    rng = random.Random(4)
    pool = " ".join(t for _, t in licenses.TEMPLATES).split() + ["x"] * 60 + ["Café", "İ", "Key"]
    docs = [(i, " ".join(rng.choice([w, w.upper(), w.title(), w + ","]) for w in rng.choices(pool, k=rng.randint(0, 80)))) for i in range(150)]
    for i in range(100):
        filler = " ".join(rng.choices(["foo", "bar", "mit", "license", "the"], k=rng.randint(0, 40)))
        docs.append((200 + i, f"{filler} {rng.choice(licenses.TEMPLATES)[1].title()}. Under the\nMIT license; CC-BY-NC under the mit license {filler}"))
    docs += [(400 + k, "foo " * k + BOTH) for k in range(0, 32, 5)] + [(500 + k, "foo " * k + APACHE) for k in range(0, 64, 9)] + EDGE
    got = licenses.scan(frame(docs)).collect()
    want = Counter()
    for i, t in docs:
        base, found = brute_base(t), brute_notices(t)
        labels = ",".join(sorted({*filter(None, base[-1].split(",")), *(licenses.TEMPLATES[n][0] for _, _, n, _ in found)}))
        want[i, *base, frozenset(found), labels, 1.0 if base[1] else max([x[3] for x in found], default=0.0)] += 1
    assert Counter((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels,
                    frozenset((m.start, m.words, m.template, m.share) for m in r.notices), r.labels, r.score) for r in got) == want
    assert licenses.scan(frame([])).collect() == []


def test_licenses_finds_all_of_a_block(frame):
    got = licenses.scan(frame([(k, "foo " * k + BOTH) for k in range(32)])).collect()
    for r in got:
        assert r.labels == "lgpl,mpl-2" and r.score == 1
        assert {m.label for m in r.notices} == {licenses.TEMPLATES[m.template][0] for m in r.notices} == {"lgpl", "mpl-2"}


def test_licenses_find_long_notices_at_any_place(frame):
    got = licenses.scan(frame([(k, "foo " * k + APACHE) for k in range(64)])).collect()
    assert len(got) == 64 and {r.labels for r in got} == {"apache-2"}
    long = " ".join(f"word{k}" for k in range(100))
    wordy = long.replace("word50", "some other words here word50")
    got = licenses.scan(frame([(k, "foo " * 5 * k + wordy + " bar" * 30) for k in range(64)]), [("long", long), ("none", "")]).collect()
    assert len(got) == 64 and {(r.labels, r.score) for r in got} == {("long", 1.0)}


def test_license_twin_states_the_query(spark, tmp_path):
    """Two licenses in one block, and a notice longer than half a block, through query and twin."""
    import pyarrow as pa
    import pyarrow.parquet as pq

    texts = ["foo " * k + t for k in range(40) for t in (BOTH, APACHE)] + [t for _, t in EDGE]
    pq.write_table(pa.table({"doc_id": range(len(texts)), "text": texts}), f"{tmp_path}/documents.parquet")
    got = QUERIES["op9_license_scan"](spark, str(tmp_path))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet'")
    rel = con.execute(ORACLE_SQL["op9_license_scan"])
    names = [d[0] for d in rel.description]
    want = rel.fetchall()
    assert sorted(map(str, got.select(names).collect())) == sorted(str(Row(**dict(zip(names, r)))) for r in want)
    assert {r[names.index("labels")] for r in want} >= {"lgpl,mpl-2", "apache-2"}


def test_language(spark):
    rng = random.Random(6)
    kinds = {"aa": ["ba", "bo", "bi", "tata"], "bb": ["xyz", "kry", "zzk", "wq"]}
    rows = [(i, " ".join(rng.choices(kinds[k], k=rng.randint(1, 400))), k if i % 7 else None) for i in range(400) for k in [rng.choice(sorted(kinds))]]
    extra = [(900, None, "aa"), (901, "", "aa"), (902, "12 ## 3", "bb"), (None, "ba bo", None), (903, "ba " * 40000, "aa"), (903, "ba " * 40000, "aa")]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows + extra], "doc_id long, text string, lang string, score string, held_out int")
    got = langid.identify(df).select("doc_id", "text", "held_out", "lang_pred", "score").collect()
    assert len(got) == len(rows) + len(extra)
    truth = {i: next(k for k, w in kinds.items() if t.split()[0] in w) for i, t, _ in rows}
    held = [r for r in got if r.held_out and r.doc_id in truth]
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) / len(held) >= 0.95
    for r in got:
        assert 0 <= r.score <= 1 and r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert (r.lang_pred == "und") == (r.text is None or not re.search(r"[^\W\d_]", r.text))
    assert langid.identify(df.where("false")).collect() == []
    alone = langid.identify(df.where("doc_id = 900")).collect()
    assert [r.lang_pred for r in alone] == ["und"]
    unknown = df.withColumn("lang", F.lit(None).cast("string")).where("doc_id in (1, 900, 901, 902, 903)")
    assert {r.doc_id for r in langid.known_language(unknown).collect()} == {1, 903}


def test_language_sample_is_not_crowded_out(spark, monkeypatch):
    rng = random.Random(7)
    kinds = {"aa": ["ba", "bo", "bi", "tata"], "bb": ["xyz", "kry", "zzk", "wq"]}
    some = lambda k: " ".join(rng.choices(kinds[k], k=rng.randint(40, 90)))
    seen, fit = [], langid.fit
    monkeypatch.setattr(langid, "fit", lambda x, y, names: seen.append((x, y, names)) or fit(x, y, names))

    def learned(rows):
        got = langid.identify(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()
        assert len(got) == len(rows) and all(r.lang_pred == r.lang for r in got if r.text)
        x, y, names = seen.pop()
        assert names == ["aa", "bb"]
        return [(int((y == k).sum()), len({w.tobytes() for w in x[y == k]})) for k in range(2)]

    with_ids = [(i, some(k), k) for i in range(400) for k in ["ab"[i % 2] * 2]]
    nameless = [(None, some(k), k) for k in kinds for _ in range(700)]
    least = 3 * 100
    assert all(n <= 3 * langid.PER_LANGUAGE and distinct > least for n, distinct in learned(with_ids + nameless))
    assert all(n <= 3 * langid.PER_LANGUAGE and distinct > least for n, distinct in learned(nameless))
    hot = spark.range(4000).where(~langid.held_out("id")).orderBy(F.shiftrightunsigned(F.xxhash64("id"), 1)).first().id
    for i, t in ((hot, some("aa")), (None, some("aa")), (None, "")):
        assert all(n <= 3 * langid.PER_LANGUAGE and distinct > least for n, distinct in learned(with_ids + [(i, t, "aa")] * 5000))


def test_languages_are_bounded(spark):
    """A dirty column has many values; those with most rows are learned."""
    rows = [(i, ["ba bo tata bi ", "xyz kry zzk wq "][i % 2] * 9, ["aa", "bb"][i % 2]) for i in range(120)]
    rows += [(1000 + i, "some other text", f"junk{i}") for i in range(500)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    net = langid.train(df, ~langid.held_out(), languages=2)
    assert net.languages == ["aa", "bb"]


def test_language_windows_cover_all_bytes():
    net = langid.ByteNet(["a", "b"], {w: np.random.default_rng(w).normal(size=(w, 256, langid.FILTERS)).astype(np.float32) for w in langid.WIDTHS},
                         np.zeros(24, np.float32), np.random.default_rng(1).normal(size=(24, 2)).astype(np.float32), np.zeros(2, np.float32))
    texts = [bytes(np.random.default_rng(n).integers(33, 127, n).astype(np.uint8)) for n in (1, 3, 127, 128, 129, 253, 1000)]
    starts, counts, joined = langid.cut(texts)
    assert len(starts) == counts.sum()
    for t, a, n in zip(texts, np.cumsum(counts) - counts, counts):
        assert starts[a + n - 1] - starts[a] + langid.LENGTH >= len(t)
    which, mean = langid.predict(net, net.tables(), texts)
    for t, k, m in zip(texts, which, mean):
        low, probs = t.lower(), []
        for s in range(0, max(1, len(t) - 3), langid.LENGTH - 3):
            w = np.frombuffer(low[s:s + langid.LENGTH].ljust(langid.LENGTH), np.uint8)
            top = [max(sum(f[i, w[p + i], j] for i in range(z)) for p in range(langid.LENGTH - z + 1)) for z, f in net.filters.items() for j in range(langid.FILTERS)]
            h = np.maximum(np.array(top), 0) @ net.dense
            probs.append(np.exp(h - h.max()) / np.exp(h - h.max()).sum())
        assert abs(np.mean(probs, axis=0)[k] - m) < 1e-4


def test_quality(spark):
    rng = random.Random(8)
    good = lambda: " ".join(rng.choices(["river", "lake", "dam", "water.", "The"], k=rng.randint(3, 300)))
    bad = lambda: " ".join(rng.choices(["$$$", "X!!", "|", "###a"], k=rng.randint(3, 300)))
    rows = [(i, good() if i % 3 else bad(), int(i % 3 > 0)) for i in range(600)]
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t, _ in rows] + [(900, None, "x", 1), (901, "", "x", 1), (None, "a b", "x", 1), (5, "other", "x", 1)],
                                 "doc_id long, text string, score string, predicted int")
    labels = spark.createDataFrame([(i, q, 0) for i, _, q in rows] + [(7, 0, 0), (7, 1, 0), (8, None, 1), (None, 1, 1)], "doc_id long, quality int, toxic int")
    got = quality.scored(docs, labels).collect()
    assert len(got) == len(rows) + 4
    truth = {i: q for i, _, q in rows}
    held = [r for r in got if r.held_out and r.doc_id in truth and r.text != "other"]
    assert sum(r.predicted == truth[r.doc_id] for r in held) / len(held) >= 0.95
    for r in got:
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
    assert {r.score for r in quality.scored(docs, labels.where("false")).collect()} == {0.5}
    assert quality.scored(docs.where("false"), labels).collect() == []
