"""Token ids, token files, packing: exact round trips and edge cases."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from hydrolake.llm import packing, tokenfiles
from hydrolake.llm.encode import encoder
from tests.llm.conftest import EDGE

BYTES, WORDS = (public_tokenizers.path(f"{n}.json") for n in ("byte_bpe_50k", "word_bpe_49k"))
ODD = ["", " ", "  ", "a  b", "a   b", "a \n b", "a\n\n b ", "\n a", " lead", "trail ", "don't we'll", "Ünïcode ß, Straße.", "x.\nY,z", "日本 語", "é àb",
       "<|endoftext|> x", "a<|endoftext|>", "tab\tx \ty", " x   y", "a\r\n b", "ΟΔΥΣΣΕΥΣ ΣΑΣ ", "1234 5.67", "a ,b . c", "\x00\x1c x", "'s 's", "ÿÀ. Éa,"]


@pytest.mark.parametrize("path", [BYTES, WORDS])
def test_ids_equal_the_library(path):
    rng = random.Random(1)
    pieces = ODD + list(" \n\t.,'") + ["word", "Word", "été", "the"]
    texts = ODD + ["".join(rng.choices(pieces, k=rng.randint(1, 12))) for _ in range(3000)]
    tok, own = Tokenizer.from_file(path), encoder(path)
    for t in texts:
        assert np.frombuffer(own.ids(t), "<u4").tolist() == tok.encode(t, add_special_tokens=False).ids, repr(t)


@pytest.mark.parametrize("path", [BYTES, WORDS])
def test_ids_of_documents(spark, path):
    tok, own = Tokenizer.from_file(path), encoder(path)
    for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect():
        assert np.frombuffer(own.ids(r[0]), "<u4").tolist() == tok.encode(r[0], add_special_tokens=False).ids


def test_token_files_round_trip(frame, tmp_path):
    docs = EDGE + [(i, f"text number {i} " * (i % 30)) for i in range(20, 400)]
    files = tokenfiles.write(frame(docs), WORDS, str(tmp_path), file_tokens=500, part_bytes=3000)
    assert files.count() > 5
    tok = Tokenizer.from_file(WORDS)
    order = sorted(docs, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, (r[1] or "").encode()))
    want, start = [], 0
    for i, t in order:
        ids = np.array(tok.encode(t or "", add_special_tokens=False).ids + [2], "<u4")
        want.append((i, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    got = sorted((tuple(r) for r in tokenfiles.read(files).collect()), key=lambda r: r[1])
    assert got == want
    one = next(f for f in files.collect() if f.known and f.n_docs > 1)
    read = tokenfiles.TokenFile(tokenfiles._get(one.path))
    assert read.get(one.first) is not None and read.get(10**15) is None and read.get(one.first, 99) is None


def test_lookup_reads_only_its_places(frame, tmp_path, monkeypatch):
    docs = EDGE + [(i * 3, f"text number {i} " * (i % 30)) for i in range(20, 400)]
    files = tokenfiles.write(frame(docs), WORDS, str(tmp_path), file_tokens=500, part_bytes=3000)
    tok = Tokenizer.from_file(WORDS)
    monkeypatch.setattr(tokenfiles, "_get", None)  # no file is read whole
    wanted = [60, 61, 1197, 5, None, 1, 10**9, -5, 8]
    got = tokenfiles.lookup(files, wanted)
    for i, ids in zip(wanted, got):
        texts = [t for d, t in docs if d == i]
        want = [tok.encode(t or "", add_special_tokens=False).ids + [2] for t in texts]
        assert ids is None if not texts else ids.tolist() in want
    assert tokenfiles.lookup(files, [5], 1)[0] is not None and tokenfiles.lookup(files, [5], 2) == [None] and tokenfiles.lookup(files, []) == []
    one = next(f for f in files.collect() if f.n_docs > 3)
    held, read = tokenfiles.KeyedReader(one.path), []
    at = held.file
    held.file = type("Counted", (), {"read_at": lambda self, n, o: (read.append(n), at.read_at(n, o))[1]})()
    ids = held.get(one.first)
    assert len(ids) and sum(read) < 64 + 4 * len(ids)


def test_token_files_of_nothing(frame, tmp_path):
    files = tokenfiles.write(frame([]), WORDS, str(tmp_path))
    assert files.collect() == [] and tokenfiles.read(files).collect() == []


@pytest.mark.parametrize("n", [0, 1, 2, 5, 1000])
def test_perfect_hash(n):
    h = tokenfiles.key_hash(np.arange(n) * 17 - 40, np.ones(n, bool), np.zeros(n))
    index = tokenfiles.PerfectHash.build(h)
    assert sorted(index(h).tolist() if n else []) == list(range(n))


def check_pieces(rows, size):
    """Each document whole, each sequence gapless."""
    by_seq = {}
    for r in rows:
        by_seq.setdefault(r.sequence_id, []).append(r)
    for s in by_seq.values():
        at = 0
        for r in sorted(s, key=lambda r: r.offset):
            assert r.offset == at and r.length > 0
            at += r.length
        assert at <= size
    return len(by_seq)


def test_packing(frame):
    docs = EDGE + [(i, "some words here " * (i % 50)) for i in range(20, 320)]
    rows = packing.pack(frame(docs), BYTES, size=256, group_bytes=20000).collect()
    n = check_pieces(rows, 256)
    tok, want, got = Tokenizer.from_file(BYTES), {}, {}
    for i, t in docs:
        ids = np.array(tok.encode(t or "", add_special_tokens=False).ids + [1], "<u4")
        want.setdefault(i, []).append(ids.tobytes())
    for r in rows:
        assert zlib.crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.length
        got.setdefault(r.doc_id, []).append(r)
    for i, texts in want.items():
        assert sum(r.length for r in got[i]) * 4 == sum(map(len, texts))
        if len(texts) == 1:
            assert b"".join(bytes(r.ids) for r in sorted(got[i], key=lambda r: r.start)) == texts[0]
            assert {r.doc_tokens for r in got[i]} == {len(texts[0]) // 4}
    groups = len({r.sequence_id >> 32 for r in rows})
    assert n * 256 - sum(r.length for r in rows) < 256 * groups and groups > 3
    assert packing.pack(frame([]), BYTES).collect() == []


def test_costs_are_balanced():
    rng = random.Random(3)
    pieces, cost = packing.assign([rng.randint(1, 900) for _ in range(400)], 2048)
    assert max(cost) < 1.6 * sorted(cost)[len(cost) // 10]
    assert packing.assign([], 2048) == ([], [])
