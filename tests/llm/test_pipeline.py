"""The stages against plain Python on a small table; the queries against SQL where it exists."""

import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from hydrolake.llm import decontaminate, langid
from hydrolake.llm.queries import ORACLE_SQL, QUERIES
from tests.llm.conftest import EDGE
from tests.llm.test_search import brute_leaks, brute_near, plain_fingerprint
from tests.llm.test_texts import brute_cut, brute_spans
from tests.oracle import connect

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_its_twin(spark, name):
    got = QUERIES[name](spark, SF)
    rel = connect(SF).execute(ORACLE_SQL[name])
    names = [d[0] for d in rel.description]
    assert sorted(names) == sorted(got.columns)
    assert sorted(map(tuple, got.select(names).collect()), key=str) == sorted(rel.fetchall(), key=str)


def test_every_operator_has_one_query():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


def test_stages(spark, tmp_path):
    import corpus_pipeline as c

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, kept = docs.columns, docs
    for name, stage in c.STAGES:
        before = kept.collect()
        stage(spark, kept, SF).write.parquet(f"{tmp_path}/{name}")
        kept = spark.read.parquet(f"{tmp_path}/{name}")
        after = kept.collect()
        if name == "language":
            assert {r.doc_id for r in before} - {r.doc_id for r in after} <= {r.doc_id for r in before if len(r.text) < 50}
        elif name == "near_copies":
            rows = sorted(before, key=lambda r: r.doc_id)
            import numpy as np

            root = brute_near(np.array([plain_fingerprint(r.text) for r in rows], np.uint64), 3)
            assert {r.doc_id for r in after} == {rows[k].doc_id for k in set(root)}
        elif name == "repeated_passages":
            old = [(r.doc_id, r.text) for r in before]
            want = {i: brute_cut(t, gone) for (i, t), gone in zip(old, brute_spans(old, 13))}
            assert len(after) == len(before)
            assert all(r.text == want[r.doc_id] and r.n_chars == len(r.text) for r in after)
        elif name == "leaks":
            items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
            found = brute_leaks([(r.doc_id, r.text) for r in before], items, 0.6, 0.8)
            assert {r.doc_id for r in after} == {r.doc_id for r in before} - {d for d, _ in found} and found
        if name != "packed":
            assert kept.columns == columns
        else:
            assert {r.doc_id for r in after} == {r.doc_id for r in before}


def test_stages_on_edges(spark, frame):
    import corpus_pipeline as c

    docs = frame(EDGE).withColumns({n: F.lit(n) for n in ("told", "__l", "__kept", "__row", "row", "held_out", "lang_pred", "kept", "spans", "root", "two words")})
    ids = lambda df: Counter(r.doc_id for r in df.select("doc_id").collect())
    want = {"language": Counter([1, 5, 5, 6, 6, None, 7, 8]), "near_copies": Counter([1, 2, 6, 6, 7, 8, 9, None, None]),
            "repeated_passages": Counter(i for i, _ in EDGE), "leaks": Counter(i for i, _ in EDGE), "packed": None}
    for name, stage in c.STAGES:
        got = stage(spark, docs, SF)
        if name == "packed":
            assert set(ids(got)) == {i for i, _ in EDGE}
        else:
            assert got.columns == docs.columns and ids(got) == want[name], (name, ids(got))
            assert all(r.told == "told" and r.row == "row" and r.lang_pred == "lang_pred" for r in got.collect())
        assert stage(spark, docs.where("false"), SF).collect() == []
    assert langid.known_language(docs.where("doc_id in (2, 3, 4)")).count() == 0
    assert re.fullmatch(r"\w+", c.STAGES[0][0]) and decontaminate.words(None) == []
