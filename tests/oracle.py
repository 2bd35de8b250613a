"""Runs registered queries beside their SQL twins in DuckDB and compares the rows."""

from __future__ import annotations

import math
import sys
import time

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def connect(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def norm(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    return v


def frames(spark, con, name: str, sf_dir: str):
    from hydrolake.plans import ORACLE_SQL, QUERIES

    left = QUERIES[name](spark, sf_dir)
    cols = sorted(left.columns)
    t = time.time()
    got = [tuple(norm(r[c]) for c in cols) for r in left.collect()]
    took = time.time() - t
    if name not in ORACLE_SQL:
        return cols, got, None, None, took
    rel = con.execute(ORACLE_SQL[name])
    names = [d[0] for d in rel.description]
    order = [names.index(c) for c in cols] if sorted(names) == cols else None
    rows = rel.fetchall()
    want = [tuple(norm(r[i]) for i in order) for r in rows] if order is not None else rows
    return cols, got, sorted(names), want, took


def compare(spark, con, name: str, sf_dir: str) -> tuple[bool, str]:
    cols, got, want_cols, want, took = frames(spark, con, name, sf_dir)
    if want is None:
        return True, f"rows only: {len(got)} ({took:.2f}s)"
    if cols != want_cols:
        return False, f"columns differ: {cols} / {want_cols}"
    key = lambda row: tuple((x is not None, type(x).__name__, str(x)) for x in row)
    got, want = sorted(got, key=key), sorted(want, key=key)
    if len(got) != len(want):
        extra = [r for r in got if r not in set(want)][:2] if len(got) < 200000 else []
        lack = [r for r in want if r not in set(got)][:2] if len(want) < 200000 else []
        return False, f"row counts differ: {len(got)} / {len(want)}; only spark {extra}; only sql {lack}"
    for g, w in zip(got, want):
        if g != w or [type(x) for x in g] != [type(x) for x in w]:
            return False, f"rows differ: {cols}\n   spark {g}\n   sql   {w}"
    return True, f"{len(got)} rows ({took:.2f}s)"


if __name__ == "__main__":
    sys.path.insert(0, "/root/repo")
    from hydrolake import get_session
    from hydrolake.plans import QUERIES, load_all

    sf, wanted = sys.argv[1], sys.argv[2:]
    load_all()
    spark = get_session(master="local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false",
                        spark__driver__memory="8g", spark__ui__showConsoleProgress="false")
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf)
    bad = 0
    for name, fn in QUERIES.items():
        if wanted and name not in wanted and fn.__module__.split(".")[-1] not in wanted:
            continue
        t = time.time()
        try:
            ok, note = compare(spark, con, name, sf)
        except Exception as e:  # noqa: BLE001
            ok, note = False, f"{type(e).__name__}: {str(e)[:900]}"
        bad += not ok
        print(f"{'ok  ' if ok else 'FAIL'} {name}: {note} [{time.time() - t:.1f}s]", flush=True)
    print("failures:", bad)
