"""Golden cases for the semantics that are easy to get wrong, and properties of merges and slices."""

import datetime as dt
import random
import re

import pytest
from pyspark.sql import Window, functions as F

from hydrolake import functions as P
from hydrolake import sources, sql
from hydrolake.functions import fixed
from hydrolake.operators import (extract_cells, extract_glyphs, extract_json, extract_text, extract_words,
                                 filters, joins, merge, ordered, quality, reshape, select)
from hydrolake.session import local_table, scratch_path

D = dt.date


def one(spark, value, fn):
    return spark.createDataFrame([(value,)], "x string").select(fn("x").alias("y")).first()["y"]


@pytest.mark.parametrize("fn,text,want", [
    (P.num_leading, "1,234", 1.0), (P.num_leading, "3.5m", 3.5), (P.num_leading, "m 3", None),
    (P.num_decimal_comma, "1,234.5", 1.234), (P.num_decimal_comma, "1 234,5", 1234.5),
    (P.num_thousands, "1,234.5", 1234.5), (P.num_thousands, "12d", None), (P.num_thousands, "NaN", None),
    (P.num_first, "RL +1,234.5 m", 1234.5), (P.num_first, "—", None),
    (P.num_space_thousands, "1 234,5", 1234.5), (P.num_space_thousands, "1\n2", None),
    (P.num_strip, "ca -12.5 %", -12.5), (P.num_strip, "-", None), (P.num_hash, "# 7", 7.0),
    (P.clean_cell, " None ", None), (P.clean_text, "a   b\n", "a b"),
    (P.html_unescape, "&amp;lt; &#233;&#xE9;&eacute;&bogus;&amp", "&lt; ééé&bogus;&amp"),
    (P.strip_accents, "Équipée ñ Č", "Equipee n C"), (P.match_key, "Thée Dam No. 1", "theeno1"),
    (P.canon_text, "Lake  Kariba - x.1", "LAKE KARIBA-X"), (P.slug_lower, "--", "unknown"),
])
def test_cells(spark, fn, text, want):
    assert one(spark, text, fn) == want


@pytest.mark.parametrize("text,want", [
    ("3/8/26", D(2026, 8, 3)), ("3/8/99", D(1999, 8, 3)), ("12 August, 2026", D(2026, 8, 12)),
    ("Aug 2, 2026", D(2026, 8, 2)), ("31-02-2026", None), ("soon", None)])
def test_date_any(spark, text, want):
    assert one(spark, text, P.parse_date_any) == want


def test_dates(spark):
    assert one(spark, "7-8-25", P.parse_dmy) == D(2025, 8, 7)
    assert one(spark, "7-13-25", P.parse_dmy) is None
    assert one(spark, "as at 99 Foo 2020. Dam Levels of 3 May 2024", P.printed_date) == D(2024, 5, 3)
    assert one(spark, "x20260629 20260630", P.cell_date) == "2026-06-30"
    anchor = F.lit("2026-04-20").cast("date")
    assert one(spark, "Apr-23", lambda c: P.resolve_year(c, anchor, 0)) == D(2025, 4, 23)
    assert one(spark, "Apr-23", lambda c: P.resolve_year(c, anchor, 7)) == D(2026, 4, 23)
    assert one(spark, "1 de Março de 2025", lambda c: P.parse_text_date(c, fixed.MONTHS_PT, joiner=r"\s+de\s+")) == D(2025, 3, 1)


def test_header_and_format(spark):
    assert tuple(one(spark, "STORAGE (current storage, mcm / 10^6 m^3)", P.parse_header)) == (
        "STORAGE", "current storage", "mcm / 10^6 m^3")
    row = spark.range(1).select(*[P.fmt_number(F.lit(v), d).alias(f"c{i}") for i, (v, d) in enumerate(
        [(1200.0, 3), (2.5, 0), (-0.0004, 3), (14.3800, 3), (None, 2)])]).first()
    assert tuple(row) == ("1200", "2", "0", "14.38", "")


def test_sql_functions(spark):
    sql.register(spark)
    row = spark.sql("""SELECT hl_num_thousands(' 1,234.5 ') a, hl_num_first('RL +7.5 m') b, hl_num_leading('1,234') c,
        hl_num_decimal_comma('1 234,5') d, hl_strip_accents('é') e, hl_cell_date('20260629') f, hl_clean_cell(' -- ') g,
        hl_pct_full(5, 10) h, hl_slug_lower('A b') i, hl_clean_text(' a  b ') j""").first()
    assert tuple(row) == (1234.5, 7.5, 1.0, 1234.5, "e", "2026-06-29", None, 50.0, "a_b", "a b")


@pytest.mark.parametrize("day,slots", [("2026-03-29", 92), ("2026-10-25", 100), ("2026-06-01", 96)])
def test_complete_day_on_dst(spark, day, slots):
    start = F.unix_seconds(F.to_utc_timestamp(F.lit(day).cast("timestamp"), "Europe/Luxembourg"))
    points = spark.range(slots).select(F.lit("r").alias("r"), F.timestamp_seconds(start + F.col("id") * 900).alias("ts"),
                                       F.col("id").cast("double").alias("v"), "id")
    run = lambda df: select.complete_day_mean(df, ["r"], "ts", "v", "id", "Europe/Luxembourg").collect()
    rows = run(points.union(points.where("id = 3")))
    assert [(str(r.date), r.n, r.mean_value) for r in rows] == [(day, slots, (slots - 1) / 2)]
    assert run(points.where("id <> 5")) == []
    # the right count off the grid is not complete either
    off = points.withColumn("ts", F.expr("CASE WHEN id = 5 THEN ts + interval 7 minutes ELSE ts END"))
    assert run(off) == []


def _hot_series(spark, n=6000, seed=3):
    """A third of the rows belongs to one key, with equal instants and gaps; some keys are null."""
    rnd = random.Random(seed)
    rows = [(0 if i % 3 == 0 else None if i % 50 == 1 else rnd.randrange(1, 40), dt.datetime(2026, 1, 1) + dt.timedelta(minutes=rnd.randrange(0, 40000)),
             i, rnd.randrange(-5, 40)) for i in range(n)]
    return spark.createDataFrame(rows, "k int, ts timestamp, id int, n int")


def test_slices_equal_plain_windows_with_a_hot_key(spark):
    df = _hot_series(spark)
    w = Window.partitionBy("k").orderBy("ts", "id")
    want = {r.id: (r.a, r.b) for r in df.select("id", F.lag("ts").over(w).alias("a"), F.sum("n").over(w).alias("b")).collect()}
    lagged = ordered.lag_over_slices(df, ["k"], ["ts", "id"], "ts", "a", F.to_date("ts"))
    got = ordered.running_sum_over_slices(lagged, ["k"], ["ts", "id"], F.col("n"), "b", F.to_date("ts")).collect()
    assert len(got) == len(want) and {r.id: (r.a, r.b) for r in got} == want


def test_dynamic_threshold_brute_force(spark):
    import statistics
    df = _hot_series(spark, 900)
    got = {r.id: r.threshold for r in ordered.dynamic_threshold(df, ["k"], ["ts", "id"], "n", F.to_date("ts")).collect()}
    seen = {}
    for r in sorted(df.collect(), key=lambda r: (r.k is None, r.k or 0, r.ts, r.id)):
        recent = [x for x in seen.get(r.k, []) if x > 0][-6:]
        want = min(24, max(14, round(statistics.median(recent) * 0.75))) if recent else 18
        assert got[r.id] == want
        seen.setdefault(r.k, []).append(r.n)


def test_upsert_is_idempotent_and_order_free(spark):
    a = spark.createDataFrame([(1, "x", "t1"), (2, "y", "t1"), (3, None, "t1")], "k int, v string, fetched_at string")
    b = spark.createDataFrame([(2, "y", "t2"), (3, "z", "t2"), (4, "w", "t2")], "k int, v string, fetched_at string")
    first = merge.upsert(a, b, ["k"], ["fetched_at"])
    assert tuple(first.stats.first()) == (1, 1, 1, 1)
    rows = first.rows.drop("merge_action")
    assert {(r.k, r.v, r.fetched_at) for r in rows.collect()} == {(1, "x", "t1"), (2, "y", "t1"), (3, "z", "t2"), (4, "w", "t2")}
    again = merge.upsert(rows, b, ["k"], ["fetched_at"])
    assert again.stats.first()["added"] == again.stats.first()["updated"] == 0
    assert set(again.rows.drop("merge_action").collect()) == set(rows.collect())


def test_ranked_upsert_is_one_way(spark):
    cols = "k int, kind string, v int"
    old = spark.createDataFrame([(1, "current", 1), (2, "previous_week", 1), (3, "current", 1)], cols)
    new = spark.createDataFrame([(1, "previous_week", 2), (2, "current", 2), (3, "current", 2)], cols)
    out = merge.upsert_ranked(old, new, ["k"], "kind", {"previous_week": 1, "current": 2}).rows
    assert {(r.k, r.v) for r in out.collect()} == {(1, 1), (2, 2), (3, 2)}


def test_merge_into_path_touches_only_its_partitions(spark):
    path = scratch_path(spark, "archive")
    make = lambda rows: spark.createDataFrame(rows, "k int, v int, day string")
    merge.merge_into_path(spark, path, make([(1, 1, "d1"), (2, 1, "d2")]), ["k", "day"], "day")
    held = lambda df: {f for f in df.inputFiles() if "day=d1" in f}
    untouched = held(spark.read.parquet(path))
    merge.merge_into_path(spark, path, make([(2, 5, "d2"), (3, 5, "d2")]), ["k", "day"], "day")
    back = spark.read.schema("k int, v int, day string").parquet(path)
    assert {tuple(r) for r in back.collect()} == {(1, 1, "d1"), (2, 5, "d2"), (3, 5, "d2")}
    assert held(back) == untouched


def test_latest_per_ties_and_modal(spark):
    df = spark.createDataFrame([("a", 1, 0, "x"), ("a", 2, 1, "y"), ("a", 2, 2, "z")], "k string, t int, pos int, v string")
    assert select.latest_per(df, ["k"], ["t"], "pos", "first").first()["v"] == "y"
    assert select.latest_per(df, ["k"], ["t"], "pos", "last").first()["v"] == "z"
    days = spark.createDataFrame([("2026-01-01",), ("2026-01-02",), ("2026-01-01",), ("2026-01-02",)], "d string")
    assert select.modal(days, "d").first()["d"] == "2026-01-02"


def test_null_flag_is_refused(spark):
    df = spark.createDataFrame([(1, False), (2, True), (3, None)], "k int, f boolean")
    assert [r.k for r in filters.keep_explicit_false(df, "f").collect()] == [1]


def test_feeds_keep_zero_and_realtime_only_today(spark):
    live = spark.createDataFrame([("a", 0.0, "2026-01-02"), ("b", 9.0, "2026-01-01")], "id string, v double, day string")
    daily = spark.createDataFrame([("a", 5.0), ("c", 7.0)], "id string, v double")
    out = joins.coalesce_feeds({"live": live, "daily": daily}, ["id"], {"v": [("live", "v"), ("daily", "v")]},
                               {"live": F.col("day") == "2026-01-02"})
    assert {(r.id, r.v) for r in out.collect()} == {("a", 0.0), ("c", 7.0)}


def test_registry_audit_and_freshness_budget(spark):
    reg = spark.createDataFrame([("s1", "active", None, None), ("s2", "active", 24.0, 12.0), ("s3", "blocked", 1.0, 1.0)],
                                "source_id string, deployment_status string, publication_cadence_hours double, max_schedule_gap_hours double")
    runs = spark.createDataFrame([("s1", dt.datetime(2026, 8, 9), "b", "ok"), ("s1", dt.datetime(2026, 8, 8), "a", "error")],
                                 "source_id string, run_ts timestamp, run_file string, status string")
    obs = spark.createDataFrame([("s1", "2026-08-06"), ("s2", "2026-08-06")], "source_id string, latest_observation string")
    # 96 h is exactly the budget of s1 (24 * 3 + 24), not over it; s2 has 84
    out = {r.source_id: r for r in quality.freshness(reg, runs, obs, F.lit("2026-08-10 00:00:00").cast("timestamp")).collect()}
    assert (out["s1"].state, out["s2"].state, out["s3"].state) == ("fresh", "stale", "not_active")
    assert out["s1"].recent_run_statuses == ["error", "ok"]


def test_run_log_shapes(spark):
    path = scratch_path(spark, "logs")
    logs = ['{"run_time": "2026-04-24 13:28:35", "status": "success", "row_count": 121, "errors": []}',
            '{"started_at": "2026-08-16T075633Z", "source": "b/d", "status": "ok", "inventory_total": 7}',
            '{"run_time": "2026-04-21 21:16:09", "source": {"dam_url": "u"}, "counts": {"dams": 8}}', "{broken"]
    spark.createDataFrame([(x,) for x in logs], "value string").repartition(4).write.text(f"{path}/x/y/run_logs")
    rows = {r.status: r for r in sources.read_run_logs(spark, f"{path}/x/y/run_logs").collect()}
    assert rows["success"].rows == 121 and rows["success"].source == "x/y"
    assert rows["ok"].run_ts == dt.datetime(2026, 8, 16, 7, 56, 33) and rows["ok"].source == "b/d"
    assert rows["?"].source == "x/y" and rows["unreadable"].run_ts is None


def test_snapshots_with_bom_and_quoted_headers(spark, tmp_path):
    name = tmp_path / "x_timeseries_2025-10-08.csv"
    name.write_text('﻿reservoir_id,"level (water level, m)"\nR1,14.679\n', encoding="utf-8")
    (tmp_path / "x_timeseries_2026-04.csv").write_text('﻿reservoir_id,"level (water level, m)"\nR2,1\n', encoding="utf-8")
    rows = {tuple(r) for r in sources.read_snapshots(spark, str(tmp_path)).collect()}
    assert rows == {("R1", "14.679", D(2025, 10, 8)), ("R2", "1", D(2026, 4, 1))}


def test_zip_series_refuses_other_labels(spark):
    df = spark.createDataFrame([(1, ["a", "b"], ["a", "c"], [1.0])], "k int, l array<string>, m array<string>, s array<double>")
    with pytest.raises(Exception, match="label vectors"):
        extract_json.zip_series(df, ["k"], "l", {"s": "s"}, "m").collect()
    assert [r.s for r in extract_json.zip_series(df, ["k"], "l", {"s": "s"}).orderBy("pos").collect()] == [1.0, None]


def test_nested_payloads_get_more_tasks_not_larger_ones(spark, monkeypatch):
    from hydrolake.plans import QUERIES, json_queries, load_all

    load_all()
    monkeypatch.setattr(json_queries, "LINES_A_TASK", 500, raising=False)
    out = QUERIES["flatten_nested"](spark, "/root/testdata/sf0.001")
    assert out._jdf.queryExecution().executedPlan().toString().count("Exchange ") == 1
    lines = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet").count()
    assert out.agg(F.sum("n")).first()[0] == lines
    assert out.rdd.getNumPartitions() == -(-lines // 500) > 8


def test_percent_columns_are_ranked(spark):
    head = ["Station", "Reservoir", "% Full 2026-06-22", "%Full Today", "% full 2026-06-29", "% Full Last Year"]
    table = [head, ["A2R001", "X", "1", "2", "3", "4"]]
    cells = spark.createDataFrame([(1, 0, r, c, t) for r, row in enumerate(table) for c, t in enumerate(row)],
                                  "doc int, table_no int, row_no int, col_no int, text string")
    as_of = F.lit("2026-06-29").cast("date")
    assert extract_cells.map_header(cells, ["doc"], as_of).first()["pct_full"] == "2"
    no_today = cells.where("col_no <> 3")
    assert extract_cells.map_header(no_today, ["doc"], as_of).first()["pct_full"] == "3"


def test_headers_are_read_on_a_documents_own_row(spark):
    def rows(title, stations):
        return [[title], ["Station", "River", "Reservoir", "% Full"], *stations, ["A9Z999", "Grand Total", "x", "9"]]

    first = rows("Bulletin", [["A2R001 x", "r", "Dam\n1", "50"], ["A2R001", "r", "later", "51"], ["note"], ["A2R002", None, "n", None]])
    second = [["A2R009", "above", "its", "header"], ["Reservoir", "Station"], ["m", "A2R003"], ["again", "A2R002"]]
    flat = [(d, t, r, c, x) for d in (1, 2, None) for t, table in ((0, first), (None, second), (3, [["no", "header"], ["A2R004", "x"]]))
            for r, row in enumerate(table) for c, x in enumerate(row)] + [(9, 0, None, 0, "Station reservoir"), (9, 0, None, 1, "A2R001")]
    schema, as_of = "doc int, table_no int, row_no int, col_no int, text string", F.lit("2026-06-29").cast("date")
    cells = spark.createDataFrame(flat, schema).repartition(3)
    together = cells.groupBy("doc").agg(F.collect_list(F.struct("table_no", "row_no", "col_no", "text")).alias("all"))
    want = {(d, *x) for d in (1, 2, None) for x in (
        ("A2R001", 0, 2, "Dam1", "r", "50"), ("A2R002", None, 3, "again", None, None), ("A2R003", None, 2, "m", None, None))}
    unnested, nested = extract_cells.map_header(cells, ["doc"], as_of), extract_cells.map_header(together, ["doc"], as_of, nested="all")
    for out in (unnested, nested):
        got = [(r.doc, r.station_id, r.table_no, r.row_no, r.reservoir, r.river, r.pct_full) for r in out.collect()]
        assert len(got) == 9 and set(got) == want
    # the cells of a document are gathered once, not sorted again by row, table and station
    held = spark.createDataFrame([], "doc int, all array<struct<table_no: int, row_no: int, col_no: int, text: string>>")
    plans = [extract_cells.map_header(x, ["doc"], as_of, nested=n)._jdf.queryExecution().executedPlan().toString() for x, n in ((spark.createDataFrame([], schema), None), (held, "all"))]
    assert [p.count("Exchange") for p in plans] == [1, 0] and not any("Window" in p or "Sort " in p or "SortAggregate" in p for p in plans)


def test_block_names_attach_to_the_open_block(spark):
    lines = [(1, None, "CHICAMBA"), (2, 5, None), (3, 6, None), (4, None, "MUDA"), (5, 5, None), (6, 6, "MAVUZI"), (7, 5, None)]
    df = spark.createDataFrame([("d", *x) for x in lines], "doc string, line int, date int, name string")
    out = extract_cells.segment_blocks(df, ["doc"], ["line"], "date", "name", F.floor(F.col("line") / 3))
    # the name on line 4 goes to the block still open; the block of line 7 stays nameless
    assert [(r.line, r.block_name) for r in out.orderBy("line").collect()] == [
        (2, "MUDA"), (3, "MUDA"), (5, "MAVUZI"), (6, "MAVUZI")]


def test_arity_and_known_dam(spark):
    rows = spark.createDataFrame([("a", "MUDA", [50.0, 1.0, 20.0]), ("b", "MAVUZI", [50.0, 1.0, 20.0]), ("c", "MUDA", [4.0, 99.0])],
                                 "k string, dam string, nums array<double>")
    got = {(r.k, r.variable): r.value for r in extract_text.unpack_by_arity(rows, "nums", ["k"], "dam").collect()}
    assert got == {("a", "water_level_m"): 50.0, ("a", "inflow_m3s"): 1.0, ("b", "water_level_m"): 50.0,
                   ("b", "inflow_m3s"): 1.0, ("b", "outflow_m3s"): 20.0, ("c", "storage_pct"): 99.0}


def test_glyph_ties_go_to_the_first_seen(spark):
    pairs = spark.createDataFrame([(1, 1, "㐁", "b"), (1, 2, "㐁", "a")], "run int, row int, enc string, truth string")
    assert extract_glyphs.train_glyphs(pairs, ["run"], "enc", "truth", ["row"]).first()["ch"] == "b"


def test_learned_centres_find_separated_columns(spark):
    rows = [(f"p{p}", float(100 * c + d)) for p in range(3) for c in range(7) for d in range(-3, 4)]
    words = spark.createDataFrame(rows, "page string, x double")
    centres = [r.centre for r in extract_words.learn_centres(words, "page", "x").orderBy("col_index").collect()]
    assert centres == pytest.approx([100.0 * c for c in range(7)], abs=1e-6)
    assert extract_words.learn_centres(words, "page", "x", min_words=50).collect() == []
    bad = spark.createDataFrame([(f"p{p}", float(p)) for p in range(60)] + [("bad", 900.0)] * 60, "page string, x double")
    spoiled = bad.union(words)
    learned = extract_words.learn_centres(spoiled, "page", "x", excluded=bad.select("page").where("page = 'bad'"))
    assert learned.agg(F.max("centre")).first()[0] < 700


def test_melt_keeps_units_and_reports_unmapped(spark):
    wide = local_table(spark, [("r", 1.0, None)], "reservoir_id string, `level (water level, m)` double, `x (TMC)` double")
    long = reshape.to_long(wide, ["reservoir_id"])
    assert [(r.variable_gloss, r.unit, r.value) for r in long.collect()] == [("water level", "m", 1.0)]


def _batch(spark, rows):
    return spark.createDataFrame(rows, "id string, date string, value double").selectExpr("id", "to_date(date) AS date", "value")


def test_archive_scan_is_bounded_by_the_batch(spark, tmp_path):
    from hydrolake.operators.merge import merge_into_path, touched_partitions

    path = f"{tmp_path}/archive"
    merge_into_path(spark, path, _batch(spark, [("a", f"2026-01-{d:02d}", 1.0) for d in range(1, 20)]), ["id", "date"], "date")
    new = _batch(spark, [("a", "2026-01-05", 2.0), ("b", "2026-01-07", 3.0)])
    merge_into_path(spark, path, new, ["id", "date"], "date")
    back = {(r.id, str(r.date)): r.value for r in spark.read.parquet(path).collect()}
    assert len(back) == 20 and back["a", "2026-01-05"] == 2.0 and back["b", "2026-01-07"] == 3.0
    archive = spark.read.schema(new.schema).parquet(path)
    plan = touched_partitions(archive, new, "date")._jdf.queryExecution().executedPlan().toString()
    filters = plan.split("PartitionFilters: [")[1].split("]")[0]
    assert ">= 2026-01-05" in filters and "<= 2026-01-07" in filters
    with pytest.raises(ValueError):
        merge_into_path(spark, path, new, ["id"], "date")


def test_long_sink_keeps_the_rest_of_the_year(spark, tmp_path):
    from hydrolake import sources

    path = f"{tmp_path}/long"
    sources.write_long(_batch(spark, [("a", "2026-01-01", 1.0), ("a", "2025-05-05", 9.0)]), path)
    sources.write_long(_batch(spark, [("a", "2026-01-02", 2.0)]), path)
    sources.write_long(_batch(spark, [("b", "2026-01-02", 3.0)]), path)
    got = {(r.id, str(r.date), r.value) for r in spark.read.parquet(path).collect()}
    assert got == {("a", "2026-01-01", 1.0), ("b", "2026-01-02", 3.0), ("a", "2025-05-05", 9.0)}


def test_payload_objects_with_lists_of_their_own(spark):
    from hydrolake.sources.files import payload_rows

    def rows(text, element):
        df = spark.createDataFrame([(text,)], "t string")
        return [r.asDict(True) for r in df.select(F.inline(payload_rows("t", element))).collect()]

    assert rows('{"id":1,"tags":[{"a":1}]}', "id int") == [{"id": 1}]
    assert rows('{"rows":[{"id":1},{"id":2}]}', "id int") == [{"id": 1}, {"id": 2}]
    assert rows('[{"d":1.25,"s":{"x":"y"}}]', "d decimal(10, 2), s struct<x: string>")[0]["s"] == {"x": "y"}


def test_snapshots_with_different_headers_meet_by_name(spark, tmp_path):
    from hydrolake import sources

    (tmp_path / "a_2026-01-01.csv").write_text("id,a,b\n1,A,B\n")
    (tmp_path / "b_2026-01-02.csv").write_text("id,b,a,c\n2,B,A,C\n")
    rows = {r.id: r for r in sources.read_snapshots(spark, str(tmp_path)).collect()}
    assert (rows["1"].a, rows["1"].b, rows["1"].c) == ("A", "B", None)
    assert (rows["2"].a, rows["2"].b, rows["2"].c, str(rows["2"].snapshot_date)) == ("A", "B", "C", "2026-01-02")


def test_newest_observation_without_date_columns(spark):
    df = spark.createDataFrame([("s", "x_2026-03-04.csv"), ("t", "none.csv")], "source string, f string")
    got = dict(select.newest_observation(df, "source", file_name="f").collect())
    assert got == {"s": "2026-03-04", "t": None}
    assert dict(select.newest_observation(df, "source", []).collect()) == {"s": None, "t": None}


def test_whole_files_are_one_row(spark, tmp_path):
    from hydrolake import sources

    (tmp_path / "page.html").write_text("<p>\none\ntwo</p>\n")
    rows = sources.read_pages(spark, str(tmp_path)).collect()
    assert [r.html for r in rows] == ["<p>\none\ntwo</p>\n"] and rows[0].fetched_at is not None


def test_archives_hold_many_pages(spark, tmp_path):
    from hydrolake import sources
    from hydrolake.plans import QUERIES, load_all

    pages = ["<p>\none\r\n\n</p>\n", "", "\n", "--x", "é\n--x"] + [f"page {i}\n--\n" for i in range(2000)]
    (tmp_path / "a.txt").write_bytes("".join(p + "\n--x--\n" for p in pages).encode())
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")  # pages across the bounds of splits
        rows = sources.read_pages(spark, str(tmp_path), "\n--x--\n").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert sorted(r.html for r in rows) == sorted(pages) and all(r.fetched_at and r.url.endswith("/a.txt") for r in rows)
    # and the query's pages have no file or folder each
    load_all()
    landed = QUERIES["read_pages"](spark, "/root/testdata/sf0.001")
    assert landed.count() == spark.read.parquet("/root/testdata/sf0.001/pages.parquet").count() > 10 * len(landed.inputFiles())


def test_header_in_any_row_and_tables_of_any_width(spark):
    from hydrolake.operators import extract_cells

    rows = [(1, 0, r, 0, "x") for r in range(60)]
    rows += [(1, 0, 60, c, t) for c, t in enumerate(["Station", "Reservoir", "% full"])] + [(1, 0, 61, c, t) for c, t in enumerate(["A2R001", "n", "5"])]
    cells = spark.createDataFrame(rows, "doc int, table_no int, row_no int, col_no int, text string")
    as_of = F.lit("2026-06-29").cast("date")
    assert [r.reservoir for r in extract_cells.map_header(cells, ["doc"], as_of).collect()] == ["n"]
    assert extract_cells.map_header(cells, ["doc"], as_of, header_rows=40).collect() == []
    wide = spark.createDataFrame([(1, 0, c, str(c)) for c in range(120)], "doc int, row_no int, col_no int, text string")
    assert {r.variable for r in extract_cells.layout_by_width(wide, ["doc"]).collect()} == {"inflow_day_mcm", "outflow_day_mcm", "storage_pct", "storage_p1_mcm"}


def test_sql_functions_equal_the_column_functions(spark):
    cells = ["", " ", "-", "--", "null", "1,234.5", " 1 234,5 ", "1\t2", "1 234", "-3", "+4 m", "12abc", "1e5", "NaN", "1d", "a\nb", "É à",
             "Dam (X) / Y", "26/06/2026", "26-06-2026", "2026-06-29", "20260629", "x 2026-06-29 y", "2020-01-01 〜 2020-12-31 (366 days)", "# 5",
             "‮7", "Kariba Dam", "Apr-23", "0", "٣", None]
    numbers = [None, 0.0, 1.0, 1.5, -2.25, 1e9, 1234.5678, 0.0005, float("nan")]
    names = dict(zip(sql.FUNCTIONS, sql.register(spark)))
    frames = {"x STRING": spark.createDataFrame([(c,) for c in cells], "x string"),
              "v DOUBLE": spark.createDataFrame([(v,) for v in numbers], "v double"),
              "d DATE": spark.createDataFrame([(D(2026, 6, 29),), (None,)], "d date"), "ms BIGINT": spark.createDataFrame([(1782691200000,), (None,)], "ms bigint")}
    for name, (arguments, fn) in sql.FUNCTIONS.items():
        if arguments in frames:
            arg = arguments.split()[0]
            rows = frames[arguments].select(fn(arg).alias("py"), F.expr(f"{names[name]}({arg})").alias("sql")).collect()
            assert [str(r.py) for r in rows] == [str(r.sql) for r in rows], name


def test_large_pages_and_long_heads(spark):
    word = lambda i: "".join(chr(ord("B") + int(c)) for c in str(i % 19000 + 10))
    objects = ", ".join(f'{{name: "Q{word(i)}", net: {i % 19000}, present: 1}}' for i in range(20000))
    head = "const mazowe = { note: '" + "x" * 500 + "', dams: [" + '{name: "Kariba", net: 10}' + "] };"
    pairs = "".join(f"<dt>k{i % 900}</dt><dd>v{i}</dd>" for i in range(9000))
    df = spark.createDataFrame([(1, f"<script>gwayiDams = [{objects}];</script>", pairs), (2, head, "<dd>x</dd><dt>a</dt><dd></dd><dt></dt><dd>y</dd>")],
                               "id int, js string, html string")
    rows = extract_text.js_objects(df, "js", ["id"]).collect()
    assert len({r.dam for r in rows if r.id == 1}) == 19000
    assert {(r.dam, r.catchment, r.value) for r in rows if r.id == 2} == {("KARIBA", "Mazowe", 10.0)}
    got = {(r.id, r.key): r.value for r in extract_text.html_pairs(df, "html", ["id"]).collect()}
    assert len(got) == 901 and got[1, "k5"] == "v8105" and got[2, "a"] == "y"


def test_cascade_reads_once_without_a_shuffle(spark, tmp_path):
    spark.createDataFrame([(1, "x")], "id int, h string").write.parquet(f"{tmp_path}/p")
    pages = spark.read.parquet(f"{tmp_path}/p")
    plan = extract_text.cascade(pages, ["id"], [extract_text.js_readings("h"), extract_text.table_readings("h"), extract_text.prose_readings("h")])
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("FileScan") == 1 and "Exchange" not in text


def test_ordered_operators_shuffle_rows_once(spark, tmp_path):
    spark.range(100).selectExpr("id", "id % 3 AS k", "timestamp_seconds(id * 900) AS ts", "CAST(id % 5 AS INT) AS n").write.parquet(f"{tmp_path}/p")
    df = spark.read.parquet(f"{tmp_path}/p")
    day = ordered.day_slice("ts")
    made = {"intervals": ordered.intervals(df, ["k"], "ts", 900), "streaks": ordered.streaks(df, ["k"], ["ts"], F.col("n") > 2, day),
            "threshold": ordered.dynamic_threshold(df, ["k"], ["ts"], "n", day)}
    old = {c: spark.conf.get(c) for c in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        for name, frame in made.items():
            text = frame.select("*")._jdf.queryExecution().sparkPlan().toString()
            ran = frame._jdf.sparkSession().sessionState().executePlan(frame._jdf.queryExecution().logical(), frame._jdf.queryExecution().mode()).executedPlan().toString()
            assert ran.count("FileScan") == 2, (name, text)
            assert ran.count("Exchange hashpartitioning(__ks") <= 3, (name, ran)
    finally:
        for c, v in old.items():
            spark.conf.set(c, v)


def test_long_token_lines(spark):
    line = ["x", "04-01", "08:00", "12", "05", "06:00", "n"] * 800
    got = spark.createDataFrame([(line,)], "t array<string>").select(extract_words.repair_tokens("t").alias("r")).first().r
    assert got == ["x", "04-01 08:00", "12-05 06:00", "n"] * 800


def test_learned_maps_are_joined_without_shuffling_rows(spark):
    rows = spark.range(1000).selectExpr("id % 2 AS run", "concat('#f1otltag', 'a', '#FontTag') AS t")
    maps = spark.createDataFrame([(0, "a", "b"), (1, "a", "c")], "run long, glyph string, ch string").repartition(3)
    out = extract_glyphs.decode_glyphs(rows, maps, ["run"], ["t"])
    assert {(r.run, r.t) for r in out.collect()} == {(0, "b"), (1, "c")}
    assert "Exchange hashpartitioning" not in out._jdf.queryExecution().executedPlan().toString()


def test_times_are_repaired_by_the_rules_alone(spark):
    # dashes with a colon, or blanks alone; mixed forms are no times
    texts = ["03-2608:00", "03 — 26 08：00", "O3-26 O8:00", "03 26 08 00", "03-26 08 00", "03 26 08:00", "03 2608 00", "a 12 34 56 7"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = [r[0] for r in df.orderBy("i").select(extract_words.normalize_time("t")).collect()]
    assert got == ["03-26 08:00"] * 4 + ["03-26 08 00", "03 26 08:00", "03 2608 00", "a 12 34 56 7"]
    line = spark.createDataFrame([(["B", "12 34", "56:78", "03-26", "08:00", "12.5"],)], "t array<string>")
    assert line.select(extract_words.repair_tokens("t")).first()[0] == ["B", "12 34", "56:78", "03-26 08:00", "12.5"]


def test_long_lists_in_prose(spark):
    names = {f"DAM {k}": f"D{k}" for k in range(40)}
    listed = ", ".join(f"Dam {k}" for k in range(39)) + " e Dam 39"
    shares = ", ".join(f"{k},5%" for k in range(40))
    text = f"A albufeira de Outra mantém o nivel, as albufeiras de {listed} registam níveis de enchimento de {shares}, respectivamente."
    assert len(listed) > 300
    out = extract_text.prose_pairs(spark.createDataFrame([(1, text)], "i int, t string"), "t", ["i"], names).collect()
    assert {(r.dam, r.value) for r in out} == {(f"D{k}", k + 0.5) for k in range(40)}


def test_glyphs_of_several_characters(spark):
    rows = spark.createDataFrame([(0, "#f1otltaga bc#FontTag"), (1, "#f1otltagabc#FontTag"), (2, "#f1otltagab#FontTag"), (0, "abc")], "run long, t string")
    maps = spark.createDataFrame([(0, "a", "x"), (0, "b", "㐀"), (1, "a", "long"), (1, "c", "z")], "run long, glyph string, ch string")
    got = {(r.run, r.t, r.unresolved_count, r.unresolved_chars) for r in extract_glyphs.decode_glyphs(rows, maps, ["run"], ["t"]).collect()}
    assert got == {(0, "x㐀c", 1, "㐀"), (1, "longbz", 0, ""), (2, "ab", 0, ""), (0, "abc", 0, "")}


def test_rowspan_blocks_in_order(spark):
    """Random documents against a plain walk over the rows."""
    rng = random.Random(11)
    cells = {"parent": lambda i: [f"D{i}"] + [f"p{i}.{k}" for k in range(1, 13)], "child": lambda i: [f"c{i}.{k}" for k in range(9)],
             "date": lambda i: [rng.choice(["Apr-23", "Dec-31", "Foo-99"])], "blank": lambda i: [""], "head": lambda i: ["Dam Name"] + [""] * 12}
    rows, want = [], []
    for doc in range(150):
        dam = child = None
        dates = 0
        for i in range(rng.randint(0, 25)):
            kind = rng.choice(["parent", "child", "child", "date", "date", "blank", "head"])
            c = cells[kind](i)
            rows.append((doc, i, c))
            if kind == "parent":
                dam, child, dates = c, None, 0
            elif kind == "child":
                child = c
            elif kind == "date" and dam:
                dates += 1
                source = dam if dates == 1 else child
                if source and c[0] != "Foo-99":
                    want.append((doc, i, dam[0], "2026-04-23" if c[0] == "Apr-23" else "2025-12-31", source[2] if dates == 1 else source[1], source[12] if dates == 1 else source[8]))
                child = child if dates == 1 else None
    rng.shuffle(rows)
    out = extract_cells.carry_rowspan(spark.createDataFrame(rows, "doc int, row int, c array<string>"), ["doc"], "row", "c", F.lit("2026-04-30").cast("date"))
    assert sorted((r.doc, r.row, r.dam, str(r.date), r.water_level, r.outflow) for r in out.collect()) == sorted(want) and len(want) > 100
    assert "Window" not in out._jdf.queryExecution().executedPlan().toString()


def test_layout_by_width_joins_nothing(spark):
    from hydrolake.plans import QUERIES, load_all

    load_all()
    plan = QUERIES["layout_by_width"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Broadcast" not in plan
    cells = [(1, r, c, f"{r}.{c}", "situation" if r == 0 else None) for r in range(2) for c in range(27)]
    cells += [(2, 0, c, str(c), "flows") for c in range(13)] + [(2, 1, 13, "wider below", None)]
    cells += [(None, 0, c, str(c), "flows") for c in range(18)] + [(3, 1, c, str(c), "flows") for c in range(18)] + [(4, 0, c, str(c), "other") for c in range(18)]
    out = extract_cells.layout_by_width(spark.createDataFrame(cells, "doc int, row_no int, col_no int, text string, kind string"), ["doc"], "kind")
    assert out.columns == ["doc", "col_no", "row_no", "text", "kind", "width", "variable"]
    got = {(r.doc, r.row_no, r.col_no, r.width, r.variable) for r in out.collect()}
    assert {x for x in got if x[0] == 2} == {(2, 0, 1, 13, "inflow_day_mcm"), (2, 0, 8, 13, "outflow_day_mcm"), (2, 1, 13, 13, "storage_p1_mcm")}
    assert len(got) == 3 + 2 * 6 and {x[0] for x in got} == {1, 2}


def test_nearest_centre_of_two_as_near_up_to_rounding(spark):
    x, (p, q) = 61.0, (46, 3)
    left, right = (x * q - p) / q, (x * q + p) / q
    assert abs(right - x) < abs(left - x)  # in the last bit only
    words = spark.createDataFrame([(1, x), (1, x + 0.001), (1, None), (1, float("inf"))], "page int, x double")
    centres = spark.createDataFrame([(1, left), (1, right)], "page int, centre double")
    got = {r.x: r.col_index for r in extract_words.assign_columns(words, centres, ["page"], "x").collect()}
    assert got == {x: 0, x + 0.001: 1, None: None, float("inf"): 0}


@pytest.mark.parametrize("kind", ["bigint", "string"])
def test_glyph_votes_are_tallied_without_a_sort(spark, kind):
    big = 9223372036854775807
    rows = [(1, -big - 1, "㐁㐂", "bx"), (1, None, "㐁㐂", "ay"), (1, 5, "㐃", "n"), (1, 4, "㐃", "m"), (1, big, "㐄㐄", "pq"), (1, 7, "㐅㐅", "ut"), (1, 7, "㐅", "t")]
    pairs = spark.createDataFrame(rows, "run int, row bigint, enc string, truth string").withColumn("row", F.col("row").cast(kind))
    out = extract_glyphs.train_glyphs(pairs, ["run"], "enc", "truth", ["row"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    sorted_by_character = re.search(r"SortAggregate\(key=\[run#\w+, glyph#\w+, ch#\w+\]", plan)
    assert bool(sorted_by_character) == (kind == "string")
    got = {r.glyph: (r.ch, r.votes, r.rivals) for r in out.collect()}
    assert got == {"㐁": ("a", 1, 2), "㐂": ("y", 1, 2), "㐃": ("m", 1, 2), "㐄": ("p", 1, 2), "㐅": ("t", 2, 2)}


def test_rowspan_dates_are_resolved_once(spark):
    rows = spark.createDataFrame([(1, 0, ["x"])], "doc int, row int, c array<string>")
    out = extract_cells.carry_rowspan(rows, ["doc"], "row", "c", F.lit("2026-04-30").cast("date"))
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert not [line for line in plan.splitlines() if "Filter" in line and "MMM-d" in line]
