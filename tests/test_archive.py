"""Archives published as a whole, bucketed archives, observed counts, live freshness, interval joins."""

import datetime as dt
import time
import uuid

import numpy as np
import pytest
from pyspark.sql import functions as F

from hydrolake import sources, streaming
from hydrolake.operators import archive, bucketed, joins, merge

SCHEMA = "id string, date string, value double"


def rows(df):
    return {(r.id, r.date): r.value for r in df.collect()}


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_publish_reads_and_writes_touched_partitions(spark, tmp_path):
    path, make = f"{tmp_path}/a", lambda x: spark.createDataFrame(x, SCHEMA)
    done = archive.publish_merge(spark, path, make([("a", f"2026-01-{d:02d}", 1.0) for d in range(1, 20)] + [("n", None, 5.0)]), ["id", "date"], "date")
    assert (done.number, done.counts["added"], done.late) == (0, 20, None)
    done = archive.publish_merge(spark, path, make([("a", "2026-01-05", 2.0), ("a", "2026-01-06", 1.0), ("b", "2026-01-07", 3.0)]), ["id", "date"], "date")
    assert done.counts == {"added": 1, "updated": 1, "unchanged": 1, "kept": 1}
    back = rows(archive.read_archive(spark, path, SCHEMA))
    assert len(back) == 21 and back["a", "2026-01-05"] == 2.0 and back["b", "2026-01-07"] == 3.0 and back["n", None] == 5.0
    assert sorted(archive.child_names(spark, f"{path}/data/batch=1")) == ["_SUCCESS", "date=2026-01-05", "date=2026-01-06", "date=2026-01-07"]
    some = archive.read_archive(spark, path, SCHEMA, "2026-01-05", "2026-01-06")
    assert len(some.inputFiles()) == 2 and len(rows(some)) == 2
    assert rows(archive.read_archive(spark, path, SCHEMA, number=0))["a", "2026-01-05"] == 1.0
    archive.publish_merge(spark, path, make([("a", "2026-01-05", 7.0)]), ["id", "date"], "date")
    assert archive.heads(spark, path) == [1, 2] and "date=2026-01-05" not in archive.child_names(spark, f"{path}/data/batch=0")
    assert rows(archive.read_archive(spark, path, SCHEMA)) == back | {("a", "2026-01-05"): 7.0}
    assert archive.publish_merge(spark, path, make([]), ["id", "date"], "date").number == 2
    with pytest.raises(ValueError):
        archive.publish_merge(spark, path, make([]), ["id"], "date")
    assert archive.read_archive(spark, f"{tmp_path}/none", SCHEMA).collect() == []


def test_a_writer_that_dies_half_way_changes_nothing(spark, tmp_path):
    path, make = f"{tmp_path}/a", lambda x: spark.createDataFrame(x, SCHEMA)
    archive.publish_merge(spark, path, make([("a", "2026-01-01", 1.0), ("a", "2026-01-02", 1.0)]), ["id", "date"], "date")
    before = rows(archive.read_archive(spark, path, SCHEMA))
    boom = F.udf(lambda v: 1 / 0 if v == 9.0 else v, "double")
    broken = make([("a", "2026-01-01", 2.0), ("a", "2026-01-02", 9.0)]).withColumn("value", boom("value"))
    with pytest.raises(Exception, match="division by zero"):
        archive.publish_merge(spark, path, broken, ["id", "date"], "date")
    # and one that wrote its data, but died before its head
    make([("a", "2026-01-01", 4.0)]).write.partitionBy("date").mode("overwrite").parquet(f"{path}/data/batch=1")
    spark.createDataFrame([("date=2026-01-01", 1)], "folder string, batch bigint").write.parquet(f"{path}/heads/1")
    archive.delete_path(spark, f"{path}/heads/1/_SUCCESS")
    assert rows(archive.read_archive(spark, path, SCHEMA)) == before and archive.heads(spark, path) == [0]
    archive.publish_merge(spark, path, make([("a", "2026-01-02", 3.0)]), ["id", "date"], "date")
    assert rows(archive.read_archive(spark, path, SCHEMA)) == {("a", "2026-01-01"): 1.0, ("a", "2026-01-02"): 3.0}


def test_rows_older_than_the_window_come_back(spark, tmp_path):
    path = f"{tmp_path}/a"
    make = lambda x: spark.createDataFrame(x, "id string, date date, value double, seen string")
    day = lambda n: dt.date(2026, 1, n)
    publish = lambda x: archive.publish_merge(spark, path, make(x), ["id", "date"], "date", ["seen"], window_days=5)
    assert publish([("a", day(n), 1.0, "x") for n in range(1, 21)]).late is None  # an empty archive takes everything
    done = publish([("a", day(3), 2.0, "y"), ("a", day(4), 1.0, "y"), ("b", day(2), 1.0, "y"), ("a", day(16), 2.0, "y"), ("a", day(21), 1.0, "y"), ("z", None, 1.0, "y")])
    assert sorted((r.id, r.date, r.value, r.kind) for r in done.late.collect()) == [("a", day(3), 2.0, "revised"), ("b", day(2), 1.0, "new")]
    back = {(r.id, r.date): r.value for r in archive.read_archive(spark, path, "id string, date date, value double, seen string").collect()}
    assert len(back) == 22 and back["a", day(3)] == 1.0 and back["a", day(16)] == 2.0 and ("b", day(2)) not in back and back["z", None] == 1.0


def test_stream_hands_late_rows_over(spark, tmp_path):
    land, got = f"{tmp_path}/land", []
    for n, batch in enumerate(([("a", "2026-01-01", 1.0), ("a", "2026-01-30", 1.0)], [("a", "2026-01-01", 2.0), ("a", "2026-01-29", 2.0)])):
        spark.createDataFrame(batch, SCHEMA).write.mode("append").parquet(land)
        stream = streaming.ingest_stream(spark, land, spark.read.parquet(land).schema)
        streaming.upsert_stream(stream, f"{tmp_path}/a", ["id", "date"], "date", ["value"], f"{tmp_path}/c", window_days=7,
                                late=lambda df, k: got.extend((k, r.date, r.kind) for r in df.collect())).awaitTermination()
    assert got == [(1, "2026-01-01", "revised")]
    assert rows(archive.read_archive(spark, f"{tmp_path}/a", SCHEMA)) == {("a", "2026-01-01"): 1.0, ("a", "2026-01-29"): 2.0, ("a", "2026-01-30"): 1.0}


def test_bucketed_archive_is_not_shuffled(spark, tmp_path):
    name = f"arch_{uuid.uuid4().hex}"
    old = spark.range(1000).selectExpr("id AS k", "id * 2 AS v", "'current' AS kind")
    new = spark.range(900, 1100).selectExpr("id AS k", "id AS v", "'current' AS kind")
    bucketed.create(old, name, ["k"], 4, str(tmp_path))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for how in (merge.upsert, lambda a, b, k: merge.upsert_ranked(a, b, k, "kind", {"current": 1}), lambda a, b, k: merge.overlay(a, b, k)):
            out = how(spark.table(name), bucketed.beside(new, f"{name}_v0"), ["k"])
            plan = plan_of(out.rows if isinstance(out, merge.Merged) else out)
            # the one exchange is the batch's
            assert plan.count("Exchange") == 1 and "Bucketed: true" in plan and "SortMergeJoin" in plan, plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    for n in (1, 2, 3):
        assert bucketed.merge_tables(spark, name, new.withColumn("v", F.col("v") + n), ["k"], merge.upsert, folder=str(tmp_path)) == n
        assert bucketed.bucket_spec(spark, f"{name}_v{n}") == (4, ["k"])
        assert {r.k: r.v for r in spark.table(name).collect()} == {**{k: 2 * k for k in range(900)}, **{k: k + n for k in range(900, 1100)}}
    assert bucketed.versions(spark, name) == [2, 3]
    with pytest.raises(ValueError):
        old.write.option("path", f"{tmp_path}/flat").saveAsTable(f"{name}_flat")
        bucketed.beside(new, f"{name}_flat")


def test_rows_and_counts_come_from_one_job(spark, tmp_path):
    spark.range(100).selectExpr("id AS k", "id AS v").write.parquet(f"{tmp_path}/old")
    spark.range(50, 120).selectExpr("id AS k", "id + id % 2 AS v").write.parquet(f"{tmp_path}/new")
    old, new = (spark.read.parquet(f"{tmp_path}/{s}") for s in ("old", "new"))
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("counted", "")
    table, seen = merge.counted(merge.upsert(old, new, ["k"]))
    table.write.parquet(f"{tmp_path}/out")
    assert seen.get == {"added": 20, "updated": 25, "unchanged": 25, "kept": 50}
    one = len(tracker.getJobIdsForGroup("counted"))
    spark.sparkContext.setJobGroup("plain", "")
    merge.upsert(old, new, ["k"]).rows.write.parquet(f"{tmp_path}/plain")
    assert one == len(tracker.getJobIdsForGroup("plain"))
    spark.sparkContext.setJobGroup("", "")
    assert seen.get == merge.upsert(old, new, ["k"]).stats.first().asDict()


def monitor(spark, now, out, seen):
    registry = spark.createDataFrame([("a", 24, 12, "active"), ("b", 24, 12, "active"), ("c", 24, 12, "active")],
                                     "source_id string, publication_cadence_hours int, max_schedule_gap_hours int, deployment_status string")
    return streaming.FreshnessMonitor(
        registry, now, lambda df: df.selectExpr("source_id", "ts AS run_ts", "run_file", "status"),
        lambda df: df.groupBy("source_id").agg(F.max("day").alias("latest_observation")),
        lambda report, n: out.append((n, {r.source_id: r.state for r in report.collect()})), seen)


LANDED = "source_id string, ts timestamp, run_file string, status string, day string"


def land(spark, path, source, day):
    spark.createDataFrame([(source, dt.datetime.fromisoformat(day), f"{day}.json", "ok", day)], LANDED).write.mode("append").parquet(path)


def test_a_silent_source_turns_stale_without_new_files(spark, tmp_path):
    files, out, clock = f"{tmp_path}/land", [], {"now": "2026-01-03"}
    for s in "ab":
        land(spark, files, s, "2026-01-02")
    watch = monitor(spark, lambda: F.lit(clock["now"]).cast("timestamp"), out, f"{tmp_path}/seen")
    schema = spark.read.parquet(files).schema
    query = watch.watch(streaming.ingest_stream(spark, files, schema), f"{tmp_path}/c", "1 second")

    def until(want):
        end = time.time() + 90
        while time.time() < end and (not out or out[-1][1] != want):
            assert query.exception() is None
            time.sleep(0.2)
        assert out[-1][1] == want

    try:
        until({"a": "fresh", "b": "fresh", "c": "no_observation_date"})
        land(spark, files, "a", "2026-01-06")
        clock["now"] = "2026-01-07"  # three and a half days of budget: b is silent for five
        until({"a": "fresh", "b": "stale", "c": "no_observation_date"})
        n = len(out)
        clock["now"] = "2026-01-20"  # nothing lands any more
        until({"a": "stale", "b": "stale", "c": "no_observation_date"})
        assert len(out) > n
    finally:
        query.stop()
    assert len(watch.states(spark)) <= 3


def test_scheduled_runs_report_without_new_files_and_keep_few_states(spark, tmp_path):
    files, out = f"{tmp_path}/land", []
    for k, day in enumerate(("2026-01-02", "2026-01-03", "2026-01-04", "2026-01-05")):
        land(spark, files, "ab"[k % 2], day)
        schema = spark.read.parquet(files).schema
        monitor(spark, F.lit(day).cast("timestamp"), out, f"{tmp_path}/seen").drain(streaming.ingest_stream(spark, files, schema), f"{tmp_path}/c")
    last = monitor(spark, F.lit("2026-02-01").cast("timestamp"), out, f"{tmp_path}/seen")
    last.drain(streaming.ingest_stream(spark, files, schema), f"{tmp_path}/c")
    assert [s["a"] for _, s in out] == ["fresh"] * 4 + ["stale"] and len(last.states(spark)) == 2
    # a replayed batch starts from the same predecessor
    again = last.states(spark)[-1]
    last.update(spark.read.parquet(files).where("day = '2026-01-05'"), again)
    runs = spark.read.parquet(f"{tmp_path}/seen/state-{again}/runs")
    assert sorted(r.run_file for r in runs.collect()) == [f"2026-01-0{d}.json" for d in (2, 3, 4, 5)]


def plain_quality(obs, periods):
    return sorted((str(o), s) for o, k, d in obs for s in
                  [q for pk, a, b, q in periods if k == pk and k is not None and d is not None and a is not None and a <= d and (b is None or d <= b)] or [None])


def test_quality_periods_against_brute_force(spark):
    rng = np.random.default_rng(3)
    day = lambda n: dt.date(1990, 1, 1) + dt.timedelta(days=int(n))
    periods = [(str(rng.choice(list("ab"))), day(s), None if rng.random() < 0.1 else day(s + n), f"q{i}") for i, (s, n) in enumerate(
        zip(rng.integers(0, 12000, 150), rng.choice([0, 1, 15, 16, 17, 255, 256, 400, 5000, 9000], 150)))]
    periods += [("a", None, day(5), "no start"), ("a", day(9), day(5), "backwards"), (None, day(0), None, "no key"), ("b", dt.date(1950, 1, 1), dt.date(1969, 12, 31), "before epoch")]
    obs = [(i, str(rng.choice(list("abc"))), day(d)) for i, d in enumerate(rng.integers(-9000, 20000, 600))] + [(900, None, day(3)), (901, "a", None), (902, "b", dt.date(1955, 5, 5))]
    schema = "k string, start_date date, end_date date, quality_state string"
    for some, few in ((periods, 16), (periods, 1000), (periods[:9], 0), (periods[:9], 16), ([], 16), ([], -1)):
        got = joins.attach_quality(spark.createDataFrame(obs, "o int, k string, date date"), spark.createDataFrame(some, schema), ["k"], "date", few)
        assert got.columns == ["o", "k", "date", "quality_state"]
        assert sorted(((str(r.o), r.quality_state) for r in got.collect()), key=str) == sorted(plain_quality(obs, some), key=str)


def test_a_key_with_very_many_periods(spark):
    """100,000 periods and 1,000,000 readings of one key, without 10^11 pairs."""
    periods = spark.range(100_000).selectExpr("'a' AS k", "date_add(DATE '1800-01-01', int(id)) AS start_date",
                                              "CASE WHEN id % 50000 = 7 THEN NULL ELSE date_add(DATE '1800-01-01', int(id + id % 40)) END AS end_date", "concat('q', id) AS quality_state")
    obs = spark.range(1_000_000).selectExpr("id", "'a' AS k", "date_add(DATE '1790-01-01', int(id % 110000)) AS date")
    start = time.time()
    got = joins.attach_quality(obs, periods, ["k"], "date").groupBy(F.col("quality_state").isNull().alias("none")).count().collect()
    took = time.time() - start
    i = np.arange(100_000)
    end = np.where(i % 50000 == 7, 10**9, i + i % 40)
    days = (np.arange(1_000_000) % 110_000) - (dt.date(1800, 1, 1) - dt.date(1790, 1, 1)).days
    n = np.searchsorted(i, days, "right") - np.searchsorted(np.sort(end), days, "left")
    assert {r[0]: r[1] for r in got} == {False: int(n.sum()), True: int((n == 0).sum())}
    assert took < 60


def test_a_large_archive_is_cut_before_it_is_shuffled(spark, tmp_path):
    spark.range(200_000).selectExpr("id AS k", "repeat('x', 20) AS pad").write.parquet(f"{tmp_path}/held")
    spark.range(1000).selectExpr("id * 150 + 7 AS k").write.parquet(f"{tmp_path}/todo")
    held, todo = (spark.read.parquet(f"{tmp_path}/{n}") for n in ("held", "todo"))
    odd = held.where("k % 2 = 1")
    for name, value in (("autoBroadcastJoinThreshold", "-1"), ("optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold", "1")):
        spark.conf.set(f"spark.sql.{name}", value)
    try:
        plan = joins.held_among(held, todo, ["k"])._jdf.queryExecution().optimizedPlan().toString()
        assert "might_contain" in plan and "<= 149857" in plan and ">= 7" in plan, plan
        got = joins.not_yet_held(todo, odd, ["k"], large=True)
        assert sorted(r.k for r in got.collect()) == sorted(r.k for r in joins.not_yet_held(todo, odd, ["k"]).collect()) == [k for k in range(7, 150000, 150) if k % 2 == 0]
    finally:
        for name in ("autoBroadcastJoinThreshold", "optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold"):
            spark.conf.unset(f"spark.sql.{name}")
    assert joins.not_yet_held(todo, odd.where("false"), ["k"], large=True).count() == 1000
    assert joins.not_yet_held(todo.where("false"), odd, ["k"], large=True).count() == 0


def test_footers_answer_newest_days_without_data_pages(spark, tmp_path):
    from hydrolake.operators import quality, select

    df = spark.range(5000).selectExpr("id % 3 AS source", "date_add(DATE '2026-01-01', int(id % 40)) AS date", "id AS v")
    df.write.partitionBy("source").parquet(f"{tmp_path}/t")
    plain, footers = spark.read.parquet(f"{tmp_path}/t"), sources.read_footers(spark, f"{tmp_path}/t")
    lag = lambda d: quality.assert_lag(d, "date", F.lit("2026-02-20").cast("date"), 10, ["source"])
    record = lambda d: select.period_of_record(d, ["source"], "date")
    for query in (lag, record):
        plan = plan_of(query(footers))
        assert "PushedAggregation: [" in plan and "MAX(date)" in plan, plan
        assert sorted(query(footers).collect()) == sorted(query(plain).collect())
    assert "FileScan parquet" in plan_of(plain)  # other readers are as before


def test_matched_join_runs_once(spark):
    left = spark.createDataFrame([(1, "Dám A"), (2, "dam a"), (3, "Dam B"), (4, "Dam C"), (5, "nowhere")] + [(k, "Dam H") for k in range(100, 400)], "pos int, l string")
    right = spark.createDataFrame([("DAM A", "s1", 1.0), ("dam b", "s2", 2.0), ("dam c", "s3", None), ("dam h", "s4", 4.0)], "r string, station string, reading double")
    rows, report = joins.match_join(left, right, "l", "r", "station", "reading", "pos")
    assert sorted((r.pos, r.station, r.reading) for r in rows.collect()) == [(1, "s1", 1.0), (3, "s2", 2.0), (100, "s4", 4.0)]
    got = sorted((r.kind, r.name) for r in report.collect())
    assert got == sorted([("duplicate_station", "dam a"), ("missing_at_date", "Dam C"), ("unmatched", "nowhere")] + [("duplicate_station", "Dam H")] * 299)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(joins.match_join(left, right, "l", "r", "station", "reading", "pos")[1])
        assert plan.count("FileScan") == 2 and plan.count("Exchange") <= 3, plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
