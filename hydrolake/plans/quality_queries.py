"""Q1-Q10: contracts, audit, freshness, licences, gaps."""

from __future__ import annotations

from pyspark.sql import functions as F

from hydrolake.operators import quality
from hydrolake.plans.registry import query, table, text
from hydrolake.session import local_table, scratch_path
from hydrolake.sources import read_footers


@query("""WITH m AS (SELECT concat('R', CASE WHEN c_custkey % 50 = 1 THEN c_custkey - 1 ELSE c_custkey END) AS id, c_custkey AS k FROM customer)
 SELECT id AS reservoir_id, issue FROM (SELECT id, unnest(list_filter([
 CASE WHEN k % 7 = 0 THEN 'missing reservoir_name' END, CASE WHEN k % 11 = 0 THEN 'missing data_type' END, CASE WHEN k % 13 = 0 AND k % 11 > 0 THEN 'invalid data_type' END,
 CASE WHEN k % 17 = 0 THEN 'lat out of range' END, CASE WHEN k % 19 = 0 THEN 'lon out of range' END], lambda x: x IS NOT NULL)) AS issue FROM m)
 UNION ALL SELECT id, 'duplicate reservoir_id' FROM m GROUP BY id HAVING count(*) > 1""")
def check_metadata(spark, sf):
    k = "c_custkey"
    meta = table(spark, sf, "customer").select(
        F.concat(F.lit("R"), text(F.expr(f"CASE WHEN {k} % 50 = 1 THEN {k} - 1 ELSE {k} END"))).alias("reservoir_id"),
        F.expr(f"CASE WHEN {k} % 7 = 0 THEN ' ' ELSE c_name END").alias("reservoir_name"), F.lit("X").alias("country"),
        F.expr(f"CASE WHEN {k} % 17 = 0 THEN '91.5' ELSE '-45.25' END").alias("lat"),
        F.expr(f"CASE WHEN {k} % 19 = 0 THEN 'east' ELSE '179' END").alias("lon"), F.lit("A").alias("source_agency"),
        F.lit("u").alias("source_url"), F.lit("t").alias("last_updated"),
        F.expr(f"CASE WHEN {k} % 11 = 0 THEN NULL WHEN {k} % 13 = 0 THEN 'gauge' ELSE 'in_situ' END").alias("data_type"))
    return quality.check_metadata(meta)


_CELL_A = "CASE l_linenumber % 4 WHEN 0 THEN '--' WHEN 1 THEN concat(CAST(l_partkey AS STRING), ' m') ELSE CAST(l_partkey AS STRING) END"
_CELL_B = "CASE WHEN l_suppkey % 9 = 0 THEN 'NA' WHEN l_suppkey % 10 = 0 THEN concat(CAST(l_suppkey AS STRING), '.5 m^3/s') ELSE '' END"


@query(f"""SELECT l_orderkey, "column", issue, count(*) AS n FROM (SELECT l_orderkey, 'a' AS "column", CASE l_linenumber % 4 WHEN 0 THEN 'leftover marker' WHEN 1 THEN 'unit in cell' END AS issue FROM lineitem
 UNION ALL SELECT l_orderkey, 'b', CASE WHEN l_suppkey % 9 = 0 THEN 'leftover marker' WHEN l_suppkey % 10 = 0 THEN 'unit in cell' END FROM lineitem) WHERE issue IS NOT NULL GROUP BY ALL""")
def check_cells(spark, sf):
    df = table(spark, sf, "lineitem").select("l_orderkey", F.expr(_CELL_A).alias("a"), F.expr(_CELL_B).alias("b"))
    return quality.check_cells(df, ["l_orderkey"], ["a", "b"]).groupBy("l_orderkey", "column", "issue").agg(F.count(F.lit(1)).alias("n"))


_META_ID = "CASE WHEN o_orderpriority = '5-LOW' THEN -o_orderkey ELSE o_orderkey END"


@query(f"SELECT l_orderkey, count(*) AS n FROM lineitem WHERE l_orderkey NOT IN (SELECT {_META_ID} FROM orders) GROUP BY ALL")
def check_fk(spark, sf):
    meta = table(spark, sf, "orders").select(F.expr(_META_ID).alias("l_orderkey"))
    return quality.check_fk(table(spark, sf, "lineitem").select("l_orderkey"), meta, "l_orderkey")


@query("""SELECT 'header' AS rule, true AS ok, 'o_orderkey,o_orderstatus,unit' AS detail UNION ALL SELECT 'min_rows', count(*) >= 150, CAST(count(*) AS VARCHAR) FROM orders
 UNION ALL SELECT 'constant unit', true, '0' UNION ALL SELECT 'constant o_orderstatus', false, CAST(count(*) FILTER (o_orderstatus <> 'F') AS VARCHAR) FROM orders""")
def check_contract(spark, sf):
    df = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", F.lit("MetersOverSeaLevel").alias("unit"))
    return quality.check_contract(df, ["o_orderkey", "o_orderstatus", "unit"], 150,
                                  {"unit": "MetersOverSeaLevel", "o_orderstatus": "F"})


def registry(spark, sf):
    """A registry with planted faults, one source per supplier."""
    s = "s_suppkey"
    return table(spark, sf, "supplier").select(
        F.concat(F.lit("src"), text(F.expr(f"CASE WHEN {s} % 25 = 24 THEN {s} - 1 ELSE {s} END"))).alias("source_id"),
        F.lit("X").alias("country"),
        F.expr(f"CASE WHEN {s} % 6 = 5 THEN 'permanent_archive' ELSE 'rolling_window' END").alias("retention_class"),
        F.lit(48.0).alias("retention_window_hours"), F.expr(f"CAST({s} % 3 * 24 AS DOUBLE)").alias("publication_cadence_hours"),
        F.expr(f"CASE WHEN {s} % 8 = 7 THEN ' ' ELSE 'UTC' END").alias("timezone"),
        F.expr(f"CASE WHEN {s} % 9 = 8 THEN array() ELSE array('0 6 * * *') END").cast("array<string>").alias("cron"),
        F.lit(12.0).alias("max_schedule_gap_hours"),
        F.expr(f"CASE WHEN {s} % 10 = 9 THEN 1 ELSE 2 END").alias("minimum_capture_opportunities"),
        F.lit("o").alias("overlap_strategy"), F.lit("r").alias("schedule_rationale"),
        F.expr(f"concat('w/', CAST({s} % 4 AS STRING), '.yml')").alias("workflow"), F.lit("s.py").alias("scraper"),
        F.concat(F.lit("data/"), text(s)).alias("data_path"),
        F.expr(f"CASE WHEN {s} % 2 = 0 THEN 'active' ELSE 'pending' END").alias("deployment_status"),
        F.expr(f"CASE WHEN {s} % 7 = 6 THEN NULL ELSE 'g' END").alias("licence_gate"))


def _registry_files(spark, sf):
    """Workflow texts of the even kinds; every data folder but those of the first three nations."""
    folders = table(spark, sf, "supplier").where("s_nationkey >= 3").select(
        F.concat(F.lit("data/"), text("s_suppkey")).alias("path"), F.lit(None).cast("string").alias("text"))
    workflows = local_table(spark, [
        ("w/0.yml", "schedule: workflow_dispatch contents: write concurrency: git push 0 6 * * * data/"),
        ("w/2.yml", "schedule: contents: write git push 0 7 * * *"), ("s.py", "code")], "path string, text string")
    return folders.unionByName(workflows)


_REG = """(SELECT s_suppkey AS s, concat('src', CASE WHEN s_suppkey % 25 = 24 THEN s_suppkey - 1 ELSE s_suppkey END) AS source_id, s_nationkey FROM supplier)"""
_AUDIT = f"""(SELECT source_id, issue FROM (
 SELECT source_id, unnest(list_filter(CASE WHEN s % 7 = 6 THEN ['missing registry fields: licence_gate'] ELSE [
  CASE WHEN s % 6 = 5 THEN 'invalid retention_class ''permanent_archive''' END, CASE WHEN s % 9 = 8 THEN 'cron must contain at least one schedule' END,
  CASE WHEN s % 10 = 9 THEN 'minimum_capture_opportunities must be at least 2' END, CASE WHEN s % 8 = 7 THEN 'timezone must be documented' END,
  CASE WHEN s % 2 = 0 AND s_nationkey < 3 THEN concat('data_path does not exist: data/', s) END,
  CASE WHEN s % 4 = 2 THEN 'workflow missing manual recovery (workflow_dispatch)' END, CASE WHEN s % 4 = 2 THEN 'workflow missing concurrency protection (concurrency:)' END,
  CASE WHEN s % 4 = 2 AND s % 9 <> 8 THEN 'registered cron not found in workflow: 0 6 * * *' END,
  CASE WHEN s % 2 = 0 THEN concat('workflow does not reference registered data_path data/', s) END] END, lambda x: x IS NOT NULL)) AS issue FROM {_REG})
 UNION ALL SELECT source_id, 'duplicate source_id' FROM {_REG} GROUP BY source_id HAVING count(*) > 1)"""


@query(f"SELECT * FROM {_AUDIT}")
def audit_registry(spark, sf):
    return quality.audit_registry(registry(spark, sf), _registry_files(spark, sf))[0]


@query(f"""SELECT count(*) AS sources_registered, count(*) FILTER (s % 2 = 0) AS active_deployments, count(*) FILTER (s % 2 = 1) AS pending_or_blocked,
 (SELECT count(*) FROM {_AUDIT}) AS n_issues, 'FAIL' AS status FROM {_REG}""")
def audit_report(spark, sf):
    return quality.audit_registry(registry(spark, sf), _registry_files(spark, sf))[1]


_NOW = "2024-02-01 12:00:00"
_FRESH = """(SELECT s.*, e.obs, e.last_run, e.status, coalesce(nullif(CAST(s % 3 * 24 AS DOUBLE), 0), 24.0) * 3 + 12 AS budget,
 date_diff('second', CAST(e.obs AS TIMESTAMP), TIMESTAMP '2024-02-01 12:00:00') / 3600.0 AS age FROM (SELECT s_suppkey AS s, s_nationkey, concat('src', s_suppkey) AS source_id FROM supplier) s
 LEFT JOIN (SELECT user_id, CASE WHEN user_id % 11 > 0 THEN strftime(max(ts), '%Y-%m-%d') END AS obs, max(ts) AS last_run, arg_max(event_type, event_id) AS status FROM events GROUP BY user_id) e ON e.user_id = s.s)"""


@query(f"""SELECT source_id, CASE WHEN s % 5 = 4 THEN 'not_active' WHEN s_nationkey = 12 THEN 'no_data_dir' WHEN age IS NULL THEN 'no_observation_date' WHEN age > budget THEN 'stale' ELSE 'fresh' END AS state,
 obs AS latest_observation, round(age, 1) AS observation_age_hours, round(budget, 1) AS stale_after_hours, status AS latest_run_status,
 s % 5 <> 4 AND (s_nationkey = 12 OR age IS NULL OR age > budget) AND s <> 1 AS is_problem FROM {_FRESH}""")
def freshness(spark, sf):
    s = "s_suppkey"
    reg = table(spark, sf, "supplier").select(
        F.concat(F.lit("src"), text(s)).alias("source_id"), F.expr(f"{s} % 3 * 24").alias("publication_cadence_hours"),
        F.lit(12).alias("max_schedule_gap_hours"), F.expr(f"CASE WHEN {s} % 5 = 4 THEN 'blocked' ELSE 'active' END").alias("deployment_status"), "s_nationkey")
    events = table(spark, sf, "events")
    sid = F.concat(F.lit("src"), text("user_id")).alias("source_id")
    runs = events.select(sid, F.col("ts").alias("run_ts"), F.lpad(text("event_id"), 12, "0").alias("run_file"), F.col("event_type").alias("status"))
    newest = F.when(F.col("user_id") % 11 > 0, text(F.to_date(F.col("newest"))))
    obs = events.groupBy("user_id").agg(F.max("ts").alias("newest")).select(sid, newest.alias("latest_observation"))
    held = reg.where("s_nationkey <> 12").select("source_id")
    out = quality.freshness(reg.drop("s_nationkey"), runs, obs, F.lit(_NOW).cast("timestamp"), held, {"src1": "dormant"})
    return out.select("source_id", "state", "latest_observation", "observation_age_hours", "stale_after_hours", "latest_run_status", "is_problem")


_LAG = """SELECT o_orderstatus, strftime(max(o_orderdate), '%Y-%m-%d') AS latest_date, date_diff('day', CAST(max(o_orderdate) AS DATE), DATE '2002-01-10') AS lag_days,
 date_diff('day', CAST(max(o_orderdate) AS DATE), DATE '2002-01-10') <= 10 AS ok FROM orders GROUP BY ALL"""


@query(_LAG)
def assert_lag(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderstatus", F.to_date("o_orderdate").alias("d"))
    df = quality.assert_lag(orders, "d", F.lit("2002-01-10").cast("date"), 10, ["o_orderstatus"])
    return df.select("o_orderstatus", text("latest_date").alias("latest_date"), F.col("lag_days").cast("bigint").alias("lag_days"), "ok")


@query(_LAG)
def assert_lag_from_footers(spark, sf):
    """A table partitioned by source: the newest day of each comes from file footers alone."""
    path = scratch_path(spark, "by_source")
    table(spark, sf, "orders").select("o_orderstatus", "o_orderkey", F.to_date("o_orderdate").alias("d")).write.partitionBy("o_orderstatus").parquet(path)
    df = quality.assert_lag(read_footers(spark, path), "d", F.lit("2002-01-10").cast("date"), 10, ["o_orderstatus"])
    return df.select("o_orderstatus", text("latest_date").alias("latest_date"), F.col("lag_days").cast("bigint").alias("lag_days"), "ok")


@query("""SELECT event_id, CASE WHEN fetched = 0 AND unavailable > 0 THEN 'source_unavailable' WHEN fetched = 0 AND skipped <> expected THEN 'error' WHEN new_items > 0 AND r = 0 THEN 'error'
 WHEN unavailable > 0 THEN 'partial' WHEN failures > 0 THEN 'ok_with_warnings' WHEN new_items = 0 THEN 'no_new' ELSE 'ok' END AS status FROM
 (SELECT event_id, 3 AS expected, event_id % 3 AS fetched, event_id % 4 AS skipped, event_id % 5 // 4 AS unavailable, event_id % 7 AS r, event_id % 2 AS new_items, event_id % 11 // 10 AS failures FROM events)""")
def classify_run(spark, sf):
    e = "event_id"
    runs = table(spark, sf, "events").select(e, F.lit(3).alias("expected"), *[F.expr(x).alias(n) for n, x in {
        "fetched": f"{e} % 3", "skipped": f"{e} % 4", "unavailable": f"{e} % 5 div 4", "rows": f"{e} % 7", "new_items": f"{e} % 2",
        "failures": f"{e} % 11 div 10"}.items()])
    return quality.classify_run(runs).select(e, "status")


_LICENCES = [("0", "open_attribution", "Source A"), ("1", "open_no_attribution", ""), ("2", "undeclared_review", None), ("3", "mixed_review", None)]


def _released(spark, sf):
    licences = local_table(spark, _LICENCES, "path string, reuse_status string, attribution string")
    rows = table(spark, sf, "orders").select("o_orderkey", text(F.col("o_custkey") % 5).alias("source"))
    return quality.release_view(rows, licences, "source")


@query("""SELECT o_orderkey, CAST(o_custkey % 5 AS VARCHAR) AS source, CASE o_custkey % 5 WHEN 0 THEN 'open_attribution' ELSE 'open_no_attribution' END AS reuse_status,
 CASE o_custkey % 5 WHEN 0 THEN 'Source A' ELSE '' END AS attribution FROM orders WHERE o_custkey % 5 < 2""")
def release_view(spark, sf):
    return _released(spark, sf)[0]


@query("""SELECT CAST(o_custkey % 5 AS VARCHAR) AS source, CASE o_custkey % 5 WHEN 2 THEN 'undeclared_review' WHEN 3 THEN 'mixed_review' END AS reuse_status, count(*) AS n FROM orders WHERE o_custkey % 5 > 1 GROUP BY ALL""")
def withheld_sources(spark, sf):
    return _released(spark, sf)[1]


@query("""WITH d AS (SELECT DISTINCT o_custkey % 20 AS series, CAST(o_orderdate AS DATE) AS d FROM orders), e AS (SELECT series, CAST(unnest(generate_series(min(d), max(d), INTERVAL 1 DAY)) AS DATE) AS d FROM d GROUP BY series)
 SELECT series, strftime(d, '%Y-%m-%d') AS date FROM e ANTI JOIN d USING (series, d)""")
def gaps(spark, sf):
    obs = table(spark, sf, "orders").select((F.col("o_custkey") % 20).alias("series"), "o_orderdate")
    return quality.gaps(obs, ["series"], "o_orderdate").withColumn("date", text("date"))
