"""Events as a stream of landed files, drained and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from hydrolake import streaming
from hydrolake.operators import archive
from hydrolake.plans.registry import mean4, query, table, text
from hydrolake.session import scratch_path


def landed(spark, sf, copies: int = 1):
    """The events table as a file stream; with copies, a re-fetched overlap."""
    schema = spark.read.parquet(f"{sf}/events.parquet").schema
    df = streaming.ingest_stream(spark, sf, schema, glob="events.parquet", max_files=40)
    if copies > 1:
        df = df.withColumn("fetch", F.explode(F.sequence(F.lit(1), F.lit(copies))))
    return df.withColumn("ts", F.col("ts").cast("timestamp"))


@query("SELECT event_id, user_id, event_type, value FROM events")
def ingest_stream(spark, sf):
    out = scratch_path(spark, "ingest")
    streaming.drain(landed(spark, sf).select("event_id", "user_id", "event_type", "value"), f"{out}/table", f"{out}/checkpoint")
    return spark.read.parquet(f"{out}/table")


@query("SELECT user_id, event_id FROM events")
def dedup_stream(spark, sf):
    out = scratch_path(spark, "dedup")
    once = streaming.dedup_stream(landed(spark, sf, copies=2), ["user_id", "event_id"], "ts", "45 days")
    streaming.drain(once.select("user_id", "event_id"), f"{out}/table", f"{out}/checkpoint")
    return spark.read.parquet(f"{out}/table")


@query("""SELECT event_type, strftime(ts + INTERVAL 8 HOUR, '%Y-%m-%d') AS date, count(*) AS n, round(avg(value) + 3e-9, 4) AS mean_value, CAST(24 AS BIGINT) AS expected, count(*) = 24 AS is_complete FROM events GROUP BY 1, 2""")
def daily_stream(spark, sf):
    out = scratch_path(spark, "daily_stream")
    days = streaming.daily_stream(landed(spark, sf), ["event_type"], "ts", "value", "Asia/Shanghai", "2 days", 3600)
    streaming.drain(days, f"{out}/table", f"{out}/checkpoint", mode="complete")
    return spark.read.parquet(f"{out}/table").select(
        "event_type", text("date").alias("date"), "n", mean4("mean_value").alias("mean_value"), "expected", "is_complete")


_ARCHIVE = "user_id bigint, event_id bigint, value double, fetched_at string, date string"


def _two_passes(spark, sf, window_days=None):
    """The first pass lands altered values for even users, the second revises them; odd users come
    again unchanged and keep their first fetch time. The archive's folder and the late rows'."""
    out = scratch_path(spark, "upsert_stream")
    rows = landed(spark, sf).select("user_id", text(F.to_date("ts")).alias("date"), "event_id", "value")
    first = rows.withColumn("value", F.expr("CASE WHEN user_id % 2 = 0 THEN value + 1 ELSE value END")).withColumn("fetched_at", F.lit("first"))
    second = rows.withColumn("fetched_at", F.lit("second"))
    for name, df in (("a", first), ("b", second)):
        streaming.upsert_stream(df, f"{out}/table", ["user_id", "date"], "date", ["event_id"], f"{out}/checkpoint_{name}", ["fetched_at"],
                                window_days, lambda late, n: late.write.mode("overwrite").parquet(f"{out}/late/{n}")).awaitTermination()
    return f"{out}/table", f"{out}/late/*"


_LAST = "e AS (SELECT user_id, strftime(ts, '%Y-%m-%d') AS date, arg_max(event_id, event_id) AS event_id, arg_max(value, event_id) AS value FROM events GROUP BY 1, 2)"


@query(f"""WITH {_LAST}
 SELECT user_id, date, event_id, value, 'second' AS fetched_at FROM e WHERE user_id % 2 = 0 UNION ALL SELECT user_id, date, event_id, value, 'first' FROM e WHERE user_id % 2 = 1""")
def upsert_stream(spark, sf):
    return archive.read_archive(spark, _two_passes(spark, sf)[0], _ARCHIVE)


@query(f"""WITH {_LAST}, w AS (SELECT *, date < strftime(CAST((SELECT max(date) FROM e) AS DATE) - 10, '%Y-%m-%d') AS old FROM e)
 SELECT user_id, date, event_id, CASE WHEN user_id % 2 = 0 AND old THEN value + 1 ELSE value END AS value, CASE WHEN user_id % 2 = 0 AND NOT old THEN 'second' ELSE 'first' END AS fetched_at, 'held' AS kind FROM w
 UNION ALL SELECT user_id, date, event_id, value, 'second', 'revised' FROM w WHERE user_id % 2 = 0 AND old""")
def upsert_window(spark, sf):
    """Revisions older than ten days before the newest day are reported, not merged."""
    path, late = _two_passes(spark, sf, window_days=10)
    held = archive.read_archive(spark, path, _ARCHIVE).withColumn("kind", F.lit("held"))
    return held.unionByName(spark.read.schema(_ARCHIVE + ", kind string").parquet(late))


def _monitor(spark, sf):
    sid = F.concat(F.lit("src"), text("user_id")).alias("source_id")
    registry = table(spark, sf, "supplier").select(
        F.concat(F.lit("src"), text("s_suppkey")).alias("source_id"), F.lit(24).alias("publication_cadence_hours"),
        F.lit(12).alias("max_schedule_gap_hours"), F.lit("active").alias("deployment_status"))

    def runs_of(df):
        return df.select(sid, F.col("ts").alias("run_ts"), F.lpad(text("event_id"), 12, "0").alias("run_file"), F.col("event_type").alias("status"))

    def observations_of(df):
        return df.groupBy("user_id").agg(text(F.to_date(F.max("ts"))).alias("latest_observation")).select(sid, "latest_observation")

    return registry, runs_of, observations_of


def _states(day):
    return f"""SELECT concat('src', s_suppkey) AS source_id, CASE WHEN d IS NULL THEN 'no_observation_date' WHEN date_diff('day', d, DATE '{day}') * 24 > 84 THEN 'stale' ELSE 'fresh' END AS state
 FROM supplier LEFT JOIN (SELECT user_id, CAST(max(ts) AS DATE) AS d FROM events GROUP BY 1) ON user_id = s_suppkey"""


@query(_states("2024-02-01"))
def freshness_stream(spark, sf):
    out = scratch_path(spark, "freshness")
    registry, runs_of, observations_of = _monitor(spark, sf)
    streaming.freshness_stream(
        landed(spark, sf), registry, F.lit("2024-02-01").cast("timestamp"), runs_of, observations_of,
        lambda report, n: report.select("source_id", "state").write.mode("overwrite").parquet(f"{out}/report"),
        f"{out}/seen", f"{out}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{out}/report")


@query(f"SELECT 1 AS run, * FROM ({_states('2024-02-01')}) UNION ALL SELECT 2 AS run, * FROM ({_states('2024-02-04')})")
def freshness_silent(spark, sf):
    """Two scheduled runs three days apart; nothing lands between them, yet the second reports."""
    out = scratch_path(spark, "silent")
    registry, runs_of, observations_of = _monitor(spark, sf)
    for run, day in enumerate(("2024-02-01", "2024-02-04"), 1):
        streaming.FreshnessMonitor(
            registry, F.lit(day).cast("timestamp"), runs_of, observations_of,
            lambda report, n, run=run: report.select("source_id", "state").write.mode("overwrite").parquet(f"{out}/report/run={run}"),
            f"{out}/seen").drain(landed(spark, sf), f"{out}/checkpoint")
    return spark.read.parquet(f"{out}/report")
