"""Events are readings, users are reservoirs."""

from __future__ import annotations

from pyspark.sql import functions as F

from hydrolake.operators import ordered, select
from hydrolake.plans.registry import mean4, query, table, text
from hydrolake.session import scratch_path

DAY = "strftime(ts, '%Y-%m-%d')"


def readings(spark, sf):
    return table(spark, sf, "events").select(
        "event_id", "ts", "user_id", "event_type", "value", F.to_date("ts").alias("day"))


@query(f"""SELECT user_id, {DAY} AS day, arg_max(event_id, ts) AS event_id, arg_max(value, ts) AS value
 FROM events GROUP BY ALL""")
def latest_per_day(spark, sf):
    df = select.latest_per(readings(spark, sf), ["user_id", "day"], ["ts"], "event_id", ties="first")
    return df.select("user_id", text("day").alias("day"), "event_id", "value")


_TIES = """SELECT user_id, {d} AS day, event_id, event_type FROM events
 QUALIFY row_number() OVER (PARTITION BY user_id, {d} ORDER BY event_type DESC, event_id {o}) = 1"""


@query(_TIES.format(d=DAY, o="ASC"))
def latest_per_first_tie(spark, sf):
    df = select.latest_per(readings(spark, sf), ["user_id", "day"], ["event_type"], "event_id", ties="first")
    return df.select("user_id", text("day").alias("day"), "event_id", "event_type")


@query(_TIES.format(d=DAY, o="DESC"))
def latest_per_last_tie(spark, sf):
    df = select.latest_per(readings(spark, sf), ["user_id", "day"], ["event_type"], "event_id", ties="last")
    return df.select("user_id", text("day").alias("day"), "event_id", "event_type")


@query("SELECT min(doc_id) AS doc_id, lang, md5(text) AS digest, arg_min(source, doc_id) AS source FROM documents GROUP BY lang, text")
def dedup_first(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "lang", F.md5("text").alias("digest"), "source")
    return select.dedup_first(docs, ["lang", "digest"], ["doc_id"])


@query(f"""SELECT event_type, day, n FROM (SELECT event_type, {DAY} AS day, count(*) AS n FROM events GROUP BY ALL)
 QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY n DESC, day DESC) = 1""")
def modal_day(spark, sf):
    df = select.modal(readings(spark, sf), "day", ["event_type"])
    return df.select("event_type", text("day").alias("day"), "n")


# one slot of each reservoir moves onto its neighbour and leaves a hole
_SLOT = "CASE WHEN o_orderkey % 982 IN (102, 593) THEN 103 ELSE o_orderkey % 491 END"


def quarter_hours(spark, sf):
    """Quarter-hour points spread from the orders: each gives one local slot of
    one of four reservoirs, with repeats, so some days fill up and others do not."""
    return table(spark, sf, "orders").select(
        (F.col("o_orderkey") % 2).alias("reservoir"),
        F.timestamp_seconds(F.lit(1774652400) + F.expr(_SLOT) * 900).alias("ts"),
        (F.col("o_custkey") % 1000).cast("double").alias("value"), "o_orderkey")


# 2026-03-27 23:00 UTC is local midnight; 491 quarter hours span five local days and a bit,
# among them 2026-03-29 with 23 hours (zone +1 before 2026-03-29 01:00 UTC, +2 after)
QUARTERS_SQL = "(SELECT o_orderkey % 2 AS reservoir, 1774652400 + (" + _SLOT + """) * 900 AS s,
 arg_max(CAST(o_custkey % 1000 AS DOUBLE), o_orderkey) AS value FROM orders GROUP BY ALL)"""
_LOCAL = "(s + CASE WHEN s < 1774746000 THEN 3600 ELSE 7200 END)"
_DAYS = f"""(SELECT reservoir, strftime(make_timestamp(({_LOCAL}) * 1000000), '%Y-%m-%d') AS date, count(*) AS n, avg(value) AS mean_value,
 min({_LOCAL} % 86400) AS first_s, max({_LOCAL} % 86400) AS last_s FROM {QUARTERS_SQL} GROUP BY ALL)"""


@query(f"""SELECT reservoir, date, n, round(mean_value + 3e-9, 4) AS mean_value, CAST(CASE WHEN date = '2026-03-29' THEN 92 ELSE 96 END AS BIGINT) AS expected FROM {_DAYS}
 WHERE n = CASE WHEN date = '2026-03-29' THEN 92 ELSE 96 END AND first_s = 0 AND last_s = 85500""")
def complete_day_mean(spark, sf):
    df = select.complete_day_mean(quarter_hours(spark, sf), ["reservoir"], "ts", "value", "o_orderkey", "Europe/Luxembourg")
    return df.select("reservoir", text("date").alias("date"), "n", mean4("mean_value").alias("mean_value"), "expected")


@query("""SELECT CASE WHEN coalesce(event_id % 4 <> 1, true) THEN 'excluded_simulated_or_unknown' WHEN event_id % 7 = 0 THEN 'excluded_malformed' ELSE 'accepted' END AS reason,
 count(*) AS n FROM events GROUP BY ALL""")
def reject_counts(spark, sf):
    return select.reject_counts(_points(spark, sf), select.point_reason("simulated", "ts", "value"))


def _points(spark, sf):
    return table(spark, sf, "events").select(
        "event_id", F.expr("CASE event_id % 4 WHEN 1 THEN false WHEN 2 THEN true END").alias("simulated"), "ts",
        F.expr("CASE WHEN event_id % 7 > 0 THEN value END").alias("value"))


@query("""SELECT reason, n, (SELECT count(*) FROM events WHERE event_id % 4 = 1 AND event_id % 7 > 0) AS n_written FROM (
 SELECT unnest(['accepted', 'excluded_malformed', 'excluded_simulated_or_unknown', 'other']) AS reason,
 unnest([count(*) FILTER (event_id % 4 = 1 AND event_id % 7 > 0), count(*) FILTER (event_id % 4 = 1 AND event_id % 7 = 0), count(*) FILTER (coalesce(event_id % 4 <> 1, true)), 0]) AS n FROM events)""")
def reject_counts_observed(spark, sf):
    """Accepted points are written; the counts of all reasons come with that write."""
    reason = select.point_reason("simulated", "ts", "value")
    kept, seen = select.observed_counts(_points(spark, sf), reason, ["excluded_simulated_or_unknown", "excluded_malformed", "accepted"], reason == "accepted")
    path = scratch_path(spark, "accepted")
    kept.write.parquet(path)
    written = spark.read.parquet(path).agg(F.count(F.lit(1)).alias("n_written"))
    pairs = F.array(*[F.struct(F.lit(k).alias("reason"), F.lit(n).cast("bigint").alias("n")) for k, n in seen.get.items()])
    return written.select(F.inline(pairs), "n_written")


@query("""SELECT o_custkey, strftime(min(o_orderdate), '%Y-%m-%d') AS period_start, strftime(max(o_orderdate), '%Y-%m-%d') AS period_end,
 count(*) AS n FROM orders GROUP BY o_custkey""")
def period_of_record(spark, sf):
    df = select.period_of_record(table(spark, sf, "orders").withColumn("d", F.to_date("o_orderdate")), ["o_custkey"], "d")
    return df.select("o_custkey", text("period_start").alias("period_start"), text("period_end").alias("period_end"), "n")


@query("""SELECT count(*) AS n_rows, count(DISTINCT o_custkey) AS n_reservoirs, count(DISTINCT o_orderdate) AS n_dates,
 CAST(count(*) FILTER (o_orderstatus = 'F') AS BIGINT) AS n_large, CAST(count(*) FILTER (o_orderstatus <> 'F') AS BIGINT) AS n_other FROM orders""")
def run_totals(spark, sf):
    return select.run_totals(table(spark, sf, "orders"), "o_custkey", "o_orderdate", "o_orderstatus", "F")


_GOOD = {"time": "CASE WHEN l_linenumber % 5 = 0 THEN 'x' ELSE '03-26 08:00' END", "a": "l_returnflag",
         "b": "CASE WHEN l_suppkey % 3 = 0 THEN ' ' ELSE 'B' END", "c": "l_linestatus",
         "d": "CASE WHEN l_suppkey % 2 = 0 THEN '' ELSE 'D' END",
         "level": "CASE WHEN l_partkey % 4 = 0 THEN '--' ELSE CAST(l_partkey AS STRING) END",
         "change": "CASE WHEN l_partkey % 8 = 0 THEN '0.5' ELSE '' END"}
_SCORES = """(SELECT l_suppkey % 50 AS screen, l_orderkey % 3 AS attempt, avg(CASE WHEN l_linenumber % 5 > 0 AND NOT (l_suppkey % 3 = 0 AND l_suppkey % 2 = 0)
 AND (l_partkey % 4 <> 0 OR l_partkey % 8 = 0) THEN 1.0 ELSE 0.0 END) AS quality, count(*) AS n_rows FROM lineitem GROUP BY ALL)"""


def _scores(spark, sf):
    rows = table(spark, sf, "lineitem").select(
        (F.col("l_suppkey") % 50).alias("screen"), (F.col("l_orderkey") % 3).alias("attempt"),
        *[F.expr(e).alias(n) for n, e in _GOOD.items()])
    return select.quality_score(rows, ["screen", "attempt"], "time", ["a", "b", "c", "d"], ["level", "change"])


@query(f"SELECT screen, attempt, round(quality + 3e-9, 4) AS quality, n_rows FROM {_SCORES}")
def quality_score(spark, sf):
    return _scores(spark, sf).withColumn("quality", mean4("quality"))


@query(f"""SELECT screen, attempt, round(quality + 3e-9, 4) AS quality, n_rows FROM {_SCORES}
 QUALIFY row_number() OVER (PARTITION BY screen ORDER BY round(quality + 3e-9, 4) DESC, n_rows DESC, attempt) = 1""")
def best_attempt(spark, sf):
    scores = _scores(spark, sf).withColumn("quality", mean4("quality"))
    return select.best_attempt(scores, ["screen"], "attempt", ["quality", "n_rows"])


@query("SELECT DISTINCT o_custkey FROM orders WHERE o_orderkey % 13 = 0")
def unresolved_ids(spark, sf):
    name = F.expr("CASE WHEN o_orderkey % 13 = 0 THEN '  ' ELSE o_orderpriority END")
    return select.unresolved_ids(table(spark, sf, "orders"), "o_custkey", name)


@query(r"""SELECT lang, ch, count(*) AS n FROM (SELECT lang, unnest(string_split(regexp_replace(text, '[\x00-\x7f]', '', 'g'), '')) AS ch FROM documents)
 WHERE ch <> '' GROUP BY ALL""")
def char_counts(spark, sf):
    return select.char_counts(table(spark, sf, "documents"), "text", r"\x{80}-\x{10FFFF}", ["lang"])


@query(f"SELECT event_type, max({DAY}) AS latest_observation FROM events GROUP BY event_type")
def newest_observation(spark, sf):
    df = table(spark, sf, "events").select(
        "event_type", F.date_format("ts", "yyyyMMdd HH:mm").alias("obs_date"),
        F.date_format("ts", "yyyy-MM-dd'T'HH").alias("reading_time"),
        F.lit("2099-01-01").alias("fetched_at"), F.lit("2098-01-01").alias("last_updated"))
    return select.newest_observation(df, "event_type")


@query("""SELECT user_id, string_agg(event_type, ',' ORDER BY event_id) AS statuses, arg_max(event_type, event_id) AS latest_status
 FROM (SELECT * FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) <= 10) GROUP BY user_id""")
def recent_runs(spark, sf):
    df = select.recent_runs(table(spark, sf, "events"), ["user_id"], ["event_id"], "event_type")
    return df.select("user_id", F.array_join("recent_statuses", ",").alias("statuses"), "latest_status")


@query("SELECT o_custkey, strftime(o_orderdate, '%Y-%m-%d') AS d, o_orderkey FROM orders ORDER BY ALL")
def canonical_sort(spark, sf):
    df = table(spark, sf, "orders").select("o_custkey", text(F.to_date("o_orderdate")).alias("d"), "o_orderkey")
    return select.canonical_sort(df, ["o_custkey", "d", "o_orderkey"])


@query("SELECT doc_id, n_chars FROM documents ORDER BY n_chars, doc_id LIMIT 40")
def cap_per_run(spark, sf):
    return select.cap(table(spark, sf, "documents").select("doc_id", "n_chars"), 40, ["n_chars", "doc_id"])


@query(f"SELECT event_id, {DAY} AS day FROM events WHERE {DAY} IN (SELECT DISTINCT {DAY} AS d FROM events ORDER BY d DESC LIMIT 18)")
def latest_files(spark, sf):
    df = readings(spark, sf).select("event_id", text("day").alias("day"))
    return select.latest_files(df, "day", 18)


# ---- order-dependent columns

@query("""SELECT event_id, user_id, CAST(floor((epoch_us(ts) - epoch_us(p)) / 1000000) AS DOUBLE) AS seconds,
 coalesce(floor((epoch_us(ts) - epoch_us(p)) / 1000000) = 900, false) AS is_regular
 FROM (SELECT *, lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS p FROM events)""")
def intervals(spark, sf):
    df = ordered.intervals(readings(spark, sf), ["user_id"], "ts", 900, "event_id")
    return df.select("event_id", "user_id", F.col("interval_seconds").cast("double").alias("seconds"),
                     F.coalesce("is_regular", F.lit(False)).alias("is_regular"))


@query("""WITH c AS (SELECT event_id, user_id, ts, CAST(floor(value) AS INT) % 40 - 5 AS n FROM events),
 p AS (SELECT user_id, event_id, n, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS k, ts FROM c),
 q AS (SELECT *, count(*) FILTER (n > 0) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM p),
 pos AS (SELECT user_id, n, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS i FROM p WHERE n > 0)
 SELECT q.event_id, CASE WHEN q.before = 0 THEN 18 ELSE least(24, greatest(14, CAST(round_even((SELECT median(pos.n) FROM pos WHERE pos.user_id = q.user_id AND pos.i BETWEEN q.before - 5 AND q.before) * 0.75, 0) AS INT))) END AS threshold
 FROM q""")
def dynamic_threshold(spark, sf):
    df = readings(spark, sf).withColumn("n", F.floor("value").cast("int") % 40 - 5)
    return ordered.dynamic_threshold(df, ["user_id"], ["ts", "event_id"], "n", F.col("day")).select("event_id", "threshold")


@query("""SELECT l_orderkey, l_partkey, l_linenumber, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) - 1 AS row_order FROM lineitem""")
def row_order(spark, sf):
    df = ordered.row_order(table(spark, sf, "lineitem"), ["l_orderkey"], ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"])
    return df.select("l_orderkey", "l_partkey", "l_linenumber", F.col("row_order").cast("bigint").alias("row_order"))


@query("""SELECT user_id, strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS start, strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS "end", count(*) AS length FROM
 (SELECT *, sum(CASE WHEN event_type IN ('error', 'signup') THEN 0 ELSE 1 END) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS island FROM events)
 WHERE event_type IN ('error', 'signup') GROUP BY user_id, island""")
def streaks(spark, sf):
    df = ordered.streaks(readings(spark, sf), ["user_id"], ["ts", "event_id"],
                         F.col("event_type").isin("error", "signup"), F.col("day"))
    stamp = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c)
    return df.select("user_id", stamp("start"), stamp("end"), "length")


@query("""SELECT o_orderkey, strftime(d, '%Y-%m-%d') AS date, value, kind AS reading_kind FROM (
 SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d, CAST(o_custkey AS DOUBLE) AS value, 'current' AS kind FROM orders
 UNION ALL SELECT o_orderkey, CAST(o_orderdate AS DATE) - 7, CAST(o_custkey AS DOUBLE) / 2, 'previous_week' FROM orders WHERE o_orderkey % 3 > 0)""")
def with_previous_week(spark, sf):
    df = table(spark, sf, "orders").select(
        "o_orderkey", F.to_date("o_orderdate").alias("date"), F.col("o_custkey").cast("double").alias("now"),
        F.expr("CASE WHEN o_orderkey % 3 > 0 THEN CAST(o_custkey AS DOUBLE) / 2 END").alias("before"))
    return ordered.with_previous_week(df, "date", "now", "before").withColumn("date", text("date"))
