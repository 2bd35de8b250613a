"""Operators chained as a user would run them, from payloads to the archive and on."""

from __future__ import annotations

from pyspark.sql import functions as F

from hydrolake import functions as P
from hydrolake.functions import fixed
from hydrolake.operators import extract_glyphs, extract_json, filters, joins, merge, quality, reshape, select
from hydrolake.plans.glyph_queries import _DIGITS, _LETTERS, _PUA, _RARE
from hydrolake.plans.registry import mean4, query, table, text
from hydrolake.session import local_table

_DAY = "strftime(ts, '%Y-%m-%d')"
_LATEST = f"(SELECT user_id, {_DAY} AS day, arg_max(value, ts) AS value, arg_max(event_id, ts) AS event_id FROM events GROUP BY 1, 2)"
_ARCHIVE = f"""(SELECT user_id, day, CASE WHEN event_id % 7 = 0 THEN value + 1 ELSE value END AS value FROM {_LATEST} WHERE value >= 20)"""


@query(f"""SELECT user_id, min(day) AS period_start, max(day) AS period_end, count(*) AS n, count(*) FILTER (a = 'added') AS added, count(*) FILTER (a = 'updated') AS updated FROM
 (SELECT user_id, day, CASE WHEN o.value IS NULL THEN 'added' WHEN o.value <> n.value THEN 'updated' ELSE 'unchanged' END AS a FROM {_LATEST} n LEFT JOIN {_ARCHIVE} o USING (user_id, day)) GROUP BY user_id""")
def archive_update(spark, sf):
    """Latest reading per reservoir and day, merged into an archive that lacks some
    days and holds others in an older version: period and changes per reservoir."""
    events = table(spark, sf, "events").select("user_id", "event_id", "ts", "value", F.to_date("ts").alias("day"))
    latest = select.latest_per(events, ["user_id", "day"], ["ts"], "event_id")
    archive = latest.where("value >= 20").select(
        "user_id", "day", F.expr("CASE WHEN event_id % 7 = 0 THEN value + 1 ELSE value END").alias("value"), F.lit("run1").alias("fetched_at"))
    batch = latest.select("user_id", "day", "value", F.lit("run2").alias("fetched_at"))
    merged = merge.upsert(archive, batch, ["user_id", "day"], ["fetched_at"]).rows
    return merged.groupBy("user_id").agg(
        text(F.min("day")).alias("period_start"), text(F.max("day")).alias("period_end"), F.count(F.lit(1)).alias("n"),
        *[F.count(F.when(F.col("merge_action") == a, 1)).alias(a) for a in ("added", "updated")])


@query("""SELECT user_id, day, round(avg(v) + 3e-9, 4) AS mean_value, count(*) AS n FROM (SELECT user_id, strftime(make_timestamp(s * 1000000), '%Y-%m-%d') AS day, s, arg_max(v, event_id) AS v FROM
 (SELECT user_id % 5 AS user_id, epoch_us(ts) // 1000000 // 3600 * 3600 AS s, value AS v, event_id FROM events WHERE event_id % 10 > 0) GROUP BY user_id, s)
 GROUP BY user_id, day HAVING count(*) = 24""")
def trusted_daily_values(spark, sf):
    """Measured points of a rolling window to means of complete days only."""
    points = table(spark, sf, "events").select(
        (F.col("user_id") % 5).alias("user_id"), "event_id", F.expr("CASE WHEN event_id % 10 > 0 THEN false ELSE true END").alias("simulated"),
        F.date_trunc("hour", "ts").alias("ts"), "value")
    measured = filters.keep_explicit_false(points, "simulated")
    days = select.complete_day_mean(measured, ["user_id"], "ts", "value", "event_id", "UTC", 3600)
    return days.select("user_id", text("date").alias("day"), mean4("mean_value").alias("mean_value"), "n")


@query("""WITH basic AS (SELECT user_id AS id, concat('B', user_id) AS name FROM events WHERE event_type NOT IN ('view', 'click') GROUP BY 1),
 daily AS (SELECT user_id AS id, arg_max(CAST(json_extract_string(props, '$.k') AS DOUBLE), event_id) AS storage FROM events WHERE event_type = 'view' OR (event_type = 'click' AND ts < TIMESTAMP '2024-01-30') GROUP BY 1),
 live AS (SELECT user_id AS id, arg_max(CAST(json_extract_string(props, '$.k') AS DOUBLE), event_id) AS storage FROM events WHERE event_type = 'click' AND ts >= TIMESTAMP '2024-01-30' GROUP BY 1)
 SELECT id, coalesce(name, '') AS name, coalesce(live.storage, daily.storage) AS storage FROM (SELECT id FROM basic UNION SELECT id FROM daily UNION SELECT id FROM live) LEFT JOIN basic USING (id) LEFT JOIN daily USING (id) LEFT JOIN live USING (id)""")
def feeds_to_snapshot(spark, sf):
    """JSON feeds of one day, each with its own spelling, to one snapshot row per id."""
    events = table(spark, sf, "events")
    value = P.num_thousands(extract_json.pick("props", "K", "k"))
    rows = events.select(F.col("user_id").alias("id"), "event_id", "event_type", "ts", value.alias("storage"))

    recent = "event_type = 'click' AND ts >= TIMESTAMP '2024-01-30'"

    def feed(which):
        return select.latest_per(rows.where(which), ["id"], ["event_id"], "event_id").select("id", "storage")

    basic = rows.where("event_type NOT IN ('view', 'click')").select("id", F.concat(F.lit("B"), text("id")).alias("name")).distinct()
    snapshot = joins.coalesce_feeds({"basic": basic, "daily": feed(f"event_type IN ('view', 'click') AND NOT ({recent})"), "live": feed(recent)}, ["id"],
                                    {"name": [("basic", "name")], "storage": [("live", "storage"), ("daily", "storage")]})
    return snapshot.withColumn("name", P.best_name("name"))


@query(f"""SELECT p_partkey, p_name AS name, CAST(p_size AS DOUBLE) AS level, CASE WHEN p_partkey % 12 + 1 > 6 THEN '2025-' ELSE '2026-' END || lpad(CAST(p_partkey % 12 + 1 AS VARCHAR), 2, '0') || '-05' AS date FROM part""")
def decoded_snapshot(spark, sf):
    """Scrambled snapshot: digits inferred, letters learned from history, rows decoded, dates resolved."""
    part = table(spark, sf, "part").withColumn("run", F.lit(1))
    scrambled = part.select("run", "p_partkey", "p_name", F.concat(F.lit("#f#"), text("p_size")).alias("plain"),
                            F.translate("p_name", _LETTERS, _RARE).alias("enc"),
                            F.concat(F.lit("#f1otltag"), F.translate(text("p_size"), _DIGITS, _PUA), F.lit("#FontTag")).alias("rz"),
                            F.concat(F.lpad(text(F.col("p_partkey") % 12 + 1), 2, "0"), F.lit("-05")).alias("tm"))
    digits = extract_glyphs.infer_digits(scrambled, ["run"], ["rz"])
    letters = extract_glyphs.train_glyphs(scrambled, ["run"], "enc", "p_name", ["p_partkey"], digits)
    maps = digits.select("run", "glyph", F.col("digit").alias("ch")).unionByName(letters.select("run", "glyph", "ch"))
    # blanks inside tagged text vanish when decoding, so names are decoded word by word
    tagged = scrambled.withColumn("first", F.concat(F.lit("#f1otltag"), F.split("enc", " ")[0], F.lit("#FontTag"))) \
        .withColumn("second", F.concat(F.lit("#f1otltag"), F.split("enc", " ")[1], F.lit("#FontTag")))
    out = extract_glyphs.decode_glyphs(tagged, maps, ["run"], ["rz", "first", "second"])
    date = P.resolve_year("tm", F.lit("2026-06-15").cast("date"), 7, "MM-dd")
    return out.select("p_partkey", F.concat_ws(" ", "first", "second").alias("name"), P.num_thousands("rz").alias("level"), text(date).alias("date"))


_VARS = [("1", "level (water level, m)", "water_level_m", 1.0), ("1", "storage (TMC)", "storage_mcm", fixed.UNIT_FACTORS["TMC"]),
         ("0", "level (water level, m)", "water_level_m", 1.0), ("2", "storage (TMC)", "storage_mcm", fixed.UNIT_FACTORS["TMC"])]


@query("""SELECT country, variable, strftime(d, '%Y-%m-%d') AS month, count(*) AS n, round(sum(v), 2) AS total FROM (
 SELECT CAST(l_suppkey % 3 AS VARCHAR) AS country, CAST(date_trunc('month', l_shipdate) AS DATE) AS d, 'water_level_m' AS variable, l_quantity AS v FROM lineitem WHERE l_suppkey % 3 < 2
 UNION ALL SELECT CAST(l_suppkey % 3 AS VARCHAR), CAST(date_trunc('month', l_shipdate) AS DATE), 'storage_mcm', l_linenumber * 28.316846592 FROM lineitem WHERE l_suppkey % 3 > 0)
 WHERE country <> '2' GROUP BY ALL""")
def global_series(spark, sf):
    """Wide snapshots to one global series: melted, converted, gated by licence, monthly."""
    wide = table(spark, sf, "lineitem").select(
        text(F.col("l_suppkey") % 3).alias("country"), P.pad_month("l_shipdate").alias("date"),
        F.col("l_quantity").alias("level (water level, m)"), F.col("l_linenumber").cast("double").alias("storage (TMC)"))
    long = reshape.to_long(wide, ["country", "date"])
    variables = local_table(spark, _VARS, "country string, variable_original string, standard_variable string, unit_factor double")
    rows, _ = reshape.normalise(long, variables)
    licences = local_table(spark, [("0", "open_attribution", "A"), ("1", "open_no_attribution", ""), ("2", "prohibited", None)],
                           "path string, reuse_status string, attribution string")
    open_rows, _ = quality.release_view(rows, licences, "country")
    return open_rows.groupBy("country", F.col("standard_variable").alias("variable"), text("date").alias("month")).agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 2).alias("total"))
