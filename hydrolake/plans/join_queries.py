"""Feeds, names, overrides, periods."""

from __future__ import annotations

from pyspark.sql import functions as F

from hydrolake import functions as P
from hydrolake.operators import joins
from hydrolake.plans.registry import query, table, text
from hydrolake.session import local_table


# rows that must not meet the other side keep their place under a negative key
_BASIC_ID = "CASE WHEN c_mktsegment = 'BUILDING' THEN -c_custkey ELSE c_custkey END"
_DAILY_ID = "CASE WHEN o_orderstatus = 'F' THEN o_custkey ELSE -o_custkey END"
_HELD_ID = "CASE WHEN l_linenumber > 2 THEN l_orderkey ELSE -l_orderkey END"


@query(f"""WITH basic AS (SELECT {_BASIC_ID} AS id, c_name AS name, CAST(NULL AS DOUBLE) AS level FROM customer),
 daily AS (SELECT {_DAILY_ID} AS id, max(o_totalprice) AS level, CASE WHEN id % 5 = 0 THEN 'D' END AS name FROM orders GROUP BY ALL),
 live AS (SELECT s_suppkey AS id, CASE WHEN s_suppkey % 3 = 0 THEN 0.0 END AS level FROM supplier WHERE s_nationkey > 3),
 ids AS (SELECT id FROM basic UNION SELECT id FROM daily UNION SELECT id FROM live)
 SELECT ids.id, coalesce(daily.name, basic.name) AS name, coalesce(live.level, daily.level, basic.level) AS level
 FROM ids LEFT JOIN basic USING (id) LEFT JOIN daily USING (id) LEFT JOIN live USING (id)""")
def coalesce_feeds(spark, sf):
    basic = table(spark, sf, "customer").select(
        F.expr(_BASIC_ID).alias("id"), F.col("c_name").alias("name"), F.lit(None).cast("double").alias("level"))
    daily = (table(spark, sf, "orders").groupBy(F.expr(_DAILY_ID).alias("id"))
             .agg(F.max("o_totalprice").alias("level")).withColumn("name", F.expr("CASE WHEN id % 5 = 0 THEN 'D' END")))
    live = table(spark, sf, "supplier").select(
        "s_nationkey", F.col("s_suppkey").alias("id"), F.expr("CASE WHEN s_suppkey % 3 = 0 THEN 0.0D END").alias("level"))
    return joins.coalesce_feeds(
        {"basic": basic, "daily": daily, "live": live}, ["id"],
        {"name": [("daily", "name"), ("basic", "name")],
         "level": [("live", "level"), ("daily", "level"), ("basic", "level")]},
        only_when={"live": F.col("s_nationkey") > 3})


@query("""SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN c_mktsegment WHEN c_custkey % 4 > 0 THEN c_name ELSE '' END AS best FROM customer""")
def best_name(spark, sf):
    return table(spark, sf, "customer").select("c_custkey", P.best_name(
        F.lit(None).cast("string"), F.expr("CASE WHEN c_custkey % 3 = 0 THEN c_mktsegment ELSE '' END"),
        F.expr("CASE WHEN c_custkey % 4 > 0 THEN c_name END")).alias("best"))


_LEFT = "(SELECT p_partkey, p_name, concat(upper(p_brand), ' Dám') AS name, CASE WHEN p_partkey % 4 > 0 THEN p_size END AS reading FROM part)"
_STATIONS = "(SELECT DISTINCT lower(p_brand) AS k, concat('ST_', p_brand) AS station FROM part WHERE length(p_brand) = 8)"
_MATCH = f"(SELECT l.*, r.station, CASE WHEN r.k IS NULL THEN 'unmatched' WHEN reading IS NULL THEN 'missing_at_date' END AS state FROM {_LEFT} l LEFT JOIN {_STATIONS} r ON replace(lower(l.name), ' dám', '') = r.k)"


def _match(spark, sf):
    part = table(spark, sf, "part")
    left = part.select("p_partkey", F.concat(F.upper("p_brand"), F.lit(" Dám")).alias("name"),
                       F.expr("CASE WHEN p_partkey % 4 > 0 THEN p_size END").alias("reading"))
    right = part.where("length(p_brand) = 8").select(
        F.concat(F.lit("Reservoir "), F.lower("p_brand")).alias("reservoir"),
        F.concat(F.lit("ST_"), "p_brand").alias("station")).distinct()
    return joins.match_join(left, right, "name", "reservoir", "station", "reading", "p_partkey")


@query(f"SELECT p_partkey, reading, station FROM {_MATCH} WHERE state IS NULL QUALIFY row_number() OVER (PARTITION BY station ORDER BY p_partkey) = 1".replace("Dám", "Dám"))
def match_join(spark, sf):
    return _match(spark, sf)[0].select("p_partkey", "reading", "station")


@query(f"""SELECT kind, name, count(*) AS n FROM (SELECT coalesce(state, 'duplicate_station') AS kind, name,
 row_number() OVER (PARTITION BY state, station ORDER BY p_partkey) AS rn, state FROM {_MATCH}) WHERE state IS NOT NULL OR rn > 1 GROUP BY ALL""")
def match_report(spark, sf):
    return _match(spark, sf)[1].groupBy("kind", "name").agg(F.count(F.lit(1)).alias("n"))


@query("""SELECT c_custkey, CASE WHEN c_mktsegment = 'MACHINERY' THEN concat('OV ', c_custkey) ELSE c_name END AS c_name,
 CASE WHEN c_mktsegment = 'MACHINERY' AND c_custkey % 2 = 0 THEN 'SEG' ELSE c_mktsegment END AS c_mktsegment FROM customer""")
def apply_overrides(spark, sf):
    customer = table(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment")
    overrides = customer.where("c_mktsegment = 'MACHINERY'").select(
        "c_custkey", F.concat(F.lit("OV "), text("c_custkey")).alias("c_name"),
        F.expr("CASE WHEN c_custkey % 2 = 0 THEN 'SEG' ELSE '' END").alias("c_mktsegment"))
    return joins.apply_overrides(customer, overrides, "c_custkey", ["c_name", "c_mktsegment"])


@query("""SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS day, round(inflow, 4) AS inflow FROM orders
 LEFT JOIN (SELECT CAST(l_shipdate AS DATE) AS day, sum(l_quantity) AS inflow FROM lineitem GROUP BY 1) ON CAST(o_orderdate AS DATE) = day""")
def attach_by_date(spark, sf):
    history = table(spark, sf, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("day"))
    recent = (table(spark, sf, "lineitem").groupBy(F.to_date("l_shipdate").alias("day")).agg(F.round(F.sum("l_quantity"), 4).alias("inflow")))
    return joins.attach_by_date(history, recent, ["day"]).select("o_orderkey", text("day").alias("day"), "inflow")


_NATION_ID = "CASE WHEN n_regionkey < 3 THEN n_nationkey ELSE -1 - n_nationkey END"
_SEEN_ID = "CASE WHEN s_nationkey > 4 THEN s_nationkey ELSE 100 + s_nationkey END"


@query(f"""SELECT key, coalesce(n_name, '') AS n_name, n_nationkey IS NOT NULL AS listed, s IS NOT NULL AS observed FROM
 (SELECT coalesce(k, s) AS key, * FROM (SELECT *, {_NATION_ID} AS k FROM nation) n FULL JOIN (SELECT DISTINCT {_SEEN_ID} AS s FROM supplier) ON k = s)""")
def full_reference(spark, sf):
    nation = table(spark, sf, "nation").select(F.expr(_NATION_ID).alias("key"), "n_name")
    seen = table(spark, sf, "supplier").select(F.expr(_SEEN_ID).alias("key"))
    return joins.full_reference(nation, seen, "key").withColumn("n_name", F.coalesce("n_name", F.lit("")))


@query(f"SELECT o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT {_HELD_ID} FROM lineitem)")
def not_yet_held(spark, sf):
    held = table(spark, sf, "lineitem").select(F.expr(_HELD_ID).alias("o_orderkey"))
    return joins.not_yet_held(table(spark, sf, "orders").select("o_orderkey"), held, ["o_orderkey"])


@query(f"SELECT o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT {_HELD_ID} FROM lineitem)")
def not_yet_held_large(spark, sf):
    """The archive is cut to the candidates' keys before it is shuffled."""
    held = table(spark, sf, "lineitem").select(F.expr(_HELD_ID).alias("o_orderkey"))
    return joins.not_yet_held(table(spark, sf, "orders").select("o_orderkey"), held, ["o_orderkey"], large=True)


@query(f"SELECT o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT {_HELD_ID} FROM lineitem) ORDER BY o_orderkey LIMIT 40")
def not_yet_held_capped(spark, sf):
    held = table(spark, sf, "lineitem").select(F.expr(_HELD_ID).alias("o_orderkey"))
    return joins.not_yet_held(table(spark, sf, "orders").select("o_orderkey"), held, ["o_orderkey"], limit=40)


@query("""SELECT s_suppkey, strftime(day, '%Y-%m-%d') AS day, concat('x/', s_name, '-', day(day), '-', month(day), '-', strftime(day, '%y'), '/', strftime(day, '%Y%m%d'), '.pdf') AS url
 FROM supplier, (SELECT CAST(unnest(generate_series(DATE '2026-02-25', DATE '2026-03-04', INTERVAL 1 DAY)) AS DATE) AS day)""")
def capture_candidates(spark, sf):
    templates = table(spark, sf, "supplier").select(
        "s_suppkey", F.concat(F.lit("x/"), "s_name", F.lit("-{d}-{m}-{yy}/{yyyy}{mm}{dd}.pdf")).alias("template"))
    days = [F.lit(d).cast("date") for d in ("2026-02-25", "2026-03-04")]
    out = joins.capture_candidates(templates, "template", *days)
    return out.select("s_suppkey", text("day").alias("day"), "url")


@query("""WITH latest AS (SELECT o_custkey, max(CAST(o_orderdate AS DATE)) AS d, arg_max(o_orderkey, o_orderdate::VARCHAR || lpad(o_orderkey::VARCHAR, 12, '0')) AS v FROM orders GROUP BY 1),
 hist AS (SELECT o_custkey, CAST(o_orderdate AS DATE) AS d, max(o_orderkey) AS v FROM orders GROUP BY 1, 2)
 SELECT l.o_custkey, '1999-06-15' AS date, CAST(CASE WHEN l.d = DATE '1999-06-15' THEN l.v WHEN l.d > DATE '1999-06-15' THEN h.v END AS DOUBLE) AS value
 FROM latest l LEFT JOIN hist h ON h.o_custkey = l.o_custkey AND h.d = DATE '1999-06-15'""")
def reading_at(spark, sf):
    rows = table(spark, sf, "orders").select("o_custkey", F.to_date("o_orderdate").alias("date"), "o_orderkey")
    history = rows.groupBy("o_custkey", "date").agg(F.max("o_orderkey").alias("value"))
    latest = history.groupBy("o_custkey").agg(F.max("date").alias("d"), F.max_by("value", "date").alias("value")) \
        .withColumnRenamed("d", "date")
    out = joins.reading_at(latest, history, "o_custkey", F.lit("1999-06-15").cast("date"))
    return out.select("o_custkey", text("date").alias("date"), F.col("value").cast("double").alias("value"))


@query("""SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' AND o_orderdate < DATE '1997-01-01' THEN 'review' WHEN o_orderstatus = 'F' THEN 'official'
 WHEN o_orderstatus = 'O' AND o_orderdate >= DATE '1996-01-01' AND o_orderdate < DATE '1998-01-01' THEN 'interim' END AS quality_state FROM orders""")
def attach_quality(spark, sf):
    periods = local_table(spark, [("F", "1900-01-01", "1996-12-31", "review"), ("F", "1997-01-01", None, "official"),
                                  ("O", "1996-01-01", "1997-12-31", "interim")],
                          "o_orderstatus string, start_date string, end_date string, quality_state string")
    periods = periods.withColumns({c: F.to_date(c) for c in ("start_date", "end_date")})
    obs = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", F.to_date("o_orderdate").alias("date"))
    return joins.attach_quality(obs, periods, ["o_orderstatus"], "date").select("o_orderkey", "quality_state")
