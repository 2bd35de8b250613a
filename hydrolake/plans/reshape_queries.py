"""Stacking, melting, pivoting, variables and units."""

from __future__ import annotations

from pyspark.sql import functions as F

from hydrolake.functions import fixed
from hydrolake.operators import reshape
from hydrolake.plans.registry import mean4, query, r4, table, text
from hydrolake.session import local_table

LEVEL, SHARE = "level (water level, m)", "storage_pct (%)"


@query("""SELECT c_custkey AS id, c_name AS name, c_mktsegment AS segment FROM customer UNION ALL SELECT s_suppkey, s_name, NULL FROM supplier""")
def union_sources(spark, sf):
    customer = table(spark, sf, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"),
                                                   F.col("c_mktsegment").alias("segment"))
    supplier = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"))
    return reshape.union_sources([customer, supplier])


# rows that must not meet the other side keep their place under a negative key
_LISTED = "CASE WHEN c_mktsegment = 'BUILDING' THEN -c_custkey ELSE c_custkey END"
_SEEN = "CASE WHEN o_orderstatus = 'F' THEN o_custkey ELSE -1000000000 - o_custkey END"


@query(f"SELECT {_LISTED} AS id FROM customer UNION SELECT {_SEEN} FROM orders")
def id_union(spark, sf):
    a = table(spark, sf, "customer").select(F.expr(_LISTED).alias("id"))
    b = table(spark, sf, "orders").select(F.expr(_SEEN).alias("id"))
    return reshape.id_union(a, b, "id")


@query(f"SELECT {_LISTED} AS id FROM customer EXCEPT SELECT {_SEEN} FROM orders")
def id_minus(spark, sf):
    a = table(spark, sf, "customer").select(F.expr(_LISTED).alias("id"))
    b = table(spark, sf, "orders").select(F.expr(_SEEN).alias("id"))
    return reshape.id_minus(a, b, "id")


def _wide(spark, sf):
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", F.col("l_quantity").alias(LEVEL),
        F.expr("CASE WHEN l_partkey % 5 > 0 THEN l_discount * 100 END").alias(SHARE))


@query(f"""SELECT l_orderkey, l_linenumber, l_partkey, '{LEVEL}' AS variable_original, 'water level' AS variable_gloss, 'm' AS unit, round(l_quantity, 4) AS value FROM lineitem
 UNION ALL SELECT l_orderkey, l_linenumber, l_partkey, '{SHARE}', '', '%', round(l_discount * 100, 4) FROM lineitem WHERE l_partkey % 5 > 0""")
def to_long(spark, sf):
    return reshape.to_long(_wide(spark, sf), ["l_orderkey", "l_linenumber", "l_partkey"]).withColumn("value", r4("value"))


@query("""SELECT user_id, strftime(ts, '%Y-%m-%d') AS day, max(value) FILTER (event_type = 'click') AS click, max(value) FILTER (event_type = 'view') AS view,
 max(value) FILTER (event_type = 'error') AS error FROM events GROUP BY ALL""")
def to_wide(spark, sf):
    df = table(spark, sf, "events").select("user_id", text(F.to_date("ts")).alias("day"), "event_type", "value")
    return reshape.to_wide(df, ["user_id", "day"], "event_type", "value", ["click", "view", "error"])


@query("""SELECT l_orderkey, l_linenumber, CASE l_returnflag WHEN 'A' THEN 'water_level_m' ELSE 'inflow_m3s' END AS variable FROM lineitem WHERE l_returnflag IN ('A', 'R')""")
def rename_variables(spark, sf):
    mapping = local_table(spark, [("A", "water_level_m"), ("R", "inflow_m3s")], "old string, new string")
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_returnflag").alias("variable"))
    return reshape.rename_variables(lines, mapping)


_MAP = [("C0", "click", "storage_mcm", fixed.UNIT_FACTORS["TMC"]), ("C0", "view", "discharge_m3s", fixed.UNIT_FACTORS["cusec"]),
        ("C1", "click", "storage_mcm", fixed.UNIT_FACTORS["10^4 m^3"]), ("C1", "error", "discharge_m3s", fixed.UNIT_FACTORS["mld"])]
_MAP_SQL = "(VALUES " + ", ".join(f"('{c}', '{v}', '{s}', {f})" for c, v, s, f in _MAP) + ") m(country, variable_original, standard_variable, unit_factor)"
_LONG_SQL = "(SELECT event_id, concat('C', user_id % 3) AS country, event_type AS variable_original, value FROM events)"


def _normalised(spark, sf):
    long = table(spark, sf, "events").select("event_id", F.concat(F.lit("C"), text(F.col("user_id") % 3)).alias("country"),
                                             F.col("event_type").alias("variable_original"), "value")
    variables = local_table(spark, _MAP, "country string, variable_original string, standard_variable string, unit_factor double")
    return reshape.normalise(long, variables)


@query(f"SELECT event_id, country, standard_variable, round(value * unit_factor, 4) AS value FROM {_LONG_SQL} JOIN {_MAP_SQL} USING (country, variable_original)")
def normalise(spark, sf):
    return _normalised(spark, sf)[0].withColumn("value", r4("value"))


@query(f"SELECT country, variable_original, count(*) AS n FROM {_LONG_SQL} ANTI JOIN {_MAP_SQL} USING (country, variable_original) GROUP BY ALL")
def unmapped_variables(spark, sf):
    return _normalised(spark, sf)[1]


@query("""SELECT user_id, event_type, strftime(ts, '%Y-%m-%d') AS date, count(value) AS n,
 round(CASE WHEN event_type = 'purchase' THEN sum(value) ELSE avg(value) END + 3e-9, 4) AS value FROM events GROUP BY 1, 2, 3""")
def to_daily(spark, sf):
    df = reshape.to_daily(table(spark, sf, "events"), ["user_id"], "ts", "event_type", "value", ["purchase"])
    return df.select("user_id", "event_type", text("date").alias("date"), "n", mean4("value").alias("value"))


@query("""SELECT event_id, variable, strftime(CAST(ts AS DATE) - CASE WHEN variable IN ('inflow_day_mcm', 'outflow_day_mcm') THEN 1 ELSE 0 END, '%Y-%m-%d') AS date FROM
 (SELECT event_id, ts, CASE event_type WHEN 'click' THEN 'inflow_day_mcm' WHEN 'view' THEN 'outflow_day_mcm' WHEN 'error' THEN 'storage_pct' ELSE event_type END AS variable FROM events)""")
def date_by_variable(spark, sf):
    back = local_table(spark, list(fixed.DAYS_BACK_BY_VARIABLE.items()), "variable string, days int")
    rows = table(spark, sf, "events").select("event_id", F.to_date("ts").alias("date"), F.expr(
        "CASE event_type WHEN 'click' THEN 'inflow_day_mcm' WHEN 'view' THEN 'outflow_day_mcm' WHEN 'error' THEN 'storage_pct' ELSE event_type END").alias("variable"))
    return reshape.date_by_variable(rows, back, "date").withColumn("date", text("date"))
