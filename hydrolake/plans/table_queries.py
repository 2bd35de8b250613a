"""Cell tables and dated lines."""

from __future__ import annotations

from pyspark.sql import functions as F

from hydrolake.operators import extract_cells
from hydrolake.plans.registry import query, table, text

# One document per order line: parent, first date, one or two child rows and a second date.
_SPAN = """array(
 struct(0 AS row_no, array('Dam Name') AS cells),
 struct(1 AS row_no, array(concat('D', l_suppkey), '8AM', CAST(l_partkey AS STRING), '', '0.5', '100', '-3', '90', '2', CAST(l_linenumber AS STRING), '1.5', CAST(l_linenumber AS STRING), '7') AS cells),
 struct(2 AS row_no, array('Apr-23') AS cells),
 struct(3 AS row_no, array('6AM', 'old', '', '80', '', '', '', '1', '2') AS cells),
 struct(4 AS row_no, array('8AM', CAST(l_partkey - 1 AS STRING), '-4', '89', '1', '9', '0.5', '3', '4') AS cells),
 struct(5 AS row_no, array(CASE WHEN l_linenumber % 3 = 0 THEN 'Foo-99' ELSE 'Dec-31' END) AS cells),
 struct(6 AS row_no, array('Apr-21') AS cells))"""


@query("""SELECT l_orderkey, l_linenumber, l_partkey, concat('D', l_suppkey) AS dam, date, CAST(row_no AS BIGINT) AS row_no, '8AM' AS observation_time, CAST(CASE row_no WHEN 2 THEN l_partkey ELSE l_partkey - 1 END AS VARCHAR) AS water_level,
 CASE row_no WHEN 2 THEN '90' ELSE '89' END AS rule_curve, CASE row_no WHEN 2 THEN '-3' ELSE '-4' END AS normal_level_deviation, CASE row_no WHEN 2 THEN '2' ELSE '1' END AS rule_curve_deviation,
 CASE row_no WHEN 2 THEN CAST(l_linenumber AS VARCHAR) ELSE '9' END AS gates_open, CASE row_no WHEN 2 THEN '1.5' ELSE '0.5' END AS gate_opening_m, CASE row_no WHEN 2 THEN CAST(l_linenumber AS VARCHAR) ELSE '3' END AS inflow, CASE row_no WHEN 2 THEN '7' ELSE '4' END AS outflow
 FROM lineitem, (VALUES (2, '2026-04-23'), (5, '2025-12-31')) v(row_no, date) WHERE row_no = 2 OR l_linenumber % 3 > 0""")
def carry_rowspan(spark, sf):
    docs = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", F.inline(F.expr(_SPAN)))
    doc = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]
    out = extract_cells.carry_rowspan(docs, doc, "row_no", "cells", F.lit("2026-04-30").cast("date"))
    return out.select("l_orderkey", "l_linenumber", "l_partkey", "dam", text("date").alias("date"), F.col("row_no").cast("bigint").alias("row_no"),
                      "observation_time", "water_level", "rule_curve", "normal_level_deviation", "rule_curve_deviation", "gates_open",
                      "gate_opening_m", "inflow", "outflow")


_DAY = "CASE WHEN event_type = 'signup' THEN NULL ELSE CAST(floor(value) AS INT) % 9 END"
_NAME = "CASE WHEN event_id % 4 = 0 THEN concat('N', event_id % 50) END"


@query(f"""WITH l AS (SELECT user_id, event_id, {_DAY} AS d, {_NAME} AS name FROM events),
 dated AS (SELECT *, lag(d) OVER (PARTITION BY user_id ORDER BY event_id) AS p FROM l WHERE d IS NOT NULL),
 b AS (SELECT l.*, CAST(sum(CASE WHEN dated.d <= dated.p THEN 1 ELSE 0 END) OVER (PARTITION BY l.user_id ORDER BY l.event_id) AS BIGINT) AS block FROM l LEFT JOIN dated USING (user_id, event_id)),
 n AS (SELECT user_id, block, arg_max(name, event_id) AS block_name FROM b WHERE name IS NOT NULL GROUP BY ALL)
 SELECT b.user_id, b.event_id, b.d, b.block, n.block_name FROM b JOIN n USING (user_id, block) WHERE b.d IS NOT NULL""")
def segment_blocks(spark, sf):
    lines = table(spark, sf, "events").select(
        "user_id", "event_id", F.expr(_DAY).alias("d"), F.expr(_NAME).alias("name"))
    out = extract_cells.segment_blocks(lines, ["user_id"], ["event_id"], "d", "name", F.floor(F.col("event_id") / 1000))
    return out.select("user_id", "event_id", "d", "block", "block_name")


# A bulletin per order: title, header, one row per line item, a subtotal.
_HEAD = "array('Station', 'Reservoir name', 'Reservoir', 'Full Supply Capacity', '% Full Last Year', '% Full 2026-06-29', '%Full', 'Prov/ Country')"


def bulletins(spark, sf):
    lines = table(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct(
        "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"))).alias("items"))
    body = F.transform("items", lambda x: F.array(
        F.concat(F.lit("A2R"), F.lpad((x["l_partkey"] % 1000).cast("string"), 3, "0"), F.lit(" x")),
        F.lit("n"), F.concat(F.lit("Dam\n"), x["l_suppkey"].cast("string")), F.concat(F.lit("# "), x["l_suppkey"].cast("string")),
        F.lit("50"), x["l_quantity"].cast("int").cast("string"), F.lit("1"), F.lit("P")))
    rows = F.concat(F.array(F.array(F.lit("Weekly bulletin"))), F.array(F.expr(_HEAD)), body,
                    F.array(F.array(F.lit("A9Z999"), F.lit("Subtotal"))))
    cells = F.transform(rows, lambda row, row_no: F.transform(row, lambda text, col_no: F.struct(
        F.lit(0).alias("table_no"), row_no.alias("row_no"), col_no.alias("col_no"), text.alias("text"))))
    return lines.select("l_orderkey", F.flatten(cells).alias("cells"))


@query("""SELECT l_orderkey, concat('A2R', lpad(CAST(l_partkey % 1000 AS VARCHAR), 3, '0')) AS station_id, concat('Dam', l_suppkey) AS reservoir, CAST(l_suppkey AS DOUBLE) AS fsc_mcm, l_quantity AS pct_full, 50.0 AS pct_last_year, 'P' AS prov
 FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_partkey % 1000 ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice) = 1""".replace("50.0 AS", "50.0::DOUBLE AS"))
def map_header(spark, sf):
    from hydrolake import functions as P
    out = extract_cells.map_header(bulletins(spark, sf), ["l_orderkey"], F.lit("2026-06-29").cast("date"), nested="cells")
    return out.select("l_orderkey", "station_id", "reservoir", *[P.num_hash(c).alias(c) for c in ("fsc_mcm", "pct_full", "pct_last_year")], "prov")


_WIDTH = "CASE o_orderkey % 4 WHEN 0 THEN 18 WHEN 1 THEN 15 WHEN 2 THEN 27 ELSE 9 END"
_KIND = "CASE o_orderkey % 8 WHEN 2 THEN 'situation' ELSE 'flows' END"


@query(f"""WITH v(kind, lo, hi, c, variable) AS (VALUES ('flows', 17, 999, 1, 'inflow_day_mcm'), ('flows', 17, 999, 8, 'outflow_day_mcm'), ('flows', 17, 999, 13, 'storage_pct'), ('flows', 17, 999, 14, 'storage_p1_mcm'),
 ('flows', 12, 16, 1, 'inflow_day_mcm'), ('flows', 12, 16, 8, 'outflow_day_mcm'), ('flows', 12, 16, 13, 'storage_p1_mcm'), ('situation', 26, 999, 18, 'water_level_m'), ('situation', 26, 999, 19, 'storage_mcm'),
 ('situation', 26, 999, 20, 'storage_useful_mcm'), ('situation', 26, 999, 21, 'withdrawal_day_mcm'), ('situation', 26, 999, 24, 'precipitation_mm'), ('situation', 26, 999, 25, 'salinity_gl'))
 SELECT o_orderkey, CAST(w AS BIGINT) AS width, c AS col_no, variable, CAST(o_custkey + c AS VARCHAR) AS text FROM (SELECT *, {_WIDTH} AS w, {_KIND} AS k FROM orders) JOIN v ON k = kind AND w BETWEEN lo AND hi""")
def layout_by_width(spark, sf):
    cells = table(spark, sf, "orders").select("o_orderkey", "o_custkey", F.expr(_KIND).alias("kind"), F.lit(0).alias("row_no"),
                                              F.explode(F.expr(f"sequence(0, {_WIDTH} - 1)")).alias("col_no"))
    cells = cells.select("o_orderkey", "kind", "row_no", "col_no", text(F.col("o_custkey") + F.col("col_no")).alias("text"))
    return extract_cells.layout_by_width(cells, ["o_orderkey"], "kind").select(
        "o_orderkey", F.col("width").cast("bigint").alias("width"), "col_no", "variable", "text")
