"""Page text. Fragments around the pages' own text are derived from keys."""

from __future__ import annotations

from pyspark.sql import functions as F

from hydrolake import functions as P
from hydrolake.functions import fixed
from hydrolake.operators import extract_text
from hydrolake.plans.registry import query, table, text


def _table_pages(spark, sf):
    row = F.expr("concat('<tr class=\"r\"><td>', lpad(CAST(o_orderkey AS STRING), 9, '0'), '</td><td align=\"x\"> <b>', o_orderpriority, '</b> &amp;  x</td><th></th></tr>')")
    return table(spark, sf, "orders").groupBy("o_custkey").agg(F.concat(
        F.lit("<table>"), F.array_join(F.sort_array(F.collect_list(row)), "\n"), F.lit("</table>")).alias("html"))


@query("""SELECT o_custkey, CAST(row_no AS BIGINT) AS row_no, CAST(col_no AS BIGINT) AS col_no, CASE col_no WHEN 0 THEN lpad(CAST(o_orderkey AS VARCHAR), 9, '0') WHEN 1 THEN concat(o_orderpriority, ' & x') ELSE '' END AS text
 FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1 AS row_no FROM orders), (SELECT unnest([0, 1, 2]) AS col_no)""")
def html_cells(spark, sf):
    cells = extract_text.html_cells(_table_pages(spark, sf), "html", ["o_custkey"])
    return cells.withColumns({c: F.col(c).cast("bigint") for c in ("row_no", "col_no")})


@query(r"""WITH h AS (SELECT page_id, regexp_extract_all(html, '<li><a href="([^"]*)">([^<]*)</a></li>', 1) AS k, regexp_extract_all(html, '<li><a href="([^"]*)">([^<]*)</a></li>', 2) AS v FROM pages),
 u AS (SELECT page_id, unnest(k) AS k, unnest(v) AS v, generate_subscripts(k, 1) AS i FROM h)
 SELECT page_id, k AS key, arg_max(v, i) AS value FROM u WHERE v <> '' GROUP BY ALL""")
def html_pairs(spark, sf):
    dl = F.regexp_replace("html", '<li><a href="([^"]*)">([^<]*)</a></li>', "<dt>$1</dt> <dd>$2</dd>")
    return extract_text.html_pairs(table(spark, sf, "pages").select("page_id", dl.alias("h")), "h", ["page_id"])


_JS = """concat('<script>const ', lower(p_type), CASE p_partkey % 3 WHEN 0 THEN 'Dams = [' WHEN 1 THEN ' = [' ELSE ' = { id: 1, dams: [' END,
 '{name: "Lake ', p_name, '", purpose: "use", net: ', CAST(p_size AS STRING), ', present: "', CAST(p_partkey AS STRING), '.5", pct: "', CAST(p_partkey % 200 AS STRING), '"},',
 '{name: "Lake ', p_name, '", purpose: "use", net: ', CAST(p_size AS STRING), ', present: "', CAST(p_partkey AS STRING), '.5", pct: "', CAST(p_partkey % 200 AS STRING), '"},',
 '{name: "Total", net: 1}', ']</script>')"""


@query("""SELECT p_partkey, concat('LAKE ', upper(p_name)) AS dam, CASE WHEN p_partkey % 3 = 0 THEN concat(upper(p_type[1]), lower(p_type[2:])) ELSE concat(upper(p_type[1]), lower(p_type[2:])) END AS catchment, 'use' AS purpose, variable, value FROM
 (SELECT *, 'full_supply_capacity_mcm' AS variable, CAST(p_size AS DOUBLE) AS value FROM part UNION ALL SELECT *, 'storage_mcm', p_partkey + 0.5 FROM part
 UNION ALL SELECT *, 'storage_pct', CAST(p_partkey % 200 AS DOUBLE) FROM part WHERE p_partkey % 200 <= 150)""")
def js_objects(spark, sf):
    pages = table(spark, sf, "part").select("p_partkey", F.expr(_JS).alias("t"))
    return extract_text.js_objects(pages, "t", ["p_partkey"])


_MAP = """concat('var x = 1;', chr(10), CASE WHEN s_suppkey % 6 = 0 THEN '[junk],' ELSE concat('[', CAST(s_suppkey AS STRING), ',''', s_name, '-Combine'',''Combine'', 1.5 , -110.25 ,''Normal'',''Alert'',''',
 '?station=', CAST(s_suppkey + 1000 AS STRING), '&lt;br&gt;River Basin: Sg. ', CAST(s_nationkey AS STRING), '<br>Time Taken : 22-08-2026 10:30<br>Latest WL : ', CAST(s_suppkey AS STRING), '.25m (WL Based on D', CAST(s_nationkey AS STRING), ')<br>',
 CASE WHEN s_suppkey % 2 = 0 THEN 'RF Status : Light <br>' ELSE '' END, 'WL Status : ', 'High', '''],') END, chr(10), 'end')"""


@query("""SELECT s_suppkey, concat(s_name, '-Combine') AS name_combined, CAST(s_suppkey + 1000 AS VARCHAR) AS station, '22-08-2026 10:30' AS time_taken, concat(s_suppkey, '.25') AS latest_wl, 'High' AS wl_status, concat('D', s_nationkey) AS wl_datum,
 CASE WHEN s_suppkey % 2 = 0 THEN 'Light' ELSE '' END AS rf_status, concat('Sg. ', s_nationkey) AS river_basin, '-110.25' AS lon FROM supplier WHERE s_suppkey % 6 > 0""")
def tooltip_fields(spark, sf):
    pages = table(spark, sf, "supplier").select("s_suppkey", F.expr(_MAP).alias("t"))
    out = extract_text.tooltip_fields(pages, "t", ["s_suppkey"])
    return out.select("s_suppkey", "name_combined", "station", "time_taken", "latest_wl", "wl_status", "wl_datum", "rf_status", "river_basin", "lon")


@query(r"""WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS line_no FROM documents),
 n AS (SELECT *, lead(line) OVER (PARTITION BY doc_id ORDER BY line_no) AS nxt FROM l)
 SELECT doc_id, CAST(line_no AS BIGINT) AS line_no, regexp_extract(line, '^(\S+) (\S+)', 1) AS first, regexp_extract(line, '^(\S+) (\S+)', 2) AS second,
 CASE WHEN regexp_matches(nxt, '^(\S+) \S+ (\S+)') THEN regexp_extract(nxt, '^(\S+) \S+ (\S+)', 2) END AS change FROM n WHERE regexp_matches(line, '^(\S+) (\S+)')""")
def lines_with_next(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", F.split("text", "\n").alias("lines"))
    out = extract_text.lines_with_next(docs, "lines", ["doc_id"], r"^(\S+) (\S+)", {"first": 1, "second": 2},
                                       r"^(\S+) \S+ (\S+)", "change", 2)
    return out.withColumn("line_no", F.col("line_no").cast("bigint"))


_LAKE = """concat(html, ' <h2>Lake Level</h2> August ', CAST(page_id % 28 + 1 AS STRING), ', 2026 256.', CAST(page_id % 90 + 10 AS STRING), ' feet | 78.', CAST(page_id % 80 + 10 AS STRING), ' m and Monday, July 3 2026 255.5 ft 77.5 meters; ',
 'August ', CAST(page_id % 28 + 1 AS STRING), ' 2026 1.0 feet 2.0 m', CASE WHEN page_id % 2 = 0 THEN repeat('.', 600) ELSE '' END, ' July 9, 2026 255.1 feet | 77.1 m')"""
_PAIR = r"((?:Monday|Tuesday)?,?\s*[A-Z][a-z]+\s+\d{1,2},?\s+\d{4})\s+(\d{2,3}\.\d{1,3})\s*(?:feet|ft)\s*\|?\s*(\d{2,3}\.\d{1,3})\s*(?:meters|metres|m)\b"


@query("""SELECT page_id, d AS date, ft, m FROM (SELECT page_id, concat('2026-08-', lpad(CAST(page_id % 28 + 1 AS VARCHAR), 2, '0')) AS d, concat('256.', page_id % 90 + 10) AS ft, concat('78.', page_id % 80 + 10) AS m FROM pages
 UNION ALL SELECT page_id, '2026-07-03', '255.5', '77.5' FROM pages UNION ALL SELECT page_id, '2026-07-09', '255.1', '77.1' FROM pages WHERE page_id % 2 = 1)""")
def anchored_pairs(spark, sf):
    pages = table(spark, sf, "pages").select("page_id", P.html_to_text(F.expr(_LAKE)).alias("t"))
    out = extract_text.anchored_pairs(pages, "t", ["page_id"], "lake level", _PAIR, 1, {"ft": 2, "m": 3}, fixed.MONTHS_EN, span=600)
    return out.withColumn("date", text("date"))


_ERA = """CASE page_id % 4 WHEN 0 THEN concat(html, '<script>gwayiDams = [{name: "Kariba ', CAST(page_id AS STRING), 'a", net: 10, present: 4, pct: 40}]</script> MANYAME Dam Level - 55.5 %')
 WHEN 1 THEN concat(html, '<table><tr><td>Lake Kariba</td><td>300</td><td>96.5</td></tr><tr><td>Total</td><td>1</td><td>1</td></tr></table> MANYAME Dam Level - 55.5 %')
 WHEN 2 THEN concat(html, ' MANYAME Dam Level - 5', CAST(page_id % 10 AS STRING), '. 5 % and DARWENDALE Dam Level – 9 %') ELSE html END"""


@query("""SELECT page_id, 0 AS parser_rank, 'KARIBA A' AS dam, variable, value FROM pages, (VALUES ('full_supply_capacity_mcm', 10.0::DOUBLE), ('storage_mcm', 4.0), ('storage_pct', 40.0)) v(variable, value) WHERE page_id % 4 = 0
 UNION ALL SELECT page_id, 1, 'KARIBA', variable, value FROM pages, (VALUES ('full_supply_capacity_mcm', 300.0::DOUBLE), ('storage_pct', 96.5)) v(variable, value) WHERE page_id % 4 = 1
 UNION ALL SELECT page_id, 2, 'MANYAME', 'storage_pct', 50 + page_id % 10 + 0.5 FROM pages WHERE page_id % 4 = 2""")
def cascade(spark, sf):
    pages = table(spark, sf, "pages").select("page_id", F.expr(_ERA).alias("h"))
    return extract_text.cascade(pages, ["page_id"], [
        extract_text.js_readings("h"), extract_text.table_readings("h"), extract_text.prose_readings("h")])


_NUMS = "slice(array(l_quantity * 3, CAST(l_partkey AS DOUBLE), CAST(l_suppkey * 4 AS DOUBLE), CAST(l_orderkey % 180 AS DOUBLE)), 1, CAST(l_linenumber % 4 + 1 AS INT))"
_DAM = "CASE WHEN l_suppkey % 10 = 0 THEN 'MAVUZI' ELSE 'MUDA' END"


@query(f"""SELECT variable, count(*) AS n, round(sum(value), 2) AS total FROM (SELECT *, l_linenumber % 4 + 1 AS k, l_quantity * 3 AS a, l_partkey AS b, l_suppkey * 4 AS c, l_orderkey % 180 AS d, {_DAM} AS dam FROM lineitem) x,
 LATERAL (SELECT unnest([{{'variable': 'water_level_m', 'value': CASE WHEN a BETWEEN 5 AND 3000 THEN a END}}, {{'variable': 'inflow_m3s', 'value': CASE WHEN k >= 3 THEN b END}},
 {{'variable': 'outflow_m3s', 'value': CASE WHEN k = 4 OR (k = 3 AND (c > 150 OR dam = 'MAVUZI')) THEN c END}}, {{'variable': 'storage_pct', 'value': CASE WHEN k = 4 AND d <= 150 THEN d WHEN k = 2 AND b <= 150 THEN b END}}], recursive := true)) WHERE value IS NOT NULL GROUP BY variable""")
def unpack_by_arity(spark, sf):
    rows = table(spark, sf, "lineitem").select("l_orderkey", F.expr(_NUMS).alias("nums"), F.expr(_DAM).alias("dam"))
    out = extract_text.unpack_by_arity(rows, "nums", ["l_orderkey"], "dam")
    return out.groupBy("variable").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 2).alias("total"))


_PROSE = """concat('As albufeiras de Chicamba Real, Muda e Outra registam níveis de enchimento de ', CAST(o_orderkey % 90 AS STRING), ',5%, 60%', CASE WHEN o_orderkey % 2 = 0 THEN ' e 70%' ELSE '' END,
 ', respectivamente. Descarga de ', CAST(o_custkey AS STRING), '.5 m³/s para a albufeira de Mavuzi e 3 m3/s para Nada.')"""


@query("""SELECT o_orderkey, dam, variable, value FROM (SELECT o_orderkey, 'CHICAMBA' AS dam, 'storage_pct' AS variable, o_orderkey % 90 + 0.5 AS value FROM orders WHERE o_orderkey % 2 = 0
 UNION ALL SELECT o_orderkey, 'MUDA', 'storage_pct', 60 FROM orders WHERE o_orderkey % 2 = 0 UNION ALL SELECT o_orderkey, 'MAVUZI', 'outflow_m3s', o_custkey + 0.5 FROM orders)""".replace("o_orderkey % 90 + 0.5", "CAST(o_orderkey % 90 + 0.5 AS DOUBLE)"))
def prose_pairs(spark, sf):
    rows = table(spark, sf, "orders").select("o_orderkey", F.expr(_PROSE).alias("t"))
    return extract_text.prose_pairs(rows, "t", ["o_orderkey"])
