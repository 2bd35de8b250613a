"""Words with coordinates from lineitem, token lines from orders."""

from __future__ import annotations

from pyspark.sql import functions as F

from hydrolake.operators import extract_cells, extract_words
from hydrolake.plans.cell_queries import S
from hydrolake.plans.registry import mean4, query, table, text

# words: a page per hundred orders, quantity gives y, linenumber and part the x
_WORDS_SQL = """(SELECT l_orderkey // 100 AS page, l_quantity * 7 AS y, CAST(l_linenumber * 40 + l_partkey % 3 AS DOUBLE) AS x, CAST(l_suppkey AS VARCHAR) AS t, l_orderkey, l_linenumber, l_partkey, l_extendedprice FROM lineitem)"""


def words(spark, sf):
    return table(spark, sf, "lineitem").select(
        F.floor(F.col("l_orderkey") / 100).alias("page"), (F.col("l_quantity") * 7).alias("y"),
        (F.col("l_linenumber") * 40 + F.col("l_partkey") % 3).cast("double").alias("x"), text("l_suppkey").alias("t"),
        "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")


@query(f"""SELECT page, line, string_agg(t, ' ' ORDER BY x, t) AS text FROM (SELECT *, round_even(y / 3, 0) * 3 AS line FROM {_WORDS_SQL}) GROUP BY ALL""")
def words_to_lines_bucket(spark, sf):
    lined = words(spark, sf).withColumn("line", extract_words.line_of_bucket("y"))
    return extract_words.line_text(lined, ["page", "line"], "x", "t").select("page", "line", "text")


_GAP_SQL = f"""(SELECT w.*, line_no FROM {_WORDS_SQL} w JOIN (SELECT page, y, CAST(sum(b) OVER (PARTITION BY page ORDER BY y) AS BIGINT) AS line_no FROM
 (SELECT page, y, CASE WHEN y - lag(y) OVER (PARTITION BY page ORDER BY y) > 7 THEN 1 ELSE 0 END AS b FROM (SELECT DISTINCT page, y FROM {_WORDS_SQL}))) USING (page, y))"""


@query(f"SELECT page, line_no, count(*) AS n, string_agg(t, ' ' ORDER BY x, t) AS text FROM {_GAP_SQL} GROUP BY ALL")
def words_to_lines_gap(spark, sf):
    lined = extract_words.words_to_lines(words(spark, sf), ["page"], "y", 7.0)
    texts = extract_words.line_text(lined, ["page", "line_no"], "x", "t")
    return texts.select("page", "line_no", F.size("tokens").cast("bigint").alias("n"), "text")


_CLUSTER_SQL = f"""(SELECT page, CAST(row_number() OVER (PARTITION BY page ORDER BY c) - 1 AS BIGINT) AS col_index, centre, n FROM (SELECT * FROM (SELECT page, c, CAST(sum(n) AS BIGINT) AS n, sum(x * n) / sum(n) AS centre FROM
 (SELECT page, x, n, sum(b) OVER (PARTITION BY page ORDER BY x) AS c FROM (SELECT page, x, n, CASE WHEN x - lag(x) OVER (PARTITION BY page ORDER BY x) >= 14 THEN 1 ELSE 0 END AS b FROM
 (SELECT page, x, count(*) AS n FROM {_WORDS_SQL} GROUP BY ALL))) GROUP BY page, c) QUALIFY row_number() OVER (PARTITION BY page ORDER BY n DESC, c) <= 5))"""


@query(f"SELECT page, col_index, round(centre + 3e-9, 4) AS centre, n FROM {_CLUSTER_SQL}")
def gap_clusters(spark, sf):
    out = extract_words.gap_clusters(words(spark, sf), ["page"], "x", 14.0, 5)
    return out.select("page", F.col("col_index").cast("bigint").alias("col_index"), mean4("centre").alias("centre"), "n")


@query(f"""SELECT l_orderkey, l_linenumber, l_partkey, arg_min(col_index, abs(centre - x) * 1000000 + col_index / 1000) AS col_index FROM {_WORDS_SQL} JOIN {_CLUSTER_SQL} USING (page)
 GROUP BY l_orderkey, l_linenumber, l_partkey, l_extendedprice, x, t, y""")
def assign_columns(spark, sf):
    w = words(spark, sf)
    centres = extract_words.gap_clusters(w, ["page"], "x", 14.0, 5)
    out = extract_words.assign_columns(w, centres, ["page"], "x")
    return out.select("l_orderkey", "l_linenumber", "l_partkey", F.col("col_index").cast("bigint").alias("col_index"))


@query(f"""SELECT page, line_no, col, string_agg(tt, ' ' ORDER BY x, tt) AS text, CAST(replace((list(tt ORDER BY x, tt) FILTER (tt <> 'e'))[1], ',', '.') AS DOUBLE) AS value,
 CASE WHEN bool_or(tt = 'e') THEN 'e' ELSE '' END AS flag FROM (SELECT *, floor(x / 40) AS col, CASE WHEN l_partkey % 5 = 0 THEN 'e' ELSE concat(t, ',5') END AS tt FROM {_GAP_SQL})
 GROUP BY page, line_no, col HAVING count(*) FILTER (tt <> 'e') > 0""")
def cell_values(spark, sf):
    lined = extract_words.words_to_lines(words(spark, sf), ["page"], "y", 7.0)
    lined = lined.withColumn("col_index", F.floor(F.col("x") / 40)).withColumn(
        "t", F.expr("CASE WHEN l_partkey % 5 = 0 THEN 'e' ELSE concat(t, ',5') END"))
    out = extract_words.cell_values(lined, ["page", "line_no"], "x", "t")
    return out.select("page", "line_no", F.col("col_index").cast("double").alias("col"), "text", "value", "flag")


_WORD_NAMES = """(VALUES (0, 'full_supply_level_masl'), (1, 'full_supply_capacity_mcm'), (2, 'lowest_abstraction_level_masl'), (3, 'lowest_abstraction_capacity_mcm'), (4, 'water_level_masl'), (5, 'storage_mcm'), (6, 'storage_pct')) v(col_index, variable)"""


@query(f"""WITH c AS (SELECT page, line_no, CAST(floor((x - 40) / 40) AS INTEGER) AS col_index, CAST(replace((list(concat(t, ',5') ORDER BY x, t))[1], ',', '.') AS DOUBLE) AS value FROM {_GAP_SQL} GROUP BY ALL)
 SELECT page, line_no, variable, value, '' AS flag FROM (SELECT *, count(*) OVER (PARTITION BY page, line_no) AS n FROM c) JOIN {_WORD_NAMES} USING (col_index) WHERE n >= 7""")
def word_table(spark, sf):
    """Words to lines, columns, cells and named variables of the bulletin with 13 columns."""
    lined = extract_words.words_to_lines(words(spark, sf), ["page"], "y", 7.0).withColumn("t", F.concat("t", F.lit(",5")))
    centres = extract_words.learn_centres(words(spark, sf), "page", "x")
    every = centres.agg(F.array_sort(F.collect_list("centre")).alias("c")).first()["c"]
    placed = lined.withColumn("col_index", extract_words.nearest_index("x", F.array(*[F.lit(c) for c in every])))
    cells = extract_words.cell_values(placed, ["page", "line_no"], "x", "t")
    return extract_cells.name_word_columns(cells, ["page", "line_no"])


# the columns lie far apart, so the best centres are the means by line number
@query(f"""SELECT CAST(row_number() OVER (ORDER BY l_linenumber) - 1 AS INTEGER) AS col_index, round(avg(x) + 3e-9, 4) AS centre FROM {_WORDS_SQL}
 WHERE page IN (SELECT page FROM {_WORDS_SQL} GROUP BY page HAVING count(*) >= 40) GROUP BY l_linenumber""")
def learn_centres(spark, sf):
    out = extract_words.learn_centres(words(spark, sf), "page", "x")
    return out.select("col_index", mean4("centre").alias("centre"))


_D, _M = (f"lpad({S(p + '(o_orderdate)')}, 2, '0')" for p in ("day", "month"))
TOKENS = f"""CASE o_orderkey % 4 WHEN 0 THEN array('B', 'P', 'R', concat('N', o_custkey), concat({_M}, '-', {_D}), '08:00', '12.5', '0.1')
 WHEN 1 THEN array('B', 'P', 'R', concat('N', o_custkey, ' ', {_M}, '-', {_D}, '08:00'), '12.5', '--')
 WHEN 2 THEN array('P', 'R', concat('N', o_custkey), {_M}, {_D}, '08:00', 'x', '12.5', '--') ELSE array('B', 'R', concat('N', o_custkey), 'no time') END"""


@query(f"""SELECT o_orderkey, array_to_string(CASE o_orderkey % 4 WHEN 0 THEN ['B', 'P', 'R', n, tm, '12.5', '0.1'] WHEN 1 THEN ['B', 'P', concat('R ', n), tm, '12.5', '--']
 WHEN 2 THEN ['P', 'R', n, tm, 'x', '12.5', '--'] ELSE ['B', 'R', n, 'n0 time'] END, '|') AS tokens FROM (SELECT *, concat('N', o_custkey) AS n, concat({_M}, '-', {_D}, ' 08:00') AS tm FROM orders)""")
def repair_tokens(spark, sf):
    # letters O become zeros in every token, and a name with a glued time is taken
    # together with the token before it, as the left-to-right repair does
    return table(spark, sf, "orders").select(
        "o_orderkey", F.array_join(extract_words.repair_tokens(F.expr(TOKENS)), "|").alias("tokens"))


@query(f"""SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN 'B' ELSE '' END AS basin, CASE o_orderkey % 4 WHEN 1 THEN 'B' ELSE 'P' END AS province, CASE o_orderkey % 4 WHEN 1 THEN 'P' ELSE 'R' END AS river, concat(CASE o_orderkey % 4 WHEN 1 THEN 'R ' ELSE '' END, 'N', o_custkey) AS reservoir,
 concat({_M}, '-', {_D}, ' 08:00') AS time, '12.5' AS level, CASE o_orderkey % 4 WHEN 0 THEN '0.1' ELSE '--' END AS change FROM orders WHERE o_orderkey % 4 < 3""")
def align_on_anchor(spark, sf):
    lines = table(spark, sf, "orders").select("o_orderkey", extract_words.repair_tokens(F.expr(TOKENS)).alias("tokens"))
    return extract_words.align_on_anchor(lines, "tokens", ["o_orderkey"])


@query("""SELECT s_suppkey, CASE k WHEN 1 THEN 'b' WHEN 3 THEN '' ELSE '长江流域' END AS basin, CASE k WHEN 1 THEN '长江流域' WHEN 3 THEN 'zz' ELSE '湖北' END AS province,
 CASE k WHEN 0 THEN concat('R', s_nationkey) WHEN 1 THEN '湖北' WHEN 2 THEN s_name ELSE 'q' END AS river, CASE k WHEN 1 THEN concat('R', s_nationkey) ELSE s_name END AS reservoir, '04-01 08:00' AS time FROM (SELECT *, s_suppkey % 4 AS k FROM supplier)""")
def repair_shift(spark, sf):
    k = "s_suppkey % 4"
    rows = table(spark, sf, "supplier").select(
        "s_suppkey", F.expr(f"CASE {k} WHEN 1 THEN 'b' ELSE '' END").alias("basin"), F.expr(f"CASE {k} WHEN 3 THEN 'zz' ELSE '长江流域' END").alias("province"),
        F.expr(f"CASE {k} WHEN 3 THEN 'q' ELSE '湖北' END").alias("river"),
        F.expr(f"CASE {k} WHEN 2 THEN concat(s_name) WHEN 3 THEN '' ELSE concat('R', s_nationkey) END").alias("reservoir"),
        F.expr(f"CASE {k} WHEN 1 THEN '04-01 08:00' WHEN 2 THEN '04-01 08:00' ELSE concat(s_name, ' 04-01 08:00') END").alias("time"))
    return extract_words.repair_shift(rows)
