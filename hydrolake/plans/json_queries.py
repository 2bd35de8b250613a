"""Nested payloads assembled from orders, lineitem and events."""

from __future__ import annotations

from pyspark.sql import functions as F

from hydrolake.operators import extract_json
from hydrolake.plans.registry import query, table, text


#: Order lines a task nests and unnests; a larger table gets more tasks, not larger ones.
LINES_A_TASK = 250_000


@query("""SELECT CAST(l_orderkey // 10 AS BIGINT) AS payload, l_orderkey AS region, l_partkey AS dam_id, l_quantity AS storage, count(*) AS n FROM lineitem GROUP BY ALL""")
def flatten_nested(spark, sf):
    lines = table(spark, sf, "lineitem").select(F.floor(F.col("l_orderkey") / 10).alias("payload"), "l_orderkey", F.struct(
        F.col("l_partkey").alias("DAM_ID"), F.col("l_quantity").alias("DMD_QUse")).alias("dam"))
    # the lines are counted from file footers; a payload's lines meet once, and all steps behind keep to its task
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-lines.count() // LINES_A_TASK))
    regions = lines.repartition(tasks, "payload").groupBy("payload", "l_orderkey").agg(F.collect_list("dam").alias("dams"))
    payloads = regions.groupBy("payload").agg(F.collect_list(F.struct(F.col("l_orderkey").alias("region_name"), "dams")).alias("regions"))
    flat = extract_json.flatten_nested(payloads, "regions", "dams", {"region": "region_name"},
                                       {"dam_id": "DAM_ID", "storage": "DMD_QUse"}, ["payload"])
    return flat.groupBy("payload", "region", "dam_id", "storage").agg(F.count(F.lit(1)).alias("n"))


_PROPS = """CASE event_id % 4 WHEN 0 THEN props WHEN 1 THEN replace(props, '"k"', '"K"') WHEN 2 THEN replace(props, '{', '{"k": "", ') ELSE '{"k": 0, "K": 7}' END"""


@query("""SELECT event_id, CAST(CASE event_id % 4 WHEN 2 THEN NULL WHEN 3 THEN '0' ELSE json_extract_string(props, '$.k') END AS VARCHAR) AS k,
 CASE event_id % 4 WHEN 2 THEN NULL WHEN 3 THEN '7' ELSE CASE WHEN json_extract_string(props, '$.k') = '0' THEN NULL ELSE json_extract_string(props, '$.k') END END AS k_nonzero FROM events""")
def pick(spark, sf):
    # the third spelling repeats the key; the first (empty) value is the one read
    row = F.expr(_PROPS)
    return table(spark, sf, "events").select("event_id", extract_json.pick(row, "k", "K").alias("k"),
                                             extract_json.pick(row, "k", "K", zero_is_missing=True).alias("k_nonzero"))


@query("""SELECT user_id, epoch_us(ts) // 1000 AS ts_ms, CAST(event_id % 100 AS DOUBLE) AS level, CASE WHEN event_id % 5 > 0 THEN CAST(event_id % 7 AS DOUBLE) END AS storage
 FROM events WHERE event_id % 6 > 0 AND event_id % 11 > 0""")
def explode_epoch_map(spark, sf):
    e = table(spark, sf, "events").select(
        "user_id", F.to_date("ts").alias("day"), "event_id", F.unix_millis("ts").alias("ms"))
    entry = F.concat(F.lit('"'), F.expr("CASE WHEN event_id % 6 = 0 THEN concat('x', ms) ELSE CAST(ms AS STRING) END"), F.lit('": '),
                     F.expr("""CASE WHEN event_id % 11 = 0 THEN '5' ELSE concat('{"level": ', event_id % 100, CASE WHEN event_id % 5 > 0 THEN concat(', "storage": "', event_id % 7, '"') ELSE '' END, '}') END"""))
    payloads = e.groupBy("user_id", "day").agg(
        F.concat(F.lit("{"), F.array_join(F.collect_list(entry), ", "), F.lit("}")).alias("payload"))
    return extract_json.explode_epoch_map(payloads, "payload", ["level", "storage"], ["user_id"])


@query("""SELECT o_custkey, strftime(d, '%Y-%m-%d') AS date, arg_max(v, r * 10000000000 + v) AS value, concat('a', max(r)) AS source_array FROM (
 SELECT o_custkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS d, o_orderkey AS v, unnest(CASE WHEN o_orderkey % 2 = 0 THEN [0, 1] WHEN o_orderkey % 3 = 0 THEN [0, 2] ELSE [0] END) AS r FROM orders) GROUP BY o_custkey, d""")
def overlay_arrays(spark, sf):
    point = F.struct(F.trunc("o_orderdate", "month").alias("date"), F.col("o_orderkey").alias("value"))
    def points(cond):
        return F.array_sort(F.collect_list(F.when(F.expr(cond), point)))
    feeds = table(spark, sf, "orders").groupBy("o_custkey").agg(
        points("true").alias("a0"), points("o_orderkey % 2 = 0").alias("a1"), points("o_orderkey % 2 = 1 AND o_orderkey % 3 = 0").alias("a2"))
    out = extract_json.overlay_arrays(feeds, ["a0", "a1", "a2"], ["o_custkey"])
    return out.withColumn("date", text("date"))


@query("""SELECT o_custkey, CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1 AS BIGINT) AS pos, CAST(o_orderkey AS VARCHAR) AS label,
 CAST(o_orderkey % 97 AS DOUBLE) AS rate, CASE WHEN row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) > 1 THEN CAST(o_orderkey % 89 AS DOUBLE) END AS storage FROM orders""")
def zip_series(spark, sf):
    charts = table(spark, sf, "orders").groupBy("o_custkey").agg(F.sort_array(F.collect_list("o_orderkey")).alias("k"))
    charts = charts.select("o_custkey", F.transform("k", lambda x: x.cast("string")).alias("labels"),
                           F.transform("k", lambda x: x.cast("string")).alias("labels2"),
                           F.transform("k", lambda x: (x % 97).cast("double")).alias("rates"),
                           F.transform(F.slice("k", F.lit(1), F.size("k") - 1), lambda x: (x % 89).cast("double")).alias("volumes"))
    out = extract_json.zip_series(charts, ["o_custkey"], "labels", {"rate": "rates", "storage": "volumes"}, "labels2")
    return out.withColumn("pos", F.col("pos").cast("bigint"))
