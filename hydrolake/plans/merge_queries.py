"""M1-M7: orders are the archive, an altered copy of them is the new batch."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from hydrolake.operators import bucketed, merge
from hydrolake.plans.registry import query, table, text
from hydrolake.session import scratch_path

_OLD = """SELECT o_orderkey, o_custkey, o_orderstatus, 'run1' AS fetched_at FROM orders WHERE o_orderpriority <> '5-LOW'"""
_NEW = """SELECT o_orderkey, CASE WHEN o_orderkey % 6 = 0 THEN o_custkey + 1 ELSE o_custkey END AS o_custkey, o_orderstatus, 'run2' AS fetched_at
 FROM orders WHERE o_orderpriority <> '1-URGENT'"""
_MERGED = f"""(SELECT coalesce(n.o_orderkey, o.o_orderkey) AS o_orderkey,
 CASE WHEN o.o_orderkey IS NULL THEN 'added' WHEN n.o_orderkey IS NULL THEN 'kept' WHEN n.o_custkey = o.o_custkey AND n.o_orderstatus = o.o_orderstatus THEN 'unchanged' ELSE 'updated' END AS merge_action,
 o.o_custkey AS oc, n.o_custkey AS nc, o.o_orderstatus AS os, n.o_orderstatus AS ns FROM ({_OLD}) o FULL JOIN ({_NEW}) n USING (o_orderkey))"""
_WINS = "merge_action IN ('added', 'updated')"


def _sides(spark, sf):
    orders = table(spark, sf, "orders")
    old = orders.where("o_orderpriority <> '5-LOW'").select("o_orderkey", "o_custkey", "o_orderstatus", F.lit("run1").alias("fetched_at"))
    new = orders.where("o_orderpriority <> '1-URGENT'").select(
        "o_orderkey", F.expr("CASE WHEN o_orderkey % 6 = 0 THEN o_custkey + 1 ELSE o_custkey END").alias("o_custkey"),
        "o_orderstatus", F.lit("run2").alias("fetched_at"))
    return old, new


@query(f"""SELECT o_orderkey, CASE WHEN {_WINS} THEN nc ELSE oc END AS o_custkey, CASE WHEN {_WINS} THEN ns ELSE os END AS o_orderstatus,
 CASE WHEN {_WINS} THEN 'run2' ELSE 'run1' END AS fetched_at, merge_action FROM {_MERGED}""")
def upsert(spark, sf):
    old, new = _sides(spark, sf)
    return merge.upsert(old, new, ["o_orderkey"], ["fetched_at"]).rows


@query(f"""SELECT count(*) FILTER (merge_action = 'added') AS added, count(*) FILTER (merge_action = 'updated') AS updated,
 count(*) FILTER (merge_action = 'unchanged') AS unchanged, count(*) FILTER (merge_action = 'kept') AS kept FROM {_MERGED}""")
def upsert_stats(spark, sf):
    old, new = _sides(spark, sf)
    return merge.upsert(old, new, ["o_orderkey"], ["fetched_at"]).stats


_COUNTS = f"""SELECT count(*) FILTER (merge_action = 'added') AS added, count(*) FILTER (merge_action = 'updated') AS updated,
 count(*) FILTER (merge_action = 'unchanged') AS unchanged, count(*) FILTER (merge_action = 'kept') AS kept FROM {_MERGED}"""


@query(f"SELECT * FROM ({_COUNTS}), (SELECT count(*) AS n_rows FROM {_MERGED})")
def upsert_observed(spark, sf):
    """The merged rows are written once; their counts come with that write."""
    old, new = _sides(spark, sf)
    rows, seen = merge.counted(merge.upsert(old, new, ["o_orderkey"], ["fetched_at"]))
    path = scratch_path(spark, "merged")
    rows.write.parquet(path)
    n = F.count(F.lit(1)).alias("n_rows")
    return spark.read.parquet(path).agg(n).select(*[F.lit(c).cast("bigint").alias(a) for a, c in seen.get.items()], "n_rows")


@query(f"""SELECT o_orderkey, CASE WHEN {_WINS} THEN nc ELSE oc END AS o_custkey, CASE WHEN {_WINS} THEN ns ELSE os END AS o_orderstatus,
 CASE WHEN {_WINS} THEN 'run2' ELSE 'run1' END AS fetched_at FROM {_MERGED}""")
def upsert_bucketed(spark, sf):
    """The archive lies bucketed by key; only the batch is shuffled."""
    old, new = _sides(spark, sf)
    name, folder = f"orders_{uuid.uuid4().hex}", scratch_path(spark, "bucketed")
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    bucketed.create(old, name, ["o_orderkey"], buckets, folder)
    last = bucketed.merge_tables(spark, name, new, ["o_orderkey"], lambda a, b, k: merge.upsert(a, b, k, ["fetched_at"]), folder=folder)
    spark.sql(f"DROP VIEW {name}")
    for v in bucketed.versions(spark, name):  # the catalog forgets them, the files stay
        spark.sql(f"DROP TABLE {name}_v{v}")
    return spark.read.parquet(f"{folder}/{name}_v{last}")


@query("""SELECT o_orderkey, CASE WHEN wins THEN n_kind ELSE o_kind END AS kind, CASE WHEN wins THEN o_custkey + 1 ELSE o_custkey END AS value, merge_action FROM (
 SELECT o_orderkey, o_custkey, o_kind, n_kind, CASE WHEN o_kind = 'current' AND n_kind <> 'current' THEN 'unchanged' ELSE 'updated' END AS merge_action,
 NOT (o_kind = 'current' AND n_kind <> 'current') AS wins FROM (
 SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 2 = 0 THEN 'current' ELSE 'previous_week' END AS o_kind,
 CASE WHEN o_orderkey % 3 = 0 THEN 'current' ELSE 'previous_week' END AS n_kind FROM orders))""")
def upsert_ranked(spark, sf):
    orders = table(spark, sf, "orders")
    kind = lambda n: F.expr(f"CASE WHEN o_orderkey % {n} = 0 THEN 'current' ELSE 'previous_week' END").alias("kind")
    old = orders.select("o_orderkey", kind(2), F.col("o_custkey").alias("value"))
    new = orders.select("o_orderkey", kind(3), (F.col("o_custkey") + 1).alias("value"))
    return merge.upsert_ranked(old, new, ["o_orderkey"], "kind", {"previous_week": 1, "current": 2}).rows


@query("""SELECT c_custkey, CASE WHEN c_mktsegment = 'BUILDING' OR c_custkey % 3 > 0 THEN c_name ELSE concat(c_name, '*') END AS c_name,
 CASE WHEN c_mktsegment = 'BUILDING' OR c_custkey % 5 = 0 THEN c_mktsegment ELSE 'NEW' END AS c_mktsegment FROM customer""")
def overlay(spark, sf):
    old = table(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment")
    new = old.where("c_mktsegment <> 'BUILDING'").select(
        "c_custkey", F.expr("CASE WHEN c_custkey % 3 > 0 THEN '' ELSE concat(c_name, '*') END").alias("c_name"),
        F.expr("CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE 'NEW' END").alias("c_mktsegment"))
    return merge.overlay(old, new, ["c_custkey"])


@query("""SELECT s_suppkey, CASE WHEN s_nationkey >= 10 THEN 'again' ELSE s_name END AS s_name FROM supplier""")
def upsert_full(spark, sf):
    supplier = table(spark, sf, "supplier")
    old = supplier.where("s_nationkey < 15").select("s_suppkey", "s_name")
    new = supplier.where("s_nationkey >= 10").select("s_suppkey", F.lit("again").alias("s_name"))
    return merge.upsert_full(old, new, ["s_suppkey"])


_OPEN = "CAST(o_orderdate AS DATE)"


@query(f"""WITH o AS (SELECT o_orderkey, {_OPEN} AS d, 'old' AS side FROM orders WHERE o_orderdate <= DATE '1998-06-15' AND (o_orderstatus = 'F' OR o_orderdate < DATE '1998-01-01')),
 n AS (SELECT o_orderkey, {_OPEN} AS d, 'new' AS side FROM orders WHERE o_orderdate >= DATE '1998-01-01')
 SELECT o_orderkey, strftime(d, '%Y-%m-%d') AS d, side FROM o WHERE d <> DATE '1998-06-15' OR NOT EXISTS (SELECT 1 FROM n WHERE n.d = DATE '1998-06-15')
 UNION ALL SELECT o_orderkey, strftime(d, '%Y-%m-%d'), side FROM n WHERE d = DATE '1998-06-15' OR d NOT IN (SELECT d FROM o)""")
def append_closed(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", F.to_date("o_orderdate").alias("d"))
    today = F.lit("1998-06-15").cast("date")
    old = orders.where((F.col("d") <= today) & F.expr("o_orderstatus = 'F' OR d < DATE '1998-01-01'")).drop("o_orderstatus").withColumn("side", F.lit("old"))
    new = orders.where("d >= DATE '1998-01-01'").drop("o_orderstatus").withColumn("side", F.lit("new"))
    return merge.append_closed(old, new, "d", today).withColumn("d", text("d"))


@query(f"SELECT o_orderkey, CASE merge_action WHEN 'added' THEN 'new' ELSE 'revised' END AS kind FROM {_MERGED} WHERE {_WINS}")
def revisions(spark, sf):
    old, new = _sides(spark, sf)
    return merge.revisions(old.drop("fetched_at"), new.drop("fetched_at"), ["o_orderkey"])


@query("""SELECT l_orderkey, l_suppkey, l_linenumber, l_partkey FROM lineitem
 QUALIFY row_number() OVER (PARTITION BY l_suppkey ORDER BY l_orderkey DESC, l_linenumber DESC, l_partkey DESC) = 1""")
def collapse(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_suppkey", "l_linenumber", "l_partkey")
    return merge.collapse(lines, ["l_suppkey"], ["l_orderkey", "l_linenumber", "l_partkey"])
