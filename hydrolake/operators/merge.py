"""M1-M7: merging new readings into an archive.

Keys are unique on each side (collapse a batch first), so the full outer join
spreads evenly; neither side can have a hot key.
"""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from hydrolake.functions._base import blank_to_null


class Merged(NamedTuple):
    """``rows`` carries ``merge_action``; ``stats`` counts the actions.

    Both are lazy and each is a job; :func:`counted` gives both from one.
    """
    rows: DataFrame
    stats: DataFrame


def collapse(new: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """M7: last row per key inside a batch."""
    rest = [c for c in new.columns if c not in keys]
    picked = F.max_by(F.struct(*rest), F.struct(*order))
    return new.groupBy(*keys).agg(picked.alias("__row")).select(*keys, "__row.*").select(*new.columns)


def _paired(old: DataFrame, new: DataFrame, keys: list[str]) -> tuple[DataFrame, list[str]]:
    rest = [c for c in old.columns if c not in keys]
    o = old.select(*keys, F.struct(*rest).alias("__old"))
    n = new.select(*keys, F.struct(*[F.col(c).cast(old.schema[c].dataType).alias(c) for c in rest])
                   .alias("__new"))
    return o.join(n, keys, "full_outer"), rest


def _same(cols: list[str]) -> Column:
    pairs = [F.col(f"__old.`{c}`").eqNullSafe(F.col(f"__new.`{c}`")) for c in cols]
    return reduce(lambda a, b: a & b, pairs, F.lit(True))


def action_counts() -> list[Column]:
    """Counts of the merge actions, for an aggregation or for metrics observed by a write."""
    return [F.count(F.when(F.col("merge_action") == a, 1)).alias(a) for a in ("added", "updated", "unchanged", "kept")]


def _stats(rows: DataFrame) -> DataFrame:
    return rows.agg(*action_counts())


def counted(merged: Merged) -> tuple[DataFrame, Observation]:
    """The rows of a merge and their action counts from one job: the write of the rows observes them.

    Put it last before the write (``observation.get`` then has the counts); behind a shuffle a
    task that a lost executor makes run again could count twice.
    """
    seen = Observation()
    return merged.rows.observe(seen, *action_counts()), seen


def _finish(joined: DataFrame, keys: list[str], rest: list[str], action: Column) -> Merged:
    new_wins = F.col("merge_action").isin("added", "updated")
    rows = joined.withColumn("merge_action", action)
    rows = rows.select(*keys, *[F.when(new_wins, F.col(f"__new.`{c}`")).otherwise(F.col(f"__old.`{c}`"))
                                .alias(c) for c in rest], "merge_action")
    return Merged(rows, _stats(rows))


def upsert(old: DataFrame, new: DataFrame, keys: list[str], volatile: list[str] | None = None) -> Merged:
    """M1: new rows win by key; a row equal apart from volatile columns stays untouched."""
    joined, rest = _paired(old, new, keys)
    stable = [c for c in rest if c not in (volatile or [])]
    action = F.when(F.col("__old").isNull(), "added").when(F.col("__new").isNull(), "kept") \
        .when(_same(stable), "unchanged").otherwise("updated")
    return _finish(joined, keys, rest, action)


def upsert_ranked(old: DataFrame, new: DataFrame, keys: list[str], rank_col: str,
                  ranks: dict[str, int], volatile: list[str] | None = None) -> Merged:
    """M2: like :func:`upsert`, but a weaker kind never replaces a stronger one.

    Kinds of equal rank behave as in :func:`upsert`; kinds not listed rank 0.
    """
    def rank(side: str) -> Column:
        kind = F.col(f"{side}.`{rank_col}`")
        return reduce(lambda acc, kv: F.when(kind == kv[0], F.lit(kv[1])).otherwise(acc),
                      ranks.items(), F.lit(0))

    joined, rest = _paired(old, new, keys)
    stable = [c for c in rest if c not in (volatile or [])]
    action = F.when(F.col("__old").isNull(), "added").when(F.col("__new").isNull(), "kept") \
        .when((rank("__new") < rank("__old")) | _same(stable), "unchanged").otherwise("updated")
    return _finish(joined, keys, rest, action)


def overlay(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """M3: non-empty new fields replace, empty ones leave the old value."""
    joined, rest = _paired(old, new, keys)

    def newest(c: str) -> Column:
        fresh = F.col(f"__new.`{c}`")
        if dict(old.dtypes)[c] == "string":
            fresh = blank_to_null(fresh)
        return F.coalesce(fresh, F.col(f"__old.`{c}`")).alias(c)

    return joined.select(*keys, *[newest(c) for c in rest])


def upsert_full(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """M4: new rows replace whole rows, ids not seen this time survive."""
    kept = old.join(new.select(*keys).distinct(), keys, "left_anti")
    return kept.unionByName(new)


def append_closed(old: DataFrame, new: DataFrame, date: str, today: Column) -> DataFrame:
    """M5: a date already held is closed; only today's may be written again."""
    held = old.select(date).distinct().where(F.col(date) != today)
    fresh = new.join(held, date, "left_anti")
    # today's old rows go only if the batch brings today's rows
    reopened = new.where(F.col(date) == today).select(date).distinct()
    kept = old.join(reopened, date, "left_anti")
    return kept.unionByName(fresh)


def revisions(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """M6: keys that are new or whose row changed."""
    joined, rest = _paired(old, new, keys)
    kind = F.when(F.col("__new").isNull(), None).when(F.col("__old").isNull(), "new") \
        .when(~_same(rest), "revised")
    return joined.select(*keys, kind.alias("kind")).where("kind is not null")


def path_exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def touched_partitions(archive: DataFrame, new: DataFrame, partition: str) -> DataFrame:
    """The archive's rows in partitions of the batch; a null partition counts as one."""
    low, high, nulls = new.agg(F.min(partition), F.max(partition), F.max(F.col(partition).isNull())).first()
    p, kind = F.col(partition), new.schema[partition].dataType
    inside = p.between(F.lit(low).cast(kind), F.lit(high).cast(kind)) if low is not None else F.lit(False)
    days = new.select(F.col(partition).alias("__p")).distinct()
    return archive.where(inside | p.isNull() if nulls else inside).join(days, p.eqNullSafe(F.col("__p")), "left_semi")


def merge_into_path(spark: SparkSession, path: str, new: DataFrame, keys: list[str],
                    partition: str, volatile: list[str] | None = None) -> None:
    """M1 on storage: rewrite only the partitions the batch touches.

    The batch's smallest and largest partition value bound the archive scan as a
    literal range, the semi join keeps only the touched partitions of it, and the
    dynamic overwrite leaves the others alone. The partition must be part of the
    key: a key that moved would leave its old row behind. The batch is collapsed
    to unique keys by the caller.
    """
    if partition not in keys:
        raise ValueError(f"{partition} must be one of the keys {keys}")
    new = new.persist()  # read for its bounds, its partitions and its rows
    try:
        if not path_exists(spark, path):
            rows = new
        else:
            touched = touched_partitions(spark.read.schema(new.schema).parquet(path), new, partition)
            rows = upsert(touched.select(*new.columns), new, keys, volatile).rows.drop("merge_action")
        (rows.hint("rebalance", F.col(partition)).sortWithinPartitions(*keys)
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(partition).parquet(path))
    finally:
        new.unpersist()
