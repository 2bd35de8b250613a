"""Archives that readers see whole: batch folders, and a head that says which of them count.

A merge writes the partitions it touches into a folder of its own (``data/batch=7/date=...``) and
then a head (``heads/7``), a small table of all partition folders and the batch each is read from.
A head counts once its write has committed, so a reader takes the newest complete head and never
sees half a merge; a writer that dies leaves files no head names, and its next attempt overwrites
them. One writer at a time, as a stream or a scheduled job is.

Partition values are those of one column; the driver handles one name per partition, as Spark
does for any partitioned table.
"""

from __future__ import annotations

import datetime as dt
from typing import NamedTuple

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F, types as T

from hydrolake.operators.merge import action_counts, path_exists, revisions, upsert
from hydrolake.session import local_table


class Published(NamedTuple):
    """Number of the new head, counts of the merge actions, and rows left out of it (or None)."""
    number: int
    counts: dict[str, int]
    late: DataFrame | None


def _fs(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none if it does not exist."""
    fs, target = _fs(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(target)) if fs.exists(target) else []


def delete_path(spark: SparkSession, path: str) -> None:
    fs, target = _fs(spark, path)
    fs.delete(target, True)


def _folder(spark: SparkSession, partition: str, value: str | None) -> str:
    """The folder Spark writes a partition value to."""
    return spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.getPartitionPathString(partition, value)


def _value(spark: SparkSession, folder: str) -> str | None:
    text = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName(folder.split("=", 1)[1])
    return None if text == "__HIVE_DEFAULT_PARTITION__" else text


def heads(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the complete heads, ascending."""
    return sorted(int(n) for n in child_names(spark, f"{path}/heads") if path_exists(spark, f"{path}/heads/{n}/_SUCCESS"))


def head(spark: SparkSession, path: str, number: int) -> dict[str, int]:
    """Partition folder to the batch it is read from."""
    return {r.folder: r.batch for r in spark.read.schema("folder string, batch bigint").parquet(f"{path}/heads/{number}").collect()}


def _rows(spark: SparkSession, path: str, folders: dict[str, int], schema: T.StructType) -> DataFrame:
    """Rows of some partition folders; none of the others is even listed."""
    if not folders:
        return spark.createDataFrame([], schema)
    places = [f"{path}/data/batch={batch}/{folder}" for folder, batch in sorted(folders.items())]
    return spark.read.schema(schema).option("basePath", f"{path}/data").parquet(*places).select(*[F.col(f"`{c}`") for c in schema.names])


def read_archive(spark: SparkSession, path: str, schema: T.StructType | str, low: str | None = None,
                 high: str | None = None, number: int | None = None) -> DataFrame:
    """The archive as of its newest complete head, or of an earlier one that is still kept.

    ``low`` and ``high`` bound the partition values as text (ISO dates); folders outside are not listed.
    """
    kind = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    known = heads(spark, path)
    if not known:
        return spark.createDataFrame([], kind)
    folders = head(spark, path, known[-1] if number is None else number)
    if low is not None or high is not None:
        value = {f: _value(spark, f) for f in folders}
        folders = {f: b for f, b in folders.items() if value[f] is not None and (low is None or value[f] >= low) and (high is None or value[f] <= high)}
    return _rows(spark, path, folders, kind)


def publish_merge(spark: SparkSession, path: str, new: DataFrame, keys: list[str], partition: str,
                  volatile: list[str] | None = None, window_days: int | None = None, keep: int = 2) -> Published:
    """M1 on storage, published as a whole: merge ``new`` (one row per key) and switch heads.

    Only partitions of the batch are read and rewritten; the partition must be one of the keys. The
    action counts are observed by the write itself. With ``window_days`` rows dated before the newest
    day (held or brought) by more than that stay out, and those that would have added or changed
    something come back in ``late`` with a ``kind`` (``new`` or ``revised``); an empty archive takes
    everything, and a null date is never late. The last ``keep`` heads stay readable.
    """
    if partition not in keys:
        raise ValueError(f"{partition} must be one of the keys {keys}")
    new = new.persist()  # read for its partitions and its rows
    try:
        return _publish(spark, path, new, keys, partition, volatile, window_days, keep)
    finally:
        new.unpersist()


def _publish(spark: SparkSession, path: str, new: DataFrame, keys: list[str], partition: str, volatile: list[str] | None,
             window_days: int | None, keep: int) -> Published:
    known = heads(spark, path)
    held = head(spark, path, known[-1]) if known else {}
    number = known[-1] + 1 if known else 0
    late = None
    brought = [r[0] for r in new.select(F.col(partition).cast("string")).distinct().collect()]
    if window_days is not None and held:
        newest = max(v for v in [*(_value(spark, f) for f in held), *brought, ""] if v is not None)
        if newest:
            edge = str(dt.date.fromisoformat(newest[:10]) - dt.timedelta(days=window_days))
            old = {v for v in brought if v is not None and v < edge}
            brought = [v for v in brought if v not in old]
            if old:
                day = F.col(partition).cast("string")
                behind = new.where(day < edge)
                there = _rows(spark, path, {f: held[f] for f in (_folder(spark, partition, v) for v in old) if f in held}, new.schema)
                drop = volatile or []
                late = behind.join(revisions(there.drop(*drop), behind.drop(*drop), keys), keys)
                new = new.where(F.coalesce(day >= edge, F.lit(True)))
    touched = [_folder(spark, partition, v) for v in brought]
    if not touched:
        return Published(number - 1, dict.fromkeys(("added", "updated", "unchanged", "kept"), 0), late)
    merged = upsert(_rows(spark, path, {f: held[f] for f in touched if f in held}, new.schema), new, keys, volatile).rows
    seen = Observation()
    # counted behind the last shuffle: a lost executor repeats no finished task of the write
    out = merged.hint("rebalance", F.col(partition)).sortWithinPartitions(*keys).observe(seen, *action_counts())
    out.drop("merge_action").write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(partition).parquet(f"{path}/data/batch={number}")
    now = held | dict.fromkeys(touched, number)
    local_table(spark, sorted(now.items()), "folder string, batch bigint").coalesce(1).write.mode("overwrite").parquet(f"{path}/heads/{number}")
    prune(spark, path, keep)
    return Published(number, seen.get, late)


def prune(spark: SparkSession, path: str, keep: int = 2) -> None:
    """Drop all but the last ``keep`` heads, and the partition folders that only they named."""
    known = heads(spark, path)
    gone, stay = known[:-keep], known[-keep:]
    if not gone:
        return
    named = {item for n in stay for item in head(spark, path, n).items()}
    for folder, batch in {item for n in gone for item in head(spark, path, n).items()} - named:
        delete_path(spark, f"{path}/data/batch={batch}/{folder}")
    for n in gone:
        delete_path(spark, f"{path}/heads/{n}")
