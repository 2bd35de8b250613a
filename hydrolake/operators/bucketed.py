"""Archives bucketed by key: a batch meets them without shuffling the archive.

The archive lies in a table bucketed and sorted by its keys, so its scan already has the
partitioning a join on the keys asks for. Only the batch is shuffled, to the same buckets. Each
merge writes the next version of the table, again bucketed, and switches a view to it, so readers
of the view always see one whole version.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from hydrolake.operators.merge import Merged


def _save(df: DataFrame, table: str, keys: list[str], buckets: int, folder: str | None) -> None:
    out = df.write.bucketBy(buckets, *keys).sortBy(*keys).mode("overwrite").format("parquet")
    (out.option("path", f"{folder}/{table}") if folder else out).saveAsTable(table)


def save_bucketed(df: DataFrame, table: str, keys: list[str], buckets: int, folder: str | None = None) -> None:
    """A table bucketed and sorted by ``keys``, one file per bucket; in ``folder`` instead of the
    warehouse if one is given."""
    _save(df.repartition(buckets, *keys), table, keys, buckets, folder)


def bucket_spec(spark: SparkSession, table: str) -> tuple[int, list[str]]:
    """Number of buckets of a table and the columns they go by; 0 if it has none."""
    facts = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE EXTENDED {table}").collect()}
    names = [c.strip(" `") for c in facts.get("Bucket Columns", "[]").strip("[]").split(",")]
    return int(facts.get("Num Buckets", 0)), [c for c in names if c]


def beside(batch: DataFrame, table: str) -> DataFrame:
    """The batch dealt to the buckets of a table, so that a join with it moves no row of the table."""
    buckets, columns = bucket_spec(batch.sparkSession, table)
    if not buckets:
        raise ValueError(f"{table} is not bucketed")
    return batch.repartition(buckets, *columns)


def versions(spark: SparkSession, name: str) -> list[int]:
    """Versions of an archive that exist, ascending."""
    head, _, last = name.rpartition(".")
    tables = spark.catalog.listTables(head) if head else spark.catalog.listTables()
    stem = f"{last}_v".lower()
    return sorted(int(t.name[len(stem):]) for t in tables if t.name.startswith(stem) and t.name[len(stem):].isdigit())


def create(df: DataFrame, name: str, keys: list[str], buckets: int, folder: str | None = None) -> None:
    """Start an archive: its first version and the view ``name`` over it."""
    save_bucketed(df, f"{name}_v0", keys, buckets, folder)
    df.sparkSession.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM {name}_v0")


def merge_tables(spark: SparkSession, name: str, batch: DataFrame, keys: list[str],
                 how: Callable[[DataFrame, DataFrame, list[str]], Merged | DataFrame], keep: int = 2,
                 folder: str | None = None) -> int:
    """Merge a batch (one row per key) into the archive ``name``; the number of its new version.

    ``how`` is M1, M2, M3 or alike: ``lambda old, new, keys: upsert(old, new, keys, volatile)``. The
    joined rows are in their buckets already, so the write moves nothing either. Versions older
    than the last ``keep`` are dropped after the switch.
    """
    last = versions(spark, name)[-1]
    buckets, columns = bucket_spec(spark, f"{name}_v{last}")
    out = how(spark.table(f"{name}_v{last}"), beside(batch, f"{name}_v{last}"), keys)
    rows = out.rows.drop("merge_action") if isinstance(out, Merged) else out
    _save(rows, f"{name}_v{last + 1}", columns, buckets, folder)
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM {name}_v{last + 1}")
    for v in versions(spark, name)[:-keep]:
        spark.sql(f"DROP TABLE {name}_v{v}")
    return last + 1
