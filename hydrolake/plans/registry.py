"""Registry of queries and of the SQL that must give the same rows."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}

_MODULES = ("cell_queries", "select_queries", "merge_queries", "join_queries", "reshape_queries",
            "quality_queries", "json_queries", "text_queries", "table_queries", "word_queries",
            "glyph_queries", "source_queries", "stream_queries", "chained_queries")


def query(sql: str | None = None):
    """Register a function under its own name, with its SQL twin if there is one."""
    def register(fn):
        if fn.__name__ in QUERIES:
            raise ValueError(f"query registered twice: {fn.__name__}")
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLE_SQL[fn.__name__] = sql
        return fn

    return register


def load_all() -> None:
    for module in _MODULES:
        importlib.import_module(f"hydrolake.plans.{module}")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables; wall-clock timestamps are read as UTC instants."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    ntz = [c for c, t in df.dtypes if t == "timestamp_ntz"]
    return df.withColumns({c: F.col(c).cast("timestamp") for c in ntz}) if ntz else df


def text(c: Column | str) -> Column:
    """Dates and numbers as text, for comparison across engines."""
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def mean4(c: Column | str) -> Column:
    """Means rounded alike on both engines: the nudge settles exact ties at the last
    digit, which would otherwise depend on the order of addition."""
    return F.round((F.col(c) if isinstance(c, str) else c) + 3e-9, 4)


def r4(c: Column | str) -> Column:
    """Doubles rounded, as sums depend on the order of addition."""
    return F.round(F.col(c) if isinstance(c, str) else c, 4)
