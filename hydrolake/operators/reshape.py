"""Set operations, reshaping, variables and units."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from hydrolake.functions.names import parse_header
from hydrolake.session import local_table


def union_sources(frames: list[DataFrame]) -> DataFrame:
    """Stack sources by column name; columns a source lacks are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def id_union(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """R2: ids of either side."""
    return left.select(key).union(right.select(key)).distinct()


def id_minus(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """R2: ids of the left side only."""
    return left.select(key).subtract(right.select(key))


def to_long(df: DataFrame, ids: list[str], variables: list[str] | None = None) -> DataFrame:
    """Wide snapshot to long; blanks dropped, header split into gloss and unit."""
    variables = variables or [c for c in df.columns if c not in ids]
    # headers are parsed once per column, not once per value
    headers = local_table(df.sparkSession, [(v,) for v in variables], "variable_original string")
    header = parse_header("variable_original")
    headers = headers.select("variable_original", header["gloss"].alias("variable_gloss"), header["unit"].alias("unit"))
    long = df.unpivot(ids, variables, "variable_original", "value").where("value is not null")
    return long.join(headers, "variable_original").select(
        *ids, "variable_original", "variable_gloss", "unit", "value")


def to_wide(df: DataFrame, ids: list[str], variable: str, value: str, variables: list[str]) -> DataFrame:
    """Long to wide for a given list of variables (one value per cell)."""
    return df.groupBy(*ids).pivot(variable, variables).agg(F.max(value))


def rename_variables(df: DataFrame, mapping: DataFrame, variable: str = "variable") -> DataFrame:
    """Rename by an ``(old, new)`` table; variables without a row are dropped."""
    table = mapping.select(F.col("old").alias("__old"), F.col("new").alias("__new"))
    return (df.join(table, F.col(variable) == F.col("__old"))
            .withColumn(variable, F.col("__new")).drop("__old", "__new"))


def normalise(long: DataFrame, variable_map: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Standard variables and units; returns the rows and what has no mapping.

    ``variable_map``: ``country, variable_original, standard_variable, unit_factor``.
    """
    on = ["country", "variable_original"]
    rows = (long.join(variable_map.select(*on, "standard_variable", "unit_factor"), on)
            .withColumn("value", F.col("value") * F.col("unit_factor"))
            .drop("unit_factor", "variable_original"))
    unmapped = (long.groupBy(*on).agg(F.count(F.lit(1)).alias("n"))
                .join(variable_map.select(*on), on, "left_anti"))
    return rows, unmapped


def to_daily(df: DataFrame, keys: list[str], ts: str, variable: str, value: str,
             summed: list[str]) -> DataFrame:
    """Daily sum for the listed variables, daily mean for all others."""
    days = df.groupBy(*keys, variable, F.to_date(ts).alias("date")).agg(
        F.sum(value).alias("__sum"), F.avg(value).alias("__mean"), F.count(value).alias("n"))
    picked = F.when(F.col(variable).isin(*summed), F.col("__sum")).otherwise(F.col("__mean"))
    return days.withColumn(value, picked).drop("__sum", "__mean")


def date_by_variable(df: DataFrame, days_back: DataFrame, date: str,
                     variable: str = "variable") -> DataFrame:
    """Flows of a bulletin belong to the day before, states to its own day.

    ``days_back``: ``variable, days``; variables without a row keep the date.
    """
    table = days_back.select(F.col("variable").alias("__variable"), F.col("days").alias("__days"))
    shifted = F.date_sub(F.col(date), F.coalesce(F.col("__days"), F.lit(0)))
    return (df.join(table, F.col(variable) == F.col("__variable"), "left")
            .withColumn(date, shifted).drop("__variable", "__days"))
