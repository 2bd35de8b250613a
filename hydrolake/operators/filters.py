"""Filters and predicates."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, functions as F

from hydrolake.functions import fixed
from hydrolake.functions._base import col
from hydrolake.functions.text import strip


def gate(df: DataFrame, bounds: DataFrame, variable: str = "variable",
         value: str = "value") -> DataFrame:
    """Keep values inside their variable's ``lo..hi``; unbounded variables pass.

    ``bounds`` is a small ``(variable, lo, hi)`` table with one row per variable.
    """
    limits = bounds.select(F.col("variable").alias("__variable"), "lo", "hi")
    inside = F.col("lo").isNull() | F.col(value).between(F.col("lo"), F.col("hi"))
    return (df.join(limits, F.col(variable) == F.col("__variable"), "left")
            .where(inside).drop("__variable", "lo", "hi"))


def is_entity_name(name: Column | str, tokens: Iterable[str] = fixed.AGGREGATE_TOKENS_EN,
                   min_length: int = 3) -> Column:
    """False for totals, headings and fragments."""
    name = col(name)
    alternation = "|".join(t.replace("-", r"\-") for t in tokens)
    return (F.length(name) >= min_length) & ~name.rlike(alternation)


def drop_aggregate_rows(df: DataFrame, name: str,
                        tokens: Iterable[str] = fixed.AGGREGATE_TOKENS_EN,
                        min_length: int = 3) -> DataFrame:
    return df.where(is_entity_name(name, tokens, min_length))


def within_dates(df: DataFrame, date: str, start, end) -> DataFrame:
    """Inclusive date range on the bare column, so that it reaches the scan."""
    return df.where((F.col(date) >= F.lit(start)) & (F.col(date) < F.lit(end) + F.expr("interval 1 day")))


def keep_explicit_false(df: DataFrame, flag: str) -> DataFrame:
    """Rows whose flag is exactly false; unknown (null) is refused too."""
    return df.where(~F.col(flag))


TIME_TEXT = r"^(\d{2}-\d{2})\s+(\d{2}:\d{2})$"
NUMERIC_TEXT = r"^[-+]?(?:\d+\.\d+|\d+)$"


def looks_numeric(c: Column | str) -> Column:
    return strip(c).rlike(NUMERIC_TEXT)


def looks_like_change(c: Column | str) -> Column:
    return strip(c).isin(*fixed.CHANGE_PLACEHOLDERS) | looks_numeric(c)


def confident_rows(df: DataFrame, run_date: Column, texts: Iterable[str], time: str,
                   level: str, change: str) -> DataFrame:
    """Recovered rows to trust: all text fields filled, a time within a day of
    the run, a numeric level, and a change that is blank, a placeholder or a number."""
    filled = [F.coalesce(strip(t), F.lit("")) != "" for t in texts]
    month_day = F.regexp_extract(F.coalesce(F.col(time), F.lit("")), TIME_TEXT, 1)
    near = [F.date_format(F.date_add(run_date, k), "MM-dd") for k in (-1, 0, 1)]
    blank_change = F.coalesce(strip(change), F.lit("")) == ""
    keep = month_day.isin(*near) & F.coalesce(looks_numeric(level), F.lit(False)) \
        & (blank_change | looks_like_change(change))
    for ok in filled:
        keep = keep & ok
    return df.where(keep)
