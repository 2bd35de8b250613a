"""Printed numbers and derived measures."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from hydrolake.functions._base import col


def fmt_number(c: Column | str, digits: int = 3) -> Column:
    """Round and print without trailing zeros; null prints as ''.

    Ties at the last digit round up on the decimal text of the number; with no
    digits they round to even.
    """
    c = col(c)
    if digits <= 0:
        text = F.bround(c, 0).cast("decimal(38,0)").cast("string")
    else:
        fixed_point = F.round(c.cast(f"decimal(38,{digits + 8})"), digits).cast("string")
        text = F.regexp_replace(fixed_point, r"\.?0+$", "")
        # a number without a fraction keeps its own zeros
        text = F.when(fixed_point.rlike(r"\.0+$"), F.regexp_extract(fixed_point, r"^(-?\d+)", 1)) \
            .otherwise(text)
        text = F.when(text == "-0", F.lit("0")).otherwise(text)
    return F.coalesce(text, F.lit(""))


def pct_full(storage: Column | str, capacity: Column | str) -> Column:
    """Storage as percent of capacity; null unless the capacity is positive."""
    storage, capacity = col(storage), col(capacity)
    return F.when(capacity > 0, storage / capacity * 100)


def volume_from_pct(capacity: Column | str, pct: Column | str) -> Column:
    return col(capacity) * col(pct) / 100
