"""Cell functions for SQL users: session functions, made from the column functions themselves.

Each is built once as a column, printed as SQL by Spark, and registered under a name, so there is
one definition of every rule. Functions that work on arrays with lambdas (multi-format dates, page
text) have no SQL text and are used from Python.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, SparkSession, functions as F

from hydrolake import functions as P
from hydrolake.functions._base import inlined

#: name -> (arguments, column function)
FUNCTIONS: dict[str, tuple[str, Callable[..., Column]]] = {
    **{f.__name__: ("x STRING", f) for f in (
        P.clean_cell, P.num_thousands, P.num_int_or_float, P.num_first, P.num_leading, P.num_decimal_comma, P.num_space_thousands,
        P.num_strip, P.num_hash, P.clean_text, P.norm_lower, P.strip, P.strip_accents, P.drop_bidi_marks, P.slug_lower, P.slug_upper,
        P.match_key, P.cell_date, P.parse_dmy, P.parse_ymd_loose, P.parse_period)},
    "make_id": ("p STRING, x STRING", lambda p, x: F.concat_ws("_", p, P.slug_lower(x))),
    "is_integer": ("v DOUBLE", P.is_integer),
    "fmt_number": ("v DOUBLE", P.fmt_number),
    "pct_full": ("storage DOUBLE, capacity DOUBLE", P.pct_full),
    "volume_from_pct": ("capacity DOUBLE, pct DOUBLE", P.volume_from_pct),
    "epoch_ms_to_date": ("ms BIGINT", P.epoch_ms_to_date),
    "monday_of": ("d DATE", P.monday_of),
    "pad_month": ("d DATE", P.pad_month),
    "resolve_year": ("x STRING, anchor DATE", lambda x, anchor: P.resolve_year(x, anchor, 0, "MMM-d")),
}


def definition(spark: SparkSession, name: str) -> tuple[str, str, str]:
    """Arguments, result type and SQL body of a function."""
    arguments, fn = FUNCTIONS[name]
    parts = [a.split() for a in arguments.split(", ")]
    row = spark.sql("SELECT " + ", ".join(f"CAST(NULL AS {kind}) AS {arg}" for arg, kind in parts))
    with inlined():
        made = row.select(fn(*[F.col(arg) for arg, _ in parts]).alias("out"))
    body = made._jdf.queryExecution().analyzed().expressions().head().sql().removesuffix(" AS out")
    if "lambdafunction" in body:
        raise ValueError(f"{name} has no SQL text")
    return arguments, made.schema["out"].dataType.simpleString(), body


def register(spark: SparkSession, prefix: str = "hl_") -> list[str]:
    """Define the functions in the session; returns their names."""
    for name in FUNCTIONS:
        arguments, kind, body = definition(spark, name)
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {prefix}{name}({arguments}) RETURNS {kind} RETURN {body}")
    return [prefix + n for n in FUNCTIONS]
