"""Semi-structured payloads to rows. Nothing here shuffles except X4."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from hydrolake.functions._base import col, let
from hydrolake.functions.numbers import num_leading


def flatten_nested(df: DataFrame, groups: str, children: str, parent_cols: dict[str, str],
                   child_cols: dict[str, str], keep: list[str] | None = None) -> DataFrame:
    """``groups[].children[]`` to one row per child with parent fields carried down.

    ``parent_cols`` and ``child_cols`` map output names to field names.
    """
    keep = keep or []
    outer = df.select(*keep, F.explode(groups).alias("__g"))
    inner = outer.select(*keep, *[F.col(f"__g.{f}").alias(o) for o, f in parent_cols.items()],
                         F.explode(f"__g.{children}").alias("__c"))
    return inner.select(*keep, *parent_cols, *[F.col(f"__c.{f}").alias(o) for o, f in child_cols.items()])


def pick(row: Column | str, *names: str, zero_is_missing: bool = False) -> Column:
    """First non-empty of several spellings of a field in a JSON object.

    ``zero_is_missing`` also skips a bare JSON 0 (or false), as some feeds want.
    """
    falsy = ["", "null"] + (["0", "0.0", "false"] if zero_is_missing else [])

    def first(fields: Column) -> Column:
        found = [F.try_element_at(fields, F.lit(n)) for n in names]
        return F.coalesce(*[F.when(~x.isin(*falsy), x) for x in found])

    return let(F.from_json(col(row), "map<string,string>"), first)


def explode_epoch_map(df: DataFrame, payload: str, fields: list[str], keep: list[str]) -> DataFrame:
    """``{"epoch_ms": {...}}`` to rows; bad keys and non-object values are dropped."""
    rows = df.select(*keep, F.explode(F.from_json(payload, "map<string,string>")).alias("__k", "__v"))
    rows = rows.withColumn("ts_ms", F.trim("__k").try_cast("bigint"))
    rows = rows.where(F.col("ts_ms").isNotNull() & F.col("__v").startswith("{"))
    return rows.select(*keep, "ts_ms", *[
        num_leading(F.get_json_object("__v", f"$.{f}")).alias(f) for f in fields])


def overlay_arrays(df: DataFrame, arrays: list[str], keep: list[str], key: str = "date",
                   value: str = "value") -> DataFrame:
    """Overlapping ``array<struct<key,value>>`` columns, later ones overwrite.

    List the widest window first and the spot value last. Inside one array the
    later element wins. Empty keys and values do not count.
    """
    def tagged(rank: int, name: str) -> Column:
        return F.transform(F.col(name), lambda x, i: F.struct(
            F.lit(rank).alias("rank"), i.alias("pos"), x[key].alias(key), x[value].alias(value),
            F.lit(name).alias("source_array")))

    lists = [tagged(r, a) for r, a in enumerate(arrays)]
    ranked = F.flatten(F.filter(F.array(*lists), lambda a: a.isNotNull()))
    points = df.select(*keep, F.inline(ranked)).where(
        F.col(key).isNotNull() & F.col(value).isNotNull())
    best = F.max_by(F.struct(value, "source_array"), F.struct("rank", "pos"))
    return points.groupBy(*keep, key).agg(best.alias("__b")).select(*keep, key, "__b.*")


def zip_series(df: DataFrame, keep: list[str], labels: str, series: dict[str, str],
               other_labels: str | None = None) -> DataFrame:
    """Parallel arrays to rows; short series are padded with null.

    Where a second label vector must agree with the first, a mismatch fails the job.
    """
    same = F.lit(True)
    if other_labels:
        same = F.coalesce(F.col(labels) == F.col(other_labels), F.lit(False))
        # a select would lose an assertion nobody reads, so it sits in the filter
        same = F.coalesce(F.assert_true(same, "label vectors do not match").isNull(), F.lit(True))
    n = F.size(labels)
    fitted = [F.slice(F.col(s), F.lit(1), n).alias(o) for o, s in series.items()]
    zipped = F.arrays_zip(F.col(labels).alias("label"), *fitted)
    names = ["label", *series]
    rows = df.where(same).select(*keep, F.posexplode(zipped).alias("pos", "__z"))
    return rows.select(*keep, "pos", *[F.col("__z").getField(str(n)).alias(n) for n in names])
