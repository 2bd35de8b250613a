"""Order-dependent columns that survive a hot key.

A plain window over one series pulls the whole series into one task. Here a
series is cut into slices (by default calendar days): the window runs inside
``(key, slice)`` and only one summary row per slice crosses the slice border.
Rows carry key and slice as one struct column, which is never null itself and
in which null fields equal each other, so window and join back share one
partitioning and rows are shuffled once; summaries are aggregated before theirs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from hydrolake.functions._base import col

_KS = "__ks"


def day_slice(ts: Column | str) -> Column:
    return F.to_date(col(ts))


def sliced(df: DataFrame, keys: list[str], slice_by: Column) -> DataFrame:
    """``df`` with the struct of its keys and its slice."""
    return df.withColumn(_KS, F.struct(*[F.col(k).alias(f"k{i}") for i, k in enumerate(keys)], slice_by.alias("slice")))


def windows(keys: list[str], order: list):
    """Inside one slice, and over the slices of one key."""
    inside = Window.partitionBy(_KS).orderBy(*order)
    across = Window.partitionBy(*[F.col(f"{_KS}.k{i}") for i in range(len(keys))]).orderBy(f"{_KS}.slice")
    return inside, across


def lag_over_slices(df: DataFrame, keys: list[str], order: list[str], value: str, out: str,
                    slice_by: Column) -> DataFrame:
    """``lag(value)`` over ``(keys order by order)``.

    ``slice_by`` must not decrease along the order. ``order`` must be total.
    """
    inside, across = windows(keys, order)
    df = sliced(df, keys, slice_by)
    tails = (df.groupBy(_KS).agg(F.max_by(F.struct(F.col(value).alias("v")), F.struct(*order)).alias("__tail"))
             .withColumn("__carry", F.lag("__tail").over(across)).select(_KS, "__carry"))
    rows = (df.withColumn(out, F.lag(value).over(inside))
            .withColumn("__n", F.row_number().over(inside)))
    return (rows.join(tails, _KS)
            .withColumn(out, F.when(F.col("__n") == 1, F.col("__carry.v")).otherwise(F.col(out)))
            .drop(_KS, "__n", "__carry"))


def running_sum_over_slices(df: DataFrame, keys: list[str], order: list[str], value: Column,
                            out: str, slice_by: Column) -> DataFrame:
    """``sum(value)`` from the start of the key up to and including the row."""
    inside, across = windows(keys, order)
    df = sliced(df, keys, slice_by).withColumn("__v", value)
    before = across.rowsBetween(Window.unboundedPreceding, -1)
    offsets = (df.groupBy(_KS).agg(F.sum("__v").alias("__sum"))
               .withColumn("__offset", F.coalesce(F.sum("__sum").over(before), F.lit(0))).select(_KS, "__offset"))
    upto = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (df.withColumn("__run", F.sum("__v").over(upto)).join(offsets, _KS)
            .withColumn(out, F.col("__run") + F.col("__offset"))
            .drop(_KS, "__v", "__run", "__offset"))


def descents_over_slices(df: DataFrame, keys: list[str], order: list[str], value: str, out: str,
                         slice_by: Column) -> DataFrame:
    """How many rows up to this one do not exceed the last known value before them.

    Rows without a value count nothing. A slice's summary is its first and last
    value and its own count; whether its first value is such a row depends on the
    slices before it.
    """
    inside, across = windows(keys, order)
    earlier = inside.rowsBetween(Window.unboundedPreceding, -1)
    upto = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    df = sliced(df, keys, slice_by)
    rows = df.withColumn("__last", F.last(value, ignorenulls=True).over(earlier))
    rows = rows.withColumn("__down", F.when(F.col(value) <= F.col("__last"), 1).otherwise(0))
    known = F.when(F.col(value).isNotNull(), F.struct(*order))
    summary = rows.groupBy(_KS).agg(F.min_by(value, known).alias("__first"), F.max_by(value, known).alias("__end"),
                                    F.sum("__down").alias("__n"))
    before = across.rowsBetween(Window.unboundedPreceding, -1)
    summary = summary.withColumn("__opens", F.when(F.col("__first") <= F.last("__end", ignorenulls=True).over(before), 1).otherwise(0))
    summary = summary.withColumn("__offset", F.coalesce(F.sum(F.col("__n") + F.col("__opens")).over(before), F.lit(0)))
    started = F.coalesce(F.col("__last"), F.col(value)).isNotNull()
    return (rows.withColumn("__run", F.sum("__down").over(upto)).join(summary.select(_KS, "__offset", "__opens"), _KS)
            .withColumn(out, F.col("__offset") + F.col("__run") + F.when(started, F.col("__opens")).otherwise(0))
            .drop(_KS, "__last", "__down", "__run", "__offset", "__opens"))


def intervals(df: DataFrame, keys: list[str], ts: str, step_seconds: int,
              tiebreak: str | None = None, slice_by: Column | None = None) -> DataFrame:
    """Previous instant, whole seconds since then, and whether that is the step."""
    order = [ts] + ([tiebreak] if tiebreak else [])
    slice_by = day_slice(ts) if slice_by is None else slice_by
    with_previous = lag_over_slices(df, keys, order, ts, "previous_ts", slice_by)
    micros = F.unix_micros(F.col(ts).cast("timestamp")) - F.unix_micros(F.col("previous_ts").cast("timestamp"))
    return (with_previous
            .withColumn("interval_seconds", F.floor(micros / 1000000).cast("bigint"))
            .withColumn("is_regular", F.col("interval_seconds") == step_seconds))


def streaks(df: DataFrame, keys: list[str], order: list[str], bad: Column,
            slice_by: Column) -> DataFrame:
    """Runs of consecutive bad rows: ``start, end, length`` in the first order column."""
    numbered = running_sum_over_slices(
        df.withColumn("__bad", bad), keys, order,
        F.when(F.col("__bad"), 0).otherwise(1), "__island", slice_by)
    return (numbered.where("__bad").groupBy(*keys, "__island")
            .agg(F.min(order[0]).alias("start"), F.max(order[0]).alias("end"),
                 F.count(F.lit(1)).alias("length"))
            .drop("__island"))


def dynamic_threshold(df: DataFrame, keys: list[str], order: list[str], count: str,
                      slice_by: Column, out: str = "threshold", sample: int = 6,
                      share: float = 0.75, low: int = 14, high: int = 24,
                      default: int = 18) -> DataFrame:
    """Retry threshold from the last few positive counts before the row.

    Median of the last ``sample`` positive counts, times ``share``, rounded
    half to even, clamped; ``default`` where nothing positive came before.
    """
    inside, across = windows(keys, order)
    # one partitioning for both windows and the join back
    rows = sliced(df, keys, slice_by).withColumn("__pos", F.col(count) > 0).repartition(F.col(_KS))
    among_positive = (Window.partitionBy(_KS, "__pos").orderBy(*order)
                      .rowsBetween(-(sample - 1), Window.currentRow))
    rows = rows.withColumn(
        "__own", F.when(F.col("__pos"), F.collect_list(count).over(among_positive)))
    rows = rows.withColumn("__seen", F.last("__own", ignorenulls=True).over(
        inside.rowsBetween(Window.unboundedPreceding, -1)))

    # one row per slice: its last positive counts, chained over earlier slices
    tails = rows.groupBy(_KS).agg(
        F.max_by("__own", F.when(F.col("__pos"), F.struct(*order))).alias("__last"))
    tails = tails.withColumn("__any", F.col("__last").isNotNull())
    chain = (Window.partitionBy(*[F.col(f"{_KS}.k{i}") for i in range(len(keys))], "__any").orderBy(f"{_KS}.slice")
             .rowsBetween(-(sample - 1), Window.currentRow))
    joined = F.flatten(F.collect_list("__last").over(chain))
    tails = tails.withColumn("__tail", F.when(F.col("__any"), _last_n(joined, sample)))
    tails = tails.select(_KS, F.last("__tail", ignorenulls=True).over(
        across.rowsBetween(Window.unboundedPreceding, -1)).alias("__carry"))

    empty = F.array().cast(f"array<{dict(df.dtypes)[count]}>")
    recent = F.sort_array(_last_n(F.concat(F.coalesce("__carry", empty),
                                           F.coalesce("__seen", empty)), sample))
    n = F.size(recent)
    middle = (F.get(recent, F.floor((n - 1) / 2).cast("int"))
              + F.get(recent, F.floor(n / 2).cast("int"))) / 2.0
    threshold = F.least(F.lit(high), F.greatest(F.lit(low), F.bround(middle * share, 0).cast("int")))
    return (rows.join(tails, _KS)
            .withColumn(out, F.when(n > 0, threshold).otherwise(F.lit(default)))
            .drop(_KS, "__pos", "__own", "__seen", "__carry"))


def _last_n(array: Column, n: int) -> Column:
    start = F.greatest(F.size(array) - n, F.lit(0)) + 1
    return F.slice(array, start, F.lit(n))


def row_order(df: DataFrame, doc: list[str], order: list[str], out: str = "row_order") -> DataFrame:
    """Position within a document, from 0 (a document is one payload)."""
    return df.withColumn(out, F.row_number().over(Window.partitionBy(*doc).orderBy(*order)) - 1)


def with_previous_week(df: DataFrame, date: str, current: str, previous: str) -> DataFrame:
    """One dashboard row gives the current and the previous week's reading."""
    rest = [c for c in df.columns if c not in (date, current, previous)]
    readings = F.array(
        F.struct(F.col(date).alias("date"), F.col(current).alias("value"),
                 F.lit("current").alias("reading_kind")),
        F.struct(F.date_sub(date, 7).alias("date"), F.col(previous).alias("value"),
                 F.lit("previous_week").alias("reading_kind")))
    return df.select(*rest, F.inline(readings)).where("date is not null and value is not null")
