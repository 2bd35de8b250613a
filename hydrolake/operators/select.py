"""Row selection, aggregation, order and limits.

Picking one row per group is an aggregation (``max_by`` over a struct), never
a window: each map task first reduces its rows to one per group, so a hot group
costs one row per task in the shuffle.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, Window, functions as F

from hydrolake.functions import fixed
from hydrolake.functions._base import col
from hydrolake.functions.dates import cell_date
from hydrolake.operators.filters import looks_numeric


def latest_per(df: DataFrame, keys: list[str], by: list[str], arrival: str,
               ties: str = "first") -> DataFrame:
    """A1: the row with the greatest ``by`` per key.

    Equal ``by`` is settled by ``arrival``: ``ties="first"`` keeps the row that
    came first, ``"last"`` the one that came last.
    """
    if ties not in ("first", "last"):
        raise ValueError(f"ties must be 'first' or 'last', not {ties!r}")
    tie = -F.col(arrival) if ties == "first" else F.col(arrival)
    rest = [c for c in df.columns if c not in keys]
    picked = F.max_by(F.struct(*rest), F.struct(*by, tie))
    return df.groupBy(*keys).agg(picked.alias("__row")).select(*keys, "__row.*")


def dedup_first(df: DataFrame, cols: list[str], order: list[str]) -> DataFrame:
    """A2: first row per business key in the given order."""
    rest = [c for c in df.columns if c not in cols]
    if not rest:
        return df.distinct()
    picked = F.min_by(F.struct(*rest), F.struct(*order))
    return df.groupBy(*cols).agg(picked.alias("__row")).select(*cols, "__row.*").select(*df.columns)


def modal(df: DataFrame, value: str, keys: list[str] | None = None) -> DataFrame:
    """A3: most frequent value per group; a tie goes to the greater value."""
    keys = keys or []
    counts = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("n"))
    best = F.max(F.struct("n", value)).alias("__best")
    return counts.groupBy(*keys).agg(best).select(*keys, f"__best.{value}", "__best.n")


def expected_slots(day: Column, tz: str, step_seconds: int) -> Column:
    """Readings a complete local day has: 92, 96 or 100 for quarter hours."""
    start = F.to_utc_timestamp(day.cast("timestamp"), tz)
    end = F.to_utc_timestamp(F.date_add(day, 1).cast("timestamp"), tz)
    return F.floor((F.unix_seconds(end) - F.unix_seconds(start)) / step_seconds).cast("bigint")


def day_summary(df: DataFrame, keys: list[str], ts: str, value: str, arrival: str, tz: str,
                step_seconds: int = 900) -> DataFrame:
    """Per local day: mean, counts and whether the day is complete.

    Repeated instants collapse first (last arrival wins). A day is complete if
    it has the expected number of distinct instants, starts at 00:00, ends one
    step before midnight, and all instants share the step's grid; together that
    means every gap is exactly one step, without ordering the readings.
    """
    instants = df.groupBy(*keys, ts).agg(F.max_by(value, arrival).alias("__v"))
    local = F.from_utc_timestamp(F.col(ts), tz)
    last_slot = f"{(86400 - step_seconds) // 3600:02d}:{(86400 - step_seconds) % 3600 // 60:02d}"
    phase = F.unix_micros(ts) % (step_seconds * 1000000)
    days = (instants.withColumn("date", F.to_date(local)).withColumn("__phase", phase)
            .groupBy(*keys, "date")
            .agg(F.count(F.lit(1)).alias("n"), F.avg("__v").alias("mean_value"),
                 F.min(ts).alias("__first"), F.max(ts).alias("__last"),
                 F.min("__phase").alias("__lo"), F.max("__phase").alias("__hi")))

    def clock(name: str) -> Column:
        return F.date_format(F.from_utc_timestamp(F.col(name), tz), "HH:mm")

    days = days.withColumn("expected", expected_slots(F.col("date"), tz, step_seconds))
    complete = ((F.col("n") == F.col("expected")) & (clock("__first") == "00:00")
                & (clock("__last") == last_slot) & (F.col("__lo") == F.col("__hi")))
    return days.withColumn("is_complete", complete).drop("__first", "__last", "__lo", "__hi")


def complete_day_mean(df: DataFrame, keys: list[str], ts: str, value: str, arrival: str,
                      tz: str, step_seconds: int = 900) -> DataFrame:
    """A4: daily means of complete local days only, nothing interpolated."""
    return (day_summary(df, keys, ts, value, arrival, tz, step_seconds)
            .where("is_complete").drop("is_complete"))


def point_reason(simulated: Column | str, ts: Column | str, value: Column | str) -> Column:
    """Why a point is kept or refused, for :func:`reject_counts`."""
    return F.when(F.coalesce(col(simulated), F.lit(True)), "excluded_simulated_or_unknown") \
        .when(col(ts).isNull() | col(value).isNull(), "excluded_malformed") \
        .otherwise("accepted")


def reject_counts(df: DataFrame, reason: Column | str, keys: list[str] | None = None) -> DataFrame:
    """A5: rows per reason."""
    return (df.groupBy(*(keys or []), col(reason).alias("reason"))
            .agg(F.count(F.lit(1)).alias("n")))


def observed_counts(df: DataFrame, reason: Column | str, reasons: Sequence[str], keep: Column | None = None) -> tuple[DataFrame, Observation]:
    """A5 from the pass that writes: the rows, and counts of known reasons (and ``other``) that the
    write of these rows observes. ``keep`` drops refused rows after they are counted.

    For rows that are only scanned before the write; behind a shuffle a task that a lost executor
    makes run again could count twice.
    """
    seen, why = Observation(), col(reason)
    counts = [F.count(F.when(why == r, 1)).alias(r) for r in reasons]
    out = df.observe(seen, *counts, F.count(F.when(~F.coalesce(why.isin(*reasons), F.lit(False)), 1)).alias("other"))
    return (out if keep is None else out.where(keep)), seen


def period_of_record(df: DataFrame, keys: list[str], date: str) -> DataFrame:
    """First day, last day and number of rows per id."""
    return df.groupBy(*keys).agg(F.min(date).alias("period_start"), F.max(date).alias("period_end"),
                                 F.count(F.lit(1)).alias("n"))


def run_totals(df: DataFrame, reservoir: str, date: str, kind: str, large: str) -> DataFrame:
    """One row: rows, reservoirs, dates, rows of the large kind and the rest."""
    is_large = F.when(F.col(kind) == large, 1).otherwise(0)
    return df.agg(F.count(F.lit(1)).alias("n_rows"),
                  F.countDistinct(reservoir).alias("n_reservoirs"),
                  F.countDistinct(date).alias("n_dates"),
                  F.sum(is_large).alias("n_large"), F.sum(1 - is_large).alias("n_other"))


def good_row(time: str, texts: list[str], numbers: list[str]) -> Column:
    """A recovered row that looks real: a time, three texts, one number."""
    def filled(c: str) -> Column:
        return F.when(F.trim(F.coalesce(F.col(c), F.lit(""))) != "", 1).otherwise(0)

    n_text = sum((filled(c) for c in texts[1:]), filled(texts[0]))
    numeric = [F.coalesce(looks_numeric(c), F.lit(False)) for c in numbers]
    any_number = numeric[0]
    for flag in numeric[1:]:
        any_number = any_number | flag
    has_time = F.coalesce(F.col(time).rlike(r"\d{2}-\d{2}\s+\d{2}:\d{2}"), F.lit(False))
    return has_time & (n_text >= 3) & any_number


def quality_score(df: DataFrame, group: list[str], time: str, texts: list[str],
                  numbers: list[str]) -> DataFrame:
    """Share of good rows and row count per group."""
    good = F.when(good_row(time, texts, numbers), 1.0).otherwise(0.0)
    return df.groupBy(*group).agg(F.avg(good).alias("quality"), F.count(F.lit(1)).alias("n_rows"))


def best_attempt(scores: DataFrame, group: list[str], attempt: str,
                 rank_by: list[str]) -> DataFrame:
    """The attempt with the highest ``(quality, rows, lines ...)``; a tie goes to the first."""
    rest = [c for c in scores.columns if c not in group]
    best = F.max_by(F.struct(*rest), F.struct(*rank_by, -F.col(attempt)))
    return scores.groupBy(*group).agg(best.alias("__row")).select(*group, "__row.*")


def unresolved_ids(df: DataFrame, key: str, name: Column | str) -> DataFrame:
    """Ids that have a row without a name."""
    return (df.where((F.trim(F.coalesce(col(name), F.lit(""))) == "") & F.col(key).isNotNull())
            .select(key).distinct())


def char_counts(df: DataFrame, text: str, keep: str | None = None,
                keys: list[str] | None = None) -> DataFrame:
    """How often each character occurs, optionally only those matching a class."""
    source = F.col(text)
    if keep:
        source = F.regexp_replace(source, f"[^{keep}]", "")
    return (df.select(*(keys or []), F.explode(F.split(source, "")).alias("ch")).where("ch != ''")
            .groupBy(*(keys or []), "ch").agg(F.count(F.lit(1)).alias("n")))


def date_columns(columns: list[str]) -> list[str]:
    """Columns that hold an observation date, not a capture time."""
    return [c for c in columns if re.search(fixed.DATE_COLUMN_PATTERN, c)
            and not re.search(fixed.CAPTURE_COLUMN_PATTERN, c)]


def newest_observation(df: DataFrame, source: str, columns: list[str] | None = None,
                       file_name: str | None = None) -> DataFrame:
    """A10: newest ISO day over all date-like columns of each source.

    Without any readable day in the data the day in the file name counts.
    """
    columns = columns if columns is not None else date_columns(df.columns)
    days = [cell_date(F.col(c)) for c in columns]
    best = F.greatest(*days) if len(days) > 1 else days[0] if days else F.lit(None).cast("string")
    newest = F.max(best)
    if file_name:
        newest = F.coalesce(newest, F.max(cell_date(F.col(file_name))))
    return df.groupBy(source).agg(newest.alias("latest_observation"))


def recent_runs(df: DataFrame, keys: list[str], order: list[str], status: str,
                n: int = 10) -> DataFrame:
    """Statuses of the last ``n`` runs, oldest first, and the newest one.

    The filter on ``row_number`` lets Spark drop all but ``n`` rows per key
    before the shuffle, so the lists stay at ``n`` entries.
    """
    newest_first = Window.partitionBy(*keys).orderBy(*[F.col(o).desc() for o in order])
    ranked = df.withColumn("__rn", F.row_number().over(newest_first)).where(F.col("__rn") <= n)
    label = F.coalesce(F.col(status), F.lit("?"))
    return (ranked.groupBy(*keys)
            .agg(F.sort_array(F.collect_list(F.struct((-F.col("__rn")).alias("k"), label.alias("s"))))
                 .alias("__runs"))
            .select(*keys, F.col("__runs.s").alias("recent_statuses"),
                    F.element_at("__runs.s", -1).alias("latest_status")))


def canonical_sort(df: DataFrame, keys: list[str], globally: bool = True) -> DataFrame:
    """L1: archive order; range-partitioned, or only inside the files to write."""
    return df.orderBy(*keys) if globally else df.sortWithinPartitions(*keys)


def cap(df: DataFrame, n: int, order: list[str]) -> DataFrame:
    """L2: the n oldest new items of a run; the rest follow in later runs."""
    return df.orderBy(*order).limit(n)


def latest_files(df: DataFrame, file_col: str, n: int, keys: list[str] | None = None) -> DataFrame:
    """L3: rows of the newest n files, by file name, optionally per key."""
    keys = keys or []
    files = df.select(*keys, file_col).distinct()
    if keys:
        newest = Window.partitionBy(*keys).orderBy(F.col(file_col).desc())
        files = files.withColumn("__rn", F.row_number().over(newest)).where(F.col("__rn") <= n)
    else:
        files = files.orderBy(F.col(file_col).desc()).limit(n)
    return df.join(files.select(*keys, file_col), [*keys, file_col], "left_semi")
