"""Joins and enrichment.

No join carries a broadcast hint: look-ups are broadcast while Spark measures
them below the session threshold and are shuffled beyond it, where AQE splits
skewed partitions of the other side.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from hydrolake.functions._base import blank_to_null
from hydrolake.functions.names import match_key
from hydrolake.operators.select import cap, dedup_first
from hydrolake.session import scratch_path


def coalesce_feeds(feeds: dict[str, DataFrame], keys: list[str],
                   precedence: dict[str, list[tuple[str, str]]],
                   only_when: dict[str, Column] | None = None) -> DataFrame:
    """Every id of any feed, each field from the first feed that has it.

    ``precedence`` maps an output column to ``(feed, column)`` pairs in order of
    trust; a zero counts as a value. ``only_when`` restricts a feed (its ids
    included) to rows where the condition holds, e.g. to today's. Each feed
    holds one row per key. All feeds meet in one aggregation, so there is one
    shuffle instead of one join per feed.
    """
    only_when = only_when or {}
    slots = sorted({pair for pairs in precedence.values() for pair in pairs})
    name_of = {pair: f"__{pair[0]}__{pair[1]}" for pair in slots}
    parts = []
    for feed, df in feeds.items():
        rows = df.where(only_when[feed]) if feed in only_when else df
        parts.append(rows.select(*keys, *[F.col(c).alias(name_of[f, c]) for f, c in slots if f == feed]))
    every = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    merged = every.groupBy(*keys).agg(*[F.max(name_of[s]).alias(name_of[s]) for s in slots])
    return merged.select(*keys, *[F.coalesce(*[F.col(name_of[p]) for p in pairs]).alias(out)
                                  for out, pairs in precedence.items()])


def match_join(left: DataFrame, right: DataFrame, left_name: str, right_name: str, station: str,
               reading: str, order: str) -> tuple[DataFrame, DataFrame]:
    """Join on folded names; returns the rows and a report of what was left out.

    The report has ``(kind, name)`` with kinds ``unmatched`` (no such name on the
    right), ``missing_at_date`` (no reading) and ``duplicate_station`` (another
    row already gave that station; the first in ``order`` wins).

    The join runs once and its rows, each with its state, are written to the shared folder; rows
    and report are read from there. The report meets one row per station, however many ask for it.
    """
    right_cols = [c for c in right.columns]
    keyed = right.withColumn("__key", match_key(right_name))
    unique = keyed.groupBy("__key").agg(F.max_by(F.struct(*right_cols), F.struct(*right_cols)).alias("__r"))
    left_cols = left.columns
    joined = left.withColumn("__key", match_key(left_name)).join(unique, "__key", "left")
    state = F.when(F.col("__r").isNull(), "unmatched").when(F.col(reading).isNull(), "missing_at_date")
    joined = joined.select(*left_cols, *[F.col(f"__r.{c}").alias(c) for c in right_cols if c not in left_cols], state.alias("__state"))
    path = scratch_path(left.sparkSession, "matched")
    joined.write.parquet(path)
    placed = left.sparkSession.read.schema(joined.schema).parquet(path)
    rows = dedup_first(placed.where("__state is null").drop("__state"), [station], [order])
    firsts = placed.where("__state is null").groupBy(F.col(station).alias("__s")).agg(F.min(order).alias("__first"))
    named = placed.select(F.when(F.col("__state").isNull(), F.col(station)).alias("__k"), F.col(order).alias("__o"), "__state", F.col(left_name).alias("name"))
    later = named.join(firsts, F.col("__k") == F.col("__s"), "left")
    kind = F.coalesce("__state", F.when(F.col("__o") != F.col("__first"), "duplicate_station"))
    return rows, later.select(kind.alias("kind"), "name").where("kind is not null")


def apply_overrides(df: DataFrame, overrides: DataFrame, key: str, cols: list[str]) -> DataFrame:
    """Non-empty override values by id win over the source's."""
    table = overrides.select(F.col(key).alias("__key"), *[F.col(c).alias(f"__o_{c}") for c in cols])
    joined = df.join(table, F.col(key) == F.col("__key"), "left")
    for c in cols:
        joined = joined.withColumn(c, F.coalesce(blank_to_null(f"__o_{c}"), F.col(c)))
    return joined.select(*df.columns)


def attach_by_date(history: DataFrame, recent: DataFrame, on: list[str]) -> DataFrame:
    """Long history with the recent table's columns where it has the day."""
    return history.join(recent, on, "left")


def full_reference(reference: DataFrame, observed: DataFrame, key: str) -> DataFrame:
    """Every known item, plus observed ones nobody listed.

    Observed rows reduce to distinct keys first, so a busy item costs one row.
    """
    seen = observed.select(key).distinct().withColumn("observed", F.lit(True))
    known = reference.withColumn("listed", F.lit(True))
    return (known.join(seen, key, "full_outer")
            .withColumn("listed", F.coalesce("listed", F.lit(False)))
            .withColumn("observed", F.coalesce("observed", F.lit(False))))


def held_among(held: DataFrame, candidates: DataFrame, on: list[str]) -> DataFrame:
    """The keys of a large archive that any candidate has, cut down before they are shuffled.

    The candidates' smallest and largest keys (one job, one row) bound the archive's scan as
    literals, which reach partitions and row groups; the semi join behind them is one that Spark
    may precede with a Bloom filter of the candidates' keys at run time. Null keys match nothing.
    """
    keys = candidates.select(*on)
    bounds = keys.agg(*[f(F.col(c)) for c in on for f in (F.min, F.max)]).first()
    if any(b is None for b in bounds):
        return held.select(*on).where(F.lit(False))
    inside = reduce(lambda x, y: x & y, [F.col(c).between(F.lit(lo), F.lit(hi)) for c, lo, hi in zip(on, bounds[::2], bounds[1::2])])
    return held.select(*on).where(inside).join(keys.where(inside), on, "left_semi")


def not_yet_held(candidates: DataFrame, held: DataFrame, on: list[str], limit: int | None = None,
                 order: list[str] | None = None, large: bool = False) -> DataFrame:
    """Candidates not in the archive, optionally the first n of them.

    ``large``: the archive is first cut to the candidates' keys (:func:`held_among`), for few
    candidates against an archive too large to be shuffled for them.
    """
    known = held_among(held, candidates, on) if large else held.select(*on)
    todo = candidates.join(known.distinct(), on, "left_anti")
    return todo if limit is None else cap(todo, limit, order or on)


def capture_candidates(templates: DataFrame, template: str, start: Column, end: Column) -> DataFrame:
    """One row per template and day, with the day filled into the template.

    Days are generated on each template row. Place-holders: ``{d} {m}``
    (unpadded), ``{dd} {mm} {yy} {yyyy}``.
    """
    days = templates.withColumn("day", F.explode(F.sequence(start, end)))
    url = F.col(template)
    for token, fmt in (("{yyyy}", "yyyy"), ("{yy}", "yy"), ("{mm}", "MM"), ("{dd}", "dd"),
                       ("{m}", "M"), ("{d}", "d")):
        url = F.replace(url, F.lit(token), F.date_format("day", fmt))
    return days.withColumn("url", url)


def reading_at(latest: DataFrame, history: DataFrame, key: str, date: Column,
               date_col: str = "date", value: str = "value") -> DataFrame:
    """Each item's value on a common date.

    The latest reading if it has that date; the history's row for that date if
    the latest one is newer; nothing if it is older.
    """
    past = history.where(F.col(date_col) == date).select(
        F.col(key).alias("__key"), F.col(value).alias("__past"))
    joined = latest.join(past, F.col(key) == F.col("__key"), "left")
    picked = F.when(F.col(date_col) == date, F.col(value)).when(F.col(date_col) > date, F.col("__past"))
    return joined.select(key, date.alias(date_col), picked.alias(value))


#: Periods are filed by length: class c holds those of up to BASE^(c + 1) days, in buckets of BASE^c.
BASE, CLASSES = 16, 6


def _filed(periods: DataFrame, keys: list[str]) -> tuple[DataFrame, list[int], int | None, int]:
    """Periods with their first and last day as numbers and their class, the classes in use, the
    horizon up to which open periods are filed, and the most periods of one key. One job over the
    periods, which returns one row."""
    first, end = F.unix_date(F.to_date("start_date")), F.unix_date(F.to_date("end_date"))
    p = periods.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)], "start_date", "end_date", "quality_state",
                       first.alias("first"), end.alias("last")).where("first IS NOT NULL AND (end_date IS NULL OR first <= last)")

    def class_of(days: Column) -> Column:
        return F.lit(CLASSES) - sum(F.when(days <= BASE ** (c + 1), 1).otherwise(0) for c in range(CLASSES))

    open_first = F.when(F.col("last").isNull(), F.col("first"))
    each = p.groupBy(*[f"__k{i}" for i in range(len(keys))]).agg(
        F.count("*").alias("n"), F.max(F.greatest("first", "last")).alias("h"), F.min(open_first).alias("lo"), F.max(open_first).alias("hi"),
        *[F.max(class_of(F.col("last") - F.col("first") + 1) == c).alias(f"c{c}") for c in range(CLASSES + 1)])
    found = each.agg(F.max("n"), F.max("h"), F.min("lo"), F.max("hi"), *[F.max(f"c{c}") for c in range(CLASSES + 1)]).first()
    most, horizon, lo, hi = found[:4]
    used = {c for c, there in enumerate(found[4:]) if there}
    if lo is not None:  # open periods last from their first day to the horizon
        plain = lambda days: sum(days > BASE ** (c + 1) for c in range(CLASSES))
        used |= set(range(plain(horizon - hi + 1), plain(horizon - lo + 1) + 1))
    p = p.withColumn("last", F.coalesce("last", F.lit(horizon)))
    return p.withColumn("class", class_of(F.col("last") - F.col("first") + 1)), sorted(used), horizon, most or 0


def attach_quality(obs: DataFrame, periods: DataFrame, keys: list[str], date: str, few: int = 16) -> DataFrame:
    """Quality state of the period a reading falls in; open periods have no end.

    An interval join by time buckets. A period is filed under the few buckets it touches, of a
    width that follows its length; the periods of a key and bucket lie in one row, so a reading
    meets at most one row per class of lengths, by equality, and looks in it for the exact
    range. However many periods a key has, a reading sees only those near its date, and the
    readings of a key spread over its buckets. Open periods are filed up to the horizon, the last
    day any period names; later readings look there. Where no key has more than ``few`` periods,
    which is counted, a reading is simply compared with all of its key's.

    A reading in several periods gives a row for each; one in none, without a date or with a null
    key keeps a null state. Periods without a start, or that end before they start, hold nothing.
    """
    p, used, horizon, most = _filed(periods, keys)
    if most <= few:
        same = reduce(lambda a, b: a & b, [F.col(f"__k{i}") == F.col(k) for i, k in enumerate(keys)])
        inside = (F.col(date) >= F.col("__start")) & (F.col("__end").isNull() | (F.col(date) <= F.col("__end")))
        p = p.select(*[f"__k{i}" for i in range(len(keys))], F.col("start_date").alias("__start"), F.col("end_date").alias("__end"), "quality_state")
        return obs.join(p, same & inside, "left").select(*[obs[f"`{c}`"] for c in obs.columns], "quality_state")
    names = set(obs.columns)
    free = lambda stem: next(n for n in (f"{stem}{'_' * i}" for i in range(len(names) + 1)) if n not in names)
    found, left = [], obs
    day = F.least(F.unix_date(F.to_date(date)), F.lit(horizon))
    for c in used:
        width = BASE ** c
        near = p.where(F.col("class") == c).withColumn("bucket", F.explode(F.sequence(F.floor(F.col("first") / width), F.floor(F.col("last") / width))))
        held, slot = free(f"__near{c}"), free(f"__slot{c}")
        by = [F.col(f"__k{i}").alias(f"{slot}k{i}") for i in range(len(keys))]
        near = near.groupBy(*by, F.col("bucket").alias(f"{slot}b")).agg(
            F.collect_list(F.struct("start_date", "end_date", "quality_state")).alias(held))
        same = reduce(lambda a, b: a & b, [F.col(f"{slot}k{i}") == F.col(k) for i, k in enumerate(keys)], F.col(f"{slot}b") == F.floor(day / width))
        left = left.join(near, same, "left").drop(f"{slot}b", *[f"{slot}k{i}" for i in range(len(keys))])
        found.append(held)
    if not found:
        return obs.withColumn("quality_state", F.lit(None).cast(periods.schema["quality_state"].dataType))
    empty = F.array().cast(left.schema[found[0]].dataType)
    inside = F.filter(F.concat(*[F.coalesce(F.col(f), empty) for f in found]), lambda s: (F.col(date) >= s["start_date"]) & (
        s["end_date"].isNull() | (F.col(date) <= s["end_date"])))
    state = free("__state")
    out = left.select(*[F.col(f"`{c}`") for c in obs.columns], F.explode_outer(F.transform(inside, lambda s: F.struct(s["quality_state"].alias("s")))).alias(state))
    return out.select(*[F.col(f"`{c}`") for c in obs.columns], F.col(f"{state}.s").alias("quality_state"))
