"""Dates as sources print them.

Unreadable dates become null; a source that wants "today" instead passes it
through ``coalesce`` explicitly.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, functions as F

from hydrolake.functions import fixed
from hydrolake.functions._base import col, extract, let, literal_map
from hydrolake.functions.text import clean_text, strip, strip_accents


def _loosen(text: Column, words: bool, two_digit_years: bool) -> Column:
    if words:
        text = F.replace(text, F.lit(","), F.lit(" "))
        text = F.when(text.rlike("[A-Za-z]"), F.replace(text, F.lit("-"), F.lit(" "))).otherwise(text)
        text = F.trim(F.regexp_replace(text, r"\s+", " "))
    if two_digit_years:
        # two-digit years 69-99 belong to the last century
        head = r"^(?<head>\d{1,2}[/-]\d{1,2}[/-])"
        text = F.regexp_replace(text, head + r"(?<yy>69|[7-9]\d)$", "${head}19${yy}")
        text = F.regexp_replace(text, head + r"(?<yy>\d\d)$", "${head}20${yy}")
    return text


def _parse_tokens(tokens: Column, formats: Iterable[str], words: bool) -> Column:
    """Dates of an array of texts; each text is prepared once, then tried per format."""
    formats = list(formats)
    short = [f for f in formats if "yy" in f and "yyyy" not in f]
    full = list(dict.fromkeys(f.replace("yy", "yyyy") if f in short else f for f in formats))
    ready = F.transform(tokens, lambda x: _loosen(strip(x), words, bool(short)))
    return F.transform(ready, lambda x: F.coalesce(
        *[F.to_date(F.try_to_timestamp(x, F.lit(f))) for f in full]))


def parse_date_any(c: Column | str, formats: Iterable[str] = fixed.DATE_FORMATS_DAY_FIRST,
                   words: bool = True) -> Column:
    """First format that parses. ``words`` loosens commas and hyphens between words."""
    return F.get(_parse_tokens(F.array(col(c)), formats, words), F.lit(0))


def _ymd(year: Column, month: Column, day: Column) -> Column:
    return F.try_to_date(F.concat_ws("-", year.cast("string"), month.cast("string"),
                                     day.cast("string")), "y-M-d")


def parse_dmy(c: Column | str, sep: str = "-", anywhere: bool = False) -> Column:
    """Unpadded ``d-m-yy`` or ``d-m-yyyy``; two-digit years are 20yy."""
    pattern = f"(\\d{{1,2}})[{sep}](\\d{{1,2}})[{sep}](\\d{{2,4}})"
    pattern = pattern if anywhere else f"^{pattern}$"

    def rebuild(text: Column) -> Column:
        # a two-digit year is widened, the day and month stay as they are
        hit = F.regexp_extract(text, pattern, 0)
        wide = F.regexp_replace(hit, f"(?<s>[{sep}])(?<y>\\d\\d)$", "${s}20${y}")
        wide = F.regexp_replace(wide, f"(?<s>[{sep}])0(?<y>\\d\\d)$", "${s}20${y}")
        return F.try_to_date(F.regexp_replace(wide, f"[{sep}]", "-"), "d-M-yyyy")

    return let(col(c) if anywhere else strip(c), rebuild)


def parse_ymd_loose(c: Column | str) -> Column:
    """``2026-8-4...`` with or without padding, at the start of the cell."""
    return F.try_to_date(F.regexp_extract(strip(c), r"^\d{4}-\d{1,2}-\d{1,2}", 0), "y-M-d")


def parse_text_date(c: Column | str, months: dict[str, int], order: str = "dmy",
                    joiner: str = r"\s+", year_range: tuple[int, int] = (2000, 2100)) -> Column:
    """Date written in words: ``4 de agosto de 2026`` or ``August 4, 2026``."""
    if order == "dmy":
        pattern = rf"(\d{{1,2}}){joiner}([a-z]+){joiner}(\d{{4}})"
        at = {"d": 1, "m": 2, "y": 3}
    else:
        pattern = r"([a-z]+)\s+(\d{1,2}),?\s+(\d{4})"
        at = {"d": 2, "m": 1, "y": 3}

    def rebuild(hit: Column) -> Column:
        year = F.regexp_extract(hit, pattern, at["y"])
        month = literal_map(months)[F.regexp_extract(hit, pattern, at["m"])]
        day = F.regexp_extract(hit, pattern, at["d"])
        return F.when(year.between(str(year_range[0]), str(year_range[1])), _ymd(year, month, day))

    return let(F.regexp_extract(F.lower(strip_accents(c)), pattern, 0), rebuild)


def printed_date(c: Column | str, patterns: Iterable[str] = fixed.AS_AT_PATTERNS,
                 formats: Iterable[str] = fixed.DATE_FORMATS_DAY_FIRST) -> Column:
    """The date a page prints: first pattern that matches *and* parses."""
    tokens = let(col(c), lambda t: F.array(*[extract(t, "(?i)" + p) for p in patterns]))
    found = F.filter(tokens, lambda x: x.isNotNull())
    dates = F.filter(_parse_tokens(found, formats, True), lambda d: d.isNotNull())
    return F.get(dates, F.lit(0))


def cell_date(c: Column | str) -> Column:
    """ISO text of a date written ``2026-06-29`` or ``20260629`` inside a cell."""
    c = col(c).cast("string")
    compact = r"\b(20\d{2})(0[1-9]|1[0-2])(0[1-9]|[12]\d|3[01])\b"
    return F.coalesce(
        extract(c, r"(20\d{2}-\d{2}-\d{2})"),
        F.when(c.rlike(compact), F.concat_ws("-", *[F.regexp_extract(c, compact, i) for i in (1, 2, 3)])))


def month_day_candidates(c: Column | str, anchor: Column | str, fmt: str) -> tuple[Column, Column]:
    """The same month and day in the anchor's year and the year before."""
    text, anchor = clean_text(c), col(anchor)
    this, last = (F.try_to_date(F.concat_ws("-", text, (F.year(anchor) - k).cast("string")),
                                f"{fmt}-yyyy") for k in (0, 1))
    return this, last


def resolve_year(c: Column | str, anchor: Column | str, tolerance_days: int = 0,
                 fmt: str = "MMM-d") -> Column:
    """Give a year-less date the anchor's year, or the one before if it lies
    more than ``tolerance_days`` in the future."""
    this, last = month_day_candidates(c, anchor, fmt)
    return F.when(F.datediff(this, col(anchor)) > tolerance_days, last).otherwise(this)


def epoch_ms_to_date(c: Column | str, tz: str | None = None) -> Column:
    """Calendar day of an epoch in milliseconds, UTC or in a named zone."""
    instant = F.timestamp_millis(col(c).cast("bigint"))
    return F.to_date(F.from_utc_timestamp(instant, tz) if tz else instant)


def monday_of(c: Column | str) -> Column:
    return F.to_date(F.date_trunc("week", col(c)))


def date_shift(c: Column | str, days: int) -> Column:
    return F.date_add(F.to_date(col(c)), days)


def parse_period(c: Column | str) -> Column:
    """``"2020-01-01 〜 2020-12-31 (366 days)"`` to ``start, end, days``."""
    pattern = r"(\d{4}-\d{2}-\d{2})\s*〜\s*(\d{4}-\d{2}-\d{2})\s*\(([\d,]+)\s+days\)"
    start, end, days = (extract(c, pattern, i) for i in (1, 2, 3))
    return F.struct(F.try_to_date(start).alias("start"), F.try_to_date(end).alias("end"),
                    F.replace(days, F.lit(","), F.lit("")).cast("bigint").alias("days"))


def pad_month(c: Column | str) -> Column:
    """First day of the month, for monthly values."""
    return F.trunc(F.to_date(col(c)), "month")
