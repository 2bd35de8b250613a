"""Ids, names and headers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from hydrolake.functions import fixed
from hydrolake.functions._base import blank_to_null, col
from hydrolake.functions.text import clean_text, html_unescape, strip, strip_accents


def slug_lower(c: Column | str) -> Column:
    slug = F.lower(F.regexp_replace(F.regexp_replace(col(c), r"[^A-Za-z0-9]+", "_"), r"^_+|_+$", ""))
    return F.when(slug == "", F.lit("unknown")).otherwise(slug)


def slug_upper(c: Column | str) -> Column:
    return F.regexp_replace(
        F.regexp_replace(F.upper(strip(c)), r"[^A-Z0-9]+", "_"), r"^_+|_+$", "")


def make_id(prefix: str, name: Column | str, uuid: Column | str | None = None,
            upper: bool = False) -> Column:
    """Stable id: prefix, slug of the name, optionally 8 characters of a uuid."""
    parts = [F.lit(prefix), (slug_upper if upper else slug_lower)(name)]
    if uuid is not None:
        parts.append(F.substring(col(uuid), 1, 8))
    return F.concat_ws("_", *parts)


def id_fallback(*rules: tuple[Column, Column]) -> Column:
    """First rule whose condition holds, as ``(condition, id)`` pairs."""
    return F.coalesce(*[F.when(cond, value) for cond, value in rules])


def best_name(*candidates: Column | str) -> Column:
    """First candidate that is neither null nor empty, else ''."""
    return F.coalesce(*[blank_to_null(c) for c in candidates], F.lit(""))


def canon_text(c: Column | str) -> Column:
    """Upper-case letters, blanks and single hyphens only."""
    text = F.upper(F.regexp_replace(html_unescape(c), r"[^A-Za-z' \-]", " "))
    return F.regexp_replace(F.trim(F.regexp_replace(text, r"\s+", " ")), r"\s*-\s*", "-")


def canon_name(df: DataFrame, name: str, aliases: DataFrame, out: str = "canonical") -> DataFrame:
    """Canonical name, after an ``(alias, canonical)`` look-up table.

    The alias table is joined, not collected; Spark broadcasts it while it is
    under the session's threshold.
    """
    table = aliases.select(F.col("alias").alias("__alias"), F.col("canonical").alias("__canon"))
    return (df.withColumn("__name", canon_text(name))
            .join(table, F.col("__name") == F.col("__alias"), "left")
            .withColumn(out, F.coalesce("__canon", "__name"))
            .drop("__name", "__alias", "__canon"))


def match_key(c: Column | str) -> Column:
    """Key for joins on names: no accents, no 'dam'/'reservoir', alphanumerics."""
    text = F.regexp_replace(F.lower(strip_accents(c)), r"[^\x00-\x7f]", "")
    return F.regexp_replace(F.regexp_replace(text, r"\b(dam|reservoir)\b", ""), r"[^a-z0-9]", "")


def split_pair(c: Column | str, sep: str = "/") -> Column:
    """``"system / river"`` to a struct of the first two cleaned parts."""
    parts = F.split(col(c), sep)

    def part(i: int) -> Column:
        cell = clean_text(F.get(parts, F.lit(i)))
        return F.when(~cell.isin(*fixed.MARKERS_DASHES), cell).otherwise(F.lit(""))

    return F.struct(F.coalesce(part(0), F.lit("")).alias("first"),
                    F.coalesce(part(1), F.lit("")).alias("second"))


def drop_suffix(c: Column | str, suffixes: list[str], sep: str = "-") -> Column:
    return F.regexp_replace(col(c), f"{sep}({'|'.join(suffixes)})$", "")


def parse_header(c: Column | str) -> Column:
    """``"name (gloss, unit)"`` to a struct ``name, gloss, unit``.

    Bracket groups are split at commas; the last part that reads as a unit is
    the unit, the other parts are the gloss.
    """
    c = col(c)
    groups = F.regexp_extract_all(c, F.lit(r"\(([^()]*)\)"), F.lit(1))
    parts = F.filter(F.transform(F.flatten(F.transform(groups, lambda g: F.split(g, ","))), lambda p: F.trim(p)),
                     lambda p: p != "")
    units = F.filter(parts, lambda p: p.rlike(fixed.UNIT_PATTERN))
    unit = F.when(F.size(units) > 0, F.element_at(units, -1))
    gloss = F.array_join(F.filter(parts, lambda p: ~p.eqNullSafe(unit)), ", ")
    return F.struct(F.trim(F.regexp_extract(c, r"^([^(]*)", 1)).alias("name"),
                    F.coalesce(gloss, F.lit("")).alias("gloss"),
                    F.coalesce(unit, F.lit("")).alias("unit"))
