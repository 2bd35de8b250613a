"""Numbers as sources print them.

A parser never fails a job: text it cannot read becomes null, and callers that
want the original keep it in a ``*_raw`` column beside the typed one.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from hydrolake.functions import fixed
from hydrolake.functions._base import col
from hydrolake.functions.cells import clean_cell
from hydrolake.functions.text import WS, strip

_LETTERS = "[a-df-zA-DF-Z]"


def to_double(c: Column | str) -> Column:
    """Plain decimal text to double; suffixes and words Java reads (``1d``, ``NaN``) are refused."""
    c = col(c)
    return F.when(~c.rlike(_LETTERS), c.try_cast("double"))


def num_thousands(c: Column | str, markers=fixed.MARKERS_NULL_WORDS) -> Column:
    """``1,234.5`` -> 1234.5."""
    return to_double(F.replace(clean_cell(c, markers), F.lit(","), F.lit("")))


def num_int_or_float(c: Column | str) -> Column:
    """Number or null; see :func:`is_integer` for the integer flag."""
    return num_thousands(c)


def is_integer(value: Column | str) -> Column:
    """True when a double carries no fraction, so it prints without ``.0``."""
    value = col(value)
    return value == F.floor(value)


def num_first(c: Column | str, markers=fixed.MARKERS_DASHES) -> Column:
    """First number inside a text: ``"+1,234.5 m"`` -> 1234.5."""
    hit = F.regexp_extract(clean_cell(c, markers, collapse=True), r"[-+]?\d[\d,]*(?:\.\d+)?", 0)
    return to_double(F.replace(hit, F.lit(","), F.lit("")))


def num_leading(c: Column | str) -> Column:
    """Number at the very start. Note that ``"1,234"`` reads as 1."""
    return to_double(F.regexp_extract(strip(c), r"^-?\d+(?:\.\d+)?", 0))


def num_decimal_comma(c: Column | str, whole: bool = False) -> Column:
    """Comma or dot as decimal sign; note that ``"1,234.5"`` reads as 1.234.

    ``whole`` demands that the entire cell is the number.
    """
    dotted = F.replace(strip(c), F.lit(","), F.lit("."))
    if whole:
        return to_double(dotted)
    packed = F.translate(dotted, chr(0xA0) + " ", "")
    return to_double(F.regexp_extract(packed, r"-?\d+(?:\.\d+)?", 0))


def num_space_thousands(c: Column | str, markers=fixed.MARKERS_BULLETIN) -> Column:
    """``"1 234,5"`` -> 1234.5; a cell that spans lines is not a number."""
    text = clean_cell(c, markers)
    packed = F.replace(F.regexp_replace(text, f"{WS}+", ""), F.lit(","), F.lit("."))
    return F.when(~text.contains("\n"), to_double(packed))


def num_strip(c: Column | str) -> Column:
    """Keep only digits, dots and minus signs, then read the number."""
    return to_double(F.regexp_replace(col(c), r"[^\d.\-]", ""))


def num_hash(c: Column | str) -> Column:
    """Number behind an optional ``#`` remark sign."""
    return to_double(F.regexp_replace(strip(c), r"^#\s*", ""))
