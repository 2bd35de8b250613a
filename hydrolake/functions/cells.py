"""Missing markers."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, functions as F

from hydrolake.functions import fixed
from hydrolake.functions._base import col
from hydrolake.functions.text import clean_text, strip


def clean_cell(c: Column | str, markers: Iterable[str] = fixed.MARKERS_NULL_WORDS,
               collapse: bool = False, ignore_case: bool = False) -> Column:
    """Trim a cell and turn a source's missing markers into null.

    ``collapse`` also folds inner white space (page cells); ``ignore_case``
    compares markers in lower case.
    """
    text = clean_text(c) if collapse else strip(col(c))
    probe = F.lower(text) if ignore_case else text
    wanted = {m.lower() for m in markers} if ignore_case else set(markers)
    return F.when(~probe.isin(*sorted(wanted | {""})), text)
