"""Small helpers shared by the column functions."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import Column, functions as F


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def extract(c: Column | str, pattern: str, group: int = 1) -> Column:
    """First match of a group, null (not '') when there is no match."""
    c = col(c)
    return F.when(c.rlike(pattern), F.regexp_extract(c, pattern, group))


def blank_to_null(c: Column | str) -> Column:
    return F.nullif(col(c), F.lit(""))


def literal_map(values: dict) -> Column:
    """A constant map; callers pass fixed tables of a few dozen entries."""
    return F.create_map(*[F.lit(x) for kv in values.items() for x in kv])


_INLINE = False


@contextmanager
def inlined():
    """Inside, ``let`` repeats the value's expression instead of binding it: longer, but without lambdas."""
    global _INLINE
    before, _INLINE = _INLINE, True
    try:
        yield
    finally:
        _INLINE = before


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once and use it several times in ``body``."""
    if _INLINE:
        return body(value)
    return F.get(F.transform(F.array(value), body), F.lit(0))
