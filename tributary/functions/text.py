"""Text and time expressions used everywhere."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# What Python calls white space: Unicode white space plus the four separator controls.
WHITE = r"[\s\x1c-\x1f]"


def non_empty(c: Column | str) -> Column:
    """The value, or NULL where it is empty."""
    c = F.col(c) if isinstance(c, str) else c
    return F.nullif(c, F.lit(""))


def first_non_empty(*cols: Column | str) -> Column:
    """First value that is neither NULL nor empty."""
    return F.coalesce(*[non_empty(c) for c in cols])


def strip(c: Column) -> Column:
    return F.regexp_replace(c, rf"(?U)^{WHITE}+|{WHITE}+$", "")


def split_list(c: Column) -> Column:
    """Comma-separated text as an array of stripped, non-empty items."""
    items = F.transform(F.split(c, ","), strip)
    return F.filter(items, lambda x: x != "")


def starts_with_any(c: Column, prefixes) -> Column:
    tests = [c.startswith(p) for p in prefixes]
    return reduce(lambda a, b: a | b, tests, F.lit(False))


def cycle_key(ts: Column) -> Column:
    """UTC `YYYYMMDDTHHMMSS` (the session time zone is UTC)."""
    return F.date_format(ts, "yyyyMMdd'T'HHmmss")


def floor_minute(ts: Column) -> Column:
    return F.date_trunc("minute", ts)


def computed(array: Column) -> Column:
    """The array as an expression of its own, for use under a generator. For a bare column the
    optimizer adds size and null checks and pushes them, with whatever computes the array,
    below the projections: an array found by regular expressions would be computed twice."""
    return F.concat(array, F.array())
