"""Comparisons whose result is never null: a missing value equals nothing, not even another missing value."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def same(a: Column, b: Column) -> Column:
    """True only for two equal values that are there."""
    return F.coalesce(a == b, F.lit(False))


def differs(a: Column, b: Column) -> Column:
    """True for different values and wherever one of them, or both, are missing."""
    return ~same(a, b)


def within(a: Column, values) -> Column:
    """Membership; a missing value is in no list."""
    values = list(values)
    return F.coalesce(a.isin(values), F.lit(False)) if values else F.lit(False)


def starts(a: Column, prefix: str, missing: bool = False) -> Column:
    return F.coalesce(a.startswith(prefix), F.lit(missing))
