"""Null-safe predicates with pandas semantics (membership never yields null)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_member(c, values) -> Column:
    """``c IN values`` where null is simply not a member."""
    return F.coalesce(_col(c).isin(list(values)), F.lit(False))


def not_member(c, values) -> Column:
    return ~is_member(c, values)


def eq(c, value) -> Column:
    """``c == value`` with null -> False."""
    return F.coalesce(_col(c) == F.lit(value), F.lit(False))


def ne(c, value) -> Column:
    """``c != value`` with null -> True (object-column comparison)."""
    return ~_col(c).eqNullSafe(F.lit(value))


def is_true(cond: Column) -> Column:
    """Null condition counts as false."""
    return F.coalesce(cond, F.lit(False))
