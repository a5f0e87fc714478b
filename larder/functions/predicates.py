"""Filters, predicates and conditional scalars."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.functions._util import as_col
from larder.functions.text import nonempty


def require(df: DataFrame, *cols) -> DataFrame:
    """Drop rows where any of ``cols`` is NULL (P2 P8 P9); pushed down to the scan."""
    cond = None
    for c in cols:
        p = as_col(c).isNotNull()
        cond = p if cond is None else cond & p
    return df if cond is None else df.filter(cond)


def require_nonempty(df: DataFrame, *cols) -> DataFrame:
    """Drop rows where any of ``cols`` is NULL or '' (P3)."""
    cond = None
    for c in cols:
        p = nonempty(c)
        cond = p if cond is None else cond & p
    return df if cond is None else df.filter(cond)


def allow_or_null(c, values: Iterable) -> Column:
    """The value if it is in the allow-list, else NULL."""
    c = as_col(c)
    return F.when(c.isin(list(values)), c)


def not_in_nonnull(c, values: Iterable) -> Column:
    """Predicate: non-NULL and outside the allow-list (P5)."""
    c = as_col(c)
    return c.isNotNull() & ~c.isin(list(values))


def cap_filter(c, upper) -> Column:
    """Predicate ``c <= upper``; NULL does not pass."""
    return as_col(c) <= F.lit(upper)


def out_of_range(c, lo=None, hi=None) -> Column:
    """Predicate: non-NULL and below ``lo`` or above ``hi``."""
    c = as_col(c)
    bad = F.lit(False)
    if lo is not None:
        bad = bad | (c < F.lit(lo))
    if hi is not None:
        bad = bad | (c > F.lit(hi))
    return c.isNotNull() & bad


def if_(cond: Column, value, otherwise=None) -> Column:
    """``IF(cond, x, NULL)`` (M7)."""
    v = as_col(value) if isinstance(value, (str, Column)) else F.lit(value)
    out = F.when(cond, v)
    return out if otherwise is None else out.otherwise(otherwise)
