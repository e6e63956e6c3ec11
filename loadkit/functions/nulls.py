"""Rules for missing values that differ from Spark's defaults."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_column(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def strict_sum(col: Column | str) -> Column:
    """Sum that is missing as soon as one value is missing; 0 for no rows."""
    c = as_column(col)
    return F.when(F.count(c) == F.count(F.lit(1)), F.coalesce(F.sum(c), F.lit(0)))


def sum_or_zero(col: Column | str) -> Column:
    """Sum of the present values; 0 when none is present."""
    return F.coalesce(F.sum(as_column(col)), F.lit(0))


def if_else3(cond: Column, yes: Column, no: Column) -> Column:
    """Two-way choice that stays missing when the condition is missing."""
    return F.when(cond, yes).when(~cond, no)


def not_in(col: Column | str, values: Iterable, keep_null: bool = True) -> Column:
    """`NOT IN` that keeps (or drops) rows with a missing value."""
    outside = ~as_column(col).isin(*values)
    return F.coalesce(outside, F.lit(keep_null))


def not_infinite(col: Column | str) -> Column:
    """True for finite, missing and NaN values alike."""
    c = as_column(col)
    return F.coalesce(F.isnan(c) | (F.abs(c) != F.lit(float("inf"))), F.lit(True))


def missing_as_text(col: Column | str) -> Column:
    """Text of a value, with a missing value written as NA."""
    return F.coalesce(as_column(col).cast("string"), F.lit("NA"))
