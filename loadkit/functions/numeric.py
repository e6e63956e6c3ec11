"""Error metrics: half-even rounding and division that does not fail on zero."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from loadkit.functions.nulls import as_column

INF = float("inf")
NAN = float("nan")


def round2(col: Column | str) -> Column:
    """Round half to even at two places."""
    return F.bround(as_column(col), 2)


def abs2(col: Column | str) -> Column:
    return round2(F.abs(as_column(col)))


def signed_error(forecast: Column | str, actual: Column | str) -> Column:
    """Forecast minus actual, rounded per row."""
    return round2(as_column(forecast) - as_column(actual))


def safe_ratio(num: Column | str, den: Column | str) -> Column:
    """num / den as a double: x/0 is plus or minus infinity and 0/0 is NaN."""
    n, d = as_column(num).cast("double"), as_column(den).cast("double")
    by_zero = (F.when(F.isnan(n) | (n == 0), F.lit(NAN))
               .when(n > 0, F.lit(INF)).otherwise(F.lit(-INF)))
    return (F.when(n.isNull() | d.isNull(), F.lit(None).cast("double"))
            .when(d == 0, by_zero).otherwise(F.try_divide(n, d)))


def pct(num: Column | str, den: Column | str) -> Column:
    """Percentage at two places."""
    return round2(safe_ratio(F.lit(100) * as_column(num), den))
