"""Text helpers."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from loadkit.functions.nulls import missing_as_text


def paste(*cols: Column | str, sep: str = " ") -> Column:
    """Concatenate with a separator; missing pieces read NA."""
    return F.concat_ws(sep, *[missing_as_text(c) for c in cols])


def upper_all(names: Iterable[str]) -> dict[str, Column]:
    """Upper-cased versions of the named columns, for `withColumns`."""
    return {n: F.upper(F.col(n)) for n in names}
