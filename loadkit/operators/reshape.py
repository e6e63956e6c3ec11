"""Wide to long, long to wide, and stacking."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadkit.config import NO_MEASURE
from loadkit.functions.nulls import strict_sum


def unpivot_drop_null(df: DataFrame, ids: Sequence[str], columns: Sequence[str],
                      name: str, value: str) -> DataFrame:
    """One row per (row, column) whose value is present."""
    return df.unpivot(list(ids), list(columns), name, value).where(F.col(value).isNotNull())


def pivot_fixed(df: DataFrame, ids: Sequence[str], name: str, value: str,
                values: Sequence[str], missing: str = NO_MEASURE) -> DataFrame:
    """One column per listed name, holding the strict sum of its rows.

    A missing name is the column `missing`. The value list is explicit, so no
    extra job looks for names and the schema does not depend on the data. A
    cell with a missing value is missing, and so is a cell without rows.
    """
    named = df.withColumn(name, F.coalesce(F.col(name), F.lit(missing)))
    # One row per cell, which the greatest value takes as it is; Spark's own pivot is not compiled.
    loads = named.groupBy(*ids, name).agg(strict_sum(value).alias("__load"))
    return loads.groupBy(*ids).agg(*[F.max(F.when(F.col(name) == v, F.col("__load"))).alias(v) for v in values])


def union_distinct(*frames: DataFrame) -> DataFrame:
    """Union by column name without duplicates; missing equals missing."""
    return reduce(lambda a, b: a.unionByName(b), frames).distinct()


def bind_tagged(frames: Iterable[tuple[str, DataFrame]] | Mapping[str, DataFrame],
                tag: str) -> DataFrame:
    """Stack frames by column name, each with its label in `tag`.

    Labels may repeat. Columns that a frame lacks are missing in its rows.
    """
    items = frames.items() if isinstance(frames, Mapping) else frames
    tagged = [df.withColumn(tag, F.lit(label)) for label, df in items]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)
