"""CSV output."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadkit.schema import decimals_to_double


def write_csv(df: DataFrame, path: str, na: str = "NA", single_file: bool = False,
              mode: str = "errorifexists", order: Sequence[str] = ()) -> None:
    """Write CSV with a header and `na` for missing values (empty text is a choice).

    `single_file` is for reports. With `order` the rows are computed in as many
    tasks as before and only then dealt to one, which sorts them (missing values
    last) and may spill. Without `order` a sorted frame keeps its own.
    """
    out, by = decimals_to_double(df), [F.col(f"`{c}`").asc_nulls_last() for c in order]
    if by:
        out = out.repartition(1).sortWithinPartitions(*by) if single_file else out.orderBy(*by)
    elif single_file:
        out = out.coalesce(1)
    out.write.mode(mode).csv(path, header=True, nullValue=na, emptyValue="")


def publish_csv(df: DataFrame, folder: str, name: Callable[[DataFrame], str], na: str = "NA", order: Sequence[str] = ()) -> str:
    """Write one CSV whose name comes from the data; returns its path.

    The frame is computed once, into a staging folder beside the result; the
    name is read from the staged rows, which are then written as one file. The
    staged rows stay: delete `folder/_staging` when no run is under way.
    """
    staged = f"{folder}/_staging/{uuid.uuid4().hex}"
    decimals_to_double(df).write.parquet(staged)
    rows = df.sparkSession.read.parquet(staged)
    path = f"{folder}/{name(rows)}"
    write_csv(rows, path, na, single_file=True, order=order)
    return path
