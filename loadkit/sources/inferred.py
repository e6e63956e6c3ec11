"""Delimited text without a given schema: types from a bounded sample, misfits told apart instead of lost."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Types that a column may turn out to have, the first that holds all sampled values wins; text holds any.
CANDIDATES: tuple[T.DataType, ...] = (T.LongType(), T.DoubleType(), T.DateType(), T.TimestampType())
FILE, POSITION = "__file", "__position"


@dataclass(frozen=True)
class Inferred:
    """`table` has the inferred types. `rejects` has one row per value that its type does not hold: file, position, column, value, type.

    Position orders the rows of a file: it grows along the file, with gaps
    where Spark reads the file in several splits.
    """

    table: DataFrame
    rejects: DataFrame
    schema: T.StructType


def _fits(value: Column, kind: T.DataType) -> Column:
    """Whether a text is a value of the type, written as that type is: a number with a fraction is no whole number."""
    if isinstance(kind, T.LongType):
        return value.rlike(r"^\s*[+-]?[0-9]+\s*$") & value.try_cast(kind).isNotNull()
    if isinstance(kind, T.DateType):
        return value.rlike(r"^\s*[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}\s*$") & value.try_cast(kind).isNotNull()
    return value.try_cast(kind).isNotNull()


def read_inferred(spark: SparkSession, path: str | Sequence[str], sep: str = ",", sample: int = 3000,
                  as_text: Sequence[str] = (), missing: str = "NA") -> Inferred:
    """Read files with a header and decide each column's type from the first `sample` rows of every file.

    Empty fields and `missing` are missing values and fit every type; a column
    without a sampled value is text, and so are the columns of `as_text`, such
    as codes that look like numbers. Only one row of counts reaches the driver.
    A value beyond the sample that does not fit is missing in the table and
    listed among the rejects, with its file, position and text.
    """
    paths = [path] if isinstance(path, str) else list(path)
    text = spark.read.csv(paths, sep=sep, header=True, nullValue=missing, emptyValue="")
    names = text.columns
    value = {n: F.nullif(F.col(f"`{n}`"), F.lit("")) for n in names}
    # The low bits of the id count the rows of a split.
    at = F.monotonically_increasing_id()
    begins = F.col("_metadata.file_block_start").alias("__begins")
    whole = text.select(F.col("_metadata.file_path").alias(FILE), at.alias(POSITION), begins, *[value[n].alias(n) for n in names])
    first = whole.where((F.col("__begins") == 0) & (F.col(POSITION).bitwiseAND(F.lit((1 << 33) - 1)) < sample))
    raw = whole.drop("__begins")
    counts = []
    for i, n in enumerate(names):
        counts.append(F.count(F.col(f"`{n}`")).alias(f"n{i}"))
        counts += [F.count_if(_fits(F.col(f"`{n}`"), kind)).alias(f"n{i}_{k}") for k, kind in enumerate(CANDIDATES)]
    found = first.agg(*counts).first()
    kinds: list[T.DataType] = []
    for i, n in enumerate(names):
        fitting = [kind for k, kind in enumerate(CANDIDATES) if found[f"n{i}"] and found[f"n{i}_{k}"] == found[f"n{i}"]]
        kinds.append(fitting[0] if fitting and n not in as_text else T.StringType())
    schema = T.StructType([T.StructField(n, kind) for n, kind in zip(names, kinds)])
    typed = [n for n, kind in zip(names, kinds) if not isinstance(kind, T.StringType)]

    def held(n: str) -> Column:
        col, kind = F.col(f"`{n}`"), schema[n].dataType
        return F.when(_fits(col, kind), col.try_cast(kind)) if n in typed else col

    table = raw.select(*[held(n).alias(n) for n in names])
    misfit = [F.when(F.col(f"`{n}`").isNotNull() & ~_fits(F.col(f"`{n}`"), schema[n].dataType),
                     F.struct(F.lit(n).alias("column"), F.col(f"`{n}`").alias("value"), F.lit(schema[n].dataType.simpleString()).alias("type")))
              for n in typed]
    none = F.array().cast("array<struct<column:string,value:string,type:string>>")
    bad = raw.select(FILE, POSITION, F.explode(F.array_compact(F.array(*misfit)) if misfit else none).alias("bad"))
    rejects = bad.select(F.col(FILE).alias("file"), F.col(POSITION).alias("position"), "bad.column", "bad.value", "bad.type")
    return Inferred(table, rejects, schema)
