"""Readers: database tables and queries, delimited files, extracts, SQL files."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from pathlib import Path
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType, NumericType, StringType, StructType

from loadkit.operators.reshape import bind_tagged


def _jdbc(spark: SparkSession, url: str, user: str | None, password: str | None,
          options: Mapping[str, Any]):
    reader = spark.read.format("jdbc").option("url", url)
    for key, value in {"user": user, "password": password, **options}.items():
        if value is not None:
            reader = reader.option(key, str(value))
    return reader


def read_query(spark: SparkSession, url: str, query: str, user: str | None = None,
               password: str | None = None, **options) -> DataFrame:
    """Result of a query that runs in the database; fit for aggregated results."""
    return _jdbc(spark, url, user, password, options).option("query", query).load()


def read_table(spark: SparkSession, url: str, table: str, user: str | None = None,
               password: str | None = None, partition_column: str | None = None,
               bounds: tuple[Any, Any] | None = None, partitions: int | None = None,
               **options) -> DataFrame:
    """A database table; facts are read in parallel over a numeric or date column."""
    reader = _jdbc(spark, url, user, password, options).option("dbtable", table)
    if partition_column is not None:
        if bounds is None or partitions is None:
            raise ValueError("a partition column needs bounds and a number of partitions")
        reader = (reader.option("partitionColumn", partition_column)
                  .option("lowerBound", str(bounds[0])).option("upperBound", str(bounds[1]))
                  .option("numPartitions", str(partitions)))
    return reader.load()


def _delimited(spark: SparkSession, path: str, sep: str, schema: StructType) -> DataFrame:
    # Empty fields and the text NA are both missing.
    return spark.read.csv(path, sep=sep, header=True, schema=schema, nullValue="NA",
                          emptyValue="", enforceSchema=False)


def read_csv(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    return _delimited(spark, path, ",", schema)


def read_tsv(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    return _delimited(spark, path, "\t", schema)


def read_extract(spark: SparkSession, path: str, schema: StructType, optional: Iterable[str] = ()) -> DataFrame:
    """A spreadsheet extract saved as Parquet or CSV, with its columns brought to `schema`.

    Columns that the schema does not name are left out. Only `optional` columns may be
    absent; they are missing then. Text that should be a number is read leniently: what is
    not a number becomes missing, and whole numbers may be written as 2018.0.
    """
    if path.endswith((".csv", ".txt")):
        text = spark.read.csv(path, header=True, nullValue="NA")
    else:
        text = spark.read.parquet(path)
    have = {f.name: f.dataType for f in text.schema.fields}
    absent = [f.name for f in schema.fields if f.name not in have and f.name not in set(optional)]
    if absent:
        raise ValueError(f"{path} lacks the columns {absent}")

    def column(field):
        if field.name not in have:
            return F.lit(None).cast(field.dataType).alias(field.name)
        col = F.col(f"`{field.name}`")
        if isinstance(field.dataType, IntegralType) and not isinstance(have[field.name], IntegralType):
            number = col.try_cast("double")
            return F.when(number == F.floor(number), number).try_cast(field.dataType).alias(field.name)
        lenient = isinstance(field.dataType, NumericType) and isinstance(have[field.name], StringType)
        return (col.try_cast(field.dataType) if lenient else col.cast(field.dataType)).alias(field.name)

    return text.select(*[column(f) for f in schema.fields])


def read_tagged(spark: SparkSession, files: Iterable[tuple[str, str]], schema: StructType,
                tag: str = "FCAST_MONTH", optional: Iterable[str] = ()) -> DataFrame:
    """Several extracts as one table, each row with the label of its file; labels may repeat."""
    may_lack = tuple(optional)
    return bind_tagged([(label, read_extract(spark, path, schema, may_lack)) for label, path in files], tag)


def register_views(tables: Mapping[str, DataFrame]) -> None:
    for name, df in tables.items():
        df.createOrReplaceTempView(name)


def run_sql_file(spark: SparkSession, path: str, args: Mapping[str, Any] | None = None) -> DataFrame:
    """Run the SQL text of a file over registered views, with named parameters."""
    return spark.sql(Path(path).read_text().strip().rstrip(";"), args=dict(args or {}))
