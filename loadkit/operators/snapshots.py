"""Choosing rows of a catalogue: latest snapshot, point in time, latest version.

Most snapshot helpers return a scalar-subquery column. It is evaluated once at
run time, prunes a fact partitioned by snapshot, and fails when the catalogue
names more than one snapshot. `resolve_snapshots` looks several ids up in one
small job instead, for plans that would repeat the subqueries many times.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def run_date(spark: SparkSession, as_of: date | None = None) -> date:
    """The date of a run: `as_of`, or the session's current date, settled once so that all parts of a run share it."""
    return as_of or spark.range(1).select(F.current_date()).first()[0]


def latest_by_date(control: DataFrame, year: int) -> Column:
    """Snapshot id with the greatest date within the year."""
    rows = control.where(F.col("REFERENCE_YEAR") == year)
    newest = rows.agg(F.max("SNAPSHOT_DATE")).scalar()
    return rows.where(F.col("SNAPSHOT_DATE") == newest).select("SNAPSHOT_ID").scalar()


def latest_by_id(control: DataFrame, year: int) -> Column:
    """Greatest snapshot id of the year."""
    return control.where(F.col("REFERENCE_YEAR") == year).agg(F.max("SNAPSHOT_ID")).scalar()


def point_in_time(control: DataFrame, as_of: date, year: int) -> Column:
    """Smallest snapshot id of the year taken on the day and month of `as_of`.

    Missing when the year has no such day, so that no row matches.
    """
    same_day = F.date_format("SNAPSHOT_DATE", "ddMM") == F.lit(as_of.strftime("%d%m"))
    return (control.where((F.col("REFERENCE_YEAR") == year) & same_day)
            .agg(F.min("SNAPSHOT_ID")).scalar())


def latest_run(control: DataFrame, column: str = "FORECAST_CONTROL_ID") -> Column:
    """Greatest run id of a control table."""
    return control.agg(F.max(column)).scalar()


def resolve_snapshots(control: DataFrame, first_year: int, last_year: int,
                      as_of: date) -> dict[int, tuple[int | None, int | None]]:
    """(latest id by date, id at the day of `as_of`) of each year, from one pass.

    One row per year reaches the driver, as literals that prune the fact scan.
    """
    newest = F.rank().over(Window.partitionBy("REFERENCE_YEAR").orderBy(F.desc("SNAPSHOT_DATE"))) == 1
    same_day = F.date_format("SNAPSHOT_DATE", "ddMM") == F.lit(as_of.strftime("%d%m"))
    rows = (control.where(F.col("REFERENCE_YEAR").between(first_year, last_year)
                          & F.col("SNAPSHOT_DATE").isNotNull())
            .withColumn("__newest", newest).groupBy("REFERENCE_YEAR")
            .agg(F.count_if("__newest").alias("n"),
                 F.max(F.when(F.col("__newest"), F.col("SNAPSHOT_ID"))).alias("latest"),
                 F.min(F.when(same_day, F.col("SNAPSHOT_ID"))).alias("pit")).collect())
    doubled = [r["REFERENCE_YEAR"] for r in rows if r["n"] > 1]
    if doubled:
        raise ValueError(f"more than one latest snapshot for {sorted(doubled)}")
    found = {r["REFERENCE_YEAR"]: (r["latest"], r["pit"]) for r in rows}
    return {year: found.get(year, (None, None)) for year in range(first_year, last_year + 1)}


def latest_version(versions: DataFrame, bound: Column | date, key: str = "COURSE_CD",
                   version: str = "VERSION_NUMBER", start: str = "START_DT",
                   value: str = "ABBREVIATION") -> DataFrame:
    """Distinct (key, value) of the greatest version that starts by `bound`.

    The bound chooses the version number only: every row with that number
    counts, also one that starts later, and ties on the number all stay.
    """
    limit = bound if isinstance(bound, Column) else F.lit(bound)
    rows = versions.where(F.col(key).isNotNull()).groupBy(key, version, value).agg(
        F.bool_or(F.col(start) <= limit).alias("__in_bound"))
    newest = F.max(F.when(F.col("__in_bound"), F.col(version))).over(Window.partitionBy(key))
    return rows.withColumn("__newest", newest).where(F.col(version) == F.col("__newest")).select(key, value).distinct()
