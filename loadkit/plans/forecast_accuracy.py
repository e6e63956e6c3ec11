"""Forecast accuracy: two forecast methods against actuals, by month.

Both methods are summed to their report grain before they meet the actuals, and
every later step works on that grain.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loadkit import config as C
from loadkit.functions import (
    abbreviate, abs2, if_else3, not_in, not_infinite, override, paste, pct, signed_error,
    upper_all)
from loadkit.functions.nulls import sum_or_zero
from loadkit.operators.aggregates import sum_numeric
from loadkit.operators.checks import Check, Side, report
from loadkit.operators.joins import left_lookup
from loadkit.operators.reshape import bind_tagged
from loadkit.operators.slices import align_by_slice
from loadkit.schema import sum_load

LOAD = "REPORTED_FORECAST_TAUGHT_LOAD"
FORECAST, ACTUAL, ERROR = "FCAST_EFTSL", "ACTUALS_EFTSL", "ForecastError"
ABS_ERROR = "ABSForecastError"
MONTH, METHOD, YEAR = "FCAST_MONTH", "FCAST_TYPE", "YEAR"
RENAMES = {
    "COMMENCING_STUDENT_IND": "COM_RET",
    "FUND_SOURCE_DESCRIPTION": "FUND_SOURCE",
    "SCA_COORD_CAMPUS": "CAMPUS",
    "TEACHING_FACULTY": "TEACHING_FACULTY_CD",
    "TEACHING_FACULTY_DESCRIPTION": "TEACHING_FACULTY_NAME",
    "TR_ORG_UNIT_CD": "DEPARTMENT_CD",
    "TR_ORG_UNIT_CD_DESCRIPTION": "DEPARTMENT",
}
BUCKET_FORECAST_KEYS = ("FACULTY", "DEGREE_FACULTY", "TEACHING_FACULTY",
                        "TEACHING_FACULTY_DESCRIPTION", "TR_ORG_UNIT_CD",
                        "TR_ORG_UNIT_CD_DESCRIPTION", "COURSE_LEVEL", "SCA_COORD_CAMPUS",
                        "UNIT_MODE", "FUND_SOURCE_DESCRIPTION", "COMMENCING_STUDENT_IND")
BUCKET_ACTUAL_KEYS = ("FACULTY", "DEGREE_FACULTY", "TEACHING_FACULTY_CD", "TEACHING_FACULTY_NAME",
                      "DEPARTMENT_CD", "DEPARTMENT", "COURSE_LEVEL", "CAMPUS", "UNIT_MODE",
                      "FUND_SOURCE", "COM_RET")
COURSE_FORECAST_KEYS = (*BUCKET_FORECAST_KEYS, "COURSE_CD")
COURSE_ACTUAL_KEYS = (*BUCKET_ACTUAL_KEYS, "COURSE_CD", "COURSE_DESCRIPTION")


def active_org_lookup(org_unit: DataFrame) -> DataFrame:
    """Code and name of the active organisation units."""
    return org_unit.where(F.col("ORG_STATUS") == "ACTIVE").select(
        F.col("ORG_UNIT_CD").alias("DEPARTMENT_CD"), F.col("DESCRIPTION").alias("DEPARTMENT"))


def course_forecast_extract(load: DataFrame, control: DataFrame, org_unit: DataFrame,
                            funding_source: DataFrame, degree_faculty: DataFrame,
                            control_ids: Iterable[int] = C.COURSE_FORECAST_RUNS,
                            institution: C.Institution | None = None) -> DataFrame:
    """Course-level forecast rows of some runs with names and the forecast month."""
    institution = institution or C.Institution()
    active = org_unit.where(F.col("ORG_STATUS") == "ACTIVE")
    year = {"REFERENCE_YEAR": "REFERENCE_YEAR"}
    rows = load.where(F.col("FORECAST_CONTROL_ID").isin(*control_ids))
    rows = left_lookup(rows, control, {"FORECAST_CONTROL_ID": "FORECAST_CONTROL_ID"},
                       {"REFERENCE_YEAR_PIT_DATE": "CURR_YR_FORECAST_DATE"})
    rows = left_lookup(rows, active, {"TEACHING_FACULTY": "ORG_UNIT_CD"},
                       {"DESCRIPTION": "TEACHING_FACULTY_DESCRIPTION"})
    rows = left_lookup(rows, active, {"TR_ORG_UNIT_CD": "ORG_UNIT_CD"},
                       {"DESCRIPTION": "TR_ORG_UNIT_CD_DESCRIPTION"})
    rows = left_lookup(rows, funding_source, {"FUNDING_SOURCE": "FUNDING_SOURCE"},
                       {"DESCRIPTION": "FUND_SOURCE_DESCRIPTION"})
    rows = left_lookup(rows, degree_faculty, {"DEGREE_FACULTY_ID": "DEGREE_FACULTY_ID"} | year,
                       {"DEGREE_FACULTY_NAME": "DEGREE_FACULTY"})
    rows = left_lookup(rows, degree_faculty, {"FACULTY_ID": "DEGREE_FACULTY_ID"} | year,
                       {"DEGREE_FACULTY_NAME": "FACULTY"})
    rows = rows.withColumn(MONTH, F.date_format("CURR_YR_FORECAST_DATE", "MMMM"))
    return rows.select(
        "REFERENCE_YEAR", "FORECAST_LOAD_ID", "FORECAST_CONTROL_ID", "FORECAST_METHODOLOGY_ID",
        "CURR_YR_FORECAST_DATE", "TEACHING_FACULTY", "TEACHING_FACULTY_DESCRIPTION",
        "TR_ORG_UNIT_CD", "TR_ORG_UNIT_CD_DESCRIPTION", "FACULTY", "DEGREE_FACULTY",
        "FUNDING_SOURCE", "FUND_SOURCE_DESCRIPTION", "COURSE_LEVEL", "COURSE_CD",
        "SCA_COORD_CAMPUS", "SUA_LOCATION_CD", "UNIT_MODE", "COMMENCING_STUDENT_IND",
        "OFFICIAL_CLUSTER", institution.cluster_column, "HIGH_LOW_COST", LOAD, MONTH)


def actuals_summary(actuals: DataFrame, year: int, keys: Sequence[str]) -> DataFrame:
    """Actual load of a year at the given grain."""
    return (actuals.where(F.col("YEAR") == year).groupBy(*keys)
            .agg(F.coalesce(sum_load(actuals, "EFTSL"), F.lit(0)).alias(ACTUAL)))


def forecast_summary(forecast: DataFrame, year: int, keys: Sequence[str],
                     overrides: Iterable[tuple[str, str]]) -> DataFrame:
    """Forecast load of a year at the given grain and month, named like the actuals."""
    summed = (forecast.where(F.col("REFERENCE_YEAR") == year).groupBy(*keys, MONTH)
              .agg(F.coalesce(sum_load(forecast, LOAD), F.lit(0)).alias(FORECAST)))
    return _typed(summed).withColumn("DEPARTMENT", override("DEPARTMENT_CD", "DEPARTMENT", overrides))


def _typed(summed: DataFrame) -> DataFrame:
    """Forecast rows with the names, codes and texts of the actuals."""
    return summed.withColumnsRenamed(RENAMES).withColumns({
        "COM_RET": if_else3(F.col("COM_RET") == "Y", F.lit("Commencing"), F.lit("Returning")),
        "TEACHING_FACULTY_CD": F.col("TEACHING_FACULTY_CD").cast("string"),
        "DEPARTMENT_CD": F.col("DEPARTMENT_CD").cast("string"),
        **upper_all(["TEACHING_FACULTY_NAME", "DEPARTMENT"]),
    })


def align_forecast(actuals: DataFrame, forecast: DataFrame, year: int, level: str,
                   overrides: Iterable[tuple[str, str]] | None = None) -> DataFrame:
    """Forecast and actual load of a year side by side, for every forecast month.

    `level` is `course` or `bucket`. The months are read from the raw forecast
    rows of the year, of which only the month column is scanned.
    """
    forecast_keys, actual_keys = {
        "course": (COURSE_FORECAST_KEYS, COURSE_ACTUAL_KEYS),
        "bucket": (BUCKET_FORECAST_KEYS, BUCKET_ACTUAL_KEYS),
    }[level]
    fixes = C.department_overrides(year) if overrides is None else tuple(overrides)
    months = forecast.where(F.col("REFERENCE_YEAR") == year).select(MONTH)
    return align_by_slice(
        forecast_summary(forecast, year, forecast_keys, fixes),
        actuals_summary(actuals, year, actual_keys), MONTH, slice_source=months)


# --- several years at once: what differs between years is a table keyed by year ---------

def rules_table(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """A few rules as a frame that joins like any other; `schema` is DDL."""
    fields = [part.strip().split(" ") for part in schema.split(",")]
    kind = "array<struct<" + ",".join(f"{name}:{type_}" for name, type_ in fields) + ">>"
    held = F.array(*[F.struct(*[F.lit(v).cast(type_).alias(name) for v, (name, type_) in zip(row, fields)]) for row in rows]) if rows else F.array()
    return spark.range(1).select(F.inline(held.cast(kind)))


def month_rules(spark: SparkSession, levels: Mapping[int, Sequence[str]]) -> DataFrame:
    """Forecast months of each year with their place in the report."""
    return rules_table(spark, [(y, m, k + 1) for y, months in levels.items() for k, m in enumerate(months)],
                       f"{YEAR} int, {MONTH} string, month_ord int")


def override_rules(spark: SparkSession, overrides: Mapping[int, Iterable[tuple[str, str]]]) -> DataFrame:
    """Name corrections of each year; of several for one code the last holds."""
    return rules_table(spark, [(y, code, name) for y, pairs in overrides.items() for code, name in dict(pairs).items()],
                       f"{YEAR} int, DEPARTMENT_CD string, CORRECTED string")


def align_years(actuals: DataFrame, forecast: DataFrame, level: str, overrides: DataFrame,
                years: Sequence[int] | None = None) -> DataFrame:
    """As `align_forecast`, with the year as a key: every year in one plan.

    Each year meets the months of its own forecasts and is corrected by its own
    `override_rules`; a year without rules keeps its names. A missing year is
    left out, as no run asks for it. `years` narrows both inputs at their scans.
    """
    forecast_keys, actual_keys = {
        "course": (COURSE_FORECAST_KEYS, COURSE_ACTUAL_KEYS),
        "bucket": (BUCKET_FORECAST_KEYS, BUCKET_ACTUAL_KEYS),
    }[level]

    def of_years(df: DataFrame, column: str) -> DataFrame:
        year = F.col(column)
        return df.where(year.isNotNull() if years is None else year.isin(*years)).withColumnRenamed(column, YEAR)

    given = of_years(forecast, "REFERENCE_YEAR")
    named = _typed(given.groupBy(YEAR, *forecast_keys, MONTH).agg(F.coalesce(sum_load(forecast, LOAD), F.lit(0)).alias(FORECAST)))
    named = left_lookup(named, overrides, {YEAR: YEAR, "DEPARTMENT_CD": "DEPARTMENT_CD"}, {"CORRECTED": "CORRECTED"})
    named = named.withColumn("DEPARTMENT", F.when(F.col("DEPARTMENT_CD").isNotNull(), F.coalesce("CORRECTED", "DEPARTMENT"))).drop("CORRECTED")
    load = of_years(actuals, YEAR).groupBy(YEAR, *actual_keys).agg(F.coalesce(sum_load(actuals, "EFTSL"), F.lit(0)).alias(ACTUAL))
    return align_by_slice(named, load, MONTH, slice_source=given.select(YEAR, MONTH), within=[YEAR])


def accuracy_totals(parts: Mapping[str, tuple[DataFrame, DataFrame, DataFrame]]) -> DataFrame:
    """Control totals of each method, from (forecast, actuals, aligned) at report grain, in one pass.

    The forecast before the alignment is held against the forecast after it: a
    row that met several actual rows counts more than once. The actual load is
    expected once for every month of the forecast.
    """
    frames, checks = {}, []
    for method, (forecast, actual, aligned) in parts.items():
        months = forecast.select(F.collect_set(MONTH)).scalar()
        frames |= {f"{method} forecast": forecast, f"{method} actuals": actual.withColumn("months", F.size(months)), f"{method} aligned": aligned}
        checks += [
            Check(f"{method}:{FORECAST}", Side(f"{method} forecast", "total", F.col(FORECAST), F.col(MONTH).isNotNull()),
                  Side(f"{method} aligned", "total", F.col(FORECAST))),
            Check(f"{method}:{ACTUAL}", Side(f"{method} actuals", "total", F.col(ACTUAL) * F.col("months")),
                  Side(f"{method} aligned", "total", F.col(ACTUAL))),
            Check(f"{method}:rows with a forecast", Side(f"{method} forecast", "rows", None, F.col(MONTH).isNotNull()),
                  Side(f"{method} aligned", "rows", None, F.col(FORECAST).isNotNull()))]
    return report(frames, checks)


def consolidate(course: DataFrame, bucket: DataFrame) -> DataFrame:
    """Both methods in one frame; the course columns are missing for buckets."""
    return bind_tagged([("Course", course), ("Bucket", bucket)], METHOD)


def _all_differ(name: str, values: Sequence[str]) -> Column:
    """A chain of comparisons; a missing value is in none of them, so its row is dropped."""
    return reduce(lambda a, b: a & b, [F.col(name) != v for v in values], F.lit(True))


def in_scope(df: DataFrame, scope: C.Scope) -> DataFrame:
    """Rows of the error tables: a missing campus is dropped, a missing faculty kept."""
    return df.where(_all_differ("CAMPUS", scope.excluded_campuses) & not_in(F.col("FACULTY"), scope.excluded_faculties))


def in_totals(df: DataFrame, scope: C.Scope) -> DataFrame:
    """Rows of the control totals: a missing campus and a missing faculty are both dropped."""
    return df.where(_all_differ("CAMPUS", scope.excluded_campuses) & _all_differ("FACULTY", scope.outside_totals))


def month_order(levels: Sequence[str]) -> Column:
    """Position of the month in the report, missing for a month outside the list."""
    table = F.create_map(*[x for k, m in enumerate(levels) for x in (F.lit(m), F.lit(k + 1))])
    return F.when(F.col(MONTH).isNotNull(), F.try_element_at(table, F.col(MONTH)))


def error_base(consolidated: DataFrame, levels: Sequence[str], scope: C.Scope) -> DataFrame:
    """In-scope rows with the signed error; months outside the list become missing.

    The error is rounded per row, so sums of it are sums of rounded values.
    """
    rows = _with_error(consolidated, scope).withColumn("month_ord", month_order(levels))
    return _known_months(rows)


def _with_error(consolidated: DataFrame, scope: C.Scope) -> DataFrame:
    rows = in_scope(consolidated, scope).withColumns({
        FORECAST: F.coalesce(F.col(FORECAST), F.lit(0)),
        ACTUAL: F.coalesce(F.col(ACTUAL), F.lit(0)),
    })
    return rows.withColumn(ERROR, signed_error(FORECAST, ACTUAL))


def _known_months(rows: DataFrame) -> DataFrame:
    return rows.withColumn(MONTH, F.when(F.col("month_ord").isNotNull(), F.col(MONTH)))


def error_base_years(consolidated: DataFrame, months: DataFrame, scope: C.Scope) -> DataFrame:
    """As `error_base`, for the years of `align_years`: `month_rules` say which months a year has and in which order."""
    rows = left_lookup(_with_error(consolidated, scope), months, {YEAR: YEAR, MONTH: MONTH}, {"month_ord": "month_ord"})
    return _known_months(rows)


# --- error tables: grouping sets over one base ------------------------------------------

IN_FACULTY, TABLE, UNIT = "IN_FACULTY", "TABLE", ("TEACHING_FACULTY_CD", "DEPARTMENT_CD")
# What each table is grouped by besides month and method. The unit tables are summed by unit first
# and then, the unit's faculty being looked up, by its abbreviation.
TABLES: dict[str, tuple[str, ...]] = {
    "month": (),
    "faculty": (IN_FACULTY, *UNIT),
    "faculty_fund": ("FUND_SOURCE", IN_FACULTY, *UNIT),
    "course": ("FACULTY", "COURSE_CD", "COM_RET", "FUND_SOURCE"),
}
SHOWN = ("FUND_SOURCE", "TEACHING_FAC_ABBREV", "FACULTY", "COURSE_CD", "COM_RET")


def error_tables(base: DataFrame, tables: Sequence[str] = tuple(TABLES), org: DataFrame | None = None,
                 abbreviations: DataFrame | None = None, pattern: str = C.FACULTY_PATTERN,
                 funds: Sequence[str] = C.KEY_FUND_SOURCES, by: Sequence[str] = ()) -> DataFrame:
    """Any of the error tables as one long frame, from one pass over the base.

    All levels come from one grouping-sets aggregation; the unit levels are then
    looked up and summed again together. `TABLE` names the table a row belongs
    to; columns that a table does not have are missing. `by` lists keys that
    every table has too, such as the year. Only the loads, the error and the sum
    of absolute errors are carried.
    """
    common = [*by, MONTH, METHOD]
    extra = list(dict.fromkeys(c for t in tables for c in TABLES[t]))
    every, units = [*common, *extra], [t for t in tables if IN_FACULTY in TABLES[t]]
    rows = base.withColumn(ABS_ERROR, abs2(ERROR))
    if units:
        rows = rows.withColumn(IN_FACULTY, F.coalesce(F.col("TEACHING_FACULTY_NAME").contains(pattern), F.lit(False)))
    measures = (FORECAST, ACTUAL, ERROR, ABS_ERROR)
    sums = [sum_or_zero(m).alias(m) for m in measures]
    if len(tables) == 1:
        cube = rows.groupBy(*every).agg(*sums).withColumn(TABLE, F.lit(tables[0]))
    else:
        levels = [[F.col(c) for c in (*common, *TABLES[t])] for t in tables]
        # The grouping id has a bit for each key that a level leaves out.
        ids = {t: sum(1 << k for k, c in enumerate(reversed(every)) if c not in common and c not in TABLES[t]) for t in tables}
        named = F.create_map(*[x for t, i in ids.items() for x in (F.lit(i).cast("long"), F.lit(t))])
        cube = rows.groupingSets(levels, *[F.col(c) for c in every]).agg(F.grouping_id().alias("level"), *sums)
        cube = cube.withColumn(TABLE, F.element_at(named, F.col("level").cast("long"))).drop("level")
    table = F.col(TABLE)
    if units:
        cube = cube.where(~table.isin(*units) | F.col(IN_FACULTY)).drop(IN_FACULTY)
    if {"faculty_fund", "course"} & set(tables):
        cube = cube.where(~table.isin("faculty_fund", "course") | F.col("FUND_SOURCE").isin(*funds))
    if "course" in tables:
        cube = cube.where((table != "course") | (F.col(METHOD) == "Course"))
    if units:
        of_unit = table.isin(*units)
        faculties = org.select(F.struct("DEPARTMENT_CD").alias("unit"), F.struct("DEPARTMENT").alias("named"))
        short = abbreviations.select(F.struct(F.col("TEACHING_FACULTY_NAME").alias("DEPARTMENT")).alias("named"), "TEACHING_FAC_ABBREV")
        # A struct is never missing, so a missing code meets a missing code; rows of other tables have no struct and meet nothing.
        departments = org.select(F.struct("DEPARTMENT_CD").alias("department"))
        cube = cube.withColumns({"unit": F.when(of_unit, F.struct(F.col(UNIT[0]).alias("DEPARTMENT_CD"))),
                                 "department": F.when(of_unit, F.struct(F.col(UNIT[1]).alias("DEPARTMENT_CD")))})
        cube = cube.join(faculties, "unit", "left").join(departments, "department", "left")
        unknown = F.when(of_unit, F.struct(F.lit(None).cast("string").alias("DEPARTMENT")))
        cube = cube.withColumn("named", F.coalesce("named", unknown)).join(short, "named", "left").drop("unit", "department", "named", *UNIT)
        keys = [TABLE, *common, *[c for c in SHOWN if c in cube.columns]]
        cube = cube.groupBy(*keys).agg(*sums)
    total = abs2(ERROR)
    cube = cube.withColumns({"percError": pct(ERROR, ACTUAL), "ABSpercError": pct(total, ACTUAL)})
    missing = {c: F.lit(None).cast("string") for c in SHOWN if c not in cube.columns}
    return cube.withColumns(missing).select(TABLE, *common, *SHOWN, *measures, "percError", "ABSpercError") if missing else (
        cube.select(TABLE, *common, *SHOWN, *measures, "percError", "ABSpercError"))


def error_by_month(base: DataFrame) -> DataFrame:
    """Loads, summed error and percentage by month and method."""
    return error_tables(base, ["month"]).select(MONTH, METHOD, FORECAST, ACTUAL, ERROR, "percError")


def error_summary(base: DataFrame) -> DataFrame:
    """Loads, summed error and sum of absolute row errors by month and method."""
    return error_tables(base, ["month"]).select(MONTH, METHOD, FORECAST, ACTUAL, ERROR, ABS_ERROR)


def report_table(summary: DataFrame, levels: Sequence[str]) -> DataFrame:
    """The summary in report order and with report names."""
    ordered = summary.withColumn("month_ord", month_order(levels)).orderBy(
        F.col("month_ord").asc_nulls_last(), F.col(METHOD))
    return ordered.select(
        F.col(MONTH).alias("Month"), F.col(METHOD).alias("Forecast Type"),
        F.col(FORECAST).alias("Forecast (EFTSL)"), F.col(ACTUAL).alias("Actual Load"),
        F.col(ERROR).alias("Error"), F.col(ABS_ERROR).alias("Absolute Error"))


def error_by_faculty(base: DataFrame, org: DataFrame, abbreviations: DataFrame,
                     pattern: str = C.FACULTY_PATTERN) -> DataFrame:
    """Error by teaching faculty, method and month."""
    out = error_tables(base, ["faculty"], org, abbreviations, pattern)
    return out.select("TEACHING_FAC_ABBREV", METHOD, MONTH, FORECAST, ACTUAL, ERROR, "percError")


def error_by_faculty_fund(base: DataFrame, org: DataFrame, abbreviations: DataFrame,
                          pattern: str = C.FACULTY_PATTERN,
                          funds: Sequence[str] = C.KEY_FUND_SOURCES,
                          short_names: dict[str, str] | None = None) -> DataFrame:
    """Error by key fund source, teaching faculty, method and month."""
    out = error_tables(base, ["faculty_fund"], org, abbreviations, pattern, funds)
    return out.select("FUND_SOURCE", "TEACHING_FAC_ABBREV", METHOD, MONTH, FORECAST, ACTUAL, ERROR, "percError").withColumn(
        "FUND_SOURCE_ABBREV", abbreviate("FUND_SOURCE", short_names or C.FUND_ABBREVIATIONS))


def error_by_course(base: DataFrame, funds: Sequence[str] = C.KEY_FUND_SOURCES) -> DataFrame:
    """Error by course for the course method; rows with an infinite percentage are left out.

    The absolute error here is that of the sum, not the sum of absolute errors.
    """
    out = error_tables(base, ["course"], funds=funds).where(not_infinite("ABSpercError"))
    return out.select("FACULTY", "COURSE_CD", "COM_RET", "FUND_SOURCE", MONTH, FORECAST, ACTUAL, ERROR, abs2(ERROR).alias(ABS_ERROR),
                      "percError", "ABSpercError", paste("FACULTY", "COURSE_CD", "COM_RET", "FUND_SOURCE").alias("row_id"))


def workload_report(rows: DataFrame, month: str = "June") -> DataFrame:
    """Rows to analyse per faculty for one forecast month."""
    return rows.where(F.col("Month") == month).drop("Month")
