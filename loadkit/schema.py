"""Input schemas and schema helpers."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MEASURE = T.DecimalType(18, 4)
# Doubles: 17 places hold their shortest form; a sum of them leaves a digit free, so that a difference of two sums is exact too.
FRACTION, FRACTION_SUM = T.DecimalType(36, 17), T.DecimalType(37, 17)

_TYPES = {"long": T.LongType(), "int": T.IntegerType(), "string": T.StringType(),
          "date": T.DateType(), "measure": MEASURE, "double": T.DoubleType()}


def _struct(spec: str) -> T.StructType:
    fields = [item.split(":") for item in spec.split()]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in fields])


SCHEMAS: dict[str, T.StructType] = {
    "plan_details": _struct(
        "KEY_ATTRIBUTES_MASTER_ID:long COURSE_CD:string SCA_LOCATION_CD:string PLAN_YEAR:string "
        "REVIEWED:string COMMENCING_LOAD:measure RETURNING_LOAD:measure"),
    "plan_forecast": _struct(
        "KEY_ATTRIBUTES_MASTER_ID:long COURSE_CD:string SCA_LOCATION_CD:string "
        "COMMENCING_FORECAST_LOAD:measure RETURNING_FORECAST_LOAD:measure"),
    "unit_load": _struct(
        "SNAPSHOT_ID:long REFERENCE_YEAR:int FUNDING_SOURCE:string DEGREE_FACULTY_ID:long "
        "FACULTY_ID:long COURSE_CD:string COURSE_LEVEL:string SCA_COORD_CAMPUS:string "
        "SCA_LOCATION_CD:string SUA_LOCATION_CD:string UNIT_MODE:string "
        "COMMENCING_STUDENT_IND:string NOMINATED_YEAR_LEVEL:int TEACHING_FACULTY:string "
        "TR_ORG_UNIT_CD:string CLUSTER_TRANSLATION_ID:long EFTSL:measure"),
    "forecast_load": _struct(
        "FORECAST_CONTROL_ID:long REFERENCE_YEAR:int FUNDING_SOURCE:string DEGREE_FACULTY_ID:long "
        "FACULTY_ID:long COURSE_LEVEL:string SCA_COORD_CAMPUS:string UNIT_MODE:string "
        "COMMENCING_STUDENT_IND:string REPORTED_FORECAST_LOAD:measure"),
    "forecast_taught_crs_load": _struct(
        "FORECAST_LOAD_ID:long FORECAST_CONTROL_ID:long FORECAST_METHODOLOGY_ID:long "
        "REFERENCE_YEAR:int TEACHING_FACULTY:string TR_ORG_UNIT_CD:string FACULTY_ID:long "
        "DEGREE_FACULTY_ID:long FUNDING_SOURCE:string COURSE_LEVEL:string COURSE_CD:string "
        "SCA_COORD_CAMPUS:string SUA_LOCATION_CD:string UNIT_MODE:string "
        "COMMENCING_STUDENT_IND:string OFFICIAL_CLUSTER:string HOME_CLUSTER:string "
        "HIGH_LOW_COST:string REPORTED_FORECAST_TAUGHT_LOAD:measure"),
    "key_attributes_master": _struct(
        "KEY_ATTRIBUTES_MASTER_ID:long REFERENCE_YEAR:int FUNDING_SOURCE:string "
        "DEGREE_FACULTY_CD:string OWNING_FACULTY:string COURSE_LEVEL:string "
        "SCA_COORD_CAMPUS:string UNIT_MODE:string"),
    "degree_faculty": _struct(
        "DEGREE_FACULTY_ID:long DEGREE_FACULTY_CD:string REFERENCE_YEAR:int "
        "DEGREE_FACULTY_NAME:string HOME_UNI_IND:string"),
    "funding_source": _struct("FUNDING_SOURCE:string DESCRIPTION:string"),
    "course_version": _struct(
        "COURSE_CD:string VERSION_NUMBER:int START_DT:date ABBREVIATION:string"),
    "org_unit": _struct("ORG_UNIT_CD:string DESCRIPTION:string ORG_STATUS:string"),
    "cluster_translation": _struct(
        "CLUSTER_TRANSLATION_ID:long CLUSTER_CD:string CLUSTER_SUBGROUP:string"),
    "aggregation_control": _struct("SNAPSHOT_ID:long REFERENCE_YEAR:int SNAPSHOT_DATE:date"),
    "forecast_control": _struct("FORECAST_CONTROL_ID:long REFERENCE_YEAR_PIT_DATE:date"),
    "forecast_file": _struct(
        "TEACHING_FACULTY:string TR_ORG_UNIT_CD:string DEGREE_FACULTY:string FUND_SOURCE:string "
        "FUND_SOURCE_DESCRIPTION:string COURSE_LEVEL:string SCA_COORD_CAMPUS:string "
        "SUA_LOCATION_CODE:string UNIT_MODE:string COMMENCING_STUDENT_IND:string "
        "HOME_CLUSTER:string CURR_YR_FORECAST_DATE:string REPORTED_FORECAST_TAUGHT_LOAD:measure"),
    "actuals_extract": _struct(
        "YEAR:int FACULTY:string DEGREE_FACULTY:string TEACHING_FACULTY_CD:string "
        "TEACHING_FACULTY_NAME:string DEPARTMENT_CD:string DEPARTMENT:string COURSE_LEVEL:string "
        "CAMPUS:string UNIT_MODE:string FUND_SOURCE:string COM_RET:string COURSE_CD:string "
        "COURSE_DESCRIPTION:string EFTSL:measure"),
    "course_forecast_extract": _struct(
        "REFERENCE_YEAR:int FACULTY:string DEGREE_FACULTY:string TEACHING_FACULTY:string "
        "TEACHING_FACULTY_DESCRIPTION:string TR_ORG_UNIT_CD:string "
        "TR_ORG_UNIT_CD_DESCRIPTION:string COURSE_LEVEL:string SCA_COORD_CAMPUS:string "
        "UNIT_MODE:string FUND_SOURCE_DESCRIPTION:string COMMENCING_STUDENT_IND:string "
        "COURSE_CD:string FCAST_MONTH:string REPORTED_FORECAST_TAUGHT_LOAD:measure"),
    "bucket_forecast": _struct(
        "REFERENCE_YEAR:int FACULTY:string DEGREE_FACULTY:string TEACHING_FACULTY:string "
        "TEACHING_FACULTY_DESCRIPTION:string TR_ORG_UNIT_CD:string "
        "TR_ORG_UNIT_CD_DESCRIPTION:string COURSE_LEVEL:string SCA_COORD_CAMPUS:string "
        "UNIT_MODE:string FUND_SOURCE_DESCRIPTION:string COMMENCING_STUDENT_IND:string "
        "OFFICIAL_CLUSTER:string REPORTED_FORECAST_TAUGHT_LOAD:measure"),
    "teaching_faculty_abbrev": _struct("TEACHING_FACULTY_NAME:string TEACHING_FAC_ABBREV:string"),
    "workload_rows": T.StructType([
        T.StructField("Month", T.StringType()),
        T.StructField("Faculty", T.StringType()),
        T.StructField("Bucket Forecast Row #", T.LongType()),
        T.StructField("Course Code Row #", T.LongType()),
        T.StructField("Course Code:Bucket Workload Ratio", T.DoubleType()),
    ]),
}


def exact(df: DataFrame, name: str) -> Column:
    """A load in a form whose sums do not depend on the order of tasks and lose nothing.

    Decimals stay at their own scale, whole numbers are taken as they are. A
    double is taken at its shortest decimal form, at 17 places: a double that
    this changes, that does not fit, or that is no number raises an error, and
    so does text that is no number.
    """
    kind, col = df.schema[name].dataType, F.col(f"`{name}`")
    if isinstance(kind, T.DecimalType):
        return col
    if isinstance(kind, T.IntegralType):
        return col.cast(T.DecimalType(20, 0))
    taken = col.try_cast(FRACTION)
    kept = taken.cast(kind) == col if isinstance(kind, T.FractionalType) else taken.isNotNull()
    broken = F.raise_error(F.concat(F.lit(f"{name}: not a load that 17 places hold: "), col.cast("string"))).cast(FRACTION)
    return F.when(col.isNull(), F.lit(None).cast(FRACTION)).when(kept, taken).otherwise(broken)


def as_double(col: Column | str) -> Column:
    """A load for output."""
    return (F.col(col) if isinstance(col, str) else col).cast("double")


def sum_load(df: DataFrame, name: str) -> Column:
    """Exact sum of the loads of a column as a decimal of their scale, missing when no load is present.

    A sum that does not fit 38 digits raises an error.
    """
    total = F.sum(exact(df, name))
    return total.cast(FRACTION_SUM) if isinstance(df.schema[name].dataType, T.FractionalType) and not isinstance(
        df.schema[name].dataType, T.DecimalType) else total


def numeric_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    """Numeric columns in schema order, without the excluded ones."""
    skip = set(exclude)
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, T.NumericType) and f.name not in skip]


def decimals_to_double(df: DataFrame) -> DataFrame:
    """Decimal measures as doubles, for output."""
    cast = {f.name: F.col(f"`{f.name}`").cast("double") for f in df.schema.fields
            if isinstance(f.dataType, T.DecimalType)}
    return df.withColumns(cast) if cast else df
