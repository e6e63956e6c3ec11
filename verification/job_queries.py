"""Designation split and forecast accuracy: every step of both jobs."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from loadkit.plans import designation as G
from loadkit.plans import forecast_accuracy as A
from loadkit.schema import decimals_to_double
from verification import standin as S
from verification.standin import Tables
from verification.standin_sql import half_even, with_ctes

QUERIES: dict = {}


def register(name: str, sql: str | None, extra: dict[str, str] | None = None):
    def wrap(fn):
        def run(spark, sf_dir):
            return decimals_to_double(fn(Tables(spark, sf_dir)))
        run.__name__, run.__doc__ = name, fn.__doc__
        QUERIES[name] = (run, None if sql is None else with_ctes(sql, extra))
        return fn
    return wrap


# --- designation ----------------------------------------------------------------

KEYS = ["TEACHING_FACULTY", "TR_ORG_UNIT_CD", "DEGREE_FACULTY", "FUND_SOURCE_DESCRIPTION", "COURSE_LEVEL",
        "SCA_COORD_CAMPUS", "SUA_LOCATION_CODE", "UNIT_MODE", "COMMENCING_STUDENT_IND", "HOME_CLUSTER"]


def _designated(courses: str, name: str) -> str:
    return f"""
    SELECT TEACHING_FACULTY, TR_ORG_UNIT_CD, DEGREE_FACULTY_NAME AS DEGREE_FACULTY, DESCRIPTION AS FUND_SOURCE_DESCRIPTION,
           COURSE_LEVEL, SCA_COORD_CAMPUS, SUA_LOCATION_CD AS SUA_LOCATION_CODE, UNIT_MODE, COMMENCING_STUDENT_IND,
           CLUSTER_SUBGROUP AS HOME_CLUSTER, sum(EFTSL) AS {name}, '06-01-1998' AS REPDATE
    FROM unit_load u LEFT JOIN cluster_translation c ON u.CLUSTER_TRANSLATION_ID = c.CLUSTER_TRANSLATION_ID
    LEFT JOIN degree_faculty d ON d.DEGREE_FACULTY_ID = u.DEGREE_FACULTY_ID AND d.REFERENCE_YEAR = u.REFERENCE_YEAR
    LEFT JOIN funding_source s ON s.FUNDING_SOURCE = u.FUNDING_SOURCE
    WHERE SNAPSHOT_ID = (SELECT max(SNAPSHOT_ID) FROM aggregation_control WHERE REFERENCE_YEAR = 1998)
      AND COURSE_CD IN ({courses}) AND u.FUNDING_SOURCE = 'AUTOMOBILE'
    GROUP BY TEACHING_FACULTY, TR_ORG_UNIT_CD, DEGREE_FACULTY_NAME, DESCRIPTION, COURSE_LEVEL, SCA_COORD_CAMPUS,
             SUA_LOCATION_CD, UNIT_MODE, COMMENCING_STUDENT_IND, CLUSTER_CD, CLUSTER_SUBGROUP"""


_SAME = " AND ".join(f"a.{k} IS NOT DISTINCT FROM b.{k}" for k in KEYS)
DESIGNATION = {
    "medical": _designated("'Brand#1', 'Brand#2', 'Brand#3', 'Brand#4'", "MEDICAL_TAUGHT_LOAD"),
    "subbach": _designated("'Brand#5', 'Brand#6', 'Brand#7', 'Brand#8', 'Brand#9', 'Brand#10'", "SUBBACH_TAUGHT_LOAD"),
    "both_actuals": f"""
    SELECT {", ".join(f"coalesce(a.{k}, b.{k}) AS {k}" for k in KEYS)}, MEDICAL_TAUGHT_LOAD,
           coalesce(a.REPDATE, b.REPDATE) AS REPDATE, SUBBACH_TAUGHT_LOAD
    FROM medical a FULL JOIN subbach b ON {_SAME} AND a.REPDATE IS NOT DISTINCT FROM b.REPDATE""",
    "split_parts": f"""
    SELECT a.*, MEDICAL_TAUGHT_LOAD, SUBBACH_TAUGHT_LOAD,
           CASE WHEN MEDICAL_TAUGHT_LOAD IS NULL THEN NULL WHEN REPORTED_FORECAST_TAUGHT_LOAD >= MEDICAL_TAUGHT_LOAD
             THEN MEDICAL_TAUGHT_LOAD WHEN REPORTED_FORECAST_TAUGHT_LOAD < MEDICAL_TAUGHT_LOAD THEN REPORTED_FORECAST_TAUGHT_LOAD
             END AS DESIG_MED_UG,
           CASE WHEN SUBBACH_TAUGHT_LOAD IS NULL THEN NULL WHEN REPORTED_FORECAST_TAUGHT_LOAD >= SUBBACH_TAUGHT_LOAD
             THEN SUBBACH_TAUGHT_LOAD WHEN REPORTED_FORECAST_TAUGHT_LOAD < SUBBACH_TAUGHT_LOAD THEN REPORTED_FORECAST_TAUGHT_LOAD
             END AS SUBBACH
    FROM forecast_file a LEFT JOIN both_actuals b ON {_SAME}""",
    "split": """
    SELECT *, CASE WHEN MEDICAL_TAUGHT_LOAD IS NULL AND SUBBACH_TAUGHT_LOAD IS NULL THEN REPORTED_FORECAST_TAUGHT_LOAD
                   WHEN MEDICAL_TAUGHT_LOAD IS NOT NULL THEN REPORTED_FORECAST_TAUGHT_LOAD - DESIG_MED_UG
                   ELSE REPORTED_FORECAST_TAUGHT_LOAD - SUBBACH END AS NON_DESIGNATED FROM split_parts""",
    "split_long": """
    UNPIVOT (SELECT * EXCLUDE (REPORTED_FORECAST_TAUGHT_LOAD, MEDICAL_TAUGHT_LOAD, SUBBACH_TAUGHT_LOAD) FROM split)
    ON DESIG_MED_UG, SUBBACH, NON_DESIGNATED INTO NAME Desig_Grouping VALUE REPORTED_FORECAST_TAUGHT_LOAD""",
    "final": """
    SELECT * EXCLUDE (label), CASE WHEN FUND_SOURCE_DESCRIPTION = 'CSP' AND COURSE_LEVEL = 'GPG' THEN 'DESIGNATED_GPG'
             WHEN NOT (FUND_SOURCE_DESCRIPTION = 'CSP' AND COURSE_LEVEL = 'GPG') THEN label END AS Desig_Grouping
    FROM (SELECT * EXCLUDE (Desig_Grouping) REPLACE (coalesce(SUA_LOCATION_CODE, SCA_COORD_CAMPUS) AS SUA_LOCATION_CODE,
            coalesce(FUND_SOURCE, 'UNALLOCATED') AS FUND_SOURCE,
            coalesce(FUND_SOURCE_DESCRIPTION, 'UNALLOCATED') AS FUND_SOURCE_DESCRIPTION), Desig_Grouping AS label
          FROM split_long)""",
}
_GPG = "FUND_SOURCE_DESCRIPTION = 'CSP' AND COURSE_LEVEL = 'GPG'"
_F = "REPORTED_FORECAST_TAUGHT_LOAD"
_VALUE = "DECIMAL(38,4)"
DESIGNATION["checks"] = f"""
    SELECT 'rows of combined actuals' AS check_name, CAST((SELECT count(*) FROM medical) + (SELECT count(*) FROM subbach) AS {_VALUE}) AS expected,
           CAST((SELECT count(*) FROM both_actuals) AS {_VALUE}) AS actual
    UNION ALL SELECT 'combined:MEDICAL_TAUGHT_LOAD', (SELECT coalesce(sum(MEDICAL_TAUGHT_LOAD), 0) FROM medical),
      (SELECT coalesce(sum(MEDICAL_TAUGHT_LOAD), 0) FROM both_actuals)
    UNION ALL SELECT 'combined:SUBBACH_TAUGHT_LOAD', (SELECT coalesce(sum(SUBBACH_TAUGHT_LOAD), 0) FROM subbach),
      (SELECT coalesce(sum(SUBBACH_TAUGHT_LOAD), 0) FROM both_actuals)
    UNION ALL SELECT 'run date', 19980601, (SELECT CAST(strftime(max(strptime(REPDATE, '%m-%d-%Y')), '%Y%m%d') AS {_VALUE}) FROM both_actuals)
    UNION ALL SELECT 'snapshot date', 19980601, (SELECT CAST(strftime(SNAPSHOT_DATE, '%Y%m%d') AS {_VALUE}) FROM aggregation_control
      WHERE SNAPSHOT_ID = (SELECT max(SNAPSHOT_ID) FROM aggregation_control WHERE REFERENCE_YEAR = 1998))
    UNION ALL SELECT 'forecast kept by join:{_F}', (SELECT sum({_F}) FROM forecast_file), (SELECT sum({_F}) FROM split)
    UNION ALL SELECT 'parts equal forecast', (SELECT sum({_F}) FROM split),
      (SELECT coalesce(sum(DESIG_MED_UG), 0) + coalesce(sum(SUBBACH), 0) + coalesce(sum(NON_DESIGNATED), 0) FROM split)
    UNION ALL SELECT 'long equals wide:DESIG_MED_UG', (SELECT coalesce(sum(DESIG_MED_UG), 0) FROM split),
      (SELECT sum({_F}) FROM split_long WHERE Desig_Grouping = 'DESIG_MED_UG')
    UNION ALL SELECT 'long equals wide:SUBBACH', (SELECT coalesce(sum(SUBBACH), 0) FROM split),
      (SELECT sum({_F}) FROM split_long WHERE Desig_Grouping = 'SUBBACH')
    UNION ALL SELECT 'long equals wide:NON_DESIGNATED', (SELECT coalesce(sum(NON_DESIGNATED), 0) FROM split),
      (SELECT sum({_F}) FROM split_long WHERE Desig_Grouping = 'NON_DESIGNATED')
    UNION ALL SELECT 'relabelled:DESIGNATED_GPG', (SELECT sum({_F}) FROM forecast_file WHERE {_GPG}),
      (SELECT sum({_F}) FROM final WHERE Desig_Grouping = 'DESIGNATED_GPG')
    UNION ALL SELECT 'unchanged:DESIG_MED_UG', (SELECT sum({_F}) FROM split_long WHERE Desig_Grouping = 'DESIG_MED_UG'),
      (SELECT sum({_F}) FROM final WHERE Desig_Grouping = 'DESIG_MED_UG')
    UNION ALL SELECT 'unchanged:SUBBACH', (SELECT sum({_F}) FROM split_long WHERE Desig_Grouping = 'SUBBACH'),
      (SELECT sum({_F}) FROM final WHERE Desig_Grouping = 'SUBBACH')"""


def _as_double(table: str, *columns: str) -> str:
    return f"SELECT * REPLACE ({', '.join(f'CAST({c} AS DOUBLE) AS {c}' for c in columns)}) FROM {table}"


def _actuals(t: Tables, courses, name):
    return G.designated_actuals(S.unit_load(t), S.aggregation_control(t), S.cluster_translation(t), S.degree_faculty(t),
                                S.funding_source(t), courses, name, S.AS_OF, fund_code=S.DESIGNATED_FUND)


class Designation:
    """The steps of the job on the stand-in tables."""

    def __init__(self, t: Tables):
        self.forecast = S.forecast_file(t)
        sets = {G.MEDICAL_LOAD: S.RULES.medical, G.SUB_BACHELOR_LOAD: S.RULES.sub_bachelor}
        control = S.aggregation_control(t)
        loads = G.designated_loads(S.unit_load(t), control, S.cluster_translation(t), S.degree_faculty(t), S.funding_source(t),
                                   sets, S.AS_OF, fund_code=S.DESIGNATED_FUND)
        self.medical, self.subbach = (G.loads_of_set(loads, name) for name in sets)
        self.actuals = G.side_by_side(loads, list(sets))
        self.snapshot = G.snapshot_date(control, S.AS_OF)
        self.split = G.designation_split(self.forecast, self.actuals)
        self.long = G.split_to_long(self.split)
        self.final = G.designation_export(self.long)


@register("q5_designated_actuals", _as_double("both_actuals", "MEDICAL_TAUGHT_LOAD", "SUBBACH_TAUGHT_LOAD"), DESIGNATION)
def q5_designated_actuals(t):
    """Actual load of both designated course sets side by side."""
    return Designation(t).actuals


@register("q6_designation_split", _as_double("split_long", _F), DESIGNATION)
def q6_designation_split(t):
    """Forecast rows as capped parts and remainder, long."""
    return Designation(t).long


@register("q7_designation_export", _as_double("final", _F), DESIGNATION)
def q7_designation_export(t):
    """Blanks filled and graduate load relabelled."""
    return Designation(t).final


@register("q8_reconcile", """
    SELECT check_name, CAST(expected AS DOUBLE) AS expected, CAST(actual AS DOUBLE) AS actual,
           CAST(actual - expected AS DOUBLE) AS difference, expected IS NOT DISTINCT FROM actual AS ok FROM checks""", DESIGNATION)
def q8_reconcile(t):
    """All checks of the job."""
    d = Designation(t)
    final = G.designation_export(d.long, label_before=G.LABEL_BEFORE)
    return G.split_checks(d.forecast, d.medical, d.subbach, d.actuals, d.split, d.long, final, S.AS_OF, snapshot=d.snapshot)


# --- accuracy -------------------------------------------------------------------------

_BUCKET_KEYS = list(A.BUCKET_ACTUAL_KEYS)
_RENAMED = """FACULTY, DEGREE_FACULTY, TEACHING_FACULTY AS TEACHING_FACULTY_CD, upper(TEACHING_FACULTY_DESCRIPTION) AS TEACHING_FACULTY_NAME,
    TR_ORG_UNIT_CD AS DEPARTMENT_CD, CASE WHEN TR_ORG_UNIT_CD IS NULL THEN NULL WHEN TR_ORG_UNIT_CD = 'D2' THEN 'WATER STUDIES CENTRE'
      WHEN TR_ORG_UNIT_CD = 'D5' THEN 'NA' ELSE upper(TR_ORG_UNIT_CD_DESCRIPTION) END AS DEPARTMENT, COURSE_LEVEL,
    SCA_COORD_CAMPUS AS CAMPUS, UNIT_MODE, FUND_SOURCE_DESCRIPTION AS FUND_SOURCE,
    CASE WHEN COMMENCING_STUDENT_IND = 'Y' THEN 'Commencing' WHEN COMMENCING_STUDENT_IND <> 'Y' THEN 'Returning' END AS COM_RET"""


def _forecast_sql(table: str, keys: str, course: str) -> str:
    return f"""SELECT {_RENAMED}{course}, FCAST_MONTH, load AS FCAST_EFTSL FROM (
      SELECT {keys}, FCAST_MONTH, coalesce(sum(REPORTED_FORECAST_TAUGHT_LOAD), 0) AS load FROM {table}
      WHERE REFERENCE_YEAR = 1998 GROUP BY ALL)"""


def _aligned_sql(forecast: str, actual: str, keys: list[str], extra: str = "") -> str:
    return f"""
    SELECT {", ".join(f"coalesce(f.{k}, a.{k}) AS {k}" for k in keys)}, coalesce(f.FCAST_MONTH, a.m) AS FCAST_MONTH,
           FCAST_EFTSL{extra}, ACTUALS_EFTSL
    FROM (SELECT * FROM {forecast} WHERE FCAST_MONTH IS NOT NULL) f
    FULL JOIN (SELECT a.*, m.m FROM {actual} a JOIN (SELECT DISTINCT FCAST_MONTH AS m FROM {forecast}
               WHERE FCAST_MONTH IS NOT NULL) m ON true) a
      ON f.FCAST_MONTH = a.m AND {" AND ".join(f"f.{k} IS NOT DISTINCT FROM a.{k}" for k in keys)}"""


ACCURACY = {
    "course_forecast": _forecast_sql("course_forecast_extract", ", ".join(A.COURSE_FORECAST_KEYS), ", COURSE_CD"),
    "bucket_forecast_sum": _forecast_sql("bucket_forecast", ", ".join(A.BUCKET_FORECAST_KEYS), ""),
    "course_actual": f"""SELECT {", ".join(A.COURSE_ACTUAL_KEYS)}, coalesce(sum(EFTSL), 0) AS ACTUALS_EFTSL
      FROM actuals_extract WHERE YEAR = 1998 GROUP BY ALL""",
    "bucket_actual": f"""SELECT {", ".join(A.BUCKET_ACTUAL_KEYS)}, coalesce(sum(EFTSL), 0) AS ACTUALS_EFTSL
      FROM actuals_extract WHERE YEAR = 1998 GROUP BY ALL""",
    "course_aligned": _aligned_sql("course_forecast", "course_actual", [*_BUCKET_KEYS, "COURSE_CD"], ", COURSE_DESCRIPTION"),
    "bucket_aligned": _aligned_sql("bucket_forecast_sum", "bucket_actual", _BUCKET_KEYS),
    "consolidated": """SELECT *, 'Course' AS FCAST_TYPE FROM course_aligned
      UNION ALL BY NAME SELECT *, 'Bucket' AS FCAST_TYPE FROM bucket_aligned""",
    "scoped": """SELECT * REPLACE (coalesce(FCAST_EFTSL, 0) AS FCAST_EFTSL, coalesce(ACTUALS_EFTSL, 0) AS ACTUALS_EFTSL),
        list_position(['March', 'June', 'July', 'September'], FCAST_MONTH) AS place
      FROM consolidated WHERE CAMPUS <> 'MALAYSIA' AND CAMPUS <> 'SAFRICA' AND coalesce(FACULTY <> 'NATION_3', true)""",
    "error_base": f"""SELECT * EXCLUDE (place) REPLACE (CASE WHEN place > 0 THEN FCAST_MONTH END AS FCAST_MONTH),
        CAST(CASE WHEN place > 0 THEN place END AS INTEGER) AS month_ord,
        {half_even('FCAST_EFTSL - ACTUALS_EFTSL')} AS ForecastError,
        CAST({half_even('FCAST_EFTSL - ACTUALS_EFTSL')} * 100 AS BIGINT) AS cents FROM scoped""",
    "org": "SELECT ORG_UNIT_CD AS DEPARTMENT_CD, DESCRIPTION AS DEPARTMENT FROM org_unit WHERE ORG_STATUS = 'ACTIVE'",
}
# cents: the rounded error as a whole number, so that its sums are exact
_SUMS = ("coalesce(sum(FCAST_EFTSL), 0) AS f, coalesce(sum(ACTUALS_EFTSL), 0) AS a, sum(cents) AS e")
_ERROR = "e / CAST(100 AS DOUBLE)"
_LOADS = "CAST(f AS DOUBLE) AS FCAST_EFTSL, CAST(a AS DOUBLE) AS ACTUALS_EFTSL"


def _flagged(df, *columns):
    """Percentages as a number or, where there is none, as text, so that the values compare plainly."""
    for c in columns:
        kind = F.when(F.isnan(c), "NaN").when(F.col(c) == float("inf"), "Inf").when(
            F.col(c) == float("-inf"), "-Inf").otherwise("number")
        df = df.withColumns({f"{c}_kind": kind, c: F.when(kind == "number", F.col(c))})
    return df


def _flagged_sql(name: str, error: str) -> str:
    value = f"CAST(100 * CAST({error} AS DECIMAL(18,2)) AS DOUBLE) / CAST(a AS DOUBLE)"
    return (f"CASE WHEN a <> 0 THEN round_even({value}, 2) END AS {name}, CASE WHEN a <> 0 THEN 'number' WHEN {error} > 0 THEN 'Inf' "
            f"WHEN {error} < 0 THEN '-Inf' ELSE 'NaN' END AS {name}_kind")


def _course(t):
    return A.align_forecast(S.actuals_extract(t), S.course_forecast_extract(t), S.ACCURACY_YEAR, "course", S.OVERRIDES)


def _bucket(t):
    return A.align_forecast(S.actuals_extract(t), S.bucket_forecast(t), S.ACCURACY_YEAR, "bucket", S.OVERRIDES)


def _base(t):
    return A.error_base(A.consolidate(_course(t), _bucket(t)), S.MONTHS, S.SCOPE)


@register("q9_align_course", _as_double("course_aligned", "FCAST_EFTSL", "ACTUALS_EFTSL"), ACCURACY)
def q9_align_course(t):
    """Course forecast beside actual load, for every forecast month."""
    return _course(t)


@register("q9_align_bucket", _as_double("bucket_aligned", "FCAST_EFTSL", "ACTUALS_EFTSL"), ACCURACY)
def q9_align_bucket(t):
    """Bucket forecast beside actual load, for every forecast month."""
    return _bucket(t)


@register("q10_consolidate", _as_double("consolidated", "FCAST_EFTSL", "ACTUALS_EFTSL"), ACCURACY)
def q10_consolidate(t):
    """Both methods in one frame."""
    return A.consolidate(_course(t), _bucket(t))


@register("q10_in_scope_totals", f"""
    SELECT FCAST_MONTH, FCAST_TYPE, {_LOADS} FROM (SELECT FCAST_MONTH, FCAST_TYPE, coalesce(sum(FCAST_EFTSL), 0) AS f,
      coalesce(sum(ACTUALS_EFTSL), 0) AS a FROM consolidated
      WHERE CAMPUS NOT IN ('MALAYSIA', 'SAFRICA') AND FACULTY NOT IN ('NATION_3', 'NATION_4') GROUP BY ALL)""", ACCURACY)
def q10_in_scope_totals(t):
    """Control totals of the home institution by month and method."""
    rows = A.in_totals(A.consolidate(_course(t), _bucket(t)), S.SCOPE)
    return A.sum_numeric(rows, [A.MONTH, A.METHOD], "skip")


@register("q11_error_base", "SELECT * EXCLUDE (cents) REPLACE (CAST(FCAST_EFTSL AS DOUBLE) AS FCAST_EFTSL, "
          "CAST(ACTUALS_EFTSL AS DOUBLE) AS ACTUALS_EFTSL) FROM error_base", ACCURACY)
def q11_error_base(t):
    """In-scope rows with the signed error and the month order."""
    return _base(t)


@register("q12_error_summary", f"""
    SELECT FCAST_MONTH AS "Month", FCAST_TYPE AS "Forecast Type", CAST(f AS DOUBLE) AS "Forecast (EFTSL)",
           CAST(a AS DOUBLE) AS "Actual Load", {_ERROR} AS "Error", ae / CAST(100 AS DOUBLE) AS "Absolute Error"
    FROM (SELECT FCAST_MONTH, FCAST_TYPE, {_SUMS}, sum(abs(cents)) AS ae FROM error_base GROUP BY ALL)""", ACCURACY)
def q12_error_summary(t):
    """Report table by month and method with the sum of absolute row errors."""
    return A.report_table(A.error_summary(_base(t)), S.MONTHS)


@register("q13_error_by_month", f"""
    SELECT FCAST_MONTH, FCAST_TYPE, {_LOADS}, {_ERROR} AS ForecastError, {_flagged_sql('percError', _ERROR)}
    FROM (SELECT FCAST_MONTH, FCAST_TYPE, {_SUMS} FROM error_base GROUP BY ALL)""", ACCURACY)
def q13_error_by_month(t):
    """Percentage error by month and method."""
    return _flagged(A.error_by_month(_base(t)), "percError")


def _faculty_sql(fund: str, where: str) -> str:
    lead = "FUND_SOURCE, " if fund else ""
    return f"""
    SELECT {lead}TEACHING_FAC_ABBREV, FCAST_TYPE, FCAST_MONTH, {_LOADS}, {_ERROR} AS ForecastError, {_flagged_sql('percError', _ERROR)}{fund}
    FROM (SELECT {lead}TEACHING_FAC_ABBREV, FCAST_TYPE, FCAST_MONTH, sum(f) AS f, sum(a) AS a, sum(e) AS e
          FROM (SELECT {lead}TEACHING_FACULTY_CD, DEPARTMENT_CD, FCAST_TYPE, FCAST_MONTH, {_SUMS} FROM error_base
                WHERE contains(TEACHING_FACULTY_NAME, 'FACULTY OF'){where} GROUP BY ALL) u
          LEFT JOIN org t ON u.TEACHING_FACULTY_CD IS NOT DISTINCT FROM t.DEPARTMENT_CD
          LEFT JOIN org d ON u.DEPARTMENT_CD IS NOT DISTINCT FROM d.DEPARTMENT_CD
          LEFT JOIN teaching_faculty_abbrev x ON t.DEPARTMENT IS NOT DISTINCT FROM x.TEACHING_FACULTY_NAME
          GROUP BY ALL)"""


@register("q14_error_by_faculty", _faculty_sql("", ""), ACCURACY)
def q14_error_by_faculty(t):
    """Error by teaching faculty: unit totals, two lookups, faculty totals."""
    out = A.error_by_faculty(_base(t), A.active_org_lookup(S.org_unit(t)), S.teaching_faculty_abbrev(t))
    return _flagged(out, "percError")


_FUNDS = "'CSP', 'DOM FEE PAY: GPG', 'INTERNATIONAL: AUSTRALIA', 'RESEARCH TRAINING PROGRAM - DOMESTIC'"


@register("q15_error_by_faculty_fund", _faculty_sql(
    ", CASE FUND_SOURCE WHEN 'CSP' THEN 'CSP' WHEN 'DOM FEE PAY: GPG' THEN 'DOM: GPG' WHEN 'INTERNATIONAL: AUSTRALIA' THEN 'INT:AUS' "
    "WHEN 'RESEARCH TRAINING PROGRAM - DOMESTIC' THEN 'RTP:DOM' END AS FUND_SOURCE_ABBREV", f" AND FUND_SOURCE IN ({_FUNDS})"), ACCURACY)
def q15_error_by_faculty_fund(t):
    """Error by key fund source and teaching faculty."""
    out = A.error_by_faculty_fund(_base(t), A.active_org_lookup(S.org_unit(t)), S.teaching_faculty_abbrev(t))
    return _flagged(out, "percError")


@register("q16_error_by_course", f"""
    SELECT FACULTY, COURSE_CD, COM_RET, FUND_SOURCE, FCAST_MONTH, {_LOADS}, {_ERROR} AS ForecastError,
           abs({_ERROR}) AS ABSForecastError, {_flagged_sql('percError', _ERROR)}, {_flagged_sql('ABSpercError', f'abs({_ERROR})')},
           coalesce(FACULTY, 'NA') || ' ' || coalesce(COURSE_CD, 'NA') || ' ' || coalesce(COM_RET, 'NA') || ' ' ||
           coalesce(FUND_SOURCE, 'NA') AS row_id
    FROM (SELECT FACULTY, COURSE_CD, COM_RET, FUND_SOURCE, FCAST_MONTH, {_SUMS} FROM error_base
          WHERE FCAST_TYPE = 'Course' AND FUND_SOURCE IN ({_FUNDS}) GROUP BY ALL) WHERE a <> 0 OR e = 0""", ACCURACY)
def q16_error_by_course(t):
    """Error by course, without rows whose percentage is infinite."""
    return _flagged(A.error_by_course(_base(t)), "percError", "ABSpercError")


# --- accuracy, two years in one plan ------------------------------------------------

# The second year has no corrections of names, and fewer months in its report.
SECOND_MONTHS = ("March", "June", "September")
_CORRECTION = """CASE WHEN TR_ORG_UNIT_CD IS NULL THEN NULL WHEN TR_ORG_UNIT_CD = 'D2' THEN 'WATER STUDIES CENTRE'
      WHEN TR_ORG_UNIT_CD = 'D5' THEN 'NA' ELSE upper(TR_ORG_UNIT_CD_DESCRIPTION) END"""


def _of_second_year() -> dict[str, str]:
    """The definitions above for the year before: `<name>_second`."""
    own = [name for name in ACCURACY if name != "org"]

    def second(text: str) -> str:
        text = text.replace(_CORRECTION, "upper(TR_ORG_UNIT_CD_DESCRIPTION)").replace("1998", "1997").replace("'March', 'June', 'July', 'September'", "'March', 'June', 'September'")
        return re.sub(rf"\b({'|'.join(own)})\b", r"\1_second", text)

    return {f"{name}_second": second(ACCURACY[name]) for name in own}


TWO_YEARS = {**ACCURACY, **_of_second_year()}
YEARS = {S.ACCURACY_YEAR: S.MONTHS, S.ACCURACY_YEAR - 1: SECOND_MONTHS}


def _years(t, level):
    forecast = {"course": S.course_forecast_extract, "bucket": S.bucket_forecast}[level](t)
    rules = A.override_rules(t.spark, {S.ACCURACY_YEAR: S.OVERRIDES})
    return A.align_years(S.actuals_extract(t), forecast, level, rules, list(YEARS))


def _base_years(t):
    both = A.consolidate(_years(t, "course"), _years(t, "bucket"))
    return A.error_base_years(both, A.month_rules(t.spark, YEARS), S.SCOPE)


def _both_years(table: str, *columns: str) -> str:
    return (f"SELECT 1998::INTEGER AS YEAR, t.* FROM ({_as_double(table, *columns)}) t "
            f"UNION ALL BY NAME SELECT 1997::INTEGER AS YEAR, t.* FROM ({_as_double(table + '_second', *columns)}) t")


@register("q9_two_years", _both_years("course_aligned", "FCAST_EFTSL", "ACTUALS_EFTSL"), TWO_YEARS)
def q9_two_years(t):
    """Course forecast beside actual load for two years, which differ in their months and corrections."""
    return _years(t, "course")


@register("q9_two_years_bucket", _both_years("bucket_aligned", "FCAST_EFTSL", "ACTUALS_EFTSL"), TWO_YEARS)
def q9_two_years_bucket(t):
    """Bucket forecast beside actual load for two years."""
    return _years(t, "bucket")


@register("q11_error_base_second_year", "SELECT * EXCLUDE (cents) REPLACE (CAST(FCAST_EFTSL AS DOUBLE) AS FCAST_EFTSL, "
          "CAST(ACTUALS_EFTSL AS DOUBLE) AS ACTUALS_EFTSL), 1997::INTEGER AS YEAR FROM error_base_second", TWO_YEARS)
def q11_error_base_second_year(t):
    """The base of the error tables for the second year, out of the plan of both."""
    return _base_years(t).where(F.col("YEAR") == S.ACCURACY_YEAR - 1)


def _table_sql(table: str, base: str, year: int) -> str:
    """One of the error tables in the columns that all of them share."""
    keys = {"month": "", "faculty": "TEACHING_FAC_ABBREV, ", "faculty_fund": "FUND_SOURCE, TEACHING_FAC_ABBREV, ",
            "course": "FUND_SOURCE, FACULTY, COURSE_CD, COM_RET, "}[table]
    sums = f"{_SUMS}, sum(abs(cents)) AS ae"
    if table in ("month", "course"):
        scope = "" if table == "month" else f" WHERE FCAST_TYPE = 'Course' AND FUND_SOURCE IN ({_FUNDS})"
        rows = f"SELECT {keys}FCAST_MONTH, FCAST_TYPE, {sums} FROM {base}{scope} GROUP BY ALL"
    else:
        fund = "FUND_SOURCE, " if table == "faculty_fund" else ""
        scope = f" AND FUND_SOURCE IN ({_FUNDS})" if fund else ""
        rows = f"""SELECT {keys}FCAST_MONTH, FCAST_TYPE, sum(f) AS f, sum(a) AS a, sum(e) AS e, sum(ae) AS ae FROM (
            SELECT {fund}TEACHING_FACULTY_CD, DEPARTMENT_CD, FCAST_TYPE, FCAST_MONTH, {sums} FROM {base}
            WHERE contains(TEACHING_FACULTY_NAME, 'FACULTY OF'){scope} GROUP BY ALL) u
          LEFT JOIN org t ON u.TEACHING_FACULTY_CD IS NOT DISTINCT FROM t.DEPARTMENT_CD
          LEFT JOIN org d ON u.DEPARTMENT_CD IS NOT DISTINCT FROM d.DEPARTMENT_CD
          LEFT JOIN teaching_faculty_abbrev x ON t.DEPARTMENT IS NOT DISTINCT FROM x.TEACHING_FACULTY_NAME GROUP BY ALL"""
    every = ("FUND_SOURCE", "TEACHING_FAC_ABBREV", "FACULTY", "COURSE_CD", "COM_RET")
    shown = ", ".join(c if f"{c}, " in keys else f"CAST(NULL AS VARCHAR) AS {c}" for c in every)
    return f"""SELECT '{table}' AS "TABLE", {year}::INTEGER AS YEAR, FCAST_MONTH, FCAST_TYPE, {shown}, {_LOADS}, {_ERROR} AS ForecastError,
        ae / CAST(100 AS DOUBLE) AS ABSForecastError, {_flagged_sql('percError', _ERROR)}, {_flagged_sql('ABSpercError', f'abs({_ERROR})')} FROM ({rows})"""


@register("q12_q16_error_tables", " UNION ALL BY NAME ".join(
    _table_sql(table, base, year) for table in A.TABLES for base, year in (("error_base", 1998), ("error_base_second", 1997))), TWO_YEARS)
def q12_q16_error_tables(t):
    """All error tables of both years from one plan: one base, one grouping-sets aggregation."""
    out = A.error_tables(_base_years(t), org=A.active_org_lookup(S.org_unit(t)), abbreviations=S.teaching_faculty_abbrev(t), by=["YEAR"])
    return _flagged(out, "percError", "ABSpercError")


def _total_sql(method: str, forecast: str, actual: str, aligned: str) -> str:
    months = f"(SELECT count(DISTINCT FCAST_MONTH) FROM {forecast})"
    return f"""SELECT '{method}:FCAST_EFTSL' AS check_name, (SELECT sum(FCAST_EFTSL) FROM {forecast} WHERE FCAST_MONTH IS NOT NULL) AS expected,
        (SELECT sum(FCAST_EFTSL) FROM {aligned}) AS actual
      UNION ALL SELECT '{method}:ACTUALS_EFTSL', (SELECT sum(ACTUALS_EFTSL) FROM {actual}) * {months}, (SELECT sum(ACTUALS_EFTSL) FROM {aligned})
      UNION ALL SELECT '{method}:rows with a forecast', (SELECT count(*) FROM {forecast} WHERE FCAST_MONTH IS NOT NULL),
        (SELECT count(FCAST_EFTSL) FROM {aligned})"""


@register("k2_accuracy_totals", f"""SELECT check_name, CAST(expected AS DOUBLE) AS expected, CAST(actual AS DOUBLE) AS actual,
    CAST(actual - expected AS DOUBLE) AS difference, expected = actual AS ok FROM (
    {_total_sql("Course", "course_forecast", "course_actual", "course_aligned")} UNION ALL
    {_total_sql("Bucket", "bucket_forecast_sum", "bucket_actual", "bucket_aligned")})""", ACCURACY)
def k2_accuracy_totals(t):
    """Loads of both methods before and after the alignment, which counts a forecast again for every actual row it meets."""
    actuals, parts = S.actuals_extract(t), {}
    for method, forecast, keys, own, aligned in (
            ("Course", S.course_forecast_extract(t), A.COURSE_FORECAST_KEYS, A.COURSE_ACTUAL_KEYS, _course(t)),
            ("Bucket", S.bucket_forecast(t), A.BUCKET_FORECAST_KEYS, A.BUCKET_ACTUAL_KEYS, _bucket(t))):
        parts[method] = (A.forecast_summary(forecast, S.ACCURACY_YEAR, keys, S.OVERRIDES), A.actuals_summary(actuals, S.ACCURACY_YEAR, own), aligned)
    return A.accuracy_totals(parts)


@register("q17_workload_rows", """
    SELECT o_orderpriority AS "Faculty", count(DISTINCT o_custkey) AS "Bucket Forecast Row #", count(*) AS "Course Code Row #",
           count(*) / count(DISTINCT o_custkey) AS "Course Code:Bucket Workload Ratio"
    FROM orders WHERE strftime(o_orderdate, '%B') = 'June' GROUP BY 1""")
def q17_workload_rows(t):
    """Rows to analyse per group for one month."""
    rows = t.orders.groupBy(F.date_format("o_orderdate", "MMMM").alias("Month"), F.col("o_orderpriority").alias("Faculty"),
                            "o_custkey").agg(F.count(F.lit(1)).alias("n"))
    out = rows.groupBy("Month", "Faculty").agg(F.count(F.lit(1)).alias("Bucket Forecast Row #"),
                                               F.sum("n").alias("Course Code Row #"))
    ratio = F.col("`Course Code Row #`") / F.col("`Bucket Forecast Row #`")
    return A.workload_report(out.withColumn("Course Code:Bucket Workload Ratio", ratio), "June")


@register("q18_course_forecast_extract", f"""
    SELECT l.REFERENCE_YEAR, FORECAST_LOAD_ID, l.FORECAST_CONTROL_ID, FORECAST_METHODOLOGY_ID,
           REFERENCE_YEAR_PIT_DATE AS CURR_YR_FORECAST_DATE, TEACHING_FACULTY, tf.DESCRIPTION AS TEACHING_FACULTY_DESCRIPTION,
           TR_ORG_UNIT_CD, de.DESCRIPTION AS TR_ORG_UNIT_CD_DESCRIPTION, mf.DEGREE_FACULTY_NAME AS FACULTY,
           df.DEGREE_FACULTY_NAME AS DEGREE_FACULTY, l.FUNDING_SOURCE, fs.DESCRIPTION AS FUND_SOURCE_DESCRIPTION, COURSE_LEVEL,
           COURSE_CD, SCA_COORD_CAMPUS, SUA_LOCATION_CD, UNIT_MODE, COMMENCING_STUDENT_IND, OFFICIAL_CLUSTER, HOME_CLUSTER,
           HIGH_LOW_COST, CAST(REPORTED_FORECAST_TAUGHT_LOAD AS DOUBLE) AS REPORTED_FORECAST_TAUGHT_LOAD,
           strftime(REFERENCE_YEAR_PIT_DATE, '%B') AS FCAST_MONTH
    FROM forecast_taught_crs_load l LEFT JOIN forecast_control c ON l.FORECAST_CONTROL_ID = c.FORECAST_CONTROL_ID
    LEFT JOIN org_unit tf ON TEACHING_FACULTY = tf.ORG_UNIT_CD AND tf.ORG_STATUS = 'ACTIVE'
    LEFT JOIN org_unit de ON TR_ORG_UNIT_CD = de.ORG_UNIT_CD AND de.ORG_STATUS = 'ACTIVE'
    LEFT JOIN funding_source fs ON l.FUNDING_SOURCE = fs.FUNDING_SOURCE
    LEFT JOIN degree_faculty df ON l.DEGREE_FACULTY_ID = df.DEGREE_FACULTY_ID AND l.REFERENCE_YEAR = df.REFERENCE_YEAR
    LEFT JOIN degree_faculty mf ON l.FACULTY_ID = mf.DEGREE_FACULTY_ID AND l.REFERENCE_YEAR = mf.REFERENCE_YEAR
    WHERE l.FORECAST_CONTROL_ID IN ({", ".join(map(str, S.COURSE_RUNS))})""")
def q18_course_forecast_extract(t):
    """Course-level forecast rows of eight runs with names and month."""
    return A.course_forecast_extract(S.forecast_taught_crs_load(t), S.forecast_control(t), S.org_unit(t),
                                     S.funding_source(t), S.degree_faculty(t), S.COURSE_RUNS)


@register("q19_active_lookup", """
    SELECT CAST(s_suppkey AS VARCHAR) AS DEPARTMENT_CD, s_name AS DEPARTMENT FROM supplier WHERE s_acctbal > 0""")
def q19_active_lookup(t):
    """Code and name of the active units, here the suppliers with a balance."""
    units = t.supplier.select(F.col("s_suppkey").cast("string").alias("ORG_UNIT_CD"), F.col("s_name").alias("DESCRIPTION"),
                              F.when(F.col("s_acctbal") > 0, "ACTIVE").otherwise("INACTIVE").alias("ORG_STATUS"))
    return A.active_org_lookup(units)
