import math
from datetime import date

import pytest
from conftest import bag
from pyspark.sql import functions as F

from loadkit import config as C
from loadkit.plans import forecast_accuracy as A

ACTUAL = ("YEAR int, FACULTY string, DEGREE_FACULTY string, TEACHING_FACULTY_CD string, TEACHING_FACULTY_NAME string, "
          "DEPARTMENT_CD string, DEPARTMENT string, COURSE_LEVEL string, CAMPUS string, UNIT_MODE string, FUND_SOURCE string, "
          "COM_RET string, COURSE_CD string, COURSE_DESCRIPTION string, EFTSL double")
FORECAST = ("REFERENCE_YEAR int, FACULTY string, DEGREE_FACULTY string, TEACHING_FACULTY int, TEACHING_FACULTY_DESCRIPTION string, "
            "TR_ORG_UNIT_CD int, TR_ORG_UNIT_CD_DESCRIPTION string, COURSE_LEVEL string, SCA_COORD_CAMPUS string, UNIT_MODE string, "
            "FUND_SOURCE_DESCRIPTION string, COMMENCING_STUDENT_IND string, COURSE_CD string, FCAST_MONTH string, "
            "REPORTED_FORECAST_TAUGHT_LOAD double")


def actual(course, descr, load, campus="CLAYTON", faculty="Arts", year=2018):
    return (year, faculty, "Arts", "500", "FACULTY OF ARTS", "50000982", "WATER STUDIES CENTRE", "UG", campus, "ON", "CSP",
            "Commencing", course, descr, load)


def forecast(course, month, load, campus="CLAYTON", faculty="Arts", year=2018, flag="Y"):
    return (year, faculty, "Arts", 500, "Faculty of Arts", 50000982, "old name", "UG", campus, "ON", "CSP", flag, course, month, load)


@pytest.fixture
def aligned(frame):
    actuals = frame(ACTUAL, actual("a", "A one", 1.0), actual("a", "A two", 2.0), actual("b", "B", 4.0), actual("b", "B", None),
                    actual("z", "Z", 9.0, year=2017))
    forecasts = frame(FORECAST, forecast("a", "March", 5.0), forecast("a", "June", 6.0), forecast("c", "June", 7.0),
                      forecast("a", None, 100.0), forecast("q", "July", 9.0, year=2017))
    return actuals, forecasts


def test_align_course(aligned):
    out = A.align_forecast(*aligned, 2018, "course")
    assert bag(out, "FCAST_MONTH", "COURSE_CD", "COURSE_DESCRIPTION", "FCAST_EFTSL", "ACTUALS_EFTSL") == [
        ("June", "a", "A one", 6.0, 1.0), ("June", "a", "A two", 6.0, 2.0),  # two descriptions count the forecast twice
        ("June", "b", "B", None, 4.0), ("June", "c", None, 7.0, None),
        ("March", "a", "A one", 5.0, 1.0), ("March", "a", "A two", 5.0, 2.0), ("March", "b", "B", None, 4.0)]
    assert {r.DEPARTMENT for r in out.collect()} == {"WATER STUDIES CENTRE"}


def test_align_bucket_and_consolidate(aligned):
    actuals, forecasts = aligned
    bucket = A.align_forecast(actuals, forecasts.drop("COURSE_CD"), 2018, "bucket")
    assert bag(bucket, "FCAST_MONTH", "FCAST_EFTSL", "ACTUALS_EFTSL") == [("June", 13.0, 7.0), ("March", 5.0, 7.0)]
    both = A.consolidate(A.align_forecast(actuals, forecasts, 2018, "course"), bucket)
    assert bag(both.where("FCAST_TYPE = 'Bucket'"), "COURSE_CD", "FCAST_EFTSL") == [(None, 13.0), (None, 5.0)]
    assert both.count() == 9


def test_overrides_belong_to_one_year(frame):
    actuals = frame(ACTUAL, actual("a", "A", 1.0, year=2019))
    out = A.align_forecast(actuals, frame(FORECAST, forecast("a", "March", 5.0, year=2019)), 2019, "course")
    # without the correction the department names differ, so the rows do not meet
    assert bag(out, "DEPARTMENT", "FCAST_EFTSL", "ACTUALS_EFTSL") == [
        ("OLD NAME", 5.0, None), ("WATER STUDIES CENTRE", None, 1.0)]


def test_raw_variants_stay_apart_and_both_meet_the_actuals(frame):
    actuals = frame(ACTUAL, actual("a", "A", 1.0)).withColumn("COM_RET", F.lit("Returning"))
    rows = frame(FORECAST, forecast("a", "March", 5.0, flag="N"), forecast("a", "March", 6.0, flag="X"),
                 forecast("a", "March", 7.0, flag=None))
    out = A.align_forecast(actuals, rows, 2018, "course")
    assert bag(out, "COM_RET", "FCAST_EFTSL", "ACTUALS_EFTSL") == [
        ("Returning", 5.0, 1.0), ("Returning", 6.0, 1.0), (None, 7.0, None)]


@pytest.fixture
def base(frame):
    rows = [  # month, type, campus, faculty, teaching faculty, unit, course, fund, forecast, actual
        ("March", "Course", "CLAYTON", "Arts", "FACULTY OF ARTS", "1", "11", "c1", "CSP", 10.125, 8.0),
        ("March", "Course", "CLAYTON", "Arts", "FACULTY OF ARTS", "1", "12", "c1", "CSP", 1.0, 4.0),
        ("March", "Course", "CLAYTON", None, "FACULTY OF LAW", "2", "21", "c2", "CSP", 2.0, None),
        ("March", "Course", "CLAYTON", None, "FACULTY OF LAW", "2", "21", "c3", "CSP", None, None),
        ("May", "Course", "CLAYTON", "Arts", "LIBRARY", "3", "31", "c4", "FEE", 2.0, 1.0),
        ("March", "Bucket", "CLAYTON", "Arts", "FACULTY OF ARTS", "1", "11", None, "CSP", 9.0, 12.0),
        ("March", "Bucket", "MALAYSIA", "Arts", "FACULTY OF ARTS", "1", "11", None, "CSP", 99.0, 1.0),
        ("March", "Bucket", None, "Arts", "FACULTY OF ARTS", "1", "11", None, "CSP", 99.0, 1.0),
        ("March", "Bucket", "CLAYTON", "MSDI", "FACULTY OF ARTS", "1", "11", None, "CSP", 99.0, 1.0)]
    df = frame("FCAST_MONTH string, FCAST_TYPE string, CAMPUS string, FACULTY string, TEACHING_FACULTY_NAME string, "
               "TEACHING_FACULTY_CD string, DEPARTMENT_CD string, COURSE_CD string, FUND_SOURCE string, f double, a double", *rows)
    df = df.select("*", F.col("f").cast("decimal(18,4)").alias("FCAST_EFTSL"), F.col("a").cast("decimal(18,4)").alias("ACTUALS_EFTSL"))
    return A.error_base(df.drop("f", "a").withColumn("COM_RET", F.lit("Commencing")), C.month_levels(2018), SCOPE)


SCOPE = C.Scope(excluded_campuses=("MALAYSIA", "SAFRICA"), excluded_faculties=("MSDI", "MUARC"), outside_totals=("MUARC",))


def test_scopes_treat_a_missing_faculty_differently(frame):
    df = frame("CAMPUS string, FACULTY string", ("A", "Arts"), ("A", None), ("A", "MSDI"), ("A", "MUARC"), ("MALAYSIA", "Arts"), (None, "Arts"))
    assert bag(A.in_scope(df, SCOPE)) == [("A", "Arts"), ("A", None)]
    assert bag(A.in_totals(df, SCOPE)) == [("A", "Arts"), ("A", "MSDI")]


def test_error_base(base):
    assert bag(base, "FCAST_MONTH", "month_ord", "FCAST_TYPE", "ForecastError") == [
        ("March", 1, "Bucket", -3.0), ("March", 1, "Course", -3.0), ("March", 1, "Course", 0.0), ("March", 1, "Course", 2.0),
        ("March", 1, "Course", 2.12), (None, None, "Course", 1.0)]


def test_summary_and_report_order(base):
    table = A.report_table(A.error_summary(base), C.month_levels(2018))
    assert table.columns == ["Month", "Forecast Type", "Forecast (EFTSL)", "Actual Load", "Error", "Absolute Error"]
    rows = [tuple(float(v) if i > 1 else v for i, v in enumerate(r)) for r in table.collect()]
    assert rows == [("March", "Bucket", 9.0, 12.0, -3.0, 3.0), ("March", "Course", 13.125, 12.0, 1.12, 7.12),
                    (None, "Course", 2.0, 1.0, 1.0, 1.0)]


def test_error_by_month(base):
    assert bag(A.error_by_month(base), "FCAST_MONTH", "FCAST_TYPE", "percError") == [
        ("March", "Bucket", -25.0), ("March", "Course", 9.33), (None, "Course", 100.0)]


def test_error_by_faculty(base, frame):
    org = A.active_org_lookup(frame("ORG_UNIT_CD string, DESCRIPTION string, ORG_STATUS string", ("1", "FACULTY OF ARTS", "ACTIVE"),
                                    ("2", "FACULTY OF LAW", "INACTIVE"), ("11", "WATER", "ACTIVE")))
    short = frame("TEACHING_FACULTY_NAME string, TEACHING_FAC_ABBREV string", ("FACULTY OF ARTS", "ART"), (None, "NONE"))
    rows = A.error_by_faculty(base, org, short)
    got = bag(rows, "TEACHING_FAC_ABBREV", "FCAST_TYPE", "ForecastError", "ACTUALS_EFTSL", "percError")
    assert got == [("ART", "Bucket", -3.0, 12.0, -25.0), ("ART", "Course", -0.88, 12.0, -7.33), ("NONE", "Course", 2.0, 0.0, math.inf)]
    funds = A.error_by_faculty_fund(base, org, short)
    assert {(r.FUND_SOURCE, r.FUND_SOURCE_ABBREV) for r in funds.collect()} == {("CSP", "CSP")}


def test_error_by_course_drops_infinite_percentages(base):
    rows = A.error_by_course(base).collect()
    got = {r.row_id: r for r in rows}
    assert set(got) == {"Arts c1 Commencing CSP", "NA c3 Commencing CSP"}
    arts = got["Arts c1 Commencing CSP"]
    assert (float(arts.ForecastError), float(arts.ABSForecastError), arts.percError, arts.ABSpercError) == (-0.88, 0.88, -7.33, 7.33)
    assert math.isnan(got["NA c3 Commencing CSP"].ABSpercError)


def test_month_levels_by_year():
    assert len(C.month_levels(2018)) == 5 and C.month_levels(2019) == ("March", "June", "September")


def test_workload_report(frame):
    rows = frame("Month string, Faculty string, n int", ("June", "Arts", 1), ("July", "Arts", 2))
    assert bag(A.workload_report(rows)) == [("Arts", 1)]


def test_course_forecast_extract(frame):
    load = frame("FORECAST_LOAD_ID long, FORECAST_CONTROL_ID long, FORECAST_METHODOLOGY_ID long, REFERENCE_YEAR int, TEACHING_FACULTY string, "
                 "TR_ORG_UNIT_CD string, FACULTY_ID long, DEGREE_FACULTY_ID long, FUNDING_SOURCE string, COURSE_LEVEL string, COURSE_CD string, "
                 "SCA_COORD_CAMPUS string, SUA_LOCATION_CD string, UNIT_MODE string, COMMENCING_STUDENT_IND string, OFFICIAL_CLUSTER string, "
                 "HOME_CLUSTER string, HIGH_LOW_COST string, REPORTED_FORECAST_TAUGHT_LOAD double",
                 (1, 40, 1, 2018, "t", "d", 2, 1, "F", "UG", "c", "CLAYTON", None, "ON", "Y", "1", "2", "H", 1.5),
                 (2, 99, 1, 2018, "t", "d", 2, 1, "F", "UG", "c", "CLAYTON", None, "ON", "Y", "1", "2", "H", 1.5))
    out = A.course_forecast_extract(
        load, frame("FORECAST_CONTROL_ID long, REFERENCE_YEAR_PIT_DATE date", (40, date(2018, 3, 5))),
        frame("ORG_UNIT_CD string, DESCRIPTION string, ORG_STATUS string", ("t", "Arts", "ACTIVE"), ("d", "Old", "INACTIVE")),
        frame("FUNDING_SOURCE string, DESCRIPTION string", ("F", "CSP")),
        frame("DEGREE_FACULTY_ID long, DEGREE_FACULTY_NAME string, REFERENCE_YEAR int", (1, "Medicine", 2018), (2, "Science", 2018), (1, "x", 2017)))
    assert bag(out, "FORECAST_LOAD_ID", "TEACHING_FACULTY_DESCRIPTION", "TR_ORG_UNIT_CD_DESCRIPTION", "FACULTY", "DEGREE_FACULTY",
               "FUND_SOURCE_DESCRIPTION", "FCAST_MONTH") == [(1, "Arts", None, "Science", "Medicine", "CSP", "March")]


def test_years_have_their_own_months_and_corrections(spark, frame):
    actuals = frame(ACTUAL, actual("a", "A", 1.0), actual("a", "A", 2.0, year=2019), actual("a", "A", 3.0, year=2020), actual("a", "A", 4.0, year=None))
    rows = frame(FORECAST, forecast("a", "March", 5.0), forecast("a", "July", 6.0), forecast("a", "June", 7.0, year=2019), forecast("a", "July", 8.0, year=2019))
    corrections = A.override_rules(spark, {2018: (("50000982", "x"), ("50000982", "WATER STUDIES CENTRE"))})
    out = A.align_years(actuals, rows, "course", corrections)
    assert bag(out, "YEAR", "FCAST_MONTH", "DEPARTMENT", "FCAST_EFTSL", "ACTUALS_EFTSL") == [
        (2018, "July", "WATER STUDIES CENTRE", 6.0, 1.0), (2018, "March", "WATER STUDIES CENTRE", 5.0, 1.0),
        (2019, "July", "OLD NAME", 8.0, None), (2019, "July", "WATER STUDIES CENTRE", None, 2.0),
        (2019, "June", "OLD NAME", 7.0, None), (2019, "June", "WATER STUDIES CENTRE", None, 2.0)]
    for year in (2018, 2019):
        one = A.align_forecast(actuals, rows, year, "course", (("50000982", "WATER STUDIES CENTRE"),) if year == 2018 else ())
        assert bag(out.where(f"YEAR = {year}").drop("YEAR"), *one.columns) == bag(one)
    base = A.error_base_years(A.consolidate(out, out.drop("COURSE_CD", "COURSE_DESCRIPTION")), A.month_rules(spark, C.MONTH_LEVELS), SCOPE)
    assert {(r.YEAR, r.FCAST_MONTH, r.month_ord) for r in base.collect()} == {(2018, "March", 1), (2018, "July", 3), (2019, "June", 2), (2019, None, None)}


def test_all_tables_at_once_equal_each_alone(base, frame):
    org = A.active_org_lookup(frame("ORG_UNIT_CD string, DESCRIPTION string, ORG_STATUS string", ("1", "FACULTY OF ARTS", "ACTIVE"),
                                    ("2", "FACULTY OF LAW", "INACTIVE"), ("11", "WATER", "ACTIVE")))
    short = frame("TEACHING_FACULTY_NAME string, TEACHING_FAC_ABBREV string", ("FACULTY OF ARTS", "ART"), (None, "NONE"))
    every = A.error_tables(base, org=org, abbreviations=short)
    for table in A.TABLES:
        alone = A.error_tables(base, [table], org, short)
        assert str(bag(every.where(F.col(A.TABLE) == table))) == str(bag(alone)) != "[]"  # as text, because NaN differs from itself
    plan = every._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Expand") == 1


def test_accuracy_totals_name_what_the_alignment_counts_twice(aligned):
    actuals, forecasts = aligned
    parts = {"Course": (A.forecast_summary(forecasts, 2018, A.COURSE_FORECAST_KEYS, ()), A.actuals_summary(actuals, 2018, A.COURSE_ACTUAL_KEYS),
                        A.align_forecast(actuals, forecasts, 2018, "course", ()))}
    # Without corrections no department name meets; with them the course with two descriptions doubles its forecasts.
    rows = {r.check_name: r for r in A.accuracy_totals(parts).collect()}
    assert all(r.ok for r in rows.values()) and float(rows["Course:ACTUALS_EFTSL"].expected) == 14.0
    fixes = (("50000982", "WATER STUDIES CENTRE"),)
    parts = {"Course": (A.forecast_summary(forecasts, 2018, A.COURSE_FORECAST_KEYS, fixes), parts["Course"][1],
                        A.align_forecast(actuals, forecasts, 2018, "course", fixes))}
    rows = {r.check_name: r for r in A.accuracy_totals(parts).collect()}
    assert float(rows["Course:FCAST_EFTSL"].difference) == 11.0 and not rows["Course:rows with a forecast"].ok
    assert rows["Course:ACTUALS_EFTSL"].ok
