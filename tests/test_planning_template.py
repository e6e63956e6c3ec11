"""The planning job on a small hand-made fixture with known results."""

import re
from datetime import date

import pytest
from conftest import bag, inline

from loadkit import config as C
from loadkit.plans import planning_template as P
from loadkit.schema import SCHEMAS

Y = 2019
LOAD = dict(SNAPSHOT_ID=92, REFERENCE_YEAR=Y, FUNDING_SOURCE="F1", DEGREE_FACULTY_ID=1, FACULTY_ID=2, COURSE_CD="4531",
            COURSE_LEVEL="UG", SCA_COORD_CAMPUS="CLAYTON", SCA_LOCATION_CD=None, UNIT_MODE="ON", COMMENCING_STUDENT_IND="Y",
            NOMINATED_YEAR_LEVEL=1, EFTSL=1.0)


@pytest.fixture
def tables(spark):
    def make(unit_load=(), plan_details=(), plan_forecast=(), forecast_load=(), course_version=None, degree_faculty=None):
        def frame(name, rows):
            schema = SCHEMAS[name]
            rows = [r if isinstance(r, dict) else dict(zip(schema.names, r)) for r in rows]
            plain = [tuple(r.get(n) for n in schema.names) for r in rows]
            ddl = ", ".join(f"{f.name} {'double' if f.dataType.typeName() == 'decimal' else f.dataType.simpleString()}"
                            for f in schema.fields)
            return inline(spark, ddl, plain)
        return P.PlanningTables(
            unit_load=frame("unit_load", unit_load), plan_details=frame("plan_details", plan_details),
            plan_forecast=frame("plan_forecast", plan_forecast), forecast_load=frame("forecast_load", forecast_load),
            key_attributes_master=frame("key_attributes_master", [
                (1, Y - 1, "F1", "DF", "MF", "UG", "CLAYTON", "ON"), (2, Y, "F2", "DF", "MF", "HDR", "CLAYTON", "OFF")]),
            degree_faculty=frame("degree_faculty", degree_faculty or [
                (1, "DF", Y, "Medicine", "Y"), (2, "MF", Y, "Science", "N"),
                (3, "DF", Y - 1, "Medicine", "Y"), (4, "MF", Y - 1, "Science", "N")]),
            funding_source=frame("funding_source", [("F1", "CSP"), ("F2", "FEE"), ("F3", None)]),
            course_version=frame("course_version", course_version or [("4531", 1, date(2010, 1, 1), "MED")]),
            aggregation_control=frame("aggregation_control", [
                (92, Y, date(Y, 5, 1)), (91, Y, date(Y, 2, 1)), (80, Y - 1, date(Y - 1, 12, 1)),
                (81, Y - 1, date(Y - 1, 6, 3)), (70, Y - 2, date(Y - 2, 12, 1))]),
            forecast_control=frame("forecast_control", [(7, date(Y, 3, 1)), (8, date(Y, 6, 1))]))
    return make


def planned(t, **options):
    return P.planned_load(t, Y, date(Y, 6, 3), **options)


def load(**changes):
    return {**LOAD, **changes}


def test_actuals_take_every_role_of_their_snapshot(tables):
    t = tables(unit_load=[load(), load(EFTSL=0.5), load(SNAPSHOT_ID=91), load(SNAPSHOT_ID=80, REFERENCE_YEAR=Y - 1),
                          load(SNAPSHOT_ID=81, REFERENCE_YEAR=Y - 1, EFTSL=4.0), load(SNAPSHOT_ID=70, REFERENCE_YEAR=Y - 2)])
    assert bag(planned(t), "MEASURE", "YEAR", "PLAN_YEAR", "EFTSL") == [
        ("2 year previous actual latest", 2017, "2017", 1.0), ("CURRENT_YEAR_YEAR_1", 2019, "2019", 1.5),
        ("Current Actual Latest", 2019, "2019", 1.5), ("Last year PIT actuals", 2018, "2018", 4.0),
        ("PREVIOUS_YEAR_YEAR_1", 2018, "2018", 1.0), ("Previous year actual latest", 2018, "2018", 1.0)]


def test_actual_columns(tables):
    row = planned(tables(unit_load=[load()])).where("MEASURE = 'Current Actual Latest'").first()
    assert row.asDict() == {
        "YEAR": 2019, "FIXED_BUCKET": "Yes", "PLANNING_MODULE": "CSP Planning", "FUND_SOURCE": "CSP", "HOME_LOAD": "Home",
        "FACULTY": "Science", "DEGREE_FACULTY": "Medicine", "COURSE_LEVEL": "UG", "CAMPUS": "CLAYTON", "UNIT_MODE": "ON",
        "COURSE_CD": "4531", "COURSE_DESCRIPTION": "MED", "COURSE_LOCATION": "NA", "DESIGNATED_IND": "CSP Designated Medical UG",
        "PLAN_YEAR": "2019", "REVIEWED": "Actuals", "COM_RET": "Commencing", "EFTSL": 1.0, "MEASURE": "Current Actual Latest"}


def test_equal_loads_of_one_band_collapse_unless_exact(tables):
    t = tables(unit_load=[load(NOMINATED_YEAR_LEVEL=5), load(NOMINATED_YEAR_LEVEL=6), load(NOMINATED_YEAR_LEVEL=None),
                          load(NOMINATED_YEAR_LEVEL=0, EFTSL=2.0)])
    assert bag(planned(t), "MEASURE", "EFTSL") == [
        ("CURRENT_YEAR_YEAR_1", 1.0), ("CURRENT_YEAR_YEAR_5+", 1.0), ("Current Actual Latest", 5.0), (None, 2.0)]
    assert ("CURRENT_YEAR_YEAR_5+", 2.0) in bag(planned(t, set_mode="exact"), "MEASURE", "EFTSL")


def test_degree_faculty_is_matched_by_id_alone(tables):
    t = tables(unit_load=[load()], degree_faculty=[(1, "DF", Y, "Medicine", "Y"), (1, "DF", Y - 5, "Old name", "N"),
                                                   (2, "MF", Y - 5, "Never matched", "N")])
    rows = bag(planned(t).where("MEASURE = 'Current Actual Latest'"), "DEGREE_FACULTY", "FACULTY", "HOME_LOAD", "EFTSL")
    assert rows == [("Medicine", None, "Home", 1.0), ("Old name", None, "Other", 1.0)]
    assert planned(t, dedupe_dims=True).where("MEASURE = 'Current Actual Latest'").count() == 1


def test_missing_fund_and_student_flag(tables):
    t = tables(unit_load=[load(FUNDING_SOURCE=None), load(FUNDING_SOURCE="F3", COMMENCING_STUDENT_IND="X", EFTSL=2.0),
                          load(FUNDING_SOURCE="F3", COMMENCING_STUDENT_IND=None, EFTSL=2.0)])
    rows = planned(t).where("MEASURE = 'Current Actual Latest'")
    # two raw flags without a label and equal loads look alike, so one of them remains
    assert bag(rows, "FUND_SOURCE", "COM_RET", "DESIGNATED_IND", "EFTSL") == [
        ("UNCLASSIFIED", "Commencing", None, 1.0), ("UNCLASSIFIED", None, None, 2.0)]


def test_plan_rows(tables):
    t = tables(plan_details=[
        (1, None, None, "2019", "R", 10.0, None), (1, None, None, "2020", "R", 5.0, 6.0),
        (1, "4531", "CITY", "2020", "R", 1.0, None), (1, None, None, "2024", "R", 9.0, None),
        (2, None, None, "2020", "R", 9.0, None), (99, None, None, "2020", "R", 9.0, None)])
    assert bag(planned(t), "MEASURE", "COURSE_CD", "COURSE_DESCRIPTION", "COURSE_LOCATION", "COM_RET", "EFTSL") == [
        ("Plan Year 1", C.BUCKET, C.BUCKET, "NA", "Commencing", 5.0), ("Plan Year 1", C.BUCKET, C.BUCKET, "NA", "Returning", 6.0),
        ("Plan Year 1", "4531", "MED", "CITY", "Commencing", 1.0),
        ("Previous plan for current year", C.BUCKET, C.BUCKET, "NA", "Commencing", 10.0),
        (None, C.BUCKET, C.BUCKET, "NA", "Commencing", 10.0)]


def test_forecast_rows(tables):
    t = tables(plan_forecast=[(2, None, None, 3.0, None), (99, None, None, 1.0, None)],
               forecast_load=[(8, Y, "F1", 1, 2, "UG", "CLAYTON", "ON", "N", 2.5), (7, Y, "F1", 1, 2, "UG", "CLAYTON", "ON", "N", 9.0)])
    assert bag(planned(t), "MEASURE", "YEAR", "FUND_SOURCE", "DESIGNATED_IND", "COM_RET", "EFTSL") == [
        ("Monitoring Forecast", 2019, "CSP", "CSP Undesignated bucket level UG", "Returning", 2.5),
        ("Planning Forecast", 2019, "FEE", "Non-CSP", "Commencing", 3.0),
        ("Planning Forecast", None, None, None, "Commencing", 1.0)]


def test_template_columns_and_filter(tables):
    t = tables(unit_load=[load(), load(COURSE_CD="x", EFTSL=0.0), load(COURSE_CD="n", EFTSL=None)],
               forecast_load=[(8, Y, "F2", 1, 2, "UG", "CLAYTON", "ON", "N", 2.5)])
    out = P.planning_template(planned(t))
    assert out.columns == [*C.TEMPLATE_IDS, *C.TEMPLATE_MEASURES]
    # zero and missing loads leave; a bucket with only a forecast stays although all its columns are zero
    rows = {r.COURSE_CD: r for r in out.collect()}
    assert set(rows) == {"4531", C.BUCKET}
    assert rows["4531"]["Current Actual Latest"] == 1.0 and rows["4531"]["Plan Year 5"] == 0.0
    assert all(rows[C.BUCKET][m] == 0.0 for m in C.TEMPLATE_MEASURES)


def test_plan_year_five_copies_four(tables):
    t = tables(plan_details=[(1, None, None, "2023", "R", 7.0, None)])
    row = P.planning_template(planned(t)).first()
    assert row["Plan Year 4"] == row["Plan Year 5"] == 7.0


def test_totals_and_rollup(tables):
    base = dict(COURSE_LEVEL="HDR", FUNDING_SOURCE="F2")
    t = tables(unit_load=[load(**base, COURSE_CD="a", EFTSL=1.0), load(**base, COURSE_CD="a", UNIT_MODE="OFF", EFTSL=2.0),
                          load(**base, COURSE_CD="b", EFTSL=4.0), load(COURSE_CD="c", EFTSL=8.0)])
    show = ("COURSE_CD", "UNIT_MODE", "Current Actual Latest")
    assert bag(P.template_with_totals(planned(t)), *show) == [
        ("a", "OFF", 2.0), ("a", "ON", 1.0), ("a", "TOTAL", 3.0), ("b", "ON", 4.0), ("b", "TOTAL", 4.0),
        ("c", "ON", 8.0), ("c", "TOTAL", 8.0)]
    rolled = P.template_with_rollup(planned(t)).where(f"COURSE_CD = '{C.BUCKET}'")
    assert bag(rolled, *show) == [(C.BUCKET, "OFF", 2.0), (C.BUCKET, "ON", 5.0), (C.BUCKET, "TOTAL", 7.0)]
    ordered = [r.UNIT_MODE for r in P.in_report_order(P.template_with_totals(planned(t))).collect()]
    assert ordered == ["ON", "TOTAL", "OFF", "ON", "TOTAL", "ON", "TOTAL"]


def test_measures_are_dealt_once(tables):
    """One shuffle serves the grouping and the closing DISTINCT or sum of all branches."""
    t = tables(unit_load=[load()], plan_details=[(1, None, None, "2019", "R", 1.0, None)], plan_forecast=[(2, None, None, 3.0, None)],
               forecast_load=[(8, Y, "F1", 1, 2, "UG", "CLAYTON", "ON", "N", 2.5)])
    for options in ({}, {"set_mode": "exact"}):
        lines = planned(t, **options)._jdf.queryExecution().executedPlan().toString().splitlines()
        depth = [len(re.match(r"[ :+*()0-9-]*", line).group()) for line in lines]
        at = next(i for i, line in enumerate(lines) if line.lstrip(" :+-*()0123456789").startswith("Union"))
        above = [lines[i] for i in range(at) if depth[i] < min(depth[i + 1:at + 1])]
        last = next(i for i, line in enumerate(above) if "Aggregate" in line)
        assert sum("Exchange hashpartitioning" in line for line in above[last:]) == 1
        assert sum("Join" in line for line in above[:last]) == 1 and not any("Join" in line for line in above[last:])


def test_each_description_of_a_course_has_its_row(tables):
    t = tables(unit_load=[load(), load(COURSE_CD="other"), load(COURSE_CD=None)],
               plan_details=[(1, None, None, "2020", "R", 5.0, None), (1, "4531", None, "2020", "R", 6.0, None)],
               plan_forecast=[(2, "4531", None, 3.0, None), (2, C.BUCKET, None, 4.0, None)],
               course_version=[("4531", 1, date(2010, 1, 1), "MED"), ("4531", 1, date(2010, 1, 1), None), ("4531", 2, date(2023, 1, 1), "NEW")])
    def named(rows, measure):
        return bag(rows.where(f"MEASURE = '{measure}'"), "COURSE_CD", "COURSE_DESCRIPTION", "EFTSL")

    rows = planned(t, forecast_version_date=date(2015, 1, 1))
    assert named(rows, "Current Actual Latest") == [("4531", "NEW", 1.0), ("other", None, 1.0), (None, None, 1.0)]
    assert named(rows, "Plan Year 1") == [(C.BUCKET, C.BUCKET, 5.0), ("4531", "NEW", 6.0)]
    assert named(rows, "Planning Forecast") == [(C.BUCKET, None, 4.0), ("4531", "MED", 3.0), ("4531", None, 3.0)]


def test_unknown_set_mode(tables):
    with pytest.raises(ValueError):
        planned(tables(), set_mode="other")
