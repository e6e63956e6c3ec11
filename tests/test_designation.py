from datetime import date

import pytest
from conftest import bag, inline
from pyspark.sql import functions as F

from loadkit.plans import designation as G
from loadkit.schema import SCHEMAS

KEY = ("T", "D", "Medicine", "CSP", "UG", "CLAYTON", None, "ON", "Y", "2")


@pytest.fixture
def forecast(spark):
    def make(*rows):
        names = ["TEACHING_FACULTY", "TR_ORG_UNIT_CD", "DEGREE_FACULTY", "FUND_SOURCE_DESCRIPTION", "COURSE_LEVEL",
                 "SCA_COORD_CAMPUS", "SUA_LOCATION_CODE", "UNIT_MODE", "COMMENCING_STUDENT_IND", "HOME_CLUSTER"]
        ddl = ", ".join(f"{n} string" for n in names)
        return inline(spark, ddl + ", CURR_YR_FORECAST_DATE string, FUND_SOURCE string, REPORTED_FORECAST_TAUGHT_LOAD double",
                      [(*key, "24092019", None, load) for key, load in rows])
    return make


def actual(spark, name, *rows):
    ddl = ", ".join(f"{n} string" for n in G.split_keys(G.C.Institution()))
    return inline(spark, f"{ddl}, {name} decimal(18,4)", [(*key, load) for key, load in rows]).withColumn(
        "REPDATE", F.lit("09-24-2019"))


def key(**changes):
    names = G.split_keys(G.C.Institution())
    return tuple(changes.get(n, v) for n, v in zip(names, KEY))


@pytest.fixture
def job(spark, forecast):
    rows = [(KEY, 10.0), (key(UNIT_MODE="OFF"), 1.0), (key(COURSE_LEVEL="GPG"), 5.0), (key(COURSE_LEVEL=None), 7.0),
            (key(HOME_CLUSTER="9", FUND_SOURCE_DESCRIPTION=None), None), (key(DEGREE_FACULTY="Arts"), 3.0)]
    medical = actual(spark, G.MEDICAL_LOAD, (KEY, 4), (key(UNIT_MODE="OFF"), 2))
    subbach = actual(spark, G.SUB_BACHELOR_LOAD, (KEY, 3), (key(DEGREE_FACULTY="Arts"), 1),
                     (key(DEGREE_FACULTY="Arts"), 2))
    f = forecast(*rows)
    both = G.combine_actuals(medical, subbach)
    split = G.designation_split(f, both)
    long = G.split_to_long(split)
    return f, medical, subbach, both, split, long, G.designation_export(long)


def test_split(job):
    split = job[4]
    got = bag(split, "UNIT_MODE", "COURSE_LEVEL", "DEGREE_FACULTY", *G.PARTS)
    assert got == [
        ("OFF", "UG", "Medicine", 1.0, None, 0.0),
        ("ON", "GPG", "Medicine", None, None, 5.0),
        ("ON", "UG", "Arts", None, 1.0, 2.0), ("ON", "UG", "Arts", None, 2.0, 1.0),  # a repeated key multiplies the row
        ("ON", "UG", "Medicine", 4.0, 3.0, 6.0),  # both limits: more than the forecast
        ("ON", "UG", "Medicine", None, None, None),
        ("ON", None, "Medicine", None, None, 7.0)]


def test_long_drops_missing_parts_and_limits(job):
    long = job[5]
    assert G.MEDICAL_LOAD not in long.columns and long.count() == 11
    assert long.columns[-2:] == [G.GROUPING, G.FORECAST]


def test_export_fills_and_relabels(job):
    final = job[6]
    assert {r.SUA_LOCATION_CODE for r in final.collect()} == {"CLAYTON"}
    assert {r.FUND_SOURCE for r in final.collect()} == {"UNALLOCATED"}
    labels = bag(final, "COURSE_LEVEL", G.GROUPING)
    assert ("GPG", "DESIGNATED_GPG") in labels
    assert (None, None) in labels  # a missing level erases the label of a CSP row


def test_checks_report_the_known_exceptions(job):
    report = {r.check_name: r for r in G.split_checks(*job, as_of=date(2019, 9, 24)).collect()}
    assert report["run date"].ok and report["relabelled:DESIGNATED_GPG"].ok
    assert report["long equals wide:SUBBACH"].ok
    assert not report["rows of combined actuals"].ok  # one key matched
    assert float(report["forecast kept by join:" + G.FORECAST].difference) == 3.0
    assert float(report["parts equal forecast"].difference) == 3.0


def test_dates_of_run_and_snapshot_can_fail(spark, job, frame):
    control = frame("SNAPSHOT_ID long, REFERENCE_YEAR int, SNAPSHOT_DATE date", (5, 2019, date(2019, 9, 23)), (4, 2019, date(2019, 12, 1)),
                    (9, 2018, date(2018, 1, 1)))
    used = G.snapshot_date(control, date(2019, 9, 24))
    rows = {r.check_name: r for r in G.split_checks(*job, as_of=date(2019, 9, 24), snapshot=used).collect()}
    assert rows["run date"].ok and not rows["snapshot date"].ok
    assert (int(rows["snapshot date"].expected), int(rows["snapshot date"].actual)) == (20190924, 20190923)
    late = {r.check_name: r for r in G.split_checks(*job, as_of=date(2019, 9, 25)).collect()}
    assert not late["run date"].ok and float(late["run date"].difference) == -1.0
    # The latest of the report dates counts, not the last in the alphabet.
    mixed = job[3].unionByName(job[3].withColumn("REPDATE", F.lit("12-31-2018")))
    rows = {r.check_name: r for r in G.split_checks(*job[:3], mixed, *job[4:], as_of=date(2019, 9, 24)).collect()}
    assert rows["run date"].ok


def test_checks_read_the_export_for_both_labels(job):
    final = G.designation_export(job[5], label_before=G.LABEL_BEFORE)
    one = bag(G.split_checks(*job, as_of=date(2019, 9, 24)))
    assert bag(G.split_checks(*job[:6], final, as_of=date(2019, 9, 24))) == one


def test_sets_side_by_side_equal_their_full_join(spark, frame):
    loads = frame("k string, s string, v decimal(18,4)", ("a", "m", 1), ("a", "m", 2), ("a", "n", 3), ("a", "n", None), ("b", "m", 4), ("c", "n", 5),
                  (None, "m", 6), (None, "n", 7))
    held = loads.groupBy("k").agg(F.collect_list(F.struct(F.col("s").alias(G.SET), F.col("v").alias("LOAD"))).alias(G.LOADS)).withColumn(
        G.REPORT_DATE, F.lit("x"))
    joined = G.combine_actuals(G.loads_of_set(held, "m"), G.loads_of_set(held, "n"))
    wide = G.side_by_side(held, ["m", "n"])
    assert bag(wide, *joined.columns) == bag(joined) and wide.count() == 7


def test_export_name(job, forecast):
    assert G.export_name(job[6], "SPLIT") == "SPLIT 24092019 w Des_Ind - blank fix required.csv"


def test_designated_actuals_hide_the_cluster_code(spark):
    def frame(name, *rows):
        ddl = ", ".join(f"{f.name} {'double' if f.dataType.typeName() == 'decimal' else f.dataType.simpleString()}"
                        for f in SCHEMAS[name].fields)
        return inline(spark, ddl, [tuple(dict(r).get(n) for n in SCHEMAS[name].names) for r in rows])
    row = dict(SNAPSHOT_ID=5, REFERENCE_YEAR=2019, FUNDING_SOURCE="DETYA", DEGREE_FACULTY_ID=1, COURSE_CD="4531", COURSE_LEVEL="UG",
               SCA_COORD_CAMPUS="CLAYTON", UNIT_MODE="ON", COMMENCING_STUDENT_IND="Y", TEACHING_FACULTY="T", TR_ORG_UNIT_CD="D",
               CLUSTER_TRANSLATION_ID=1, EFTSL=1.0)
    loads = frame("unit_load", row, {**row, "CLUSTER_TRANSLATION_ID": 2}, {**row, "CLUSTER_TRANSLATION_ID": 3},
                  {**row, "COURSE_CD": "x"}, {**row, "SNAPSHOT_ID": 4}, {**row, "FUNDING_SOURCE": "z"})
    out = G.designated_actuals(
        loads, frame("aggregation_control", dict(SNAPSHOT_ID=5, REFERENCE_YEAR=2019, SNAPSHOT_DATE=date(2019, 1, 1)),
                     dict(SNAPSHOT_ID=4, REFERENCE_YEAR=2019, SNAPSHOT_DATE=date(2019, 9, 1))),
        frame("cluster_translation", dict(CLUSTER_TRANSLATION_ID=1, CLUSTER_CD="a", CLUSTER_SUBGROUP="s"),
              dict(CLUSTER_TRANSLATION_ID=2, CLUSTER_CD="b", CLUSTER_SUBGROUP="s"),
              dict(CLUSTER_TRANSLATION_ID=3, CLUSTER_CD="b", CLUSTER_SUBGROUP="s")),
        frame("degree_faculty", dict(DEGREE_FACULTY_ID=1, REFERENCE_YEAR=2019, DEGREE_FACULTY_NAME="Medicine"),
              dict(DEGREE_FACULTY_ID=1, REFERENCE_YEAR=2018, DEGREE_FACULTY_NAME="Old")),
        frame("funding_source", dict(FUNDING_SOURCE="DETYA", DESCRIPTION="CSP")), ("4531",), G.MEDICAL_LOAD, date(2019, 9, 24))
    assert bag(out, "DEGREE_FACULTY", "HOME_CLUSTER", G.MEDICAL_LOAD, "REPDATE") == [
        ("Medicine", "s", 1.0, "09-24-2019"), ("Medicine", "s", 2.0, "09-24-2019")]
