"""Planning template: the whole job, step by step."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from loadkit import config as C
from loadkit.plans import planning_template as P
from loadkit.schema import decimals_to_double
from verification import standin as S
from verification.standin_sql import with_ctes

# --- Spark -------------------------------------------------------------------


def _planned(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    tables = S.planning_tables(S.Tables(spark, sf_dir))
    return P.planned_load(tables, S.REF_YEAR, S.AS_OF, S.RULES, **options)


def planned_load(spark, sf_dir):
    return decimals_to_double(_planned(spark, sf_dir))


def planned_load_exact(spark, sf_dir):
    return decimals_to_double(_planned(spark, sf_dir, set_mode="exact", dedupe_dims=True))


def template(spark, sf_dir):
    return P.planning_template(_planned(spark, sf_dir))


def totals(spark, sf_dir):
    return P.template_with_totals(_planned(spark, sf_dir))


def rollup(spark, sf_dir):
    return P.template_with_rollup(_planned(spark, sf_dir))


# --- oracle ------------------------------------------------------------------

RTP = "'RESEARCH TRAINING PROGRAM - DOMESTIC', 'RESEARCH TRAINING PROGRAM - INTERNATIONAL'"
MEDICAL = "'Brand#1', 'Brand#2', 'Brand#3', 'Brand#4'"
SUB = "'Brand#5', 'Brand#6', 'Brand#7', 'Brand#8', 'Brand#9', 'Brand#10'"
BUCKET = "'* Key attribute bucket'"
FIXED = f"CASE WHEN fs.DESCRIPTION IN ('CSP', {RTP}) THEN 'Yes' ELSE 'No fixed bucket' END"
MODULE = (f"CASE WHEN fs.DESCRIPTION = 'CSP' THEN 'CSP Planning' WHEN fs.DESCRIPTION = 'INTERNATIONAL: OFFSHORE PARTNERS' "
          f"THEN 'Offshore Partner Planning' WHEN fs.DESCRIPTION IN ({RTP}) THEN 'RTP Planning' ELSE 'DEMAND Planning' END")
HOME = "CASE WHEN dfac.HOME_UNI_IND = 'Y' THEN 'Home' ELSE 'Other' END"


def designated(fact: str, level: str) -> str:
    ug = f"fs.DESCRIPTION = 'CSP' AND {level} = 'UG'"
    return (f"CASE WHEN fs.DESCRIPTION = 'CSP' AND {level} = 'GPG' THEN 'CSP Designated GPG' "
            f"WHEN {ug} AND {fact}.COURSE_CD IN ({MEDICAL}) THEN 'CSP Designated Medical UG' "
            f"WHEN {ug} AND {fact}.COURSE_CD IN ({SUB}) THEN 'CSP Designated Sub-bachelor UG' "
            f"WHEN {ug} AND {fact}.COURSE_CD IS NULL THEN 'CSP Undesignated bucket level UG' "
            f"WHEN {ug} AND {fact}.COURSE_CD NOT IN ({MEDICAL}, {SUB}) THEN 'CSP Undesignated course code level UG' "
            f"WHEN fs.DESCRIPTION <> 'CSP' THEN 'Non-CSP' END")


def bucket_branch(fact: str, columns: str, plan_year: str, reviewed: str, measure: str, where: str, group: str) -> str:
    commencing = columns.split(", ")[0]
    return f"""
    SELECT k.REFERENCE_YEAR AS YEAR, {FIXED} AS FIXED_BUCKET, {MODULE} AS PLANNING_MODULE, fs.DESCRIPTION AS FUND_SOURCE,
           {HOME} AS HOME_LOAD, mfac.DEGREE_FACULTY_NAME AS FACULTY, dfac.DEGREE_FACULTY_NAME AS DEGREE_FACULTY,
           k.COURSE_LEVEL, k.SCA_COORD_CAMPUS AS CAMPUS, k.UNIT_MODE,
           CASE WHEN p.COURSE_CD IS NULL THEN {BUCKET} ELSE p.COURSE_CD END AS COURSE_CD,
           CASE WHEN p.COURSE_CD IS NULL THEN {BUCKET} ELSE v.ABBREVIATION END AS COURSE_DESCRIPTION,
           CASE WHEN p.SCA_LOCATION_CD IS NULL THEN 'NA' ELSE p.SCA_LOCATION_CD END AS COURSE_LOCATION,
           {designated('p', 'k.COURSE_LEVEL')} AS DESIGNATED_IND, {plan_year} AS PLAN_YEAR, {reviewed} AS REVIEWED,
           CASE WHEN p.ind = '{commencing}' THEN 'Commencing' ELSE 'Returning' END AS COM_RET,
           sum(p.EFTSL) AS EFTSL, {measure} AS MEASURE
    FROM (UNPIVOT (SELECT * FROM {fact}) ON {columns} INTO NAME ind VALUE EFTSL) p
    LEFT JOIN key_attributes_master k ON p.KEY_ATTRIBUTES_MASTER_ID = k.KEY_ATTRIBUTES_MASTER_ID
    LEFT JOIN funding_source fs ON k.FUNDING_SOURCE = fs.FUNDING_SOURCE
    LEFT JOIN degree_faculty dfac ON k.DEGREE_FACULTY_CD = dfac.DEGREE_FACULTY_CD AND k.REFERENCE_YEAR = dfac.REFERENCE_YEAR
    LEFT JOIN degree_faculty mfac ON k.OWNING_FACULTY = mfac.DEGREE_FACULTY_CD AND k.REFERENCE_YEAR = mfac.REFERENCE_YEAR
    LEFT JOIN versions v ON p.COURSE_CD = v.COURSE_CD
    {where}
    GROUP BY k.REFERENCE_YEAR, fs.DESCRIPTION, {HOME}, mfac.DEGREE_FACULTY_NAME, dfac.DEGREE_FACULTY_NAME,
             k.COURSE_LEVEL, k.SCA_COORD_CAMPUS, k.UNIT_MODE, p.COURSE_CD, v.ABBREVIATION, p.SCA_LOCATION_CD, {group}p.ind"""


def actual_branch(plan_year: int, snapshot: str, measure: str, hidden: str = "", degree_year: str = "") -> str:
    return f"""
    SELECT u.REFERENCE_YEAR AS YEAR, {FIXED} AS FIXED_BUCKET, {MODULE} AS PLANNING_MODULE,
           coalesce(fs.DESCRIPTION, 'UNCLASSIFIED') AS FUND_SOURCE, {HOME} AS HOME_LOAD,
           mfac.DEGREE_FACULTY_NAME AS FACULTY, dfac.DEGREE_FACULTY_NAME AS DEGREE_FACULTY, u.COURSE_LEVEL,
           u.SCA_COORD_CAMPUS AS CAMPUS, u.UNIT_MODE, u.COURSE_CD, v.ABBREVIATION AS COURSE_DESCRIPTION,
           coalesce(u.SCA_LOCATION_CD, 'NA') AS COURSE_LOCATION, {designated('u', 'u.COURSE_LEVEL')} AS DESIGNATED_IND,
           '{plan_year}' AS PLAN_YEAR, 'Actuals' AS REVIEWED,
           CASE u.COMMENCING_STUDENT_IND WHEN 'Y' THEN 'Commencing' WHEN 'N' THEN 'Returning' END AS COM_RET,
           sum(u.EFTSL) AS EFTSL, {measure} AS MEASURE
    FROM unit_load u LEFT JOIN funding_source fs ON u.FUNDING_SOURCE = fs.FUNDING_SOURCE
    LEFT JOIN degree_faculty dfac ON u.DEGREE_FACULTY_ID = dfac.DEGREE_FACULTY_ID
      AND u.REFERENCE_YEAR = {degree_year or 'u.REFERENCE_YEAR'}
    LEFT JOIN degree_faculty mfac ON u.FACULTY_ID = mfac.DEGREE_FACULTY_ID AND u.REFERENCE_YEAR = mfac.REFERENCE_YEAR
    LEFT JOIN versions v ON u.COURSE_CD = v.COURSE_CD
    WHERE u.SNAPSHOT_ID = {snapshot}
    GROUP BY u.REFERENCE_YEAR, fs.DESCRIPTION, {HOME}, mfac.DEGREE_FACULTY_NAME, dfac.DEGREE_FACULTY_NAME,
             u.COURSE_LEVEL, u.SCA_COORD_CAMPUS, u.UNIT_MODE, u.COURSE_CD, v.ABBREVIATION, u.SCA_LOCATION_CD, {hidden}
             u.COMMENCING_STUDENT_IND"""


def latest(year: int) -> str:
    return (f"(SELECT c.SNAPSHOT_ID FROM aggregation_control c JOIN (SELECT REFERENCE_YEAR, max(SNAPSHOT_DATE) AS d "
            f"FROM aggregation_control GROUP BY REFERENCE_YEAR) m ON c.REFERENCE_YEAR = m.REFERENCE_YEAR "
            f"AND c.SNAPSHOT_DATE = m.d WHERE c.REFERENCE_YEAR = {year})")


PIT = "(SELECT min(SNAPSHOT_ID) FROM aggregation_control WHERE strftime(SNAPSHOT_DATE, '%d%m') = '0106' AND REFERENCE_YEAR = 1997)"


def band(prefix: str) -> str:
    level = "u.NOMINATED_YEAR_LEVEL"
    return (f"CASE WHEN {level} = 1 OR {level} IS NULL THEN '{prefix}1' WHEN {level} = 2 THEN '{prefix}2' "
            f"WHEN {level} = 3 THEN '{prefix}3' WHEN {level} = 4 THEN '{prefix}4' WHEN {level} >= 5 THEN '{prefix}5+' END")


def planned_sql(exact: bool = False) -> str:
    """The eleven branches, joined left to right by the same set operators."""
    year = "dfac.REFERENCE_YEAR" if exact else ""
    plan = ("plan_details", "COMMENCING_LOAD, RETURNING_LOAD", "p.PLAN_YEAR", "p.REVIEWED")
    plan_measure = ("CASE CAST(p.PLAN_YEAR AS INTEGER) WHEN 1999 THEN 'Plan Year 1' WHEN 2000 THEN 'Plan Year 2' "
                    "WHEN 2001 THEN 'Plan Year 3' WHEN 2002 THEN 'Plan Year 4' WHEN 2003 THEN 'Plan Year 5' END")
    group = "p.PLAN_YEAR, p.REVIEWED, "
    bucket = "WHERE k.REFERENCE_YEAR = 1997 AND CAST(p.PLAN_YEAR AS INTEGER)"
    level = "u.NOMINATED_YEAR_LEVEL,"
    chain = [
        ("", bucket_branch(*plan, plan_measure, f"{bucket} BETWEEN 1998 AND 2002", group)),
        ("UNION", bucket_branch(*plan, "'Previous plan for current year'", f"{bucket} = 1998", group)),
        ("UNION ALL", actual_branch(1998, latest(1998), "'Current Actual Latest'", degree_year=year)),
        ("UNION ALL", actual_branch(1997, latest(1997), "'Previous year actual latest'", degree_year=year)),
        ("UNION ALL", actual_branch(1996, latest(1996), "'2 year previous actual latest'", degree_year=year)),
        ("UNION ALL", actual_branch(1995, latest(1995), "'3 year previous actual latest'", degree_year=year)),
        ("UNION ALL", actual_branch(1997, PIT, "'Last year PIT actuals'", degree_year=year)),
        ("UNION", bucket_branch("plan_forecast", "COMMENCING_FORECAST_LOAD, RETURNING_FORECAST_LOAD", "'1998'",
                                "'Planning Forecast'", "'Planning Forecast'", "", "")),
        ("UNION", f"""
    SELECT f.REFERENCE_YEAR AS YEAR, {FIXED}, {MODULE}, fs.DESCRIPTION, {HOME}, mfac.DEGREE_FACULTY_NAME,
           dfac.DEGREE_FACULTY_NAME, f.COURSE_LEVEL, f.SCA_COORD_CAMPUS, f.UNIT_MODE, {BUCKET}, {BUCKET}, 'NA',
           CASE WHEN fs.DESCRIPTION = 'CSP' AND f.COURSE_LEVEL = 'GPG' THEN 'CSP Designated GPG'
                WHEN fs.DESCRIPTION = 'CSP' AND f.COURSE_LEVEL = 'UG' THEN 'CSP Undesignated bucket level UG'
                WHEN fs.DESCRIPTION <> 'CSP' THEN 'Non-CSP' END, '1998', 'Monitoring Forecast',
           CASE f.COMMENCING_STUDENT_IND WHEN 'Y' THEN 'Commencing' WHEN 'N' THEN 'Returning' END,
           sum(f.REPORTED_FORECAST_LOAD), 'Monitoring Forecast'
    FROM forecast_load f LEFT JOIN funding_source fs ON f.FUNDING_SOURCE = fs.FUNDING_SOURCE
    LEFT JOIN degree_faculty dfac ON f.DEGREE_FACULTY_ID = dfac.DEGREE_FACULTY_ID AND f.REFERENCE_YEAR = dfac.REFERENCE_YEAR
    LEFT JOIN degree_faculty mfac ON f.FACULTY_ID = mfac.DEGREE_FACULTY_ID AND f.REFERENCE_YEAR = mfac.REFERENCE_YEAR
    WHERE f.FORECAST_CONTROL_ID = (SELECT max(FORECAST_CONTROL_ID) FROM forecast_control)
    GROUP BY f.REFERENCE_YEAR, fs.DESCRIPTION, {HOME}, mfac.DEGREE_FACULTY_NAME, dfac.DEGREE_FACULTY_NAME, f.COURSE_LEVEL,
             f.SCA_COORD_CAMPUS, f.UNIT_MODE, f.COMMENCING_STUDENT_IND"""),
        ("UNION ALL", actual_branch(1998, latest(1998), band("CURRENT_YEAR_YEAR_"), level, year)),
        ("UNION", actual_branch(1998 - 1, latest(1997), band("PREVIOUS_YEAR_YEAR_"), level, year)),
    ]
    if exact:  # all rows of all branches, summed over what is shown
        rows = "\nUNION ALL\n".join(text for _, text in chain)
        return f"SELECT * EXCLUDE (EFTSL), sum(EFTSL) AS EFTSL FROM ({rows}) GROUP BY ALL"
    return "\n".join(f"{op}\n{text}" for op, text in chain)


VERSIONS = """
    SELECT DISTINCT cv.COURSE_CD, cv.ABBREVIATION FROM course_version cv
    JOIN (SELECT COURSE_CD, max(VERSION_NUMBER) AS VERSION_NUMBER FROM course_version
          WHERE START_DT <= DATE '2003-01-01' GROUP BY COURSE_CD) m
      ON cv.COURSE_CD = m.COURSE_CD AND cv.VERSION_NUMBER = m.VERSION_NUMBER"""

IDS = ", ".join(C.TEMPLATE_IDS)


def _cells() -> str:
    names = [*C.TEMPLATE_MEASURES[:-1], "Planning Forecast", "Monitoring Forecast", "NA"]
    return ", ".join(f"coalesce(max(CASE WHEN m = '{n}' THEN load END), 0) AS \"{n}\"" for n in names)


def _nonzero() -> str:
    names = [*C.TEMPLATE_MEASURES[:-1], "Planning Forecast", "Monitoring Forecast", "NA"]
    return " OR ".join(f'"{n}" <> 0' for n in names)


def _sums() -> str:
    return ", ".join(f'sum("{n}") AS "{n}"' for n in C.TEMPLATE_MEASURES)


MEASURES = ", ".join(f'"{n}"' for n in C.TEMPLATE_MEASURES)
OTHER_IDS = ", ".join(c for c in C.TEMPLATE_IDS if c != "UNIT_MODE")
ROLLUP_IDS = ", ".join(c for c in C.TEMPLATE_IDS if c not in ("COURSE_CD", "COURSE_DESCRIPTION"))

EXTRA = {
    "versions": VERSIONS,
    "planned": planned_sql(),
    "planned_by_band": planned_sql(exact=True),
    "template": f"""
    SELECT {IDS}, {", ".join(f'"{n}"' for n in C.TEMPLATE_MEASURES[:-1])}, "Plan Year 4" AS "Plan Year 5"
    FROM (SELECT {IDS}, {_cells()} FROM (
            SELECT coalesce(FUND_SOURCE, 'UNCLASSIFIED') AS FUND_SOURCE, {", ".join(C.TEMPLATE_IDS[1:-1])},
                   coalesce(DESIGNATED_IND, 'Non-CSP') AS DESIGNATED_IND, coalesce(MEASURE, 'NA') AS m,
                   CASE WHEN count(EFTSL) = count(*) THEN sum(EFTSL) END AS load
            FROM planned GROUP BY ALL) GROUP BY {IDS})
    WHERE {_nonzero()}""",
    "template_totals": f"""
    SELECT {IDS}, {MEASURES} FROM template
    UNION
    SELECT {", ".join("'TOTAL'" if c == "UNIT_MODE" else c for c in C.TEMPLATE_IDS)}, {_sums()}
    FROM template GROUP BY {OTHER_IDS}""",
    "template_rollup": f"""
    SELECT {IDS}, {MEASURES} FROM template_totals
    WHERE NOT (COURSE_LEVEL = 'HDR' AND COURSE_CD = {BUCKET})
    UNION
    SELECT {", ".join(BUCKET if c in ("COURSE_CD", "COURSE_DESCRIPTION") else c for c in C.TEMPLATE_IDS)}, {_sums()}
    FROM template_totals WHERE COURSE_LEVEL = 'HDR' GROUP BY {ROLLUP_IDS}""",
}

_WIDE = f"SELECT {IDS}, " + ", ".join(f'CAST("{n}" AS DOUBLE) AS "{n}"' for n in C.TEMPLATE_MEASURES) + " FROM {0}"
_LONG = "SELECT * REPLACE (CAST(EFTSL AS DOUBLE) AS EFTSL) FROM {0}"

QUERIES = {
    "q1_planned_load": (planned_load, with_ctes(_LONG.format("planned"), EXTRA)),
    "q1_planned_load_exact": (planned_load_exact, with_ctes(_LONG.format("planned_by_band"), EXTRA)),
    "q2_template": (template, with_ctes(_WIDE.format("template"), EXTRA)),
    "q3_totals": (totals, with_ctes(_WIDE.format("template_totals"), EXTRA)),
    "q4_rollup": (rollup, with_ctes(_WIDE.format("template_rollup"), EXTRA)),
}
