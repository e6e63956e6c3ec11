"""The definitions of `standin`, in SQL for the oracle."""

from __future__ import annotations

import re

FUND = ("CASE {0} WHEN 'AUTOMOBILE' THEN 'CSP' WHEN 'BUILDING' THEN 'RESEARCH TRAINING PROGRAM - DOMESTIC' "
        "WHEN 'FURNITURE' THEN 'INTERNATIONAL: OFFSHORE PARTNERS' "
        "WHEN 'HOUSEHOLD' THEN 'INTERNATIONAL: AUSTRALIA' END")
FLAG = "CASE {0} WHEN 'F' THEN 'Y' WHEN 'O' THEN 'N' END"
LEVEL = "CASE {0} % 5 WHEN 0 THEN 'UG' WHEN 1 THEN 'GPG' WHEN 2 THEN 'HDR' WHEN 3 THEN 'UG' WHEN 4 THEN 'PG' END"
CAMPUS = "CASE {0} % 3 WHEN 0 THEN 'A' WHEN 1 THEN 'N' WHEN 2 THEN 'R' END"
BRAND = "nullif('Brand#' || CAST(1 + {0} % 25 AS VARCHAR), 'Brand#11')"
RUN_ID = "CAST((10 - abs(year({0}) - 1998)) * 1000 + CASE WHEN year({0}) > 1998 THEN 100 ELSE 0 END + month({0}) AS BIGINT)"
DEC = "CAST({0} AS DECIMAL(18,4))"

_ACCURACY_FORECAST = f"""
    SELECT YEAR AS REFERENCE_YEAR, FACULTY, DEGREE_FACULTY, FACULTY_CODE AS TEACHING_FACULTY,
           'Faculty of ' || FACULTY_CODE AS TEACHING_FACULTY_DESCRIPTION, DEPARTMENT_CODE AS TR_ORG_UNIT_CD,
           'Dept ' || DEPARTMENT_CODE AS TR_ORG_UNIT_CD_DESCRIPTION, COURSE_LEVEL,
           CAMPUS_NAME AS SCA_COORD_CAMPUS, UNIT_MODE, FUND AS FUND_SOURCE_DESCRIPTION,
           {FLAG.format('o_orderstatus')} AS COMMENCING_STUDENT_IND, COURSE_CD,
           {{months}} AS FCAST_MONTH,
           {DEC.format('CASE WHEN l_discount <> 0.0 THEN l_quantity * (CAST(1 AS DOUBLE) - l_discount) * CAST({factor} AS DOUBLE) END')}
             AS REPORTED_FORECAST_TAUGHT_LOAD
    FROM accuracy_rows"""

CTES: dict[str, str] = {
    "aggregation_control": """
    SELECT DISTINCT CAST(year(o_orderdate) * 100 + month(o_orderdate) * 5 % 12 AS BIGINT) AS SNAPSHOT_ID,
           CAST(year(o_orderdate) AS INTEGER) AS REFERENCE_YEAR,
           make_date(year(o_orderdate), month(o_orderdate), 1) AS SNAPSHOT_DATE
    FROM orders""",
    "forecast_control": f"""
    SELECT DISTINCT {RUN_ID.format('o_orderdate')} AS FORECAST_CONTROL_ID,
           make_date(year(o_orderdate), month(o_orderdate), 1) AS REFERENCE_YEAR_PIT_DATE
    FROM orders""",
    "degree_faculty": """
    SELECT CAST(n_nationkey AS BIGINT) AS DEGREE_FACULTY_ID, 'F' || CAST(n_nationkey AS VARCHAR) AS DEGREE_FACULTY_CD,
           CAST(y.y AS INTEGER) AS REFERENCE_YEAR, n_name AS DEGREE_FACULTY_NAME,
           CASE n_regionkey WHEN 0 THEN 'N' WHEN 1 THEN 'Y' WHEN 3 THEN 'N' WHEN 4 THEN 'Y' END AS HOME_UNI_IND
    FROM nation JOIN (SELECT unnest([1996, 1997, 1998]) AS y) y ON y.y >= CASE WHEN n_regionkey = 0 THEN 1997 ELSE 1996 END""",
    "funding_source": f"""
    SELECT DISTINCT c_mktsegment AS FUNDING_SOURCE, {FUND.format('c_mktsegment')} AS DESCRIPTION
    FROM customer WHERE c_mktsegment <> 'MACHINERY'""",
    "course_version": """
    SELECT p_brand AS COURSE_CD, p_size AS VERSION_NUMBER, make_date(1990 + p_partkey % 15, 1, 1) AS START_DT,
           p_brand || ' v' || CAST(p_size AS VARCHAR) || '-' || CAST(p_partkey % 2 AS VARCHAR) AS ABBREVIATION
    FROM part""",
    "cluster_translation": """
    SELECT DISTINCT p_partkey % 6 AS CLUSTER_TRANSLATION_ID, 'C' || CAST(p_partkey % 6 AS VARCHAR) AS CLUSTER_CD,
           'S' || CAST((p_partkey % 6) // 2 AS VARCHAR) AS CLUSTER_SUBGROUP
    FROM part WHERE p_partkey % 6 <> 5""",
    "key_attributes_master": f"""
    SELECT c_custkey AS KEY_ATTRIBUTES_MASTER_ID, CAST(1995 + c_custkey % 4 AS INTEGER) AS REFERENCE_YEAR,
           c_mktsegment AS FUNDING_SOURCE, 'F' || CAST(c_nationkey AS VARCHAR) AS DEGREE_FACULTY_CD,
           'F' || CAST(c_custkey % 25 AS VARCHAR) AS OWNING_FACULTY, {LEVEL.format('c_custkey')} AS COURSE_LEVEL,
           {CAMPUS.format('c_custkey')} AS SCA_COORD_CAMPUS,
           CASE (c_custkey // 3) % 2 WHEN 0 THEN 'F' ELSE 'O' END AS UNIT_MODE
    FROM customer""",
    "org_unit": """
    SELECT code AS ORG_UNIT_CD, CASE WHEN code LIKE 'T%' THEN 'FACULTY OF ' ELSE 'DEPT ' END || code AS DESCRIPTION,
           CASE WHEN code IN ('T3', 'D7') THEN 'INACTIVE' ELSE 'ACTIVE' END AS ORG_STATUS
    FROM (SELECT 'T' || CAST(s_suppkey % 5 AS VARCHAR) AS code FROM supplier
          UNION SELECT 'D' || CAST(s_suppkey % 10 AS VARCHAR) FROM supplier)""",
    "teaching_faculty_abbrev": """
    SELECT DISTINCT CASE WHEN s_suppkey % 5 <> 4 THEN 'FACULTY OF T' || CAST(s_suppkey % 5 AS VARCHAR) END
             AS TEACHING_FACULTY_NAME, 'AB' || CAST(s_suppkey % 5 AS VARCHAR) AS TEACHING_FAC_ABBREV
    FROM supplier""",
    "unit_load": f"""
    SELECT CAST(year(o_orderdate) * 100 + month(o_orderdate) * 5 % 12 AS BIGINT) AS SNAPSHOT_ID,
           CAST(year(o_orderdate) AS INTEGER) AS REFERENCE_YEAR, c_mktsegment AS FUNDING_SOURCE,
           CAST(c_nationkey % 5 AS BIGINT) AS DEGREE_FACULTY_ID, CAST(s_nationkey AS BIGINT) AS FACULTY_ID,
           nullif(p_brand, 'Brand#11') AS COURSE_CD,
           CASE p_type WHEN 'PROMO' THEN 'GPG' WHEN 'STANDARD' THEN 'UG' WHEN 'MEDIUM' THEN 'UG'
                       WHEN 'LARGE' THEN 'HDR' WHEN 'ECONOMY' THEN 'PG' END AS COURSE_LEVEL,
           l_returnflag AS SCA_COORD_CAMPUS, nullif(l_returnflag, 'R') AS SCA_LOCATION_CD,
           nullif(l_linestatus, 'O') AS SUA_LOCATION_CD, l_linestatus AS UNIT_MODE,
           {FLAG.format('o_orderstatus')} AS COMMENCING_STUDENT_IND,
           nullif(l_linenumber - 1, 6) AS NOMINATED_YEAR_LEVEL,
           'T' || CAST(l_suppkey % 2 AS VARCHAR) AS TEACHING_FACULTY,
           'D' || CAST(l_suppkey % 2 AS VARCHAR) AS TR_ORG_UNIT_CD, l_partkey % 6 AS CLUSTER_TRANSLATION_ID,
           {DEC.format('nullif(l_quantity, 1)')} AS EFTSL
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
    JOIN supplier ON l_suppkey = s_suppkey JOIN part ON l_partkey = p_partkey""",
    "plan_details": f"""
    SELECT o_custkey AS KEY_ATTRIBUTES_MASTER_ID, {BRAND.format('l_partkey')} AS COURSE_CD,
           nullif(l_returnflag, 'R') AS SCA_LOCATION_CD, CAST(year(l_shipdate) AS VARCHAR) AS PLAN_YEAR,
           o_orderstatus AS REVIEWED, {DEC.format('CASE WHEN l_linenumber <> 3 THEN l_extendedprice END')} AS COMMENCING_LOAD,
           {DEC.format('nullif(l_tax, 0)')} AS RETURNING_LOAD
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "plan_forecast": f"""
    SELECT o_custkey AS KEY_ATTRIBUTES_MASTER_ID, {BRAND.format('o_orderkey')} AS COURSE_CD,
           nullif(substr(o_orderpriority, 1, 1), '5') AS SCA_LOCATION_CD,
           {DEC.format("CASE WHEN o_orderstatus <> 'F' THEN o_totalprice END")} AS COMMENCING_FORECAST_LOAD,
           {DEC.format("CASE WHEN o_orderstatus <> 'O' THEN o_totalprice END")} AS RETURNING_FORECAST_LOAD
    FROM orders""",
    "forecast_load": f"""
    SELECT {RUN_ID.format('o_orderdate')} AS FORECAST_CONTROL_ID, CAST(year(o_orderdate) AS INTEGER) AS REFERENCE_YEAR,
           c_mktsegment AS FUNDING_SOURCE, CAST(c_nationkey AS BIGINT) AS DEGREE_FACULTY_ID,
           o_custkey % 25 AS FACULTY_ID, {LEVEL.format('o_orderkey')} AS COURSE_LEVEL,
           {CAMPUS.format('o_orderkey')} AS SCA_COORD_CAMPUS, substr(o_orderpriority, 1, 1) AS UNIT_MODE,
           {FLAG.format('o_orderstatus')} AS COMMENCING_STUDENT_IND, {DEC.format('o_totalprice')} AS REPORTED_FORECAST_LOAD
    FROM orders JOIN customer ON o_custkey = c_custkey""",
    "forecast_file": f"""
    SELECT TEACHING_FACULTY, TR_ORG_UNIT_CD, DEGREE_FACULTY, nullif(FUNDING_SOURCE, 'HOUSEHOLD') AS FUND_SOURCE,
           {FUND.format('FUNDING_SOURCE')} AS FUND_SOURCE_DESCRIPTION, COURSE_LEVEL, SCA_COORD_CAMPUS,
           SUA_LOCATION_CD AS SUA_LOCATION_CODE, UNIT_MODE, COMMENCING_STUDENT_IND, CLUSTER_SUBGROUP AS HOME_CLUSTER,
           '01061998' AS CURR_YR_FORECAST_DATE,
           CASE WHEN COURSE_LEVEL = 'PG' AND SCA_COORD_CAMPUS = 'A' THEN NULL
                ELSE {DEC.format('total / 4')} END AS REPORTED_FORECAST_TAUGHT_LOAD
    FROM (SELECT TEACHING_FACULTY, TR_ORG_UNIT_CD, DEGREE_FACULTY, FUNDING_SOURCE, COURSE_LEVEL, SCA_COORD_CAMPUS,
                 SUA_LOCATION_CD, UNIT_MODE, COMMENCING_STUDENT_IND, CLUSTER_SUBGROUP, sum(EFTSL) AS total
          FROM unit_load u LEFT JOIN cluster_translation c USING (CLUSTER_TRANSLATION_ID)
          LEFT JOIN (SELECT DISTINCT DEGREE_FACULTY_ID, DEGREE_FACULTY_NAME AS DEGREE_FACULTY FROM degree_faculty) d
            USING (DEGREE_FACULTY_ID)
          GROUP BY ALL)""",
    "accuracy_rows": f"""
    SELECT CAST(year(o_orderdate) AS INTEGER) AS YEAR,
           nullif('NATION_' || CAST(c_nationkey % 5 AS VARCHAR), 'NATION_4') AS FACULTY,
           'DF' || CAST(c_nationkey % 5 AS VARCHAR) AS DEGREE_FACULTY, 'T' || CAST(l_suppkey % 5 AS VARCHAR) AS FACULTY_CODE,
           nullif('D' || CAST(l_suppkey % 10 AS VARCHAR), 'D9') AS DEPARTMENT_CODE, l_returnflag AS COURSE_LEVEL,
           CASE l_linenumber WHEN 6 THEN 'MALAYSIA' WHEN 7 THEN NULL ELSE 'CITY' END AS CAMPUS_NAME,
           l_linestatus AS UNIT_MODE, {FUND.format('c_mktsegment')} AS FUND, o_orderstatus, o_orderpriority,
           'K' || CAST(l_partkey % 5 AS VARCHAR) AS COURSE_CD,
           'K' || CAST(l_partkey % 5 AS VARCHAR) || ' v' || CAST(l_partkey % 2 AS VARCHAR) AS COURSE_DESCRIPTION,
           l_quantity, l_discount
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey""",
    "actuals_extract": f"""
    SELECT YEAR, FACULTY, DEGREE_FACULTY, FACULTY_CODE AS TEACHING_FACULTY_CD,
           'FACULTY OF ' || FACULTY_CODE AS TEACHING_FACULTY_NAME, DEPARTMENT_CODE AS DEPARTMENT_CD,
           CASE DEPARTMENT_CODE WHEN 'D2' THEN 'WATER STUDIES CENTRE' WHEN 'D3' THEN 'RENAMED' WHEN 'D5' THEN 'NA'
                ELSE 'DEPT ' || DEPARTMENT_CODE END AS DEPARTMENT,
           COURSE_LEVEL, CAMPUS_NAME AS CAMPUS, UNIT_MODE, FUND AS FUND_SOURCE,
           CASE o_orderstatus WHEN 'F' THEN 'Commencing' WHEN 'O' THEN 'Returning' END AS COM_RET,
           nullif(COURSE_CD, 'K4') AS COURSE_CD, COURSE_DESCRIPTION, {DEC.format('nullif(l_quantity, 1)')} AS EFTSL
    FROM accuracy_rows""",
    "course_forecast_extract": _ACCURACY_FORECAST.format(factor="4.5", months="""CASE o_orderpriority WHEN '1-URGENT' THEN 'March'
             WHEN '2-HIGH' THEN 'June' WHEN '3-MEDIUM' THEN 'July' WHEN '4-NOT SPECIFIED' THEN 'September' END"""),
    "bucket_forecast": _ACCURACY_FORECAST.replace(" COURSE_CD,", "").format(factor="3.75", months="""CASE o_orderpriority
             WHEN '1-URGENT' THEN 'March' WHEN '2-HIGH' THEN 'March' WHEN '3-MEDIUM' THEN 'June'
             WHEN '4-NOT SPECIFIED' THEN 'September' WHEN '5-LOW' THEN 'November' END"""),
    "forecast_taught_crs_load": f"""
    SELECT l_orderkey * 10 + l_linenumber AS FORECAST_LOAD_ID, {RUN_ID.format('o_orderdate')} AS FORECAST_CONTROL_ID,
           l_partkey % 2 AS FORECAST_METHODOLOGY_ID, CAST(year(o_orderdate) AS INTEGER) AS REFERENCE_YEAR,
           'T' || CAST(l_suppkey % 5 AS VARCHAR) AS TEACHING_FACULTY, 'D' || CAST(l_suppkey % 10 AS VARCHAR) AS TR_ORG_UNIT_CD,
           o_custkey % 25 AS FACULTY_ID, CAST(c_nationkey AS BIGINT) AS DEGREE_FACULTY_ID, c_mktsegment AS FUNDING_SOURCE,
           {LEVEL.format('l_partkey')} AS COURSE_LEVEL, {BRAND.format('l_partkey')} AS COURSE_CD,
           l_returnflag AS SCA_COORD_CAMPUS, nullif(l_linestatus, 'O') AS SUA_LOCATION_CD, l_linestatus AS UNIT_MODE,
           {FLAG.format('o_orderstatus')} AS COMMENCING_STUDENT_IND, CAST(l_partkey % 6 AS VARCHAR) AS OFFICIAL_CLUSTER,
           CAST(l_partkey % 3 AS VARCHAR) AS HOME_CLUSTER, CASE l_partkey % 2 WHEN 0 THEN 'HIGH' ELSE 'LOW' END AS HIGH_LOW_COST,
           {DEC.format('l_quantity')} AS REPORTED_FORECAST_TAUGHT_LOAD
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey""",
}


def half_even(expr: str) -> str:
    """Exact half-even rounding of a DECIMAL(_,4) expression at two places, as a double."""
    units = f"CAST(({expr}) * 10000 AS BIGINT)"
    size = f"abs({units})"
    tie_down = f"CASE WHEN {size} % 100 = 50 AND ({size} // 100) % 2 = 0 THEN 1 ELSE 0 END"
    return f"(sign({units}) * (({size} + 50 - {tie_down}) // 100)) / CAST(100 AS DOUBLE)"


def with_ctes(body: str, extra: dict[str, str] | None = None) -> str:
    """`body` preceded by the definitions it needs, in order."""
    known = {**CTES, **(extra or {})}
    chosen: dict[str, str] = {}

    def need(text: str, self_name: str = "") -> None:
        for name, definition in known.items():
            if name != self_name and name not in chosen and re.search(rf"\b{name}\b", text):
                need(definition, name)
                chosen[name] = definition

    need(body)
    if not chosen:
        return body
    return "WITH " + ",\n".join(f"{n} AS ({d})" for n, d in chosen.items()) + "\n" + body
