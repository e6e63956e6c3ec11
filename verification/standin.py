"""The planning domain derived from the driver's tables.

The driver's tables hold no missing values, so the ones the null rules need are
made here, by rule, over the whole tables. `standin_sql` states the same
definitions for the oracle.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loadkit import config as C
from loadkit.plans.planning_template import PlanningTables

REF_YEAR = 1998
AS_OF = date(1998, 6, 1)

RULES = C.PlanningRules(
    medical=("Brand#1", "Brand#2", "Brand#3", "Brand#4"),
    sub_bachelor=("Brand#5", "Brand#6", "Brand#7", "Brand#8", "Brand#9", "Brand#10"),
)
DESIGNATED_FUND = "AUTOMOBILE"
SCOPE = C.Scope(excluded_campuses=("MALAYSIA", "SAFRICA"), excluded_faculties=("NATION_3",),
                outside_totals=("NATION_3", "NATION_4"))
ACCURACY_YEAR = 1998
MONTHS = ("March", "June", "July", "September")
OVERRIDES = (("D2", "WATER STUDIES CENTRE"), ("D5", "MUSIC TECHNOLOGY"), ("D5", "NA"))

FUND_NAMES = {
    "AUTOMOBILE": "CSP",
    "BUILDING": "RESEARCH TRAINING PROGRAM - DOMESTIC",
    "FURNITURE": "INTERNATIONAL: OFFSHORE PARTNERS",
    "HOUSEHOLD": "INTERNATIONAL: AUSTRALIA",
}


class Tables:
    """Readers for the driver's tables; a table's schema is looked up once."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        df = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        setattr(self, name, df)
        return df


def mapped(col: Column, pairs: dict, default: Column | None = None) -> Column:
    out = None
    for key, value in pairs.items():
        out = (F if out is None else out).when(col == key, F.lit(value))
    return out if default is None else out.otherwise(default)


def load(col: Column | str) -> Column:
    return (F.col(col) if isinstance(col, str) else col).cast("decimal(18,4)")


def fund_name(segment: Column) -> Column:
    return mapped(segment, FUND_NAMES)


def student_flag(status: Column) -> Column:
    return mapped(status, {"F": "Y", "O": "N"})


def brand(number: Column) -> Column:
    code = F.concat(F.lit("Brand#"), (number % 25 + 1).cast("string"))
    return F.nullif(code, F.lit("Brand#11"))


def level_of(number: Column) -> Column:
    return mapped(number % 5, {0: "UG", 1: "GPG", 2: "HDR", 3: "UG", 4: "PG"})


def campus_of(number: Column) -> Column:
    return mapped(number % 3, {0: "A", 1: "N", 2: "R"})


# --- catalogues and dimensions -----------------------------------------------

def aggregation_control(t: Tables) -> DataFrame:
    """One snapshot per month; the id order differs from the date order."""
    months = t.orders.select(F.year("o_orderdate").alias("y"), F.month("o_orderdate").alias("m")).distinct()
    return months.select((F.col("y") * 100 + F.col("m") * 5 % 12).cast("long").alias("SNAPSHOT_ID"),
                         F.col("y").alias("REFERENCE_YEAR"),
                         F.make_date("y", "m", F.lit(1)).alias("SNAPSHOT_DATE"))


def run_id(when: Column) -> Column:
    """Runs are numbered so that the nearer a year is to the reference year, the greater; the latest is in that year."""
    year = F.year(when)
    return ((F.lit(10) - F.abs(year - REF_YEAR)) * 1000 + F.when(year > REF_YEAR, 100).otherwise(0) + F.month(when)).cast("long")


def forecast_control(t: Tables) -> DataFrame:
    """One forecast run per month of the orders."""
    day = F.col("o_orderdate")
    return t.orders.select(run_id(day).alias("FORECAST_CONTROL_ID"),
                           F.make_date(F.year(day), F.month(day), F.lit(1)).alias("REFERENCE_YEAR_PIT_DATE")).distinct()


def degree_faculty(t: Tables) -> DataFrame:
    """Faculties for two or three years each, so that an id repeats and some years are missing."""
    first = F.when(F.col("n_regionkey") == 0, 1997).otherwise(1996)
    return t.nation.select(
        F.col("n_nationkey").cast("long").alias("DEGREE_FACULTY_ID"),
        F.concat(F.lit("F"), F.col("n_nationkey").cast("string")).alias("DEGREE_FACULTY_CD"),
        F.explode(F.sequence(first, F.lit(REF_YEAR))).alias("REFERENCE_YEAR"),
        F.col("n_name").alias("DEGREE_FACULTY_NAME"),
        mapped(F.col("n_regionkey"), {0: "N", 1: "Y", 3: "N", 4: "Y"}).alias("HOME_UNI_IND"))


def funding_source(t: Tables) -> DataFrame:
    segments = t.customer.select("c_mktsegment").distinct().where("c_mktsegment <> 'MACHINERY'")
    return segments.select(F.col("c_mktsegment").alias("FUNDING_SOURCE"),
                           fund_name(F.col("c_mktsegment")).alias("DESCRIPTION"))


def course_version(t: Tables) -> DataFrame:
    """Several rows per version, with two abbreviations and different start dates."""
    return t.part.select(
        F.col("p_brand").alias("COURSE_CD"), F.col("p_size").alias("VERSION_NUMBER"),
        F.make_date((F.lit(1990) + F.col("p_partkey") % 15).cast("int"), F.lit(1), F.lit(1)).alias("START_DT"),
        F.concat(F.col("p_brand"), F.lit(" v"), F.col("p_size").cast("string"), F.lit("-"),
                 (F.col("p_partkey") % 2).cast("string")).alias("ABBREVIATION"))


def cluster_translation(t: Tables) -> DataFrame:
    """Two codes per subgroup; one id is not translated."""
    ids = t.part.select((F.col("p_partkey") % 6).alias("i")).distinct().where("i <> 5")
    return ids.select(F.col("i").alias("CLUSTER_TRANSLATION_ID"),
                      F.concat(F.lit("C"), F.col("i").cast("string")).alias("CLUSTER_CD"),
                      F.concat(F.lit("S"), F.floor(F.col("i") / 2).cast("string")).alias("CLUSTER_SUBGROUP"))


def key_attributes_master(t: Tables) -> DataFrame:
    k = F.col("c_custkey")
    return t.customer.select(
        k.alias("KEY_ATTRIBUTES_MASTER_ID"), (F.lit(1995) + k % 4).cast("int").alias("REFERENCE_YEAR"),
        F.col("c_mktsegment").alias("FUNDING_SOURCE"),
        F.concat(F.lit("F"), F.col("c_nationkey").cast("string")).alias("DEGREE_FACULTY_CD"),
        F.concat(F.lit("F"), (k % 25).cast("string")).alias("OWNING_FACULTY"),
        level_of(k).alias("COURSE_LEVEL"), campus_of(k).alias("SCA_COORD_CAMPUS"),
        mapped(F.floor(k / 3) % 2, {0: "F", 1: "O"}).alias("UNIT_MODE"))


def org_unit(t: Tables) -> DataFrame:
    """Teaching faculties T0-T4 and departments D0-D9; T3 and D7 are not active."""
    number = F.col("s_suppkey")
    faculty = F.concat(F.lit("T"), (number % 5).cast("string"))
    department = F.concat(F.lit("D"), (number % 10).cast("string"))
    units = t.supplier.select(F.explode(F.array(faculty, department)).alias("ORG_UNIT_CD")).distinct()
    code = F.col("ORG_UNIT_CD")
    return units.select(
        code, F.concat(F.when(code.startswith("T"), "FACULTY OF ").otherwise("DEPT "), code).alias("DESCRIPTION"),
        F.when(code.isin("T3", "D7"), "INACTIVE").otherwise("ACTIVE").alias("ORG_STATUS"))


def teaching_faculty_abbrev(t: Tables) -> DataFrame:
    """Short names per faculty name, one of them for the missing name."""
    names = t.supplier.select((F.col("s_suppkey") % 5).alias("i")).distinct()
    return names.select(
        F.when(F.col("i") != 4, F.concat(F.lit("FACULTY OF T"), F.col("i").cast("string")))
        .alias("TEACHING_FACULTY_NAME"),
        F.concat(F.lit("AB"), F.col("i").cast("string")).alias("TEACHING_FAC_ABBREV"))


# --- facts -------------------------------------------------------------------

def order_lines(t: Tables) -> DataFrame:
    return t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))


def unit_load(t: Tables) -> DataFrame:
    """Actual load: one row per order line, a snapshot per month."""
    star = (order_lines(t).join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
            .join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey"))
            .join(t.part, F.col("l_partkey") == F.col("p_partkey")))
    day = F.col("o_orderdate")
    return star.select(
        (F.year(day) * 100 + F.month(day) * 5 % 12).cast("long").alias("SNAPSHOT_ID"),
        F.year(day).alias("REFERENCE_YEAR"),
        F.col("c_mktsegment").alias("FUNDING_SOURCE"),
        (F.col("c_nationkey") % 5).cast("long").alias("DEGREE_FACULTY_ID"),
        F.col("s_nationkey").cast("long").alias("FACULTY_ID"),
        F.nullif(F.col("p_brand"), F.lit("Brand#11")).alias("COURSE_CD"),
        mapped(F.col("p_type"), {"PROMO": "GPG", "STANDARD": "UG", "MEDIUM": "UG", "LARGE": "HDR",
                                 "ECONOMY": "PG"}).alias("COURSE_LEVEL"),
        F.col("l_returnflag").alias("SCA_COORD_CAMPUS"),
        F.nullif(F.col("l_returnflag"), F.lit("R")).alias("SCA_LOCATION_CD"),
        F.nullif(F.col("l_linestatus"), F.lit("O")).alias("SUA_LOCATION_CD"),
        F.col("l_linestatus").alias("UNIT_MODE"),
        student_flag(F.col("o_orderstatus")).alias("COMMENCING_STUDENT_IND"),
        F.nullif(F.col("l_linenumber") - 1, F.lit(6)).alias("NOMINATED_YEAR_LEVEL"),
        F.concat(F.lit("T"), (F.col("l_suppkey") % 2).cast("string")).alias("TEACHING_FACULTY"),
        F.concat(F.lit("D"), (F.col("l_suppkey") % 2).cast("string")).alias("TR_ORG_UNIT_CD"),
        (F.col("l_partkey") % 6).alias("CLUSTER_TRANSLATION_ID"),
        load(F.nullif(F.col("l_quantity"), F.lit(1.0))).alias("EFTSL"))


def plan_details(t: Tables) -> DataFrame:
    return order_lines(t).select(
        F.col("o_custkey").alias("KEY_ATTRIBUTES_MASTER_ID"), brand(F.col("l_partkey")).alias("COURSE_CD"),
        F.nullif(F.col("l_returnflag"), F.lit("R")).alias("SCA_LOCATION_CD"),
        F.year("l_shipdate").cast("string").alias("PLAN_YEAR"), F.col("o_orderstatus").alias("REVIEWED"),
        load(F.when(F.col("l_linenumber") != 3, F.col("l_extendedprice"))).alias("COMMENCING_LOAD"),
        load(F.nullif(F.col("l_tax"), F.lit(0.0))).alias("RETURNING_LOAD"))


def plan_forecast(t: Tables) -> DataFrame:
    price, status = F.col("o_totalprice"), F.col("o_orderstatus")
    return t.orders.select(
        F.col("o_custkey").alias("KEY_ATTRIBUTES_MASTER_ID"), brand(F.col("o_orderkey")).alias("COURSE_CD"),
        F.nullif(F.substring("o_orderpriority", 1, 1), F.lit("5")).alias("SCA_LOCATION_CD"),
        load(F.when(status != "F", price)).alias("COMMENCING_FORECAST_LOAD"),
        load(F.when(status != "O", price)).alias("RETURNING_FORECAST_LOAD"))


def forecast_load(t: Tables) -> DataFrame:
    key = F.col("o_orderkey")
    rows = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    return rows.select(
        run_id(F.col("o_orderdate")).alias("FORECAST_CONTROL_ID"),
        F.year("o_orderdate").alias("REFERENCE_YEAR"), F.col("c_mktsegment").alias("FUNDING_SOURCE"),
        F.col("c_nationkey").cast("long").alias("DEGREE_FACULTY_ID"),
        (F.col("o_custkey") % 25).cast("long").alias("FACULTY_ID"), level_of(key).alias("COURSE_LEVEL"),
        campus_of(key).alias("SCA_COORD_CAMPUS"), F.substring("o_orderpriority", 1, 1).alias("UNIT_MODE"),
        student_flag(F.col("o_orderstatus")).alias("COMMENCING_STUDENT_IND"),
        load("o_totalprice").alias("REPORTED_FORECAST_LOAD"))


def planning_tables(t: Tables) -> PlanningTables:
    return PlanningTables(
        plan_details=plan_details(t), plan_forecast=plan_forecast(t), unit_load=unit_load(t),
        forecast_load=forecast_load(t), key_attributes_master=key_attributes_master(t),
        degree_faculty=degree_faculty(t), funding_source=funding_source(t),
        course_version=course_version(t), aggregation_control=aggregation_control(t),
        forecast_control=forecast_control(t))


def forecast_file(t: Tables) -> DataFrame:
    """The forecast to split: a quarter of all load per key, missing for one level and campus."""
    u = unit_load(t).join(cluster_translation(t), ["CLUSTER_TRANSLATION_ID"], "left")
    names = degree_faculty(t).select(F.col("DEGREE_FACULTY_ID"), F.col("DEGREE_FACULTY_NAME")
                                     .alias("DEGREE_FACULTY")).distinct()
    u = u.join(names, ["DEGREE_FACULTY_ID"], "left")
    keys = ["TEACHING_FACULTY", "TR_ORG_UNIT_CD", "DEGREE_FACULTY", "FUNDING_SOURCE", "COURSE_LEVEL",
            "SCA_COORD_CAMPUS", "SUA_LOCATION_CD", "UNIT_MODE", "COMMENCING_STUDENT_IND", "CLUSTER_SUBGROUP"]
    total = u.groupBy(*keys).agg((F.sum("EFTSL") / F.lit(4)).alias("total"))
    blank = F.coalesce((F.col("COURSE_LEVEL") == "PG") & (F.col("SCA_COORD_CAMPUS") == "A"), F.lit(False))
    return total.select(
        "TEACHING_FACULTY", "TR_ORG_UNIT_CD", "DEGREE_FACULTY",
        F.nullif(F.col("FUNDING_SOURCE"), F.lit("HOUSEHOLD")).alias("FUND_SOURCE"),
        fund_name(F.col("FUNDING_SOURCE")).alias("FUND_SOURCE_DESCRIPTION"), "COURSE_LEVEL", "SCA_COORD_CAMPUS",
        F.col("SUA_LOCATION_CD").alias("SUA_LOCATION_CODE"), "UNIT_MODE", "COMMENCING_STUDENT_IND",
        F.col("CLUSTER_SUBGROUP").alias("HOME_CLUSTER"), F.lit("01061998").alias("CURR_YR_FORECAST_DATE"),
        load(F.when(~blank, F.col("total"))).alias("REPORTED_FORECAST_TAUGHT_LOAD"))


def accuracy_rows(t: Tables) -> DataFrame:
    """Order lines with the columns that the accuracy extracts share."""
    lines = order_lines(t).join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    unit, nation = F.col("l_suppkey"), F.col("c_nationkey") % 5
    course = F.concat(F.lit("K"), (F.col("l_partkey") % 5).cast("string"))
    return lines.select(
        F.year("o_orderdate").alias("YEAR"),
        F.nullif(F.concat(F.lit("NATION_"), nation.cast("string")), F.lit("NATION_4")).alias("FACULTY"),
        F.concat(F.lit("DF"), nation.cast("string")).alias("DEGREE_FACULTY"),
        F.concat(F.lit("T"), (unit % 5).cast("string")).alias("FACULTY_CODE"),
        F.nullif(F.concat(F.lit("D"), (unit % 10).cast("string")), F.lit("D9")).alias("DEPARTMENT_CODE"),
        F.col("l_returnflag").alias("COURSE_LEVEL"),
        mapped(F.col("l_linenumber"), {6: "MALAYSIA", 7: None}, F.lit("CITY")).alias("CAMPUS_NAME"),
        F.col("l_linestatus").alias("UNIT_MODE"), fund_name(F.col("c_mktsegment")).alias("FUND"),
        F.col("o_orderstatus"), F.col("o_orderpriority"), course.alias("COURSE_CD"),
        F.concat(course, F.lit(" v"), (F.col("l_partkey") % 2).cast("string")).alias("COURSE_DESCRIPTION"),
        F.col("l_quantity"), F.col("l_discount"))


def actuals_extract(t: Tables) -> DataFrame:
    """Actual load; one department has another name and one course no code, so some forecasts stay alone."""
    return accuracy_rows(t).select(
        "YEAR", "FACULTY", "DEGREE_FACULTY", F.col("FACULTY_CODE").alias("TEACHING_FACULTY_CD"),
        F.concat(F.lit("FACULTY OF "), F.col("FACULTY_CODE")).alias("TEACHING_FACULTY_NAME"),
        F.col("DEPARTMENT_CODE").alias("DEPARTMENT_CD"),
        mapped(F.col("DEPARTMENT_CODE"), {"D2": "WATER STUDIES CENTRE", "D3": "RENAMED", "D5": "NA"},
               F.concat(F.lit("DEPT "), F.col("DEPARTMENT_CODE"))).alias("DEPARTMENT"),
        "COURSE_LEVEL", F.col("CAMPUS_NAME").alias("CAMPUS"), "UNIT_MODE", F.col("FUND").alias("FUND_SOURCE"),
        mapped(F.col("o_orderstatus"), {"F": "Commencing", "O": "Returning"}).alias("COM_RET"),
        F.nullif(F.col("COURSE_CD"), F.lit("K4")).alias("COURSE_CD"), "COURSE_DESCRIPTION",
        load(F.nullif(F.col("l_quantity"), F.lit(1.0))).alias("EFTSL"))


def _forecast_extract(t: Tables, months: dict[str, str | None], factor: float, columns: list[str]) -> DataFrame:
    rows = accuracy_rows(t).select(
        F.col("YEAR").alias("REFERENCE_YEAR"), "FACULTY", "DEGREE_FACULTY",
        F.col("FACULTY_CODE").alias("TEACHING_FACULTY"),
        F.concat(F.lit("Faculty of "), F.col("FACULTY_CODE")).alias("TEACHING_FACULTY_DESCRIPTION"),
        F.col("DEPARTMENT_CODE").alias("TR_ORG_UNIT_CD"),
        F.concat(F.lit("Dept "), F.col("DEPARTMENT_CODE")).alias("TR_ORG_UNIT_CD_DESCRIPTION"),
        "COURSE_LEVEL", F.col("CAMPUS_NAME").alias("SCA_COORD_CAMPUS"), "UNIT_MODE",
        F.col("FUND").alias("FUND_SOURCE_DESCRIPTION"),
        student_flag(F.col("o_orderstatus")).alias("COMMENCING_STUDENT_IND"), "COURSE_CD",
        mapped(F.col("o_orderpriority"), months).alias("FCAST_MONTH"),
        load(F.when(F.col("l_discount") != 0.0,
                    F.col("l_quantity") * (F.lit(1.0) - F.col("l_discount")) * F.lit(factor)))
        .alias("REPORTED_FORECAST_TAUGHT_LOAD"))
    return rows.select(*columns)


COURSE_MONTHS = {"1-URGENT": "March", "2-HIGH": "June", "3-MEDIUM": "July", "4-NOT SPECIFIED": "September",
                 "5-LOW": None}
BUCKET_MONTHS = {"1-URGENT": "March", "2-HIGH": "March", "3-MEDIUM": "June", "4-NOT SPECIFIED": "September",
                 "5-LOW": "November"}
_BUCKET_COLUMNS = ["REFERENCE_YEAR", "FACULTY", "DEGREE_FACULTY", "TEACHING_FACULTY",
                   "TEACHING_FACULTY_DESCRIPTION", "TR_ORG_UNIT_CD", "TR_ORG_UNIT_CD_DESCRIPTION", "COURSE_LEVEL",
                   "SCA_COORD_CAMPUS", "UNIT_MODE", "FUND_SOURCE_DESCRIPTION", "COMMENCING_STUDENT_IND",
                   "FCAST_MONTH", "REPORTED_FORECAST_TAUGHT_LOAD"]


def course_forecast_extract(t: Tables) -> DataFrame:
    return _forecast_extract(t, COURSE_MONTHS, 4.5, [*_BUCKET_COLUMNS[:-2], "COURSE_CD", *_BUCKET_COLUMNS[-2:]])


def bucket_forecast(t: Tables) -> DataFrame:
    return _forecast_extract(t, BUCKET_MONTHS, 3.75, _BUCKET_COLUMNS)


def forecast_taught_crs_load(t: Tables) -> DataFrame:
    rows = order_lines(t).join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    unit = F.col("l_suppkey")
    return rows.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("FORECAST_LOAD_ID"),
        run_id(F.col("o_orderdate")).alias("FORECAST_CONTROL_ID"),
        (F.col("l_partkey") % 2).alias("FORECAST_METHODOLOGY_ID"), F.year("o_orderdate").alias("REFERENCE_YEAR"),
        F.concat(F.lit("T"), (unit % 5).cast("string")).alias("TEACHING_FACULTY"),
        F.concat(F.lit("D"), (unit % 10).cast("string")).alias("TR_ORG_UNIT_CD"),
        (F.col("o_custkey") % 25).cast("long").alias("FACULTY_ID"),
        F.col("c_nationkey").cast("long").alias("DEGREE_FACULTY_ID"), F.col("c_mktsegment").alias("FUNDING_SOURCE"),
        level_of(F.col("l_partkey")).alias("COURSE_LEVEL"), brand(F.col("l_partkey")).alias("COURSE_CD"),
        F.col("l_returnflag").alias("SCA_COORD_CAMPUS"),
        F.nullif(F.col("l_linestatus"), F.lit("O")).alias("SUA_LOCATION_CD"), F.col("l_linestatus").alias("UNIT_MODE"),
        student_flag(F.col("o_orderstatus")).alias("COMMENCING_STUDENT_IND"),
        (F.col("l_partkey") % 6).cast("string").alias("OFFICIAL_CLUSTER"),
        (F.col("l_partkey") % 3).cast("string").alias("HOME_CLUSTER"),
        mapped(F.col("l_partkey") % 2, {0: "HIGH", 1: "LOW"}).alias("HIGH_LOW_COST"),
        load("l_quantity").alias("REPORTED_FORECAST_TAUGHT_LOAD"))


# Four months of 1997 and four of 1998.
COURSE_RUNS = (9001, 9003, 9006, 9009, 10003, 10006, 10009, 10011)
