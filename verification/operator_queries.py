"""One query per operator on the driver's tables, each with oracle SQL.

Missing values are made by rule (`nullif`) on both sides, because the driver's
tables have none.
"""

from __future__ import annotations

import uuid
from datetime import date
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loadkit import config as C
from loadkit.functions import (
    abbreviate, cap, classify, if_else3, not_in, not_infinite, override, paste, pct, remainder,
    safe_ratio, signed_error, upper_all)
from loadkit.functions import rules as R
from loadkit.operators import (
    add_total_member, align_by_slice, bind_tagged, conservation_check, group_checks, latest_by_date,
    latest_by_id, latest_run, latest_version, left_lookup, natural_join, null_safe_join, pivot_fixed,
    point_in_time, reconcile, rollup_into, row_checks, sum_by, sum_numeric, union_distinct,
    unpivot_drop_null)
from loadkit.plans.forecast_accuracy import month_order
from loadkit.schema import decimals_to_double, sum_load
from loadkit.sources import read_inferred, register_views, run_sql_file
from loadkit.sources.staging import shared_folder
from verification import standin as S
from verification.standin import Tables, load, mapped
from verification.standin_sql import DEC, FUND, half_even, with_ctes

D = DEC.format
QUERIES: dict = {}


def register(name: str, sql: str | None, extra: dict[str, str] | None = None):
    """Add a query that takes the tables; decimals leave as doubles."""
    def wrap(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return decimals_to_double(fn(Tables(spark, sf_dir)))
        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = (run, None if sql is None else with_ctes(sql, extra))
        return fn
    return wrap


def null_if(col: str, value):
    return F.nullif(F.col(col), F.lit(value))


# --- sources, projections, scalar functions ------------------------------------

@register("s3_param_year", """
    SELECT CAST(year(o_orderdate) AS INTEGER) AS order_year, o_orderstatus, count(*) AS n,
           CAST(sum(CAST(o_totalprice AS DECIMAL(18,4))) AS DOUBLE) AS total
    FROM orders WHERE year(o_orderdate) BETWEEN 1997 AND 1999 AND o_orderpriority = '1-URGENT' GROUP BY ALL""")
def s3_param_year(t):
    """Query text with named parameters instead of spliced values."""
    return t.spark.sql("""
        SELECT year(o_orderdate) AS order_year, o_orderstatus, count(*) AS n,
               sum(CAST(o_totalprice AS DECIMAL(18,4))) AS total
        FROM {orders} WHERE year(o_orderdate) BETWEEN :y - 1 AND :y + 1 AND o_orderpriority = :priority
        GROUP BY 1, 2""", args={"y": S.REF_YEAR, "priority": "1-URGENT"}, orders=t.orders)


@register("s2_sql_file", """
    SELECT o_orderstatus, count(*) AS n, CAST(sum(CAST(o_totalprice AS DECIMAL(18,4))) AS DOUBLE) AS total
    FROM orders WHERE year(o_orderdate) >= 1997 AND o_orderpriority <> '5-LOW' GROUP BY o_orderstatus""")
def s2_sql_file(t):
    """A statement kept in a file, run over a registered view with named parameters."""
    register_views({"order_rows": t.orders})
    return run_sql_file(t.spark, str(Path(__file__).parent / "statements" / "order_totals.sql"), {"first_year": 1997, "skipped": "5-LOW"})


@register("s4_sampled_types", """
    SELECT 'table' AS part, o_orderstatus AS name, count(*) AS n, count(CASE WHEN o_orderstatus <> 'P' THEN 1 END) AS customers,
           count(nullif(o_orderpriority, '1-URGENT')) AS priorities, CAST(sum(o_orderkey) AS BIGINT) AS keys,
           CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS price, strftime(min(o_orderdate), '%Y-%m-%d') AS first,
           min(right('00' || CAST(o_custkey % 100 AS VARCHAR), 2)) AS code
    FROM orders GROUP BY o_orderstatus
    UNION ALL SELECT 'rejects', 'customer', count(*), 0, 0, 0, NULL, min('c' || CAST(o_custkey AS VARCHAR)), 'bigint' FROM orders WHERE o_orderstatus = 'P'""")
def s4_sampled_types(t):
    """The orders written as text and read without a schema; values beyond the sample that do not fit are told apart."""
    status, customer = F.col("o_orderstatus"), F.col("o_custkey").cast("string")
    text = t.orders.select(
        F.col("o_orderkey").alias("key"), "o_orderstatus", F.when(status == "P", F.concat(F.lit("c"), customer)).otherwise(customer).alias("customer"),
        F.lpad((F.col("o_custkey") % 100).cast("string"), 2, "0").alias("code"), F.col("o_totalprice").cast("decimal(18,2)").alias("price"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"), null_if("o_orderpriority", "1-URGENT").alias("priority"))
    path = f"{shared_folder(t.spark)}/orders-{uuid.uuid4().hex}"
    text.sortWithinPartitions("o_orderstatus").write.csv(path, header=True, nullValue="NA")
    got = read_inferred(t.spark, path, sample=200, as_text=["code"])
    none = F.lit(None).cast("double")
    table = got.table.groupBy(F.lit("table").alias("part"), F.col("o_orderstatus").alias("name")).agg(
        F.count(F.lit(1)).alias("n"), F.count("customer").alias("customers"), F.count("priority").alias("priorities"), F.sum("key").alias("keys"),
        F.sum(F.col("price").cast("decimal(18,2)")).cast("double").alias("price"), F.min("day").cast("string").alias("first"), F.min("code").alias("code"))
    rejects = got.rejects.groupBy(F.lit("rejects").alias("part"), F.col("column").alias("name"), F.col("type").alias("code")).agg(
        F.count(F.lit(1)).alias("n"), F.lit(0).cast("long").alias("customers"), F.lit(0).cast("long").alias("priorities"),
        F.lit(0).cast("long").alias("keys"), none.alias("price"), F.min("value").alias("first"))
    return table.unionByName(rejects)


@register("p1_project_range", """
    SELECT l_orderkey AS order_key, l_partkey, l_suppkey, l_linenumber, l_quantity AS "Plan Year 4",
           l_quantity AS "Plan Year 5", 'TOTAL' AS unit_mode, l_quantity * 2 AS twice FROM lineitem""")
def p1_project_range(t):
    """Column range by position, drop, literal, computed and copied columns, explicit order."""
    names = t.lineitem.columns
    span = names[names.index("l_orderkey"):names.index("l_quantity") + 1]
    rows = t.lineitem.select(*span).withColumnsRenamed({"l_orderkey": "order_key", "l_quantity": "Plan Year 4"})
    rows = rows.withColumns({"Plan Year 5": F.col("Plan Year 4"), "unit_mode": F.lit(C.TOTAL),
                             "twice": F.col("Plan Year 4") * 2, "scratch": F.lit(1)}).drop("scratch")
    return rows.select("order_key", *span[1:-1], "Plan Year 4", "Plan Year 5", "unit_mode", "twice")


@register("p7_cast_upper", """
    SELECT CAST(p_partkey AS VARCHAR) AS part_code, upper(p_name) AS p_name, upper(p_brand) AS p_brand,
           CAST(p_size AS VARCHAR) AS p_size, try_cast(regexp_replace(p_brand, '^Brand#1', 'x') AS DOUBLE) AS lenient
    FROM part""")
def p7_cast_upper(t):
    """Rename, cast and upper-case listed columns; text that is no number becomes missing."""
    rows = t.part.withColumnsRenamed({"p_partkey": "part_code"})
    rows = rows.withColumn("lenient", F.regexp_replace("p_brand", "^Brand#1", "x").try_cast("double"))
    return rows.withColumns({c: F.col(c).cast("string") for c in ("part_code", "p_size")} | upper_all(
        ["p_name", "p_brand"])).select("part_code", "p_name", "p_brand", "p_size", "lenient")


@register("p8_zero_fill_any_nonzero", f"""
    SELECT l_orderkey, l_linenumber, coalesce(nullif(l_returnflag, 'R'), 'UNCLASSIFIED') AS flag,
           coalesce(nullif(l_discount, 0.01), 0) AS discount, coalesce(nullif(l_tax, 0.02), 0) AS tax
    FROM lineitem WHERE coalesce(nullif(l_discount, 0.01), 0) <> 0 OR coalesce(nullif(l_tax, 0.02), 0) <> 0""")
def p8_zero_fill_any_nonzero(t):
    """Named and typed fills of missing values, then keep rows with any measure not zero."""
    rows = t.lineitem.select("l_orderkey", "l_linenumber", null_if("l_returnflag", "R").alias("flag"),
                             null_if("l_discount", 0.01).alias("discount"), null_if("l_tax", 0.02).alias("tax"))
    rows = rows.fillna({"flag": C.UNCLASSIFIED}).fillna(0, subset=["discount", "tax"])
    return rows.where((F.col("discount") != 0) | (F.col("tax") != 0))


@register("x14_arith_abs_null", f"""
    SELECT l_returnflag, count(*) AS n, count(CASE WHEN missing THEN 1 END) AS n_missing,
           CAST(sum(a) AS DOUBLE) AS abs_sum, CAST(sum(c) AS DOUBLE) AS check_sum FROM (
      SELECT l_returnflag, nullif(l_tax, 0.0) IS NULL AS missing, abs({D('l_discount')} - {D('l_tax')}) AS a,
             {D('l_quantity')} + {D('l_discount')} + {D('nullif(l_tax, 0.0)')} AS c FROM lineitem)
    GROUP BY l_returnflag""")
def x14_arith_abs_null(t):
    """Row count, missing test, absolute value and a sum that is missing with any part."""
    tax = load(null_if("l_tax", 0.0))
    rows = t.lineitem.select("l_returnflag", tax.isNull().alias("missing"),
                             F.abs(load("l_discount") - load("l_tax")).alias("a"),
                             (load("l_quantity") + load("l_discount") + tax).alias("c"))
    return rows.groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n"), F.count_if("missing").alias("n_missing"),
                                            F.sum("a").alias("abs_sum"), F.sum("c").alias("check_sum"))


@register("x8_paste", """
    SELECT c_custkey, coalesce(nullif(c_mktsegment, 'BUILDING'), 'NA') || ' ' || CAST(c_nationkey AS VARCHAR) AS row_id,
           coalesce(nullif(c_mktsegment, 'BUILDING'), 'NA') || CAST(c_nationkey AS VARCHAR) AS joined FROM customer""")
def x8_paste(t):
    """Concatenation in which a missing piece reads NA."""
    segment = null_if("c_mktsegment", "BUILDING")
    return t.customer.select("c_custkey", paste(segment, "c_nationkey").alias("row_id"),
                             paste(segment, "c_nationkey", sep="").alias("joined"))


@register("x12_max_text", """
    SELECT o_orderstatus, max(nullif(o_orderpriority, '5-LOW')) AS last_priority, min(o_orderdate)::DATE AS first_day
    FROM orders GROUP BY o_orderstatus""")
def x12_max_text(t):
    """Greatest text ignoring missing values, and the smallest date."""
    return t.orders.groupBy("o_orderstatus").agg(
        F.max(null_if("o_orderpriority", "5-LOW")).alias("last_priority"),
        F.min("o_orderdate").cast("date").alias("first_day"))


@register("x2_date_text", """
    SELECT o_orderkey, strftime(o_orderdate, '%d%m') AS day_month, strftime(o_orderdate, '%Y') AS year_text,
           strftime(o_orderdate, '%m-%d-%Y') AS report_date, strftime(o_orderdate, '%B') AS month_name FROM orders""")
def x2_date_text(t):
    """Dates as day+month, year, report date and full month name."""
    day = F.col("o_orderdate")
    return t.orders.select("o_orderkey", F.date_format(day, "ddMM").alias("day_month"),
                           F.date_format(day, "yyyy").alias("year_text"),
                           F.date_format(day, "MM-dd-yyyy").alias("report_date"),
                           F.date_format(day, "MMMM").alias("month_name"))


@register("x13_month_level", """
    SELECT "Month", "Forecast Type", n, total, row_number() OVER (ORDER BY ord NULLS LAST, "Forecast Type") AS position
    FROM (SELECT CASE WHEN ord IS NOT NULL THEN month END AS "Month", ord, kind AS "Forecast Type", count(*) AS n,
                 CAST(sum(CAST(o_totalprice AS DECIMAL(18,4))) AS DOUBLE) AS total
          FROM (SELECT strftime(o_orderdate, '%B') AS month, o_orderstatus AS kind, o_totalprice,
                       CASE strftime(o_orderdate, '%B') WHEN 'March' THEN 1 WHEN 'June' THEN 2 WHEN 'July' THEN 3
                            WHEN 'September' THEN 4 WHEN 'November' THEN 5 END AS ord FROM orders) GROUP BY ALL)""")
def x13_month_level(t):
    """Ordered months with values outside the list missing, as a table in report order."""
    rows = t.orders.select(F.date_format("o_orderdate", "MMMM").alias("FCAST_MONTH"), "o_orderstatus",
                           load("o_totalprice").alias("load"))
    rows = rows.withColumn("ord", month_order(C.month_levels(2018)))
    rows = rows.withColumn("FCAST_MONTH", F.when(F.col("ord").isNotNull(), F.col("FCAST_MONTH")))
    out = rows.groupBy("FCAST_MONTH", "ord", "o_orderstatus").agg(F.count(F.lit(1)).alias("n"),
                                                                  F.sum("load").alias("total"))
    place = F.row_number().over(Window.orderBy(F.col("ord").asc_nulls_last(), "o_orderstatus")).cast("long")
    return out.withColumn("position", place).orderBy("position").select(
        F.col("FCAST_MONTH").alias("Month"), F.col("o_orderstatus").alias("Forecast Type"), "n", "total", "position")


# --- filters --------------------------------------------------------------------

@register("f2_in_notin_guard", """
    SELECT c_custkey, seg, CASE WHEN seg IN ('BUILDING', 'AUTOMOBILE') THEN 'in'
                                WHEN seg NOT IN ('BUILDING', 'AUTOMOBILE') AND seg IS NOT NULL THEN 'out' END AS place
    FROM (SELECT c_custkey, nullif(c_mktsegment, 'MACHINERY') AS seg FROM customer)
    WHERE seg IS NULL OR seg <> 'HOUSEHOLD'""")
def f2_in_notin_guard(t):
    """IN, NOT IN with a guard for missing values, and the missing test."""
    seg = F.col("seg")
    rows = t.customer.select("c_custkey", null_if("c_mktsegment", "MACHINERY").alias("seg"))
    inside = seg.isin("BUILDING", "AUTOMOBILE")
    return rows.where(seg.isNull() | (seg != "HOUSEHOLD")).withColumn(
        "place", classify([(inside, "in"), (~inside & seg.isNotNull(), "out")]))


@register("f6_notin_keep_null", """
    SELECT c_custkey, campus, faculty FROM (SELECT c_custkey, nullif(c_mktsegment, 'MACHINERY') AS campus,
           nullif(CAST(c_nationkey % 5 AS VARCHAR), '4') AS faculty FROM customer)
    WHERE campus <> 'BUILDING' AND campus <> 'FURNITURE' AND coalesce(faculty NOT IN ('1', '3'), true)""")
def f6_notin_keep_null(t):
    """`!=` drops a missing value, not-in-set keeps it."""
    rows = t.customer.select("c_custkey", null_if("c_mktsegment", "MACHINERY").alias("campus"),
                             F.nullif((F.col("c_nationkey") % 5).cast("string"), F.lit("4")).alias("faculty"))
    campus = F.col("campus")
    return rows.where((campus != "BUILDING") & (campus != "FURNITURE") & not_in("faculty", ("1", "3")))


@register("f8_not_infinite", f"""
    SELECT l_orderkey, l_linenumber, l_tax FROM lineitem
    WHERE NOT (l_tax = 0 AND l_discount <> 0) """)
def f8_not_infinite(t):
    """Rows whose ratio is not infinite; NaN (zero by zero) stays."""
    rows = t.lineitem.withColumn("ratio", safe_ratio("l_discount", "l_tax"))
    return rows.where(not_infinite("ratio")).select("l_orderkey", "l_linenumber", "l_tax")


@register("f9_contains", """
    SELECT p_partkey, name FROM (SELECT p_partkey, nullif(p_name, 'red gear') AS name FROM part)
    WHERE contains(name, 'red ') OR regexp_matches(name, '^(old|hot) ')""")
def f9_contains(t):
    """Substring and pattern match; a missing text does not match."""
    name = F.col("name")
    rows = t.part.select("p_partkey", null_if("p_name", "red gear").alias("name"))
    return rows.where(name.contains("red ") | name.rlike("^(old|hot) "))


@register("f11_negated_compound", """
    SELECT o_orderkey, level, code FROM (SELECT o_orderkey, nullif(o_orderstatus, 'P') AS level,
           nullif(o_orderpriority, '5-LOW') AS code FROM orders)
    WHERE NOT (level = 'F' AND code = '1-URGENT')""")
def f11_negated_compound(t):
    """Negated conjunction, three-valued."""
    rows = t.orders.select("o_orderkey", null_if("o_orderstatus", "P").alias("level"),
                           null_if("o_orderpriority", "5-LOW").alias("code"))
    return rows.where(~((F.col("level") == "F") & (F.col("code") == "1-URGENT")))


@register("f12_latest_snapshot", """
    SELECT o_orderkey, CAST(year(o_orderdate) * 100 + month(o_orderdate) * 5 % 12 AS BIGINT) AS snapshot_id FROM orders
    WHERE year(o_orderdate) * 100 + month(o_orderdate) * 5 % 12 IN (
      (SELECT SNAPSHOT_ID FROM aggregation_control WHERE REFERENCE_YEAR = 1998 AND SNAPSHOT_DATE =
         (SELECT max(SNAPSHOT_DATE) FROM aggregation_control WHERE REFERENCE_YEAR = 1998)),
      (SELECT max(SNAPSHOT_ID) FROM aggregation_control WHERE REFERENCE_YEAR = 1999))""")
def f12_latest_snapshot(t):
    """Rows of the latest snapshot of a year, by date and by id."""
    control = S.aggregation_control(t)
    day = F.col("o_orderdate")
    rows = t.orders.select("o_orderkey", (F.year(day) * 100 + F.month(day) * 5 % 12).cast("long").alias("snapshot_id"))
    sid = F.col("snapshot_id")
    return rows.where((sid == latest_by_date(control, 1998)) | (sid == latest_by_id(control, 1999)))


@register("f13_semi_in", """
    SELECT o_orderkey, o_custkey, o_totalprice FROM orders
    WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')""")
def f13_semi_in(t):
    """IN (subquery) as a semi join."""
    wanted = t.customer.where(F.col("c_mktsegment") == "BUILDING")
    return null_safe_join(t.orders, wanted, [("o_custkey", "c_custkey")], "left_semi").select(
        "o_orderkey", "o_custkey", "o_totalprice")


@register("f14_point_in_time", """
    SELECT o_orderkey, o_orderdate::DATE AS order_day FROM orders
    WHERE year(o_orderdate) * 100 + month(o_orderdate) * 5 % 12 = (SELECT min(SNAPSHOT_ID) FROM aggregation_control
      WHERE strftime(SNAPSHOT_DATE, '%d%m') = '0106' AND REFERENCE_YEAR = 1997)""")
def f14_point_in_time(t):
    """Rows of the first snapshot of last year taken on today's day and month."""
    day = F.col("o_orderdate")
    sid = (F.year(day) * 100 + F.month(day) * 5 % 12).cast("long")
    return t.orders.where(sid == point_in_time(S.aggregation_control(t), S.AS_OF, 1997)).select(
        "o_orderkey", day.cast("date").alias("order_day"))


@register("f15_date_bound", """
    SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS order_year FROM orders
    WHERE o_orderdate <= make_date(1998 + 1, 1, 1) AND o_orderdate >= strptime('15/03/1996', '%d/%m/%Y')""")
def f15_date_bound(t):
    """Date bounds built from a year and from text, and the year of a date."""
    bound, first = F.make_date(F.lit(S.REF_YEAR + 1), F.lit(1), F.lit(1)), F.to_date(F.lit("15/03/1996"), "dd/MM/yyyy")
    day = F.col("o_orderdate")
    return t.orders.where((day <= bound) & (day >= first)).select("o_orderkey", F.year(day).alias("order_year"))


@register("f16_outer_cancelled", """
    SELECT l_orderkey, l_linenumber, o_orderstatus FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey
    AND o_orderpriority <> '5-LOW' WHERE o_orderstatus = 'F'""")
def f16_outer_cancelled(t):
    """A left join whose right side is filtered later plans as an inner join."""
    urgent = t.orders.where(F.col("o_orderpriority") != "5-LOW")
    return left_lookup(t.lineitem.select("l_orderkey", "l_linenumber"), urgent, {"l_orderkey": "o_orderkey"},
                       {"o_orderstatus": "o_orderstatus"}).where(F.col("o_orderstatus") == "F")


# --- joins ------------------------------------------------------------------------

@register("j1_star_left", f"""
    SELECT n_name, c_mktsegment, l_returnflag, CAST(sum({D('l_quantity')}) AS DOUBLE) AS load, count(*) AS n
    FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey AND l_returnflag = CASE o_orderstatus WHEN 'F' THEN 'A'
      WHEN 'O' THEN 'N' ELSE 'R' END
    LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey GROUP BY ALL""")
def j1_star_left(t):
    """Fact with dimensions on one and on two keys; a row without a match keeps missing names."""
    orders = t.orders.withColumn("flag", mapped(F.col("o_orderstatus"), {"F": "A", "O": "N"}, F.lit("R")))
    rows = left_lookup(t.lineitem.select("l_orderkey", "l_returnflag", "l_quantity"), orders,
                       {"l_orderkey": "o_orderkey", "l_returnflag": "flag"}, {"o_custkey": "o_custkey"})
    rows = left_lookup(rows, t.customer, {"o_custkey": "c_custkey"},
                       {"c_nationkey": "c_nationkey", "c_mktsegment": "c_mktsegment"})
    rows = left_lookup(rows, t.nation, {"c_nationkey": "n_nationkey"}, {"n_name": "n_name"})
    return rows.groupBy("n_name", "c_mktsegment", "l_returnflag").agg(
        F.sum(load("l_quantity")).alias("load"), F.count(F.lit(1)).alias("n"))


@register("j3_two_roles", """
    SELECT d.n_name AS degree_faculty, f.n_name AS faculty, count(*) AS n FROM lineitem
    JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey
    LEFT JOIN nation d ON c_nationkey = d.n_nationkey LEFT JOIN nation f ON s_nationkey = f.n_nationkey GROUP BY ALL""")
def j3_two_roles(t):
    """One dimension in two roles, joined to the fact summed by its codes."""
    rows = (S.order_lines(t).join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
            .join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey"))
            .groupBy("c_nationkey", "s_nationkey").agg(F.count(F.lit(1)).alias("n")))
    rows = left_lookup(rows, t.nation, {"c_nationkey": "n_nationkey"}, {"n_name": "degree_faculty"})
    rows = left_lookup(rows, t.nation, {"s_nationkey": "n_nationkey"}, {"n_name": "faculty"})
    return rows.groupBy("degree_faculty", "faculty").agg(F.sum("n").alias("n"))


@register("j4_on_filter", """
    SELECT c_custkey, n_name FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey AND n_regionkey = 1""")
def j4_on_filter(t):
    """A predicate in ON filters the dimension, not the fact."""
    return left_lookup(t.customer.select("c_custkey", "c_nationkey"), t.nation.where(F.col("n_regionkey") == 1),
                       {"c_nationkey": "n_nationkey"}, {"n_name": "n_name"}).drop("c_nationkey")


@register("j5_id_only", """
    SELECT o_orderkey, DEGREE_FACULTY_NAME FROM (SELECT o_orderkey, o_custkey % 25 AS id,
      nullif(CAST(year(o_orderdate) AS INTEGER), 1997) AS y FROM orders)
    LEFT JOIN degree_faculty ON id = DEGREE_FACULTY_ID AND y = y""")
def j5_id_only(t):
    """A tautology in ON: matched by id alone for rows with a year, so ids that repeat fan out."""
    year = F.nullif(F.year("o_orderdate"), F.lit(1997))
    rows = t.orders.select("o_orderkey", F.when(year.isNotNull(), F.col("o_custkey") % 25).alias("id"))
    return left_lookup(rows, S.degree_faculty(t), {"id": "DEGREE_FACULTY_ID"},
                       {"DEGREE_FACULTY_NAME": "DEGREE_FACULTY_NAME"}).drop("id")


@register("j6_latest_version", """
    SELECT cv.COURSE_CD, cv.ABBREVIATION FROM course_version cv JOIN (SELECT COURSE_CD, max(VERSION_NUMBER) AS v
      FROM course_version WHERE START_DT <= DATE '1998-01-01' GROUP BY COURSE_CD) m
    ON cv.COURSE_CD = m.COURSE_CD AND cv.VERSION_NUMBER = m.v GROUP BY 1, 2""")
def j6_latest_version(t):
    """Latest version per course within a date bound; ties stay."""
    return latest_version(S.course_version(t), date(1998, 1, 1))


@register("w2_latest_per_year", """
    SELECT REFERENCE_YEAR, SNAPSHOT_ID, SNAPSHOT_DATE FROM aggregation_control c
    WHERE SNAPSHOT_DATE = (SELECT max(SNAPSHOT_DATE) FROM aggregation_control d WHERE d.REFERENCE_YEAR = c.REFERENCE_YEAR)""")
def w2_latest_per_year(t):
    """Latest snapshot of every year as a window."""
    newest = Window.partitionBy("REFERENCE_YEAR").orderBy(F.desc("SNAPSHOT_DATE"))
    return (S.aggregation_control(t).withColumn("place", F.rank().over(newest)).where("place = 1").drop("place"))


@register("a4_latest_run", f"""
    SELECT FUNDING_SOURCE, CAST(sum(REPORTED_FORECAST_LOAD) AS DOUBLE) AS load FROM forecast_load
    WHERE FORECAST_CONTROL_ID = (SELECT max(FORECAST_CONTROL_ID) FROM forecast_control) GROUP BY FUNDING_SOURCE""")
def a4_latest_run(t):
    """Load of the latest forecast run, found by a global maximum."""
    rows = S.forecast_load(t).where(F.col("FORECAST_CONTROL_ID") == latest_run(S.forecast_control(t)))
    return rows.groupBy("FUNDING_SOURCE").agg(sum_load(rows, "REPORTED_FORECAST_LOAD").alias("load"))


def _flag_sums(t, keep, name):
    rows = t.lineitem.where(keep).select(null_if("l_returnflag", "R").alias("flag"),
                                         null_if("l_linestatus", "O").alias("status"), "l_linenumber",
                                         load("l_quantity").alias("q"))
    return rows.groupBy("flag", "status", "l_linenumber").agg(F.sum("q").alias(name))


_FLAG_SUMS = ("SELECT nullif(l_returnflag, 'R') AS flag, nullif(l_linestatus, 'O') AS status, l_linenumber, "
              "CAST(sum(CAST(l_quantity AS DECIMAL(18,4))) AS DOUBLE) AS {0} FROM lineitem WHERE {1} GROUP BY ALL")


@register("j8_natural_full_nullsafe", f"""
    SELECT coalesce(a.flag, b.flag) AS flag, coalesce(a.status, b.status) AS status,
           coalesce(a.l_linenumber, b.l_linenumber) AS l_linenumber, medical, subbach
    FROM ({_FLAG_SUMS.format('medical', 'l_linenumber <= 5')}) a FULL JOIN ({_FLAG_SUMS.format('subbach', 'l_linenumber >= 3')}) b
    ON a.flag IS NOT DISTINCT FROM b.flag AND a.status IS NOT DISTINCT FROM b.status
       AND a.l_linenumber IS NOT DISTINCT FROM b.l_linenumber""")
def j8_natural_full_nullsafe(t):
    """Full join on all shared columns, missing equal to missing."""
    return natural_join(_flag_sums(t, F.col("l_linenumber") <= 5, "medical"),
                        _flag_sums(t, F.col("l_linenumber") >= 3, "subbach"), "full")


@register("j9_left_nullsafe_fanout", f"""
    SELECT a.flag, a.status, a.total, b.part FROM (SELECT flag, status, sum(q) AS total FROM
      ({_FLAG_SUMS.format('q', 'true')}) GROUP BY ALL) a
    LEFT JOIN ({_FLAG_SUMS.format('part', "l_linenumber > 1 AND l_returnflag <> 'N'")}) b
    ON a.flag IS NOT DISTINCT FROM b.flag AND a.status IS NOT DISTINCT FROM b.status""")
def j9_left_nullsafe_fanout(t):
    """Left join with missing keys; a key that repeats on the right multiplies the left row."""
    total = sum_numeric(_flag_sums(t, F.lit(True), "total").drop("l_linenumber"), ["flag", "status"])
    part = _flag_sums(t, (F.col("l_linenumber") > 1) & (F.col("l_returnflag") != "N"), "part").drop("l_linenumber")
    return null_safe_join(total, part, ["flag", "status"], "left")


_MONTHLY = {
    "monthly_forecast": f"""SELECT nullif(o_orderstatus, 'P') AS status, o_custkey, nullif(o_orderpriority, '5-LOW') AS month,
        sum({D('o_totalprice')}) AS forecast FROM orders GROUP BY ALL""",
    "customer_actual": f"""SELECT nullif(o_orderstatus, 'P') AS status, o_custkey, l_returnflag AS description,
        sum({D('l_extendedprice')}) AS actual FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY ALL""",
    "months": "SELECT DISTINCT month AS m FROM monthly_forecast WHERE month IS NOT NULL",
    "aligned": """SELECT coalesce(f.status, a.status) AS status, coalesce(f.o_custkey, a.o_custkey) AS o_custkey,
        coalesce(f.month, a.m) AS month, f.forecast, a.description, a.actual
        FROM (SELECT * FROM monthly_forecast WHERE month IS NOT NULL) f
        FULL JOIN (SELECT * FROM customer_actual, months) a ON f.status IS NOT DISTINCT FROM a.status
        AND f.o_custkey IS NOT DISTINCT FROM a.o_custkey AND f.month = a.m""",
}


def _monthly(t):
    status = null_if("o_orderstatus", "P").alias("status")
    rows = t.orders.select(status, "o_custkey", null_if("o_orderpriority", "5-LOW").alias("month"),
                           load("o_totalprice").alias("load"))
    forecast = rows.groupBy("status", "o_custkey", "month").agg(F.sum("load").alias("forecast"))
    actual = S.order_lines(t).groupBy(status, "o_custkey", F.col("l_returnflag").alias("description")).agg(
        F.sum(load("l_extendedprice")).alias("actual"))
    return align_by_slice(forecast, actual, "month", slice_source=rows)


@register("j10_per_month_full", """
    SELECT * REPLACE (CAST(forecast AS DOUBLE) AS forecast, CAST(actual AS DOUBLE) AS actual) FROM aligned""", _MONTHLY)
def j10_per_month_full(t):
    """Every month of the forecast full-joined with all actuals."""
    return _monthly(t)


_HOT = {
    "hot_forecast": f"""SELECT nullif(o_orderstatus, 'P') AS status, nullif(o_orderpriority, '5-LOW') AS month,
        sum({D('o_totalprice')}) AS forecast FROM orders WHERE o_orderstatus <> 'O' GROUP BY ALL""",
    "hot_actual": f"""SELECT nullif(o_orderstatus, 'P') AS status, l_orderkey, l_linenumber, {D('l_quantity')} AS actual
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "hot_aligned": """SELECT coalesce(f.status, a.status) AS status, coalesce(f.month, a.m) AS month, f.forecast, a.l_orderkey, a.l_linenumber, a.actual
        FROM (SELECT * FROM hot_forecast WHERE month IS NOT NULL) f
        FULL JOIN (SELECT * FROM hot_actual, (SELECT DISTINCT month AS m FROM hot_forecast WHERE month IS NOT NULL) m) a
        ON f.status IS NOT DISTINCT FROM a.status AND f.month = a.m""",
}


@register("j10_hot_keys", """
    SELECT * REPLACE (CAST(forecast AS DOUBLE) AS forecast, CAST(actual AS DOUBLE) AS actual) FROM hot_aligned""", _HOT)
def j10_hot_keys(t):
    """Raw order lines under three keys, one of them missing: the rows of a key are dealt over several tasks."""
    status = null_if("o_orderstatus", "P").alias("status")
    forecast = (t.orders.where(F.col("o_orderstatus") != "O").groupBy(status, null_if("o_orderpriority", "5-LOW").alias("month"))
                .agg(F.sum(load("o_totalprice")).alias("forecast")))
    actual = S.order_lines(t).select(status, "l_orderkey", "l_linenumber", load("l_quantity").alias("actual"))
    return align_by_slice(forecast, actual, "month", spread=32)


@register("j11_tagged_consolidate", f"""
    SELECT 'Course' AS kind, o_orderstatus AS status, o_orderpriority AS course, CAST(sum({D('o_totalprice')}) AS DOUBLE) AS load
    FROM orders GROUP BY ALL
    UNION ALL SELECT 'Bucket', l_linestatus, NULL, CAST(sum({D('l_extendedprice')}) AS DOUBLE) FROM lineitem GROUP BY ALL""")
def j11_tagged_consolidate(t):
    """A full join whose tag never matches: union by name, missing columns missing."""
    course = t.orders.groupBy(F.col("o_orderstatus").alias("status"), F.col("o_orderpriority").alias("course")).agg(
        F.sum(load("o_totalprice")).alias("load"))
    bucket = t.lineitem.groupBy(F.col("l_linestatus").alias("status")).agg(F.sum(load("l_extendedprice")).alias("load"))
    return bind_tagged([("Course", course), ("Bucket", bucket)], "kind")


@register("j12_double_lookup", """
    SELECT o_orderkey, l_linenumber, c.n_name AS degree_name, s.n_name AS faculty_name, r_name FROM lineitem
    JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey
    LEFT JOIN nation c ON nullif(c_nationkey, 7) IS NOT DISTINCT FROM c.n_nationkey
    LEFT JOIN nation s ON s_nationkey = s.n_nationkey LEFT JOIN region ON s.n_regionkey = r_regionkey""")
def j12_double_lookup(t):
    """A lookup by differently named keys for two roles, then a natural lookup."""
    rows = (S.order_lines(t).join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
            .join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey"))
            .select("o_orderkey", "l_linenumber", null_if("c_nationkey", 7).alias("degree_key"), "s_nationkey"))
    degree = t.nation.select("n_nationkey", F.col("n_name").alias("degree_name"))
    faculty = t.nation.select("n_nationkey", F.col("n_name").alias("faculty_name"), F.col("n_regionkey").alias("r_regionkey"))
    rows = null_safe_join(rows, degree, [("degree_key", "n_nationkey")], "left")
    rows = null_safe_join(rows, faculty, [("s_nationkey", "n_nationkey")], "left")
    return natural_join(rows, t.region, "left").drop("degree_key", "s_nationkey", "r_regionkey")


# --- aggregations -------------------------------------------------------------------

@register("a1_group_by_case", f"""
    SELECT CASE WHEN fund IN ('CSP', 'RESEARCH TRAINING PROGRAM - DOMESTIC', 'RESEARCH TRAINING PROGRAM - INTERNATIONAL')
             THEN 'Yes' ELSE 'No fixed bucket' END AS fixed_bucket,
           CASE WHEN fund = 'CSP' THEN 'CSP Planning' WHEN fund = 'INTERNATIONAL: OFFSHORE PARTNERS'
             THEN 'Offshore Partner Planning' WHEN fund IN ('RESEARCH TRAINING PROGRAM - DOMESTIC',
             'RESEARCH TRAINING PROGRAM - INTERNATIONAL') THEN 'RTP Planning' ELSE 'DEMAND Planning' END AS module,
           CASE WHEN flag = 'Y' THEN 'Home' ELSE 'Other' END AS home_load, CAST(sum(q) AS DOUBLE) AS load
    FROM (SELECT {FUND.format('c_mktsegment')} AS fund, CASE o_orderstatus WHEN 'F' THEN 'Y' WHEN 'O' THEN 'N' END AS flag,
                 {D('l_quantity')} AS q FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey)
    GROUP BY 1, 2, 3""")
def a1_group_by_case(t):
    """Sum grouped by classified columns; the fact is summed by raw codes first."""
    raw = (S.order_lines(t).join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
           .groupBy("c_mktsegment", "o_orderstatus").agg(F.sum(load("l_quantity")).alias("q")))
    fund, flag = S.fund_name(F.col("c_mktsegment")), S.student_flag(F.col("o_orderstatus"))
    return raw.groupBy(R.fixed_bucket(fund, S.RULES).alias("fixed_bucket"), R.planning_module(fund, S.RULES).alias("module"),
                       R.home_load(flag, S.RULES).alias("home_load")).agg(F.sum("q").alias("load"))


@register("a2_hidden_key", f"""
    SELECT l_returnflag, CAST(load AS DOUBLE) AS load FROM (SELECT l_returnflag, l_linenumber, sum({D('l_quantity')}) AS load
    FROM lineitem GROUP BY 1, 2)""")
def a2_hidden_key(t):
    """A grouped key that is not shown leaves repeated output keys."""
    return sum_by(t.lineitem.withColumn("q", load("l_quantity")), ["l_returnflag", "l_linenumber"], "q",
                  "load").drop("l_linenumber")


@register("a6_strict_sum", f"""
    SELECT l_orderkey, CAST(CASE WHEN count(x) = count(*) THEN sum(x) END AS DOUBLE) AS load
    FROM (SELECT l_orderkey, {D('nullif(l_tax, 0.0)')} AS x FROM lineitem) GROUP BY l_orderkey""")
def a6_strict_sum(t):
    """A sum that is missing as soon as one value is."""
    rows = t.lineitem.select("l_orderkey", load(null_if("l_tax", 0.0)).alias("x"))
    return sum_by(rows, ["l_orderkey"], "x", "load", "strict")


_FINE = "CAST(l_quantity AS DECIMAL(18,4)) * CAST(0.00001 AS DECIMAL(6,5))"
_LARGE = "CAST(l_quantity AS DECIMAL(20,0)) * CAST(1000000000001 AS DECIMAL(13,0))"
_DEEP = "CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(0.000000000001 AS DECIMAL(13,12))"


@register("a6_fine_loads", f"""
    SELECT l_returnflag, CAST(sum({_FINE}) AS DOUBLE) AS fine, CAST(sum({_LARGE}) AS DOUBLE) AS large,
           CAST(sum({_DEEP}) AS DOUBLE) AS deep FROM lineitem GROUP BY 1""")
def a6_fine_loads(t):
    """Sums of loads with nine and with fourteen places, and of loads above 1e13; no place is lost before the sum."""
    rows = t.lineitem.select("l_returnflag", F.expr(_FINE).alias("fine"), F.expr(_LARGE).alias("large"), F.expr(_DEEP).alias("deep"))
    return rows.groupBy("l_returnflag").agg(*[sum_load(rows, c).alias(c) for c in ("fine", "large", "deep")])


@register("a7_sum_or_zero", f"""
    SELECT l_orderkey, CAST(coalesce(sum({D('nullif(l_tax, 0.0)')}), 0) AS DOUBLE) AS load FROM lineitem GROUP BY l_orderkey""")
def a7_sum_or_zero(t):
    """A sum that skips missing values and is zero without any."""
    rows = t.lineitem.select("l_orderkey", load(null_if("l_tax", 0.0)).alias("x"))
    return sum_by(rows, ["l_orderkey"], "x", "load", "skip")


@register("a8_sum_all_numeric", f"""
    SELECT flag, CAST(coalesce(sum(q), 0) AS DOUBLE) AS q, CAST(coalesce(sum(d), 0) AS DOUBLE) AS d,
           CAST(coalesce(sum(x), 0) AS DOUBLE) AS x, CAST(sum(n) AS BIGINT) AS n
    FROM (SELECT nullif(l_returnflag, 'R') AS flag, l_linestatus, {D('l_quantity')} AS q, {D('l_discount')} AS d,
                 {D('nullif(l_tax, 0.0)')} AS x, CAST(l_linenumber AS BIGINT) AS n FROM lineitem) GROUP BY GROUPING SETS ((flag), ())
    """)
def a8_sum_all_numeric(t):
    """Sum of every numeric column per group and in total; text columns leave."""
    rows = t.lineitem.select(null_if("l_returnflag", "R").alias("flag"), "l_linestatus", load("l_quantity").alias("q"),
                             load("l_discount").alias("d"), load(null_if("l_tax", 0.0)).alias("x"),
                             F.col("l_linenumber").cast("long").alias("n"))
    groups = sum_numeric(rows, ["flag"], "skip")
    return groups.unionByName(sum_numeric(groups, [], "skip"), allowMissingColumns=True)


_COURSES = f"""SELECT nullif(p_brand, 'Brand#11') AS course, CASE p_type WHEN 'PROMO' THEN NULL WHEN 'LARGE' THEN 'HDR'
    ELSE p_type END AS level, l_linestatus AS mode, sum({D('l_quantity')}) AS load, sum({D('l_discount')}) AS other
    FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY ALL"""


def _courses(t):
    parts = t.lineitem.groupBy("l_partkey", "l_linestatus").agg(F.sum(load("l_quantity")).alias("load"),
                                                               F.sum(load("l_discount")).alias("other"))
    rows = parts.join(t.part, F.col("l_partkey") == F.col("p_partkey"))
    level = F.when(F.col("p_type") == "LARGE", "HDR").when(F.col("p_type") != "PROMO", F.col("p_type"))
    return rows.groupBy(null_if("p_brand", "Brand#11").alias("course"), level.alias("level"),
                        F.col("l_linestatus").alias("mode")).agg(F.sum("load").alias("load"), F.sum("other").alias("other"))


_DOUBLES = "SELECT course, level, mode, CAST(load AS DOUBLE) AS load, CAST(other AS DOUBLE) AS other FROM {0}"


@register("a12_total_member", _DOUBLES.format("""(SELECT course, level, CASE WHEN grouping(mode) = 1 THEN 'TOTAL' ELSE mode END AS mode,
    sum(load) AS load, sum(other) AS other FROM courses GROUP BY GROUPING SETS ((course, level, mode), (course, level)))"""),
          {"courses": _COURSES})
def a12_total_member(t):
    """Detail rows and one TOTAL row over a dimension, from one aggregation."""
    return add_total_member(_courses(t), ["course", "level", "mode"], "mode", ["load", "other"])


@register("a13_rollup_replace", _DOUBLES.format("""(
    SELECT * FROM marked WHERE NOT (level = 'HDR' AND course = 'Brand#1')
    UNION SELECT 'Brand#1', level, mode, sum(load), sum(other) FROM marked WHERE level = 'HDR' GROUP BY level, mode)"""),
          {"courses": _COURSES, "marked": "SELECT course, level, mode, load, other FROM courses"})
def a13_rollup_replace(t):
    """All rows of one level summed into a sentinel row that replaces the old one."""
    return rollup_into(_courses(t), F.col("level") == "HDR", ["level", "mode"], {"course": "Brand#1"}, ["load", "other"])


@register("a14_two_level", f"""
    SELECT r_name, CAST(coalesce(sum(load), 0) AS DOUBLE) AS load FROM (SELECT nullif(c_nationkey, 3) AS code,
      sum({D('c_acctbal')}) AS load FROM customer GROUP BY 1) LEFT JOIN nation ON code IS NOT DISTINCT FROM n_nationkey
    LEFT JOIN region ON n_regionkey = r_regionkey GROUP BY r_name""")
def a14_two_level(t):
    """Sum by unit, look the group of the unit up, sum by group."""
    rows = t.customer.select(null_if("c_nationkey", 3).alias("code"), load("c_acctbal").alias("load"))
    units = sum_numeric(rows, ["code"], "skip")
    units = null_safe_join(units, t.nation.select("n_nationkey", "n_regionkey"), [("code", "n_nationkey")], "left")
    named = null_safe_join(units, t.region, [("n_regionkey", "r_regionkey")], "left")
    return sum_by(named, ["r_name"], "load", "load", "skip")


_ORDER_ERRORS = {
    "line_totals": f"""SELECT l_orderkey, sum({D('l_extendedprice')}) AS actual FROM lineitem GROUP BY 1""",
    "order_errors": f"""SELECT o_orderkey, o_orderstatus AS status, o_orderpriority AS month,
        CASE WHEN o_orderstatus = 'P' THEN 0 ELSE {D('o_totalprice')} END AS forecast, coalesce(actual, 0) AS actual
        FROM orders LEFT JOIN line_totals ON o_orderkey = l_orderkey""",
}


def _order_errors(t):
    # Orders without lines have no actual load.
    totals = t.lineitem.groupBy("l_orderkey").agg(F.sum(load("l_extendedprice")).alias("actual"))
    rows = left_lookup(t.orders, totals, {"o_orderkey": "l_orderkey"}, {"actual": "actual"})
    return rows.select("o_orderkey", F.col("o_orderstatus").alias("status"), F.col("o_orderpriority").alias("month"),
                       F.when(F.col("o_orderstatus") == "P", F.lit(0).cast("decimal(18,4)")).otherwise(load("o_totalprice"))
                       .alias("forecast"), F.coalesce("actual", F.lit(0).cast("decimal(28,4)")).alias("actual"))


@register("a15_abs_error_both", """
    SELECT month, CAST(sum(abs(e)) AS DOUBLE) AS abs_of_rows, CAST(abs(sum(e)) AS DOUBLE) AS abs_of_sum
    FROM (SELECT month, CAST(forecast - actual AS DECIMAL(18,2)) AS e FROM order_errors) GROUP BY month""", _ORDER_ERRORS)
def a15_abs_error_both(t):
    """Sum of absolute row errors beside the absolute value of the summed error."""
    rows = _order_errors(t).withColumn("e", signed_error("forecast", "actual"))
    return rows.groupBy("month").agg(F.sum(F.abs("e")).alias("abs_of_rows"), F.abs(F.sum("e")).alias("abs_of_sum"))


# --- reshape, order, set operations ---------------------------------------------------

@register("r1_unpivot", f"""
    SELECT l_orderkey, l_linenumber, CASE kind WHEN 'commencing_load' THEN 'Commencing' WHEN 'returning_load' THEN 'Returning' END
             AS com_ret, load FROM (
      UNPIVOT (SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber <> 3 THEN l_extendedprice END AS commencing_load,
                      nullif(l_tax, 0.0) AS returning_load FROM lineitem)
      ON commencing_load, returning_load INTO NAME kind VALUE load)""")
def r1_unpivot(t):
    """Two measures to label and value; missing measures give no row."""
    wide = t.lineitem.select("l_orderkey", "l_linenumber",
                             F.when(F.col("l_linenumber") != 3, F.col("l_extendedprice")).alias("commencing_load"),
                             null_if("l_tax", 0.0).alias("returning_load"))
    long = unpivot_drop_null(wide, ["l_orderkey", "l_linenumber"], ["commencing_load", "returning_load"], "kind", "load")
    label = classify([(F.col("kind") == "commencing_load", "Commencing"), (F.col("kind") == "returning_load", "Returning")])
    return long.withColumn("com_ret", label).drop("kind")


_PIVOT = ["1-URGENT", "2-HIGH", "3-MEDIUM", "NA"]


@register("r3_pivot_fixed", f"""
    SELECT o_custkey, {", ".join(f'''CAST(CASE WHEN count(CASE WHEN m = '{v}' THEN x END) = count(CASE WHEN m = '{v}' THEN 1 END)
      THEN sum(CASE WHEN m = '{v}' THEN x END) END AS DOUBLE) AS "{v}"''' for v in _PIVOT)}
    FROM (SELECT o_custkey, coalesce(nullif(o_orderpriority, '5-LOW'), 'NA') AS m,
                 CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '1-URGENT' THEN NULL ELSE {D('o_totalprice')} END AS x FROM orders)
    GROUP BY o_custkey""")
def r3_pivot_fixed(t):
    """One column per listed measure, one of them for the missing name, strict sums."""
    hole = (F.col("o_orderstatus") == "P") & (F.col("o_orderpriority") == "1-URGENT")
    rows = t.orders.select("o_custkey", null_if("o_orderpriority", "5-LOW").alias("measure"),
                           F.when(~hole, load("o_totalprice")).alias("x"))
    return pivot_fixed(rows, ["o_custkey"], "measure", "x", _PIVOT)


@register("o2_nulls_last_rank", """
    SELECT status, priority, n, row_number() OVER (ORDER BY status NULLS LAST, priority NULLS LAST) AS position
    FROM (SELECT nullif(o_orderstatus, 'F') AS status, nullif(o_orderpriority, '1-URGENT') AS priority, count(*) AS n
          FROM orders GROUP BY ALL)""")
def o2_nulls_last_rank(t):
    """Sort by several keys with missing values last."""
    rows = t.orders.groupBy(null_if("o_orderstatus", "F").alias("status"),
                            null_if("o_orderpriority", "1-URGENT").alias("priority")).agg(F.count(F.lit(1)).alias("n"))
    order = [F.col("status").asc_nulls_last(), F.col("priority").asc_nulls_last()]
    return rows.withColumn("position", F.row_number().over(Window.orderBy(*order)).cast("long")).orderBy(*order)


@register("o4_first_n", """
    SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 4""")
def o4_first_n(t):
    """First n of a total order."""
    return t.orders.select("o_orderkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(4)


@register("s7_tagged_union", """
    SELECT 'March' AS FCAST_MONTH, o_orderkey AS id, o_totalprice AS load, NULL AS flag FROM orders WHERE o_orderstatus = 'F'
    UNION ALL SELECT 'March', o_orderkey, o_totalprice, NULL FROM orders WHERE o_orderstatus = 'O'
    UNION ALL SELECT 'June', o_orderkey, o_totalprice, NULL FROM orders WHERE o_orderstatus = 'P'
    UNION ALL SELECT 'September', l_orderkey, l_extendedprice, l_returnflag FROM lineitem""")
def s7_tagged_union(t):
    """Several inputs as one table with a label each; labels repeat and columns may be absent."""
    def part(status):
        return t.orders.where(F.col("o_orderstatus") == status).select(
            F.col("o_orderkey").alias("id"), F.col("o_totalprice").alias("load"))
    lines = t.lineitem.select(F.col("l_orderkey").alias("id"), F.col("l_extendedprice").alias("load"),
                              F.col("l_returnflag").alias("flag"))
    return bind_tagged([("March", part("F")), ("March", part("O")), ("June", part("P")), ("September", lines)], "FCAST_MONTH")


_LINES = "SELECT l_returnflag AS a, l_linenumber AS b FROM lineitem WHERE l_linestatus = '{0}'"


@register("u3_mixed_chain", f"""
    {_LINES.format('F')} UNION ALL {_LINES.format('O')}
    UNION SELECT o_orderstatus, CAST(length(o_orderpriority) AS INTEGER) FROM orders
    UNION ALL SELECT nullif(o_orderpriority, '5-LOW'), CAST(year(o_orderdate) AS INTEGER) FROM orders""")
def u3_mixed_chain(t):
    """UNION ALL, UNION and UNION ALL left to right: the UNION makes all above it distinct."""
    def lines(status):
        return t.lineitem.where(F.col("l_linestatus") == status).select(
            F.col("l_returnflag").alias("a"), F.col("l_linenumber").alias("b"))
    states = t.orders.select(F.col("o_orderstatus").alias("a"), F.length("o_orderpriority").alias("b"))
    years = t.orders.select(null_if("o_orderpriority", "5-LOW").alias("a"), F.year("o_orderdate").alias("b"))
    return lines("F").union(lines("O")).union(states).distinct().union(years)


@register("u4_union_by_name", """
    SELECT nullif(o_orderstatus, 'F') AS a, nullif(o_orderpriority, '2-HIGH') AS b FROM orders
    UNION SELECT nullif(l_linestatus, 'F'), nullif(l_returnflag, 'N') FROM lineitem""")
def u4_union_by_name(t):
    """Distinct union by column name; missing equals missing."""
    left = t.orders.select(null_if("o_orderstatus", "F").alias("a"), null_if("o_orderpriority", "2-HIGH").alias("b"))
    right = t.lineitem.select(null_if("l_returnflag", "N").alias("b"), null_if("l_linestatus", "F").alias("a"))
    return union_distinct(left, right)


# --- classification -----------------------------------------------------------------

_DESIGNATED = """CASE WHEN fund = 'CSP' AND COURSE_LEVEL = 'GPG' THEN 'CSP Designated GPG'
    WHEN fund = 'CSP' AND COURSE_LEVEL = 'UG' AND {0} IN ('Brand#1', 'Brand#2', 'Brand#3', 'Brand#4') THEN 'CSP Designated Medical UG'
    WHEN fund = 'CSP' AND COURSE_LEVEL = 'UG' AND {0} IN ('Brand#5', 'Brand#6', 'Brand#7', 'Brand#8', 'Brand#9', 'Brand#10')
      THEN 'CSP Designated Sub-bachelor UG'
    WHEN fund = 'CSP' AND COURSE_LEVEL = 'UG' AND {0} IS NULL THEN 'CSP Undesignated bucket level UG'
    WHEN fund = 'CSP' AND COURSE_LEVEL = 'UG' AND {0} IS NOT NULL THEN 'CSP Undesignated course code level UG'
    WHEN fund <> 'CSP' THEN 'Non-CSP' END"""


@register("c6_designation", f"""
    SELECT {_DESIGNATED.format('COURSE_CD')} AS designated, {_DESIGNATED.format('CAST(NULL AS VARCHAR)')} AS reduced,
           coalesce(COURSE_CD, '* Key attribute bucket') AS code,
           CASE WHEN COURSE_CD IS NULL THEN '* Key attribute bucket' ELSE nullif(COURSE_LEVEL, 'PG') END AS description,
           coalesce(SCA_LOCATION_CD, SCA_COORD_CAMPUS) AS filled, coalesce(SCA_LOCATION_CD, 'NA') AS place,
           CAST(sum(EFTSL) AS DOUBLE) AS load
    FROM (SELECT *, {FUND.format('FUNDING_SOURCE')} AS fund FROM unit_load) GROUP BY 1, 2, 3, 4, 5, 6""")
def c6_designation(t):
    """Designation with and without a course, and the fills of missing codes."""
    keys = ["FUNDING_SOURCE", "COURSE_LEVEL", "COURSE_CD", "SCA_LOCATION_CD", "SCA_COORD_CAMPUS"]
    loads = S.unit_load(t)
    raw = loads.groupBy(*keys).agg(sum_load(loads, "EFTSL").alias("EFTSL"))
    fund, course, level = S.fund_name(F.col("FUNDING_SOURCE")), F.col("COURSE_CD"), F.col("COURSE_LEVEL")
    place = F.col("SCA_LOCATION_CD")
    return raw.groupBy(
        R.designation(fund, level, course, S.RULES).alias("designated"),
        R.designation(fund, level, F.lit(None).cast("string"), S.RULES).alias("reduced"),
        R.bucket_code(course).alias("code"),
        R.bucket_description(course, F.nullif(level, F.lit("PG"))).alias("description"),
        F.coalesce(place, "SCA_COORD_CAMPUS").alias("filled"), R.location(place).alias("place"),
    ).agg(F.sum("EFTSL").alias("load"))


@register("c9_tristate", """
    SELECT o_orderkey, CASE flag WHEN 'Y' THEN 'Commencing' WHEN 'N' THEN 'Returning' END AS by_flag,
           CASE WHEN flag = 'Y' THEN 'Commencing' WHEN flag <> 'Y' THEN 'Returning' END AS by_test,
           CASE WHEN flag = 'N' AND priority = '1-URGENT' THEN 'DESIGNATED_GPG'
                WHEN NOT (flag = 'N' AND priority = '1-URGENT') THEN o_orderpriority END AS relabelled
    FROM (SELECT o_orderkey, o_orderpriority, nullif(o_orderpriority, '5-LOW') AS priority,
                 CASE o_orderstatus WHEN 'F' THEN 'Y' WHEN 'O' THEN 'N' END AS flag FROM orders)""")
def c9_tristate(t):
    """Two-way choices in which a missing condition gives a missing result."""
    flag, priority = F.col("flag"), F.col("priority")
    rows = t.orders.select("o_orderkey", "o_orderpriority", null_if("o_orderpriority", "5-LOW").alias("priority"),
                           S.student_flag(F.col("o_orderstatus")).alias("flag"))
    graduate = (flag == "N") & (priority == "1-URGENT")
    return rows.select("o_orderkey", R.student_type(flag).alias("by_flag"),
                       if_else3(flag == "Y", F.lit("Commencing"), F.lit("Returning")).alias("by_test"),
                       if_else3(graduate, F.lit("DESIGNATED_GPG"), F.col("o_orderpriority")).alias("relabelled"))


@register("c11_horizon_c12_band", """
    SELECT l_orderkey, l_linenumber, CASE WHEN y - 1996 BETWEEN 1 AND 5 THEN 'Plan Year ' || CAST(y - 1996 AS VARCHAR) END AS horizon,
           CASE WHEN lv IS NULL OR lv = 1 THEN 'CURRENT_YEAR_YEAR_1' WHEN lv = 2 THEN 'CURRENT_YEAR_YEAR_2'
                WHEN lv = 3 THEN 'CURRENT_YEAR_YEAR_3' WHEN lv = 4 THEN 'CURRENT_YEAR_YEAR_4' WHEN lv >= 5 THEN 'CURRENT_YEAR_YEAR_5+' END AS band
    FROM (SELECT l_orderkey, l_linenumber, year(l_shipdate) AS y, nullif(l_linenumber - 1, 6) AS lv FROM lineitem)""")
def c11_horizon_c12_band(t):
    """Plan year by distance from the reference year, and the year-level band."""
    return t.lineitem.select("l_orderkey", "l_linenumber",
                             R.plan_year_label(F.year("l_shipdate").cast("string"), 1996).alias("horizon"),
                             R.year_level_band(F.nullif(F.col("l_linenumber") - 1, F.lit(6)), "CURRENT_YEAR_").alias("band"))


@register("c14_overrides", """
    SELECT c_custkey, CASE WHEN code IS NULL THEN NULL WHEN code = '3' THEN 'WATER STUDIES CENTRE' WHEN code = '5' THEN 'NA'
                           ELSE name END AS name,
           CASE segment WHEN 'BUILDING' THEN 'BLD' WHEN 'AUTOMOBILE' THEN 'AUT' END AS short
    FROM (SELECT c_custkey, nullif(CAST(c_nationkey AS VARCHAR), '7') AS code, n_name AS name, c_mktsegment AS segment
          FROM customer JOIN nation ON c_nationkey = n_nationkey)""")
def c14_overrides(t):
    """Names replaced by code, the later entry wins, a missing code erases the name; short forms."""
    rows = left_lookup(t.customer, t.nation, {"c_nationkey": "n_nationkey"}, {"n_name": "name"})
    code = F.nullif(F.col("c_nationkey").cast("string"), F.lit("7"))
    pairs = [("3", "WATER STUDIES CENTRE"), ("5", "MUSIC TECHNOLOGY"), ("5", "NA")]
    return rows.select("c_custkey", override(code, "name", pairs).alias("name"),
                       abbreviate("c_mktsegment", {"BUILDING": "BLD", "AUTOMOBILE": "AUT"}).alias("short"))


_CAPS = {
    "limits": f"""SELECT l_orderkey, sum({D("CASE WHEN l_returnflag = 'A' THEN l_extendedprice END")}) AS medical,
        sum({D("CASE WHEN l_returnflag = 'N' THEN l_extendedprice END")}) AS subbach FROM lineitem GROUP BY 1""",
    "capped": f"""SELECT o_orderkey, f, medical, subbach, CASE WHEN f >= medical THEN medical WHEN f < medical THEN f END AS p1,
        CASE WHEN f >= subbach THEN subbach WHEN f < subbach THEN f END AS p2
        FROM (SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN {D('o_totalprice')} END AS f FROM orders)
        LEFT JOIN limits ON o_orderkey = l_orderkey""",
}


def _capped(t):
    def part(flag):
        return F.sum(load(F.when(F.col("l_returnflag") == flag, F.col("l_extendedprice"))))
    limits = t.lineitem.groupBy("l_orderkey").agg(part("A").alias("medical"), part("N").alias("subbach"))
    rows = left_lookup(t.orders.select("o_orderkey", F.when(F.col("o_orderstatus") != "P", load("o_totalprice")).alias("f")),
                       limits, {"o_orderkey": "l_orderkey"}, {"medical": "medical", "subbach": "subbach"})
    rows = rows.withColumns({"p1": cap("f", "medical"), "p2": cap("f", "subbach")})
    return rows.withColumn("rest", remainder("f", [("medical", "p1"), ("subbach", "p2")]))


@register("c15_cap_remainder", """
    SELECT o_orderkey, CAST(p1 AS DOUBLE) AS p1, CAST(p2 AS DOUBLE) AS p2,
           CAST(CASE WHEN medical IS NULL AND subbach IS NULL THEN f WHEN medical IS NOT NULL THEN f - p1 ELSE f - p2 END AS DOUBLE) AS rest
    FROM capped""", _CAPS)
def c15_cap_remainder(t):
    """Capped parts and the remainder after the first part that applies."""
    return _capped(t).select("o_orderkey", "p1", "p2", "rest")


@register("x4_round_half_even", f"""
    SELECT l_orderkey, l_linenumber, {half_even(f"{D('l_quantity')} * 0.125 - {D('l_discount')} * 0.5")} AS error
    FROM lineitem""")
def x4_round_half_even(t):
    """Signed error at two places, ties to even: eighths give many ties."""
    eighth, half = F.lit("0.125").cast("decimal(4,3)"), F.lit("0.5").cast("decimal(2,1)")
    return t.lineitem.select("l_orderkey", "l_linenumber",
                             signed_error(load("l_quantity") * eighth, load("l_discount") * half).alias("error"))


@register("x7_pct_error", """
    SELECT o_orderkey, CAST(forecast - actual AS DOUBLE) AS error,
           CASE WHEN actual <> 0 THEN 'number' WHEN forecast > actual THEN 'Inf' WHEN forecast < actual THEN '-Inf' ELSE 'NaN' END AS kind,
           CASE WHEN actual <> 0 THEN round_even(CAST((forecast - actual) * 100 AS DOUBLE) / CAST(actual AS DOUBLE), 2) END AS pct
    FROM order_errors""", _ORDER_ERRORS)
def x7_pct_error(t):
    """Percentage error with infinite and undefined cases told apart."""
    rows = _order_errors(t).withColumn("error", signed_error("forecast", "actual"))
    value = pct("error", "actual")
    kind = classify([(F.isnan(value), "NaN"), (value == float("inf"), "Inf"), (value == float("-inf"), "-Inf")], "number")
    return rows.select("o_orderkey", "error", kind.alias("kind"), F.when(kind == "number", value).alias("pct"))


# --- checks ---------------------------------------------------------------------------

_CHECKS = {
    "wide": """SELECT *, CASE WHEN medical IS NULL AND subbach IS NULL THEN f WHEN medical IS NOT NULL THEN f - p1 ELSE f - p2 END AS p3 FROM capped""",
    "long": "SELECT part, load FROM (UNPIVOT (SELECT p1, p2, p3 FROM wide) ON p1, p2, p3 INTO NAME part VALUE load)",
    "checks": """
      SELECT 'rows' AS check_name, (SELECT count(*) FROM lineitem) AS expected, (SELECT count(*) FROM lineitem JOIN orders ON l_orderkey = o_orderkey) AS actual
      UNION ALL SELECT 'kept:f', (SELECT sum(CASE WHEN o_orderstatus <> 'P' THEN CAST(o_totalprice AS DECIMAL(18,4)) END) FROM orders), (SELECT sum(f) FROM wide)
      UNION ALL SELECT 'parts', (SELECT sum(f) FROM wide), (SELECT sum(coalesce(p1, 0)) + sum(coalesce(p2, 0)) + sum(coalesce(p3, 0)) FROM wide)
      UNION ALL SELECT 'long:' || part, sum(load), sum(load) FROM long GROUP BY part""",
}


@register("k_reconcile", """
    SELECT check_name, CAST(expected AS DOUBLE) AS expected, CAST(actual AS DOUBLE) AS actual,
           CAST(actual - expected AS DOUBLE) AS difference, expected = actual AS ok FROM checks""", {**_CAPS, **_CHECKS})
def k_reconcile(t):
    """Row counts, control totals, conservation and group totals as one report."""
    rows = _capped(t).withColumnRenamed("rest", "p3")
    long = unpivot_drop_null(rows, [], ["p1", "p2", "p3"], "part", "load")
    wide = rows.unpivot([], ["p1", "p2", "p3"], "part", "load")
    source = t.orders.select(F.when(F.col("o_orderstatus") != "P", load("o_totalprice")).alias("f"))
    reports = [row_checks("rows", S.order_lines(t), [t.lineitem]), reconcile("kept", source, rows, ["f"]),
               conservation_check("parts", rows, "f", ["p1", "p2", "p3"]),
               group_checks("long", wide, long, "part", "load")]
    out = reports[0]
    for report in reports[1:]:
        out = out.unionByName(report)
    return out
