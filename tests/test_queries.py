"""Registered queries against their oracle on the smallest tables, and the shape of their plans."""

from pathlib import Path

import pytest

from __spark_entry__ import oracle_sql, queries
from loadkit import config as C
from verification import compare, job_queries, operator_queries, planning_queries

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="the driver's tables are not here")
QUERIES, ORACLE = queries(), oracle_sql()
# The planning queries are long, so one of them stands for all here; the driver runs the rest.
RUN = [*operator_queries.QUERIES, *job_queries.QUERIES, "q4_rollup"]


@pytest.fixture(scope="module")
def oracle():
    con = compare.oracle_connection(SF)
    yield con
    con.close()


def test_every_query_has_an_oracle():
    own = {*operator_queries.QUERIES, *planning_queries.QUERIES, *job_queries.QUERIES}
    assert own <= set(QUERIES) and own <= set(ORACLE)


@pytest.mark.parametrize("name", RUN)
def test_query_equals_oracle(spark, oracle, name):
    ok, account = compare.compare(spark, oracle, QUERIES[name], ORACLE[name], SF)
    assert ok, account


@pytest.mark.parametrize("name", ["a12_total_member", "j10_hot_keys", "j10_per_month_full", "q4_rollup", "q8_reconcile", "q9_two_years",
                                  "q12_q16_error_tables", "s4_sampled_types"])
def test_query_equals_oracle_as_users_run_it(spark, oracle, name):
    """With adaptive execution and generated code, which the other tests leave out for speed."""
    users = {"spark.sql.adaptive.enabled": "true", "spark.sql.codegen.wholeStage": "true", "spark.sql.codegen.factoryMode": "FALLBACK"}
    before = {k: spark.conf.get(k) for k in users}
    try:
        for k, v in users.items():
            spark.conf.set(k, v)
        ok, account = compare.compare(spark, oracle, QUERIES[name], ORACLE[name], SF)
        assert ok, account
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_the_comparison_notices_a_difference(spark, oracle):
    wrong = ORACLE["a7_sum_or_zero"].replace("0.0)", "0.01)")
    assert wrong != ORACLE["a7_sum_or_zero"]
    ok, account = compare.compare(spark, oracle, QUERIES["a7_sum_or_zero"], wrong, SF)
    assert not ok and "missing" in account


@pytest.mark.parametrize("name", ["q4_rollup", "q6_designation_split", "q11_error_base", "j10_per_month_full", "j8_natural_full_nullsafe"])
def test_plan_has_no_cross_join_and_no_python(spark, name):
    plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "ArrowEval", "MapInPandas"):
        assert node not in plan


# Reads of the fact and hash exchanges that really run: what is reused counts once.
@pytest.mark.parametrize("name, reads, exchanges", [
    ("q5_designated_actuals", 1, 6), ("q8_reconcile", 2, 12), ("q1_planned_load", 2, 9), ("q3_totals", 2, 11), ("q4_rollup", 2, 11),
    ("q9_two_years", 3, 6), ("q12_q16_error_tables", 6, 16)])
def test_plan_reads_the_fact_and_shuffles_no_more_than(spark, name, reads, exchanges):
    plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    lines = [line.lstrip(" :+-|") for line in plan.splitlines()]
    assert sum("FileScan parquet" in line and "l_" in line.split("]")[0] for line in lines) <= reads
    assert sum(line.startswith("Exchange hashpartitioning") for line in lines) <= exchanges


def test_cases_are_not_vacuous(spark):
    """The queries meet the cases they are there for."""
    pct = QUERIES["x7_pct_error"](spark, SF)
    assert {r.kind for r in pct.select("kind").distinct().collect()} == {"number", "Inf", "NaN"}
    aligned = QUERIES["q9_align_course"](spark, SF)
    both = aligned.selectExpr("FCAST_EFTSL IS NULL AS no_forecast", "ACTUALS_EFTSL IS NULL AS no_actual").distinct().collect()
    assert {tuple(r) for r in both} == {(True, False), (False, True), (False, False)}
    rolled = QUERIES["q4_rollup"](spark, SF)
    labels = rolled.where(f"COURSE_LEVEL = '{C.ROLLUP_LEVEL}' AND COURSE_CD = '{C.BUCKET}'").select("UNIT_MODE").distinct()
    assert "TOTAL" in {r[0] for r in labels.collect()}
