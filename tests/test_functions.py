import math
from decimal import Decimal

import pytest
from conftest import bag
from pyspark.sql import functions as F

from loadkit import config as C
from loadkit.functions import (
    abbreviate, cap, classify, if_else3, not_in, not_infinite, override, paste, pct, remainder, round2,
    safe_ratio, strict_sum, sum_or_zero)
from loadkit.functions import rules as R
from loadkit.schema import as_double, exact, sum_load


def values(df, col):
    return [r[0] for r in df.select(col).collect()]


def test_strict_sum_and_sum_or_zero(frame):
    df = frame("k string, x double", ("a", 1.0), ("a", None), ("b", 2.0), ("b", 3.0), ("c", None))
    out = df.groupBy("k").agg(strict_sum("x").alias("s"), sum_or_zero("x").alias("z"))
    assert bag(out) == [("a", None, 1.0), ("b", 5.0, 5.0), ("c", None, 0.0)]
    empty = df.where("k = 'none'").agg(strict_sum("x"), sum_or_zero("x")).first()
    assert tuple(empty) == (0.0, 0.0)


def test_three_valued_choice(frame):
    df = frame("x string", ("Y",), ("N",), (None,))
    assert values(df, if_else3(F.col("x") == "Y", F.lit("c"), F.lit("r"))) == ["c", "r", None]
    assert values(df, classify([(F.col("x") == "Y", "c")], "r")) == ["c", "r", "r"]


def test_not_in_keeps_or_drops_missing(frame):
    df = frame("x string", ("a",), ("b",), (None,))
    assert values(df, not_in("x", ["a"])) == [False, True, True]
    assert values(df, not_in("x", ["a"], keep_null=False)) == [False, True, False]


def test_half_even_rounding(frame):
    df = frame("x double", (2.5,), (0.125,), (0.285,), (0.375,), (-0.125,))
    assert values(df, F.bround("x", 0))[0] == 2.0
    assert values(df, round2("x"))[1:] == [0.12, 0.28, 0.38, -0.12]


def test_ratio_by_zero(frame):
    df = frame("n double, d double", (1.0, 2.0), (1.0, 0.0), (-1.0, 0.0), (0.0, 0.0), (None, 1.0), (1.0, None))
    got = values(df, safe_ratio("n", "d"))
    assert got[:3] == [0.5, math.inf, -math.inf] and math.isnan(got[3]) and got[4:] == [None, None]
    got = values(df, pct("n", "d"))
    assert got[:3] == [50.0, math.inf, -math.inf] and math.isnan(got[3]) and got[4:] == [None, None]
    assert values(df, not_infinite(safe_ratio("n", "d"))) == [True, False, False, True, True, True]


def test_paste_writes_missing_as_text(frame):
    df = frame("a string, b int", ("x", 1), (None, 2), ("y", None))
    assert values(df, paste("a", "b")) == ["x 1", "NA 2", "y NA"]
    assert values(df, paste("a", "b", sep="")) == ["x1", "NA2", "yNA"]


def test_override_last_entry_wins(frame):
    df = frame("code string, name string", ("50168617", "old"), ("50000982", None), ("1", "kept"), (None, "erased"))
    got = values(df, override("code", "name", C.DEPARTMENT_OVERRIDES_FULL))
    assert got == ["NA", "WATER STUDIES CENTRE", "kept", None]
    assert values(df, override("code", "name", C.DEPARTMENT_OVERRIDES_SHORT))[0] == "MUSIC TECHNOLOGY"
    assert values(df, override("code", "name", ())) == ["old", None, "kept", "erased"]


def test_abbreviate(frame):
    df = frame("f string", ("DOM FEE PAY: GPG",), ("other",), (None,))
    assert values(df, abbreviate("f", C.FUND_ABBREVIATIONS)) == ["DOM: GPG", None, None]


def test_cap_and_remainder(frame):
    df = frame("f double, m double, s double", (10.0, 4.0, None), (3.0, 4.0, None), (10.0, None, 2.0),
               (10.0, 4.0, 2.0), (10.0, None, None), (None, 4.0, None))
    out = df.withColumns({"p": cap("f", "m"), "q": cap("f", "s")})
    out = out.withColumn("rest", remainder("f", [("m", "p"), ("s", "q")]))
    assert [tuple(r) for r in out.select("p", "q", "rest").collect()] == [
        (4.0, None, 6.0), (3.0, None, 0.0), (None, 2.0, 8.0),
        (4.0, 2.0, 6.0),  # both limits: only the first part is subtracted
        (None, None, 10.0), (None, None, None)]


def test_designation_rules(frame):
    df = frame("f string, l string, c string", ("CSP", "GPG", "x"), ("CSP", "UG", "4531"), ("CSP", "UG", "D0502"),
               ("CSP", "UG", None), ("CSP", "UG", "x"), ("CSP", "HDR", "x"), ("FEE", "UG", "4531"), (None, "UG", "x"))
    got = values(df, R.designation(F.col("f"), F.col("l"), F.col("c"), C.PlanningRules()))
    assert got == ["CSP Designated GPG", "CSP Designated Medical UG", "CSP Designated Sub-bachelor UG",
                   "CSP Undesignated bucket level UG", "CSP Undesignated course code level UG", None, "Non-CSP", None]


def test_fund_rules(frame):
    df = frame("f string", ("CSP",), ("RESEARCH TRAINING PROGRAM - DOMESTIC",),
               ("INTERNATIONAL: OFFSHORE PARTNERS",), ("x",), (None,))
    rules = C.PlanningRules()
    assert values(df, R.fixed_bucket(F.col("f"), rules)) == ["Yes", "Yes"] + ["No fixed bucket"] * 3
    assert values(df, R.planning_module(F.col("f"), rules)) == [
        "CSP Planning", "RTP Planning", "Offshore Partner Planning", "DEMAND Planning", "DEMAND Planning"]


def test_horizon_and_band(frame):
    df = frame("y string, l int", ("2019", None), ("2020", 1), ("2024", 5), ("2025", 7), (None, 0))
    assert values(df, R.plan_year_label(F.col("y"), 2019)) == [None, "Plan Year 1", "Plan Year 5", None, None]
    assert values(df, R.year_level_band(F.col("l"), "P_")) == ["P_YEAR_1", "P_YEAR_1", "P_YEAR_5+", "P_YEAR_5+", None]


def test_bucket_description_follows_the_code(frame):
    df = frame("c string, a string", (None, "abbr"), ("x", "abbr"), ("x", None))
    assert values(df, R.bucket_description(F.col("c"), F.col("a"))) == [C.BUCKET, "abbr", None]


def test_loads_are_exact(frame):
    df = frame("x double", (0.1,), (0.2,), (0.07,), (None,), (1e8,), (1 / 3,))
    assert [None if v is None else float(v) for v in values(df, exact(df, "x"))] == [0.1, 0.2, 0.07, None, 1e8, 1 / 3]
    few = df.where("x <> 1 / 3D")
    assert few.agg(as_double(sum_load(few, "x"))).first()[0] == 100000000.37
    assert str(few.agg(sum_load(few, "x")).first()[0]) == "100000000.37000000000000000"
    assert df.where("x IS NULL").agg(sum_load(df, "x")).first()[0] is None


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_no_place_and_no_size_is_lost(spark, frame, ansi):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)

    def total(df):
        return df.agg(sum_load(df, "x")).first()[0]

    try:
        assert str(total(frame("x double", *[(0.00004,)] * 4, (0.08333,)))) == "0.08349000000000000"
        assert str(total(frame("x decimal(18,4)", ("12345678901234.5678",), *[("5000000000000",)] * 3))) == "27345678901234.5678"
        assert total(frame("x decimal(20,14)", *[("0.00000000000004",)] * 5)) == Decimal("2E-13")
        assert total(frame("x decimal(30,28)", *[("0.0000000000000000000000000003",)] * 4)) == Decimal("12E-28")
        assert str(total(frame("x double", *[(1 / 3,)] * 3))) == "0.99999999999999990"
        assert total(frame("x int", (2,), (3,))) == 5 and str(total(frame("x string", ("0.25",), ("1",)))) == "1.25000000000000000"
        # What no 17 places hold must not vanish: too large, too small, not a number.
        for kind, bad in (("double", "1e20D"), ("double", "4e-18D"), ("double", "1.2345678901234567e-3D"), ("double", "double('NaN')"), ("string", "'x'")):
            with pytest.raises(Exception, match="not a load"):
                total(spark.sql(f"SELECT CAST({bad} AS {kind}) AS x"))
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)
