"""Planning template: measures from plans, actuals and forecasts, one row per bucket.

Physical design. Every fact is read once and summed by its raw codes before any
join, so the dimension joins, the classification and the later shuffles work on
bucket-sized data however large the facts are. All measures are then dealt once, by
keys that are shown as they are, and grouped and freed of doubles where they are. A course
has a row for each of its descriptions; those are joined last, when the rows are fewest. The seven measures taken from
the actuals are roles of one scan: a pre-aggregated row is copied to each role
its snapshot has. Loads are summed as exact decimals of their own scale; the templates turn
them into doubles at the very end.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadkit import config as C
from loadkit.functions import rules as R
from loadkit.operators.aggregates import add_total_member, rollup_into
from loadkit.operators.joins import left_lookup
from loadkit.operators.reshape import pivot_fixed, unpivot_drop_null
from loadkit.operators.snapshots import latest_run, latest_version, resolve_snapshots, run_date
from loadkit.schema import as_double, exact, sum_load

BUCKET_KEYS = ("YEAR", "FUND", "HOME_FLAG", "FACULTY", "DEGREE_FACULTY", "COURSE_LEVEL",
               "CAMPUS", "UNIT_MODE")
# Columns a branch groups by. RAW_* are grouped but not shown, so that two rows
# may look alike; the closing DISTINCT then keeps one of them.
GROUP_KEYS = (*BUCKET_KEYS, "COURSE_CD", "COURSE_DESCRIPTION", "COURSE_LOCATION",
              "DESIGNATED_IND", "PLAN_YEAR", "REVIEWED", "RAW_STUDENT", "RAW_LEVEL", "FAMILY")

# Keys that are shown as they are; together they name a bucket or course closely enough to deal its rows evenly.
DEALT_FIRST_BY = ("YEAR", "FACULTY", "DEGREE_FACULTY", "COURSE_LEVEL", "CAMPUS", "UNIT_MODE", "COURSE_CD", "COURSE_LOCATION",
                  "DESIGNATED_IND", "PLAN_YEAR", "REVIEWED")

FAMILY_PLAN, FAMILY_PREVIOUS_PLAN = "plan", "previous plan"
FAMILY_LEVEL_CURRENT, FAMILY_LEVEL_PREVIOUS = "current level", "previous level"


@dataclass(frozen=True)
class PlanningTables:
    """Input tables of the planning job; columns as in `loadkit.schema.SCHEMAS`."""

    plan_details: DataFrame
    plan_forecast: DataFrame
    unit_load: DataFrame
    forecast_load: DataFrame
    key_attributes_master: DataFrame
    degree_faculty: DataFrame
    funding_source: DataFrame
    course_version: DataFrame
    aggregation_control: DataFrame
    forecast_control: DataFrame


def output_columns(rules: C.PlanningRules) -> list[str]:
    return ["YEAR", "FIXED_BUCKET", "PLANNING_MODULE", "FUND_SOURCE",
            rules.institution.load_column, "FACULTY", "DEGREE_FACULTY", "COURSE_LEVEL", "CAMPUS",
            "UNIT_MODE", "COURSE_CD", "COURSE_DESCRIPTION", "COURSE_LOCATION", "DESIGNATED_IND",
            "PLAN_YEAR", "REVIEWED", "COM_RET", "EFTSL", "MEASURE"]


def _fund(fact: DataFrame, t: PlanningTables) -> DataFrame:
    return left_lookup(fact, t.funding_source, {"FUNDING_SOURCE": "FUNDING_SOURCE"},
                       {"DESCRIPTION": "FUND"})


def _faculties(fact: DataFrame, t: PlanningTables, degree_on: dict[str, str],
               faculty_on: dict[str, str], rules: C.PlanningRules) -> DataFrame:
    """The faculty dimension in its two roles."""
    fact = left_lookup(fact, t.degree_faculty, degree_on,
                       {"DEGREE_FACULTY_NAME": "DEGREE_FACULTY",
                        rules.institution.home_flag: "HOME_FLAG"})
    return left_lookup(fact, t.degree_faculty, faculty_on, {"DEGREE_FACULTY_NAME": "FACULTY"})


def _wide_fact(fact: DataFrame, ids: list[str], commencing: str, returning: str) -> DataFrame:
    """Sum both measures by the raw keys, then go long: half the rows of the other order."""
    summed = fact.groupBy(*ids).agg(*[sum_load(fact, c).alias(c) for c in (commencing, returning)])
    long = unpivot_drop_null(summed, ids, [commencing, returning], "INDICATOR", "EFTSL")
    return long.withColumn("RAW_STUDENT", F.when(F.col("INDICATOR") == commencing, "Y").otherwise("N")).drop("INDICATOR")


def _plans(t: PlanningTables, y: int) -> DataFrame:
    """Long plan rows of last year's buckets: plan years, and last year's plan for the reference year."""
    plan_year = F.col("PLAN_YEAR").cast("int")
    plans = t.plan_details.where(plan_year.between(y, y + 4))
    # Rows of other years' buckets vanish later anyway; without them the sum is of a fraction of the fact.
    of_year = t.key_attributes_master.where(F.col("REFERENCE_YEAR") == y - 1).select("KEY_ATTRIBUTES_MASTER_ID")
    plans = plans.join(of_year, "KEY_ATTRIBUTES_MASTER_ID", "left_semi")
    ids = ["KEY_ATTRIBUTES_MASTER_ID", "COURSE_CD", "SCA_LOCATION_CD", "PLAN_YEAR", "REVIEWED"]
    long = _wide_fact(plans, ids, "COMMENCING_LOAD", "RETURNING_LOAD")
    both = F.array(F.lit(FAMILY_PLAN), F.lit(FAMILY_PREVIOUS_PLAN))
    return long.withColumns({"FAMILIES": F.when(plan_year == y, both).otherwise(F.array(F.lit(FAMILY_PLAN))),
                             "BUCKET_YEAR": F.lit(y - 1)})


def _planning_forecasts(t: PlanningTables, y: int) -> DataFrame:
    """Long planning forecast rows, of buckets of any year."""
    ids = ["KEY_ATTRIBUTES_MASTER_ID", "COURSE_CD", "SCA_LOCATION_CD"]
    long = _wide_fact(t.plan_forecast, ids, "COMMENCING_FORECAST_LOAD", "RETURNING_FORECAST_LOAD")
    return long.withColumns({"PLAN_YEAR": F.lit(str(y)), "REVIEWED": F.lit(C.PLANNING_FORECAST),
                             "FAMILIES": F.array(F.lit(C.PLANNING_FORECAST)), "BUCKET_YEAR": F.lit(None).cast("int")})


def _not_yet() -> Column:
    """The description of a course until its versions are joined."""
    return F.lit(None).cast("string")


def _bucket_rows(long: DataFrame, t: PlanningTables, rules: C.PlanningRules) -> DataFrame:
    """Long plan or forecast rows with bucket, fund, faculty and course columns, one per family.

    A row with a `BUCKET_YEAR` stays only if its bucket is of that year.
    """
    buckets = t.key_attributes_master
    fact = left_lookup(long, buckets, {"KEY_ATTRIBUTES_MASTER_ID": "KEY_ATTRIBUTES_MASTER_ID"}, {
        "REFERENCE_YEAR": "YEAR", "FUNDING_SOURCE": "FUNDING_SOURCE",
        "DEGREE_FACULTY_CD": "DEGREE_FACULTY_CD", "OWNING_FACULTY": "OWNING_FACULTY",
        "COURSE_LEVEL": "COURSE_LEVEL", "SCA_COORD_CAMPUS": "CAMPUS", "UNIT_MODE": "UNIT_MODE"})
    fact = fact.where(F.col("BUCKET_YEAR").isNull() | (F.col("YEAR") == F.col("BUCKET_YEAR")))
    fact = _faculties(_fund(fact, t), t,
                      {"DEGREE_FACULTY_CD": "DEGREE_FACULTY_CD", "YEAR": "REFERENCE_YEAR"},
                      {"OWNING_FACULTY": "DEGREE_FACULTY_CD", "YEAR": "REFERENCE_YEAR"}, rules)
    fact, course = fact.withColumnRenamed("COURSE_CD", "RAW_COURSE"), F.col("RAW_COURSE")
    return fact.withColumns({
        "COURSE_CD": R.bucket_code(course),
        "COURSE_DESCRIPTION": R.bucket_description(course, _not_yet()),
        "COURSE_LOCATION": R.location(F.col("SCA_LOCATION_CD")),
        "RAW_LEVEL": F.lit(None).cast("int"),
        "FAMILY": F.explode("FAMILIES"),
    })


def snapshot_roles(control: DataFrame, y: int, as_of: date) -> list[tuple[str, int, int, bool]]:
    """(family, snapshot id, plan year, by year level) of each measure taken from the actuals.

    A measure whose snapshot does not exist has no role and so no rows.
    """
    found = resolve_snapshots(control, y - 3, y, as_of)
    latest = {k: found[y - k][0] for k in range(4)}
    roles = [
        (C.CURRENT_LATEST, latest[0], y, False),
        (C.PREVIOUS_LATEST, latest[1], y - 1, False),
        (C.TWO_YEARS_LATEST, latest[2], y - 2, False),
        (C.THREE_YEARS_LATEST, latest[3], y - 3, False),
        (C.LAST_YEAR_PIT, found[y - 1][1], y - 1, False),
        (FAMILY_LEVEL_CURRENT, latest[0], y, True),
        (FAMILY_LEVEL_PREVIOUS, latest[1], y - 1, True),
    ]
    return [role for role in roles if role[1] is not None]


def _roles_of(snapshot: Column, roles: list[tuple[str, int, int, bool]]) -> Column:
    """One row per role of the snapshot, from constant arrays."""
    by_id: dict[int, list[Column]] = {}
    for family, sid, plan_year, by_level in roles:
        by_id.setdefault(sid, []).append(F.struct(
            F.lit(family).alias("FAMILY"), F.lit(str(plan_year)).alias("PLAN_YEAR"),
            F.lit(by_level).alias("BY_LEVEL")))
    out = F.lit(None).cast("array<struct<FAMILY:string,PLAN_YEAR:string,BY_LEVEL:boolean>>")
    for sid, items in by_id.items():
        out = F.when(snapshot == sid, F.array(*items)).otherwise(out)
    return F.explode(out)


def _actual_rows(t: PlanningTables, y: int, as_of: date,
                 rules: C.PlanningRules, dedupe_dims: bool) -> DataFrame:
    """All measures taken from the actuals, from one scan of the wanted snapshots."""
    roles = snapshot_roles(t.aggregation_control, y, as_of)
    snapshot = F.col("SNAPSHOT_ID")
    wanted = snapshot.isin(*sorted({sid for _, sid, _, _ in roles}))
    ids = ["SNAPSHOT_ID", "REFERENCE_YEAR", "FUNDING_SOURCE", "DEGREE_FACULTY_ID", "FACULTY_ID",
           "COURSE_CD", "COURSE_LEVEL", "SCA_COORD_CAMPUS", "SCA_LOCATION_CD", "UNIT_MODE",
           "COMMENCING_STUDENT_IND", "NOMINATED_YEAR_LEVEL"]
    fact = t.unit_load.where(wanted).groupBy(*ids).agg(sum_load(t.unit_load, "EFTSL").alias("EFTSL"))
    # The degree faculty is matched by id alone, for rows that have a year.
    fact = fact.withColumns({
        "RAW_COURSE": F.col("COURSE_CD"),
        "DEGREE_KEY": F.when(F.col("REFERENCE_YEAR").isNotNull(), F.col("DEGREE_FACULTY_ID"))})
    degree_on = {"DEGREE_KEY": "DEGREE_FACULTY_ID"}
    if dedupe_dims:
        degree_on["REFERENCE_YEAR"] = "REFERENCE_YEAR"
    fact = _faculties(_fund(fact, t), t, degree_on,
                      {"FACULTY_ID": "DEGREE_FACULTY_ID", "REFERENCE_YEAR": "REFERENCE_YEAR"}, rules)
    role = _roles_of(snapshot, roles)
    return fact.withColumn("ROLE", role).withColumns({
        "YEAR": F.col("REFERENCE_YEAR"),
        "CAMPUS": F.col("SCA_COORD_CAMPUS"),
        "COURSE_DESCRIPTION": _not_yet(),
        "COURSE_LOCATION": R.location(F.col("SCA_LOCATION_CD")),
        "PLAN_YEAR": F.col("ROLE.PLAN_YEAR"),
        "REVIEWED": F.lit("Actuals"),
        "RAW_STUDENT": F.col("COMMENCING_STUDENT_IND"),
        "RAW_LEVEL": F.when(F.col("ROLE.BY_LEVEL"), F.col("NOMINATED_YEAR_LEVEL")),
        "FAMILY": F.col("ROLE.FAMILY"),
    })


def _monitoring_rows(t: PlanningTables, y: int, rules: C.PlanningRules) -> DataFrame:
    """Latest monitoring forecast; it has no course, so the course columns are constants."""
    ids = ["REFERENCE_YEAR", "FUNDING_SOURCE", "DEGREE_FACULTY_ID", "FACULTY_ID", "COURSE_LEVEL",
           "SCA_COORD_CAMPUS", "UNIT_MODE", "COMMENCING_STUDENT_IND"]
    run = latest_run(t.forecast_control)
    fact = (t.forecast_load.where(F.col("FORECAST_CONTROL_ID") == run).groupBy(*ids)
            .agg(sum_load(t.forecast_load, "REPORTED_FORECAST_LOAD").alias("EFTSL")))
    fact = _faculties(_fund(fact, t), t,
                      {"DEGREE_FACULTY_ID": "DEGREE_FACULTY_ID", "REFERENCE_YEAR": "REFERENCE_YEAR"},
                      {"FACULTY_ID": "DEGREE_FACULTY_ID", "REFERENCE_YEAR": "REFERENCE_YEAR"}, rules)
    return fact.withColumns({
        "YEAR": F.col("REFERENCE_YEAR"),
        "CAMPUS": F.col("SCA_COORD_CAMPUS"),
        "RAW_COURSE": F.lit(None).cast("string"),
        "COURSE_CD": F.lit(C.BUCKET),
        "COURSE_DESCRIPTION": F.lit(C.BUCKET),
        "COURSE_LOCATION": F.lit(C.NO_LOCATION),
        "PLAN_YEAR": F.lit(str(y)),
        "REVIEWED": F.lit(C.MONITORING_FORECAST),
        "RAW_STUDENT": F.col("COMMENCING_STUDENT_IND"),
        "RAW_LEVEL": F.lit(None).cast("int"),
        "FAMILY": F.lit(C.MONITORING_FORECAST),
    })


def _measure_name(y: int) -> Column:
    family, level = F.col("FAMILY"), F.col("RAW_LEVEL")
    return (F.when(family == FAMILY_PLAN, R.plan_year_label(F.col("PLAN_YEAR"), y))
            .when(family == FAMILY_PREVIOUS_PLAN, F.lit(C.PREVIOUS_PLAN))
            .when(family == FAMILY_LEVEL_CURRENT, R.year_level_band(level, "CURRENT_YEAR_"))
            .when(family == FAMILY_LEVEL_PREVIOUS, R.year_level_band(level, "PREVIOUS_YEAR_"))
            .otherwise(family))


SHOWN = (*(k for k in GROUP_KEYS if k not in ("FUND", "RAW_STUDENT", "RAW_LEVEL", "FAMILY")),
         "FUND_SOURCE", "COM_RET", "MEASURE")


def _shown(rows: DataFrame, y: int) -> DataFrame:
    """Grouped rows with the raw keys replaced by what is shown of them."""
    fund = F.col("FUND")
    from_plan = F.col("FAMILY").isin(FAMILY_PLAN, FAMILY_PREVIOUS_PLAN, C.PLANNING_FORECAST,
                                     C.MONITORING_FORECAST)
    return rows.withColumns({
        "FUND_SOURCE": F.when(from_plan, fund).otherwise(F.coalesce(fund, F.lit(C.UNCLASSIFIED))),
        "COM_RET": R.student_type(F.col("RAW_STUDENT")),
        "MEASURE": _measure_name(y),
    }).select(*SHOWN, "EFTSL")


def _described(rows: DataFrame, versions: DataFrame, forecast_versions: DataFrame) -> DataFrame:
    """Shown rows with one row for each description of their course; the sentinel's is there already."""
    lookup = F.when(F.col("COURSE_DESCRIPTION").isNull(), F.col("COURSE_CD"))
    names = versions.select(F.col("COURSE_CD").alias("__course"), "ABBREVIATION")
    found = lookup == F.col("__course")
    if forecast_versions is not versions:
        # The planning forecast has version bounds of its own.
        own = forecast_versions.select(F.col("COURSE_CD").alias("__course"), "ABBREVIATION")
        names = names.withColumn("__own", F.lit(False)).unionByName(own.withColumn("__own", F.lit(True)))
        found &= F.col("__own") == F.col("MEASURE").eqNullSafe(F.lit(C.PLANNING_FORECAST))
    return rows.join(names, found, "left").withColumn(
        "COURSE_DESCRIPTION", F.coalesce("COURSE_DESCRIPTION", "ABBREVIATION")).select(*SHOWN, "EFTSL")


def _label(rows: DataFrame, rules: C.PlanningRules) -> DataFrame:
    """Columns that follow from the fund and the home flag, added last to keep keys short."""
    fund = F.col("FUND_SOURCE")
    return rows.withColumns({
        "FIXED_BUCKET": R.fixed_bucket(fund, rules),
        "PLANNING_MODULE": R.planning_module(fund, rules),
        rules.institution.load_column: R.home_load(F.col("HOME_FLAG"), rules),
    }).select(*output_columns(rules))


def planned_load(t: PlanningTables, ref_year: int | None = None, as_of: date | None = None,
                 rules: C.PlanningRules | None = None, set_mode: str = "reference",
                 dedupe_dims: bool = False, forecast_version_date: date | None = None) -> DataFrame:
    """All labelled measures in long form.

    The run date `as_of` is the session's current date unless given, and the
    reference year is its year; both are settled once and hold for all measures.
    `set_mode="reference"` ends with DISTINCT, which also merges two year levels
    of one band that have equal loads; `"exact"` sums them. `dedupe_dims` joins
    the degree faculty on the year too. `forecast_version_date` is the version
    bound of the planning forecast, by default that of the other measures.
    """
    if set_mode not in {"reference", "exact"}:
        raise ValueError(f"unknown set mode {set_mode!r}")
    rules = rules or C.PlanningRules()
    as_of = run_date(t.unit_load.sparkSession, as_of)
    y = as_of.year if ref_year is None else ref_year
    bound = date(y + 5, 1, 1)
    versions = latest_version(t.course_version, bound)
    forecast_versions = (versions if forecast_version_date in (None, bound)
                         else latest_version(t.course_version, forecast_version_date))
    branches = [
        _bucket_rows(_plans(t, y).unionByName(_planning_forecasts(t, y)), t, rules),
        _actual_rows(t, y, as_of, rules, dedupe_dims),
        _monitoring_rows(t, y, rules),
    ]
    # The home flag is grouped by its label, the student flag by its raw value.
    early = {
        "HOME_FLAG": F.when(F.col("HOME_FLAG") == "Y", "Y"),
        "DESIGNATED_IND": R.designation(F.col("FUND"), F.col("COURSE_LEVEL"),
                                        F.col("RAW_COURSE"), rules),
    }
    shaped = [b.withColumns(early).select(*GROUP_KEYS, "EFTSL") for b in branches]
    rows = reduce(lambda a, b: a.unionByName(b), shaped).repartition(*DEALT_FIRST_BY)
    grouped = rows.groupBy(*GROUP_KEYS).agg(F.sum("EFTSL").alias("EFTSL"))
    shown = _shown(grouped, y)
    whole = shown.distinct() if set_mode == "reference" else shown.groupBy(*SHOWN).agg(F.sum("EFTSL").alias("EFTSL"))
    return _label(_described(whole, versions, forecast_versions), rules)


# Keys that neither the totals nor the roll-up change: dealt by these once, pivot, totals and roll-up shuffle no more.
DEALT_BY = tuple(k for k in C.TEMPLATE_IDS if k not in ("UNIT_MODE", "COURSE_CD", "COURSE_DESCRIPTION"))


def _template(planned: DataFrame) -> DataFrame:
    ids, named = list(C.TEMPLATE_IDS), C.TEMPLATE_MEASURES[:-1]
    cells = [*named, C.PLANNING_FORECAST, C.MONITORING_FORECAST, C.NO_MEASURE]
    filled = planned.fillna({"FUND_SOURCE": C.UNCLASSIFIED, "DESIGNATED_IND": "Non-CSP"})
    filled = filled.select(*ids, "MEASURE", exact(filled, "EFTSL").alias("EFTSL")).repartition(*DEALT_BY)
    wide = pivot_fixed(filled, ids, "MEASURE", "EFTSL", cells)
    # Tested before the cells are filled: a condition on the filled cells would be restated by the
    # optimizer for each subset of them as soon as a user filters the template.
    any_load = F.expr(" OR ".join(f"`{c}` <> 0" for c in cells))
    return (wide.where(any_load).fillna(0, subset=cells).withColumn("Plan Year 5", F.col("`Plan Year 4`"))
            .select(*ids, *[f"`{m}`" for m in C.TEMPLATE_MEASURES]))


def _totals(template: DataFrame) -> DataFrame:
    return add_total_member(template, C.TEMPLATE_IDS, "UNIT_MODE", C.TEMPLATE_MEASURES, dealt_by=(), unique=True)


ROLLUP_KEYS = tuple(k for k in C.TEMPLATE_IDS if k not in ("COURSE_CD", "COURSE_DESCRIPTION"))


def _rollup(totals: DataFrame, level: str) -> DataFrame:
    return rollup_into(totals, F.col("COURSE_LEVEL") == level, ROLLUP_KEYS,
                       {"COURSE_CD": C.BUCKET, "COURSE_DESCRIPTION": C.BUCKET},
                       C.TEMPLATE_MEASURES)


def _loads(template: DataFrame) -> DataFrame:
    return template.withColumns({m: as_double(f"`{m}`") for m in C.TEMPLATE_MEASURES})


def planning_template(planned: DataFrame) -> DataFrame:
    """One row per bucket or course, one column per measure, from `planned_load`.

    A bucket stays when any measure is not zero. The two forecasts and the
    measure without a name count for that test, and are dropped after it.
    """
    return _loads(_template(planned))


def template_with_totals(planned: DataFrame) -> DataFrame:
    """Template plus one TOTAL row over the unit modes of each bucket."""
    return _loads(_totals(_template(planned)))


def template_with_rollup(planned: DataFrame, level: str = C.ROLLUP_LEVEL) -> DataFrame:
    """Template with totals in which the courses of one level become one bucket row too."""
    return _loads(_rollup(_totals(_template(planned)), level))


def in_report_order(template: DataFrame) -> DataFrame:
    """Sorted for output, missing values last."""
    return template.orderBy(*[F.col(c).asc_nulls_last() for c in C.TEMPLATE_ORDER])
