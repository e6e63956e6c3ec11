"""Designation split: forecast rows divided into designated parts and a remainder."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadkit import config as C
from loadkit.functions import cap, if_else3, remainder
from loadkit.operators.checks import Check, Side, conserved, report
from loadkit.operators.joins import left_lookup, natural_join, null_safe_join
from loadkit.operators.reshape import unpivot_drop_null
from loadkit.operators.snapshots import latest_by_id
from loadkit.schema import exact, sum_load
from loadkit.sources.writers import publish_csv

FORECAST = "REPORTED_FORECAST_TAUGHT_LOAD"
MEDICAL_LOAD, SUB_BACHELOR_LOAD = "MEDICAL_TAUGHT_LOAD", "SUBBACH_TAUGHT_LOAD"
PARTS = ("DESIG_MED_UG", "SUBBACH", "NON_DESIGNATED")
GROUPING = "Desig_Grouping"
SET, LOADS, REPORT_DATE, LABEL_BEFORE = "LOAD_SET", "LOADS", "REPDATE", "LABEL_BEFORE"


def split_keys(institution: C.Institution) -> list[str]:
    """The ten keys on which forecast and actual load meet."""
    return ["TEACHING_FACULTY", "TR_ORG_UNIT_CD", "DEGREE_FACULTY", "FUND_SOURCE_DESCRIPTION",
            "COURSE_LEVEL", "SCA_COORD_CAMPUS", "SUA_LOCATION_CODE", "UNIT_MODE",
            "COMMENCING_STUDENT_IND", institution.cluster_column]


def designated_loads(unit_load: DataFrame, aggregation_control: DataFrame,
                     cluster_translation: DataFrame, degree_faculty: DataFrame,
                     funding_source: DataFrame, sets: Mapping[str, Sequence[str]],
                     as_of: date, fund_code: str = C.DESIGNATED_FUND_CODE,
                     institution: C.Institution | None = None) -> DataFrame:
    """Actual loads of several course sets in the newest snapshot of the year of `as_of`, one row per key.

    `sets` names a load and lists its courses; a course may be in several. All
    sets come from one scan. `LOADS` holds (set, load) of every row that a set
    has for the key: the cluster code is grouped but not shown, so a set may
    have several, as many as there are cluster codes behind the shown one.
    """
    institution = institution or C.Institution()
    snapshot = latest_by_id(aggregation_control, as_of.year)
    codes = ["TEACHING_FACULTY", "TR_ORG_UNIT_CD", "DEGREE_FACULTY_ID", "REFERENCE_YEAR",
             "FUNDING_SOURCE", "COURSE_LEVEL", "SCA_COORD_CAMPUS", "SUA_LOCATION_CD", "UNIT_MODE",
             "COMMENCING_STUDENT_IND", "CLUSTER_TRANSLATION_ID"]
    course = F.col("COURSE_CD")
    every = sorted({c for courses in sets.values() for c in courses})
    wanted = (F.col("SNAPSHOT_ID") == snapshot) & course.isin(*every) & (F.col("FUNDING_SOURCE") == fund_code)
    of_sets = F.array_compact(F.array(*[F.when(course.isin(*courses), F.lit(name)) for name, courses in sets.items()]))
    fact = (unit_load.where(wanted).withColumn(SET, F.explode(of_sets)).groupBy(*codes, SET)
            .agg(sum_load(unit_load, "EFTSL").alias("EFTSL")))
    fact = left_lookup(fact, cluster_translation,
                       {"CLUSTER_TRANSLATION_ID": "CLUSTER_TRANSLATION_ID"},
                       {"CLUSTER_CD": "CLUSTER_CD", "CLUSTER_SUBGROUP": institution.cluster_column})
    fact = left_lookup(fact, degree_faculty,
                       {"DEGREE_FACULTY_ID": "DEGREE_FACULTY_ID", "REFERENCE_YEAR": "REFERENCE_YEAR"},
                       {"DEGREE_FACULTY_NAME": "DEGREE_FACULTY"})
    fact = left_lookup(fact, funding_source, {"FUNDING_SOURCE": "FUNDING_SOURCE"},
                       {"DESCRIPTION": "FUND_SOURCE_DESCRIPTION"})
    keys = split_keys(institution)
    # Dealt by the shown key, both groupings below need no shuffle of their own.
    named = fact.withColumnRenamed("SUA_LOCATION_CD", "SUA_LOCATION_CODE").repartition(*keys)
    grouped = named.groupBy(*keys, "CLUSTER_CD", SET).agg(F.sum("EFTSL").alias("LOAD"))
    return (grouped.groupBy(*keys).agg(F.collect_list(F.struct(SET, "LOAD")).alias(LOADS))
            .withColumn(REPORT_DATE, F.lit(as_of.strftime("%m-%d-%Y"))))


def _of_set(name: str) -> Column:
    return F.filter(F.col(LOADS), lambda held: held[SET] == name)


def loads_of_set(loads: DataFrame, name: str) -> DataFrame:
    """The rows of one set, its load named like the set."""
    keys = [c for c in loads.columns if c not in (LOADS, REPORT_DATE)]
    return loads.withColumn("held", F.explode(_of_set(name))).select(*keys, F.col("held.LOAD").alias(name), REPORT_DATE)


def side_by_side(loads: DataFrame, names: Sequence[str]) -> DataFrame:
    """Every set's load in a column: a full join of the sets on key and report date, without a join.

    A key that several sets repeat gives every combination, as the join does.
    """
    keys = [c for c in loads.columns if c not in (LOADS, REPORT_DATE)]
    out = loads
    for k, name in enumerate(names):
        out = out.withColumn(f"held{k}", F.explode_outer(_of_set(name)))
    return out.select(*keys, REPORT_DATE, *[F.col(f"held{k}.LOAD").alias(name) for k, name in enumerate(names)])


def designated_actuals(unit_load: DataFrame, aggregation_control: DataFrame,
                       cluster_translation: DataFrame, degree_faculty: DataFrame,
                       funding_source: DataFrame, courses: Sequence[str], load_name: str,
                       as_of: date, fund_code: str = C.DESIGNATED_FUND_CODE,
                       institution: C.Institution | None = None) -> DataFrame:
    """Actual load of one course set; keys may repeat."""
    return loads_of_set(designated_loads(unit_load, aggregation_control, cluster_translation, degree_faculty, funding_source,
                                         {load_name: courses}, as_of, fund_code, institution), load_name)


def combine_actuals(medical: DataFrame, sub_bachelor: DataFrame) -> DataFrame:
    """Both loads side by side: full join on every shared column, report date included."""
    return natural_join(medical, sub_bachelor, "full")


def designation_split(forecast: DataFrame, actuals: DataFrame,
                      institution: C.Institution | None = None) -> DataFrame:
    """Forecast rows with capped parts and the remainder, still wide.

    Actual keys that repeat multiply the forecast row; `split_checks` reports it.
    """
    keys = split_keys(institution or C.Institution())
    typed = forecast.withColumn(FORECAST, exact(forecast, FORECAST))
    joined = null_safe_join(typed, actuals.drop(REPORT_DATE), keys, "left")
    medical, sub_bachelor, rest = PARTS
    return joined.withColumns({
        medical: cap(FORECAST, MEDICAL_LOAD),
        sub_bachelor: cap(FORECAST, SUB_BACHELOR_LOAD),
    }).withColumn(rest, remainder(FORECAST, [(MEDICAL_LOAD, medical),
                                             (SUB_BACHELOR_LOAD, sub_bachelor)]))


def split_to_long(split: DataFrame) -> DataFrame:
    """One row per forecast row and present part."""
    ids = [c for c in split.columns
           if c not in (*PARTS, FORECAST, MEDICAL_LOAD, SUB_BACHELOR_LOAD)]
    return unpivot_drop_null(split, ids, PARTS, GROUPING, FORECAST)


def designation_export(long: DataFrame, csp: str = C.CSP, graduate_level: str = "GPG", label_before: str | None = None) -> DataFrame:
    """Blanks filled and graduate load relabelled.

    The relabelling condition is three-valued: a row without a course level
    whose fund is the one tested loses its label. `label_before` names a column
    that keeps the label as it was.
    """
    if label_before:
        long = long.withColumn(label_before, F.col(GROUPING))
    filled = long.withColumns({
        "SUA_LOCATION_CODE": F.coalesce("SUA_LOCATION_CODE", "SCA_COORD_CAMPUS"),
        "FUND_SOURCE": F.coalesce("FUND_SOURCE", F.lit(C.UNALLOCATED)),
        "FUND_SOURCE_DESCRIPTION": F.coalesce("FUND_SOURCE_DESCRIPTION", F.lit(C.UNALLOCATED)),
    })
    graduate = (F.col("FUND_SOURCE_DESCRIPTION") == csp) & (F.col("COURSE_LEVEL") == graduate_level)
    return filled.withColumn(GROUPING, if_else3(graduate, F.lit("DESIGNATED_GPG"), F.col(GROUPING)))


def _day(when: Column) -> Column:
    return F.date_format(when, "yyyyMMdd").cast("long")


def snapshot_date(aggregation_control: DataFrame, as_of: date) -> DataFrame:
    """One row: the date of the snapshot that `designated_loads` uses; without a row if the year has none."""
    used = latest_by_id(aggregation_control, as_of.year)
    return aggregation_control.where((F.col("REFERENCE_YEAR") == as_of.year) & (F.col("SNAPSHOT_ID") == used)).select("SNAPSHOT_DATE")


def split_checks(forecast: DataFrame, medical: DataFrame, sub_bachelor: DataFrame,
                 actuals: DataFrame, split: DataFrame, long: DataFrame, final: DataFrame,
                 as_of: date, csp: str = C.CSP, graduate_level: str = "GPG",
                 snapshot: DataFrame | None = None) -> DataFrame:
    """All checks of the job in one pass, one row per check.

    `final` may carry the label before the relabelling in `LABEL_BEFORE`; its rows then stand for those of `long` as well,
    which is not computed. `run date` holds the latest report date of the actuals, and `snapshot date`
    the date of the snapshot they were taken from (see `snapshot_date`), against
    the date of the run; both are yyyymmdd numbers.
    """
    graduate = (F.col("FUND_SOURCE_DESCRIPTION") == csp) & (F.col("COURSE_LEVEL") == graduate_level)
    load, label = F.col(FORECAST), F.col(GROUPING)
    carried = LABEL_BEFORE in final.columns
    source, before = ("final", F.col(LABEL_BEFORE)) if carried else ("long", label)
    frames = {"medical": medical, "subbach": sub_bachelor, "parts": medical.select(REPORT_DATE).unionByName(sub_bachelor.select(REPORT_DATE)),
              "actuals": actuals, "forecast": forecast.withColumn(FORECAST, exact(forecast, FORECAST)), "split": split, "long": long,
              "final": final, "run": forecast.sparkSession.range(1).select(F.lit(int(as_of.strftime("%Y%m%d"))).alias("day"))}
    run = Side("run", "max", F.col("day"))
    checks = [
        Check("rows of combined actuals", Side("parts", "rows"), Side("actuals", "rows")),
        Check(f"combined:{MEDICAL_LOAD}", Side("medical", "total", F.col(MEDICAL_LOAD)), Side("actuals", "total", F.col(MEDICAL_LOAD))),
        Check(f"combined:{SUB_BACHELOR_LOAD}", Side("subbach", "total", F.col(SUB_BACHELOR_LOAD)),
              Side("actuals", "total", F.col(SUB_BACHELOR_LOAD))),
        Check("run date", run, Side("actuals", "max", _day(F.to_date(REPORT_DATE, "MM-dd-yyyy")))),
        Check(f"forecast kept by join:{FORECAST}", Side("forecast", "total", load), Side("split", "total", load)),
        conserved("split", "parts equal forecast", FORECAST, PARTS),
        *[Check(f"long equals wide:{part}", Side("split", "sum", F.col(part)), Side(source, "sum", load, before == part)) for part in PARTS],
        Check("relabelled:DESIGNATED_GPG", Side("forecast", "sum", load, graduate), Side("final", "sum", load, label == "DESIGNATED_GPG")),
        *[Check(f"unchanged:{part}", Side(source, "sum", load, before == part), Side("final", "sum", load, label == part)) for part in PARTS[:2]],
    ]
    if carried:
        frames.pop("long")
    if snapshot is not None:
        frames["snapshot"] = snapshot
        checks.append(Check("snapshot date", run, Side("snapshot", "max", _day(F.col("SNAPSHOT_DATE")))))
    return report(frames, checks)


def export_name(final: DataFrame, prefix: str,
                column: str = "CURR_YR_FORECAST_DATE") -> str:
    """Output name built from the forecast date in the data: the smallest, so that it is stable."""
    stamp = final.agg(F.min(column)).first()[0]
    return f"{prefix} {'NA' if stamp is None else stamp} w Des_Ind - blank fix required.csv"


def write_export(final: DataFrame, folder: str, prefix: str, na: str = "") -> str:
    """The export as one sorted CSV named after its forecast date; the split runs once."""
    keys = [c for c in split_keys(C.Institution()) if c in final.columns]
    return publish_csv(final, folder, lambda rows: export_name(rows, prefix), na, order=[*keys, GROUPING])
