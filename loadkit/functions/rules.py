"""Classification rules as column expressions."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from loadkit.config import BUCKET, NO_LOCATION, PlanningRules
from loadkit.functions.nulls import as_column



def classify(rules: Iterable[tuple[Column, Column | str]], default: Column | str | None = None) -> Column:
    """First matching rule wins; without a default the result is missing."""
    def value(v):
        return v if isinstance(v, Column) else F.lit(v)

    (first, label), *rest = list(rules)
    out = reduce(lambda acc, rule: acc.when(rule[0], value(rule[1])), rest, F.when(first, value(label)))
    return out if default is None else out.otherwise(value(default))


def _lookup(pairs: Mapping[str, str], key: Column) -> Column:
    table = F.create_map(*[F.lit(x) for x in chain.from_iterable(pairs.items())])
    return F.try_element_at(table, key)


def override(code: Column | str, name: Column | str, pairs: Iterable[tuple[str, str]]) -> Column:
    """Replace names by code; the last entry for a code wins, a missing code erases the name."""
    table = dict(pairs)
    c, n = as_column(code), as_column(name)
    if not table:
        return n
    return F.when(c.isNotNull(), F.coalesce(_lookup(table, c), n))


def abbreviate(col: Column | str, table: Mapping[str, str]) -> Column:
    """Short form of a value; missing when the table has none."""
    c = as_column(col)
    return F.when(c.isNotNull(), _lookup(table, c))


def cap(total: Column | str, limit: Column | str) -> Column:
    """The part of `total` up to `limit`; missing when either is missing."""
    t, m = as_column(total), as_column(limit)
    return F.when(m.isNull(), None).when(t >= m, m).when(t < m, t)


def remainder(total: Column | str, caps: Iterable[tuple[Column | str, Column | str]]) -> Column:
    """What is left of `total` after the first part whose limit is present.

    `caps` lists (limit, part) in order of precedence. Later parts are not
    subtracted when an earlier limit is present.
    """
    t = as_column(total)
    pairs = [(as_column(limit), as_column(part)) for limit, part in caps]
    none_present = reduce(lambda a, b: a & b, [limit.isNull() for limit, _ in pairs])
    out = F.when(none_present, t)
    for limit, part in pairs:
        out = out.when(limit.isNotNull(), t - part)
    return out


# --- planning rules ----------------------------------------------------------

def fixed_bucket(fund: Column, rules: PlanningRules) -> Column:
    return classify([(fund.isin(rules.csp, *rules.rtp), "Yes")], "No fixed bucket")


def planning_module(fund: Column, rules: PlanningRules) -> Column:
    return classify([
        (fund == rules.csp, "CSP Planning"),
        (fund == rules.offshore, "Offshore Partner Planning"),
        (fund.isin(*rules.rtp), "RTP Planning"),
    ], "DEMAND Planning")


def home_load(flag: Column, rules: PlanningRules) -> Column:
    return classify([(flag == "Y", rules.institution.home_label)], rules.institution.other_label)


def designation(fund: Column, level: Column, course: Column, rules: PlanningRules) -> Column:
    """Six-way designation; missing for a known CSP fund at any other level."""
    csp = fund == rules.csp
    ug = csp & (level == rules.undergraduate_level)
    designated = (*rules.medical, *rules.sub_bachelor)
    return classify([
        (csp & (level == rules.graduate_level), "CSP Designated GPG"),
        (ug & course.isin(*rules.medical), "CSP Designated Medical UG"),
        (ug & course.isin(*rules.sub_bachelor), "CSP Designated Sub-bachelor UG"),
        (ug & course.isNull(), "CSP Undesignated bucket level UG"),
        (ug & ~course.isin(*designated), "CSP Undesignated course code level UG"),
        (fund != rules.csp, "Non-CSP"),
    ])


def student_type(flag: Column) -> Column:
    """Y/N flag as Commencing/Returning; any other value is missing."""
    return classify([(flag == "Y", "Commencing"), (flag == "N", "Returning")])


def plan_year_label(plan_year: Column, ref_year: int) -> Column:
    """Plan Year 1..5 by distance from the reference year, else missing."""
    offset = plan_year.cast("int") - F.lit(ref_year)
    return F.when(offset.between(1, 5), F.concat(F.lit("Plan Year "), offset.cast("string")))


def year_level_band(level: Column, prefix: str) -> Column:
    """Year-level band; a missing level counts as first year, level 0 has no band."""
    return F.when(level.isNull(), F.lit(f"{prefix}YEAR_1")).when(
        level >= 5, F.lit(f"{prefix}YEAR_5+")).when(
        level.isin(1, 2, 3, 4), F.concat(F.lit(f"{prefix}YEAR_"), level.cast("int").cast("string")))


def bucket_code(course: Column) -> Column:
    return F.coalesce(course, F.lit(BUCKET))


def bucket_description(course: Column, abbreviation: Column) -> Column:
    """Sentinel when the *code* is missing; otherwise the abbreviation, which may be missing."""
    return F.when(course.isNull(), F.lit(BUCKET)).otherwise(abbreviation)


def location(code: Column) -> Column:
    return F.coalesce(code, F.lit(NO_LOCATION))
