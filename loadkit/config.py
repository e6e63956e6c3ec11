"""Fixed values and per-institution names.

Everything here is data: labels, code lists and name corrections that results
must carry verbatim. Names that identify one institution are parameters
(`Institution`), so a user sets their own.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# --- Fixed values: sentinels -------------------------------------------------
BUCKET = "* Key attribute bucket"
UNCLASSIFIED = "UNCLASSIFIED"
UNALLOCATED = "UNALLOCATED"
NO_LOCATION = "NA"
TOTAL = "TOTAL"

# --- Fixed values: fund sources ----------------------------------------------
CSP = "CSP"
OFFSHORE = "INTERNATIONAL: OFFSHORE PARTNERS"
RTP_DOMESTIC = "RESEARCH TRAINING PROGRAM - DOMESTIC"
RTP_INTERNATIONAL = "RESEARCH TRAINING PROGRAM - INTERNATIONAL"
FIXED_BUCKET_FUNDS = (CSP, RTP_DOMESTIC, RTP_INTERNATIONAL)
DESIGNATED_FUND_CODE = "DETYA"
KEY_FUND_SOURCES = (CSP, "DOM FEE PAY: GPG", "INTERNATIONAL: AUSTRALIA", RTP_DOMESTIC)
FUND_ABBREVIATIONS = {
    "CSP": "CSP",
    "DOM FEE PAY: GPG": "DOM: GPG",
    "INTERNATIONAL: AUSTRALIA": "INT:AUS",
    "RESEARCH TRAINING PROGRAM - DOMESTIC": "RTP:DOM",
}

# --- Fixed values: designated course sets ------------------------------------
MEDICAL_COURSES = ("4531", "4532", "M6011", "M6018")
SUB_BACHELOR_COURSES = ("A0001", "A0501", "A0502", "D0001", "D0501", "D0502")

# --- Fixed values: measure names ---------------------------------------------
CURRENT_LATEST = "Current Actual Latest"
PREVIOUS_LATEST = "Previous year actual latest"
TWO_YEARS_LATEST = "2 year previous actual latest"
THREE_YEARS_LATEST = "3 year previous actual latest"
LAST_YEAR_PIT = "Last year PIT actuals"
PREVIOUS_PLAN = "Previous plan for current year"
PLANNING_FORECAST = "Planning Forecast"
MONITORING_FORECAST = "Monitoring Forecast"
PLAN_YEARS = tuple(f"Plan Year {k}" for k in range(1, 6))
YEAR_BANDS = ("YEAR_1", "YEAR_2", "YEAR_3", "YEAR_4", "YEAR_5+")
CURRENT_BANDS = tuple(f"CURRENT_YEAR_{b}" for b in YEAR_BANDS)
PREVIOUS_BANDS = tuple(f"PREVIOUS_YEAR_{b}" for b in YEAR_BANDS)
NO_MEASURE = "NA"

TEMPLATE_IDS = ("FUND_SOURCE", "FACULTY", "DEGREE_FACULTY", "COURSE_LEVEL", "CAMPUS",
                "UNIT_MODE", "COURSE_CD", "COURSE_DESCRIPTION", "COM_RET", "DESIGNATED_IND")
TEMPLATE_MEASURES = (
    THREE_YEARS_LATEST, TWO_YEARS_LATEST, LAST_YEAR_PIT, *PREVIOUS_BANDS, PREVIOUS_LATEST,
    *CURRENT_BANDS, CURRENT_LATEST, PREVIOUS_PLAN, *PLAN_YEARS,
)
TEMPLATE_ORDER = ("FUND_SOURCE", "FACULTY", "DEGREE_FACULTY", "COURSE_LEVEL", "CAMPUS",
                  "COURSE_CD", "COM_RET", "UNIT_MODE")
ROLLUP_LEVEL = "HDR"

# --- Fixed values: forecast accuracy -----------------------------------------
MONTH_LEVELS = {
    2018: ("March", "June", "July", "September", "November"),
    2019: ("March", "June", "September"),
}
FACULTY_PATTERN = "FACULTY OF"
COURSE_FORECAST_RUNS = (40, 32, 37, 29, 30, 41, 42, 38)
# Applied in order, a later entry wins; the last value is the text NA.
DEPARTMENT_OVERRIDES_FULL = (
    ("50000982", "WATER STUDIES CENTRE"),
    ("50168617", "MUSIC TECHNOLOGY"),
    ("50000766", "DEPARTMENT OF DESIGN"),
    ("50000767", "DEPARTMENT OF FINE ART"),
    ("50000977", "SCH OF MATHEMATICS"),
    ("50001040", "HUDSON DEPT OF MOLECULAR & TRANS SCIENCE"),
    ("50001045", "DEPARTMENT OF NEUROSCIENCE"),
    ("50017828", "DEPARTMENT OF PARAMEDICINE"),
    ("50049270", "DEPARTMENT OF ARCHITECTURE"),
    ("50138873", "PPS EDUCATION"),
    ("50140748", "COMPOSITION & MUSIC TECHNOLOGY"),
    ("50168617", "NA"),
)
DEPARTMENT_OVERRIDES_SHORT = (
    ("50000982", "WATER STUDIES CENTRE"),
    ("50168617", "MUSIC TECHNOLOGY"),
)


def department_overrides(year: int) -> tuple[tuple[str, str], ...]:
    """Name corrections made while aligning forecasts; only the 2018 extracts need them."""
    return DEPARTMENT_OVERRIDES_FULL if year == 2018 else ()


def month_levels(year: int) -> tuple[str, ...]:
    """Forecast months of a year, in report order."""
    return MONTH_LEVELS.get(year, MONTH_LEVELS[2019])


@dataclass(frozen=True)
class Institution:
    """Names that belong to one institution."""

    home_label: str = "Home"
    other_label: str = "Other"
    load_column: str = "HOME_LOAD"
    home_flag: str = "HOME_UNI_IND"
    cluster_column: str = "HOME_CLUSTER"


@dataclass(frozen=True)
class Scope:
    """What the accuracy job leaves out. There are no defaults, as the names belong to one institution.

    `excluded_faculties` holds for the error tables, `outside_totals` for the control totals.
    """

    excluded_campuses: tuple[str, ...]
    excluded_faculties: tuple[str, ...]
    outside_totals: tuple[str, ...]


@dataclass(frozen=True)
class PlanningRules:
    """Values the classification rules compare with."""

    csp: str = CSP
    offshore: str = OFFSHORE
    rtp: tuple[str, ...] = (RTP_DOMESTIC, RTP_INTERNATIONAL)
    medical: tuple[str, ...] = MEDICAL_COURSES
    sub_bachelor: tuple[str, ...] = SUB_BACHELOR_COURSES
    graduate_level: str = "GPG"
    undergraduate_level: str = "UG"
    institution: Institution = field(default_factory=Institution)
