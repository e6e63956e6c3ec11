"""Relational operators with the reference semantics, as DataFrame compositions."""

from loadkit.operators.aggregates import add_total_member, rollup_into, sum_by, sum_numeric
from loadkit.operators.checks import Check, Side, conservation_check, conserved, group_checks, reconcile, report, row_checks
from loadkit.operators.joins import left_lookup, natural_join, null_safe_join
from loadkit.operators.reshape import bind_tagged, pivot_fixed, union_distinct, unpivot_drop_null
from loadkit.operators.slices import align_by_slice
from loadkit.operators.snapshots import (
    latest_by_date, latest_by_id, latest_run, latest_version, point_in_time, resolve_snapshots, run_date)

__all__ = [
    "Check", "Side", "add_total_member", "align_by_slice", "bind_tagged", "conservation_check", "conserved", "group_checks",
    "latest_by_date", "latest_by_id", "latest_run", "latest_version", "left_lookup",
    "natural_join", "null_safe_join", "pivot_fixed", "point_in_time", "reconcile", "report",
    "resolve_snapshots", "rollup_into", "row_checks", "run_date", "sum_by", "sum_numeric", "union_distinct", "unpivot_drop_null",
]
