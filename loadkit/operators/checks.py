"""Reconciliation checks: one row per check with expected, actual, difference, ok.

All checks of a report are conditional aggregates over one tagged frame: the
inputs are stacked with only the values that some check needs, one aggregation
gives one wide row, and that row is turned long. However many checks there are,
every input is read once and one small row per task is shuffled.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

VALUE = "decimal(38,10)"
SCHEMA = ("check_name", "expected", "actual", "difference", "ok")


@dataclass(frozen=True)
class Side:
    """One number of a check: an aggregate over the rows of a frame for which `where` holds.

    `how` is `rows` (a count), `total` (a sum, 0 without values), `sum` (a sum,
    0 without values but missing without rows), or `max`.
    """

    frame: str
    how: str
    value: Column | None = None
    where: Column | None = None


@dataclass(frozen=True)
class Check:
    name: str
    expected: Side
    actual: Side


def _cells(side: Side) -> list[Column]:
    """What a row adds to the side: its value, and whether it counts."""
    true = F.lit(1).cast(VALUE)
    held = true if side.where is None else F.when(side.where, true)
    if side.how == "rows":
        return [held, held]
    value = side.value.cast(VALUE)
    return [value if side.where is None else F.when(side.where, value), held]


def _number(side: Side, k: int) -> Column:
    value, held = F.col(f"v{k}"), F.col(f"h{k}")
    if side.how == "max":
        return F.max(value)
    total = F.coalesce(F.sum(value), F.lit(0).cast(VALUE))
    return F.when(F.count(held) > 0, total) if side.how == "sum" else total


def report(frames: Mapping[str, DataFrame], checks: Sequence[Check]) -> DataFrame:
    """All checks in one pass over the frames that their sides name."""
    sides = [side for check in checks for side in (check.expected, check.actual)]
    none = F.lit(None).cast(VALUE)
    stacked = []
    for name, df in frames.items():
        cells = [_cells(side) if side.frame == name else [none, none] for side in sides]
        stacked.append(df.select(*[c.alias(f"{kind}{k}") for k, pair in enumerate(cells) for kind, c in zip("vh", pair)]))
    wide = reduce(DataFrame.unionAll, stacked).agg(*[_number(side, k).alias(f"n{k}") for k, side in enumerate(sides)])
    rows = [F.struct(F.lit(check.name).alias("check_name"), F.col(f"n{2 * i}").cast(VALUE).alias("expected"),
                     F.col(f"n{2 * i + 1}").cast(VALUE).alias("actual")) for i, check in enumerate(checks)]
    return _judged(wide.select(F.inline(F.array(*rows))))


def _judged(rows: DataFrame) -> DataFrame:
    return rows.select("check_name", "expected", "actual", (F.col("actual") - F.col("expected")).cast(VALUE).alias("difference"),
                       F.col("expected").eqNullSafe(F.col("actual")).alias("ok"))


def row_checks(name: str, joined: DataFrame, parts: Sequence[DataFrame]) -> DataFrame:
    """Rows of a join against the sum of the rows of its inputs."""
    counted = reduce(DataFrame.unionAll, [p.select(F.lit(1).alias("one")) for p in parts])
    return report({"parts": counted, "joined": joined}, [Check(name, Side("parts", "rows"), Side("joined", "rows"))])


def reconcile(name: str, expected: DataFrame, actual: DataFrame, measures: Sequence[str] | Mapping[str, str]) -> DataFrame:
    """Control totals of measures; a mapping gives the actual column for each expected one."""
    pairs = measures if isinstance(measures, Mapping) else {m: m for m in measures}
    return report({"expected": expected, "actual": actual}, [
        Check(f"{name}:{e}", Side("expected", "total", F.col(f"`{e}`")), Side("actual", "total", F.col(f"`{a}`"))) for e, a in pairs.items()])


def conserved(frame: str, name: str, total: str, parts: Sequence[str]) -> Check:
    """The sum of the parts, each 0 where it is missing, against the sum of the total."""
    whole = reduce(lambda a, b: a + b, [F.coalesce(F.col(f"`{p}`").cast(VALUE), F.lit(0).cast(VALUE)) for p in parts])
    return Check(name, Side(frame, "total", F.col(f"`{total}`")), Side(frame, "total", whole))


def conservation_check(name: str, df: DataFrame, total: str, parts: Sequence[str]) -> DataFrame:
    """Sum of the parts against the sum of the total, in one pass."""
    return report({"all": df}, [conserved("all", name, total, parts)])


def group_checks(name: str, expected: DataFrame, actual: DataFrame, group: str, measure: str) -> DataFrame:
    """Totals per group value, whatever values there are; a group on one side only fails the check."""
    label = F.concat(F.lit(f"{name}:"), F.coalesce(F.col(f"`{group}`").cast("string"), F.lit("NA"))).alias("check_name")
    value, none = F.coalesce(F.col(f"`{measure}`").cast(VALUE), F.lit(0).cast(VALUE)), F.lit(None).cast(VALUE)
    rows = expected.select(label, value.alias("e"), none.alias("a")).unionAll(actual.select(label, none.alias("e"), value.alias("a")))
    return _judged(rows.groupBy("check_name").agg(F.sum("e").cast(VALUE).alias("expected"), F.sum("a").cast(VALUE).alias("actual")))
