"""Joins in which a missing key matches a missing key.

`<=>` on each key is still an equi join for Catalyst, so these plan as hash or
sort-merge joins. No broadcast is forced: the size check behind
`spark.sql.autoBroadcastJoinThreshold` and adaptive execution decide, and
adaptive execution splits skewed partitions where the join type allows it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Key = str | tuple[str, str]
_RIGHT = "__right_"


def _pairs(keys: Sequence[Key]) -> list[tuple[str, str]]:
    return [(k, k) if isinstance(k, str) else k for k in keys]


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[Key],
                   how: str = "left") -> DataFrame:
    """Join on named keys with missing equal to missing.

    The result has the left columns, then the right columns that are not keys.
    For full and right joins the key columns are filled from the right side.
    """
    if how not in {"left", "right", "full", "inner", "left_semi", "left_anti"}:
        raise ValueError(f"unsupported join type {how!r}")
    one_sided = how in {"left_semi", "left_anti"}
    pairs = _pairs(keys)
    right_keys = list(dict.fromkeys(r for _, r in pairs))
    extra = [] if one_sided else [c for c in right.columns if c not in right_keys]
    clash = set(extra) & set(left.columns)
    if clash:
        raise ValueError(f"columns on both sides that are not keys: {sorted(clash)}")
    side = right.selectExpr(*[f"`{r}` AS `{_RIGHT}{r}`" for r in right_keys],
                            *[f"`{c}`" for c in extra])
    on = F.expr(" AND ".join(f"`{lk}` <=> `{_RIGHT}{rk}`" for lk, rk in pairs))
    joined = left.join(side, on, how)
    if one_sided:
        return joined
    source = dict(pairs) if how in {"right", "full"} else {}
    fill = "`{0}`" if how == "right" else "coalesce(`{1}`, `{0}`)"
    return joined.selectExpr(
        *[fill.format(_RIGHT + source[c], c) + f" AS `{c}`" if c in source else f"`{c}`"
          for c in left.columns],
        *[f"`{c}`" for c in extra])


def natural_join(left: DataFrame, right: DataFrame, how: str = "left") -> DataFrame:
    """Null-safe join on every column name the two sides share."""
    shared = [c for c in left.columns if c in set(right.columns)]
    if not shared:
        raise ValueError("the two sides share no column")
    return null_safe_join(left, right, shared, how)


def left_lookup(fact: DataFrame, dim: DataFrame, on: dict[str, str],
                take: dict[str, str]) -> DataFrame:
    """Left join a dimension on equal codes and take some of its columns.

    `on` maps fact column to dimension column and `take` maps dimension column
    to output name, so one dimension can be joined several times in different
    roles. A missing code matches nothing, as in SQL. An output name that the
    fact has already raises an error.
    """
    clash = set(take.values()) & set(fact.columns)
    if clash:
        raise ValueError(f"columns that the fact has already: {sorted(clash)}")
    codes = list(dict.fromkeys(on.values()))
    side = dim.selectExpr(*[f"`{c}` AS `{_RIGHT}{c}`" for c in codes],
                          *[f"`{c}` AS `{name}`" for c, name in take.items()])
    cond = F.expr(" AND ".join(f"`{f}` = `{_RIGHT}{d}`" for f, d in on.items()))
    return fact.join(side, cond, "left").drop(*[_RIGHT + c for c in codes])
