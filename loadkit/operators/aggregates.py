"""Sums over numeric columns, total members and roll-ups with replacement."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loadkit.config import TOTAL
from loadkit.functions.nulls import strict_sum, sum_or_zero
from loadkit.schema import numeric_columns


def _q(name: str) -> Column:
    return F.col(f"`{name}`")


def sum_by(df: DataFrame, keys: Sequence[str], value: str, name: str,
           mode: str = "strict") -> DataFrame:
    """Sum of one column per group; `strict` or `skip` missing values."""
    agg = {"strict": strict_sum, "skip": sum_or_zero}[mode]
    return df.groupBy(*keys).agg(agg(_q(value)).alias(name))


def sum_numeric(df: DataFrame, keys: Sequence[str], mode: str = "strict") -> DataFrame:
    """Sum of every numeric column that is not a key."""
    agg = {"strict": strict_sum, "skip": sum_or_zero}[mode]
    return df.groupBy(*keys).agg(*[agg(_q(c)).alias(c) for c in numeric_columns(df, keys)])


def add_total_member(df: DataFrame, keys: Sequence[str], member: str,
                     measures: Sequence[str], label: str = TOTAL,
                     dealt_by: Sequence[str] | None = None, unique: bool = False) -> DataFrame:
    """Append one row per group of the other keys with `member` set to `label`.

    The rows of a group meet in one sort, which gives each of them the sums of its
    group; the first brings the total along. Rows that repeat all keys are summed to one
    before, unless `unique` says that there are none. A total equal to a row that already
    carries the label is the same row and appears once. `dealt_by` names fewer of the other
    keys, if a later step is to group by no more than those, and none of them if `df` is
    dealt already by keys other than `member`.
    """
    others = [k for k in keys if k != member]
    summed = [strict_sum(_q(m)).alias(m) for m in measures]
    kinds = {f.name: f.dataType for f in df.agg(*summed).schema}
    by = others if dealt_by is None else dealt_by
    rows = df.repartition(*[_q(k) for k in by]) if by else df
    rows = rows if unique else rows.groupBy(*[_q(k) for k in keys]).agg(*summed)
    group = Window.partitionBy(*[_q(k) for k in others]).orderBy(_q(member))
    whole = group.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    every = F.count(F.lit(1)).over(whole)
    sums = {f"__sum_{m}": F.when(F.count(_q(m)).over(whole) == every, F.sum(_q(m)).over(whole)).cast(kinds[m]) for m in measures}
    rows = rows.withColumns({"__first": F.row_number().over(group) == 1, **sums})
    own = F.struct(_q(member).cast("string").alias("member"), *[_q(m).cast(kinds[m]).alias(m) for m in measures])
    total = F.struct(F.lit(label).alias("member"), *[_q(f"__sum_{m}").alias(m) for m in measures])
    copies = F.array_compact(F.array(F.when(~own.eqNullSafe(total), own), F.when(F.col("__first"), total)))
    out = rows.withColumn("__copy", F.explode(copies))
    return out.select(*[F.col("__copy").getField("member" if c == member else c).alias(c) if c == member or c in measures else _q(c)
                        for c in df.columns])


def rollup_into(df: DataFrame, where: Column, keys: Sequence[str],
                sentinel: Mapping[str, str], measures: Sequence[str]) -> DataFrame:
    """Sum the rows that satisfy `where` into one sentinel row per group of `keys`.

    The old sentinel rows among them, known by the first entry of `sentinel`,
    are replaced; the other rows stay, equal ones once. The negated condition is
    three-valued: a row for which it is missing is dropped. A row of the subset
    is copied to its roll-up, so one aggregation serves both kinds of row; it
    shuffles nothing if `df` is dealt by some of `keys` already.
    """
    column, value = next(iter(sentinel.items()))
    rolled = F.col("__rolled")
    kept = ~(where & (_q(column) == value))
    yes, no = F.lit(True), F.lit(False)
    copies = (F.when(where & kept, F.array(no, yes)).when(where, F.array(yes))
              .when(kept, F.array(no)))
    rows = df.withColumn("__rolled", F.explode(copies)).withColumns({
        "__row": F.when(~rolled, F.struct(*[_q(m) for m in measures])),
        **{c: F.when(rolled, F.lit(v)).otherwise(_q(c)) for c, v in sentinel.items()}})
    groups = [_q(k) for k in (*keys, *sentinel)]
    out = rows.groupBy(*groups, rolled, "__row").agg(*[strict_sum(_q(m)).alias(m) for m in measures])
    own = F.col("__row")
    return out.select(*[
        F.when(rolled, _q(c)).otherwise(own.getField(c)).alias(c) if c in measures else _q(c)
        for c in df.columns])
