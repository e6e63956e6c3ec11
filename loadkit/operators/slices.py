"""Aligning a sliced forecast with unsliced actuals."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _q(name: str) -> Column:
    return F.col(f"`{name}`")


def _few(slices: Column, most: int) -> Column:
    """The slices found, or an error when they are no short list of labels."""
    broken = F.raise_error(F.concat(F.lit("more slices than the alignment allows: "), F.size(slices).cast("string")))
    return F.when(F.size(slices) > most, broken.cast("array<string>")).otherwise(slices)


def align_by_slice(forecast: DataFrame, actual: DataFrame, slice_col: str,
                   keys: Sequence[str] | None = None, slice_source: DataFrame | None = None,
                   within: Sequence[str] = (), spread: int = 1, most_slices: int = 1000) -> DataFrame:
    """Full-join every slice of the forecast with all actuals and stack the results.

    `keys` default to the shared columns; missing matches missing. The slice of
    an actual-only row is the slice it was joined in, forecast rows without a
    slice are dropped, and the slices are those found in the forecast. Slices
    are labels such as months; more than `most_slices` distinct ones raise an
    error. `slice_source` is a cheaper frame with the same slices, such as the
    rows the forecast was aggregated from: only its slice column (and the
    `within` columns) are read. `within` names keys, such as a year, whose
    values have slices of their own; an actual row without any slice is dropped.

    The forecast rows of a key are gathered to one row with a list of slices
    and values, so that an actual row meets its key once and fans out to its
    slices, matched or not, only after the join. Give a forecast aggregated to
    its grain, as the callers here do: a list then has as many entries as the
    key has raw variants and slices.

    `spread` is for actuals that are not aggregated, of which one key may hold a
    large part: a key's actual rows are dealt over that many tasks, by a hash of
    the row, and the gathered forecast row is copied to each. Forecast keys
    that no actual row has are found apart, against the distinct keys, which are
    combined before they are shuffled.
    """
    keys = list(keys or [c for c in forecast.columns if c in set(actual.columns)])
    sliced = forecast.where(_q(slice_col).isNotNull())
    f_extra = [c for c in forecast.columns if c not in keys and c != slice_col]
    a_extra = [c for c in actual.columns if c not in keys]

    # One struct key: equality inside a struct treats missing fields as equal.
    key = F.struct(*[_q(k) for k in keys])
    entry = F.struct(_q(slice_col).alias("slice"), F.struct(F.lit(True).alias("present"), *[_q(c) for c in f_extra]).alias("f"))
    gathered = sliced.groupBy(key.alias("__key")).agg(F.collect_list(entry).alias("__held"))

    found = (sliced if slice_source is None else slice_source.where(_q(slice_col).isNotNull()))
    labels = _few(F.collect_set(_q(slice_col).cast("string")), most_slices)
    own = F.struct(F.lit(True).alias("present"), *[_q(c) for c in a_extra]).alias("__a")
    if within:
        scope = F.struct(*[_q(c) for c in within])
        wanted = found.groupBy(scope.alias("__scope")).agg(labels.alias("__wanted"))
        rows = actual.select(key.alias("__akey"), scope.alias("__in"), own)
        right = rows.join(wanted, F.col("__in") == F.col("__scope")).select("__akey", "__a", "__wanted")
    else:
        right = actual.select(key.alias("__akey"), own, found.select(labels).scalar().alias("__wanted"))

    same = F.col("__key") == F.col("__akey")
    if spread == 1:
        joined = gathered.join(right, same, "full")
    else:
        salted = right.withColumn("__salt", F.pmod(F.xxhash64("__a"), F.lit(spread)))
        copies = gathered.withColumn("__copy", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(spread - 1).cast("long"))))
        met = salted.join(copies, same & (F.col("__salt") == F.col("__copy")), "left").drop("__salt", "__copy")
        alone = gathered.join(actual.select(key.alias("__akey")).distinct(), same, "left_anti")
        joined = met.unionByName(alone, allowMissingColumns=True)

    kind = gathered.schema["__held"].dataType.simpleString()
    held = F.coalesce(F.col("__held"), F.array().cast(kind))
    seen = F.transform(held, lambda e: e["slice"].cast("string"))
    unmatched = F.when(F.col("__a.present"), F.array_except(F.col("__wanted"), seen))
    blank = F.lit(None).cast(gathered.schema["__held"].dataType.elementType["f"].dataType)
    slice_type = forecast.schema[slice_col].dataType
    others = F.transform(F.coalesce(unmatched, F.array().cast("array<string>")),
                         lambda s: F.struct(s.cast(slice_type).alias("slice"), blank.alias("f")))
    rows = joined.withColumn("__entry", F.explode(F.concat(held, others)))
    both = F.coalesce(F.col("__key"), F.col("__akey"))
    out = {slice_col: F.col("__entry.slice")} | {k: both.getField(k) for k in keys}
    out |= {c: F.col("__entry.f").getField(c) for c in f_extra}
    order = [*forecast.columns, *a_extra]
    return rows.select(*[(out[c] if c in out else F.col("__a").getField(c)).alias(c) for c in order])
