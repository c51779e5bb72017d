"""Exact percentiles of groups of any size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Groups with more distinct values are narrowed down to the values near the rank first.
SMALL = 10_000
#: Bins that the sketch of a large group divides its distinct values into.
BINS = 200
#: The sketch's quantiles err by at most 1 in so many of the distinct values.
ACCURACY = 10_000


def same_group(by: list[str]) -> Column:
    """Joins columns of `by` with their twins `k_...`, nulls included."""
    found = F.lit(True)
    for c in by:
        found = found & F.col(c).eqNullSafe(F.col(f"k_{c}"))
    return found


def twins(rows: DataFrame, by: list[str], *others: str | Column) -> DataFrame:
    return rows.select(*[F.col(c).alias(f"k_{c}") for c in by], *others)


def brackets(counted: DataFrame, by: list[str], fractions: list[float]) -> DataFrame:
    """`k_...` of `by`, `_low` and `_high` (arrays, one entry a fraction) for groups above SMALL.

    A mergeable sketch cuts the distinct values of a group into BINS bins; the rows of each bin
    are counted, and the bins that hold a fraction's two ranks bound its values. All steps have
    partial results; a group's bins, not its values, come together.
    """
    sizes = counted.groupBy(*by).agg(F.count("_v").alias("_d"), F.sum("_c").alias("_n")).where(F.col("_d") > SMALL)
    large = counted.join(twins(sizes, by, "_n"), same_group(by)).drop(*[f"k_{c}" for c in by])
    at = F.array(*[F.lit(i / BINS) for i in range(1, BINS)])
    cuts = large.groupBy(*by).agg(F.percentile_approx("_v", at, ACCURACY).alias("_cuts"))
    bin_of = F.size(F.filter("_cuts", lambda cut: cut < F.col("_v")))
    binned = large.join(twins(cuts, by, "_cuts"), same_group(by)).groupBy(*by, "_n", bin_of.alias("_bin")).agg(
        F.sum("_c").alias("_c"), F.min("_v").alias("_first"), F.max("_v").alias("_last")
    )
    upto = F.sum("_c").over(Window.partitionBy(*by).orderBy("_bin"))
    ranked = binned.withColumn("_upto", upto)
    low, high = [], []
    for fraction in fractions:
        rank = F.lit(fraction) * (F.col("_n") - 1)
        low.append(F.min(F.when(F.col("_upto") > F.floor(rank), F.col("_first"))))
        high.append(F.min(F.when(F.col("_upto") > F.ceil(rank), F.col("_last"))))
    found = ranked.groupBy(*by).agg(F.array(*low).alias("_low"), F.array(*high).alias("_high"))
    return twins(found, by, "_low", "_high")


def counted_percentiles(
    counted: DataFrame, by: list[str], value: str, count: str, fractions: dict[str, float], total: str | None = None
) -> DataFrame:
    """`by` and one exact percentile per name, from rows that say how often a value occurs.

    `total` names a column for the rows of the group, null values included.

    Interpolates between neighbours as SQL's percentile does. In a group with more than SMALL
    distinct values, all values beyond the bracket of a rank are first put together at its ends,
    which leaves the percentile as it is; so no task orders, or holds, more than a small share
    of such a group's distinct values. Null values do not count; a group without values has
    null percentiles.
    """
    rows = counted.select(*by, F.col(value).cast("double").alias("_v"), F.col(count).alias("_c"))
    near = rows.join(brackets(rows.where("_v IS NOT NULL"), by, list(fractions.values())), same_group(by), "left")
    held = [F.greatest(F.least(F.col("_v"), F.col("_high")[i]), F.col("_low")[i]) for i in range(len(fractions))]
    clipped = {f"_v{i}": F.when(F.col("_v").isNull() | F.col("_low").isNull(), F.col("_v")).otherwise(x) for i, x in enumerate(held)}
    together = near.withColumns(clipped).groupBy(*by, *clipped).agg(F.sum("_c").alias("_c"))
    found = [F.percentile(v, float(f), F.col("_c")).alias(name) for v, (name, f) in zip(clipped, fractions.items(), strict=True)]
    rows_of = [F.sum("_c").alias(total)] if total else []
    return together.groupBy(*by).agg(*rows_of, *found)


def group_percentiles(rows: DataFrame, by: list[str], value: str, fractions: dict[str, float]) -> DataFrame:
    """The same from single rows; equal values of a group are counted, with partial results, first."""
    counted = rows.groupBy(*by, F.col(value).alias("_value")).agg(F.count(F.lit(1)).alias("_rows"))
    return counted_percentiles(counted, by, "_value", "_rows", fractions)
