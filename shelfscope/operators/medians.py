"""AG-05: exact medians of groups of any size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def exact_median(df: DataFrame, keys: Sequence[str], value: str, name: str) -> DataFrame:
    """The lower median (the value ``percentile_disc(0.5)`` takes) of the known
    values per ``keys``; a group without one has no row.

    Values are counted per (keys, value) with map-side partial counts, so a hot
    group is reduced before its shuffle; the median is the value at which the
    running count reaches half.  Only distinct values are ordered.
    """
    keys = list(keys)
    counts = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("_n"))
    group = Window.partitionBy(*keys)
    rising = group.orderBy(value).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = counts.withColumn("_upto", F.sum("_n").over(rising)).withColumn("_all", F.sum("_n").over(group))
    half = F.when(F.col("_upto") * 2 >= F.col("_all"), F.col(value))
    return ranked.groupBy(*keys).agg(F.min(half).alias(name))


def join_groups(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left join of two frames with one row per ``keys``; null keys meet."""
    right = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    cond = [left[k].eqNullSafe(right[f"_r_{k}"]) for k in keys]
    for c in cond[1:]:
        cond[0] = cond[0] & c
    return left.join(right, cond[0], "left").drop(*[f"_r_{k}" for k in keys])
