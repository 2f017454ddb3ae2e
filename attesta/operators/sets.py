"""Set operations on rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from attesta.scale import stored


def symmetric_difference(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows on one side more often than on the other: (row, side, n), from one combined count."""
    cols = a.columns
    both = a.withColumn("__d", F.lit(1)).unionByName(b.withColumn("__d", F.lit(-1)))
    n = both.groupBy(*cols).agg(F.sum("__d").alias("d")).filter("d <> 0")
    return n.select(*cols, F.when(F.col("d") > 0, "a").otherwise("b").alias("side"), F.abs("d").alias("n"))


def in_both(a: DataFrame, b: DataFrame, group: Sequence[str], member: str) -> DataFrame:
    """Groups with a member on both lists."""
    tag = lambda df, x, y: df.select(*group, member, F.lit(x).alias("x"), F.lit(y).alias("y"))
    each = tag(a, True, False).unionByName(tag(b, False, True)).groupBy(*group, member).agg(F.bool_or("x").alias("x"), F.bool_or("y").alias("y"))
    return each.groupBy(*group).agg(F.bool_or(F.col("x") & F.col("y")).alias("reject"))


def cached_merge(cached: DataFrame, fresh: DataFrame, key: Sequence[str]) -> DataFrame:
    """Fresh rows replace cached rows of the same key; the others stay.

    Fresh rows and then their keys are written, so that they are worked out once and no task holds tables of groups and sorted
    rows at the same time.
    """
    fresh = stored(fresh, "fresh-rows")
    keys = stored(fresh.select(*key).distinct(), "fresh-keys")
    return cached.join(keys, list(key), "left_anti").unionByName(fresh)


def coverage(universe: DataFrame, assigned: DataFrame, unit: str, office: str | None = None) -> DataFrame:
    """Units that are not assigned exactly once (per office): unassigned or assigned twice."""
    keys = [unit] + ([office] if office else [])
    n = assigned.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    base = universe.select(*keys).distinct()
    j = base.join(n, keys, "full_outer").fillna(0, ["n"])
    return j.filter("n <> 1").withColumn("problem", F.when(F.col("n") == 0, "unassigned").otherwise("assigned twice"))
