"""Joins whose physical strategy follows from measured sizes."""

from __future__ import annotations

from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def sized(df: DataFrame) -> DataFrame:
    """Materialise a table that is expected to be small, so that the planner knows its size.

    An aggregate's size is unknown while a plan is built, so a join against it would shuffle the big
    side first. A filled cache reports its true size: below `spark.sql.autoBroadcastJoinThreshold`
    the planner broadcasts it and leaves the big side in place, above it the join stays a shuffle
    join with adaptive skew splitting. Lost cache blocks are recomputed from lineage. A table whose
    plan is cached already is returned as it is."""
    if df.storageLevel.useMemory:
        return df
    df = df.persist(StorageLevel.MEMORY_AND_DISK)
    df.count()
    return df


def null_safe_join(left: DataFrame, right: DataFrame, on: list[str], how: str = "left") -> DataFrame:
    """Equi-join in which a missing key matches a missing key."""
    condition = reduce(
        lambda a, b: a & b, [F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}")) for k in on]
    )
    joined = left.alias("l").join(right.alias("r"), condition, how)
    if how in ("left_semi", "left_anti"):
        return joined
    added = [F.col(f"r.{c}") for c in right.columns if c not in on]
    return joined.select("l.*", *added)


def natural_left_join(left: DataFrame, right: DataFrame) -> DataFrame:
    """Left join on every column name the two sides share."""
    shared = [c for c in left.columns if c in right.columns]
    return null_safe_join(left, right, shared)


def missing_of(df: DataFrame, keys: list[str], value: str, every: DataFrame) -> DataFrame:
    """For every group of rows, the values of a small table that none of its rows has: keys and value.

    A group gathers its different values only, no more than `every` has (the internal standards of a
    dimension); groups that lack none produce nothing, and no grid of groups and values is built."""
    all_values = every.agg(F.collect_set(value)).scalar()
    own = df.groupBy(*keys).agg(F.collect_set(value).alias("_own"))
    return own.select(*keys, F.explode(F.array_except(all_values, "_own")).alias(value))
