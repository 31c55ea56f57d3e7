"""Grouped statistics that stay exact and skew-safe on large groups."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from peakflow.functions.columns import safe_div
from peakflow.functions.joins import null_safe_join, sized
from peakflow.sources.staging import stage


def rsd_by_group(df: DataFrame, keys: list[str], value: str, name: str = "rsd") -> DataFrame:
    """Relative standard deviation: sample standard deviation over mean, NULL for a single value."""
    return df.groupBy(*keys).agg(safe_div(F.stddev_samp(value), F.avg(value)).alias(name))


def weighted_rsd(
    df: DataFrame, keys: list[str], name: str = "rsd", cluster: list[str] | None = None
) -> DataFrame:
    """Relative standard deviation of values given as moments, plus `row_weight`, the weight of all rows.

    A row stands for `frequency` values with this `mean` and (population) `variance`, and for
    `rows` table rows, missing values included. Rows of equal frequency are first reduced to count,
    mean and variance, map-side and numerically stable; only these partial moments are shuffled and
    combined around the overall mean. `cluster` names the keys a following step groups by: laid out by
    them at once, that step needs no shuffle of its own."""
    parts = df.groupBy(*keys, "frequency").agg(
        F.sum("rows").alias("_rows"),
        F.count("mean").alias("_n"),
        F.avg("mean").alias("_mean"),
        (F.var_pop("mean") + F.avg("variance")).alias("_var"),
    )
    if cluster:
        parts = parts.repartition(*cluster)
    group = Window.partitionBy(*keys)
    n = F.col("frequency") * F.col("_n")
    parts = parts.withColumn("_total", F.sum(n).over(group)).withColumn(
        "_overall", safe_div(F.sum(n * F.col("_mean")).over(group), F.col("_total"))
    )
    spread = n * (F.col("_var") + F.pow(F.col("_mean") - F.col("_overall"), 2))
    variance = F.when(F.max("_total") > 1, safe_div(F.sum(spread), F.max("_total") - 1))
    return parts.groupBy(*keys).agg(
        F.sum("_rows").alias("row_weight"),
        safe_div(F.sqrt(variance), F.max("_overall")).alias(name),
    )


def _middle_values(long: DataFrame, keys: list[str], bounds: DataFrame) -> DataFrame:
    """Per group the mean of its middle value(s), looked up between two bounds.

    Values below the lower bound are only counted and values above the upper one dropped, so a
    group's sorted part is the thin slice around its middle. NULL where the slice misses the middle."""
    below = F.lit(float("-inf"))
    slots = null_safe_join(long, bounds, keys, "inner").filter(F.col("_value") <= F.col("_high"))
    slots = slots.groupBy(
        *keys, "_n", F.when(F.col("_value") < F.col("_low"), below).otherwise(F.col("_value")).alias("_slot")
    ).agg(F.count(F.lit(1)).alias("_count"))
    up_to_here = Window.partitionBy(*keys).orderBy("_slot").rowsBetween(Window.unboundedPreceding, 0)
    slots = slots.withColumn("_upto", F.sum("_count").over(up_to_here))

    def value_at(position):
        here = (F.col("_upto") >= position) & (F.col("_upto") - F.col("_count") < position)
        return F.max(F.when(here & (F.col("_slot") != below), F.col("_slot")))

    n = F.col("_n")
    return slots.groupBy(*keys).agg(
        ((value_at(F.floor((n + 1) / 2)) + value_at(F.floor(n / 2) + 1)) / 2).alias("_median")
    )


def median_min_max(
    df: DataFrame, keys: list[str], columns: list[str], accuracy: int = 10_000
) -> DataFrame:
    """Exact interpolated median, minimum and maximum of several columns per group, as
    `<column>_med`, `_min` and `_max`, without gathering a group anywhere.

    One map-side pass takes the ranges and brackets the middle of every group with a mergeable
    quantile sketch; a second pass counts exactly inside the bracket. A group whose bracket misses is
    done over its full range. Groups without any value have NULLs.

    The sketch is written: joined back to the rows it was made of, a cached one is not recognised, so it would be
    made again in every pass, and at an unknown size the rows would be shuffled whole."""
    by = [*keys, "_metric"]
    long = df.unpivot(keys, columns, "_metric", "_value")
    margin = 2.0 / accuracy
    stats = stage(
        long.groupBy(*by).agg(
            F.count("_value").alias("_n"), F.min("_value").alias("_min"), F.max("_value").alias("_max"),
            F.percentile_approx("_value", [0.5 - margin, 0.5 + margin], accuracy).alias("_b"),
        ).select(*by, "_n", "_min", "_max", F.col("_b")[0].alias("_low"), F.col("_b")[1].alias("_high")),
        "ranges",
    )
    values = long.filter(F.col("_value").isNotNull())
    bounds = stats.filter(F.col("_n") > 0).select(*by, "_n", "_low", "_high")
    medians = sized(_middle_values(values, by, bounds))
    missed = medians.filter(F.col("_median").isNull()).select(*by)
    if not missed.isEmpty():
        whole = null_safe_join(bounds, missed, by, "left_semi").withColumns(
            {"_low": F.lit(float("-inf")), "_high": F.lit(float("inf"))}
        )
        medians = medians.filter(F.col("_median").isNotNull()).unionByName(_middle_values(values, by, whole))
    per_metric = null_safe_join(stats.select(*by, "_min", "_max"), medians, by)
    return per_metric.groupBy(*keys).agg(*[
        F.max(F.when(F.col("_metric") == c, F.col(source))).alias(f"{c}_{name}")
        for c in columns
        for name, source in (("med", "_median"), ("min", "_min"), ("max", "_max"))
    ])
