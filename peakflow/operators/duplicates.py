"""Compounds seen in both ion modes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from peakflow.functions.joins import null_safe_join, sized
from peakflow.schema import HILIC_NEGATIVE


def mode_duplicates(df: DataFrame) -> DataFrame:
    """Compounds with at least two rows in one replicate."""
    if "ion_column" not in df.columns:
        raise ValueError("no ion_column: duplicates exist between ion modes only")
    return (
        df.groupBy("metabolite_name", "replicate_name").agg(F.count(F.lit(1)).alias("_n"))
        .filter(F.col("_n") >= 2).select("metabolite_name").distinct()
    )


def mode_duplicate_stats(df: DataFrame) -> DataFrame:
    """Mean and spread of the area of every duplicated compound, per ion mode."""
    duplicated = null_safe_join(df, sized(mode_duplicates(df)), ["metabolite_name"], "left_semi")
    return duplicated.groupBy("metabolite_name", "ion_column").agg(
        F.avg("area_with_qc").alias("means"), F.stddev_samp("area_with_qc").alias("std_devs")
    )


def drop_mode_duplicates(
    df: DataFrame, mode_label: str = HILIC_NEGATIVE, duplicates: DataFrame | None = None
) -> DataFrame:
    """Remove duplicated compounds measured in one ion mode (rows without a mode label go too)."""
    names = sized((mode_duplicates(df) if duplicates is None else duplicates).select("metabolite_name"))
    doomed = F.col("l.metabolite_name").eqNullSafe(F.col("r.metabolite_name")) & F.coalesce(
        F.col("l.ion_column") == mode_label, F.lit(True)
    )
    return df.alias("l").join(names.alias("r"), doomed, "left_anti")


def duplicate_report(df: DataFrame, mode_label: str = HILIC_NEGATIVE) -> DataFrame:
    """One line of text per removed compound."""
    return mode_duplicates(df).select(F.concat_ws(" ", "metabolite_name", F.lit(mode_label)).alias("line"))
