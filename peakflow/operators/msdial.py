"""Quality control of wide-export peak tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from peakflow.functions.columns import (
    area_with_qc, flag, msdial_flag_text, open_max, open_min, outside, run_type, safe_div, strict_max, strict_min,
)
from peakflow.functions.joins import null_safe_join, sized
from peakflow.params import REFERENCE, QcParams, is_corrected

PEAK_COLUMNS = (
    "replicate_name", "ion_column", "area_value", "mz_value", "rt_value", "sn_value", "alignment_id", "metabolite_name",
)


def with_run_type(peaks: DataFrame) -> DataFrame:
    kept = [c for c in PEAK_COLUMNS if c in peaks.columns]
    return peaks.select(*kept, run_type("replicate_name").alias("run_type"))


def _rt_range(mode: str) -> dict:
    """Aggregates over standard rows. A detected time of 0 means not detected."""
    rt = F.nullif(F.when(F.col("run_type") == "std", F.col("rt_value")), F.lit(0.0))
    return {"rt_min": open_min(rt, mode), "rt_max": open_max(rt, mode)}


def rt_reference(peaks: DataFrame, mode: str = REFERENCE) -> DataFrame:
    """Retention-time range of every compound in the standard runs."""
    standards = with_run_type(peaks).filter(F.col("run_type") == "std")
    return (
        standards.groupBy("metabolite_name", "run_type")
        .agg(*[c.alias(n) for n, c in _rt_range(mode).items()])
        .withColumn("rt_diff", F.abs(F.col("rt_max") - F.col("rt_min")))
    )


def blank_reference(peaks: DataFrame, mode: str = REFERENCE) -> DataFrame:
    """Area range of every compound in the blanks. Reference: one missing area hides the range."""
    low, high = (F.min, F.max) if is_corrected(mode) else (strict_min, strict_max)
    blanks = with_run_type(peaks).filter(F.col("run_type") == "blk")
    return blanks.groupBy("metabolite_name", "run_type").agg(
        low("area_value").alias("blk_min"), high("area_value").alias("blk_max")
    )


# The flag labels below.


def sn_area_flags(peaks: DataFrame, p: QcParams) -> DataFrame:
    return with_run_type(peaks).withColumns({
        "sn_flag": flag(F.col("sn_value") < p.sn_min, "SN.Flag"),
        "area_min_flag": flag(F.col("area_value") < p.area_min, "Area.Min.Flag"),
    })


def _rt_flag(p: QcParams):
    return flag(outside("rt_value", "rt_min", "rt_max", p.rt_flex), "RT.Flag")


def _blank_flag(p: QcParams):
    return flag(safe_div("area_value", "blk_max") < p.blk_thresh, "Blank.Flag")


def rt_flags(peaks: DataFrame, rt_ref: DataFrame, p: QcParams) -> DataFrame:
    ranges = sized(rt_ref.select("metabolite_name", "rt_min", "rt_max"))
    joined = null_safe_join(peaks, ranges, ["metabolite_name"])
    return joined.withColumn("rt_flag", _rt_flag(p)).drop("rt_min", "rt_max")


def blank_flags(peaks: DataFrame, blank_ref: DataFrame, p: QcParams) -> DataFrame:
    ranges = sized(blank_ref.select("metabolite_name", "blk_max"))
    joined = null_safe_join(peaks, ranges, ["metabolite_name"])
    return joined.withColumn("blank_flag", _blank_flag(p)).drop("blk_max")


def qc_references(peaks: DataFrame, mode: str = REFERENCE) -> DataFrame:
    """Both reference ranges of every compound, from one pass over the standard and blank runs."""
    runs = with_run_type(peaks).filter(F.col("run_type").isin("std", "blk"))
    n_std = F.count(F.when(F.col("run_type") == "std", True))
    n_blk = F.count(F.when(F.col("run_type") == "blk", True))
    blank = F.when(F.col("run_type") == "blk", F.col("area_value"))
    blk_max = F.max(blank) if is_corrected(mode) else F.when(F.count(blank) == n_blk, F.max(blank))
    return runs.groupBy("metabolite_name").agg(
        *[F.when(n_std > 0, c).alias(n) for n, c in _rt_range(mode).items()],
        blk_max.alias("blk_max"),
    )


def msdial_qc(peaks: DataFrame, p: QcParams = QcParams(), mode: str = REFERENCE) -> DataFrame:
    """All flags, their text and the area that passed. Every input row comes back once.

    The ranges are one small row per compound, so the peak table itself is not shuffled."""
    ranges = sized(qc_references(peaks, mode))
    flagged = null_safe_join(sn_area_flags(peaks, p), ranges, ["metabolite_name"]).withColumns({
        "area_with_qc": area_with_qc("area_value", p.area_min),
        "rt_flag": _rt_flag(p),
        "blank_flag": _blank_flag(p),
    })
    flags = ["sn_flag", "area_min_flag", "rt_flag", "blank_flag"]
    ion = ["ion_column"] if "ion_column" in peaks.columns else []
    return flagged.select(
        "replicate_name", *ion, "area_value", "area_with_qc", "mz_value", "rt_value", "sn_value",
        "alignment_id", "metabolite_name", "run_type", *flags,
        msdial_flag_text(flags, mode).alias("all_flags"),
    )
