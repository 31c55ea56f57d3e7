"""Quality control of long exports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from peakflow.functions.columns import (
    BLANK_ANY_CASE, SAMPLE_OR_POOL, SAMPLE_OR_POOL_ANY_CASE, STANDARD_ANY_CASE, area_with_qc, flag, open_max,
    open_min, outside, run_type, safe_div, skyline_flag_text, strict_max, strict_min,
)
from peakflow.functions.joins import null_safe_join, sized
from peakflow.params import REFERENCE, QcParams, is_corrected

COMPOUND = "precursor_ion_name"


def standard_mix_filter(df: DataFrame, standards: DataFrame, literal: bool = True) -> DataFrame:
    """Standard runs whose replicate name carries the compound's own mix label or the in-matrix label.

    A compound without a mix label keeps its in-matrix rows only. `literal=False` reads the label as
    a regular expression."""
    mixes = sized(standards.select(F.col("compound_name").alias(COMPOUND), "hilic_mix").distinct())
    runs = df.filter(F.col("replicate_name").contains("Std"))
    name, mix = F.col("replicate_name"), F.col("hilic_mix")
    own_mix = name.contains(mix) if literal else F.rlike(name, mix)
    joined = null_safe_join(runs, mixes, [COMPOUND])
    return joined.filter(own_mix | name.rlike("(?i)H2OinMatrix")).drop("hilic_mix")


def keep_own_mixes(df: DataFrame, standards: DataFrame, mode: str = REFERENCE) -> DataFrame:
    """Apply the mix filter to a whole table. Corrected: runs that are no standards stay."""
    kept = standard_mix_filter(df, standards)
    if not is_corrected(mode):
        return kept
    return kept.unionByName(df.filter(~F.coalesce(F.col("replicate_name").contains("Std"), F.lit(False))))


def _rt_range(mode: str) -> dict:
    rt = F.when(F.col("replicate_name").rlike(STANDARD_ANY_CASE), F.col("retention_time"))
    return {"rt_min": open_min(rt, mode), "rt_max": open_max(rt, mode)}


def skyline_rt_reference(df: DataFrame, mode: str = REFERENCE) -> DataFrame:
    """Retention-time range in the standard runs; the mean is an extra of corrected mode."""
    extra = [F.avg("retention_time").alias("rt_reference")] if is_corrected(mode) else []
    return (
        df.filter(F.col("replicate_name").rlike(STANDARD_ANY_CASE)).groupBy(COMPOUND)
        .agg(*[c.alias(n) for n, c in _rt_range(mode).items()], *extra)
    )


def skyline_blank_reference(df: DataFrame, mode: str = REFERENCE) -> DataFrame:
    """Area range in the blanks. Reference: one missing area hides the range."""
    low, high = (F.min, F.max) if is_corrected(mode) else (strict_min, strict_max)
    return (
        df.filter(F.col("replicate_name").rlike(BLANK_ANY_CASE)).groupBy(COMPOUND)
        .agg(low("area").alias("blank_min"), high("area").alias("blank_max"))
    )


def _samples_and_pools(df: DataFrame, pattern: str = SAMPLE_OR_POOL_ANY_CASE) -> DataFrame:
    return df.filter(F.col("replicate_name").rlike(pattern))


def height_table(df: DataFrame, triple_quad: bool = False) -> DataFrame:
    ions = ["precursor_mz", "product_mz"] if triple_quad else []
    pattern = SAMPLE_OR_POOL if triple_quad else SAMPLE_OR_POOL_ANY_CASE
    return _samples_and_pools(df, pattern).select("replicate_name", COMPOUND, *ions, "height")


def area_table(df: DataFrame) -> DataFrame:
    return _samples_and_pools(df).select("replicate_name", COMPOUND, "area")


def signal_to_noise(df: DataFrame) -> DataFrame:
    return _samples_and_pools(df).select(
        "replicate_name", COMPOUND, "area", "background",
        safe_div("area", "background").alias("signal_to_noise"),
    )


def qc_references(df: DataFrame, mode: str = REFERENCE) -> DataFrame:
    """Retention-time and blank ranges of every compound, from one pass over standards and blanks."""
    name = F.col("replicate_name")
    std, blk = name.rlike(STANDARD_ANY_CASE), name.rlike(BLANK_ANY_CASE)
    blank = F.when(blk, F.col("area"))
    n_std, n_blk = F.count(F.when(std, True)), F.count(F.when(blk, True))
    blank_max = F.max(blank) if is_corrected(mode) else F.when(F.count(blank) == n_blk, F.max(blank))
    return df.filter(std | blk).groupBy(COMPOUND).agg(
        *[F.when(n_std > 0, c).alias(n) for n, c in _rt_range(mode).items()],
        blank_max.alias("blank_max"),
    )


def threshold_flags(df: DataFrame, p: QcParams, mode: str = REFERENCE) -> DataFrame:
    """Flags of a table that already carries its ranges rt_min, rt_max and blank_max.

    Signal to noise is judged in samples and pools only, all other flags in every run. Only
    corrected mode judges the blank ratio."""
    flags = {  # fixed values: the labels
        "rt_flag": flag(outside("retention_time", "rt_min", "rt_max", p.rt_flex), "RT.Flag"),
        "height_min_flag": flag(F.col("height") < p.height_min, "height.min.Flag"),
        "overloaded_flag": flag(F.col("height") > p.height_max, "overloaded.Flag"),
        "area_min_flag": flag(F.col("area") < p.area_min, "area.min.Flag"),
        "sn_flag": flag(
            F.col("replicate_name").rlike(SAMPLE_OR_POOL_ANY_CASE)
            & (safe_div("area", "background") < p.sn_min), "SN.Flag",
        ),
    }
    if is_corrected(mode):
        flags["blank_flag"] = flag(safe_div("area", "blank_max") < p.blk_thresh, "Blank.Flag")
    return df.withColumns({"area_with_qc": area_with_qc("area", p.area_min), **flags})


def flag_columns(df: DataFrame) -> list[str]:
    """Columns whose name contains `flag`, in table order."""
    return [c for c in df.columns if "flag" in c.lower()]


def blanks_to_null(df: DataFrame) -> DataFrame:
    """Empty text becomes NULL in every text column."""
    text = [n for n, t in df.dtypes if t == "string"]
    return df.withColumns({c: F.nullif(F.col(c), F.lit("")) for c in text})


def skyline_qc(df: DataFrame, p: QcParams = QcParams(), mode: str = REFERENCE) -> DataFrame:
    """All flags, their text and the area that passed. Every input row comes back once."""
    ranges = sized(qc_references(df, mode))
    flagged = threshold_flags(null_safe_join(df, ranges, [COMPOUND]), p, mode)
    flags = flag_columns(flagged)
    ion = ["ion_column"] if "ion_column" in df.columns else []
    return blanks_to_null(flagged.select(
        "replicate_name", "retention_time", "area", "area_with_qc", COMPOUND, "background", "height",
        "mass_error_ppm", *ion, "rt_min", "rt_max", skyline_flag_text(flags, mode).alias("all_flags"), *flags,
    ))


def to_peaks(qc: DataFrame) -> DataFrame:
    """Rename a quality-controlled long export so that the normalisation steps can read it."""
    named = qc.withColumnsRenamed({COMPOUND: "metabolite_name", "area": "area_value"})
    return named.withColumn("run_type", run_type("replicate_name"))
