"""Triple-quad checks: product-ion pairs, ion ratios and quantitative traces."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from peakflow.functions.columns import flag, open_max, open_min, safe_div, skyline_flag_text
from peakflow.functions.joins import null_safe_join, sized
from peakflow.operators.skyline import COMPOUND, flag_columns, skyline_rt_reference, threshold_flags
from peakflow.params import REFERENCE, QcParams, is_corrected

#: Distance up to which two m/z values, unless told otherwise, are the same product ion.
MZ_TOLERANCE = 5e-5

_FRAGMENT = ["replicate_name", COMPOUND, "product_mz"]


def attach_transitions(df: DataFrame, transitions: DataFrame, tolerance: float = MZ_TOLERANCE) -> DataFrame:
    """Add whether a product ion is the quantitative or the secondary trace (NULL: not listed).

    An interval join: bins are as wide as the interval of a listed ion, so it lies in two neighbouring bins at most
    and stands in both; a measured ion has one bin, and the exact distance decides. Nothing depends on
    where bins end. A missing m/z matches a missing one."""
    second, quan = F.col("second_trace"), F.col("quan_trace")
    width = 2 * tolerance or 1.0

    def bin_of(mz):
        return F.floor(mz / F.lit(width))

    mz = F.col("daughter")
    bins = F.when(mz.isNull(), F.array(F.lit(None).cast("bigint"))).otherwise(
        F.array_distinct(F.array(bin_of(mz - tolerance), bin_of(mz), bin_of(mz + tolerance))))
    listed = sized(transitions.select(
        F.col("compound_name").alias("_compound"), mz.alias("_listed"), F.explode(bins).alias("_listed_bin"),
        F.when(quan.isNotNull(), quan != "no").alias("quan_trace"),
        F.when(second.isNotNull(), second != "").alias("second_trace"),
    ))
    measured = F.col("product_mz").cast("double")
    keyed = df.withColumn("_bin", bin_of(measured))
    near = F.col("_listed").isNull() | (F.abs(measured - F.col("_listed")) <= tolerance)
    same = F.col(COMPOUND).eqNullSafe(F.col("_compound")) & F.col("_bin").eqNullSafe(F.col("_listed_bin")) & near
    return keyed.join(listed, same, "left").drop("_bin", "_compound", "_listed", "_listed_bin")


def _checked(
    df: DataFrame, transitions: DataFrame, run_type: str, mode: str, carry: list[str]
) -> DataFrame:
    runs = df.filter(F.col("replicate_name").rlike(run_type)).select(
        "replicate_name", COMPOUND, "area", "precursor_mz", "product_mz", *carry
    )
    pairs = sized(
        runs.select(COMPOUND, "precursor_mz", "product_mz").distinct()
        .groupBy(COMPOUND).agg((F.count(F.lit(1)) != 1).alias("two_fragments"))
    )
    joined = attach_transitions(null_safe_join(runs, pairs, [COMPOUND]), transitions)
    rest = [c for c in joined.columns if c not in _FRAGMENT]
    # One row per fragment: the smallest area that is not missing, reduced map-side.
    first = F.min(F.struct(F.col("area").isNull().alias("_missing"), *rest)).alias("_first")
    rows = joined.groupBy(*_FRAGMENT).agg(first).select(*_FRAGMENT, *[f"_first.{c}" for c in rest])
    is_pair = F.col("two_fragments") & F.col("quan_trace")
    if is_corrected(mode):
        group = Window.partitionBy("replicate_name", COMPOUND)
        quan = F.max(F.when(F.col("quan_trace"), F.col("area"))).over(group)
        second = F.max(F.when(F.col("second_trace"), F.col("area"))).over(group)
        checks = {"qt_five_percent": F.when(is_pair, 0.05 * quan), "_size": second}
    else:
        checks = {"qt_five_percent": F.when(is_pair, 0.05 * F.col("product_mz")), "_size": F.col("product_mz")}
    return rows.withColumns(checks).withColumn(
        "significant_size", F.col("qt_five_percent") < F.col("_size")
    ).drop("_size")


def check_fragments(
    df: DataFrame, transitions: DataFrame, run_type: str, mode: str = REFERENCE
) -> DataFrame:
    """One row per replicate and product ion of a run type, with its trace and pair checks.

    `significant_size` in reference mode compares m/z values; corrected mode tests whether the
    secondary area exceeds 5 % of the quantitative area."""
    return _checked(df, transitions, run_type, mode, []).select(
        "replicate_name", COMPOUND, "precursor_mz", "product_mz", "area", "two_fragments",
        "quan_trace", "second_trace", "qt_five_percent", "significant_size",
    )


def assert_two_fragments(frags: DataFrame, strict: bool = False) -> DataFrame:
    """Compounds with a single product ion; `strict` raises when there are any."""
    offenders = frags.filter(~F.col("two_fragments")).select(COMPOUND).distinct()
    if strict and not offenders.isEmpty():
        raise ValueError("some compounds have fewer than two fragments")
    return offenders


def single_fragment_metric() -> dict[str, Column]:
    """Whether any compound lacks its second product ion, as an aggregate for a pass made anyway."""
    return {"single_fragment": F.bool_or(~F.col("two_fragments"))}


def require_two_fragments(found: dict) -> None:
    if found.get("single_fragment"):
        raise ValueError("some compounds have fewer than two fragments")


def _trace_area(trace: str):
    return F.when(F.col(trace), F.col("area"))


def ion_ratio_reference(frags: DataFrame, mode: str = REFERENCE) -> DataFrame:
    """Range, over the standard replicates, of quantitative area over secondary area."""
    per_replicate = frags.groupBy(COMPOUND, "replicate_name").agg(
        safe_div(F.max(_trace_area("quan_trace")), F.max(_trace_area("second_trace"))).alias("_ratio")
    )
    return per_replicate.groupBy(COMPOUND).agg(
        open_min("_ratio", mode).alias("ir_min"), open_max("_ratio", mode).alias("ir_max")
    )


def _with_ion_ratio(samples: DataFrame, mode: str) -> DataFrame:
    """Corrected: the ratio of each replicate. Reference: that of the first replicate, for all rows."""
    if is_corrected(mode):
        group = Window.partitionBy("replicate_name", COMPOUND)
        ratio = safe_div(
            F.max(_trace_area("quan_trace")).over(group), F.max(_trace_area("second_trace")).over(group)
        )
        return samples.withColumn("ir_ratio", ratio)

    def first(trace: str):
        return F.min_by(F.col("area"), F.when(F.col(trace), F.struct("replicate_name", "product_mz")))

    ratios = sized(samples.groupBy(COMPOUND).agg(
        F.when(F.bool_or("significant_size"), safe_div(first("quan_trace"), first("second_trace"))).alias("ir_ratio")
    ))
    return null_safe_join(samples, ratios, [COMPOUND])


def ion_ratio_flags(
    df: DataFrame, transitions: DataFrame, ir_ref: DataFrame, p: QcParams = QcParams(), mode: str = REFERENCE
) -> DataFrame:
    """Fragments of the sample runs, flagged where the ion ratio leaves the widened range."""
    carry = [c for c in ("protein_name", "retention_time", "background", "height") if c in df.columns]
    samples = _with_ion_ratio(_checked(df, transitions, "Smp", mode, carry), mode)
    ratio = F.col("ir_ratio")
    # fixed value: the label
    off = (ratio < F.col("ir_min") - p.ir_flex) | (ratio > F.col("ir_max") + p.ir_flex)
    return null_safe_join(samples, sized(ir_ref), [COMPOUND]).select(
        "replicate_name", COMPOUND, "precursor_mz", "product_mz", "area", "two_fragments",
        "quan_trace", "second_trace", *carry, flag(off, "IR.Flag").alias("ir_flag"),
    )


def tqs_blank_reference(df: DataFrame, transitions: DataFrame, mode: str = REFERENCE) -> DataFrame:
    """Largest blank area of the quantitative trace; missing areas are ignored."""
    blanks = df.filter(F.col("replicate_name").contains("Blk"))
    return (
        attach_transitions(blanks, transitions).filter("quan_trace").groupBy(COMPOUND)
        .agg(open_max("area", mode).alias("blank_max"))
    )


def tqs_qc(
    df: DataFrame, transitions: DataFrame, p: QcParams = QcParams(), mode: str = REFERENCE, strict: bool = False,
    ion_ratios: DataFrame | None = None,
) -> DataFrame:
    """Flags of the quantitative trace in the sample runs.

    Reference mode returns the published columns; corrected mode adds the area that passed and the
    single flags. `ion_ratios` are the ranges of the standards, where they are known already."""
    if ion_ratios is None:
        standards = check_fragments(df, transitions, "Std", mode)
        assert_two_fragments(standards, strict)
        ion_ratios = ion_ratio_reference(standards, mode)
    samples = ion_ratio_flags(df, transitions, ion_ratios, p, mode)
    samples = samples.filter("quan_trace")
    rt = skyline_rt_reference(df, mode).select(COMPOUND, "rt_min", "rt_max")
    with_ranges = null_safe_join(samples, sized(rt), [COMPOUND])
    with_ranges = null_safe_join(with_ranges, sized(tqs_blank_reference(df, transitions, mode)), [COMPOUND])
    flagged = threshold_flags(with_ranges, p, mode)
    flags = flag_columns(flagged)
    measured = [c for c in ("retention_time", "background", "height") if c in df.columns]
    keys = ["replicate_name", COMPOUND, "precursor_mz", "product_mz", "area"]
    text = skyline_flag_text(flags, mode).alias("all_flags")
    if is_corrected(mode):
        return flagged.select(*keys, "area_with_qc", *measured, text, *flags)
    return flagged.select(*keys, *measured, text)
