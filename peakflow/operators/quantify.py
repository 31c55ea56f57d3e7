"""From normalised areas to concentrations, carbon and nitrogen totals and mole fractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from peakflow.functions.columns import (
    core_name, finite, formula_atoms, join_parts, safe_div, trim_whitespace,
)
from peakflow.functions.joins import natural_left_join, null_safe_join, sized
from peakflow.functions.stats import median_min_max
from peakflow.params import REFERENCE, QuantifyParams, is_corrected

# Standard run classes.
STANDARDS_WATER, STANDARDS_MATRIX, WATER_MATRIX = "Standards_Water", "Standards_Matrix", "Water_Matrix"

# Patterns that tell a standard mix and a matrix run from plain water.
RUN_CLASS_PATTERNS = {"stds": ("Stds", "Matrix"), "mix": ("StdsMix|InH2O", "InMatrix")}


def known_standards(standards: DataFrame, column_type: str) -> DataFrame:
    """Compounds of one column type with a known concentration."""
    return standards.filter(
        (F.col("column_type") == column_type) & F.col("concentration_um").isNotNull()
    ).select(
        trim_whitespace("compound_name").alias("metabolite_name"), "compound_type", "concentration_um",
        "hilic_mix", "empirical_formula",
    )


def _quantify_columns(qc: DataFrame) -> DataFrame:
    ion = ["ion_column"] if "ion_column" in qc.columns else []
    return qc.select("replicate_name", "metabolite_name", "area_with_qc", "area_value", "run_type", *ion)


def standard_rows(qc: DataFrame, standards: DataFrame, column_type: str) -> DataFrame:
    """Standard runs of known compounds, with the columns of the dimension."""
    runs = _quantify_columns(qc).filter(F.col("replicate_name").contains("Std"))
    known = sized(known_standards(standards, column_type))
    return null_safe_join(runs, known, ["metabolite_name"], "inner").distinct()


def standard_run_types(df: DataFrame, pattern_set: str = "stds") -> DataFrame:
    """Add the standard run class: standards or water, in matrix or in water."""
    standard, matrix = RUN_CLASS_PATTERNS[pattern_set]
    name = F.col("replicate_name")
    return df.withColumn("standard_type", join_parts(
        F.when(name.rlike(standard), "Standards").otherwise("Water"),
        F.when(name.rlike(matrix), "Matrix").otherwise("Water"),
    ))


def response_factors(std: DataFrame, literal: bool = True) -> DataFrame:
    """Area per concentration of every standard row that is no internal standard.

    The replicate name loses its last two characters. With ion modes, only the compound's own mix
    and the in-matrix runs count."""
    rf = std.filter(F.col("compound_type") != "Internal Standard").withColumns({
        "rf": safe_div("area_with_qc", "concentration_um"),
        "replicate_name": F.expr("substring(replicate_name, 1, length(replicate_name) - 2)"),
    })
    if "ion_column" in std.columns:
        name, mix = F.col("replicate_name"), F.col("hilic_mix")
        own_mix = name.contains(mix) if literal else F.rlike(name, mix)
        rf = rf.filter(own_mix | name.contains("H2OInMatrix"))
    return rf


def rf_range(rf: DataFrame) -> DataFrame:
    """Response-factor range of every compound over the standards in water."""
    return rf.filter(F.col("standard_type") == STANDARDS_WATER).groupBy("metabolite_name").agg(
        finite(F.max("rf")).alias("rf_max"), finite(F.min("rf")).alias("rf_min")
    )


def rf_dimensions(rf: DataFrame) -> DataFrame:
    """Standards in water with the range of their compound and its quotient."""
    water = rf.filter(F.col("standard_type") == STANDARDS_WATER)
    ranges = sized(rf_range(rf).withColumn("rf_diff", safe_div("rf_max", "rf_min")))
    return null_safe_join(water, ranges, ["metabolite_name"]).distinct()


def missing_rf(rf: DataFrame) -> DataFrame:
    """Compounds with a standard in water that gives no response factor."""
    return rf.filter(
        (F.col("standard_type") == STANDARDS_WATER) & F.col("rf").isNull()
    ).select("metabolite_name").distinct()


def rf_ratios(rf: DataFrame, mode: str = REFERENCE) -> DataFrame:
    """(standards in matrix - water in matrix) / standards in water, of the mean response factors.

    Reference: for compounds with at least three (replicate, class) rows; corrected: for compounds
    that have all three classes."""
    means = rf.groupBy("metabolite_name", "standard_type").agg(
        F.avg("rf").alias("_mean"), F.count_distinct(F.struct("replicate_name")).alias("_rows")
    ).filter(F.col("_mean").isNotNull())

    def mean_of(standard_type: str):
        return F.max(F.when(F.col("standard_type") == standard_type, F.col("_mean")))

    ratios = means.groupBy("metabolite_name").agg(
        safe_div(mean_of(STANDARDS_MATRIX) - mean_of(WATER_MATRIX), mean_of(STANDARDS_WATER)).alias("rf_ratio"),
        F.sum("_rows").alias("_rows"),
        *[mean_of(t).isNotNull().alias(f"_{t}") for t in (STANDARDS_MATRIX, WATER_MATRIX, STANDARDS_WATER)],
    )
    if is_corrected(mode):
        enough = F.col(f"_{STANDARDS_MATRIX}") & F.col(f"_{WATER_MATRIX}") & F.col(f"_{STANDARDS_WATER}")
    else:
        enough = F.col("_rows") >= 3
    return ratios.filter(enough).select("metabolite_name", "rf_ratio")


def quantify_response_factor(bmis: DataFrame, ratios: DataFrame, ranges: DataFrame) -> DataFrame:
    """Amount per vial of every normalised row whose compound has a response-factor ratio.

    Repeated rows count once; they are removed while the rows are still narrow."""
    factors = sized(null_safe_join(
        ratios, ranges.select("metabolite_name", "rf_max", "rf_min").distinct(), ["metabolite_name"]
    ))
    rows = bmis.select(
        F.col("mass_feature").alias("metabolite_name"), "final_bmis", "run_date", "type", "samp_id", "replicate",
        "adjusted_area", "area_with_qc",
    )
    rows = null_safe_join(rows, factors, ["metabolite_name"], "left_semi").distinct()
    joined = null_safe_join(rows, factors, ["metabolite_name"], "inner").withColumns({
        "replicate_name": join_parts("run_date", "type", "samp_id", "replicate"),
        "rf_ave": (F.col("rf_min") + F.col("rf_max")) / 2,
    })

    def umol(factor: str):
        return safe_div(safe_div("adjusted_area", factor), "rf_ratio")

    return joined.withColumns({
        "umol_in_vial_ave": umol("rf_ave"),
        "umol_in_vial_max": umol("rf_min"),
        "umol_in_vial_min": umol("rf_max"),
    })


def is_name_pairs(
    bmis: DataFrame, ratios: DataFrame, known: DataFrame, literal: bool = True
) -> DataFrame:
    """Compounds whose chosen standard carries their own name, with the standard's concentration.

    `literal=False` reads the compound name as a regular expression."""
    names = null_safe_join(
        bmis.select("final_bmis", F.col("mass_feature").alias("metabolite_name")).distinct(),
        sized(ratios).select("metabolite_name"), ["metabolite_name"], "left_semi",
    )
    chosen, name = F.col("final_bmis"), F.col("metabolite_name")
    pairs = names.filter(chosen.contains(name) if literal else F.rlike(chosen, name))
    concentrations = sized(known).select(F.col("metabolite_name").alias("final_bmis"), "concentration_um")
    return natural_left_join(pairs, concentrations)


def quantify_internal_standard(
    qc: DataFrame, pairs: DataFrame, measured: DataFrame | None = None
) -> DataFrame:
    """Amount per vial from the area ratio of a compound and its labelled standard, per replicate.

    The two rows meet by their core name. `measured` are the standard rows: a pair whose standard
    occurs in none of them gets no concentration."""
    if measured is not None:
        seen = sized(measured.select(F.col("metabolite_name").alias("final_bmis"), F.lit(True).alias("_seen")).distinct())
        pairs = natural_left_join(pairs, seen).withColumn(
            "concentration_um", F.when(F.col("_seen"), F.col("concentration_um"))
        ).drop("_seen")
    pairs = sized(pairs)
    members = (
        pairs.select(F.col("final_bmis").alias("metabolite_name"))
        .unionByName(pairs.select("metabolite_name")).distinct()
    )
    concentrations = pairs.select("metabolite_name", "concentration_um").distinct()
    rows = qc.filter(~F.col("replicate_name").contains("Std")).select(
        "replicate_name", "metabolite_name", "area_with_qc"
    )
    rows = null_safe_join(rows, members, ["metabolite_name"], "left_semi").distinct()
    rows = rows.withColumn("_core", core_name("metabolite_name"))
    labelled = F.col("metabolite_name").contains(",")
    standard_areas = rows.filter(labelled).groupBy("replicate_name", "_core").agg(
        F.max("area_with_qc").alias("_is_area")
    )
    compounds = null_safe_join(rows.filter(~labelled), standard_areas, ["replicate_name", "_core"])
    return null_safe_join(compounds, concentrations, ["metabolite_name"]).select(
        "replicate_name", "metabolite_name", "area_with_qc", "concentration_um",
        (safe_div("area_with_qc", "_is_area") * (F.col("concentration_um") / 1000)).alias("umol_in_vial_is"),
    )


def quantify_merge(by_factor: DataFrame, by_standard: DataFrame) -> DataFrame:
    """The amount by internal standard wins where there is one; it has no range.

    Only compounds that have such amounts are joined on the replicate, all others stay in place."""
    amounts = by_standard.select("replicate_name", "metabolite_name", "umol_in_vial_is").distinct()
    paired = sized(amounts.select("metabolite_name").distinct())
    rows = by_factor.select(
        "metabolite_name", "samp_id", "replicate_name", "adjusted_area", "area_with_qc", "rf_ratio", "rf_max",
        "rf_min", "rf_ave", "umol_in_vial_ave", "umol_in_vial_max", "umol_in_vial_min",
    )
    alone = null_safe_join(rows, paired, ["metabolite_name"], "left_anti")
    joined = null_safe_join(
        null_safe_join(rows, paired, ["metabolite_name"], "left_semi"), amounts, ["replicate_name", "metabolite_name"]
    )
    amount = F.col("umol_in_vial_is")
    joined = joined.withColumns({
        "umol_in_vial_ave": F.coalesce(amount, F.col("umol_in_vial_ave")),
        "umol_in_vial_max": F.when(amount.isNull(), F.col("umol_in_vial_max")),
        "umol_in_vial_min": F.when(amount.isNull(), F.col("umol_in_vial_min")),
    })
    return joined.unionByName(alone, allowMissingColumns=True)


def environmental_nmol(
    merged: DataFrame, formulas: DataFrame, p: QuantifyParams = QuantifyParams(), dedupe: bool = True
) -> DataFrame:
    """Amount in the environment, and the empirical formula of the compound.

    `dedupe=False` saves a shuffle where the rows are known to be distinct."""
    nmol = (
        F.col("umol_in_vial_ave") * F.lit(1e-6) * p.reconstitution_volume / p.volume_filtered * 1000.0
        * p.dilution_factor
    )
    known = sized(formulas).select("metabolite_name", "empirical_formula").distinct()
    rows = null_safe_join(merged.withColumn("nmol_in_enviro_ave", nmol), known, ["metabolite_name"])
    return rows.distinct() if dedupe else rows


def carbon_nitrogen(environmental: DataFrame, mode: str = REFERENCE) -> DataFrame:
    carbon, nitrogen = formula_atoms("empirical_formula", mode)
    return environmental.withColumns({"c": carbon, "n": nitrogen}).withColumns({
        "nmol_c_ave": F.col("nmol_in_enviro_ave") * F.col("c"),
        "nmol_n_ave": F.col("nmol_in_enviro_ave") * F.col("n"),
    })


def totals_per_sample(molecules: DataFrame) -> DataFrame:
    """Carbon and nitrogen of every sample; nothing measured counts as 0."""
    return molecules.groupBy("samp_id").agg(
        F.coalesce(F.sum("nmol_c_ave"), F.lit(0.0)).alias("total_c_measured_nm_per_id"),
        F.coalesce(F.sum("nmol_n_ave"), F.lit(0.0)).alias("total_n_measured_nm_per_id"),
    )


def mole_fractions(molecules: DataFrame, totals: DataFrame) -> DataFrame:
    """Share of every row in the carbon and nitrogen of its sample."""
    total_c, total_n = "total_c_measured_nm_per_id", "total_n_measured_nm_per_id"
    joined = null_safe_join(molecules, sized(totals), ["samp_id"])
    return joined.withColumns({
        "ratio_cn": safe_div(total_c, total_n),
        "mol_fraction_c": safe_div("nmol_c_ave", total_c),
        "mol_fraction_n": safe_div("nmol_n_ave", total_n),
    }).select(
        "metabolite_name", "replicate_name", "adjusted_area", "area_with_qc", "rf_ratio", "rf_max", "rf_min",
        "rf_ave", "umol_in_vial_ave", "umol_in_vial_max", "umol_in_vial_min", "umol_in_vial_is",
        "nmol_in_enviro_ave", "empirical_formula", "c", "n", "nmol_c_ave", "nmol_n_ave", total_c, total_n,
        "ratio_cn", "mol_fraction_c", "mol_fraction_n",
    )


_SUMMARISED = {
    "nmol_in_enviro_ave": "nmol_enviro",
    "nmol_c_ave": "nmol_c",
    "mol_fraction_c": "mol_c_fraction",
}


def compound_summary(fractions: DataFrame) -> DataFrame:
    """Median, minimum and maximum of three amounts for every compound, names descending."""
    amounts = fractions.select("metabolite_name", *[F.col(c).alias(n) for c, n in _SUMMARISED.items()])
    return median_min_max(amounts, ["metabolite_name"], list(_SUMMARISED.values())).orderBy(
        F.desc("metabolite_name")
    )
