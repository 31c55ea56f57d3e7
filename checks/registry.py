"""Every registered query: an operator applied to the views over the whole driver tables."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.fixtures import view
from peakflow.functions import columns as C
from peakflow.functions.joins import sized
from peakflow.functions.stats import rsd_by_group
from peakflow.operators import bmis as B
from peakflow.operators import duplicates as D
from peakflow.operators import fragments as R
from peakflow.operators import msdial as M
from peakflow.operators import quantify as Q
from peakflow.operators import reports
from peakflow.operators import skyline as S
from peakflow.operators import tidy as T
from peakflow.params import CORRECTED, REFERENCE, QcParams, QuantifyParams
from peakflow.plans import outputs
from peakflow.plans import workflow as W
from peakflow.schema import PEAKS, SKYLINE_NUMERIC
from peakflow.sources.readers import load_standards, read_long, read_wide
from peakflow.sources.staging import stage, staging_dir

QC = QcParams()
SKYLINE_QC = QcParams(rt_flex=40.0)
RUN_DATE = dt.date(2017, 4, 10)

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn):
    _QUERIES[fn.__name__] = fn
    return fn


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_QUERIES)


def cut(c: Column | str, digits: int = 7) -> Column:
    """Cut a computed double to significant digits for comparison.

    The last bits depend on the order of a sum. The offset is no decimal half, so values on a short
    decimal grid never sit on the edge of a step."""
    x = C.col(c)
    scale = F.pow(F.lit(10.0), F.lit(digits - 1) - F.floor(F.log10(F.abs(x))))
    return F.when(F.abs(x) < 1e-12, 0.0).when(F.isnan(x) | (F.abs(x) == float("inf")), x).otherwise(F.floor(x * scale + 0.123456) / scale)


def cut_columns(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({c: cut(c) for c in names})


# --- inputs -----------------------------------------------------------------------------------------


def peaks(spark, sf):
    return view(spark, sf, "peaks").select(*PEAKS.names)


def peaks_modes(spark, sf):
    return view(spark, sf, "peaks_modes").select("ion_column", *PEAKS.names)


def standards(spark, sf):
    return sized(view(spark, sf, "standards"))


def internal(spark, sf):
    return B.internal_standards(standards(spark, sf))


def qc(spark, sf):
    return M.msdial_qc(peaks(spark, sf), QC)


def qc_of_table(spark, sf):
    """Quality control of a stored peak table, where many passes over the input follow."""
    return M.msdial_qc(stage(peaks(spark, sf), "peaks"), QC)


def bmis_data(spark, sf):
    return B.bmis_input(qc(spark, sf))


def staged_qc(spark, sf):
    return stage(qc_of_table(spark, sf), "qc")


def skyline(spark, sf):
    raw = T.cast_numeric_columns(T.null_markers(view(spark, sf, "skyline_raw")), SKYLINE_NUMERIC)
    return T.update_compound_names(
        raw, standards(spark, sf), "precursor_ion_name", keep_unmatched=False, dedupe=False
    )


def wide(spark, sf, measure="area"):
    return view(spark, sf, f"wide_{measure}")


def fragments(spark, sf):
    return view(spark, sf, "fragments")


def fragment_table(spark, sf):
    return stage(fragments(spark, sf), "fragments")


def transitions(spark, sf):
    return sized(view(spark, sf, "transitions"))


@query
def dimension_by_header(spark, sf):
    """The dimension written with vendor headers, shuffled and extra columns, and read back by name."""
    folder = f"{staging_dir(spark).rstrip('/')}/dimension-{uuid.uuid4().hex}"
    standards(spark, sf).select(
        F.col("hilic_mix").alias("HILIC_Mix"), F.lit("x").alias("Extra"), F.col("compound_type").alias("Compound_Type"),
        F.col("concentration_um").alias("Concentration_uM"), F.col("compound_name").alias("Compound_Name"),
        F.col("empirical_formula").alias("Empirical_Formula"), F.col("column_type").alias("Column"),
        F.col("compound_name_original").alias("Compound_Name_Original"), F.lit(1).alias("Mass"),
    ).write.option("header", True).option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(folder)
    return load_standards(spark, folder)


@query
def long_two_headers(spark, sf):
    """Long exports of one folder, half of them with another order, spelling and number of columns, read by name."""
    folder = f"{staging_dir(spark).rstrip('/')}/long-{uuid.uuid4().hex}"
    raw = stage(view(spark, sf, "skyline_raw"), "skyline-raw")
    first = F.pmod(F.length("replicate_name") + F.coalesce(F.length("area"), F.lit(0)), F.lit(2)) == 0
    keep = {"header": True, "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    raw.filter(first).toDF(*(c.replace("_", " ").title() for c in raw.columns)).write.options(**keep).csv(folder)
    other = raw.filter(~first).select(F.lit("x").alias("Extra"), *(F.col(c).alias(c.upper()) for c in reversed(raw.columns)))
    other.write.mode("append").options(**keep).csv(folder)
    return read_long(spark, folder)


# --- names and scalars ------------------------------------------------------------------------------


@query
def run_type(spark, sf):
    return peaks(spark, sf).select("replicate_name", "metabolite_name", C.run_type("replicate_name").alias("run_type"))


@query
def parse_replicate(spark, sf):
    return peaks(spark, sf).select(
        "replicate_name", "metabolite_name",
        *[c.alias(n) for n, c in C.parse_replicate("replicate_name").items()],
    )


@query
def fix_replicate_dash(spark, sf):
    return peaks(spark, sf).select(
        C.fix_replicate_dash(F.replace("replicate_name", F.lit("_"), F.lit("-"))).alias("replicate_name"),
        "metabolite_name", "area_value",
    )


def _formulas(spark, sf, mode):
    carbon, nitrogen = C.formula_atoms("empirical_formula", mode)
    return standards(spark, sf).select("compound_name", "empirical_formula", carbon.alias("c"), nitrogen.alias("n"))


@query
def formula_atoms(spark, sf):
    return _formulas(spark, sf, REFERENCE)


@query
def formula_atoms_corrected(spark, sf):
    return _formulas(spark, sf, CORRECTED)


@query
def trim_names(spark, sf):
    padded = standards(spark, sf).withColumn("compound_name", F.concat(F.lit(" \t"), "compound_name", F.lit("  \n")))
    return T.trim_names(padded).select("compound_name", "compound_type", "concentration_um")


@query
def run_types_present(spark, sf):
    return T.run_types_present(peaks(spark, sf))


@query
def run_type_filter(spark, sf):
    rows = peaks(spark, sf).select("replicate_name", "metabolite_name", "area_value")
    kept = T.run_type_filter(rows, "blk|poo", ignore_case=True)
    return kept.unionByName(T.run_type_filter(rows, "Smp|Poo|Blk", include=False))


# --- wide exports -----------------------------------------------------------------------------------


@query
def wide_header(spark, sf):
    """Write the wide table as raw export files of two layouts, then read those files."""
    headers = ["170410_Smp_A_1", "170410_Smp_A-2", "170410_Poo_B_1", "170410_Std_C_1"]
    table = wide(spark, sf).withColumn("block", F.floor(F.col("alignment_id") / 500))
    swapped = F.col("block") % 2 == 1

    def line(name, number, values):
        first = F.concat_ws(",", name, number, *values)
        return F.when(swapped, F.concat_ws(",", number, name, *values[::-1])).otherwise(first)

    def text(c):
        return F.concat(F.lit('"'), F.coalesce(F.col(c).cast("string"), F.lit("")), F.lit('"'))

    data = table.select(
        "block", F.lit("9").alias("place"),
        line(text("metabolite_name"), text("alignment_id"), [text(c) for c in T.sample_columns(table)]).alias("line"),
    )
    title = line(F.lit("Metabolite name"), F.lit("Alignment ID"), [F.lit(h) for h in headers])
    tops = table.select("block").distinct().select(
        "block", F.posexplode(F.array(F.lit("export,of,a,run,,"), F.lit(",Class,,1,,"), F.lit(",Type,,2,,"), title))
        .alias("place", "line"),
    ).withColumn("place", F.col("place").cast("string"))
    path = f"{staging_dir(spark).rstrip('/')}/exports-{spark.sql('SELECT uuid()').first()[0]}"
    lines = tops.unionByName(data).repartition("block").sortWithinPartitions("block", "place")
    lines.drop("place").write.partitionBy("block").text(path)
    return read_wide(spark, path, "area_value")


@query
def melt_samples(spark, sf):
    return T.melt_samples(wide(spark, sf), "area_value")


@query
def cast_sample_columns(spark, sf):
    table = wide(spark, sf)
    text = table.withColumns({c: F.concat(F.lit(" "), F.col(c).cast("string")) for c in T.sample_columns(table)})
    return T.cast_sample_columns(text)


def _assembled(spark, sf):
    return T.assemble_measures(*[
        T.melt_samples(wide(spark, sf, m), f"{m}_value") for m in ("area", "mz", "sn", "rt")
    ])


@query
def assemble_measures(spark, sf):
    return _assembled(spark, sf)


@query
def standardize_names(spark, sf):
    long = T.melt_samples(T.drop_unknown(wide(spark, sf)), "area_value")
    return T.standardize_names(long, "Lab_", has_prefix=True)


@query
def update_compound_names(spark, sf):
    old = view(spark, sf, "peaks").select(
        F.concat(F.lit("Old_"), F.col("compound_id").cast("string")).alias("metabolite_name"),
        "replicate_name", "area_value",
    )
    known = standards(spark, sf).filter(F.col("concentration_um").isNotNull())
    return T.update_compound_names(old, known)


@query
def union_modes(spark, sf):
    both = view(spark, sf, "peaks_modes").select("replicate_name", "metabolite_name", "area_value", "ion_column")
    positive = both.filter(F.col("ion_column") == "HILICPos").drop("ion_column")
    negative = both.filter(F.col("ion_column") == "HILICNeg").select("replicate_name", "metabolite_name")
    return T.union_modes(positive, negative)


# --- wide-export quality control ---------------------------------------------------------------------


@query
def rt_reference(spark, sf):
    return M.rt_reference(peaks(spark, sf))


@query
def blank_reference(spark, sf):
    return M.blank_reference(peaks(spark, sf))


@query
def sn_area_flags(spark, sf):
    return M.sn_area_flags(peaks(spark, sf), QC)


@query
def rt_flags(spark, sf):
    table = peaks(spark, sf)
    return M.rt_flags(table, M.rt_reference(table), QC)


@query
def blank_flags(spark, sf):
    table = peaks(spark, sf)
    return M.blank_flags(table, M.blank_reference(table), QC)


@query
def msdial_qc(spark, sf):
    return qc(spark, sf)


@query
def msdial_qc_corrected(spark, sf):
    return M.msdial_qc(peaks(spark, sf), QC, CORRECTED)


@query
def qc_parameter_report(spark, sf):
    parameters = reports.parameter_table(spark, reports.msdial_parameters(QC, RUN_DATE))
    return reports.qc_parameter_report(qc(spark, sf), parameters)


# --- long-export quality control ---------------------------------------------------------------------


@query
def null_markers(spark, sf):
    return T.null_markers(view(spark, sf, "skyline_raw"))


@query
def cast_numeric_columns(spark, sf):
    return T.cast_numeric_columns(view(spark, sf, "skyline_raw"), SKYLINE_NUMERIC)


@query
def keep_own_mixes(spark, sf):
    return S.keep_own_mixes(skyline(spark, sf), standards(spark, sf))


@query
def keep_own_mixes_corrected(spark, sf):
    return S.keep_own_mixes(skyline(spark, sf), standards(spark, sf), CORRECTED)


@query
def standard_mix_filter(spark, sf):
    return S.standard_mix_filter(skyline(spark, sf), standards(spark, sf))


@query
def skyline_rt_reference(spark, sf):
    return S.skyline_rt_reference(skyline(spark, sf))


@query
def skyline_blank_reference(spark, sf):
    return S.skyline_blank_reference(skyline(spark, sf))


@query
def height_table(spark, sf):
    return S.height_table(skyline(spark, sf))


@query
def area_table(spark, sf):
    return S.area_table(skyline(spark, sf))


@query
def signal_to_noise(spark, sf):
    return S.signal_to_noise(skyline(spark, sf))


@query
def skyline_qc(spark, sf):
    return S.skyline_qc(stage(skyline(spark, sf), "long-peaks"), SKYLINE_QC)


@query
def skyline_qc_corrected(spark, sf):
    return S.skyline_qc(stage(skyline(spark, sf), "long-peaks"), SKYLINE_QC, CORRECTED)


# --- triple-quad -------------------------------------------------------------------------------------


@query
def attach_transitions(spark, sf):
    return R.attach_transitions(fragments(spark, sf), transitions(spark, sf))


@query
def check_fragments(spark, sf):
    return R.check_fragments(fragments(spark, sf), transitions(spark, sf), "Smp")


@query
def check_fragments_corrected(spark, sf):
    return R.check_fragments(fragments(spark, sf), transitions(spark, sf), "Smp", CORRECTED)


def _standard_fragments(spark, sf):
    return R.check_fragments(fragments(spark, sf), transitions(spark, sf), "Std")


@query
def assert_two_fragments(spark, sf):
    return R.assert_two_fragments(_standard_fragments(spark, sf))


@query
def single_fragments(spark, sf):
    """Compounds of which one product ion is missing in all runs."""
    kept = fragments(spark, sf).filter(~((F.col("product_mz") >= 70) & F.col("precursor_ion_name").rlike("[37]$")))
    return R.assert_two_fragments(R.check_fragments(kept, transitions(spark, sf), "Std"))


@query
def transitions_within_tolerance(spark, sf):
    """Measured product ions a little off the listed ones, on both sides of bin edges and of the tolerance."""
    shift = (F.length("replicate_name") * 7 + F.col("precursor_mz").cast("int")) % 9 - 4
    off = fragments(spark, sf).withColumn("product_mz", F.col("product_mz") + shift * 0.03)
    return R.attach_transitions(off, transitions(spark, sf), tolerance=0.1)


@query
def ion_ratio_reference(spark, sf):
    return R.ion_ratio_reference(_standard_fragments(spark, sf))


def _ion_ratio_flags(spark, sf, mode):
    table, listed = fragment_table(spark, sf), transitions(spark, sf)
    ranges = R.ion_ratio_reference(R.check_fragments(table, listed, "Std", mode), mode)
    return R.ion_ratio_flags(table, listed, ranges, QC, mode)


@query
def ion_ratio_flags(spark, sf):
    return _ion_ratio_flags(spark, sf, REFERENCE)


@query
def tqs_blank_reference(spark, sf):
    return R.tqs_blank_reference(fragments(spark, sf), transitions(spark, sf))


@query
def tqs_qc(spark, sf):
    return R.tqs_qc(fragment_table(spark, sf), transitions(spark, sf), QC)


@query
def tqs_qc_corrected(spark, sf):
    return R.tqs_qc(fragment_table(spark, sf), transitions(spark, sf), QC, CORRECTED)


def _triple_quad(spark, sf):
    return W.triple_quad_quality_control(fragments(spark, sf), transitions(spark, sf), QC)


def _written_triple_quad(spark, sf, name):
    """One table of the written section, read back."""
    base = f"{staging_dir(spark).rstrip('/')}/tqs-{uuid.uuid4().hex}"
    written = outputs.write_triple_quad_qc(_triple_quad(spark, sf), QC, base, RUN_DATE, "2017-04-11")
    return spark.read.parquet(written[name])


@query
def ion_ratio_table(spark, sf):
    return _written_triple_quad(spark, sf, "ion_ratio_table")


@query
def tqs_report(spark, sf):
    """Ten parameter rows above the flagged peaks of the plan."""
    return _written_triple_quad(spark, sf, "qc_output")


@query
def combined_peaks(spark, sf):
    """Rearranged peaks of a run, written under its pattern and date and read back by a later section."""
    base = f"{staging_dir(spark).rstrip('/')}/combined-{uuid.uuid4().hex}"
    return spark.read.parquet(outputs.write_combined(skyline(spark, sf), "Skyline", "HILIC.*QE", base, RUN_DATE))


@query
def reverse_phase_export(spark, sf):
    """A long export with columns no step reads; they stay, also where half of the files lack one."""
    folder = f"{staging_dir(spark).rstrip('/')}/reverse-{uuid.uuid4().hex}"
    raw = stage(view(spark, sf, "skyline_raw"), "skyline-raw").withColumn("Protein Name", F.concat(F.lit("P"), "mass_error_ppm"))
    late = F.col("mass_error_ppm").cast("int") > 3
    raw.filter(~late).write.option("header", True).csv(folder)
    raw.filter(late).withColumn("Total Area.Fragment", F.col("background")).write.mode("append").option("header", True).csv(folder)
    return read_long(spark, folder, keep_all=True)


# --- ion-mode duplicates -----------------------------------------------------------------------------


@query
def mode_duplicates(spark, sf):
    return D.mode_duplicates(B.bmis_input(peaks_modes(spark, sf)))


@query
def mode_duplicate_stats(spark, sf):
    table = B.bmis_input(peaks_modes(spark, sf)).withColumn("area_with_qc", C.area_with_qc("area_value", QC.area_min))
    return cut_columns(D.mode_duplicate_stats(table), "means", "std_devs")


@query
def drop_mode_duplicates(spark, sf):
    table = peaks_modes(spark, sf)
    return D.drop_mode_duplicates(table, duplicates=D.mode_duplicates(B.bmis_input(table)))


# --- best-matched internal standard ------------------------------------------------------------------


@query
def internal_standards(spark, sf):
    return internal(spark, sf).select("compound_name", "compound_type", "column_type", "concentration_um")


@query
def semi_internal_standards(spark, sf):
    return B.semi_internal_standards(peaks(spark, sf), internal(spark, sf))


@query
def anti_internal_standards(spark, sf):
    return B.anti_internal_standards(peaks(spark, sf), internal(spark, sf))


@query
def bmis_input(spark, sf):
    return bmis_data(spark, sf)


@query
def injection_volume(spark, sf):
    return B.injection_volume(bmis_data(spark, sf))


@query
def is_issues(spark, sf):
    return B.is_issues(bmis_data(spark, sf), internal(spark, sf))


@query
def is_raw_areas(spark, sf):
    return B.is_raw_areas(bmis_data(spark, sf), internal(spark, sf))


@query
def is_means(spark, sf):
    return cut_columns(B.is_means(bmis_data(spark, sf), internal(spark, sf)), "average_area")


@query
def assert_same_replicates(spark, sf):
    data, names = bmis_data(spark, sf), internal(spark, sf)
    return B.assert_same_replicates(
        B.semi_internal_standards(data, names), B.anti_internal_standards(data, names)
    )


@query
def replicate_mismatch(spark, sf):
    """Internal standards lost in some replicates, everything else in others."""
    data, names = bmis_data(spark, sf), internal(spark, sf)
    sample = F.element_at(F.split("replicate_name", "_"), 3)
    return B.assert_same_replicates(
        B.semi_internal_standards(data, names).filter(~sample.endswith("3")),
        B.anti_internal_standards(data, names).filter(~sample.endswith("7")),
    )


def _staged_data(spark, sf):
    data = B.bmis_input(qc_of_table(spark, sf))
    return stage(data.select("replicate_name", "metabolite_name", "area_with_qc"), "bmis-input")


@query
def bmis_candidates(spark, sf):
    candidates = B.bmis_candidates(_staged_data(spark, sf), internal(spark, sf))
    return cut_columns(candidates, "adjusted_area")


def _odd_data(spark, sf):
    table = stage(view(spark, sf, "odd_peaks").select(*PEAKS.names), "odd-peaks")
    data = B.bmis_input(M.msdial_qc(table, QC))
    return stage(data.select("replicate_name", "metabolite_name", "area_with_qc"), "bmis-input")


@query
def bmis_candidates_odd(spark, sf):
    """Half injections, dashes and repeated rows; equal rows are counted together."""
    rows = cut_columns(B.bmis_candidates(_odd_data(spark, sf), internal(spark, sf)), "adjusted_area")
    return rows.groupBy([c for c in rows.columns if c != "weight"]).agg(F.sum("weight").alias("weight"))


@query
def bmis_normalize_odd(spark, sf):
    """The different rows, which are what quantification takes: repeated rows of a replicate fan out here."""
    data, names = _odd_data(spark, sf), internal(spark, sf)
    return cut_columns(B.bmis_normalize(data, names).distinct(), "orig_rsd", "final_rsd", "adjusted_area")


@query
def rsd_by_group_query(spark, sf):
    rows = bmis_data(spark, sf).withColumn("type", C.replicate_part("replicate_name", 1))
    return cut_columns(rsd_by_group(rows, ["metabolite_name", "type"], "area_with_qc"), "rsd")


def _pooled_rsd(spark, sf, mode=REFERENCE):
    data, names = _staged_data(spark, sf), internal(spark, sf)
    rsd = B.pooled_rsd(B.candidate_moments(data, names, mode, runs=B.is_pool()))
    return B.with_missing_pairs(rsd, B.is_means(data, names, mode))


@query
def pooled_rsd(spark, sf):
    return cut_columns(_pooled_rsd(spark, sf), "rsd_of_poo")


@query
def pooled_rsd_corrected(spark, sf):
    return cut_columns(_pooled_rsd(spark, sf, CORRECTED), "rsd_of_poo")


@query
def bmis_pick(spark, sf):
    return cut_columns(
        B.bmis_pick(_pooled_rsd(spark, sf)), "rsd_of_poo", "orig_rsd", "del_rsd", "percent_change"
    )


@query
def bmis_final(spark, sf):
    final = B.bmis_final(B.bmis_pick(_pooled_rsd(spark, sf)))
    return cut_columns(final, "orig_rsd", "del_rsd", "percent_change", "final_rsd")


@query
def is_to_is_rsd(spark, sf):
    data, names = _staged_data(spark, sf), internal(spark, sf)
    pick = B.bmis_pick(B.pooled_rsd(B.candidate_moments(data, names, runs=B.is_pool())))
    return cut_columns(B.is_to_is_rsd(data, names, pick), "rsd_of_smp", "rsd_of_poo")


@query
def bmis_quick_report(spark, sf):
    return cut_columns(B.bmis_quick_report(B.bmis_final(B.bmis_pick(_pooled_rsd(spark, sf)))), "share_picked")


def _normalized(spark, sf):
    return B.bmis_normalize(_staged_data(spark, sf), internal(spark, sf))


@query
def bmis_normalize(spark, sf):
    return cut_columns(_normalized(spark, sf), "orig_rsd", "final_rsd", "adjusted_area")


# --- quantification ----------------------------------------------------------------------------------


def _rows(spark, sf):
    return Q.standard_rows(qc_of_table(spark, sf), standards(spark, sf), "HILIC")


def _rf(spark, sf):
    return Q.response_factors(Q.standard_run_types(_rows(spark, sf)))


@query
def standard_rows(spark, sf):
    return _rows(spark, sf)


@query
def standard_run_types(spark, sf):
    runs = peaks(spark, sf).filter(F.col("replicate_name").contains("Std")).select("replicate_name", "metabolite_name")
    mix = Q.standard_run_types(runs, "mix").withColumnRenamed("standard_type", "mix_type")
    return Q.standard_run_types(mix)


@query
def response_factors(spark, sf):
    return _rf(spark, sf)


@query
def response_factors_own_mix(spark, sf):
    rows = Q.standard_run_types(_rows(spark, sf)).withColumn("ion_column", F.lit("HILICPos"))
    return Q.response_factors(rows)


@query
def rf_dimensions(spark, sf):
    return Q.rf_dimensions(_rf(spark, sf))


@query
def missing_rf(spark, sf):
    return Q.missing_rf(_rf(spark, sf))


@query
def rf_ratios(spark, sf):
    return cut_columns(Q.rf_ratios(_rf(spark, sf)), "rf_ratio")


def _normalized_peaks(spark, sf):
    """Staged quality-controlled and normalised peaks with the dimension."""
    checked, known = staged_qc(spark, sf), standards(spark, sf)
    normalized = stage(B.bmis_normalize(B.bmis_input(checked), B.internal_standards(known)), "normalized")
    return checked, known, normalized


def _inputs(spark, sf):
    checked, known, normalized = _normalized_peaks(spark, sf)
    return checked, known, normalized, W.response_factor_tables(checked, known)


UMOL = ("adjusted_area", "rf_ratio", "umol_in_vial_ave", "umol_in_vial_max", "umol_in_vial_min")


@query
def quantify_response_factor(spark, sf):
    _, _, normalized, (_, ratios, ranges) = _inputs(spark, sf)
    return cut_columns(Q.quantify_response_factor(normalized, ratios, ranges), *UMOL)


def _pairs(inputs):
    _, known, normalized, (_, ratios, _) = inputs
    return Q.is_name_pairs(normalized, ratios, Q.known_standards(known, "HILIC"))


@query
def is_name_pairs(spark, sf):
    return _pairs(_inputs(spark, sf))


def _by_standard(inputs):
    return Q.quantify_internal_standard(inputs[0], _pairs(inputs), measured=inputs[3][0])


@query
def quantify_internal_standard(spark, sf):
    return cut_columns(_by_standard(_inputs(spark, sf)), "umol_in_vial_is")


@query
def quantify_merge(spark, sf):
    inputs = _inputs(spark, sf)
    _, _, normalized, (_, ratios, ranges) = inputs
    merged = Q.quantify_merge(Q.quantify_response_factor(normalized, ratios, ranges), _by_standard(inputs))
    return cut_columns(merged, *UMOL, "umol_in_vial_is")


def _quantified(spark, sf):
    checked, known, normalized = _normalized_peaks(spark, sf)
    return W.quantify(checked, normalized, known, QuantifyParams())


AMOUNTS = (*UMOL, "umol_in_vial_is", "nmol_in_enviro_ave")
ATOMS = (*AMOUNTS, "nmol_c_ave", "nmol_n_ave")


@query
def environmental_nmol(spark, sf):
    table = _quantified(spark, sf).molecules.drop("c", "n", "nmol_c_ave", "nmol_n_ave")
    return cut_columns(table, *AMOUNTS)


@query
def carbon_nitrogen(spark, sf):
    return cut_columns(_quantified(spark, sf).molecules, *ATOMS)


TOTALS = ("total_c_measured_nm_per_id", "total_n_measured_nm_per_id")
SUMMARY = tuple(f"{short}_{name}" for short in ("nmol_enviro", "nmol_c", "mol_c_fraction") for name in ("med", "min", "max"))


@query
def totals_per_sample(spark, sf):
    return cut_columns(_quantified(spark, sf).totals, *TOTALS)


@query
def mole_fractions(spark, sf):
    return cut_columns(
        _quantified(spark, sf).measurements, *ATOMS, *TOTALS, "ratio_cn", "mol_fraction_c", "mol_fraction_n"
    )


@query
def compound_summary(spark, sf):
    return cut_columns(_quantified(spark, sf).summary, *SUMMARY)


@query
def analyse_two_modes(spark, sf):
    """Everything from raw peaks of both ion modes to the compound summary."""
    table = stage(peaks_modes(spark, sf), "peaks")
    return cut_columns(W.analyse(table, standards(spark, sf)).summary, *SUMMARY)


@query
def analyse_long(spark, sf):
    """Everything from a long export to the compound summary, on own mixes."""
    table = stage(skyline(spark, sf), "long")
    return cut_columns(W.analyse_long(table, standards(spark, sf), SKYLINE_QC, own_mixes=True).summary, *SUMMARY)


_QUERIES["rsd_by_group"] = _QUERIES.pop("rsd_by_group_query")
