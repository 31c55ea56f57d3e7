"""From quality-controlled peaks to concentrations, with written hand-over tables in between."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from peakflow.functions.columns import fix_replicate_dash
from peakflow.functions.joins import sized
from peakflow.operators import bmis as B
from peakflow.operators import fragments as R
from peakflow.operators import quantify as Q
from peakflow.operators import tidy as T
from peakflow.operators.duplicates import drop_mode_duplicates, mode_duplicates
from peakflow.operators.msdial import msdial_qc
from peakflow.operators.skyline import keep_own_mixes, skyline_qc, to_peaks
from peakflow.params import CORRECTED, REFERENCE, BmisParams, QcParams, QuantifyParams, is_corrected
from peakflow.sources.staging import observed_stage, stage


@dataclass(frozen=True)
class Quantified:
    """Results of the last section and the tables they rest on."""

    normalized: DataFrame
    standard_rows: DataFrame
    ratios: DataFrame
    molecules: DataFrame

    @property
    def totals(self) -> DataFrame:
        return Q.totals_per_sample(self.molecules)

    @property
    def measurements(self) -> DataFrame:
        return Q.mole_fractions(self.molecules, self.totals)

    @property
    def summary(self) -> DataFrame:
        return Q.compound_summary(self.measurements)


@dataclass(frozen=True)
class TripleQuad:
    """Quality control of a triple-quad export: its rows, the ion-ratio ranges of the standards, the flagged peaks."""

    fragments: DataFrame
    transitions: DataFrame
    ion_ratios: DataFrame
    qc: DataFrame


def _checked_stage(df: DataFrame, name: str, strict: bool) -> DataFrame:
    """A hand-over table; `strict` stops on unexpected run types, told in the pass that writes it."""
    if not strict:
        return stage(df, name)
    staged, found = observed_stage(df, name, T.run_type_metrics())
    T.require_run_types(found)
    return staged


def without_duplicates(qc: DataFrame) -> DataFrame:
    """Rows of a quality-controlled table without the duplicates of the negative ion mode.

    Duplicates are compounds seen twice in one sample or pool; blanks and standards do not count."""
    if "ion_column" not in qc.columns:
        return qc
    return drop_mode_duplicates(qc, duplicates=mode_duplicates(B.bmis_input(qc)))


def quality_control(
    peaks: DataFrame, p: QcParams = QcParams(), mode: str = REFERENCE, strict: bool = False
) -> tuple[DataFrame, DataFrame]:
    """Flagged peaks of wide exports as a hand-over table, and the same without duplicates.

    Response factors rest on the first table, everything else on the second. `strict` stops unless
    the run has its four run types and no other."""
    qc = _checked_stage(msdial_qc(peaks, p, mode), "qc", strict)
    return qc, without_duplicates(qc)


def long_quality_control(
    raw: DataFrame, standards: DataFrame, p: QcParams = QcParams(), mode: str = REFERENCE, own_mixes: bool | None = None,
    strict: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """The same for long exports. Of standard runs only those with the compound's own mix count, by
    default where there are ion modes; all other runs stay."""
    if own_mixes or (own_mixes is None and "ion_column" in raw.columns):
        raw = keep_own_mixes(raw, standards, CORRECTED)
    qc = _checked_stage(to_peaks(skyline_qc(raw, p, mode)), "qc", strict)
    return qc, without_duplicates(qc)


def triple_quad_quality_control(
    raw: DataFrame, transitions: DataFrame, p: QcParams = QcParams(), mode: str = REFERENCE, strict: bool = True
) -> TripleQuad:
    """Quality control of a triple-quad export. The export and the product ions of its standards are written
    once; all tables of the section are derived from these.

    `strict` (as published) stops when a compound of the standards has a single product ion; it is told in
    the pass that writes them."""
    table = stage(raw, "fragments")
    standards, found = observed_stage(
        R.check_fragments(table, transitions, "Std", mode), "standard-fragments", R.single_fragment_metric())
    if strict:
        R.require_two_fragments(found)
    ratios = sized(R.ion_ratio_reference(standards, mode))
    return TripleQuad(table, transitions, ratios, stage(R.tqs_qc(table, transitions, p, mode, ion_ratios=ratios), "qc"))


def response_factor_tables(
    qc: DataFrame, standards: DataFrame, p: QuantifyParams = QuantifyParams(), mode: str = REFERENCE
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Standard rows with their class, response-factor ratios and response-factor ranges."""
    rows = stage(Q.standard_run_types(Q.standard_rows(qc, standards, p.column_type)), "standard-rows")
    rf = Q.response_factors(rows)
    return rows, sized(Q.rf_ratios(rf, mode)), sized(Q.rf_range(rf))


def quantify(
    qc: DataFrame, normalized: DataFrame, standards: DataFrame, p: QuantifyParams = QuantifyParams(),
    mode: str = REFERENCE, measured: DataFrame | None = None,
) -> Quantified:
    """Both quantification routes, merged, with carbon and nitrogen.

    `measured` is the quality-controlled table that holds the standard runs, where it is not `qc`."""
    rows, ratios, ranges = response_factor_tables(qc if measured is None else measured, standards, p, mode)
    known = Q.known_standards(standards, p.column_type)
    pairs = Q.is_name_pairs(normalized, ratios, known)
    # Corrected: both routes spell replicate names alike, so that they meet.
    samples = qc.withColumn("replicate_name", fix_replicate_dash("replicate_name")) if is_corrected(mode) else qc
    merged = Q.quantify_merge(
        Q.quantify_response_factor(normalized, ratios, ranges),
        Q.quantify_internal_standard(samples, pairs, measured=rows),
    )
    molecules = Q.carbon_nitrogen(Q.environmental_nmol(merged, known, p, dedupe=False), mode)
    return Quantified(normalized, rows, ratios, stage(molecules, "molecules"))


def analyse(
    peaks: DataFrame, standards: DataFrame, qc_params: QcParams = QcParams(),
    bmis_params: BmisParams = BmisParams(), quantify_params: QuantifyParams = QuantifyParams(),
    mode: str = REFERENCE, strict: bool = False,
) -> Quantified:
    """Quality control, duplicate removal, normalisation and quantification of one peak table.

    `strict` stops on run types other than the usual four, and on replicates that have internal standards
    only or none; the latter takes one more pass over two columns of the flagged table."""
    tables = quality_control(peaks, qc_params, mode, strict)
    return _concentrations(tables, standards, bmis_params, quantify_params, mode, strict)


def analyse_long(
    raw: DataFrame, standards: DataFrame, qc_params: QcParams = QcParams(),
    bmis_params: BmisParams = BmisParams(), quantify_params: QuantifyParams = QuantifyParams(),
    mode: str = REFERENCE, own_mixes: bool | None = None, strict: bool = False,
) -> Quantified:
    """The same from a long export."""
    tables = long_quality_control(raw, standards, qc_params, mode, own_mixes, strict)
    return _concentrations(tables, standards, bmis_params, quantify_params, mode, strict)


def _concentrations(
    tables, standards: DataFrame, bmis_params: BmisParams, quantify_params: QuantifyParams, mode: str, strict: bool
) -> Quantified:
    measured, qc = tables
    internal = B.internal_standards(standards, quantify_params.column_type, mode)
    if strict:
        B.require_same_replicates(B.bmis_input(qc), internal)
    normalized = stage(B.bmis_normalize(B.bmis_input(qc), internal, bmis_params, mode), "normalized")
    return quantify(qc, normalized, standards, quantify_params, mode, measured)
