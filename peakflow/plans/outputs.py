"""The result tables and reports of each section, written under one folder."""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from peakflow.functions.columns import BLANK_OR_STANDARD
from peakflow.operators import bmis as B
from peakflow.operators import duplicates as D
from peakflow.operators import fragments as R
from peakflow.operators import msdial as M
from peakflow.operators import reports
from peakflow.operators import skyline as S
from peakflow.params import REFERENCE, BmisParams, QcParams
from peakflow.plans.workflow import Quantified, TripleQuad
from peakflow.sources.writers import quick_report_line, write_lines, write_table, write_tables


def write_wide_qc(
    peaks: DataFrame, qc: DataFrame, p: QcParams, base: str, run_date: dt.date, mode: str = REFERENCE,
    fmt: str = "parquet",
) -> dict[str, str]:
    """Reference ranges, the quality-controlled table and its report with parameter rows."""
    parameters = reports.parameter_table(peaks.sparkSession, reports.msdial_parameters(p, run_date))
    return write_tables({
        "rt_table": M.rt_reference(peaks, mode), "blank_table": M.blank_reference(peaks, mode),
        "final_table": qc, "qc_output": reports.qc_parameter_report(qc, parameters),
    }, base, run_date, fmt)


def write_long_qc(
    peaks: DataFrame, qc: DataFrame, p: QcParams, base: str, run_date: dt.date, processed_on: str,
    mode: str = REFERENCE, fmt: str = "parquet",
) -> dict[str, str]:
    """As above for long exports, with their area, height and signal-to-noise tables."""
    parameters = reports.parameter_table(
        peaks.sparkSession, reports.skyline_parameters(p, run_date, processed_on)
    )
    return write_tables({
        "rt_table": S.skyline_rt_reference(peaks, mode), "blank_table": S.skyline_blank_reference(peaks, mode),
        "area_table": S.area_table(peaks), "height_table": S.height_table(peaks), "sn_table": S.signal_to_noise(peaks),
        "final_table": qc, "qc_output": reports.qc_parameter_report(qc, parameters),
    }, base, run_date, fmt)


def write_triple_quad_qc(
    tables: TripleQuad, p: QcParams, base: str, run_date: dt.date, processed_on: str, mode: str = REFERENCE,
    fmt: str = "parquet",
) -> dict[str, str]:
    """As above for triple-quad exports, with the ion-ratio ranges and product ions in the height table."""
    raw = tables.fragments
    parameters = reports.parameter_table(
        raw.sparkSession, reports.skyline_parameters(p, run_date, processed_on, triple_quad=True)
    )
    return write_tables({
        "rt_table": S.skyline_rt_reference(raw, mode),
        "blank_table": R.tqs_blank_reference(raw, tables.transitions, mode),
        "area_table": S.area_table(raw), "height_table": S.height_table(raw, triple_quad=True),
        "sn_table": S.signal_to_noise(raw), "ion_ratio_table": tables.ion_ratios,
        "final_table": tables.qc, "qc_output": reports.qc_parameter_report(tables.qc, parameters),
    }, base, run_date, fmt)


def write_combined(
    peaks: DataFrame, software: str, file_pattern: str, base: str, run_date: dt.date, fmt: str = "parquet"
) -> str:
    """Combined peaks of all files of a run, as rearranged, under a name that carries software and pattern.

    Only the folder of this run date is replaced."""
    name = re.sub(r"[^A-Za-z0-9-]+", "_", f"{software}_combined_{file_pattern}").strip("_")
    return write_table(peaks, f"{base.rstrip('/')}/{name}", run_date, fmt)


def write_duplicates(qc: DataFrame, base: str, run_date: dt.date, fmt: str = "parquet") -> dict[str, str]:
    """Duplicated compounds of samples and pools, their statistics, and the text list of what is removed."""
    qc = qc.filter(~F.col("replicate_name").rlike(BLANK_OR_STANDARD))
    written = write_tables(
        {"duplicates": D.mode_duplicates(qc), "duplicate_stats": D.mode_duplicate_stats(qc)}, base, run_date, fmt
    )
    written["duplicate_report"] = write_lines(D.duplicate_report(qc), f"{base}/duplicate_report", run_date)
    return written


def write_bmis(
    data: DataFrame, standards: DataFrame, normalized: DataFrame, base: str, run_date: dt.date,
    p: BmisParams = BmisParams(), mode: str = REFERENCE, fmt: str = "parquet",
) -> dict[str, str]:
    """Normalised peaks with the tables and the report one judges them by."""
    pick = B.bmis_pick(B.pooled_rsd(B.candidate_moments(data, standards, mode, runs=B.is_pool())), p)
    written = write_tables({
        "bmis_output": normalized, "is_issues": B.is_issues(data, standards),
        "is_raw_areas": B.is_raw_areas(data, standards),
        "is_to_is_rsd": B.is_to_is_rsd(data, standards, pick, mode),
    }, base, run_date, fmt)
    report = quick_report_line(B.bmis_quick_report(B.bmis_final(pick, mode), p))
    written["quick_report"] = write_lines(report, f"{base}/quick_report", run_date)
    return written


def write_quantified(results: Quantified, base: str, run_date: dt.date, fmt: str = "parquet") -> dict[str, str]:
    """Response-factor ratios and the three quantified outputs."""
    written = {"rf_ratios": write_table(results.ratios, f"{base}/rf_ratios", run_date, fmt)}
    return written | write_tables({
        "quantified_summary": results.summary, "quantified_measurements": results.measurements,
        "quantified_per_sample": results.totals,
    }, base, run_date, fmt)
