"""From raw export files to the canonical long peak table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from peakflow import schema
from peakflow.operators import tidy as T
from peakflow.params import REFERENCE
from peakflow.schema import HILIC_NEGATIVE, HILIC_POSITIVE
from peakflow.sources.readers import read_long, read_wide

# The token of a file name that tells its measure, and the column it becomes.
MEASURES = {"Area": "area_value", "Mz": "mz_value", "SN": "sn_value", "RT": "rt_value"}

# The part of a file name that tells its ion mode, in any case.
ION_MODES = {HILIC_POSITIVE: "pos", HILIC_NEGATIVE: "neg"}


def _files(file_pattern: str, measure: str | None = None, ion_mode: str | None = None) -> str:
    """File-name pattern: all given parts occur, in any order."""
    parts = [file_pattern]
    if measure:
        parts.append(rf"(^|[^A-Za-z]){measure}([^A-Za-z]|$)")
    if ion_mode:
        parts.append(f"(?i:{ion_mode})")
    return "^" + "".join(f"(?=.*{p})" for p in parts)


def wide_mode(
    spark: SparkSession, path: str, file_pattern: str, ion_mode: str | None = None,
    descriptors: dict[str, str] | None = None,
) -> DataFrame:
    """The four measures of one ion mode (or of a reverse-phase run), one row per feature and sample."""
    return T.assemble_measures(*[
        read_wide(spark, path, MEASURES[m], _files(file_pattern, m, ion_mode), descriptors=descriptors)
        for m in ("Area", "Mz", "SN", "RT")
    ])


def wide_peaks(
    spark: SparkSession, path: str, standards: DataFrame, file_pattern: str, prefix: str, hilic: bool = True,
    descriptors: dict[str, str] | None = None,
) -> DataFrame:
    """Peaks of wide exports, both ion modes stacked, with the compound names of the dimension."""
    if hilic:
        positive, negative = (
            wide_mode(spark, path, file_pattern, ION_MODES[m], descriptors) for m in (HILIC_POSITIVE, HILIC_NEGATIVE)
        )
        peaks = T.union_modes(positive, negative)
    else:
        peaks = wide_mode(spark, path, file_pattern, descriptors=descriptors)
    return T.update_compound_names(T.standardize_names(peaks, prefix), standards)


def long_peaks(
    spark: SparkSession, path: str, standards: DataFrame, file_pattern: str, hilic: bool = True,
    mode: str = REFERENCE, triple_quad: bool = False,
) -> DataFrame:
    """Peaks of long exports, cleaned and cast, with the compound names of the dimension. Exports of both ion
    modes are cut to the columns later steps read; a reverse-phase or triple-quad export keeps all it has.

    Reference: a compound the dimension does not know loses its name; corrected: it keeps it."""
    columns, numeric = (
        (schema.FRAGMENTS_LONG, schema.FRAGMENTS_NUMERIC) if triple_quad
        else (schema.SKYLINE_LONG, schema.SKYLINE_NUMERIC)
    )
    if hilic:
        parts = [
            read_long(spark, path, columns, numeric, _files(file_pattern, ion_mode=part))
            .withColumn("ion_column", F.lit(label))
            for label, part in ION_MODES.items()
        ]
        peaks = parts[0].unionByName(parts[1])
    else:
        peaks = read_long(spark, path, columns, numeric, _files(file_pattern), keep_all=True)
    return T.update_compound_names(
        peaks, standards, "precursor_ion_name", keep_unmatched=T.keeps_unmatched_names(mode), dedupe=False
    )
