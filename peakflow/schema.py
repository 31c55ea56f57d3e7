"""Table schemas and fixed labels."""

from __future__ import annotations

from pyspark.sql import types as T


def _strings(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


#: Long export of the vendor software: everything is text until it has been cleaned.
SKYLINE_LONG = _strings(
    "replicate_name", "precursor_ion_name", "retention_time", "area", "background", "height", "mass_error_ppm"
)
SKYLINE_NUMERIC = ("retention_time", "area", "background", "height", "mass_error_ppm")

#: Triple-quad export: one row per replicate and product ion.
FRAGMENTS_LONG = _strings(
    "replicate_name", "protein_name", "precursor_ion_name", "precursor_mz", "product_mz",
    "retention_time", "area", "background", "height",
)
FRAGMENTS_NUMERIC = ("precursor_mz", "product_mz", "retention_time", "area", "background", "height")

#: Compound dimension.
STANDARDS = T.StructType([
    T.StructField("compound_name", T.StringType()),
    T.StructField("compound_name_original", T.StringType()),
    T.StructField("compound_type", T.StringType()),
    T.StructField("column_type", T.StringType()),
    T.StructField("concentration_um", T.DoubleType()),
    T.StructField("hilic_mix", T.StringType()),
    T.StructField("empirical_formula", T.StringType()),
])

#: Triple-quad master list.
TRANSITIONS = T.StructType([
    T.StructField("compound_name", T.StringType()),
    T.StructField("daughter", T.DoubleType()),
    T.StructField("quan_trace", T.StringType()),
    T.StructField("second_trace", T.StringType()),
])

#: Canonical long peak table.
PEAKS = T.StructType([
    T.StructField("replicate_name", T.StringType()),
    T.StructField("area_value", T.DoubleType()),
    T.StructField("mz_value", T.DoubleType()),
    T.StructField("rt_value", T.DoubleType()),
    T.StructField("sn_value", T.DoubleType()),
    T.StructField("alignment_id", T.IntegerType()),
    T.StructField("metabolite_name", T.StringType()),
])

# Ion-mode labels, one spelling for both vendor formats.
HILIC_POSITIVE = "HILICPos"
HILIC_NEGATIVE = "HILICNeg"

# Descriptor columns a wide export may carry that no later step reads,
# in the spelling they have once headers are made syntactic.
DROPPABLE_DESCRIPTORS = (
    "Average.Rt.min.", "Formula", "Ontology", "INCHIKEY", "SMILES",
    "Isotope.tracking.parent.ID", "Isotope.tracking.weight.number",
    "MS1.isotopic.spectrum", "MS.MS.spectrum", "Average.Mz", "Post.curation.result",
    "Fill..", "Annotation.tag..VS1.0.", "RT.matched",
    "m.z.matched", "MS.MS.matched", "Manually.modified", "Total.score", "RT.similarity",
    "Dot.product", "Reverse.dot.product", "Fragment.presence..",
)
