"""Cleaning, melting and aligning raw exports into the canonical long peak table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from peakflow.functions.columns import run_type, to_number, trim_whitespace
from peakflow.functions.joins import natural_left_join, null_safe_join, sized
from peakflow.params import REFERENCE, is_corrected
from peakflow.schema import DROPPABLE_DESCRIPTORS, HILIC_NEGATIVE, HILIC_POSITIVE

#: A raw header of this form names a sample; other headers are descriptors.
SAMPLE_HEADER = r"^([Xx]|[^A-Za-z.])"


def null_markers(df: DataFrame, marker: str = "#N/A") -> DataFrame:
    """NULL for every text cell that contains the marker."""
    return df.select(*[
        F.when(~F.col(f.name).contains(marker), F.col(f.name)).alias(f.name)
        if isinstance(f.dataType, T.StringType) else F.col(f.name)
        for f in df.schema
    ])


def cast_numeric_columns(df: DataFrame, columns: list[str] | tuple[str, ...]) -> DataFrame:
    return df.withColumns({c: to_number(c) for c in columns})


def sample_columns(df: DataFrame) -> list[str]:
    """Columns that hold one sample each: their name starts with X."""
    return [c for c in df.columns if c.lower().startswith("x")]


def cast_sample_columns(df: DataFrame) -> DataFrame:
    return cast_numeric_columns(df, sample_columns(df))


def drop_descriptors(df: DataFrame, names: tuple[str, ...] = DROPPABLE_DESCRIPTORS) -> DataFrame:
    """Drop descriptor columns; names the table lacks are ignored."""
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c not in names])


def drop_unknown(df: DataFrame, column: str = "metabolite_name") -> DataFrame:
    return df.filter(F.col(column) != "Unknown")


def melt_samples(df: DataFrame, measure: str) -> DataFrame:
    """Wide to long: one row per feature and sample, the value in a column called `measure`."""
    samples = sample_columns(df)
    ids = [c for c in df.columns if c not in samples]
    long = df.unpivot(ids, samples, "replicate_name", measure)
    return long.select("replicate_name", measure, *ids)


def assemble_measures(area: DataFrame, mz: DataFrame, sn: DataFrame, rt: DataFrame) -> DataFrame:
    """One row per feature and sample from four melted tables.

    All three joins use the same key, so each table is shuffled once and rows stay in place."""
    joined = natural_left_join(natural_left_join(natural_left_join(area, mz), sn), rt)
    first = ["replicate_name", "area_value", "mz_value", "rt_value", "sn_value"]
    return joined.select(*first, *[c for c in joined.columns if c not in first])


def union_modes(positive: DataFrame, negative: DataFrame) -> DataFrame:
    """Label the two ion modes and stack them; a column only one side has is NULL in the other."""
    labelled = negative.withColumn("ion_column", F.lit(HILIC_NEGATIVE))
    return labelled.unionByName(
        positive.withColumn("ion_column", F.lit(HILIC_POSITIVE)), allowMissingColumns=True
    )


def standardize_names(df: DataFrame, prefix: str, has_prefix: bool = False) -> DataFrame:
    """Cut a laboratory prefix off compound names and the syntactic X off replicate names.

    A name that contains `prefix` becomes its second underscore-separated part. `has_prefix` says
    that replicate names still carry the extra first character of a wide export."""
    name = F.col("metabolite_name")
    columns = {
        "metabolite_name": F.when(
            name.contains(prefix), F.nullif(F.get(F.split(name, "_"), F.lit(1)), F.lit(""))
        ).otherwise(name)
    }
    if has_prefix:
        columns["replicate_name"] = F.expr("substring(replicate_name, 2)")
    return df.withColumns(columns)


def update_compound_names(
    df: DataFrame,
    standards: DataFrame,
    column: str = "metabolite_name",
    keep_unmatched: bool = True,
    dedupe: bool = True,
) -> DataFrame:
    """Replace original compound names by the current names of the dimension.

    `keep_unmatched` keeps a name the dimension does not know (wide exports), else it becomes NULL
    (long exports in reference mode)."""
    mapping = sized(
        standards.select(F.col("compound_name_original").alias(column), F.col("compound_name").alias("_new"))
        .distinct()
    )
    renamed = null_safe_join(df, mapping, [column])
    new = F.coalesce("_new", column) if keep_unmatched else F.col("_new")
    renamed = renamed.withColumn(column, new).drop("_new")
    return renamed.distinct() if dedupe else renamed


def keeps_unmatched_names(mode: str = REFERENCE) -> bool:
    """Long exports lose unmatched names in reference mode only."""
    return is_corrected(mode)


def trim_names(df: DataFrame, column: str = "compound_name") -> DataFrame:
    return df.withColumn(column, trim_whitespace(column))


def run_types_present(df: DataFrame, required: tuple[str, ...] = ()) -> DataFrame:
    """Distinct run types; with `required` it raises when one of them is missing."""
    found = df.select(run_type("replicate_name").alias("run_type")).distinct()
    if required:
        known = found.filter(F.col("run_type").isin(*required)).count()
        if known < len(set(required)):
            raise ValueError(f"run types other than {sorted(required)} or some of them missing")
    return found


#: The run types every run has.
RUN_TYPES = ("std", "blk", "poo", "smp")


def run_type_metrics(types: tuple[str, ...] = RUN_TYPES) -> dict[str, Column]:
    """Whether each run type occurs and whether anything else does, as aggregates for a pass made anyway."""
    kind = run_type("replicate_name")
    known = F.coalesce(kind.isin(*types), F.lit(False))
    return {t: F.bool_or(kind == t) for t in types} | {"other": F.bool_or(~known)}


def require_run_types(found: dict, types: tuple[str, ...] = RUN_TYPES) -> None:
    """Raise unless the metrics show all these run types and no other."""
    missing = [t for t in types if not found.get(t)]
    if missing or found.get("other"):
        besides = " and others occur" if found.get("other") else ""
        raise ValueError(f"run types {list(types)} are expected; missing: {missing}{besides}")


def run_type_filter(
    df: DataFrame, pattern: str, include: bool = True, ignore_case: bool = False,
    column: str = "replicate_name",
) -> DataFrame:
    """Rows whose replicate name matches (or does not match) a pattern; missing names never pass."""
    match = F.col(column).rlike(("(?i)" if ignore_case else "") + pattern)
    return df.filter(match if include else ~match)
