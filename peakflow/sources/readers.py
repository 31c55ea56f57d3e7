"""Raw exports, dimension tables and earlier results."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from peakflow import schema
from peakflow.functions.columns import blank_to_null, to_number
from peakflow.functions.joins import sized
from peakflow.operators.tidy import SAMPLE_HEADER, cast_numeric_columns, null_markers


def dataset_name(file_name: Column | str) -> Column:
    """File name without its csv extension."""
    return F.regexp_replace(file_name if isinstance(file_name, Column) else F.col(file_name), r"(?i)\.csv$", "")


def _matching(df: DataFrame, pattern: str | None, ignore_case: bool = False) -> DataFrame:
    """Keep rows of files whose name matches a regular expression anywhere."""
    if pattern is None:
        return df
    return df.filter(F.col("_metadata.file_name").rlike(("(?i)" if ignore_case else "") + pattern))


#: Headers whose plain spelling is not the column's name here.
_ALIASES = {"column": "column_type", "2nd_trace": "second_trace"}


def column_name(header: str) -> str:
    """Plain spelling of a header: small letters, everything else an underscore."""
    plain = re.sub(r"[^0-9a-z]+", "_", header.strip().lower()).strip("_")
    return _ALIASES.get(plain, plain)


def _names_of(header: Column) -> Column:
    """Plain spellings of a header's cells, as `column_name` gives them."""
    def plain(cell):
        name = F.regexp_replace(F.regexp_replace(F.lower(F.trim(F.coalesce(cell, F.lit("")))), "[^0-9a-z]+", "_"), "^_+|_+$", "")
        for alias, own in _ALIASES.items():
            name = F.when(name == alias, own).otherwise(name)
        return name

    return F.transform(header, plain)


def _lines(spark: SparkSession, path: str, pattern: str | None, skip_first: bool) -> DataFrame:
    """Whole lines of CSV files, without the first of each file where asked for: _path, _at, line.

    The same reader as for cells, with a separator that does not occur and no quotes."""
    reader = spark.read.schema("line string").options(header=skip_first, sep="\u0001", quote="", recursiveFileLookup=True)
    at = F.struct(F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("line"))
    return _matching(reader.csv(path), pattern).select(F.col("_metadata.file_path").alias("_path"), at.alias("_at"), "line")


def _headed(
    spark: SparkSession, path: str, pattern: str | None, wide: bool, columns: list[str] | None = None
) -> tuple[DataFrame, DataFrame]:
    """Data rows of CSV files (source_file, _path, cells), and the header of each file (_path, header).

    Two scans. The first takes, in one aggregation, each file's header line and the most cells of any line; only that
    one number reaches the driver. The second reads cells by position; they meet on _path what follows from the header of
    their file, worked out once per file, so files may
    differ in order, number and spelling of columns. A header is the first line of its file; in wide exports,
    whose first line says nothing, the first later line with a first cell. `columns` must be in every header."""
    lines = _lines(spark, path, pattern, skip_first=wide)
    commas = F.length("line") - F.length(F.replace("line", F.lit(","), F.lit("")))
    first = F.regexp_replace(F.substring_index("line", ",", 1), '"', "")
    heads = (first != "") & (first != "NA") if wide else F.lit(True)
    found = sized(lines.groupBy("_path").agg(
        F.min_by(F.when(heads, F.col("line")), F.when(heads, F.col("_at"))).alias("line"), F.max(commas).alias("commas")
    ))
    names = [f"_c{i}" for i in range((found.agg(F.max("commas")).first()[0] or 0) + 1)]
    layout = schema._strings(*names)
    parsed = F.from_csv("line", ", ".join(f"{n} string" for n in names), {"nullValue": "NA"})
    headers = found.where(F.col("line").isNotNull()).select(
        "_path", F.array(*[parsed[n] for n in names]).alias("header"))
    if columns:
        lacking = F.array_except(F.array(*map(F.lit, columns)), _names_of(F.col("header")))
        short = headers.select("_path", "header", lacking.alias("lacking")).where(F.size("lacking") > 0).first()
        if short:
            among = ", ".join(c for c in short.header if c is not None)
            raise ValueError(f"{short['_path']}: no column for {', '.join(short.lacking)} among {among}")
    rows = _scan_rows(spark, path, layout, pattern).select(
        dataset_name(F.col("_metadata.file_name")).alias("source_file"),
        F.col("_metadata.file_path").alias("_path"), F.array(*names).alias("cells"),
    )
    if wide:
        rows = rows.filter(F.coalesce(F.col("cells")[0], F.lit("")) != "")
    return rows, headers


def _scan_csv(
    spark: SparkSession, path: str, columns: T.StructType, pattern: str | None, keep_all: bool = False
) -> DataFrame:
    """Text columns of CSV files, bound by the names in their own header.

    Files of one folder may have different headers; each must have all columns. Further ones are ignored or, with
    `keep_all`, follow in alphabetical order, NULL in files that lack them. Only their names reach the driver."""
    rows, headers = _headed(spark, path, pattern, False, columns.names)
    headers, names = headers.select("_path", _names_of(F.col("header")).alias("_names")), list(columns.names)
    if keep_all:
        each = headers.select(F.explode(F.array_distinct("_names")).alias("name")).distinct()
        more = each.filter((F.col("name") != "") & ~F.col("name").isin(*names))
        names += sorted(x.name for x in more.collect())
    places = headers.select("_path", *((F.array_position("_names", c).cast("int") - 1).alias(f"_at{k}") for k, c in enumerate(names)))
    return rows.join(sized(places), "_path").select(*(F.get("cells", F.col(f"_at{k}")).alias(c) for k, c in enumerate(names)))


def _scan_rows(spark: SparkSession, path: str, columns: T.StructType, pattern: str | None) -> DataFrame:
    """CSV rows after the first line of each file, bound by position."""
    reader = spark.read.schema(columns).option("header", True).option("nullValue", "NA")
    return _matching(reader.option("recursiveFileLookup", True).csv(path), pattern)


def read_csv(
    spark: SparkSession, path: str, columns: T.StructType, pattern: str | None = None
) -> DataFrame:
    """CSV files of one layout, columns by name in any order. "NA" and empty cells are missing; numbers are read from text."""
    text = T.StructType([T.StructField(f.name, T.StringType()) for f in columns])
    raw = _scan_csv(spark, path, text, pattern)
    return raw.select(*[
        (blank_to_null(f.name) if isinstance(f.dataType, T.StringType) else to_number(f.name).cast(f.dataType))
        .alias(f.name)
        for f in columns
    ])


def read_long(
    spark: SparkSession, path: str, columns: T.StructType = schema.SKYLINE_LONG,
    numeric: tuple[str, ...] = schema.SKYLINE_NUMERIC, pattern: str | None = None, keep_all: bool = False,
) -> DataFrame:
    """Long exports: markers of missing values removed, numeric columns cast. `keep_all` keeps the columns
    no step reads."""
    return cast_numeric_columns(null_markers(_scan_csv(spark, path, columns, pattern, keep_all)), numeric)


def load_standards(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, schema.STANDARDS)


def load_transitions(spark: SparkSession, path: str, pattern: str = "(?i)master") -> DataFrame:
    """Triple-quad master list. An empty secondary-trace cell is kept: it means `no`."""
    raw = _scan_csv(spark, path, schema._strings(*schema.TRANSITIONS.names), pattern)
    return raw.withColumns({
        "daughter": to_number("daughter"), "second_trace": F.coalesce("second_trace", F.lit("")),
    })


def read_qc_report(spark: SparkSession, path: str, columns: T.StructType) -> DataFrame:
    """An earlier quality-control report: the parameter rows on top have no replicate and are skipped."""
    layout = T.StructType(schema._strings("description", "value").fields + columns.fields)
    return read_csv(spark, path, layout).drop("description", "value").filter(
        F.col("replicate_name").isNotNull()
    )


def wide_header(spark: SparkSession, path: str, pattern: str | None = None) -> DataFrame:
    """Data rows of wide exports with the header of their own file: source_file, header, cells.

    The first line of every file is skipped. Then lines with an empty first cell are sample metadata;
    the first line with a first cell is the header, and the rest is data. Files may differ in header
    and width and may be split over tasks."""
    rows, headers = _headed(spark, path, pattern, wide=True)
    # the header is a row here; one that is said again further down is no data either
    return rows.join(headers, "_path").filter(~F.col("cells").eqNullSafe(F.col("header"))).select("source_file", "header", "cells")


def syntactic(name: Column) -> Column:
    """Characters a column name may not contain become dots."""
    return F.regexp_replace(name, r"[^A-Za-z0-9._]", ".")


def read_wide(
    spark: SparkSession, path: str, measure: str, pattern: str | None = None, ion_column: str | None = None,
    descriptors: dict[str, str] | None = None,
) -> DataFrame:
    """Wide exports straight to long rows: replicate_name, the measure, and the chosen descriptors.

    `descriptors` maps raw headers to column names. Features named Unknown are dropped."""
    descriptors = descriptors or {"Alignment ID": "alignment_id", "Metabolite name": "metabolite_name"}
    rows = wide_header(spark, path, pattern)

    def cell(header: str) -> Column:
        return F.get("cells", F.array_position("header", header).cast("int") - 1)

    sample = F.explode(F.filter(
        F.arrays_zip("header", "cells"), lambda pair: pair["header"].rlike(SAMPLE_HEADER)
    )).alias("_sample")
    long = rows.select("source_file", *[cell(h).alias(n) for h, n in descriptors.items()], sample)
    if "metabolite_name" in descriptors.values():
        long = long.filter(F.col("metabolite_name") != "Unknown")
    ids = [
        F.col(n).try_cast("int").alias(n) if n == "alignment_id" else F.col(n) for n in descriptors.values()
    ]
    ion = [F.lit(ion_column).alias("ion_column")] if ion_column else []
    return long.select(
        syntactic(F.col("_sample.header")).alias("replicate_name"),
        to_number("_sample.cells").alias(measure), *ids, *ion,
    )
