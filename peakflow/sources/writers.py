"""Result tables and text reports."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_table(df: DataFrame, path: str, run_date: dt.date, fmt: str = "parquet") -> str:
    """Write one result under a folder of its run date. Executors write their own partitions."""
    target = f"{path.rstrip('/')}/run_date={run_date.isoformat()}"
    writer = df.write.mode("overwrite")
    if fmt == "csv":
        writer.option("header", True).option("nullValue", "NA").csv(target)
    else:
        writer.format(fmt).save(target)
    return target


def write_tables(
    tables: dict[str, DataFrame], base: str, run_date: dt.date, fmt: str = "parquet", only: str | None = None
) -> dict[str, str]:
    """Write every named table; `only` keeps those whose name contains a text, in any case."""
    return {
        name: write_table(df, f"{base.rstrip('/')}/{name}", run_date, fmt)
        for name, df in tables.items()
        if only is None or only.lower() in name.lower()
    }


def write_lines(df: DataFrame, path: str, run_date: dt.date) -> str:
    """Write a one-column text report."""
    target = f"{path.rstrip('/')}/run_date={run_date.isoformat()}"
    df.write.mode("overwrite").text(target)
    return target


def quick_report_line(report: DataFrame) -> DataFrame:
    """The share of matched features as one line of text. Its wording."""
    return report.select(F.concat_ws(
        " ", F.lit("Percent of Mass Features that picked a BMIS:"), F.col("share_picked").cast("string"),
        F.lit("| RSD improvement cutoff"), F.col("cut_off").cast("string"),
        F.lit("| RSD minimum cutoff"), F.col("cut_off2").cast("string"),
    ).alias("line"))
