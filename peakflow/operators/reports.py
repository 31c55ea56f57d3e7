"""Parameter rows and one-line reports that go with a result table."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession

from peakflow.params import QcParams


def _number_text(value: float) -> str:
    """Shortest plain or scientific text of a parameter value."""
    plain = format(Decimal(repr(float(value))).normalize(), "f")
    mantissa, exponent = f"{value:.14e}".split("e")
    mantissa = mantissa.rstrip("0").rstrip(".")
    scientific = f"{mantissa}e{int(exponent):+03d}"
    return scientific if len(scientific) < len(plain) else plain


def msdial_parameters(p: QcParams, run_date: dt.date) -> list[tuple[str, str | None]]:
    # Wording of the parameter rows on top of a quality-control report.
    return [
        (run_date.isoformat(), None),
        ("Hello! Welcome to the world of MSDIAL QE Quality Control! ", None),
        ("Minimum area for a real peak: ", _number_text(p.area_min)),
        ("RT flexibility: ", _number_text(p.rt_flex)),
        ("Blank can be this fraction of a sample: ", _number_text(p.blk_thresh)),
        ("S/N ratio: ", _number_text(p.sn_min)),
    ]


def skyline_parameters(
    p: QcParams, run_date: dt.date, processed_on: str, triple_quad: bool = False
) -> list[tuple[str, str | None]]:
    # Wording of the parameter rows on top of a quality-control report.
    instrument = "TQS" if triple_quad else "QE"
    rows = [
        (run_date.isoformat(), None),
        (f"Hello! Welcome to the world of Skyline {instrument} Quality Control! ", None),
        ("Maximum height for a real peak: ", _number_text(p.height_max)),
        ("Minimum height for a real peak: ", _number_text(p.height_min)),
        ("Maximum area for a real peak: ", _number_text(p.area_min)),
        ("RT flexibility: ", _number_text(p.rt_flex)),
        ("Blank can be this fraction of a sample: ", _number_text(p.blk_thresh)),
        ("S/N ratio: ", _number_text(p.sn_min)),
    ]
    if triple_quad:
        rows.append(("Ion ratio flexibility", _number_text(p.ir_flex)))
    return rows + [("Processed on: ", processed_on)]


def parameter_table(spark: SparkSession, rows: list[tuple[str, str | None]]) -> DataFrame:
    return spark.createDataFrame(rows, "description string, value string")


def qc_parameter_report(qc: DataFrame, parameters: DataFrame) -> DataFrame:
    """The quality-control table below its parameter rows."""
    return parameters.unionByName(qc, allowMissingColumns=True)
