"""Small frames and result access for the unit tests."""

from __future__ import annotations

PEAKS = "replicate_name string, metabolite_name string, area_value double, mz_value double, rt_value double, sn_value double, alignment_id int"
QC_ROWS = "replicate_name string, metabolite_name string, area_with_qc double"
STANDARDS = (
    "compound_name string, compound_name_original string, compound_type string, column_type string, "
    "concentration_um double, hilic_mix string, empirical_formula string"
)


def peak(replicate, compound, area=5000.0, rt=5.0, sn=10.0):
    return (replicate, compound, area, 100.0, rt, sn, 1)


def by(df, *keys):
    """Rows as dicts, keyed by one or several columns."""
    rows = [r.asDict() for r in df.collect()]
    return {tuple(r[k] for k in keys) if len(keys) > 1 else r[keys[0]]: r for r in rows}


def standard(name, kind="Standard", conc=1.0, mix="Mix1", formula="C2H4N2", column="HILIC", original=None):
    return (name, original, kind, column, conc, mix, formula)


def plan_of(df) -> str:
    """Text of the physical plan."""
    import contextlib
    import io

    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


def forbidden_in(df) -> list[str]:
    """Operators no plan of this package may contain."""
    text = plan_of(df)
    return [w for w in ("EvalPython", "InPandas", "InArrow", "CartesianProduct", "NestedLoopJoin") if w in text]
