"""Registered queries against their SQL on the smallest scale, and checks on their plans."""

import pytest

from checks.compare import database, rows_of
from checks.oracle import oracle_sql
from checks.registry import queries
from tests.helpers import forbidden_in

SF = "/root/testdata/sf0.001"
NAMES = sorted(queries())

# The rest is a step of one of these or compared with plain Python elsewhere; the comparison tool runs all.
COMPARED = [
    "analyse_two_modes", "assemble_measures", "attach_transitions", "bmis_candidates", "bmis_normalize",
    "check_fragments_corrected", "drop_mode_duplicates", "formula_atoms_corrected", "is_to_is_rsd",
    "mode_duplicate_stats", "mole_fractions", "msdial_qc", "msdial_qc_corrected", "pooled_rsd",
    "qc_parameter_report", "rf_dimensions", "skyline_qc", "skyline_qc_corrected", "standardize_names",
    "tqs_qc", "tqs_qc_corrected", "update_compound_names", "wide_header", "long_two_headers",
    "single_fragments", "transitions_within_tolerance", "replicate_mismatch", "tqs_report", "ion_ratio_table",
    "combined_peaks", "reverse_phase_export", "bmis_candidates_odd", "bmis_normalize_odd",
]


@pytest.fixture(scope="module")
def con():
    return database(SF)


def test_every_query_has_its_sql():
    assert NAMES == sorted(oracle_sql())


@pytest.mark.parametrize("name", COMPARED)
def test_query_equals_its_sql(spark, con, name):
    df = queries()[name](spark, SF)
    assert forbidden_in(df) == []
    result = con.execute(oracle_sql()[name])
    columns = [d[0] for d in result.description]
    assert sorted(df.columns) == sorted(columns)
    assert rows_of(df.columns, df.collect()) == rows_of(columns, result.fetchall())


def test_columns_are_pruned_at_the_scan(spark):
    df = queries()["run_types_present"](spark, SF)
    text = df._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<l_partkey:bigint,l_suppkey:bigint,l_linenumber:int" in text
    assert "l_shipdate" not in text
