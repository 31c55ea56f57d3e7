import pytest

from peakflow.operators import fragments as R
from peakflow.params import CORRECTED, QcParams
from tests.helpers import by

ROWS = "replicate_name string, precursor_ion_name string, precursor_mz double, product_mz double, area double, background double, height double, retention_time double"
P = QcParams()


def pair(run, quan, second, compound="A", mz=(50.0, 70.0)):
    return [
        (run, compound, 100.0, mz[0], quan, 10.0, 5000.0, 5.0),
        (run, compound, 100.0, mz[1], second, 10.0, 5000.0, 5.0),
    ]


@pytest.fixture()
def table(spark):
    return spark.createDataFrame(
        pair("1_Std_a_1", 2000.0, 1000.0) + pair("1_Std_a_2", 3000.0, 1000.0)
        + pair("1_Blk_b_1", 50.0, 900.0) + pair("1_Blk_b_2", None, 900.0)
        + pair("1_Smp_s_1", 9000.0, 1000.0) + pair("1_Smp_s_2", 2500.0, 100.0)
        + [("1_Std_a_1", "B", 100.0, 55.0, 10.0, 1.0, 1.0, 1.0)],
        ROWS,
    )


@pytest.fixture()
def listed(spark):
    return spark.createDataFrame(
        [("A", 50.00004, "yes", ""), ("A", 70.0, "no", "yes"), ("B", 99.0, "yes", "")],
        "compound_name string, daughter double, quan_trace string, second_trace string",
    )


def test_transitions_match_rounded_masses(table, listed):
    rows = by(R.attach_transitions(table, listed), "replicate_name", "precursor_ion_name", "product_mz")
    quan = rows["1_Std_a_1", "A", 50.0]
    assert quan["quan_trace"] is True and quan["second_trace"] is False
    assert rows["1_Std_a_1", "B", 55.0]["quan_trace"] is None


def test_transitions_match_across_bin_edges(spark):
    """Every place of a listed ion within its bin, and measured ions on both sides of the tolerance."""
    tolerance, listed, table = 0.01, [], []
    for k in range(200):
        mz = 50 + k * 0.0017
        listed.append((f"c{k}", mz, "yes", ""))
        table += [("r", f"c{k}", 1.0, mz + f * tolerance, 1.0, 0.0, 0.0, float(f)) for f in (-1.5, -1.01, -0.99, -0.3, 0, 0.99, 1.01, 2.5)]
    table.append(("r", "none", 1.0, None, 1.0, 0.0, 0.0, 9.0))
    listed += [("none", None, "no", "yes"), ("c0", 50.005, "no", "yes")]
    df = R.attach_transitions(spark.createDataFrame(table, ROWS), spark.createDataFrame(
        listed, "compound_name string, daughter double, quan_trace string, second_trace string"), tolerance)
    rows = df.collect()
    assert {(r.precursor_ion_name, r.retention_time) for r in rows if r.quan_trace} == {(f"c{k}", f) for k in range(200) for f in (-0.99, -0.3, 0.0, 0.99)}
    assert {r.retention_time for r in rows if r.second_trace and r.precursor_ion_name == "c0"} == {-0.3, 0.0, 0.99, 1.01}
    assert [r.quan_trace for r in rows if r.precursor_ion_name == "none"] == [False]
    assert len(rows) == len(table) + 3


def test_fragment_checks(table, listed):
    frags = R.check_fragments(table, listed, "Std")
    rows = by(frags, "replicate_name", "precursor_ion_name", "product_mz")
    quan = rows["1_Std_a_1", "A", 50.0]
    assert quan["two_fragments"] and quan["qt_five_percent"] == 2.5 and quan["significant_size"]
    assert rows["1_Std_a_1", "A", 70.0]["significant_size"] is None
    assert rows["1_Std_a_1", "B", 55.0]["two_fragments"] is False
    assert [r[0] for r in R.assert_two_fragments(frags).collect()] == ["B"]
    with pytest.raises(ValueError):
        R.assert_two_fragments(frags, strict=True)


def test_five_percent_rule_in_corrected_mode_uses_areas(table, listed):
    rows = by(R.check_fragments(table, listed, "Smp", CORRECTED), "replicate_name", "product_mz")
    assert rows["1_Smp_s_1", 50.0]["significant_size"] is True
    assert rows["1_Smp_s_2", 50.0]["significant_size"] is False
    assert rows["1_Smp_s_2", 50.0]["qt_five_percent"] == 125.0


def test_repeated_fragments_count_once(table, listed):
    twice = table.unionByName(table)
    assert R.check_fragments(twice, listed, "Std").count() == R.check_fragments(table, listed, "Std").count()


def test_ion_ratio_range(table, listed):
    rows = by(R.ion_ratio_reference(R.check_fragments(table, listed, "Std")), "precursor_ion_name")
    assert (rows["A"]["ir_min"], rows["A"]["ir_max"]) == (2.0, 3.0)
    assert rows["B"]["ir_min"] == float("inf")


def _flags(table, listed, mode):
    ranges = R.ion_ratio_reference(R.check_fragments(table, listed, "Std", mode), mode)
    return by(R.ion_ratio_flags(table, listed, ranges, P, mode), "replicate_name", "product_mz")


def test_reference_mode_takes_the_first_replicates_ratio_for_all(table, listed):
    rows = _flags(table, listed, "reference")
    assert rows["1_Smp_s_1", 50.0]["ir_flag"] == rows["1_Smp_s_2", 50.0]["ir_flag"] == "IR.Flag"
    calm = table.filter("replicate_name <> '1_Smp_s_1'")
    assert _flags(calm, listed, CORRECTED)["1_Smp_s_2", 50.0]["ir_flag"] == "IR.Flag"


def test_corrected_mode_takes_each_replicates_ratio(spark, table, listed):
    more = table.unionByName(spark.createDataFrame(pair("1_Smp_s_3", 2500.0, 1000.0), ROWS))
    assert _flags(more, listed, CORRECTED)["1_Smp_s_3", 50.0]["ir_flag"] is None
    assert _flags(more, listed, "reference")["1_Smp_s_3", 50.0]["ir_flag"] == "IR.Flag"


def test_blank_reference_uses_the_quantitative_trace(table, listed):
    assert by(R.tqs_blank_reference(table, listed), "precursor_ion_name")["A"]["blank_max"] == 50.0


def test_quality_control_keeps_the_quantitative_trace(table, listed):
    reference = R.tqs_qc(table.filter("precursor_ion_name = 'A'"), listed, P, strict=True)
    rows = by(reference, "replicate_name")
    assert set(rows) == {"1_Smp_s_1", "1_Smp_s_2"} and "area_with_qc" not in reference.columns
    assert rows["1_Smp_s_1"]["all_flags"] == "IR.Flag"
    corrected = R.tqs_qc(table, listed, P, CORRECTED)
    assert {"area_with_qc", "blank_flag", "ir_flag"} <= set(corrected.columns)
    with pytest.raises(ValueError):
        R.tqs_qc(table, listed, P, strict=True)
