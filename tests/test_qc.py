import datetime as dt

import pytest

from peakflow.operators import msdial as M
from peakflow.operators import reports
from peakflow.operators import skyline as S
from peakflow.params import CORRECTED, QcParams
from tests.helpers import PEAKS, STANDARDS, by, peak, standard

P = QcParams()
INF = float("inf")


@pytest.fixture()
def peaks(spark):
    return spark.createDataFrame([
        peak("1_Std_a_1", "A", rt=5.0), peak("1_Std_a_2", "A", rt=5.2), peak("1_Std_a_3", "A", rt=0.0),
        peak("1_Blk_b_1", "A", area=100.0), peak("1_Blk_b_2", "A", area=2000.0),
        peak("1_Smp_s_1", "A", rt=5.7), peak("1_Smp_s_2", "A", rt=5.0, sn=1.0),
        peak("1_Smp_s_3", "A", area=500.0, rt=5.0), peak("1_Smp_s_4", "A", area=None, rt=None, sn=None),
        # every standard time missing
        peak("1_Std_a_1", "B", rt=0.0), peak("1_Smp_s_1", "B"),
        # no standard at all
        peak("1_Smp_s_1", "C"),
        # one blank area missing
        peak("1_Blk_b_1", "D", area=4900.0), peak("1_Blk_b_2", "D", area=None), peak("1_Smp_s_1", "D"),
    ], PEAKS)


def test_rt_reference(peaks):
    rows = by(M.rt_reference(peaks), "metabolite_name")
    assert (rows["A"]["rt_min"], rows["A"]["rt_max"]) == (5.0, 5.2)
    assert rows["A"]["rt_diff"] == pytest.approx(0.2)
    assert (rows["B"]["rt_min"], rows["B"]["rt_max"], rows["B"]["rt_diff"]) == (INF, -INF, INF)
    assert "C" not in rows
    assert by(M.rt_reference(peaks, CORRECTED), "metabolite_name")["B"]["rt_min"] is None


def test_one_missing_blank_hides_the_range_in_reference_mode(peaks):
    assert by(M.blank_reference(peaks), "metabolite_name")["D"]["blk_max"] is None
    assert by(M.blank_reference(peaks), "metabolite_name")["A"]["blk_max"] == 2000.0
    assert by(M.blank_reference(peaks, CORRECTED), "metabolite_name")["D"]["blk_max"] == 4900.0


def test_flags(peaks):
    rows = by(M.msdial_qc(peaks, P), "replicate_name", "metabolite_name")
    late = rows["1_Smp_s_1", "A"]
    assert late["rt_flag"] == "RT.Flag" and late["all_flags"] == "RT.Flag, "
    assert rows["1_Smp_s_2", "A"]["all_flags"] == "SN.Flag, "
    small = rows["1_Smp_s_3", "A"]
    assert small["area_min_flag"] and small["blank_flag"] and small["area_with_qc"] is None
    missing = rows["1_Smp_s_4", "A"]
    assert missing["all_flags"] is None and missing["area_with_qc"] is None
    # a time of 0 is compared as 0
    assert rows["1_Std_a_3", "A"]["rt_flag"] == "RT.Flag"


def test_default_thresholds():
    assert QcParams() == QcParams(area_min=1000, rt_flex=0.4, blk_thresh=0.3, sn_min=4)
    reverse = QcParams.reverse_phase()
    assert (reverse.area_min, reverse.rt_flex, reverse.blk_thresh, reverse.sn_min) == (5000, 0.2, 0.2, 4)


def test_range_ends_are_flagged(spark):
    df = spark.createDataFrame(
        [peak("1_Std_a_1", "A", rt=5.0), peak("1_Smp_s_1", "A", rt=5.5), peak("1_Smp_s_2", "A", rt=4.5)], PEAKS
    )
    rows = by(M.msdial_qc(df, QcParams(rt_flex=0.5)), "replicate_name")
    assert rows["1_Smp_s_1"]["rt_flag"] == rows["1_Smp_s_2"]["rt_flag"] == "RT.Flag"


def test_missing_standard_times_flag_everything_in_reference_mode_only(peaks):
    assert by(M.msdial_qc(peaks, P), "replicate_name", "metabolite_name")["1_Smp_s_1", "B"]["rt_flag"] == "RT.Flag"
    corrected = by(M.msdial_qc(peaks, P, CORRECTED), "replicate_name", "metabolite_name")
    assert corrected["1_Smp_s_1", "B"]["rt_flag"] is None
    for mode_rows in (corrected, by(M.msdial_qc(peaks, P), "replicate_name", "metabolite_name")):
        assert mode_rows["1_Smp_s_1", "C"]["rt_flag"] is None


def test_single_steps_agree_with_the_whole(peaks):
    whole = by(M.msdial_qc(peaks, P), "replicate_name", "metabolite_name")
    step = M.blank_flags(
        M.rt_flags(M.sn_area_flags(peaks, P), M.rt_reference(peaks), P), M.blank_reference(peaks), P
    )
    for key, row in by(step, "replicate_name", "metabolite_name").items():
        for flag in ("sn_flag", "area_min_flag", "rt_flag", "blank_flag"):
            assert row[flag] == whole[key][flag], (key, flag)


def test_result_does_not_depend_on_partitions_or_order(peaks):
    a = sorted(map(str, M.msdial_qc(peaks, P).collect()))
    b = sorted(map(str, M.msdial_qc(peaks.orderBy("area_value").repartition(7), P).collect()))
    assert a == b


def test_rows_without_a_compound_name_meet_their_own_reference(spark):
    df = spark.createDataFrame([peak("1_Std_a_1", None, rt=5.0), peak("1_Smp_s_1", None, rt=9.0)], PEAKS)
    rows = by(M.msdial_qc(df, P), "replicate_name")
    assert rows["1_Smp_s_1"]["rt_flag"] == "RT.Flag"


def test_parameter_report(spark, peaks):
    qc = M.msdial_qc(peaks, P)
    table = reports.parameter_table(spark, reports.msdial_parameters(P, dt.date(2020, 1, 2)))
    report = reports.qc_parameter_report(qc, table)
    assert report.columns[:2] == ["description", "value"]
    rows = report.filter("description is not null").collect()
    assert [r["value"] for r in rows] == [None, None, "1000", "0.4", "0.3", "4"]
    assert report.filter("description is null").count() == peaks.count()
    skyline = reports.skyline_parameters(P, dt.date(2020, 1, 2), "now")
    assert dict(skyline)["Maximum height for a real peak: "] == "1e+08"
    assert len(reports.skyline_parameters(P, dt.date(2020, 1, 2), "now", triple_quad=True)) == 10


# --- long exports ---

LONG = (
    "replicate_name string, precursor_ion_name string, retention_time double, area double, background double, "
    "height double, mass_error_ppm double"
)


@pytest.fixture()
def long(spark):
    return spark.createDataFrame([
        ("1_Std_Mix1_1", "A", 5.0, 9000.0, 100.0, 5000.0, 0.0),
        ("1_std_Mix1_2", "A", 5.4, 9000.0, 100.0, 5000.0, 0.0),
        ("1_Blk_b_1", "A", 5.0, 4000.0, 100.0, 5000.0, 0.0),
        ("1_blk_b_2", "A", 5.0, None, 100.0, 5000.0, 0.0),
        ("1_Smp_s_1", "A", 6.0, 900.0, 0.0, 500.0, 0.0),
        ("1_Smp_s_2", "A", 5.1, 5000.0, 4000.0, 2e8, 0.0),
        ("1_Poo_p_1", "A", 5.1, 5000.0, 1000.0, 5000.0, 0.0),
        ("1_Std_Mix2_1", "B", None, 1.0, 1.0, 1.0, 0.0),
        ("1_Smp_s_1", "B", 5.1, 5000.0, 1000.0, 5000.0, 0.0),
    ], LONG)


def test_long_export_qc(long):
    rows = by(S.skyline_qc(long, P), "replicate_name", "precursor_ion_name")
    early = rows["1_Smp_s_1", "A"]
    assert early["all_flags"] == "RT.Flag, height.min.Flag,  area.min.Flag"
    assert early["area_with_qc"] is None and early["sn_flag"] is None
    assert rows["1_Smp_s_2", "A"]["all_flags"] == "overloaded.Flag,  SN.Flag"
    assert rows["1_Poo_p_1", "A"]["all_flags"] is None
    assert "blank_flag" not in rows["1_Poo_p_1", "A"]
    assert rows["1_Smp_s_1", "B"]["rt_flag"] == "RT.Flag"


def test_long_export_qc_corrected(long):
    rows = by(S.skyline_qc(long, P, CORRECTED), "replicate_name", "precursor_ion_name")
    assert rows["1_Smp_s_1", "A"]["blank_flag"] == "Blank.Flag"
    assert rows["1_Smp_s_1", "A"]["all_flags"] == "RT.Flag, height.min.Flag, area.min.Flag, Blank.Flag"
    assert rows["1_Smp_s_1", "B"]["rt_flag"] is None


def test_long_export_references(long):
    assert by(S.skyline_rt_reference(long), "precursor_ion_name")["A"]["rt_max"] == 5.4
    assert by(S.skyline_rt_reference(long, CORRECTED), "precursor_ion_name")["A"]["rt_reference"] == pytest.approx(5.2)
    assert by(S.skyline_blank_reference(long), "precursor_ion_name")["A"]["blank_max"] is None
    assert by(S.skyline_blank_reference(long, CORRECTED), "precursor_ion_name")["A"]["blank_max"] == 4000.0


def test_signal_to_noise_and_tables(long):
    sn = by(S.signal_to_noise(long), "replicate_name", "precursor_ion_name")
    assert len(sn) == 4 and sn["1_Smp_s_1", "A"]["signal_to_noise"] is None
    assert S.height_table(long).count() == S.area_table(long).count() == 4


def test_mix_filter(spark, long):
    standards = spark.createDataFrame([standard("A", mix="Mix2"), standard("B", mix="Mix2")], STANDARDS)
    kept = by(S.standard_mix_filter(long, standards), "replicate_name")
    assert set(kept) == {"1_Std_Mix2_1"}
    matrix = long.limit(1).selectExpr("'1_Std_H2OinMATRIX_1' replicate_name", *long.columns[1:])
    no_label = spark.createDataFrame([standard("A", mix=None)], STANDARDS)
    assert S.standard_mix_filter(matrix, no_label).count() == 1
    assert S.standard_mix_filter(long, no_label).count() == 0
    pattern = spark.createDataFrame([standard("A", mix="Mix[12]")], STANDARDS)
    assert S.standard_mix_filter(long, pattern).count() == 0
    assert S.standard_mix_filter(long, pattern, literal=False).count() == 1
    # reference keeps the standards only, corrected keeps all other runs as well (`std` is no `Std`)
    assert S.keep_own_mixes(long, standards).count() == 1
    assert S.keep_own_mixes(long, standards, CORRECTED).count() == 8


def test_bridge_to_the_normalisation(long):
    assert {"metabolite_name", "area_value", "area_with_qc"} <= set(S.to_peaks(S.skyline_qc(long, P)).columns)
