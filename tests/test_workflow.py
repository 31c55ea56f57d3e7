"""Whole analyses from raw files to written results."""

import datetime as dt

import pytest

from checks.registry import peaks_modes, standards
from peakflow.operators import bmis as B
from peakflow.operators.msdial import msdial_qc
from peakflow.operators.skyline import skyline_qc, to_peaks
from peakflow.params import CORRECTED, REFERENCE, QcParams
from peakflow.plans import ingest, outputs, workflow
from tests.helpers import STANDARDS, by, standard

SF = "/root/testdata/sf0.001"
DAY = dt.date(2020, 1, 2)


def _wide(values, names=("Ours_A_x", "Unknown")):
    head = "line one\n,Class\nAlignment ID,Metabolite name,170410_Smp_A_1,170410_Std_B_1\n"
    return head + "".join(f"{i},{n},{v},{v + 1}\n" for i, (n, v) in enumerate(zip(names, values), 1))


def test_wide_files_to_flags_and_written_tables(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    for k, measure in enumerate(("Area", "Mz", "SN", "RT")):
        for mode in ("HILICPos", "HILICNeg"):
            (raw / f"CRUISE_{measure}_{mode}_Example.csv").write_text(_wide([1000.0 + k, 5.0]))
    (raw / "OTHER_Area_HILICPos_Example.csv").write_text(_wide([1.0, 2.0]))
    dim = spark.createDataFrame([standard("New A", original="A")], STANDARDS)
    peaks = ingest.wide_peaks(spark, str(raw), dim, "CRUISE", "Ours_")
    rows = by(peaks, "ion_column", "replicate_name")
    assert len(rows) == 4 and {r["metabolite_name"] for r in rows.values()} == {"New A"}
    row = rows["HILICPos", "170410_Smp_A_1"]
    assert [row[c] for c in ("area_value", "mz_value", "sn_value", "rt_value")] == [1000.0, 1001.0, 1002.0, 1003.0]
    qc = msdial_qc(peaks, QcParams())
    written = outputs.write_wide_qc(peaks, qc, QcParams(), str(tmp_path / "out"), DAY)
    assert spark.read.parquet(written["qc_output"]).count() == 6 + 4
    assert spark.read.parquet(written["rt_table"]).first()["rt_max"] == 1004.0
    single = ingest.wide_peaks(spark, str(raw), dim, "CRUISE.*Pos", "Ours_", hilic=False)
    assert single.count() == 2 and "ion_column" not in single.columns


@pytest.mark.parametrize("mode, name", [(REFERENCE, None), (CORRECTED, "X")])
def test_long_files_to_flags_and_written_tables(spark, tmp_path, mode, name):
    raw = tmp_path / "raw"
    raw.mkdir()
    head = "Replicate Name,Precursor Ion Name,Retention Time,Area,Background,Height,Mass Error PPM\n"
    (raw / "CRUISE_HILICPos.csv").write_text(head + "1_Smp_a_1,Old,5,6000,100,#N/A,0\n1_Std_a_1,Old,5,6000,100,9000,0\n")
    (raw / "CRUISE_HILICNeg.csv").write_text(head + "1_Smp_a_1,X,5,6000,100,9000,0\n")
    dim = spark.createDataFrame([standard("A", original="Old")], STANDARDS)
    peaks = ingest.long_peaks(spark, str(raw), dim, "CRUISE", mode=mode)
    rows = by(peaks, "ion_column", "replicate_name")
    assert rows["HILICPos", "1_Smp_a_1"]["precursor_ion_name"] == "A"
    assert rows["HILICPos", "1_Smp_a_1"]["height"] is None
    assert rows["HILICNeg", "1_Smp_a_1"]["precursor_ion_name"] == name
    qc = skyline_qc(peaks, QcParams(), mode)
    assert to_peaks(qc).filter("metabolite_name = 'A'").count() == 2
    written = outputs.write_long_qc(peaks, qc, QcParams(), str(tmp_path / "out"), DAY, "now", mode)
    assert spark.read.parquet(written["qc_output"]).count() == 9 + 3
    assert spark.read.parquet(written["sn_table"]).count() == 2


@pytest.mark.parametrize("mode", [REFERENCE, CORRECTED])
def test_analysis_and_its_written_results(spark, tmp_path, mode):
    peaks, dim = peaks_modes(spark, SF), standards(spark, SF)
    measured_runs, qc = workflow.quality_control(peaks, mode=mode)
    assert measured_runs.count() > qc.count()
    results = workflow.analyse(peaks, dim, mode=mode)
    written = outputs.write_quantified(results, str(tmp_path), DAY)
    summary = spark.read.parquet(written["quantified_summary"])
    measured = spark.read.parquet(written["quantified_measurements"])
    assert summary.count() == measured.select("metabolite_name").distinct().count() > 0
    assert spark.read.parquet(written["quantified_per_sample"]).count() > 0
    internal = B.internal_standards(dim, "HILIC", mode)
    data = B.bmis_input(qc)
    assert results.normalized.count() > 0
    if mode == REFERENCE:
        bmis = outputs.write_bmis(data, internal, results.normalized, str(tmp_path / "bmis"), DAY)
        assert spark.read.text(bmis["quick_report"]).first()[0].startswith("Percent of Mass Features")
        assert spark.read.parquet(bmis["is_to_is_rsd"]).count() == 49
        dups = outputs.write_duplicates(B.bmis_input(msdial_qc(peaks)), str(tmp_path / "dups"), DAY)
        assert spark.read.text(dups["duplicate_report"]).count() == spark.read.parquet(dups["duplicates"]).count() > 0


def test_triple_quad_files_to_flags_and_written_tables(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    head = "Replicate Name,Protein Name,Precursor Ion Name,Precursor Mz,Product Mz,Retention Time,Area,Background,Height,Note\n"
    lines = [f"1_{run}_a_1,P,{name},100,{mz},5,{area},10,5000,n\n"
             for name in ("A", "B") for run, k in (("Std", 1), ("Blk", 0.01), ("Smp", 2), ("Poo", 2))
             for mz, area in ((50, 4000 * k), (70, 2000 * k))]
    (raw / "CRUISE.csv").write_text(head + "".join(lines))
    (raw / "master.csv").write_text("Compound Name,Daughter,Quan Trace,2nd Trace\nA,50,yes,\nA,70,no,yes\nB,50,yes,\nB,70,no,yes\n")
    dim = spark.createDataFrame([standard("A", original="A"), standard("B", original="B")], STANDARDS)
    from peakflow.sources.readers import load_transitions

    peaks = ingest.long_peaks(spark, str(raw), dim, "CRUISE", hilic=False, triple_quad=True)
    assert peaks.select("note").distinct().first()[0] == "n"
    listed = load_transitions(spark, str(raw))
    tables = workflow.triple_quad_quality_control(peaks, listed)
    assert by(tables.ion_ratios, "precursor_ion_name")["A"]["ir_min"] == 2.0
    written = outputs.write_triple_quad_qc(tables, QcParams(), str(tmp_path / "out"), DAY, "now")
    assert spark.read.parquet(written["qc_output"]).count() == 10 + 2
    assert spark.read.parquet(written["height_table"]).columns[2:4] == ["precursor_mz", "product_mz"]
    assert spark.read.parquet(written["sn_table"]).count() == 8
    assert spark.read.parquet(written["ion_ratio_table"]).count() == spark.read.parquet(written["blank_table"]).count() == 2
    lonely = peaks.filter("not (precursor_ion_name = 'B' and product_mz = 70)")
    with pytest.raises(ValueError, match="fewer than two fragments"):
        workflow.triple_quad_quality_control(lonely, listed)
    assert workflow.triple_quad_quality_control(lonely, listed, strict=False).qc.count() > 0


def test_combined_peaks_replace_their_run_date_only(spark, tmp_path):
    one, two = spark.range(3).toDF("x"), spark.range(5).toDF("x")
    first = outputs.write_combined(one, "MSDial", "HILIC.*QE", str(tmp_path), DAY)
    other = outputs.write_combined(two, "MSDial", "HILIC.*QE", str(tmp_path), dt.date(2020, 1, 3))
    assert "MSDial_combined_HILIC_QE" in first
    outputs.write_combined(two, "MSDial", "HILIC.*QE", str(tmp_path), DAY)
    assert spark.read.parquet(first).count() == spark.read.parquet(other).count() == 5


def test_strict_analysis_stops(spark):
    runs = [("1_Std_x_1", 1), ("1_Blk_x_1", 1), ("1_Poo_x_1", 1), ("1_Smp_a_1", 1)]
    rows = [(r, c, 5000.0, 100.0, 5.0, 10.0, 1) for r, _ in runs for c in ("A", "S")]
    schema = ("replicate_name string, metabolite_name string, area_value double, mz_value double, rt_value double, "
              "sn_value double, alignment_id int")
    dim = spark.createDataFrame([standard("A"), standard("S", kind="Internal Standard")], STANDARDS)
    full = spark.createDataFrame(rows, schema)
    assert workflow.analyse(full, dim, strict=True).normalized.count() > 0
    with pytest.raises(ValueError, match="blk"):
        workflow.analyse(full.filter("replicate_name not like '%Blk%'"), dim, strict=True)
    with pytest.raises(ValueError, match="others occur"):
        workflow.quality_control(full.unionByName(spark.createDataFrame([("odd", "A", 1.0, 1.0, 1.0, 1.0, 1)], schema)), strict=True)
    with pytest.raises(ValueError, match="1_Smp_a_1"):
        workflow.analyse(full.filter("not (replicate_name like '%Smp%' and metabolite_name = 'S')"), dim, strict=True)
    with pytest.raises(ValueError, match="missing"):
        workflow.quality_control(full.limit(0), strict=True)


def test_long_exports_feed_the_normalisation(spark):
    from checks.registry import skyline

    qc = to_peaks(skyline_qc(skyline(spark, SF), QcParams(rt_flex=40.0)))
    internal = B.internal_standards(standards(spark, SF))
    final = B.bmis_choice(B.bmis_input(qc), internal)
    assert final.filter("final_bmis <> 'Inj_vol'").count() > 0


def test_only_samples_and_pools_make_duplicates(spark):
    """A compound doubled in a standard run keeps its rows; one doubled in a sample keeps them for response factors."""
    from peakflow.schema import HILIC_NEGATIVE

    rows = [(mode, run, name, 5000.0, 100.0, 5.0, 10.0, 1)
            for mode, run, name in (
                ("HILICPos", "1_Std_x_1", "A"), (HILIC_NEGATIVE, "1_Std_x_1", "A"), (HILIC_NEGATIVE, "1_Smp_a_1", "A"),
                ("HILICPos", "1_Smp_a_1", "B"), (HILIC_NEGATIVE, "1_Smp_a_1", "B"), (HILIC_NEGATIVE, "1_Std_x_1", "B"))]
    peaks = spark.createDataFrame(
        rows, "ion_column string, replicate_name string, metabolite_name string, area_value double, mz_value double, "
              "rt_value double, sn_value double, alignment_id int")
    measured, qc = workflow.quality_control(peaks)
    left = {(r.ion_column, r.replicate_name, r.metabolite_name) for r in qc.collect()}
    assert left == {(m, r, n) for m, r, n, *_ in rows if not (n == "B" and m == HILIC_NEGATIVE)}
    assert measured.filter("metabolite_name = 'B' and replicate_name like '%Std%'").count() == 1


def test_staging_leaves_the_session_alone(spark):
    from peakflow.sources.staging import staging_dir

    before = spark.conf.get("spark.checkpoint.dir")
    assert staging_dir(spark) == before == spark.conf.get("spark.checkpoint.dir")
