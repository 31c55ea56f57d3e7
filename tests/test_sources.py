import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from peakflow import schema
from peakflow.sources import readers as R
from peakflow.sources import writers as W
from peakflow.sources.staging import stage, staging_dir
from tests.helpers import by

FIRST = """eaten by the header,,,,
,Class,Smp,Smp,
,Type,1,1,
Alignment ID,Metabolite name,SMILES,170410_Smp_A_1,170410_Smp_A-2
1,"Cmpd_8, 15N",CC,10.5,NA
2,Unknown,CC,1,2
3,Ingot_x,,,1e3
"""
SECOND = """x
,,
Metabolite name,Alignment ID,170410_Poo_B_1
Other,7,33
"""


@pytest.fixture()
def exports(tmp_path):
    (tmp_path / "run_Area_pos.csv").write_text(FIRST)
    (tmp_path / "run_Area_neg.csv").write_text(SECOND)
    (tmp_path / "notes.txt.csv").write_text("a,b\nc,d\n")
    return str(tmp_path)


def test_headers_differ_per_file(spark, exports):
    rows = R.wide_header(spark, exports, "Area").collect()
    headers = {r["source_file"]: r["header"][:2] for r in rows}
    assert headers == {
        "run_Area_pos": ["Alignment ID", "Metabolite name"], "run_Area_neg": ["Metabolite name", "Alignment ID"],
    }
    assert len(rows) == 4


def test_wide_exports_become_long_rows(spark, exports):
    long = R.read_wide(spark, exports, "area_value", "Area_(pos|neg)", ion_column="HILICPos")
    rows = by(long, "alignment_id", "replicate_name")
    assert set(rows) == {
        (1, "170410_Smp_A_1"), (1, "170410_Smp_A.2"), (3, "170410_Smp_A_1"), (3, "170410_Smp_A.2"), (7, "170410_Poo_B_1"),
    }
    first = rows[1, "170410_Smp_A_1"]
    assert first["metabolite_name"] == "Cmpd_8, 15N" and first["area_value"] == 10.5 and first["ion_column"] == "HILICPos"
    assert rows[1, "170410_Smp_A.2"]["area_value"] is None and rows[3, "170410_Smp_A.2"]["area_value"] == 1000.0
    extra = R.read_wide(spark, exports, "area_value", "pos", descriptors={"Alignment ID": "alignment_id", "SMILES": "smiles"})
    assert {r["smiles"] for r in extra.collect()} == {"CC", None}


def test_many_small_splits_give_the_same_headers(spark, tmp_path):
    lines = FIRST.splitlines()[:4] + [f'{i},"C_{i}",CC,{i}.5,{i}' for i in range(500)]
    for k in range(3):
        (tmp_path / f"f{k}_Area.csv").write_text("\n".join(lines))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        long = R.read_wide(spark, str(tmp_path), "area_value")
        assert long.rdd.getNumPartitions() > 3
        assert long.count() == 3 * 500 * 2
        assert long.select("replicate_name").distinct().count() == 2
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_long_exports(spark, tmp_path):
    (tmp_path / "HILIC_pos.csv").write_text(
        "Replicate Name,Precursor Ion Name,Retention Time,Area,Background,Height,Mass Error PPM\n"
        '1_Smp_a_1,"A, x",5.1,#N/A,0,1e3,0.1\n1_Blk_a_1,#N/A,,100,1,2,NA\n'
    )
    (tmp_path / "other.csv").write_text("a\nb\n")
    rows = by(R.read_long(spark, str(tmp_path), pattern="pos"), "replicate_name")
    assert rows["1_Smp_a_1"]["area"] is None and rows["1_Smp_a_1"]["height"] == 1000.0
    assert rows["1_Smp_a_1"]["precursor_ion_name"] == "A, x"
    assert rows["1_Blk_a_1"]["precursor_ion_name"] is None and rows["1_Blk_a_1"]["retention_time"] is None


def test_dimensions(spark, tmp_path):
    (tmp_path / "standards.csv").write_text(
        "Compound_Name,Compound_Name_Original,Compound_Type,Column,Concentration_uM,HILIC_Mix,Empirical_Formula\n"
        'A,Old,Standard,HILIC,2.5,Mix1,C2\nB,"",Internal Standard,RP,NA,NA,C3\n'
    )
    rows = by(R.load_standards(spark, str(tmp_path / "standards.csv")), "compound_name")
    assert rows["A"]["concentration_um"] == 2.5 and rows["B"]["concentration_um"] is None
    assert rows["B"]["compound_name_original"] is None and rows["B"]["hilic_mix"] is None
    (tmp_path / "extras").mkdir()
    (tmp_path / "extras" / "TQS_Master_List.csv").write_text("Compound Name,Daughter,Quan Trace,2nd trace\nA,50.1,yes,\nA,70.2,no,yes\n")
    (tmp_path / "extras" / "else.csv").write_text("x\ny\n")
    listed = by(R.load_transitions(spark, str(tmp_path / "extras")), "daughter")
    assert listed[50.1]["second_trace"] == "" and listed[70.2]["quan_trace"] == "no"


def test_columns_are_bound_by_name(spark, tmp_path):
    (tmp_path / "standards.csv").write_text(
        "Compound_Type,Extra,Empirical_Formula,Concentration_uM,Column,HILIC_Mix,Compound_Name,Compound_Name_Original\n"
        "Internal Standard,zz,C2,2.5,HILIC,Mix1,A,Old\n")
    row = R.load_standards(spark, str(tmp_path / "standards.csv")).first()
    assert (row.compound_name, row.compound_type, row.concentration_um, row.column_type) == ("A", "Internal Standard", 2.5, "HILIC")
    (tmp_path / "short.csv").write_text("Compound_Type,Compound_Name\nx,A\n")
    with pytest.raises(ValueError, match="concentration_um"):
        R.load_standards(spark, str(tmp_path / "short.csv"))
    assert R.read_long(spark, str(tmp_path), pattern="nothing").count() == 0


def test_files_of_one_folder_may_have_different_headers(spark, tmp_path):
    (tmp_path / "a.csv").write_text("Replicate Name,Precursor Ion Name,Retention Time,Area,Background,Height,Mass Error PPM\nr1,A,1,2,3,4,5\n")
    (tmp_path / "b.csv").write_text('height,"x, y",AREA,replicate name,Mass-Error-PPM,Background,Precursor Ion Name,Retention Time,more\n40,z,20,r2,50,30,"B, b",10,q,too,many\n')
    rows = by(R.read_long(spark, str(tmp_path)), "replicate_name")
    assert [rows["r1"][c] for c in ("retention_time", "area", "background", "height", "mass_error_ppm")] == [1, 2, 3, 4, 5]
    assert [rows["r2"][c] for c in ("retention_time", "area", "background", "height", "mass_error_ppm")] == [10, 20, 30, 40, 50]
    assert rows["r2"]["precursor_ion_name"] == "B, b"


def test_wide_exports_are_scanned_twice(spark, exports):
    plan = R.wide_header(spark, exports, "Area")._jdf.queryExecution().toString()
    physical = plan[plan.index("== Physical Plan =="):]
    scans = re.findall(r"FileScan csv \[.*ReadSchema: struct<([^>]*)>", physical)
    assert {s.split(":")[0] for s in scans} == {"_c0", "line"}  # lines fill the cached headers, cells are the data
    assert sum(s.startswith("_c0") for s in scans) == 1


def test_results_round_trip(spark, tmp_path):
    day = dt.date(2020, 1, 2)
    df = spark.createDataFrame([("r", 1.5), (None, None)], "replicate_name string, area double")
    written = W.write_tables({"RT.table": df, "other": df}, str(tmp_path), day, fmt="csv", only="TABLE")
    assert list(written) == ["RT.table"]
    back = R.read_csv(spark, str(tmp_path / "RT.table"), df.schema)
    assert sorted(map(str, back.collect())) == sorted(map(str, df.collect()))
    path = W.write_table(df, str(tmp_path / "final"), day)
    assert path.endswith("run_date=2020-01-02") and spark.read.parquet(path).count() == 2


def test_reports_with_parameter_rows_are_read_by_content(spark, tmp_path):
    top = spark.createDataFrame([("2020-01-02", None), ("S/N ratio: ", "4")], "description string, value string")
    body = spark.createDataFrame([("r1", 1.5), ("r2", None)], "replicate_name string, area double")
    report = top.unionByName(body, allowMissingColumns=True)
    W.write_table(report, str(tmp_path), dt.date(2020, 1, 2), fmt="csv")
    back = R.read_qc_report(spark, str(tmp_path), body.schema)
    assert sorted(r["replicate_name"] for r in back.collect()) == ["r1", "r2"]


def test_text_reports(spark, tmp_path):
    report = spark.createDataFrame([(0.5, 0.4, 0.1)], "share_picked double, cut_off double, cut_off2 double")
    path = W.write_lines(W.quick_report_line(report), str(tmp_path), dt.date(2020, 1, 2))
    assert spark.read.text(path).first()[0] == (
        "Percent of Mass Features that picked a BMIS: 0.5 | RSD improvement cutoff 0.4 | RSD minimum cutoff 0.1"
    )


def test_staged_tables_live_in_the_configured_folder(spark):
    df = spark.range(10).withColumn("x", F.col("id") * 2)
    staged = stage(df, "numbers")
    assert staged.dtypes == df.dtypes and staged.count() == 10
    assert all(staging_dir(spark).rstrip("/") in f for f in staged.inputFiles())
    assert "ReadSchema: struct<x:bigint>" in staged.select("x")._jdf.queryExecution().toString()


def test_dataset_names():
    assert schema.PEAKS.names[0] == "replicate_name"


def test_headers_are_worked_out_once_per_file(spark, tmp_path):
    """Not once per row: the rows take places that their file's header gave."""
    (tmp_path / "a.csv").write_text("Replicate Name,Area\nr1,1\n")
    (tmp_path / "b.csv").write_text("AREA,x,replicate_name\n2,9,r2\n")
    rows = R._scan_csv(spark, str(tmp_path), schema._strings("replicate_name", "area"), None, keep_all=True)
    assert {tuple(r) for r in rows.collect()} == {("r1", "1", None), ("r2", "2", "9")}
    last = rows._jdf.queryExecution().optimizedPlan().expressions().toString()
    assert "regexp_replace" not in last and "array_position" not in last


def _shuffle_files(spark):
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {files.apply(i).getName() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle_")}


def test_a_staged_table_keeps_no_shuffle_files(spark):
    """They stood beside the table until the driver collected its garbage."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    setting, cached = spark.conf.get(key, None), spark.range(100).groupBy((F.col("id") % 7).alias("k")).count().persist()
    cached.count()
    before = _shuffle_files(spark)
    staged = stage(spark.range(1000).groupBy((F.col("id") % 10).alias("k")).count().join(cached.drop("count"), "k"), "counts")
    assert not _shuffle_files(spark) - before
    assert staged.count() == 7 == cached.count() and spark.conf.get(key, None) == setting
