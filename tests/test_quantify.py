import pytest
from pyspark.sql import functions as F

from peakflow.operators import quantify as Q
from peakflow.params import CORRECTED, QuantifyParams
from tests.helpers import STANDARDS, by, standard

QC = "replicate_name string, metabolite_name string, area_with_qc double, area_value double, run_type string"
BMIS = (
    "mass_feature string, final_bmis string, orig_rsd double, final_rsd double, run_date string, type string, "
    "samp_id string, replicate string, area_with_qc double, mis string, adjusted_area double, run_cmpd string"
)


@pytest.fixture()
def standards(spark):
    return spark.createDataFrame([
        standard(" A ", conc=2.0, formula="C2H4N2"), standard("B", conc=4.0, mix="Mix2", formula="C10H8NO"),
        standard("C", conc=None), standard("R", column="RP"), standard("Z", conc=0.0),
        standard("A, 15N", "Internal Standard", conc=3.0), standard("A, 13C", "Internal Standard", conc=5.0),
    ], STANDARDS)


@pytest.fixture()
def qc(spark):
    def row(replicate, compound, area):
        return (replicate, compound, area, area, "std")

    rows = [
        row("1_Std_StdsMix1InH2O_1", "A", 100.0), row("1_Std_StdsMix1InH2O_2", "A", 200.0),
        row("1_Std_StdsMix1InMatrix_1", "A", 300.0), row("1_Std_H2OInMatrix_1", "A", 100.0),
        row("1_Std_StdsMix1InH2O_1", "B", 400.0), row("1_Std_StdsMix2InH2O_1", "B", None),
        row("1_Std_StdsMix2InMatrix_1", "B", 800.0), row("1_Std_H2OInMatrix_1", "B", 80.0),
        row("1_Std_StdsMix1InH2O_1", "A, 15N", 50.0), row("1_Std_StdsMix1InH2O_1", "C", 50.0),
        row("1_Std_StdsMix1InH2O_1", "Z", 50.0),
        row("1_Smp_X_1", "A", 30.0), row("1_Smp_X_1", "A, 15N", 10.0), row("1_Smp_X_2", "A", 40.0),
        row("1_Blk_X_1", "A", 5.0), row("1_Blk_X_1", "A, 15N", 0.0), row("1_Smp_X_1", "B", 70.0),
    ]
    return spark.createDataFrame(rows + [rows[0]], QC)


@pytest.fixture()
def rows(qc, standards):
    return Q.standard_run_types(Q.standard_rows(qc, standards, "HILIC"))


def test_standard_rows(rows):
    got = rows.collect()
    assert {r["metabolite_name"] for r in got} == {"A", "B", "A, 15N", "Z"}
    assert len([r for r in got if r["metabolite_name"] == "A"]) == 4


@pytest.mark.parametrize("name, stds, mix", [
    ("1_Std_StdsMix1InH2O_1", "Standards_Water", "Standards_Water"),
    ("1_Std_StdsMix1InMatrix_1", "Standards_Matrix", "Standards_Matrix"),
    ("1_Std_H2OInMatrix_1", "Water_Matrix", "Water_Matrix"),
    ("1_Std_OtherMatrix_1", "Water_Matrix", "Water_Water"),
    ("1_Std_WaterInH2O_1", "Water_Water", "Standards_Water"),
])
def test_run_classes(spark, name, stds, mix):
    df = spark.createDataFrame([(name,)], "replicate_name string")
    assert Q.standard_run_types(df).first()["standard_type"] == stds
    assert Q.standard_run_types(df, "mix").first()["standard_type"] == mix


def test_response_factors(rows):
    rf = by(Q.response_factors(rows), "metabolite_name", "replicate_name", "area_value")
    assert rf["A", "1_Std_StdsMix1InH2O", 100.0]["rf"] == 50.0
    assert rf["Z", "1_Std_StdsMix1InH2O", 50.0]["rf"] is None
    assert not any(k[0] == "A, 15N" for k in rf)


def test_own_mix_only_with_ion_modes(rows):
    rf = Q.response_factors(rows.withColumn("ion_column", F.lit("HILICPos")))
    names = {(r["metabolite_name"], r["replicate_name"]) for r in rf.collect()}
    assert ("B", "1_Std_StdsMix1InH2O") not in names and ("B", "1_Std_StdsMix2InH2O") in names
    assert ("B", "1_Std_H2OInMatrix") in names


def test_ranges_and_missing_factors(rows):
    rf = Q.response_factors(rows)
    ranges = by(Q.rf_range(rf), "metabolite_name")
    assert (ranges["A"]["rf_max"], ranges["A"]["rf_min"]) == (100.0, 50.0)
    assert ranges["Z"]["rf_max"] is None
    a = Q.rf_dimensions(rf).filter("metabolite_name = 'A'").collect()
    assert len(a) == 2 and {r["rf_diff"] for r in a} == {2.0}
    assert {r[0] for r in Q.missing_rf(rf).collect()} == {"B", "Z"}


def test_ratios(spark, rows):
    rf = Q.response_factors(rows)
    ratios = {r["metabolite_name"]: r["rf_ratio"] for r in Q.rf_ratios(rf).collect()}
    assert ratios["A"] == pytest.approx((150 - 50) / 75)
    assert ratios["B"] == pytest.approx((200 - 20) / 100) and "Z" not in ratios
    # three rows of two classes pass the published count, not the corrected one
    two = rf.filter("metabolite_name = 'A' and standard_type <> 'Water_Matrix'").unionByName(
        rf.filter("metabolite_name = 'A' and standard_type = 'Standards_Water'")
        .withColumn("replicate_name", F.lit("other"))
    )
    assert [tuple(r) for r in Q.rf_ratios(two).collect()] == [("A", None)]
    assert Q.rf_ratios(two, CORRECTED).count() == 0


def _bmis(spark, *rows):
    return spark.createDataFrame([
        (f, m, 0.5, 0.1, "1", "Smp", s, r, 30.0, m, a, f"1_Smp_{s}_{r} {f}") for f, m, s, r, a in rows
    ], BMIS)


@pytest.fixture()
def bmis(spark):
    return _bmis(
        spark, ("A", "A, 15N", "X", "1", 600.0), ("A", "A, 15N", "X", "2", 900.0),
        ("B", "Inj_vol", "X", "1", 180.0), ("B", "Inj_vol", "X", "1", 180.0), ("B", "Inj_vol", "Y", "1", 0.0),
        ("U", "Inj_vol", "X", "1", 1.0),
    )


@pytest.fixture()
def factors(rows):
    rf = Q.response_factors(rows)
    return Q.rf_ratios(rf), Q.rf_range(rf)


def test_amount_by_response_factor(bmis, factors):
    got = Q.quantify_response_factor(bmis, *factors)
    # repeated rows once, compounds without a ratio not at all
    assert got.count() == 4
    a = by(got, "metabolite_name", "replicate_name")["A", "1_Smp_X_1"]
    ratio = (150 - 50) / 75
    assert a["rf_ave"] == 75.0
    assert a["umol_in_vial_ave"] == pytest.approx(600 / 75 / ratio)
    assert a["umol_in_vial_max"] == pytest.approx(600 / 50 / ratio)
    assert a["umol_in_vial_min"] == pytest.approx(600 / 100 / ratio)


def test_pairs_are_literal_unless_asked(spark, factors, standards):
    known = Q.known_standards(standards, "HILIC")
    bmis = _bmis(spark, ("A", "A, 15N", "X", "1", 1.0), ("B", "A, 15N", "X", "1", 1.0))
    assert [tuple(r) for r in Q.is_name_pairs(bmis, factors[0], known).select("metabolite_name", "final_bmis", "concentration_um").collect()] == [("A", "A, 15N", 3.0)]
    dots = spark.createDataFrame([("A.", 1.0)], "metabolite_name string, rf_ratio double")
    other = _bmis(spark, ("A.", "A, 15N", "X", "1", 1.0))
    assert Q.is_name_pairs(other, dots, known).count() == 0
    assert Q.is_name_pairs(other, dots, known, literal=False).count() == 1


def test_amount_by_internal_standard(qc, bmis, factors, standards, rows):
    pairs = Q.is_name_pairs(bmis, factors[0], Q.known_standards(standards, "HILIC"))
    got = by(Q.quantify_internal_standard(qc, pairs, rows), "replicate_name")
    assert set(got) == {"1_Smp_X_1", "1_Smp_X_2", "1_Blk_X_1"}
    assert got["1_Smp_X_1"]["umol_in_vial_is"] == pytest.approx(30 / 10 * 3 / 1000)
    assert got["1_Smp_X_2"]["umol_in_vial_is"] is None and got["1_Blk_X_1"]["umol_in_vial_is"] is None
    nowhere = rows.filter("metabolite_name <> 'A, 15N'")
    assert {r["concentration_um"] for r in Q.quantify_internal_standard(qc, pairs, nowhere).collect()} == {None}


@pytest.fixture()
def merged(qc, bmis, factors, standards, rows):
    pairs = Q.is_name_pairs(bmis, factors[0], Q.known_standards(standards, "HILIC"))
    return Q.quantify_merge(
        Q.quantify_response_factor(bmis, *factors), Q.quantify_internal_standard(qc, pairs, rows)
    )


def test_merge_prefers_the_internal_standard(merged):
    rows = by(merged, "metabolite_name", "replicate_name")
    a = rows["A", "1_Smp_X_1"]
    assert a["umol_in_vial_ave"] == pytest.approx(0.009) and a["umol_in_vial_max"] is None
    assert rows["A", "1_Smp_X_2"]["umol_in_vial_max"] is not None
    assert rows["B", "1_Smp_X_1"]["umol_in_vial_is"] is None and len(rows) == 4


def test_environment_atoms_totals_and_fractions(merged, standards):
    known = Q.known_standards(standards, "HILIC")
    p = QuantifyParams(dilution_factor=2.0, reconstitution_volume=400.0, volume_filtered=5.0)
    molecules = Q.carbon_nitrogen(Q.environmental_nmol(merged, known, p))
    a = by(molecules, "metabolite_name", "replicate_name")["A", "1_Smp_X_1"]
    assert a["nmol_in_enviro_ave"] == pytest.approx(0.009 * 1e-6 * 400 / 5 * 1000 * 2)
    assert (a["c"], a["n"]) == (2.0, 2.0)
    totals = Q.totals_per_sample(molecules)
    fractions = Q.mole_fractions(molecules, totals)
    shares = fractions.withColumn("samp", F.split("replicate_name", "_")[2]).groupBy("samp").agg(
        F.sum("mol_fraction_c").alias("c"), F.sum("mol_fraction_n").alias("n")
    )
    rows = by(shares, "samp")
    assert rows["X"]["c"] == pytest.approx(1) and rows["X"]["n"] == pytest.approx(1)
    # a sample whose total is zero has no fractions
    assert rows["Y"]["c"] is None
    assert "samp_id" not in fractions.columns


def test_totals_of_nothing_are_zero(spark):
    df = spark.createDataFrame([("X", None, None)], "samp_id string, nmol_c_ave double, nmol_n_ave double")
    assert tuple(Q.totals_per_sample(df).first()) == ("X", 0.0, 0.0)


def test_summary(spark):
    df = spark.createDataFrame(
        [("A", 1.0, 2.0, 0.1), ("A", 3.0, 6.0, 0.3), ("A", None, None, None), ("B", 5.0, None, None)],
        "metabolite_name string, nmol_in_enviro_ave double, nmol_c_ave double, mol_fraction_c double",
    )
    rows = [r.asDict() for r in Q.compound_summary(df).collect()]
    assert [r["metabolite_name"] for r in rows] == ["B", "A"]
    assert (rows[1]["nmol_enviro_med"], rows[1]["nmol_enviro_min"], rows[1]["nmol_c_max"]) == (2.0, 1.0, 6.0)
    assert rows[0]["nmol_enviro_med"] == 5.0 and rows[0]["nmol_c_med"] is None
