import pytest
from pyspark.sql import functions as F

from peakflow.operators import duplicates as D
from peakflow.operators import tidy as T
from tests.helpers import STANDARDS, by, plan_of, standard


def test_null_markers_hit_any_text_cell(spark):
    df = spark.createDataFrame([("a#N/A", "x", 1.0)], "a string, b string, c double")
    assert tuple(T.null_markers(df).first()) == (None, "x", 1.0)


def test_cast_numeric_columns(spark):
    df = spark.createDataFrame([("1.5", "n"), ("bad", "n")], "a string, b string")
    assert [tuple(r) for r in T.cast_numeric_columns(df, ["a"]).collect()] == [(1.5, "n"), (None, "n")]


@pytest.fixture()
def wide(spark):
    return spark.createDataFrame(
        [(1, "Lab_Abc_x", "1", "2"), (2, "Unknown", "3", None)],
        "alignment_id int, metabolite_name string, X1_Smp_a_1 string, x1_Smp_a_2 string",
    )


def test_melt_is_case_insensitive_and_keeps_ids(wide):
    long = T.melt_samples(T.cast_sample_columns(wide), "area_value")
    assert long.columns == ["replicate_name", "area_value", "alignment_id", "metabolite_name"]
    assert sorted(r["area_value"] or -1 for r in long.collect()) == [-1, 1.0, 2.0, 3.0]


def test_names_are_standardised(wide):
    long = T.melt_samples(T.drop_unknown(wide), "area_value")
    row = T.standardize_names(long, "Lab_", has_prefix=True).orderBy("replicate_name").first()
    assert (row["metabolite_name"], row["replicate_name"]) == ("Abc", "1_Smp_a_1")
    assert T.standardize_names(long, "Lab_").first()["replicate_name"].lower().startswith("x")


def test_drop_descriptors_ignores_absent_ones(spark):
    df = spark.createDataFrame([(1, 2, 3)], ["SMILES", "kept", "RT.matched"])
    assert T.drop_descriptors(df).columns == ["kept"]


def _measure(spark, name, value, id_=1, compound="A"):
    return spark.createDataFrame(
        [("r1", value, id_, compound)], f"replicate_name string, {name} double, alignment_id int, metabolite_name string"
    )


def test_assemble_matches_missing_keys_and_keeps_unmatched_areas(spark):
    parts = [_measure(spark, f"{m}_value", v, compound=None) for m, v in (("area", 1.0), ("mz", 2.0), ("sn", 3.0))]
    row = T.assemble_measures(*parts, _measure(spark, "rt_value", 4.0, id_=9)).first()
    assert (row["area_value"], row["mz_value"], row["sn_value"], row["rt_value"]) == (1.0, 2.0, 3.0, None)


def test_assemble_shuffles_each_table_once(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        tables = [
            spark.range(50).select(
                F.col("id").cast("string").alias("replicate_name"), F.col("id").cast("double").alias(f"{m}_value"),
                F.col("id").cast("int").alias("alignment_id"), F.lit("A").alias("metabolite_name"),
            ) for m in ("area", "mz", "sn", "rt")
        ]
        tree = plan_of(T.assemble_measures(*tables)).split("\n\n")[0]
        assert tree.count("Exchange") == 4
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_update_compound_names(spark):
    df = spark.createDataFrame([("Old_A", 1), ("Old_A", 1), ("X", 2), (None, 3)], "metabolite_name string, v int")
    standards = spark.createDataFrame([standard("A", original="Old_A")], STANDARDS)
    kept = T.update_compound_names(df, standards)
    assert sorted((r["metabolite_name"] or "", r["v"]) for r in kept.collect()) == [("", 3), ("A", 1), ("X", 2)]
    lost = T.update_compound_names(df, standards, keep_unmatched=False, dedupe=False)
    assert sorted((r["metabolite_name"] or "", r["v"]) for r in lost.collect()) == [("", 2), ("", 3), ("A", 1), ("A", 1)]
    assert T.keeps_unmatched_names("corrected") and not T.keeps_unmatched_names()


def test_run_types_present(spark):
    df = spark.createDataFrame([("1_Smp_a_1",), ("1_Std_a_1",)], "replicate_name string")
    assert {r[0] for r in T.run_types_present(df).collect()} == {"smp", "std"}
    assert T.run_types_present(df, ("smp", "std")).count() == 2
    with pytest.raises(ValueError):
        T.run_types_present(df, ("smp", "std", "poo", "blk"))


def test_run_type_filter(spark):
    df = spark.createDataFrame([("1_smp_a",), ("1_Smp_a",), ("1_Blk_a",), (None,)], "replicate_name string")
    assert T.run_type_filter(df, "Smp").count() == 1
    assert T.run_type_filter(df, "Smp", ignore_case=True).count() == 2
    assert T.run_type_filter(df, "Smp", include=False).count() == 2


def test_union_modes_fills_missing_columns(spark):
    pos = spark.createDataFrame([("r", 1.0)], "replicate_name string, area_value double")
    neg = spark.createDataFrame([("r",)], "replicate_name string")
    rows = by(T.union_modes(pos, neg), "ion_column")
    assert rows["HILICNeg"]["area_value"] is None and rows["HILICPos"]["area_value"] == 1.0


# --- duplicates between ion modes ---


@pytest.fixture()
def modes(spark):
    return spark.createDataFrame([
        ("r1", "A", "HILICPos", 1.0), ("r1", "A", "HILICNeg", 3.0), ("r2", "A", "HILICNeg", 5.0),
        ("r1", "B", "HILICNeg", 2.0), ("r1", "C", "HILICPos", 2.0), ("r3", "A", None, 2.0),
    ], "replicate_name string, metabolite_name string, ion_column string, area_with_qc double")


def test_duplicates(modes):
    assert [r[0] for r in D.mode_duplicates(modes).collect()] == ["A"]
    stats = by(D.mode_duplicate_stats(modes), "ion_column")
    assert stats["HILICNeg"]["means"] == 4.0 and stats["HILICNeg"]["std_devs"] == pytest.approx(2**0.5)
    assert stats["HILICPos"]["std_devs"] is None
    assert [r[0] for r in D.duplicate_report(modes).collect()] == ["A HILICNeg"]


def test_removal_keeps_single_compounds_and_is_idempotent(modes):
    once = D.drop_mode_duplicates(modes)
    left = sorted((r["replicate_name"], r["metabolite_name"]) for r in once.collect())
    # a duplicate without a mode label cannot be judged and goes as well
    assert left == [("r1", "A"), ("r1", "B"), ("r1", "C")]
    assert sorted(map(str, D.drop_mode_duplicates(once).collect())) == sorted(map(str, once.collect()))


def test_duplicates_need_ion_modes(spark, modes):
    with pytest.raises(ValueError):
        D.mode_duplicates(modes.drop("ion_column"))
