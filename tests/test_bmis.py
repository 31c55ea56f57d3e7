import statistics
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from peakflow.operators import bmis as B
from peakflow.params import CORRECTED, REFERENCE, BmisParams
from tests.helpers import QC_ROWS, STANDARDS, by, forbidden_in, standard

IS = ("S1", "S2")


@pytest.fixture()
def standards(spark):
    return spark.createDataFrame(
        [standard(f" {n} ", "Internal Standard") for n in IS] + [standard("A"), standard("B", column="RP")], STANDARDS
    )


@pytest.fixture()
def internal(standards):
    return B.internal_standards(standards)


ROWS = [
    # a pooled sample whose volume effect S1 follows exactly and S2 does not
    *[(f"1_Poo_P_{i}", c, v) for i, f in enumerate((1.0, 1.5, 2.2, 0.7), 1)
      for c, v in (("A", 1000 * f + 7 * i), ("S1", 2000 * f), ("S2", 3000.0 + 100 * i), ("B", 500.0 + i))],
    # another with two replicates, one of them half the volume and without S2
    ("1_Poo_HalfQ_1", "A", 400.0), ("1_Poo_HalfQ_1", "S1", 900.0),
    ("1_Poo_HalfQ_2", "A", 450.0), ("1_Poo_HalfQ_2", "S1", 950.0), ("1_Poo_HalfQ_2", "S2", None),
    # a single replicate
    ("1_Poo_R_1", "A", 700.0), ("1_Poo_R_1", "S1", 800.0), ("1_Poo_R_1", "S2", 900.0),
    ("1_Smp_X_1", "A", 800.0), ("1_Smp_X_1", "S1", 1600.0), ("1_Smp_X_1", "S2", 10.0), ("1_Smp_X_1", "B", None),
    ("1_Smp_X_2", "A", 900.0), ("1_Smp_X_2", "S1", 1700.0), ("1_Smp_X_2", "S2", 20.0),
    # an only-missing feature, and a standard measured twice
    ("1_Poo_P_1", "Z", None), ("1_Poo_P_2", "S1", 4100.0),
]


@pytest.fixture()
def data(spark):
    return spark.createDataFrame(ROWS, QC_ROWS)


def literal(rows, mode):
    """The calculation as published, on plain lists: repeat, divide, spread, average over rows."""
    volumes = [(r, "Inj_vol", 0.5 if "Half" in r else 1.0) for r, _, _ in rows]
    if mode == CORRECTED:
        volumes = sorted(set(volumes))
    int_std = [t for t in rows if t[1] in IS] + volumes
    mean = {}
    for m in {t[1] for t in int_std}:
        known = [a for _, n, a in int_std if n == m and a is not None]
        mean[m] = statistics.fmean(known)
    candidates = []
    for r, f, a in int_std + [t for t in rows if t[1] not in IS]:
        for m in mean:
            areas = [x for rr, n, x in int_std if rr == r and n == m] or [None]
            for x in areas:
                adjusted = a / x * mean[m] if a is not None and x else None
                candidates.append((r, f, m, adjusted))
    groups = defaultdict(list)
    for r, f, m, x in candidates:
        if r.split("_")[1] == "Poo":
            groups[r.split("_")[2], f, m].append(x)
    weighted = defaultdict(list)
    for (_, f, m), xs in groups.items():
        known = [x for x in xs if x is not None]
        if len(known) > 1:
            weighted[f, m].append((len(xs), statistics.stdev(known) / statistics.mean(known)))
    pairs = {(f, m) for _, f, m in groups}
    return {
        k: sum(n * r for n, r in weighted[k]) / sum(n for n, _ in weighted[k]) if weighted[k] else None for k in pairs
    }, mean, candidates


@pytest.mark.parametrize("mode", [REFERENCE, CORRECTED])
def test_pooled_spread_equals_the_literal_repetition(data, internal, mode):
    want, mean, _ = literal(ROWS, mode)
    rsd = B.pooled_rsd(B.candidate_moments(data, internal, mode, runs=B.is_pool()))
    rows = by(B.with_missing_pairs(rsd, B.is_means(data, internal, mode)), "mass_feature", "mis")
    assert set(rows) == set(want)
    for key, value in want.items():
        got = rows[key]["rsd_of_poo"]
        assert (got is None) if value is None else got == pytest.approx(value, rel=1e-9, abs=1e-12), key
    means = {r["mass_feature"]: r["average_area"] for r in B.is_means(data, internal, mode).collect()}
    assert means == pytest.approx(mean)


def test_candidates_are_the_dense_literal_table(data, internal):
    _, _, literal_rows = literal(ROWS, REFERENCE)
    got = [r.asDict() for r in B.bmis_candidates(data, internal).collect()]
    assert sum(r["weight"] for r in got) == len(literal_rows)
    total = sum(r["adjusted_area"] * r["weight"] for r in got if r["adjusted_area"] is not None)
    assert total == pytest.approx(sum(x for *_, x in literal_rows if x is not None))


@pytest.mark.parametrize("factor", [1e-3, 7.0])
def test_scaling_all_areas_changes_no_spread(spark, data, internal, factor):
    scaled = spark.createDataFrame([(r, c, a * factor if a is not None else None) for r, c, a in ROWS], QC_ROWS)
    a, b = (
        {k: v["rsd_of_poo"] for k, v in by(
            B.pooled_rsd(B.candidate_moments(d, internal)), "mass_feature", "mis").items()}
        for d in (data, scaled)
    )
    assert a.keys() == b.keys()
    for k in a:
        assert b[k] == (pytest.approx(a[k], abs=1e-12) if a[k] is not None else None)


def test_internal_standards_by_mode(spark):
    table = spark.createDataFrame([
        standard(" S1\t", "Internal Standard"), standard("S3", "Internal Standard", column="RP"),
        standard("S4", "Internal Standard", column=None), standard("A"),
    ], STANDARDS)
    names = lambda df: sorted(r["compound_name"] for r in df.collect())
    assert names(B.internal_standards(table, "HILIC")) == ["S1", "S3"]
    assert names(B.internal_standards(table, "HILIC", CORRECTED)) == ["S1"]


def test_input_rows(spark):
    df = spark.createDataFrame(
        [("1-2_Smp_a-b_1", "A", 1.0), ("1_Blk_a_1", "A", 1.0), ("1_Std_a_1", "A", 1.0), (None, "A", 1.0)], QC_ROWS
    )
    assert [r["replicate_name"] for r in B.bmis_input(df).collect()] == ["1.2_Smp_a-b_1"]


def test_injection_volume(data):
    rows = by(B.injection_volume(data), "replicate_name")
    assert rows["1_Poo_HalfQ_1"]["area_with_qc"] == 0.5 and rows["1_Poo_HalfQ_1"]["weight"] == 2
    assert rows["1_Poo_P_1"]["weight"] == 5
    assert {r["weight"] for r in B.injection_volume(data, CORRECTED).collect()} == {1}


def test_issues_and_raw_areas(data, internal):
    issues = B.is_issues(data, internal).collect()
    assert [(r["replicate_name"], r["mass_feature"], r["samp_id"]) for r in issues] == [("1_Poo_HalfQ_2", "S2", "HalfQ")]
    assert B.is_raw_areas(data, internal).filter("mass_feature = 'Inj_vol'").count() == 9


def test_replicates_of_both_sides(spark, data, internal):
    left, right = B.semi_internal_standards(data, internal), B.anti_internal_standards(data, internal)
    assert B.assert_same_replicates(left, right, strict=True).count() == 0
    fewer = right.filter("replicate_name <> '1_Smp_X_2'")
    assert [tuple(r) for r in B.assert_same_replicates(left, fewer).collect()] == [("1_Smp_X_2", "left")]
    with pytest.raises(ValueError):
        B.assert_same_replicates(left, fewer, strict=True)


def _rsd(spark, *rows):
    return spark.createDataFrame(rows, "mass_feature string, mis string, rsd_of_poo double")


@pytest.fixture()
def spreads(spark):
    return _rsd(
        spark,
        ("better", "Inj_vol", 0.5), ("better", "S1", 0.2), ("better", "S2", 0.3),
        ("slightly", "Inj_vol", 0.5), ("slightly", "S1", 0.4),
        ("steady", "Inj_vol", 0.05), ("steady", "S1", 0.01),
        ("tie", "Inj_vol", 0.5), ("tie", "S1", 0.2), ("tie", "S2", 0.2 + 1e-15),
        ("open", "Inj_vol", None), ("open", "S1", 0.2),
        ("nothing", "Inj_vol", None), ("nothing", "S1", None),
        ("perfect", "Inj_vol", 0.0), ("perfect", "S1", 0.0),
    )


def test_pick(spreads):
    rows = by(B.bmis_pick(spreads, BmisParams()), "mass_feature", "mis")
    best = rows["better", "S1"]
    assert best["poo_picked_is"] == "S1" and best["accept_mis"] is True
    assert best["del_rsd"] == pytest.approx(0.3) and best["percent_change"] == pytest.approx(0.6)
    assert rows["tie", "S2"]["poo_picked_is"] == "S1"
    assert rows["open", "S1"]["accept_mis"] is None
    assert rows["nothing", "S1"]["poo_picked_is"] is None
    # nothing over nothing is undecided, but a small original spread decides alone
    assert rows["perfect", "S1"]["percent_change"] is None and rows["perfect", "S1"]["accept_mis"] is False


def test_final_choice_in_both_modes(spreads):
    pick = B.bmis_pick(spreads, BmisParams())
    final = {k: (r["final_bmis"], r["final_rsd"]) for k, r in by(B.bmis_final(pick), "mass_feature").items()}
    assert final == {
        "better": ("S1", 0.2), "slightly": ("Inj_vol", 0.5), "steady": ("Inj_vol", 0.05), "tie": ("S1", 0.2),
        "perfect": ("Inj_vol", 0.0),
    }
    corrected = {k: r["final_bmis"] for k, r in by(B.bmis_final(pick, CORRECTED), "mass_feature").items()}
    assert corrected["open"] == corrected["nothing"] == "Inj_vol" and corrected["better"] == "S1"
    report = B.bmis_quick_report(B.bmis_final(pick)).first()
    assert report["share_picked"] == pytest.approx(2 / 5) and report["cut_off"] == 0.4


def test_normalised_rows(data, internal):
    p = BmisParams(cut_off=0.1, cut_off2=0.01)
    final = by(B.bmis_choice(data, internal, p), "mass_feature")
    assert final["A"]["final_bmis"] == "S1" and final["B"]["final_bmis"] == "Inj_vol" and "Z" not in final
    assert final["Inj_vol"]["final_bmis"] == "Inj_vol"
    _, mean, _ = literal(ROWS, REFERENCE)
    out = [r.asDict() for r in B.bmis_normalize(data, internal, p).collect()]
    a = [r for r in out if r["mass_feature"] == "A" and r["samp_id"] == "X"]
    assert sorted(r["adjusted_area"] for r in a) == pytest.approx(
        sorted([800 / 1600 * mean["S1"], 900 / 1700 * mean["S1"]])
    )
    assert {r["run_cmpd"] for r in a} == {"1_Smp_X_1 A", "1_Smp_X_2 A"}
    # a standard measured twice gives its replicate's rows twice, and no feature disappears
    assert len([r for r in out if r["mass_feature"] == "A"]) == 10
    assert len([r for r in out if r["mass_feature"] == "Inj_vol"]) == 9


def test_normalising_by_a_full_injection_changes_nothing(spark, internal):
    df = spark.createDataFrame([(f"1_Poo_P_{i}", "B", 100.0 + i) for i in range(4)], QC_ROWS)
    rows = B.bmis_normalize(df, internal).filter("mass_feature = 'B'").collect()
    assert len(rows) == 4 and all(r["adjusted_area"] == r["area_with_qc"] for r in rows)


def test_standard_to_standard_spread(data, internal):
    pick = B.bmis_pick(B.pooled_rsd(B.candidate_moments(data, internal, runs=B.is_pool())))
    rows = by(B.is_to_is_rsd(data, internal, pick), "mass_feature", "mis")
    assert {k[0] for k in rows} == {"S1", "S2", "Inj_vol"}
    assert rows["S1", "S1"]["rsd_of_smp"] == pytest.approx(0, abs=1e-12)
    ratios = [1600 / 10, 1700 / 20]
    assert rows["S1", "S2"]["rsd_of_smp"] == pytest.approx(statistics.stdev(ratios) / statistics.mean(ratios))


def test_repeated_rows_of_a_hot_replicate_never_multiply(spark, internal):
    """A replicate with thousands of repeated rows costs as many entries as it has compounds."""
    per_compound = 4000
    rows = spark.range(3 * per_compound).selectExpr(
        "'1_Poo_H_1' AS replicate_name", "element_at(array('A', 'S1', 'S2'), cast(id % 3 as int) + 1) AS metabolite_name",
        "1000.0 + (id * 7919) % 500 AS area_with_qc",
    ).withColumn("area_with_qc", F.col("area_with_qc").cast("double"))
    moments = B.candidate_moments(rows, internal)
    found = by(moments, "mass_feature", "mis")
    # features A, S1, S2 and the volume against S1, S2, the volume and the entry of base counts
    assert moments.count() == len(found) == 16
    assert found["A", "S1"]["frequency"] == per_compound**2
    areas = {n: [r["area_with_qc"] for r in rows.filter(F.col("metabolite_name") == n).collect()] for n in ("A", "S1")}
    mean_a, mean_s = statistics.fmean(areas["A"]), statistics.fmean(1 / x for x in areas["S1"])
    square = statistics.fmean(x * x for x in areas["A"]) * statistics.fmean(1 / x**2 for x in areas["S1"])
    assert found["A", "S1"]["mean"] == pytest.approx(mean_a * mean_s)
    assert found["A", "S1"]["variance"] == pytest.approx(square - (mean_a * mean_s) ** 2, rel=1e-6)


def test_a_replicate_of_very_many_compounds_is_not_gathered(spark, internal):
    """One pooled replicate with 100,000 compounds, two of them internal standards."""
    n = 100_000
    rows = spark.range(n).selectExpr(
        "'1_Poo_H_1' AS replicate_name", "CASE id WHEN 0 THEN 'S1' WHEN 1 THEN 'S2' ELSE concat('C', id) END AS metabolite_name",
        "cast(100 + id % 977 as double) AS area_with_qc",
    )
    moments = B.candidate_moments(rows, internal)
    plan = moments._jdf.queryExecution().toString()
    assert "collect_list" not in plan and "collect_set" not in plan and "CartesianProduct" not in plan
    # every compound and the volume against S1, S2, the volume and the row of base counts
    assert moments.count() == 4 * (n + 1)
    mean = moments.filter("mass_feature = 'C500' AND mis = 'S2'").first()["mean"]
    assert mean == pytest.approx(600 / 101)


def test_plans_have_no_python_and_no_cross_joins(data, internal):
    for df in (B.bmis_candidates(data, internal), B.bmis_normalize(data, internal)):
        assert forbidden_in(df) == []
