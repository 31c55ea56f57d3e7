import pytest
from pyspark.sql import functions as F

from peakflow.functions import columns as C
from peakflow.params import CORRECTED, REFERENCE, is_corrected


def one(spark, value, expression, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(expression.alias("y")).first()["y"]


@pytest.mark.parametrize("name, want", [
    ("170410_Smp_A_1", "smp"), ("170410_Std_StdsMix1InH2O_1", "std"), ("noparts", None), ("a_b", None), (None, None),
])
def test_run_type_is_null_without_an_enclosed_token(spark, name, want):
    assert one(spark, name, C.run_type("x")) == want


@pytest.mark.parametrize("name, want", [
    ("170410_Smp_A_1_extra", ("170410", "Smp", "A", "1")), ("170410_Smp", ("170410", "Smp", None, None)),
])
def test_parse_replicate_drops_surplus_and_fills_missing(spark, name, want):
    row = spark.createDataFrame([(name,)], "x string").select(
        *[c.alias(n) for n, c in C.parse_replicate("x").items()]
    ).first()
    assert tuple(row) == want


def test_first_dash_only(spark):
    assert one(spark, "a-b-c", C.fix_replicate_dash("x")) == "a.b-c"
    assert one(spark, "abc", C.fix_replicate_dash("x")) == "abc"


def test_safe_div_gives_null_on_zero(spark):
    assert one(spark, 0.0, C.safe_div(F.lit(1.0), "x"), "double") is None


@pytest.mark.parametrize("text, want", [
    (" 1.5 ", 1.5), ("1e5", 1e5), ("-.5", -0.5), ("3.", 3.0), ("1d", None), ("Inf", None), ("NaN", None), ("", None),
    ("x", None), (None, None), ("1e999", None),
])
def test_to_number(spark, text, want):
    assert one(spark, text, C.to_number("x")) == want


def test_finite(spark):
    for value in (float("nan"), float("inf"), float("-inf")):
        assert one(spark, value, C.finite("x"), "double") is None
    assert one(spark, 2.0, C.finite("x"), "double") == 2.0


def test_trim_whitespace_cuts_tabs_and_line_ends(spark):
    assert one(spark, "\t a b \n", C.trim_whitespace("x")) == "a b"


# Carbon and nitrogen under the published rule and under the plain one.
FORMULAS = {
    "C12H22O11": ((12.0, None), (12.0, 0.0)),
    "CH4": ((None, None), (1.0, 0.0)),
    "C5H5N": ((5.0, None), (5.0, 1.0)),
    "C10H15N10O": ((10.0, 1.0), (10.0, 10.0)),
    "NaCl": ((None, 1.0), (0.0, 0.0)),
    "C6H13NO2": ((6.0, 1.0), (6.0, 1.0)),
    "C123H4N2": ((12.0, 2.0), (123.0, 2.0)),
    None: ((None, None), (None, None)),
}


@pytest.mark.parametrize("formula", FORMULAS)
def test_formula_atoms_in_both_modes(spark, formula):
    for mode, want in zip((REFERENCE, CORRECTED), FORMULAS[formula]):
        carbon, nitrogen = C.formula_atoms("x", mode)
        row = spark.createDataFrame([(formula,)], "x string").select(carbon.alias("c"), nitrogen.alias("n")).first()
        assert tuple(row) == want


@pytest.mark.parametrize("flags, reference, corrected", [
    (("SN.Flag", None, None, None), "SN.Flag, ", "SN.Flag"),
    (("SN.Flag", None, "RT.Flag", None), "SN.Flag, RT.Flag, ", "SN.Flag, RT.Flag"),
    ((None, None, None, "Blank.Flag"), "Blank.Flag", "Blank.Flag"),
    ((None, None, None, None), None, None),
])
def test_wide_export_flag_text(spark, flags, reference, corrected):
    df = spark.createDataFrame([flags], "a string, b string, c string, d string")
    assert df.select(C.msdial_flag_text(list("abcd"))).first()[0] == reference
    assert df.select(C.msdial_flag_text(list("abcd"), CORRECTED)).first()[0] == corrected


@pytest.mark.parametrize("flags, reference, corrected", [
    (("RT.Flag", None, None, "area.min.Flag", None), "RT.Flag,   area.min.Flag", "RT.Flag, area.min.Flag"),
    ((None, None, "overloaded.Flag", None, None), "overloaded.Flag", "overloaded.Flag"),
    ((None, None, None, None, "SN.Flag"), "SN.Flag", "SN.Flag"),
    ((None,) * 5, None, None),
])
def test_long_export_flag_text(spark, flags, reference, corrected):
    df = spark.createDataFrame([flags], "a string, b string, c string, d string, e string")
    assert df.select(C.skyline_flag_text(list("abcde"))).first()[0] == reference
    assert df.select(C.skyline_flag_text(list("abcde"), CORRECTED)).first()[0] == corrected


@pytest.mark.parametrize("name, want", [
    ("Cmpd_8, 15N", "Cmpd_8"), ("L-Alanine, 13C", "Alanine"), ("Alanine", "Alanine"), ("D-Ala-x", "Ala"),
])
def test_core_name(spark, name, want):
    assert one(spark, name, C.core_name("x")) == want


def test_strict_and_open_extremes(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", None), ("b", None)], "k string, x double")
    rows = {r["k"]: r for r in df.groupBy("k").agg(
        C.strict_max("x").alias("strict"), C.open_min("x").alias("open"), C.open_min("x", CORRECTED).alias("plain")
    ).collect()}
    assert rows["a"]["strict"] is None and rows["a"]["open"] == 1.0
    assert rows["b"]["open"] == float("inf") and rows["b"]["plain"] is None


def test_unknown_mode_is_an_error():
    with pytest.raises(ValueError):
        is_corrected("other")


def test_names_read_without_patterns_equal_the_patterns(spark):
    names = ["a_Smp_b", "a__Poo_b", "a_b", "_x_", "__", "a_B_", "x", "", None, "a_Std-1_b", "a-b_Blk_-c", "_-_", "é_Ü_x", "blk_StdBlk"]
    rows = spark.createDataFrame([(n,) for n in names], "n string")
    got = rows.select(
        C.run_type("n").alias("a"), F.lower(F.regexp_substr("n", F.lit(C.RUN_TYPE))).alias("b"),
        C.fix_replicate_dash("n").alias("c"), F.regexp_replace("n", "^([^-]*)-", "$1.").alias("d"),
        C.is_blank_or_standard("n").alias("e"), F.col("n").rlike(C.BLANK_OR_STANDARD).alias("f"),
    ).collect()
    assert all(r.a == r.b and r.c == r.d and r.e == r.f for r in got)
