import random
import statistics

import pytest
from pyspark.sql import functions as F

from peakflow.functions import joins as J
from peakflow.functions import stats as S
from tests.helpers import by, forbidden_in, plan_of


def _rows(values):
    return [(k, v, 2 * v if v is not None else None) for k, vs in values.items() for v in vs]


def test_median_min_max_is_exact(spark):
    rng = random.Random(7)
    values = {
        "odd": [rng.gauss(0, 1) for _ in range(3001)],
        "even": [rng.random() for _ in range(2000)],
        "tied": [1.0] * 900 + [2.0] * 900 + [3.0],
        "single": [4.0],
        "pair": [1.0, 2.0, None],
        "none": [None],
    }
    df = spark.createDataFrame(_rows(values), "k string, a double, b double").repartition(5)
    # a coarse sketch makes the brackets wide or wrong; the result stays exact
    for accuracy in (10, 100, 10_000):
        rows = by(S.median_min_max(df, ["k"], ["a", "b"], accuracy), "k")
        assert set(rows) == set(values)
        for k, vs in values.items():
            known = [v for v in vs if v is not None]
            if not known:
                assert rows[k]["a_med"] is None and rows[k]["a_min"] is None
                continue
            assert rows[k]["a_med"] == pytest.approx(statistics.median(known), abs=1e-15)
            assert rows[k]["b_max"] == 2 * max(known) and rows[k]["a_min"] == min(known)


def test_a_missed_bracket_is_redone_over_the_full_range(spark):
    df = spark.createDataFrame([("k", float(i)) for i in range(9)], "k string, a double")
    long = df.select("k", F.lit("a").alias("_metric"), F.col("a").alias("_value"))
    wrong = spark.createDataFrame([("k", "a", 9, 6.0, 7.0)], "k string, _metric string, _n long, _low double, _high double")
    assert S._middle_values(long, ["k", "_metric"], wrong).first()["_median"] is None
    right = wrong.withColumns({"_low": F.lit(float("-inf")), "_high": F.lit(float("inf"))})
    assert S._middle_values(long, ["k", "_metric"], right).first()["_median"] == 4.0


def _weighted(values):
    """(value, weight) pairs written out."""
    return [v for v, w in values for _ in range(w)]


def test_weighted_rsd_equals_repeated_values(spark):
    groups = {"a": [(1.0, 3), (2.0, 1), (4.0, 2)], "b": [(5.0, 4)], "c": [(1.0, 1)], "d": [(1e8, 2), (1e8 + 1, 3)]}
    df = spark.createDataFrame(
        [(k, v, 0.0, w, w) for k, vs in groups.items() for v, w in vs],
        "k string, mean double, variance double, frequency long, rows long",
    )
    rows = by(S.weighted_rsd(df, ["k"]), "k")
    for k, vs in groups.items():
        plain = _weighted(vs)
        want = statistics.stdev(plain) / statistics.mean(plain) if len(plain) > 1 else None
        assert rows[k]["rsd"] == (pytest.approx(want, rel=1e-9, abs=1e-15) if want is not None else None)
        assert rows[k]["row_weight"] == len(plain)


def test_rsd_by_group(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("b", 1.0), ("c", -1.0), ("c", 1.0)], "k string, x double")
    rows = by(S.rsd_by_group(df, ["k"], "x"), "k")
    assert rows["a"]["rsd"] == pytest.approx(2**0.5 / 2)
    assert rows["b"]["rsd"] is None and rows["c"]["rsd"] is None


def test_missing_values_of_groups_without_a_grid(spark):
    every = spark.createDataFrame([("a",), ("b",), ("c",)], "v string")
    df = spark.createDataFrame([("x", "a"), ("x", "a"), ("y", "c"), ("y", "b"), ("y", "a"), (None, "b")], "k string, v string")
    got = J.missing_of(df, ["k"], "v", every)
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, [("x", "b"), ("x", "c"), (None, "a"), (None, "c")]))
    assert forbidden_in(got) == [] and J.missing_of(df.limit(0), ["k"], "v", every).count() == 0


def test_sized_tables_decide_the_join(spark):
    big = spark.range(100_000).withColumn("k", F.col("id") % 10)
    small = J.sized(big.groupBy("k").count())
    assert "BroadcastHashJoin" in plan_of(J.natural_left_join(big, small))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10")
    try:
        joined = J.natural_left_join(big, small)
        assert "SortMergeJoin" in plan_of(joined) and joined.count() == 100_000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_median_does_not_make_its_sketch_again(spark):
    """A cached sketch was not recognised in the passes over the rows it came from."""
    rows = spark.range(1000).select((F.col("id") % 7).cast("string").alias("k"), F.col("id").cast("double").alias("a"))
    more = J.null_safe_join(rows, J.sized(rows.groupBy("k").agg(F.max("a").alias("b"))), ["k"])
    result = S.median_min_max(more, ["k"], ["a", "b"])
    assert by(result, "k")["0"]["a_med"] == 497.0
    assert "percentile_approx" not in plan_of(result) and "approx_percentile" not in plan_of(result)
