"""Edges where rows or results must not be lost."""

import math

import pytest
from pyspark.sql import functions as F

from cohortlab.operators import describe, evaluate, outliers, quality, relational, sampling
from cohortlab.streaming import scoring


def test_isolation_sample_never_vanishes():
    for n in (1, 10, 10**6, 3 * 10**8, 4 * 10**8, 10**11, 10**14):
        t = outliers.hash_threshold(n, 256)
        assert 0 < t < 2**63 and (n < 400 or abs(t / 2**63 * n - 384) < 1)


def test_step_function_equals_walking_the_tree():
    tree = ("node", 5.0, ("leaf", 3), ("node", 7.0, ("leaf", 1), ("leaf", 4)))
    cuts, lengths = outliers.step_function(tree, float)
    assert cuts.tolist() == [5.0, 7.0] and lengths.tolist() == [4.0, 3.0, 6.0]


def test_isolation_replaces_the_asked_share(spark):
    df = spark.range(2000).select(F.col("id"), (F.col("id") % 97).cast("double").alias("v")).unionByName(
        spark.range(20).select((F.col("id") + 5000).alias("id"), (F.lit(1e6) + F.col("id")).alias("v")))
    out = outliers.isolation_forest_to_median(df, ["v"], contamination=0.05, n_trees=20)
    assert out.agg(F.max("v")).first()[0] < 1000
    assert out.count() == 2020


def test_histogram_has_empty_bins(spark):
    df = spark.createDataFrame([(0.0, 1.0), (0.1, 1.0), (10.0, 1.0)], "v double, one double")
    got = {(r["column"], r["bin"]): r["count"] for r in describe.histogram(df, ["v", "one"], 20).collect()}
    assert len(got) == 21 and got["v", 0] == 2 and got["v", 19] == 1 and sum(got.values()) == 6 and got["one", 0] == 3


def test_density_has_all_points(spark):
    vals = [0.0] * 50 + [1000.0] * 50 + [1.0]
    got = describe.kde(spark.createDataFrame([(v,) for v in vals], "v double"), "v").orderBy("i").collect()
    assert len(got) == 200 and all(r["density"] >= 0 for r in got)
    m = sum(vals) / len(vals)
    h = math.sqrt(sum((v - m) ** 2 for v in vals) / (len(vals) - 1)) * len(vals) ** -0.2
    for r in got[::40]:
        want = sum(math.exp(-0.5 * ((r["x"] - v) / h) ** 2) for v in vals) / (len(vals) * h * math.sqrt(2 * math.pi))
        assert r["density"] == pytest.approx(want, rel=1e-9)
    assert [tuple(r) for r in describe.kde(spark.createDataFrame([(3.0,), (3.0,)], "v double"), "v").collect()] == [(0, 3.0, None)]


def test_fold_keeps_repeated_and_null_keys(spark):
    a = spark.createDataFrame([(1, 10), (1, 11), (None, 5)], "k int, a int")
    b = spark.createDataFrame([(1, 20), (None, 6)], "k int, b int")
    got = sorted((tuple(r) for r in relational.full_outer_fold([a, b], "k").collect()), key=str)
    assert got == sorted([(1, 10, 20), (1, 11, 20), (None, 5, None), (None, None, 6)], key=str)
    with pytest.raises(Exception, match="repeats"):
        relational.full_outer_fold([a, b], "k", one_row_per_key=True).collect()
    once = relational.full_outer_fold([a.where("a <> 11"), b], "k", one_row_per_key=True).collect()
    assert sorted((tuple(r) for r in once), key=str) == sorted([(1, 10, 20), (None, 5, None), (None, None, 6)], key=str)


def test_null_text_is_rejected(spark):
    df = spark.createDataFrame([("1,2",), ("1",), (None,), ("1,x",)], "t string")
    good, bad = scoring.parse_rows(df, "t", 2)
    assert (good.count(), bad.count()) == (1, 3)
    assert all(r["reason"] for r in bad.collect())


def test_split_with_a_null_key_and_with_repeated_keys(spark):
    df = spark.createDataFrame([(k if k else None,) for k in range(30)], "k long")
    got = {r["split"]: r["count"] for r in sampling.train_test(df, "k").groupBy("split").count().collect()}
    assert got == {"train": 24, "test": 6}
    with pytest.raises(ValueError, match="repeats"):
        sampling.train_test(df.unionByName(df), "k")
    with pytest.raises(ValueError, match="empty group"):
        sampling.over_sample(df.withColumn("g", F.lit("a")), "g", "b", 3, "k")


def test_validate_one_column(spark):
    got = {r["check_name"]: r["passed"] for r in quality.validate(spark.createDataFrame([(1,), (None,)], "a int")).collect()}
    assert got == {"not_empty": True, "required_columns": True, "no_nulls": False}


def test_drift_with_an_empty_side(spark):
    a = spark.createDataFrame([(1.0, 1.0), (2.0, 2.0)], "x double, y double")
    b = spark.createDataFrame([(None, 1.0), (None, 5.0)], "x double, y double")
    got = {r["column"]: r for r in quality.ks_drift(a, b).collect()}
    assert got["x"]["ks_stat"] is None and got["x"]["drift"] is None
    assert got["y"]["ks_stat"] == 0.5 and 0 < got["y"]["p_value"] <= 1


def test_roc_of_a_class_without_positives(spark):
    df = spark.createDataFrame([("a", False, 0.1), ("a", False, 0.2), ("b", True, 0.9), ("b", False, 0.1)], "class string, is_pos boolean, score double")
    _, auc = evaluate.roc_points(df)
    assert {r["class"]: r["auc"] for r in auc.collect()} == {"a": None, "b": 1.0}


def test_fairness_counts_classes_that_a_group_lacks(spark):
    """Group b never has class 1 and is never given it: its rates there are zero."""
    df = spark.createDataFrame([("m", 0, 0, "b"), ("m", 0, 0, "b"), ("m", 1, 1, "a"), ("m", 0, 1, "a"), ("m", 0, 0, "a"),
                                ("m", 2, 0, None)], "model string, label int, prediction int, s string")
    got = {r["class"]: (r["dp_diff"], r["eo_diff"]) for r in evaluate.fairness_long(df, "label", ["s"]).collect()}
    assert got[1] == (pytest.approx(2 / 3), 1.0)
    assert got[0] == (pytest.approx(2 / 3), 1.0)
    assert got[2] == (0.0, 0.0)


def test_unknown_model_name_raises(spark):
    acc = spark.createDataFrame([("naive bayes", 0.5)], "model string, accuracy double")
    fair = spark.createDataFrame([("naive bayes", 0.1, 0.1)], "model string, dp_diff double, eo_diff double")
    with pytest.raises(Exception, match="no model type"):
        evaluate.rank_models(acc, fair).collect()
