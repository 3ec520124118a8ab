"""Resampling and splits: exact sizes, disjoint covers, label order."""
from pyspark.sql import functions as F

from cohortlab.functions import scalars as S
from cohortlab.operators import sampling as D
from cohortlab.plans.more_queries import AGE_EDGES, AGE_LABELS


def test_age_labels(spark):
    df = spark.createDataFrame([(a, "x") for a in [45, 55, 65, 75, 85]], "ENROLL_AGE int, OTHER_COLUMN string")
    got = [r[0] for r in df.select(S.bin_fixed("ENROLL_AGE", AGE_EDGES, AGE_LABELS)).collect()]
    assert got == AGE_LABELS


def test_split_exact_sizes(spark):
    df = spark.range(1000).withColumnRenamed("id", "k")
    s = D.train_val_test(df, "k")
    counts = {r[0]: r[1] for r in s.groupBy("split").count().collect()}
    assert counts == {"train": 700, "val": 150, "test": 150}
    assert s.select("k").distinct().count() == 1000


def test_rank_cut_refines(spark):
    df = spark.range(5000).withColumnRenamed("id", "k").withColumn("u", D.hash_u("k"))
    cut = D.rank_cut(df, "u", "k", 1234, bits=4, exact_rows=50)
    before = df.where((F.col("u") < cut[0]) | ((F.col("u") == cut[0]) & (F.col("k") < cut[1]))).count()
    assert before == 1234


def test_under_over(spark):
    df = spark.createDataFrame([(i, "a" if i < 30 else "b") for i in range(40)], "k long, g string")
    assert D.under_sample(df, "g", "a", 7, "k").count() == 7
    o = D.over_sample(df, "g", "b", 25, "k")
    assert o.count() == 25 and o.where("g <> 'b'").count() == 0


def test_folds_balanced(spark):
    df = spark.createDataFrame([(i, i % 2) for i in range(30)], "k long, label int")
    f = D.stratified_folds(df, "label", "k", 3)
    sizes = sorted(r[0] for r in f.groupBy("label", "fold").count().select("count").collect())
    assert sizes == [5] * 6


def test_cuts_take_one_histogram_and_repeated_keys_raise(spark):
    import pytest
    df = spark.range(3000).withColumnRenamed("id", "k")
    hist = D._histogram(df.withColumn("u", D.hash_u("k")), "u", D.U_BITS - 16)
    assert sum(r["n"] for r in hist) == 3000
    d = df.withColumn("u", D.hash_u("k"))
    for k in (0, 1234, 2999, 3000):
        assert D.rank_cut(d, "u", "k", k, histogram=hist) == D.rank_cut(d, "u", "k", k, bits=5, exact_rows=20)
    with pytest.raises(ValueError, match="repeats"):
        D.train_test(df.unionByName(df.limit(1)), "k")
    with pytest.raises(ValueError, match="repeats"):
        D.train_test(df.limit(3).select(F.when(F.col("k") > 5, F.col("k")).alias("k")), "k")


def test_rebalance_counts_two_groups_only(spark):
    df = spark.createDataFrame([(i, "abcd"[min(i // 10, 3)]) for i in range(70)], "k long, g string")
    out = D.rebalance(df, "g", "d", "a", "b", "k")
    assert {r["g"]: r["count"] for r in out.groupBy("g").count().collect()} == {"a": 10, "b": 10, "c": 10, "d": 10}
