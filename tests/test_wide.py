"""Many categories, many columns: encoders, Gram matrix, sets that stop growing, distances, associations."""
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortlab.operators import describe, encode, evaluate, gram, missing, outliers, quality
from cohortlab.operators import relational as R


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


# ---------------------------------------------------------------- keyed joins and ranks

@pytest.mark.parametrize("max_rows", [10, 1000])
@pytest.mark.parametrize("how", ["left", "inner"])
def test_keyed_join_splits_hot_values(spark, max_rows, how):
    rows = spark.range(3000).select("id", F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 100 == 1, None).otherwise(F.col("id") % 500).alias("k"))
    table = rows.where("k is not null and k <> 11").groupBy("k").agg(F.count("*").alias("n")).withColumn("v", F.col("k") * 2)
    want = rows.join(table.drop("n"), "k", how).select("id", "k", "v")
    got = R.join_keyed(rows, table, "k", how, max_rows=max_rows).select("id", "k", "v")
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_labels_of_a_million_values_are_not_collected(spark):
    df = spark.range(1_000_000).select((F.col("id") * 2 - 7).alias("v"))
    out = encode.label_encode(df, "v", "code")
    assert out.where(F.col("code") != (F.col("v") + 7) / 2).isEmpty() and out.count() == 1_000_000


def test_label_encode_in_place_and_nulls(spark):
    df = spark.createDataFrame([("b", 1, 1), (None, 2, 2), ("a", 3, 3), ("b", 4, 4)], "c string, n int, __value int")
    assert sorted(map(tuple, encode.label_encode(df, "c").collect()), key=str) == [(0, 3, 3), (1, 1, 1), (1, 4, 4), (None, 2, 2)]
    assert encode.label_encode(df, "c").columns == df.columns
    empty = encode.label_encode(df.where("c is null"), "c", "x")
    assert [tuple(r) for r in empty.collect()] == [(None, 2, 2, None)] and encode.label_encode(df.limit(0), "c").count() == 0


# ---------------------------------------------------------------- vector encoder

def test_vector_encoder_equals_the_named_columns(spark):
    rng = random.Random(1)
    rows = [(i, rng.choice(["x", "y", "z", None]), rng.choice([1, 2, 30, None]), rng.choice([0.5, 2.0, None])) for i in range(60)]
    df = spark.createDataFrame(rows, "id int, c string, k int, v double")
    for drop_first in (False, True):
        enc = encode.VectorEncoder(["c", "k"], ["v"], drop_first).fit(df)
        got = {}
        for r in enc.unpack(enc.transform(df), ["id"]).collect():
            got.setdefault(r["id"], {})[r["name"]] = r["value"]
        one = encode.OneHot(["c", "k"], drop_first).fit(df).transform(df)
        scaled = {r["id"]: r["v"] for r in encode.StandardScaler(["v"]).fit(df).transform(df).select("id", "v").collect()}
        for r in one.collect():
            want = {c: 1.0 for c in one.columns if c not in ("id", "v") and r[c]} | {"v": scaled[r["id"]] or 0.0}
            assert got[r["id"]] == pytest.approx(want)
        assert enc.names().count() == enc.size


def test_vector_encoder_has_no_limit_of_categories(spark):
    df = spark.range(100_000).select("id", F.concat(F.lit("c"), F.lpad(F.col("id").cast("string"), 6, "0")).alias("c"), (F.col("id") % 3).alias("k"))
    enc = encode.VectorEncoder(["c", "k"]).fit(df)
    assert enc.size == 100_003
    out = enc.transform(df)
    assert out.where((F.col("features.indices")[0] != F.col("id")) | (F.col("features.indices")[1] != 100_000 + F.col("k"))).isEmpty()
    assert "Python" not in plan(out)
    with pytest.raises(ValueError, match="VectorEncoder"):
        encode.OneHot(["c"]).fit(df)
    vector = encode.as_ml_vector(out.where("id = 5")).first()["features"]
    assert vector.size == 100_003 and sorted(vector.indices) == [5, 100_002]


def test_vector_encoder_unseen_values_and_empty_tables(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", 1.0)], "c string, v double")
    enc = encode.VectorEncoder(["c"], ["v"]).fit(df)
    new = spark.createDataFrame([("q", 3.0), (None, None)], "c string, v double")
    assert [tuple(r["features"]) for r in enc.transform(new).collect()] == [(3, [0], [2.0]), (3, [0], [0.0])]
    none = encode.VectorEncoder(["c"], ["v"]).fit(df.limit(0))
    assert none.size == 1 and none.transform(df).count() == 2
    assert enc.transform(df.limit(0)).count() == 0


def test_composer_leaves_excluded_columns_out(spark):
    df = spark.createDataFrame([(1, 2.0, "a")], "id int, v double, c string")
    assert encode.ColumnComposer(["v"], ["c"], ["id"]).fit(df).transform(df).columns == ["v", "c_a"]


# ---------------------------------------------------------------- Gram matrix

def test_wide_correlations_equal_corr(spark):
    rng = np.random.default_rng(4)
    p, n = 335, 300
    x = rng.normal(size=(n, p)) @ rng.normal(size=(p, p)) / 10 + rng.normal(size=p) * 1000
    x[:, 5] = 3.0  # constant
    holes = rng.random((n, p)) < 0.05
    x[holes] = np.nan
    x[:, 6] = np.nan
    cols = [f"c{i}" for i in range(p)]
    import pandas as pd
    df = spark.createDataFrame(pd.DataFrame(x, columns=cols)).repartition(5)
    out = describe.correlation_long(df, cols)
    got = {(r["i"], r["j"]): r["r"] for r in out.collect()}
    assert len(got) == p * p and got[0, 0] == 1.0 and got[5, 7] is None and got[6, 7] is None
    want = pd.DataFrame(x, columns=cols).corr().to_numpy()
    for i in range(0, p, 7):
        for j in range(p):
            if i != j and not np.isnan(want[i, j]):
                assert math.isclose(got[i, j], want[i, j], abs_tol=1e-8)
    assert len(plan(out)) < 200_000  # no expression a pair


def test_pair_sums_count_pairs_and_survive_empty_parts(spark):
    df = spark.createDataFrame([(1.0, None), (2.0, 3.0), (None, None)], "a double, b double").repartition(6)
    got = {r["i"]: r.asDict() for r in gram.pair_sums(df, ["a", "b"]).collect()}
    assert got[0]["n"] == [2, 1] and got[1]["n"] == [1, 1] and got[0]["c"] == [5.0, 6.0] and got[0]["a"] == [3.0, 2.0] and got[0]["at"] == [3.0, 3.0]
    assert gram.pair_sums(df.limit(0), ["a", "b"]).count() == 0
    assert sorted(map(tuple, gram.pearson(df, ["a", "b"]).collect())) == [(0, 0, 2, pytest.approx(1.0)), (0, 1, 1, None), (1, 0, 1, None), (1, 1, 1, None)]


# ---------------------------------------------------------------- roles

def test_few_distinct_values_are_counted_exactly(spark):
    df = spark.range(5000).select(
        *[(F.col("id") % k).alias(f"l{k}") for k in (1, 7, 8, 9, 10, 3000)], (F.col("id") % 8).cast("string").alias("s8"),
        F.when(F.col("id") % 2 == 0, "").otherwise("x").alias("blank"), F.lit(None).cast("string").alias("none"),
        F.when(F.col("id") % 3 == 0, -0.0).when(F.col("id") % 3 == 1, 0.0).alias("zero"), (F.col("id") % 2 == 0).alias("flag"),
        F.to_date(F.lit("2020-01-01")).alias("day"), (F.col("id") % 9).cast("decimal(5,2)").alias("dec"))
    got = {r["column"]: r["n_few"] for r in missing.few_distinct(df, 9).collect()}
    assert got == {"l1": 1, "l7": 7, "l8": 8, "l9": None, "l10": None, "l3000": None, "s8": 8, "blank": 2, "none": 0, "zero": 1, "flag": 2, "day": 1, "dec": None}
    want = {r["column"]: r["role"] for r in missing.column_roles(df, 9).collect()}
    assert {r["column"]: r["role"] for r in missing.quick_roles(df, 9).collect()} == want
    assert {r["n_few"] for r in missing.few_distinct(df.limit(0), 9).collect()} == {0}


def test_roles_of_many_columns_take_one_pass(spark):
    df = spark.range(2000).select(*[((F.col("id") * (i + 1)) % (i + 2)).alias(f"c{i}") for i in range(335)])
    out = missing.quick_roles(df, 9)
    text = plan(out)
    assert "Expand" not in text and "unpivot" not in text.lower() and text.count("Range (") <= 2
    assert {r["column"] for r in out.where("role = 'categorical'").collect()} >= {f"c{i}" for i in range(7)}


# ---------------------------------------------------------------- drift and association

def test_distances_against_plain_sums(spark):
    rng = np.random.default_rng(2)
    a, b = rng.normal(1000, 1, 400).round(2), rng.normal(1000.5, 2, 300).round(2)
    left = spark.createDataFrame([(float(v), "x" if v < 1000 else "y") for v in a] + [(None, None)], "v double, c string")
    right = spark.createDataFrame([(float(v), "x" if v < 1000 else "z") for v in b], "v double, c string")
    got = {r["column"]: r for r in quality.drift_distances(left, right).collect()}
    grid = np.unique(np.concatenate([a, b]))
    f = lambda s: np.searchsorted(np.sort(s), grid, side="right") / len(s)
    area = (np.abs(f(a) - f(b))[:-1] * np.diff(grid)).sum()
    assert math.isclose(got["v"]["wasserstein"], area, rel_tol=1e-9) and math.isclose(got["v"]["wasserstein_norm"], area / a.std(), rel_tol=1e-9)

    def js(p, q):
        m = (p + q) / 2
        part = lambda x: np.where(x > 0, x * np.log(np.where(x > 0, x, 1) / m), 0).sum()
        return math.sqrt((part(p) + part(q)) / 2)

    edges = np.linspace(grid[0], grid[-1], 31)
    p, q = (np.histogram(s, edges)[0] / len(s) for s in (a, b))
    keep = p + q > 0
    assert math.isclose(got["v"]["jensen_shannon"], js(p[keep], q[keep]), abs_tol=0.02)  # borders may round apart
    p, q = np.array([(a < 1000).mean(), (a >= 1000).mean(), 0]), np.array([(b < 1000).mean(), 0, (b >= 1000).mean()])
    assert math.isclose(got["c"]["jensen_shannon"], js(p, q), rel_tol=1e-9)


def test_distances_of_equal_empty_and_constant_sides(spark):
    df = spark.createDataFrame([(1.0, "x"), (2.0, "y")], "v double, c string")
    got = {r["column"]: tuple(r)[2:] for r in quality.drift_distances(df, df).collect()}
    assert got == {"v": (0.0, 0.0, 0.0), "c": (None, None, 0.0)}
    got = {r["column"]: tuple(r)[2:] for r in quality.drift_distances(df, df.limit(0)).collect()}
    assert got == {"v": (None, None, None), "c": (None, None, None)}
    one = spark.createDataFrame([(5.0, "x")], "v double, c string")
    got = {r["column"]: tuple(r)[2:] for r in quality.drift_distances(one, df).collect()}
    assert got["v"][0] == 3.5 and got["v"][1] == 3500.0


def test_associations_known_and_undefined(spark):
    rows = [(float(i), 2.0 * i, "a" if i % 2 else "b", "p" if i % 2 else "q", "k", float(i % 2)) for i in range(40)] + [(None, 1.0, None, "p", None, None)]
    df = spark.createDataFrame(rows, "x double, y double, c string, d string, one string, z double")
    got = {(r["a"], r["b"]): (r["kind"], r["n"], r["value"]) for r in quality.associations(df, ["x", "y", "z"], ["c", "d", "one"]).collect()}
    assert len(got) == 15
    assert got["x", "y"] == ("pearson", 40, pytest.approx(1.0)) and got["c", "d"] == ("cramers_v", 40, pytest.approx(1.0))
    assert got["c", "one"] == ("cramers_v", 40, None) and got["c", "z"] == ("correlation_ratio", 40, pytest.approx(1.0))
    assert got["one", "x"][2] == pytest.approx(0.0, abs=1e-9)
    top = quality.associations(df, ["x", "y", "z"], ["c", "d", "one"], top=1).collect()
    assert sorted((r["kind"], r["a"], r["b"]) for r in top) == [("correlation_ratio", "c", "z"), ("cramers_v", "c", "d"), ("pearson", "x", "y")]
    assert quality.associations(df.limit(0), ["x", "y"], ["c", "d"]).where("value is not null").isEmpty()


def test_chi_square_on_shares_needs_no_window(spark):
    ref = spark.createDataFrame([("a",)] * 30 + [("b",)] * 10, "c string")
    cur = spark.createDataFrame([("a",)] * 10 + [("c",)] * 10, "c string")
    table = quality.chi2_table(ref, cur, ["c"], "share")
    assert "Window" not in plan(table)
    p, q = np.array([0.75, 0.25, 0]), np.array([0.5, 0, 0.5])
    want = sum(((o - (p + q) / 2) ** 2 / ((p + q) / 2)).sum() for o in (p, q))
    assert table.first()["statistic"] == pytest.approx(want)


# ---------------------------------------------------------------- others

def test_roc_groups_with_nulls_stay_apart(spark):
    rows = [("a", None, True, 0.9), ("a", None, False, 0.1), (None, "a", True, 0.2), (None, "a", False, 0.8)]
    _, auc = evaluate.roc_points(spark.createDataFrame(rows, "x string, y string, is_pos boolean, score double"), ["x", "y"])
    assert {(r["x"], r["y"]): r["auc"] for r in auc.collect()} == {("a", None): 1.0, (None, "a"): 0.0}


def test_isolation_forest_scores_columns_from_the_input(spark):
    rows = [(float(i % 10), float(i % 7)) for i in range(300)] + [(500.0, 3.0), (4.0, -900.0)]
    df = spark.createDataFrame(rows, "a double, b double")
    out = outliers.isolation_forest_to_median(df, ["a", "b"], 0.005, n_trees=30).collect()
    assert max(r["a"] for r in out) < 500 and min(r["b"] for r in out) > -900 and len(out) == 302
    one = outliers.isolation_forest_to_median(df, ["b"], 0.005, n_trees=30).collect()
    assert sorted(r["b"] for r in one) == sorted(r["b"] for r in out)  # columns do not depend on each other
    assert outliers.isolation_forest_to_median(df.limit(0), ["a"]).count() == 0


def test_mean_of_step_functions():
    rng = np.random.default_rng(5)
    trees = [(np.sort(rng.normal(size=n)), rng.normal(size=n + 1)) for n in (0, 1, 7, 30)]
    cuts, lengths = outliers.mean_steps(trees)
    v = np.concatenate([rng.normal(size=200) * 2, cuts])
    want = sum(h[np.searchsorted(c, v, side="right")] for c, h in trees) / 4
    assert np.allclose(lengths[np.searchsorted(cuts, v, side="right")], want)


def test_every_tree_gets_a_sample(spark):
    for n in (3, 300, 20_000, 400_000):
        df = spark.range(n).select(F.when(F.col("id") < 3, 1e6).otherwise(F.col("id") % 100).cast("double").alias("v"), "id")
        scored = df.withColumn("s", outliers.isolation_scorer(df, "v", n_trees=20))
        far, near = (scored.where(c).agg(F.avg("s")).first()[0] for c in ("v > 1000", "v between 40 and 60"))
        assert far > 0 and (near is None or far > near)
