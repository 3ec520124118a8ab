"""Statistics, drift and evaluation properties."""
import math

from pyspark.sql import functions as F

from cohortlab.functions.stats import chi2_sf, ks_pvalue
from cohortlab.operators import evaluate as V
from cohortlab.operators import quality as Q
from cohortlab.operators.describe import describe


def test_ks_zero_on_equal(spark):
    df = spark.createDataFrame([(float(i % 17),) for i in range(200)], "x double")
    r = Q.ks_drift(df, df).first()
    assert r["ks_stat"] == 0.0 and r["p_value"] == 1.0 and not r["drift"]


def test_ks_symmetric(spark):
    a = spark.createDataFrame([(float(i),) for i in range(100)], "x double")
    b = spark.createDataFrame([(float(i) + 30,) for i in range(100)], "x double")
    assert abs(Q.ks_drift(a, b).first()["ks_stat"] - 0.3) < 1e-12
    assert abs(Q.ks_drift(b, a).first()["ks_stat"] - 0.3) < 1e-12


def test_pvalues():
    assert abs(chi2_sf(3.841458820694124, 1) - 0.05) < 1e-6
    assert abs(chi2_sf(5.991464547107979, 2) - 0.05) < 1e-6
    assert 0 < ks_pvalue(0.3, 100, 100) < 0.001


def test_chi2_against_spark_ml(spark):
    # 30/10 vs 20/40 contingency without correction
    from pyspark.ml.linalg import Vectors
    from pyspark.ml.stat import ChiSquareTest
    ref = spark.createDataFrame([("a",)] * 30 + [("b",)] * 10, "c string")
    cur = spark.createDataFrame([("a",)] * 20 + [("b",)] * 40, "c string")
    stat = Q.chi2_table_no_yates(ref, cur, ["c"]).first()["statistic"]
    rows = [(0.0, Vectors.dense([0.0]))] * 30 + [(0.0, Vectors.dense([1.0]))] * 10 + \
           [(1.0, Vectors.dense([0.0]))] * 20 + [(1.0, Vectors.dense([1.0]))] * 40
    ml = ChiSquareTest.test(spark.createDataFrame(rows, ["label", "features"]), "features", "label").first()
    assert math.isclose(stat, float(ml.statistics[0]), rel_tol=1e-9)


def test_describe_matches_pandas_interpolation(spark):
    df = spark.createDataFrame([(float(x),) for x in [1, 2, 3, 4]], "v double")
    r = describe(df, ["v"]).first()
    assert r["p25"] == 1.75 and r["p50"] == 2.5 and r["count"] == 4


def test_auc_bounds_and_perfect(spark):
    rows = [("c", float(i) / 10, i >= 5) for i in range(10)]
    df = spark.createDataFrame(rows, "class string, score double, is_pos boolean")
    _, auc = V.roc_points(df, ["class"])
    assert auc.first()["auc"] == 1.0


def test_fairness_zero_when_equal(spark):
    rows = [("m", "A", "A", g) for g in ["0", "1"] for _ in range(5)]
    df = spark.createDataFrame(rows, "model string, label string, prediction string, s string")
    fl = V.fairness_long(df, "label", ["s"], ["model"]).first()
    assert fl["dp_diff"] == 0.0 and fl["eo_diff"] == 0.0


def test_validate_report(spark):
    df = spark.createDataFrame([(1, None)], "a int, b int")
    rep = {r["check_name"]: r["passed"] for r in Q.validate(df, ["a", "c"]).collect()}
    assert rep == {"not_empty": True, "required_columns": False, "no_nulls": False}
