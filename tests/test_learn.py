"""Permutation importance against a model whose answers are known."""
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from cohortlab.operators import learn


class FirstFeature:
    """Predicts 1 where the first feature is above zero."""

    def transform(self, df):
        return df.withColumn("prediction", (vector_to_array("features")[0] > 0).cast("double"))


def rows(spark, n):
    first = F.when(F.col("id") % 2 == 0, 1.0).otherwise(-1.0)
    return spark.range(n).select(first.alias("a"), F.col("id").cast("double").alias("b"), (F.col("id") % 2 == 0).cast("int").alias("label"))


def test_only_the_used_feature_matters(spark):
    got = dict(learn.permutation_importance(FirstFeature(), rows(spark, 400), ["a", "b"]).collect())
    assert got["b"] == 0.0
    # Donors are as good as random: about half of them carry the other sign.
    assert 0.35 < got["a"] < 0.65


def test_one_row_and_no_row(spark):
    assert dict(learn.permutation_importance(FirstFeature(), rows(spark, 1), ["a", "b"]).collect()) == {"a": 0.0, "b": 0.0}
    assert dict(learn.permutation_importance(FirstFeature(), rows(spark, 0), ["a", "b"]).collect()) == {"a": None, "b": None}


def rings(spark, n=400):
    """Two classes on two circles around one centre: no line parts them."""
    angle = F.col("id").cast("double") * 2.399963
    radius = F.when(F.col("id") % 2 == 0, 1.0).otherwise(3.0) + F.sin(F.col("id") * 1.7) * 0.2
    df = spark.range(n).select("id", (F.col("id") % 2).cast("double").alias("label"), (radius * F.cos(angle)).alias("x"), (radius * F.sin(angle)).alias("y"))
    return learn.assemble(df, ["x", "y"]).select("id", "label", "features", (F.col("id") % 3).cast("int").alias("fold")).coalesce(1).cache()


def accuracy(df):
    return df.agg(F.avg((F.col("prediction") == F.col("label")).cast("double"))).first()[0]


def test_rbf_machine_parts_rings_that_a_line_cannot(spark, tmp_path):
    df = rings(spark)
    line = learn.fit_pipeline([learn.estimator("svm", 400, C=10, maxIter=12)], df)
    ring = learn.fit_pipeline([learn.estimator("svm", 400, C=10, kernel="rbf", n_features=64, maxIter=12)], df)
    assert accuracy(line.transform(df)) < 0.75 and accuracy(ring.transform(df)) > 0.97
    # The drawn map travels with the saved model.
    path = str(tmp_path / "model")
    learn.save_model(ring, path)
    again = learn.load_pipeline(path)
    want = {r["id"]: r["prediction"] for r in ring.transform(df).collect()}
    assert {r["id"]: r["prediction"] for r in again.transform(df).collect()} == want


def test_rbf_stage_runs_on_a_stream(spark, tmp_path):
    from pyspark.ml.classification import LinearSVC
    from cohortlab.operators.kernel import RbfFeatures
    df = rings(spark, 100)
    model = learn.fit_pipeline([RbfFeatures(numFeatures=32), LinearSVC(featuresCol="rbf", maxIter=10)], df)
    df.write.parquet(str(tmp_path / "in"))
    stream = model.transform(spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))).select("id", "prediction")
    q = stream.writeStream.format("memory").queryName("rbf_rows").start()
    q.processAllAvailable()
    q.stop()
    assert sorted(map(tuple, spark.table("rbf_rows").collect())) == sorted(map(tuple, model.transform(df).select("id", "prediction").collect()))


def test_rbf_map_approximates_the_kernel(spark):
    import numpy as np
    from cohortlab.operators.kernel import RbfFeatures
    df = rings(spark, 60)
    model = RbfFeatures(gamma="auto", numFeatures=4096).fit(df)
    got = model.transform(df).orderBy("id").select("features", "rbf").collect()
    x, z = np.array([r[0].toArray() for r in got]), np.array([r[1].toArray() for r in got])
    want = np.exp(-0.5 * ((x[:, None] - x[None]) ** 2).sum(-1))
    assert np.abs(z @ z.T - want).max() < 0.12
    scale = RbfFeatures(gamma="scale").fit(df)
    assert abs(scale.getOrDefault(scale.width) - 1 / (2 * x.var())) < 1e-9
    assert RbfFeatures(gamma=0.3).fit(df).getOrDefault("width") == 0.3
    import pytest
    for bad in ("wide", -1.0):
        with pytest.raises(ValueError):
            RbfFeatures(gamma=bad).fit(df)
    with pytest.raises(ValueError):
        RbfFeatures().fit(df.limit(0))


def test_grid_points_that_fit_the_same_are_fitted_once(spark):
    points, same = learn.grid_points("svm", learn.SVM_GRID, 100)
    assert len(points) == 12 and len(set(same)) == 9  # gamma means nothing to a line
    assert all((points[i]["kernel"] == "linear") == (points[j]["kernel"] == "linear") for i, j in enumerate(same))
    assert [len(learn.grid_points(k, g, 100)[0]) for k, g in (("random_forest", learn.RF_GRID), ("xgboost", learn.XGB_GRID))] == [36, 81]
    assert len(set(learn.grid_points("random_forest", learn.RF_GRID, 100)[1])) == 18  # no min-split parameter in Spark


def test_grid_search_prefers_the_rbf_kernel_on_rings(spark):
    df = rings(spark, 150)
    model, scores = learn.grid_scores(df, "svm", {"C": [10], "kernel": ["linear", "rbf"], "gamma": ["scale", "auto"], "maxIter": [6]}, fold_col="fold")
    by = {(p["kernel"], p["gamma"]): m for p, m in scores}
    assert by["linear", "scale"] == by["linear", "auto"] < 0.8 < 0.95 < max(by["rbf", "scale"], by["rbf", "auto"])
    assert accuracy(model.transform(df)) > 0.95
