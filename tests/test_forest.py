"""The deep forest: rows that a few trees tell apart, cut trees, the shared upper levels, saving."""
import numpy as np
import pytest
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from cohortlab.operators import forest, learn


def board(spark, n=900):
    """Three classes in a pattern of squares, beside a column that says nothing and one of a single value."""
    x, y = F.pmod(F.xxhash64("id"), F.lit(1000)) / 250, F.pmod(F.xxhash64("id", F.lit(7)), F.lit(1000)) / 250
    df = spark.range(n).select("id", x.alias("x"), y.alias("y"), F.pmod(F.xxhash64("id", F.lit(9)), F.lit(100)).cast("double").alias("z"), F.lit(1.0).alias("one"))
    df = df.withColumn("label", ((F.floor("x") + F.floor("y")) % 3).cast("int"))
    return learn.assemble(df, ["x", "y", "z", "one"]).select("id", "label", "features").repartition(3, "id").cache()


def said(model, df):
    return {r["id"]: r["prediction"] for r in model.transform(df).select("id", "prediction").collect()}


def share(model, df):
    return MulticlassClassificationEvaluator(metricName="accuracy").evaluate(model.transform(df))


def test_forest_learns_what_the_spark_forest_learns(spark):
    from pyspark.ml.classification import RandomForestClassifier
    df, new = board(spark), board(spark, 1200).where("id >= 900")
    got, want = (c(numTrees=30, maxDepth=12, seed=42).fit(df) for c in (forest.DeepForest, RandomForestClassifier))
    assert share(got, df) > 0.97 and share(got, new) > share(want, new) - 0.05
    imp, ref = got.featureImportances.toArray(), want.featureImportances.toArray()
    assert abs(imp.sum() - 1) < 1e-9 and imp[3] == 0 and np.abs(imp - ref).max() < 0.08
    row = got.transform(df).first()
    assert abs(sum(row["probability"]) - 1) < 1e-9 and row["prediction"] == np.argmax(row["rawPrediction"].toArray())


def test_open_nodes_of_many_rows_are_split_over_all_tasks(spark, monkeypatch):
    df = board(spark)
    monkeypatch.setattr(forest, "LOCAL_ROWS", 100)
    monkeypatch.setattr(forest, "BLOCK_ROWS", 64)
    model = forest.DeepForest(numTrees=20, maxDepth=12, seed=42).fit(df)
    assert share(model, df) > 0.97
    # Subtrees hang below upper levels, and a bound on the levels counts both.
    flat = forest.DeepForest(numTrees=5, maxDepth=2, seed=42).fit(df)
    assert max(len(t["feature"]) for t in flat.trees) <= 7
    monkeypatch.setattr(forest, "LOCAL_ROWS", 10**9)
    assert max(len(t["feature"]) for t in forest.DeepForest(numTrees=5, maxDepth=2, seed=42).fit(df).trees) <= 7


def test_fewer_trees_are_the_first_ones(spark):
    df = board(spark, 300)
    small, large = (forest.DeepForest(numTrees=t, maxDepth=30, seed=42).fit(df) for t in (4, 9))
    cut = large.votes(df, [4, 9], "v").select("id", learn.prediction_of(F.slice("v", 1, 3)).alias("p"))
    assert {r["id"]: r["p"] for r in cut.collect()} == said(small, df)


def test_least_rows_of_a_leaf_and_binary_columns(spark):
    rows = [(i, int(i < 3), float(i < 3)) for i in range(400)]  # a value held by three rows has a cut of its own
    df = learn.assemble(spark.createDataFrame(rows, "id long, label int, rare double"), ["rare"]).coalesce(1)
    assert share(forest.DeepForest(numTrees=15, seed=42).fit(df), df) == 1.0
    assert share(forest.DeepForest(numTrees=15, minInstancesPerNode=50, seed=42).fit(df), df) == 397 / 400


def test_saved_forest_answers_alike(spark, tmp_path):
    df = board(spark, 300)
    model = learn.fit_pipeline([learn.estimator("random_forest", n_estimators=7, max_depth=None)], df)
    path = str(tmp_path / "forest")
    learn.save_model(model, path)
    learn.save_model(model, path)  # overwrites
    again = learn.load_pipeline(path)
    assert said(again, df) == said(model, df)
    assert again.stages[0].featureImportances == model.stages[0].featureImportances


def test_rows_that_cannot_be_learned_from_raise(spark):
    df = board(spark, 20)
    for bad in (df.limit(0), df.withColumn("label", F.lit(0.5)), df.withColumn("label", F.lit(-1)), df.withColumn("label", F.lit(None).cast("int"))):
        with pytest.raises(ValueError):
            forest.DeepForest().fit(bad)
    with pytest.raises(Exception, match="null"):
        forest.DeepForest().fit(df.withColumn("features", F.when(F.col("id") > 3, F.col("features"))))


def test_sensitivity_curve_grows_each_tree_once(spark, monkeypatch):
    df, fits, fit = board(spark, 200), [], forest.DeepForest._fit

    def counted(self, rows):
        fits.append(self.getOrDefault("numTrees"))
        return fit(self, rows)

    monkeypatch.setattr(forest.DeepForest, "_fit", counted)
    got = learn.sensitivity_curve(df, df, trees=[6, 2]).collect()
    assert fits == [6] and [r["value"] for r in got] == [6.0, 2.0]
    ev = MulticlassClassificationEvaluator(metricName="f1")
    assert [r["f1"] for r in got] == [ev.evaluate(forest.DeepForest(numTrees=t, maxDepth=30, seed=42).fit(df).transform(df)) for t in (6, 2)]


def test_permuted_rows_are_scored_in_many_tasks(spark, monkeypatch):
    tasks = []

    class Watched:
        def transform(self, df):
            tasks.append(df.rdd.getNumPartitions())
            return df.withColumn("prediction", (vector_to_array("features")[0] > 0).cast("double"))

    rows = spark.range(400).select(F.when(F.col("id") % 2 == 0, 1.0).otherwise(-1.0).alias("a"), F.col("id").cast("double").alias("b"), (F.col("id") % 2 == 0).cast("int").alias("label"))
    monkeypatch.setattr(learn, "ROWS_PER_TASK", 100)
    assert dict(learn.permutation_importance(Watched(), rows, ["a", "b"]).collect())["b"] == 0.0
    assert tasks[0] >= 10


def test_numbers_that_are_not_finite(spark):
    rows = [(i, i % 2, [float(i % 2)]) for i in range(40)]
    df = learn.with_vector(spark.createDataFrame(rows, "id long, label int, a array<double>"), "a")
    odd = learn.with_vector(spark.createDataFrame([(0, [float("nan")]), (1, [float("-inf")])], "id long, a array<double>"), "a")
    with pytest.raises(Exception, match="finite"):
        forest.DeepForest(numTrees=3).fit(odd.withColumn("label", F.lit(1)))
    # As in Spark's trees, NaN is above every cut.
    assert said(forest.DeepForest(numTrees=9).fit(df), odd) == {0: 1.0, 1: 0.0}


def said_by(df, col="v"):
    return {r["id"]: list(r[col]) for r in df.select("id", col).collect()}


@pytest.mark.parametrize("local", [100, 10**9])
def test_trees_that_outgrow_the_driver_stay_a_table(spark, monkeypatch, tmp_path, local):
    df = board(spark, 400)
    for name, v in (("LOCAL_ROWS", local), ("BLOCK_ROWS", 64), ("GROUP_BYTES", 2_000)):
        monkeypatch.setattr(forest, name, v)
    est = forest.DeepForest(numTrees=6, maxDepth=8, seed=42)
    held, apart = est.grown(df, (1, 4), 1 << 30), est.grown(df, (1, 4), 100)
    want = said_by(held.votes(df, [2, 6], "v", (1, 4)))
    rows = df.withColumn("__row", F.lit(1)).withColumn("votes", F.lit(2)).unionByName(df.limit(0).withColumn("__row", F.lit(1)).withColumn("votes", F.lit(2)))
    got = apart.votes(rows, [2, 6], "v", (1, 4))
    assert said_by(got) == want and got.columns == [*rows.columns, "v"] and got.select("__row", "votes").distinct().collect() == [(1, 2)]
    assert apart.featureImportances == held.featureImportances and said(apart, df) == said(held, df)
    assert apart.transform(df.limit(0)).count() == 0
    # Cut trees are the trees of forests of fewer levels.
    for i, depth in enumerate((1, 4, 8)):
        for j, t in enumerate((2, 6)):
            alone = said_by(forest.DeepForest(numTrees=t, maxDepth=depth, seed=42).fit(df).votes(df, [t], "v"))
            assert all(v[(2 * i + j) * 3:(2 * i + j + 1) * 3] == alone[k] for k, v in want.items())
    path = str(tmp_path / "forest")
    apart.write().overwrite().save(path)
    again = forest.DeepForestModel.load(path)
    assert said(again, df) == said(apart, df)
    # Nothing of all that has brought the trees to the driver.
    assert again._trees is None and apart._trees is None


def test_forest_grid_scores_every_point_as_its_own_fit(spark, monkeypatch):
    df = board(spark, 300).withColumn("fold", (F.col("id") % 3).cast("int")).coalesce(1)  # as a grid search does: bags hang on the partitions
    grid, fits, grown = {"n_estimators": [3, 5], "max_depth": [2, None], "min_samples_split": [2, 5], "min_samples_leaf": [1, 9]}, [], forest.DeepForest.grown

    def watched(self, rows, levels=(), held=None):
        fits.append(held)
        return grown(self, rows, levels, held)

    monkeypatch.setattr(forest.DeepForest, "grown", watched)
    monkeypatch.setattr(learn, "FOREST_HELD", 0)
    model, scores = learn.grid_scores(df, "random_forest", grid, folds=3, fold_col="fold")
    # One forest for a leaf size and fold, the best again on all rows; none may keep its trees on the driver.
    assert fits == [0] * 7 and len(scores) == 16 and model.stages[0]._trees is None
    for point, got in scores:
        if tuple(point.values()) in ((3, None, 2, 1), (5, 2, 5, 9)):
            each = [share(learn.estimator("random_forest", **point).fit(df.where(F.col("fold") != i)), df.where(F.col("fold") == i)) for i in range(3)]
            assert abs(got - sum(each) / 3) < 1e-12
    best = max(scores, key=lambda s: s[1])[0]  # the first of the best
    assert said(model, df) == said(learn.estimator("random_forest", **best).fit(df), df)
