"""Learning, inventory IDs L1-L12, on Spark ML.

Features travel as one ``vector`` column; the label is an integer class
index (E5). Grids are the reference's, mapped onto Spark ML parameters
where an equivalent exists (see the table in the README).
"""

from __future__ import annotations

import itertools
import math
from functools import reduce
from multiprocessing.pool import ThreadPool
from typing import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LinearSVC, LogisticRegression, OneVsRest
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.functions import array_to_vector
from pyspark.ml.param import Params
from pyspark.ml.tuning import CrossValidator
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.util import inheritable_thread_target

from cohortlab.operators.forest import PAIRS_PER_TASK, DeepForest, prediction_of
from cohortlab.operators.kernel import RbfFeatures
from cohortlab.session import checkpointed

# The reference's search grids (L2-L5, L7) and the sensitivity axis.
SVM_GRID = {"C": [0.1, 1, 10], "kernel": ["linear", "rbf"], "gamma": ["scale", "auto"]}
RF_GRID = {"n_estimators": [50, 100, 200], "max_depth": [10, 20, 30], "min_samples_split": [2, 5],
           "min_samples_leaf": [1, 2]}
XGB_GRID = {"max_depth": [3, 6, 10], "learning_rate": [0.01, 0.1, 0.3], "n_estimators": [50, 100, 200],
            "subsample": [0.8, 0.9, 1.0]}
LR_GRID = {"C": [0.1, 1, 10], "solver": ["liblinear", "saga"]}
RF_F1_GRID = {"n_estimators": [50, 100, 150], "max_depth": [None, 10, 20], "min_samples_split": [2, 5, 10],
              "min_samples_leaf": [1, 2, 4]}
SENSITIVITY_TREES = [10, 50, 100, 150, 200]
# Rows that one task of an iterative fit holds at least.
ROWS_PER_TASK = 10_000
# Machines of one class against the rest that are fitted side by side.
CLASSES_AT_ONCE = 4
# Bytes of trees that a forest of a grid has on the driver at most.
FOREST_HELD = 8 << 20


def spread(df: DataFrame, n: int | None = None, rows: int = ROWS_PER_TASK) -> DataFrame:
    """``df`` (of ``n`` rows) over as many tasks as ``rows`` each ask for, however it was stored: few tasks for a small table, none that grows with a large one."""
    return df.repartition(max(1, math.ceil((df.count() if n is None else n) / rows)))


def with_vector(df: DataFrame, array_col: str, out: str = "features") -> DataFrame:
    """array<float|double> -> ML vector (JVM-side, no UDF)."""
    return df.withColumn(out, array_to_vector(F.col(array_col).cast("array<double>")))


def assemble(df: DataFrame, cols: Sequence[str], out: str = "features") -> DataFrame:
    """Numeric columns -> one vector column."""
    from pyspark.ml.feature import VectorAssembler
    return VectorAssembler(inputCols=list(cols), outputCol=out, handleInvalid="keep").transform(df)


def estimator(kind: str, n_rows: int = 1, **p):
    """The four classifiers with reference parameter names mapped.

    * SVM: ``OneVsRest(LinearSVC(regParam = 1 / (n C)))``; ``kernel='rbf'`` puts ``RbfFeatures`` (with ``gamma`` and
      ``n_features``) in front of it, as a pipeline.
    * forest: ``DeepForest`` with ``numTrees``, ``maxDepth`` (None -> 30), ``minInstancesPerNode``
      = min_samples_leaf (as in Spark's forest there is no min-split parameter).
    * boosting: ``OneVsRest(GBTClassifier(maxDepth, stepSize, maxIter, subsamplingRate))``.
    * logistic: multinomial, ``regParam = 1 / (n C)``, no standardisation.
    """
    if kind == "svm":
        kernel = p.get("kernel", "linear")
        if kernel not in ("linear", "rbf"):
            raise ValueError(f"unknown kernel {kernel}")
        machine = LinearSVC(regParam=1.0 / (max(n_rows, 1) * p.get("C", 1.0)), maxIter=p.get("maxIter", 50))
        if kernel == "linear":
            return OneVsRest(classifier=machine, parallelism=CLASSES_AT_ONCE)
        mapped = RbfFeatures(inputCol="features", outputCol="rbf", gamma=p.get("gamma", "scale"), numFeatures=p.get("n_features", 128), seed=42)
        return Pipeline(stages=[mapped, OneVsRest(classifier=machine.setFeaturesCol("rbf"), featuresCol="rbf", parallelism=CLASSES_AT_ONCE)])
    if kind == "random_forest":
        depth = p.get("max_depth") or 30
        return DeepForest(numTrees=p.get("n_estimators", 100), maxDepth=min(depth, 30),
                          minInstancesPerNode=p.get("min_samples_leaf", 1), seed=42)
    if kind == "xgboost":
        return OneVsRest(classifier=GBTClassifier(maxDepth=p.get("max_depth", 3), stepSize=p.get("learning_rate", 0.1),
                                                  maxIter=p.get("n_estimators", 50),
                                                  subsamplingRate=p.get("subsample", 1.0), seed=42),
                         parallelism=CLASSES_AT_ONCE)
    if kind == "logistic_regression":
        c = p.get("C", 1.0)
        return LogisticRegression(family="multinomial", elasticNetParam=0.0, regParam=1.0 / (max(n_rows, 1) * c),
                                  standardization=False, maxIter=p.get("maxIter", 100))
    raise ValueError(kind)


def _signature(stage) -> str:
    """The parameters of an estimator and of those inside it; equal for estimators that fit the same."""
    if isinstance(stage, list):
        return repr([_signature(x) for x in stage])
    if isinstance(stage, Params):
        return type(stage).__name__ + repr(sorted((k.name, _signature(v)) for k, v in stage.extractParamMap().items()))
    return repr(stage)


def grid_points(kind: str, grid: dict, n_rows: int) -> tuple[list[dict], list[int]]:
    """All points of a grid in order, and for each the position of the first one that fits the same
    (axes that Spark has not got, and ``gamma`` of a linear machine, change nothing)."""
    points = [dict(zip(grid, v)) for v in itertools.product(*grid.values())]
    first: dict[str, int] = {}
    return points, [first.setdefault(_signature(estimator(kind, n_rows, **pt)), i) for i, pt in enumerate(points)]


def grid_scores(train: DataFrame, kind: str, grid: dict, folds: int = 3, metric: str = "accuracy",
                fold_col: str | None = None, parallelism: int = 4):
    """Cross-validated grid search: ``(best model, refit on all training rows; [(point, mean metric)] of all points)``.

    ``fold_col`` (D6 stratified folds) keeps the folds exact and reproducible; otherwise Spark's random folds.
    Points that fit the same are fitted once and share their metric. The best is the first of those with the largest.
    Forests of one grid share their trees (``_forest_grid``).
    """
    points, same = grid_points(kind, grid, n := train.count())
    # A fit of many short iterations is bound by its task launches: a small table takes few tasks.
    train = train.coalesce(max(1, -(-n // ROWS_PER_TASK)))
    base = Pipeline(stages=[])
    unique = sorted(set(same))
    maps = [{base.stages: [estimator(kind, n, **points[i])]} for i in unique]
    ev = MulticlassClassificationEvaluator(metricName="f1" if metric == "f1" else "accuracy")
    cv = CrossValidator(estimator=base, estimatorParamMaps=maps, evaluator=ev, numFolds=folds,
                        parallelism=parallelism, seed=42, **({"foldCol": fold_col} if fold_col else {}))
    if kind == "random_forest":
        model, metrics = _forest_grid([m[base.stages][0] for m in maps], train, cv, ev, parallelism)
        got = dict(zip(unique, metrics))
        return model, [(pt, float(got[i])) for pt, i in zip(points, same)]
    model = cv.fit(train)
    got = dict(zip(unique, model.avgMetrics))
    return model.bestModel, [(pt, float(got[i])) for pt, i in zip(points, same)]


def _forest_grid(forests: list[DeepForest], train: DataFrame, cv: CrossValidator, ev, parallelism: int) -> tuple[PipelineModel, list[float]]:
    """What ``cv`` finds for these forests: the first best, fitted to all rows, and the mean metric of each.

    Trees hang on (seed, number) only and are cut by a bound on their levels, so forests that differ in the number of trees and
    levels are parts of the largest of them: for each least size of a leaf and fold one forest is grown, and one pass over it
    scores all. Trees of more than ``FOREST_HELD`` bytes never come to the driver, however many fits run side by side."""
    spark = train.sparkSession
    alike: dict[int, list[int]] = {}
    for i, f in enumerate(forests):
        alike.setdefault(f.getOrDefault("minInstancesPerNode"), []).append(i)

    def fold(job: tuple) -> list[tuple[int, float]]:
        members, (fit_rows, val) = job
        sizes, depths = (sorted({forests[i].getOrDefault(p) for i in members}) for p in ("numTrees", "maxDepth"))
        largest = forests[members[0]].copy()._set(numTrees=sizes[-1], maxDepth=depths[-1])
        model = largest.grown(fit_rows.select("label", "features"), tuple(depths[:-1]), FOREST_HELD)
        votes = model.votes(val.select("label", "features"), sizes, "__votes", tuple(depths[:-1]))
        k = model.numClasses
        place = {(d, t): (a * len(sizes) + b) * k + 1 for a, d in enumerate(depths) for b, t in enumerate(sizes)}
        at = {i: place[forests[i].getOrDefault("maxDepth"), forests[i].getOrDefault("numTrees")] for i in members}
        scored = checkpointed(votes.select(F.col("label").cast("double").alias("label"), *[prediction_of(F.slice("__votes", at[i], k)).alias(f"p{i}") for i in members]))
        return [(i, ev.evaluate(scored.select("label", F.col(f"p{i}").alias("prediction")))) for i in members]

    folds = [tuple(d.cache() for d in pair) for pair in cv._kFold(train)]
    jobs = [(members, pair) for members in alike.values() for pair in folds]
    # A fit that fills the cluster by itself has it to itself.
    pairs = train.count() * max(f.getOrDefault("numTrees") for f in forests)
    with ThreadPool(1 if pairs > 2 * PAIRS_PER_TASK * spark.sparkContext.defaultParallelism else min(parallelism, len(jobs))) as pool:
        found = [x for got in pool.map(inheritable_thread_target(spark)(fold), jobs, chunksize=1) for x in got]
    for d in (d for pair in folds for d in pair):
        d.unpersist()
    metrics = [sum(v for j, v in found if j == i) / len(folds) for i in range(len(forests))]
    best = forests[metrics.index(max(metrics))].grown(train, held=FOREST_HELD)
    return PipelineModel(stages=[best]), metrics


def grid_search(train: DataFrame, kind: str, grid: dict, folds: int = 3, metric: str = "accuracy",
                fold_col: str | None = None, parallelism: int = 4):
    """``grid_scores`` as (best model, best point, metrics of all points)."""
    model, scores = grid_scores(train, kind, grid, folds, metric, fold_col, parallelism)
    metrics = [m for _, m in scores]
    return model, scores[metrics.index(max(metrics))][0], metrics


def predict(model, df: DataFrame) -> DataFrame:
    """L11."""
    return model.transform(df)


def feature_importance(model, names: Sequence[str], k: int = 10, spark=None) -> DataFrame:
    """Tree-ensemble importances, top k by value then name."""
    imp = model.featureImportances.toArray()
    rows = sorted(zip(names, [float(v) for v in imp]), key=lambda t: (-t[1], t[0]))[:k]
    spark = spark or __import__("pyspark.sql", fromlist=["SparkSession"]).SparkSession.getActiveSession()
    return spark.createDataFrame(rows, "feature string, importance double")


def permutation_importance(model, df: DataFrame, feature_cols: Sequence[str], label: str = "label",
                           seed: int = 42) -> DataFrame:
    """L9 (re-aim of the SHAP summaries): accuracy drop when one feature is
    shuffled. Every row takes the feature of the row of the next hash rank: one
    join gives each row its donor, then a row is scored once as it is and once
    per feature, and only counts leave the task. Not SHAP values. Features
    hold no nulls; an empty table gives null importances.
    """
    from cohortlab.operators.relational import with_row_index
    p = len(feature_cols)
    x = F.array(*[F.col(c).cast("double") for c in feature_cols])
    rows = df.select(F.col(label).alias("label"), x.alias("__x"), F.xxhash64(*feature_cols, F.lit(seed)).alias("__h"))
    ranked = checkpointed(with_row_index(rows, ["__h", "label"], "__r").drop("__h"))
    n = max(ranked.count(), 1)
    donor = ranked.select(((F.col("__r") + 1) % n).alias("__to"), F.col("__x").alias("__d"))
    # The lowest rank is 0 or 1, so ranks are compared modulo n.
    pairs = ranked.join(donor, (F.col("__r") % n) == F.col("__to"))
    # A row is scored p + 1 times, more work than the bytes that the join was cut by tell.
    pairs = spread(pairs, n, max(1, ROWS_PER_TASK // (p + 1)))
    each = pairs.select("label", "__x", "__d", F.explode(F.sequence(F.lit(0), F.lit(p))).alias("__f"))
    # Feature p does not exist: the row as it is.
    swapped = F.transform("__x", lambda v, i: F.when(i == F.col("__f"), F.element_at("__d", i + 1)).otherwise(v))
    scored = model.transform(each.select("label", "__f", array_to_vector(swapped).alias("features")))
    hit = (F.col("prediction") == F.col("label")).cast("double")
    acc = dict(scored.groupBy("__f").agg(F.avg(hit).alias("a")).collect())
    out = [(c, acc[p] - acc[i] if p in acc else None) for i, c in enumerate(feature_cols)]
    return df.sparkSession.createDataFrame(out, "feature string, importance double")


def sensitivity_curve(train: DataFrame, test: DataFrame, trees: Sequence[int] = SENSITIVITY_TREES,
                      label: str = "label", max_depth: int = 30) -> DataFrame:
    """Weighted F1 on ``test`` for forests of each size, as deep as the reference's on Spark (30 levels).

    Trees hang on (seed, number) only, so the first t trees of the largest forest are the forest of t trees: all are grown
    once, and one pass over them scores every size."""
    if not trees:
        return train.sparkSession.createDataFrame([], "param string, value double, f1 double")
    ev = MulticlassClassificationEvaluator(metricName="f1", labelCol=label)
    model = DeepForest(numTrees=max(trees), maxDepth=max_depth, seed=42, labelCol=label).fit(train)
    k, sizes = model.numClasses, sorted(set(trees))
    votes = model.votes(test, sizes, "__votes")
    scored = checkpointed(votes.select(F.col(label).cast("double").alias(label), *[
        prediction_of(F.slice("__votes", i * k + 1, k)).alias(f"t{t}") for i, t in enumerate(sizes)]))
    rows = [("n_estimators", float(t), ev.evaluate(scored.select(label, F.col(f"t{t}").alias("prediction")))) for t in trees]
    return train.sparkSession.createDataFrame(rows, "param string, value double, f1 double")


def save_model(model, path: str) -> None:
    """S6."""
    model.write().overwrite().save(path)


def load_pipeline(path: str) -> PipelineModel:
    """S6."""
    return PipelineModel.load(path)


def fit_pipeline(stages, df: DataFrame) -> PipelineModel:
    return Pipeline(stages=list(stages)).fit(df)


def select_best(models: dict, rows: DataFrame, sensitive: Sequence[str], label: str = "label") -> tuple[str, DataFrame]:
    """V13 selection: ``(name of the best, ranking)`` of fitted ``{name: model}`` on validation rows, by accuracy less
    0.7 x unfairness over the ``sensitive`` columns. The predictions are scanned once, for one contingency table."""
    from cohortlab.operators import evaluate as V
    preds = [predict(m, rows).select(F.lit(name).alias("model"), F.col(label).alias("label"), F.col("prediction").cast("int").alias("prediction"), *sensitive)
             for name, m in models.items()]
    cells = V.contingency(reduce(DataFrame.unionByName, preds), list(sensitive))
    ranked = checkpointed(V.rank_models(V.accuracy_of_cells(cells, ["model"]), V.fairness_report(cells, list(sensitive), cells=cells)))
    return V.best_model(ranked).first()["model"], ranked


def keep_best(model, name: str, test: DataFrame, path: str, runs: str, label: str = "label") -> dict:
    """The winner's accuracy and weighted F1 on the test rows, after which it is saved to ``path``, loaded again and logged in
    ``runs``. Also tells whether the loaded model predicts every test row alike. No test rows: null scores."""
    from cohortlab.operators import evaluate as V
    from cohortlab.sources import io as IO
    test = test.withColumn("__row", F.monotonically_increasing_id())
    save_model(model, path)
    answers = lambda m, c: predict(m, test).select("__row", F.col(label).alias("label"), F.col("prediction").alias(c))
    both = checkpointed(answers(model, "prediction").join(answers(load_pipeline(path), "again").drop("label"), "__row"))
    acc = V.accuracy(both).first()["accuracy"]
    f1 = V.weighted_f1(both.select(F.col("label").cast("int").alias("label"), F.col("prediction").cast("int").alias("prediction"))).first()["weighted_f1"]
    same = both.where(~F.col("prediction").eqNullSafe(F.col("again"))).isEmpty()
    scores = {k: v for k, v in {"test_accuracy": acc, "test_f1": f1}.items() if v is not None}
    IO.log_run(test.sparkSession, runs, "Best_Model", name, {"path": path}, scores, {"same_after_reload": str(same)})
    return {"test_accuracy": acc, "test_f1": f1, "same_after_reload": same}
