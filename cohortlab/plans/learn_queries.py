"""Registered queries, part 5: sources/sinks, learning, scoring (mostly
rows-only checks: model fits and I/O round trips have no SQL oracle, except
where the round trip must give the table back unchanged)."""

from __future__ import annotations

from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.sql import functions as F

from cohortlab.operators import learn as L
from cohortlab.operators import sampling as D
from cohortlab.operators.encode import LinearDiscriminant
from cohortlab.operators.outliers import isolation_forest_to_median
from cohortlab.plans.queries import _cohort_sql, cohort_rows, register, r6
from cohortlab.session import checkpointed, scratch_dir
from cohortlab.sources import io as IO
from cohortlab.streaming import scoring as ST
from cohortlab.plans.tables import table

ORDERS_DDL = ("o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string")


@register("csv_round_trip", "SELECT * FROM orders")
def q_s1(spark, d):
    """S4 + S1: write CSV without index, read back with an explicit schema."""
    path = scratch_dir(spark, "csv_orders")
    IO.write_csv(table(spark, d, "orders"), path)
    return IO.read_csv(spark, path, ORDERS_DDL)


@register("csv_missing_marks", """
SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 3 THEN o_totalprice END AS price,
       CASE WHEN o_orderkey % 4 IN (1, 3) THEN o_orderpriority END AS priority FROM orders""")
def q_s1_missing(spark, d):
    """Markers of missing values, in number and text columns, come back as null."""
    path, kind = scratch_dir(spark, "csv_marks"), F.col("o_orderkey") % 4
    mark = F.when(kind == 0, "NA").when(kind == 1, "NaN").when(kind == 2, "")
    IO.write_csv(table(spark, d, "orders").select(
        "o_orderkey", F.coalesce(mark, F.col("o_totalprice").cast("string")).alias("price"),
        F.when(kind == 0, "null").when(kind == 2, "N/A").otherwise(F.col("o_orderpriority")).alias("priority")), path)
    return IO.read_csv(spark, path)


@register("csv_directory", """
SELECT 'customer' AS name, count(*) AS n_rows FROM customer UNION ALL
SELECT 'nation', count(*) FROM nation UNION ALL SELECT 'region', count(*) FROM region""")
def q_s2(spark, d):
    """Every CSV file of a folder becomes its own table (name order)."""
    base = scratch_dir(spark, "csv_dir")
    for t in ["region", "nation", "customer"]:
        IO.write_csv(table(spark, d, t), f"{base}/{t}.csv")
    tables = IO.read_csv_dir(spark, base)
    out = None
    for name, df in tables.items():
        one = df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("name"), "n_rows")
        out = one if out is None else out.unionByName(one)
    return out


@register("json_round_trip", "SELECT * FROM orders")
def q_s3(spark, d):
    """S3: record JSON written and read back with a schema."""
    path = scratch_dir(spark, "json_orders")
    table(spark, d, "orders").write.mode("overwrite").json(path)
    return IO.read_json(spark, path, ORDERS_DDL)


@register("parquet_hand_off", _cohort_sql())
def q_s5(spark, d):
    """The feature table handed to the next stage as Parquet."""
    path = scratch_dir(spark, "hand_off")
    IO.write_table(cohort_rows(spark, d), path)
    return spark.read.parquet(path)


def _embeddings(spark, d):
    e = table(spark, d, "embeddings")
    return L.with_vector(e, "embedding").select("vec_id", "label", "embedding", "features")


def _split(spark, d):
    # Iterative fits read the rows many times: kept in tasks of a bounded number of rows.
    s = L.spread(D.train_test(_embeddings(spark, d), "vec_id", 0.2, seed=42)).cache()
    return s.where(F.col("split") == "train"), s.where(F.col("split") == "test")


@register("fixed_param_classifiers")
def q_l6(spark, d):
    """L6 + L11 + V11: the four classifiers with fixed parameters, test accuracy
    per model; fitted models saved and re-loaded (S6), run logged (S7)."""
    train, test = _split(spark, d)
    ev = MulticlassClassificationEvaluator(metricName="accuracy")
    rows = []
    runs = scratch_dir(spark, "runs")
    for name, kind, params in [("Logistic Regression", "logistic_regression", {}),
                               ("Random Forest", "random_forest", {"n_estimators": 100, "max_depth": 10}),
                               ("SVM", "svm", {}), ("XGBoost", "xgboost", {"n_estimators": 20})]:
        model = L.fit_pipeline([L.estimator(kind, train.count(), **params)], train)
        path = scratch_dir(spark, f"model_{kind}")
        L.save_model(model, path)
        model = L.load_pipeline(path)
        acc = ev.evaluate(L.predict(model, test))
        IO.log_run(spark, runs, "Model_Training", name, params, {"test_accuracy": acc})
        rows.append((name, acc))
    return spark.createDataFrame(rows, "model string, accuracy double")


@register("tune_logistic_cv")
def q_l1(spark, d):
    """L1 + L5 + D6: 3-fold grid search (stratified folds), best refit, validation accuracy."""
    e = _embeddings(spark, d)
    s = D.train_val_test(e, "vec_id", seed=42).cache()
    train = D.stratified_folds(s.where(F.col("split") == "train"), "label", "vec_id", 3, 42)
    model, best, metrics = L.grid_search(train, "logistic_regression", L.LR_GRID, folds=3, fold_col="fold")
    val = s.where(F.col("split") == "val")
    acc = MulticlassClassificationEvaluator(metricName="accuracy").evaluate(model.transform(val))
    return spark.createDataFrame([("Logistic Regression", str(best), float(max(metrics)), acc)],
                                 "model string, best_params string, cv_accuracy double, validation_accuracy double")


def _three_classes(spark, d):
    """Training rows in three classes, with stratified folds."""
    e = _embeddings(spark, d).withColumn("label", (F.col("label") % 3).cast("int"))
    train = D.train_test(e, "vec_id", 0.2, seed=42).where(F.col("split") == "train")
    return checkpointed(D.stratified_folds(train, "label", "vec_id", 3, 42))


@register("svm_grid")
def q_l2(spark, d):
    """L2 + L1: cross-validated accuracy of every point of the SVM grid, linear and rbf; gamma changes nothing for a line."""
    _, scores = L.grid_scores(_three_classes(spark, d), "svm", L.SVM_GRID, folds=3, fold_col="fold", parallelism=8)
    return spark.createDataFrame([(p["C"] * 1.0, p["kernel"], p["gamma"], m) for p, m in scores],
                                 "C double, kernel string, gamma string, cv_accuracy double")


@register("saved_model_round_trip", """
SELECT (SELECT count(*) FROM embeddings) AS n_rows, (SELECT count(*) FROM embeddings) AS n_equal, 2 AS n_params, 1 AS n_metrics, 1 AS n_texts,
  0.5 AS cut, CAST((SELECT count(*) FROM embeddings) AS DOUBLE) AS logged_rows, 'reloaded' AS note""")
def q_s6(spark, d):
    """S6 + S7: every row is predicted alike by the fitted model and by the one that was saved and loaded again; the run
    that says so is logged and read back."""
    e = _embeddings(spark, d)
    model = L.fit_pipeline([L.estimator("logistic_regression", e.count(), maxIter=20)], e)
    path, runs = scratch_dir(spark, "model"), scratch_dir(spark, "runs")
    L.save_model(model, path)
    both = L.predict(model, e).select("vec_id", F.col("prediction").alias("p")).join(
        L.predict(L.load_pipeline(path), e).select("vec_id", F.col("prediction").alias("q")), "vec_id")
    r = both.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("p") == F.col("q")).alias("same")).first()
    IO.log_run(spark, runs, "Reload", "logistic", {"cut": 0.5, "kind": "logistic"}, {"rows": r["n"]}, {"note": "reloaded"})
    log = IO.read_runs(spark, runs)
    kind = lambda k: F.count_if(F.col("kind") == k).cast("int").alias(f"n_{k}s")
    one = lambda k: F.max(F.when(F.col("key") == k, F.col("value")))
    return log.agg(kind("param"), kind("metric"), kind("text"), one("cut").cast("double").cast("decimal(2,1)").alias("cut"),
                   one("rows").cast("double").alias("logged_rows"), one("note").alias("note")).select(
        F.lit(r["n"]).cast("long").alias("n_rows"), F.lit(r["same"]).cast("long").alias("n_equal"), "*")


@register("best_model_kept")
def q_v13_kept(spark, d):
    """Candidates are ranked on the validation rows by accuracy and fairness; the winner alone is scored on the
    test rows, saved, loaded again and logged. One row: its name, scores, and whether the saved model answers alike."""
    e = _embeddings(spark, d).withColumn("side", (F.col("embedding")[0] > 0).cast("int"))
    s = checkpointed(L.spread(D.train_val_test(e, "vec_id", seed=42)))
    part = lambda name: s.where(F.col("split") == name)
    n = part("train").count()
    kinds = {"Logistic Regression": {"kind": "logistic_regression", "maxIter": 50}, "Random Forest": {"kind": "random_forest", "n_estimators": 50, "max_depth": 10}}
    models = {name: L.fit_pipeline([L.estimator(n_rows=n, **p)], part("train")) for name, p in kinds.items()}
    best, ranked = L.select_best(models, part("val"), ["side"])
    kept = L.keep_best(models[best], best, part("test"), scratch_dir(spark, "best_model"), scratch_dir(spark, "runs"))
    top = ranked.where(F.col("model") == best).select("model", "accuracy", "score", "model_type")
    return top.select("*", F.lit(kept["test_accuracy"]).alias("test_accuracy"), F.lit(kept["test_f1"]).alias("test_f1"),
                      F.lit(kept["same_after_reload"]).alias("same_after_reload"))


@register("feature_importance_top10")
def q_l8(spark, d):
    """Forest importances, top 10 features."""
    train, _ = _split(spark, d)
    m = L.estimator("random_forest", n_estimators=100).fit(train)
    return L.feature_importance(m, [f"f{i}" for i in range(64)], 10, spark)


@register("sensitivity_curve")
def q_l10(spark, d):
    """Weighted F1 against the number of trees."""
    train, test = _split(spark, d)
    return L.sensitivity_curve(train, test)


@register("permutation_importance")
def q_l9(spark, d):
    """Accuracy drop on the test split per shuffled feature (re-aim of the SHAP summaries)."""
    train, test = _split(spark, d)
    cols = [f"f{i}" for i in range(64)]
    m = L.estimator("random_forest", n_estimators=100).fit(train)
    flat = test.select("label", *[F.col("embedding")[i].cast("double").alias(c) for i, c in enumerate(cols)])
    return L.permutation_importance(m, flat, cols)


@register("score_comma_text")
def q_l12(spark, d):
    """L12 batch: comma text -> vector -> saved model -> prediction; bad rows rejected."""
    train, _ = _split(spark, d)
    model = L.fit_pipeline([L.estimator("logistic_regression", train.count())], train)
    e = table(spark, d, "embeddings")
    txt = F.when(F.col("vec_id") % 97 == 0, F.lit("1,2,3")).otherwise(
        F.concat_ws(",", F.transform("embedding", lambda x: x.cast("double").cast("string"))))
    scored, rejected = ST.score(model, e.withColumn("text", txt), "text", 64, keep=["vec_id"])
    return scored.unionByName(rejected.select("vec_id", F.lit(-1).alias("prediction")))


@register("stream_scoring")
def q_l12_stream(spark, d):
    """L12 stream: the same transform on a Structured Streaming source."""
    train, _ = _split(spark, d)
    model = L.fit_pipeline([L.estimator("logistic_regression", train.count())], train)
    src = scratch_dir(spark, "stream_in")
    e = table(spark, d, "embeddings").select(
        "vec_id", F.concat_ws(",", F.transform("embedding", lambda x: x.cast("double").cast("string"))).alias("text"))
    e.write.mode("overwrite").parquet(src)
    out, rejects = scratch_dir(spark, "stream_out"), scratch_dir(spark, "stream_rejects")
    q = ST.score_stream(spark, model, src, e.schema, F.col("text"), 64, out, rejects,
                        scratch_dir(spark, "stream_ckpt"), keep=["vec_id"])
    q.processAllAvailable()
    q.stop()
    return (spark.read.parquet(out).select("vec_id", "prediction")
            .unionByName(spark.read.parquet(rejects).select("vec_id", F.lit(-1).alias("prediction"))))


@register("scored_rows", "SELECT vec_id, vec_id % 97 = 0 AS rejected, CASE WHEN vec_id % 97 = 0 THEN 'expected 64 numbers, got 3' END AS reason FROM embeddings")
def q_l12_rows(spark, d):
    """Which rows are scored and which rejected, and why."""
    train = _embeddings(spark, d)
    model = L.fit_pipeline([L.estimator("logistic_regression", train.count(), maxIter=5)], train)
    txt = F.when(F.col("vec_id") % 97 == 0, F.lit("1,2,3")).otherwise(F.concat_ws(",", F.transform("embedding", lambda x: x.cast("double").cast("string"))))
    scored, rejected = ST.score(model, table(spark, d, "embeddings").withColumn("text", txt), "text", 64, keep=["vec_id"])
    return scored.select("vec_id", F.lit(False).alias("rejected"), F.lit(None).cast("string").alias("reason")).unionByName(
        rejected.select("vec_id", F.lit(True).alias("rejected"), "reason"))


@register("stream_equals_batch", "SELECT vec_id, TRUE AS same FROM embeddings")
def q_l12_same(spark, d):
    """A stream scores every row as the batch does."""
    train = _embeddings(spark, d)
    model = L.fit_pipeline([L.estimator("logistic_regression", train.count(), maxIter=5)], train)
    e = table(spark, d, "embeddings").select("vec_id", F.concat_ws(",", F.transform("embedding", lambda x: x.cast("double").cast("string"))).alias("text"))
    src, out = scratch_dir(spark, "stream_in"), scratch_dir(spark, "stream_out")
    e.write.mode("overwrite").parquet(src)
    q = ST.score_stream(spark, model, src, e.schema, F.col("text"), 64, out, scratch_dir(spark, "stream_rejects"), scratch_dir(spark, "stream_ckpt"), keep=["vec_id"])
    q.processAllAvailable()
    q.stop()
    batch = ST.score(model, e, "text", 64, keep=["vec_id"])[0].withColumnRenamed("prediction", "want")
    got = spark.read.parquet(out).select("vec_id", "prediction")
    return batch.join(got, "vec_id", "full").select("vec_id", F.col("prediction").eqNullSafe(F.col("want")).alias("same"))


@register("forest_grid")
def q_l3(spark, d):
    """L3 + L1: cross-validated accuracy of every point of the forest grid; points that differ in the split minimum only fit the same."""
    _, scores = L.grid_scores(_three_classes(spark, d), "random_forest", L.RF_GRID, folds=3, fold_col="fold", parallelism=8)
    return spark.createDataFrame([(p["n_estimators"], p["max_depth"], p["min_samples_split"], p["min_samples_leaf"], m) for p, m in scores],
                                 "n_estimators int, max_depth int, min_samples_split int, min_samples_leaf int, cv_accuracy double")


@register("lda_projection")
def q_e8(spark, d):
    """Fisher discriminant projection of the 64-d embeddings (9 components)."""
    e = table(spark, d, "embeddings")
    cols = [f"f{i}" for i in range(64)]
    flat = e.select("vec_id", "label", *[F.col("embedding")[i].cast("double").alias(c) for i, c in enumerate(cols)])
    lda = LinearDiscriminant(cols, "label").fit(flat)
    return lda.transform(flat).select("vec_id", "label", *[f"ld{j + 1}" for j in range(lda.scalings.shape[1])])


@register("isolation_forest_outliers")
def q_x3(spark, d):
    """Isolation-forest scores per column, top 10 % replaced by the median."""
    cols = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    li = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", *cols)
    return isolation_forest_to_median(li, cols, 0.1)
