"""Registered queries, part 6: learning whose right answer is known.

The classes follow from the segment of ``customer`` by a rule, the features hold the segment's indicators and two
columns that say nothing. A correct search, fit, prediction, importance or curve must recover the rule on every row, so SQL
can state the result: exact, not only its number of rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlab.operators import learn as L
from cohortlab.operators import quality as Q
from cohortlab.operators import relational as R
from cohortlab.operators import sampling as D
from cohortlab.operators.outliers import isolation_forest_to_median
from cohortlab.plans.queries import register
from cohortlab.plans.tables import table
from cohortlab.session import checkpointed, scratch_dir

# The segments of the test tables, one indicator each; the rule below names two of them.
SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
NAMES = [s.lower() for s in SEGMENTS] + ["balance", "nation"]
# Rows of seven features that one task of a fit holds at most.
FIT_ROWS = 50_000


def _flat(spark, d) -> DataFrame:
    """(c_custkey, label, one column per name): class 1 is BUILDING, class 2 MACHINERY, class 0 the rest."""
    c = table(spark, d, "customer")
    seg = F.col("c_mktsegment")
    return c.select("c_custkey", F.when(seg == "BUILDING", 1).when(seg == "MACHINERY", 2).otherwise(0).alias("label"),
                    *[(seg == s).cast("double").alias(s.lower()) for s in SEGMENTS],
                    (F.col("c_acctbal") / 10_000).cast("double").alias("balance"), (F.col("c_nationkey") / 25).cast("double").alias("nation"))


def _rows(spark, d) -> DataFrame:
    return L.assemble(_flat(spark, d), NAMES).select("c_custkey", "label", "features")


def _folded(spark, d, folds: int) -> DataFrame:
    return checkpointed(D.stratified_folds(_rows(spark, d), "label", "c_custkey", folds, 42))


def _grid_sql(grid: dict, metric: str) -> str:
    """SQL for all points of a grid, each with a perfect metric."""
    def cell(v) -> str:
        return "NULL" if v is None else f"'{v}'" if isinstance(v, str) else f"CAST({v} AS DOUBLE)" if isinstance(v, float) else str(v)
    axes = [f"(SELECT unnest([{', '.join(cell(float(v) if k == 'C' else v) for v in vs)}]) AS {k})" for k, vs in grid.items()]
    return f"SELECT {', '.join(grid)}, CAST(1.0 AS DOUBLE) AS {metric} FROM {' CROSS JOIN '.join(axes)}"


def _points(spark, scores, grid: dict, metric: str) -> DataFrame:
    kinds = {str: "string", float: "double", int: "int"}
    of = lambda k, vs: "double" if k == "C" else kinds[next(type(v) for v in vs if v is not None)]
    schema = ", ".join(f"{k} {of(k, vs)}" for k, vs in grid.items()) + f", {metric} double"
    return spark.createDataFrame([(*[float(v) if k == "C" else v for k, v in p.items()], round(m, 9)) for p, m in scores], schema)


@register("rule_logistic_grid", _grid_sql(L.LR_GRID, "cv_accuracy"))
def q_l5(spark, d):
    """L1 + L5 + D6: every point of the logistic grid recovers the rule in 3-fold cross-validation."""
    return _points(spark, L.grid_scores(_folded(spark, d, 3), "logistic_regression", L.LR_GRID, fold_col="fold")[1], L.LR_GRID, "cv_accuracy")


@register("rule_fixed_classifiers", """
SELECT model, (SELECT count(*) FROM customer) AS n_rows, (SELECT count(*) FROM customer) AS n_right
FROM (SELECT unnest(['logistic_regression', 'random_forest', 'svm', 'xgboost']) AS model)""")
def q_l6(spark, d):
    """L6 + L11 + S6: the four kinds with fixed parameters (few rounds: the rule needs no more) are fitted on the training part, saved, loaded and predict all rows."""
    rows = _rows(spark, d)
    train = checkpointed(L.spread(D.train_test(rows, "c_custkey", 0.2, seed=42).where("split = 'train'"), rows=FIT_ROWS))
    n, out = train.count(), []
    for kind, params in {"logistic_regression": {}, "random_forest": {"n_estimators": 100, "max_depth": None}, "svm": {"maxIter": 10}, "xgboost": {"n_estimators": 5}}.items():
        path = scratch_dir(spark, f"rule_{kind}")
        L.save_model(L.fit_pipeline([L.estimator(kind, n, **params)], train), path)
        hit = (F.col("prediction") == F.col("label")).cast("long")
        out.append(L.predict(L.load_pipeline(path), rows).agg(F.count(F.lit(1)).alias("n_rows"), F.sum(hit).alias("n_right")).select(F.lit(kind).alias("model"), "*"))
    return reduce(DataFrame.unionByName, out)


@register("rule_feature_importance", """
SELECT unnest(['building', 'machinery']) AS feature, 2 AS n_leading, 7 AS n_features, CAST(1.0 AS DOUBLE) AS total""")
def q_l8(spark, d):
    """The two indicators that the rule names lead the importances, which add up to one."""
    model = L.estimator("random_forest", n_estimators=100, max_depth=10).fit(checkpointed(L.spread(_rows(spark, d), rows=FIT_ROWS)))
    each = L.feature_importance(model, NAMES, len(NAMES), spark)
    total = each.agg(F.round(F.sum("importance"), 6).alias("total"), F.count(F.lit(1)).cast("int").alias("n_features")).first()
    lead = R.top_k(each, "importance", 2, ["feature"])
    return lead.select("feature", F.lit(2).alias("n_leading"), F.lit(total["n_features"]).alias("n_features"), F.lit(total["total"]).alias("total"))


@register("rule_permutation_importance", """
SELECT feature, feature IN ('building', 'machinery') AS matters, feature IN ('balance', 'nation') AS says_nothing
FROM (SELECT unnest(['building', 'machinery', 'balance', 'nation']) AS feature)""")
def q_l9(spark, d):
    """Shuffling an indicator of the rule costs accuracy, shuffling a column that says nothing costs none."""
    flat = checkpointed(L.spread(_flat(spark, d), rows=FIT_ROWS))
    model = L.estimator("logistic_regression", flat.count()).fit(L.assemble(flat, NAMES))
    got = L.permutation_importance(model, flat, NAMES)
    return got.where(F.col("feature").isin("building", "machinery", "balance", "nation")).select(
        "feature", (F.col("importance") > 0.1).alias("matters"), (F.col("importance") == 0).alias("says_nothing"))


@register("rule_sensitivity_curve", """
SELECT 'n_estimators' AS param, CAST(value AS DOUBLE) AS value, CAST(1.0 AS DOUBLE) AS f1 FROM (SELECT unnest([10, 50, 100, 150, 200]) AS value)""")
def q_l10(spark, d):
    """Weighted F1 on the test part for forests of each size."""
    s = checkpointed(L.spread(D.train_test(_rows(spark, d), "c_custkey", 0.2, seed=42), rows=FIT_ROWS))
    return L.sensitivity_curve(s.where("split = 'train'"), s.where("split = 'test'")).withColumn("f1", F.round("f1", 9))


@register("rule_best_model", "SELECT CAST(1.0 AS DOUBLE) AS validation_accuracy, CAST(1.0 AS DOUBLE) AS test_accuracy, CAST(1.0 AS DOUBLE) AS test_f1, TRUE AS same_after_reload")
def q_v13(spark, d):
    """L1 + V13: the refitted best of a grid is tried on validation rows, then scored on test rows, saved, loaded and compared."""
    s = checkpointed(D.train_val_test(_rows(spark, d), "c_custkey", seed=42))
    train = checkpointed(D.stratified_folds(s.where("split = 'train'"), "label", "c_custkey", 3, 42))
    model, _, _ = L.grid_search(train, "logistic_regression", L.LR_GRID, fold_col="fold")
    seen = MulticlassClassificationEvaluator(metricName="accuracy").evaluate(L.predict(model, s.where("split = 'val'")))
    kept = L.keep_best(model, "logistic_regression", s.where("split = 'test'").select("c_custkey", "label", "features"),
                       scratch_dir(spark, "rule_best"), scratch_dir(spark, "rule_runs"))
    return spark.createDataFrame([(float(seen), float(kept["test_accuracy"]), float(kept["test_f1"]), kept["same_after_reload"])],
                                 "validation_accuracy double, test_accuracy double, test_f1 double, same_after_reload boolean")


@register("isolation_forest_invariants", """
SELECT 'l_extendedprice' AS name, count(*) AS n_rows, 0 AS n_other, TRUE AS at_most_a_tenth, TRUE AS extremes_gone,
  round(quantile_cont(CAST(l_extendedprice AS DOUBLE), 0.5), 6) AS median FROM lineitem""")
def q_x3(spark, d):
    """X3 on a column of many values: a value stays or becomes the exact median; at most a tenth change, the two extremes among them."""
    c = "l_extendedprice"
    li = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.col(c), F.col(c).alias("was"))
    new = checkpointed(isolation_forest_to_median(li, [c], 0.1))
    change = F.col(c) != F.col("was")
    one = new.agg(F.max(F.when(change, F.col(c))).alias("m"), F.min("was").alias("lo"), F.max("was").alias("hi")).first()
    m, ends = F.lit(one["m"]), [one["lo"], one["hi"]]
    return new.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(change & (F.col(c) != m)).cast("int").alias("n_other"),
                    (F.count_if(change) <= F.count(F.lit(1)) * 0.1).alias("at_most_a_tenth"),
                    (F.count_if(F.col("was").isin(ends) & ~change) == 0).alias("extremes_gone"),
                    F.round(m, 6).alias("median")).select(F.lit(c).alias("name"), "*")


@register("column_sets_checked", """
SELECT 'same names' AS tables, count(*) AS n_rows, FALSE AS refused FROM orders
UNION ALL SELECT 'one name less', NULL, TRUE UNION ALL SELECT 'no table', NULL, TRUE""")
def q_u2(spark, d):
    """U2 + Q2: tables of equal column names, in any order, are stacked; others, and a missing one, are refused by name."""
    o = table(spark, d, "orders")
    old, new = o.where("o_orderstatus = 'F'"), o.where("o_orderstatus <> 'F'").select(*reversed(o.columns))
    out = []
    for name, a, b in [("same names", old, new), ("one name less", old, new.drop("o_totalprice")), ("no table", old, None)]:
        try:
            Q.require(before=a, after=b)
            R.assert_same_columns(a, b)
        except ValueError:
            out.append(spark.range(1).select(F.lit(name).alias("tables"), F.lit(None).cast("long").alias("n_rows"), F.lit(True).alias("refused")))
        else:
            out.append(R.stack_by_name([a, b]).agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("tables"), "n_rows", F.lit(False).alias("refused")))
    return reduce(DataFrame.unionByName, out)
