"""Evaluation, fairness and ranking, inventory IDs V1-V13.

Inputs are prediction tables with the label and the prediction in the row
(``label``, ``prediction``) and optionally a ``model`` column; every metric
is a group-by over that table, so all models are scored in one pass.
"""

from __future__ import annotations

from functools import reduce
from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlab.functions.scalars import model_type
from cohortlab.operators.relational import cumulative_sums
from cohortlab.session import checkpointed


def accuracy(pred: DataFrame, by: Sequence[str] = (), label="label", prediction="prediction") -> DataFrame:
    """``avg(prediction == label)`` per ``by`` group."""
    hit = (F.col(prediction) == F.col(label)).cast("double")
    return pred.groupBy(*by).agg(F.avg(hit).alias("accuracy"))


def confusion(pred: DataFrame, by: Sequence[str] = (), label="label", prediction="prediction") -> DataFrame:
    """V2: ``(label, prediction, count)`` completed with zeros over the classes seen."""
    counts = pred.groupBy(*by, label, prediction).agg(F.count(F.lit(1)).alias("count"))
    classes = (pred.select(*by, F.col(label).alias("c")).union(pred.select(*by, F.col(prediction).alias("c")))
                   .distinct())
    grid = classes.groupBy(*by).agg(F.array_sort(F.collect_set("c")).alias("cs"))  # bounded: classes
    grid = grid.select(*by, F.explode("cs").alias(label), F.col("cs")).select(
        *by, label, F.explode("cs").alias(prediction))
    return (grid.join(counts, [*by, label, prediction], "left")
                .select(*by, label, prediction, F.coalesce("count", F.lit(0)).cast("long").alias("count")))


def per_class(pred: DataFrame, by: Sequence[str] = (), label="label", prediction="prediction") -> DataFrame:
    """V3 rows: ``(class, precision, recall, f1, support)``; zero division gives 0."""
    by = list(by)
    lab = pred.groupBy(*by, F.col(label).alias("class")).agg(
        F.count(F.lit(1)).alias("support"),
        F.sum((F.col(label) == F.col(prediction)).cast("long")).alias("tp"))
    prd = pred.groupBy(*by, F.col(prediction).alias("class")).agg(F.count(F.lit(1)).alias("predicted"))
    j = lab.join(prd, [*by, "class"], "full").fillna(0, ["support", "tp", "predicted"])
    p = F.when(F.col("predicted") > 0, F.col("tp") / F.col("predicted")).otherwise(F.lit(0.0))
    r = F.when(F.col("support") > 0, F.col("tp") / F.col("support")).otherwise(F.lit(0.0))
    f1 = F.when(p + r > 0, 2 * p * r / (p + r)).otherwise(F.lit(0.0))
    return j.select(*by, "class", p.alias("precision"), r.alias("recall"), f1.alias("f1"),
                    F.col("support").cast("long").alias("support"))


def classification_report(pred: DataFrame, by: Sequence[str] = (), label="label",
                          prediction="prediction") -> DataFrame:
    """V3: per-class rows plus ``accuracy``, ``macro avg``, ``weighted avg`` rows."""
    by = list(by)
    pc = per_class(pred, by, label, prediction).withColumn("class", F.col("class").cast("string"))
    macro = pc.groupBy(*by).agg(F.avg("precision").alias("precision"), F.avg("recall").alias("recall"),
                                F.avg("f1").alias("f1"), F.sum("support").alias("support"))
    wavg = lambda c: F.sum(F.col(c) * F.col("support")) / F.sum("support")
    weighted = pc.groupBy(*by).agg(wavg("precision").alias("precision"), wavg("recall").alias("recall"),
                                   wavg("f1").alias("f1"), F.sum("support").alias("support"))
    acc = pred.groupBy(*by).agg(F.avg((F.col(label) == F.col(prediction)).cast("double")).alias("a"),
                                F.count(F.lit(1)).alias("support"))
    acc = acc.select(*by, F.lit("accuracy").alias("class"), F.lit(None).cast("double").alias("precision"),
                     F.lit(None).cast("double").alias("recall"), F.col("a").alias("f1"),
                     F.col("support").cast("long").alias("support"))
    return (pc.unionByName(acc)
              .unionByName(macro.select(*by, F.lit("macro avg").alias("class"), "precision", "recall", "f1",
                                        F.col("support").cast("long").alias("support")))
              .unionByName(weighted.select(*by, F.lit("weighted avg").alias("class"), "precision", "recall",
                                           "f1", F.col("support").cast("long").alias("support"))))


def weighted_f1(pred: DataFrame, by: Sequence[str] = (), label="label", prediction="prediction") -> DataFrame:
    """V4: support-weighted mean of per-class F1."""
    pc = per_class(pred, by, label, prediction)
    return pc.groupBy(*by).agg((F.sum(F.col("f1") * F.col("support")) / F.sum("support")).alias("weighted_f1"))


def roc_points(scores: DataFrame, by: Sequence[str] = ("class",), label_is_pos="is_pos",
               score="score") -> tuple[DataFrame, DataFrame]:
    """V5 / V6: one-vs-rest ROC per ``by`` group from ``(..., is_pos, score)``.

    Rows with equal score are grouped first (so the AUC equals the rank
    statistic), then distributed running sums in descending score order.
    Returns ``(curve, auc)``: curve ``(*by, threshold, fpr, tpr)``, which starts
    at (0, 0) with an infinite threshold; auc
    ``(*by, auc)`` from the trapezoid rule, each step computed from its own
    row (no lag window). A group without positive or without negative rows
    has a null rate there and a null auc.
    """
    by = list(by)
    g = scores.groupBy(*by, F.col(score).alias("threshold")).agg(
        F.sum(F.col(label_is_pos).cast("long")).alias("pos"),
        F.sum((~F.col(label_is_pos)).cast("long")).alias("neg"))
    # A struct, not joined text: nulls and separators in the values keep groups apart.
    g = g.withColumn("__key", F.struct(*by) if by else F.struct(F.lit(0))).withColumn("__neg_thr", -F.col("threshold"))
    tot = g.groupBy("__key").agg(F.sum("pos").alias("P"), F.sum("neg").alias("N"))
    cum = cumulative_sums(g, "__key", ["__neg_thr"], ["pos", "neg"])
    cum = cum.join(tot.withColumnRenamed("__key", "__of"), F.col("__key").eqNullSafe(F.col("__of")))
    curve = cum.select(*by, "threshold",
                       F.try_divide("cum_neg", "N").alias("fpr"),
                       F.try_divide("cum_pos", "P").alias("tpr"))
    start = g.select(*by).distinct().select(*by, F.lit(float("inf")).alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"))
    curve = start.unionByName(curve)
    step = F.try_divide("neg", "N") * F.try_divide(F.col("cum_pos") - F.col("pos") / 2.0, F.col("P"))
    auc = cum.groupBy(*by).agg(F.sum(step).alias("auc"))
    return curve, auc


def group_rates(pred: DataFrame, positive, group: str, by: Sequence[str] = (), label="label",
                prediction="prediction") -> DataFrame:
    """Per sensitive group: selection rate, TPR, FPR (empty denominators -> 0) and accuracy."""
    yp = (F.col(prediction) == F.lit(positive)) if not isinstance(positive, F.Column) else (F.col(prediction) == positive)
    yt = (F.col(label) == F.lit(positive)) if not isinstance(positive, F.Column) else (F.col(label) == positive)
    a = pred.groupBy(*by, F.col(group).alias("group")).agg(
        F.avg(yp.cast("double")).alias("selection_rate"),
        F.sum((yp & yt).cast("long")).alias("tp"), F.sum(yt.cast("long")).alias("p"),
        F.sum((yp & ~yt).cast("long")).alias("fp"), F.sum((~yt).cast("long")).alias("n"),
        F.avg((yp == yt).cast("double")).alias("accuracy"))
    return a.select("*", F.when(F.col("p") > 0, F.col("tp") / F.col("p")).otherwise(F.lit(0.0)).alias("tpr"),
                    F.when(F.col("n") > 0, F.col("fp") / F.col("n")).otherwise(F.lit(0.0)).alias("fpr"))


def contingency(pred: DataFrame, sensitive: Sequence[str], by: Sequence[str] = ("model",), label="label",
                prediction="prediction") -> DataFrame:
    """Rows per (by, label, prediction, sensitive values), in column ``cell``: the
    one scan of the predictions that fairness and accuracy are made from. Written once."""
    return checkpointed(pred.groupBy(*dict.fromkeys([*by, label, prediction, *sensitive])).agg(F.count(F.lit(1)).alias("cell")))


def _fairness(cells: DataFrame, sensitive: Sequence[str], by: Sequence[str], label: str, prediction: str) -> DataFrame:
    """V7 + V8 + V9 from a contingency table."""
    by = list(by)
    groups = F.inline(F.array(*[F.struct(F.lit(s).alias("feature"), F.col(s).cast("string").alias("group")) for s in sensitive]))
    # A cell counts for the class of its label and for the class of its prediction.
    hit = F.coalesce(F.col(label) == F.col(prediction), F.lit(False))
    as_label = F.struct(F.col(label).alias("class"), F.col("cell").alias("support"),
                        F.lit(0).cast("long").alias("predicted"), F.when(hit, F.col("cell")).otherwise(0).alias("tp"))
    as_prediction = F.struct(F.col(prediction).alias("class"), F.lit(0).cast("long").alias("support"),
                             F.col("cell").alias("predicted"), F.lit(0).cast("long").alias("tp"))
    small = cells.select(*by, label, prediction, "cell", groups).groupBy(*by, "feature", "group", label, prediction).agg(
        F.sum("cell").alias("cell"))
    margins = (small.select(*by, "feature", "group", F.inline(F.array(as_label, as_prediction)))
               .groupBy(*by, "feature", "group", "class").agg(*[F.sum(c).alias(c) for c in ("support", "predicted", "tp")]))
    # Every group gets every class of the labels; one absent from a group has zeros there.
    classes = cells.agg(F.collect_set(label).alias("classes"))
    grid = (small.groupBy(*by, "feature", "group").agg(F.sum("cell").alias("n_rows"))
            .withColumn("class", F.explode(classes.scalar())))
    same = reduce(lambda x, y: x & y, [grid[c].eqNullSafe(margins[c]) for c in [*by, "feature", "group", "class"]])
    full = grid.join(margins, same, "left").select(
        *[grid[c] for c in [*by, "feature", "group", "class", "n_rows"]],
        *[F.coalesce(margins[c], F.lit(0)).alias(c) for c in ("support", "predicted", "tp")])
    others = F.col("n_rows") - F.col("support")
    rates = full.select(
        *by, "class", "feature", (F.col("predicted") / F.col("n_rows")).alias("sr"),
        F.when(F.col("support") > 0, F.col("tp") / F.col("support")).otherwise(0.0).alias("tpr"),
        F.when(others > 0, (F.col("predicted") - F.col("tp")) / others).otherwise(0.0).alias("fpr"))
    return rates.groupBy(*by, "class", "feature").agg(
        (F.max("sr") - F.min("sr")).alias("dp_diff"),
        F.greatest(F.max("tpr") - F.min("tpr"), F.max("fpr") - F.min("fpr")).alias("eo_diff"))


def fairness_long(pred: DataFrame, classes_col: str, sensitive: Sequence[str], by: Sequence[str] = ("model",),
                  label="label", prediction="prediction") -> DataFrame:
    """V7 + V8 + V9 for every (model, class, sensitive feature), from one
    contingency table: ``(*by, class, feature, dp_diff, eo_diff)`` with
    ``dp_diff = max - min`` selection rate, ``eo_diff = max(TPR range, FPR range)``
    over the groups. Classes are those of the labels; null labels are no class.
    """
    return _fairness(contingency(pred, sensitive, by, label, prediction), sensitive, by, label, prediction)


def fairness_report(pred: DataFrame, sensitive: Sequence[str], binned: str | None = None,
                    label="label", prediction="prediction", cells: DataFrame | None = None) -> DataFrame:
    """Rows ``(model, class, slice, accuracy, dp_diff, eo_diff)``.

    As in the reference, ``accuracy`` is the model's overall accuracy (quirk
    9), and the binned feature yields one row per bin value carrying the
    feature-level metrics (quirk 11); ``slice_accuracy`` is the real
    per-slice accuracy. All of it comes from one contingency table (``cells``,
    if it is there already).
    """
    feats = list(sensitive) + ([binned] if binned else [])
    if cells is None:
        cells = contingency(pred, feats, ["model"], label, prediction)
    fl = _fairness(cells, feats, ["model"], label, prediction)
    base = fl.join(accuracy_of_cells(cells, ["model"], label, prediction), "model")
    plain = base.where(F.col("feature") != F.lit(binned or "")).withColumn("slice", F.col("feature")) \
                .withColumn("slice_accuracy", F.col("accuracy"))
    if not binned:
        return plain.drop("feature")
    bins = accuracy_of_cells(cells.withColumn("bin", F.col(binned).cast("string")), ["model", "bin"], label, prediction)
    b = (base.where(F.col("feature") == binned).join(bins.withColumnRenamed("accuracy", "slice_accuracy"), "model")
             .withColumn("slice", F.concat(F.lit("AGE_"), F.col("bin"))).drop("bin"))
    return plain.drop("feature").unionByName(b.drop("feature"))


def accuracy_of_cells(cells: DataFrame, by: Sequence[str], label="label", prediction="prediction") -> DataFrame:
    """V1 / V11 from a contingency table; rows without a label or a prediction are left out, as in ``accuracy``."""
    hit = F.col(label) == F.col(prediction)
    return cells.groupBy(*by).agg(F.try_divide(F.sum(F.when(hit, F.col("cell")).when(~hit, 0)),
                                               F.sum(F.when(hit.isNotNull(), F.col("cell")))).alias("accuracy"))


def rank_models(acc: DataFrame, fairness: DataFrame, weight: float = 0.7) -> DataFrame:
    """``score = accuracy - weight * mean(|dp| + |eo|)``; missing penalty 0;
    model type by name (F9), an unknown name raises; descending score, name as tie-break."""
    pen = fairness.groupBy("model").agg(F.avg(F.abs("dp_diff") + F.abs("eo_diff")).alias("penalty"))
    j = acc.join(pen, "model", "left").fillna(0.0, ["penalty"])
    return (j.select("model", "accuracy", "penalty",
                     (F.col("accuracy") - weight * F.col("penalty")).alias("score"),
                     F.coalesce(model_type(F.col("model")), F.raise_error(
                         F.concat(F.lit("no model type for the name "), F.coalesce("model", F.lit("null"))))).alias("model_type"))
              .orderBy(F.col("score").desc(), F.col("model")))


def best_model(ranked: DataFrame) -> DataFrame:
    """V13 selection: the top row (limit 1 is the feature here)."""
    return ranked.orderBy(F.col("score").desc(), F.col("model")).limit(1)
