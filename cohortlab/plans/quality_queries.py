"""Registered queries, part 4: data quality, drift, evaluation, fairness, ranking."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortlab.functions import scalars as S
from cohortlab.operators import evaluate as V
from cohortlab.operators import quality as Q
from cohortlab.plans.more_queries import LI_NUM, _rounded
from cohortlab.plans.queries import _cohort_sql, cohort_rows, register
from cohortlab.plans.tables import GAPPY_LINEITEM_SQL, gappy_lineitem, table

# ---------------------------------------------------------------- Q

_COHORT_COLS = ["c_custkey", "c_mktsegment", "age", "n_nationkey", "n_name", "n_regionkey", "first_visit",
                "visit_price", "click_value", "error_value", "purchase_value", "signup_value", "view_value"]


@register("validate_table", f"""
WITH c AS ({_cohort_sql()})
SELECT 'not_empty' AS check_name, count(*) > 0 AS passed, 'rows=' || count(*) || ' columns=13' AS detail FROM c
UNION ALL SELECT 'required_columns', FALSE, 'missing=[''NHY'']'
UNION ALL SELECT 'no_nulls', count(*) FILTER (WHERE {' OR '.join(f'{c} IS NULL' for c in _COHORT_COLS)}) = 0,
  CASE WHEN count(*) FILTER (WHERE {' OR '.join(f'{c} IS NULL' for c in _COHORT_COLS)}) = 0 THEN 'none'
  ELSE 'nulls found' END FROM c""")
def q_q1(spark, d):
    """Q1: not empty, required columns, no nulls: one aggregation, report table."""
    return Q.validate(cohort_rows(spark, d), required=["c_custkey", "age", "NHY"])


_PROF_COLS = [("qty", "double"), ("tax", "double"), ("status", "string"), ("flag", "string")]


def _profile_sql() -> str:
    parts = []
    for c, t in _PROF_COLS:
        num = t == "double"
        top = (f"(SELECT CAST({c} AS VARCHAR) FROM gappy WHERE {c} IS NOT NULL GROUP BY {c} "
               f"ORDER BY count(*) DESC, CAST({c} AS VARCHAR) LIMIT 1)")
        topn = (f"(SELECT count(*) FROM gappy WHERE {c} IS NOT NULL GROUP BY {c} "
                f"ORDER BY count(*) DESC, CAST({c} AS VARCHAR) LIMIT 1)")
        nums = (f"count({c}) AS count, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std, "
                f"round(min({c}), 6) AS min, round(quantile_cont({c}, 0.25), 6) AS p25, "
                f"round(quantile_cont({c}, 0.5), 6) AS p50, round(quantile_cont({c}, 0.75), 6) AS p75, "
                f"round(max({c}), 6) AS max, count(CASE WHEN {c} = 0 THEN 1 END) AS n_zero")
        if not num:
            nums = ("CAST(NULL AS BIGINT) AS count, CAST(NULL AS DOUBLE) AS mean, CAST(NULL AS DOUBLE) AS std, "
                    "CAST(NULL AS DOUBLE) AS min, CAST(NULL AS DOUBLE) AS p25, CAST(NULL AS DOUBLE) AS p50, "
                    "CAST(NULL AS DOUBLE) AS p75, CAST(NULL AS DOUBLE) AS max, CAST(NULL AS BIGINT) AS n_zero")
        lens = ("CAST(NULL AS INTEGER) AS min_len, CAST(NULL AS INTEGER) AS max_len, CAST(NULL AS DOUBLE) AS mean_len"
                if num else
                f"CAST(min(length({c})) AS INTEGER) AS min_len, CAST(max(length({c})) AS INTEGER) AS max_len, "
                f"round(avg(length({c})), 6) AS mean_len")
        parts.append(f"SELECT '{c}' AS column, '{t}' AS dtype, count(*) AS n_rows, count(*) - count({c}) AS n_null, "
                     f"round((count(*) - count({c})) / count(*), 6) AS null_share, count(DISTINCT {c}) AS n_unique, "
                     f"{top} AS top, {topn} AS top_count, {nums}, {lens} FROM gappy")
    return f"WITH {GAPPY_LINEITEM_SQL.strip()} " + " UNION ALL ".join(parts)


@register("profile_columns", _profile_sql())
def q_q3(spark, d):
    """Q3 + Q4: per-column profile (type, missing, distinct, top value,
    numeric summary, zeros, text lengths)."""
    g = gappy_lineitem(spark, d)
    p = Q.profile(g, [c for c, _ in _PROF_COLS])
    return _rounded(p, ["null_share", "mean", "std", "min", "p25", "p50", "p75", "max", "mean_len"])


_SCHEMA_COLS = [("qty", "double"), ("status", "string"), ("flag", "string"), ("line", "int")]


@register("infer_schema", f"WITH {GAPPY_LINEITEM_SQL.strip()} " + " UNION ALL ".join(
    f"SELECT '{c}' AS column, '{t}' AS dtype, round(count({c}) / count(*), 6) AS presence, "
    f"count(DISTINCT {c}) AS n_unique, "
    + (f"CASE WHEN count(DISTINCT {c}) <= 20 THEN list(DISTINCT {c} ORDER BY {c}) "
       f"FILTER (WHERE {c} IS NOT NULL) END AS domain" if t == "string" else "CAST(NULL AS VARCHAR[]) AS domain")
    + " FROM gappy" for c, t in _SCHEMA_COLS))
def q_q5(spark, d):
    """Q5: type, presence, distinct count and small string domains."""
    g = gappy_lineitem(spark, d).select(*[c for c, _ in _SCHEMA_COLS])
    return _rounded(Q.infer_schema(g, 20), ["presence"])


_DOMAINS = {"customer": ["c_name", "c_mktsegment"]}


@register("string_domains", " UNION ALL ".join(
    f"SELECT '{c}' AS column, {c} AS value, count(*) AS count FROM customer WHERE {c} IS NOT NULL GROUP BY {c}" for c in _DOMAINS["customer"]))
def q_q5_rows(spark, d):
    """Q5: every value of the text columns with its count, one row each."""
    return Q.domains(table(spark, d, "customer").select(*_DOMAINS["customer"]))


_CUT = "TIMESTAMP '1998-01-01'"


def _drift_frames(spark, d):
    li = table(spark, d, "lineitem")
    cut = F.lit("1998-01-01").cast("timestamp_ntz")
    return li.where(F.col("l_shipdate") < cut), li.where(F.col("l_shipdate") >= cut)


def _ks_cte() -> str:
    la = " UNION ALL ".join(f"SELECT '{c}' AS column, {c} AS value, 1 AS c1, 0 AS c2 FROM a WHERE {c} IS NOT NULL"
                            for c in LI_NUM)
    lb = " UNION ALL ".join(f"SELECT '{c}' AS column, {c} AS value, 0 AS c1, 1 AS c2 FROM b WHERE {c} IS NOT NULL"
                            for c in LI_NUM)
    return f"""a AS (SELECT * FROM lineitem WHERE l_shipdate < {_CUT}),
b AS (SELECT * FROM lineitem WHERE l_shipdate >= {_CUT}),
cnt AS (SELECT "column", value, sum(c1) AS c1, sum(c2) AS c2 FROM ({la} UNION ALL {lb}) GROUP BY 1, 2),
cum AS (SELECT "column", sum(c1) OVER (PARTITION BY "column" ORDER BY value) AS k1,
               sum(c2) OVER (PARTITION BY "column" ORDER BY value) AS k2,
               sum(c1) OVER (PARTITION BY "column") AS n1, sum(c2) OVER (PARTITION BY "column") AS n2 FROM cnt),
ks AS (SELECT "column", CAST(n1 AS BIGINT) AS n1, CAST(n2 AS BIGINT) AS n2, max(abs(k1 / n1 - k2 / n2)) AS ks_stat
       FROM cum GROUP BY 1, 2, 3),
lam AS (SELECT *, (sqrt(n1 * n2 / (n1 + n2)) + 0.12 + 0.11 / sqrt(n1 * n2 / (n1 + n2))) * ks_stat AS lam FROM ks),
kp AS (SELECT "column", n1, n2, ks_stat, CASE WHEN lam < 1e-3 THEN 1.0 ELSE least(1.0, greatest(0.0, 2 * (
  SELECT sum(CASE WHEN k % 2 = 1 THEN 1.0 ELSE -1.0 END * exp(-2.0 * k * k * lam * lam)) FROM range(1, 101) t(k)))) END
  AS p_value FROM lam)"""


@register("ks_drift", f"""WITH {_ks_cte()}
SELECT "column", n1, n2, round(ks_stat, 6) AS ks_stat, round(p_value, 6) AS p_value, p_value < 0.05 AS drift FROM kp""")
def q_q6(spark, d):
    """Q6: two-sample KS per numeric column (distributed running sums)."""
    a, b = _drift_frames(spark, d)
    return _rounded(Q.ks_drift(a, b, LI_NUM), ["ks_stat", "p_value"])


_CAT = ["l_returnflag", "l_linestatus"]


def _chi_cte(yates: bool, with_sides: bool = True) -> str:
    rows = " UNION ALL ".join(
        f"SELECT '{c}' AS column, {c} AS value, 1.0 AS o1, 0.0 AS o2 FROM a WHERE {c} IS NOT NULL UNION ALL "
        f"SELECT '{c}', {c}, 0.0, 1.0 FROM b WHERE {c} IS NOT NULL" for c in _CAT)
    y = "CASE WHEN k = 2 THEN 0.5 ELSE 0.0 END" if yates else "0.0"

    def term(o, e):
        dev = f"greatest(abs({o} - {e}) - least({y}, abs({o} - {e})), 0.0)"
        return f"CASE WHEN {e} > 0 THEN {dev} * {dev} / {e} ELSE 0.0 END"
    sides = (f"a AS (SELECT * FROM lineitem WHERE l_shipdate < {_CUT}),\n"
             f"b AS (SELECT * FROM lineitem WHERE l_shipdate >= {_CUT}),\n") if with_sides else ""
    return sides + f"""t AS (SELECT "column", value, sum(o1) AS o1, sum(o2) AS o2 FROM ({rows}) GROUP BY 1, 2),
tot AS (SELECT "column", sum(o1) AS r1, sum(o2) AS r2, count(*) AS k FROM t GROUP BY 1),
j AS (SELECT t.*, r1, r2, k, r1 * (o1 + o2) / (r1 + r2) AS e1, r2 * (o1 + o2) / (r1 + r2) AS e2
      FROM t JOIN tot USING ("column")),
chi AS (SELECT "column", k, sum({term('o1', 'e1')} + {term('o2', 'e2')}) AS statistic FROM j GROUP BY 1, 2)"""


@register("chi_square_drift", f"""WITH {_chi_cte(True)}
SELECT "column", k, round(statistic, 6) AS statistic, k - 1 AS dof FROM chi""")
def q_q7(spark, d):
    """Q7: chi-square statistic per text column on counts (Yates when dof = 1)."""
    a, b = _drift_frames(spark, d)
    return _rounded(Q.chi2_table(a, b, _CAT, "count"), ["statistic"])


@register("feature_drift_scores", f"""WITH {_ks_cte()}, {_chi_cte(False, with_sides=False)}
SELECT "column", 'numerical' AS kind, round(ks_stat, 6) AS score FROM kp
UNION ALL SELECT "column", 'categorical', round(sqrt(statistic / (SELECT count(*) FROM lineitem)), 6) FROM chi""")
def q_q9(spark, d):
    """Q9: numeric KS statistic, categorical Cramer's V."""
    a, b = _drift_frames(spark, d)
    return _rounded(Q.feature_drift_scores(a.select(*LI_NUM, *_CAT), b.select(*LI_NUM, *_CAT)), ["score"])


# Survival function of the chi-square distribution: one less the series of the lower incomplete gamma function.
_CHI_P = """chip AS (SELECT *, CASE WHEN statistic > 1000 THEN 0.0 WHEN statistic <= 0 THEN 1.0 ELSE greatest(0.0, 1 - (
  SELECT sum(exp(-statistic / 2 + (i + (k - 1) / 2.0) * ln(statistic / 2) - lgamma(i + (k - 1) / 2.0 + 1))) FROM range(0, 2000) t(i))) END
  AS p_value FROM chi)"""


@register("chi_square_test", f"""WITH {_chi_cte(True)}, {_CHI_P}
SELECT "column", k, round(statistic, 6) AS statistic, k - 1 AS dof, round(p_value, 6) AS p_value, p_value < 0.05 AS drift FROM chip""")
def q_q7_test(spark, d):
    """Q7: statistic, p-value and flag."""
    a, b = _drift_frames(spark, d)
    return _rounded(Q.chi2_drift(a, b, _CAT), ["statistic", "p_value"])


def _js_sql(value: str, marks: str) -> str:
    """Jensen-Shannon distance per column of rows (column, value, c1, c2)."""
    part = lambda x: f"CASE WHEN {x} > 0 THEN {x} * ln({x} / ((p + q) / 2)) ELSE 0.0 END"
    return f"""(SELECT "column", sqrt(greatest(sum(({part('p')} + {part('q')}) / 2), 0)) AS js FROM (
  SELECT "column", {value} AS v, sum(c1) / sum(sum(c1)) OVER (PARTITION BY "column") AS p, sum(c2) / sum(sum(c2)) OVER (PARTITION BY "column") AS q
  FROM ({marks}) GROUP BY 1, 2) GROUP BY 1)"""


def _marks_sql(cols) -> str:
    return " UNION ALL ".join(f"SELECT '{c}' AS column, {c} AS value, 1.0 AS c1, 0.0 AS c2 FROM a UNION ALL SELECT '{c}', {c}, 0.0, 1.0 FROM b" for c in cols)


_BINNED = f"""SELECT m.*, lo, hi FROM ({_marks_sql(LI_NUM)}) m JOIN (SELECT "column", min(value) AS lo, max(value) AS hi FROM ({_marks_sql(LI_NUM)}) GROUP BY 1) USING ("column")"""


@register("drift_distances", f"""WITH {_ks_cte()},
area AS (SELECT "column", sum(abs(k1 / n1 - k2 / n2) * (nxt - value)) AS w FROM (
  SELECT *, lead(value) OVER (PARTITION BY "column" ORDER BY value) AS nxt FROM (
    SELECT c.*, cnt.value FROM (SELECT "column", value, sum(c1) OVER w AS k1, sum(c2) OVER w AS k2, sum(c1) OVER (PARTITION BY "column") AS n1,
      sum(c2) OVER (PARTITION BY "column") AS n2 FROM cnt WINDOW w AS (PARTITION BY "column" ORDER BY value)) c JOIN cnt USING ("column", value)))
  GROUP BY 1),
sd AS ({' UNION ALL '.join(f"SELECT '{c}' AS column, stddev_pop({c}) AS sd FROM a" for c in LI_NUM)})
SELECT "column", 'numerical' AS kind, round(w, 6) AS wasserstein, round(w / greatest(sd, 0.001), 6) AS wasserstein_norm, round(js, 6) AS jensen_shannon
FROM area JOIN sd USING ("column") JOIN {_js_sql('CASE WHEN hi = lo THEN 0 ELSE least(floor((value - lo) / ((hi - lo) / 30)), 29) END', _BINNED)} USING ("column")
UNION ALL SELECT "column", 'categorical', NULL, NULL, round(js, 6) FROM {_js_sql('value', _marks_sql(_CAT))}""")
def q_q8_distances(spark, d):
    """Q8: Wasserstein and Jensen-Shannon distances per column."""
    a, b = _drift_frames(spark, d)
    return _rounded(Q.drift_distances(a, b, LI_NUM, _CAT), ["wasserstein", "wasserstein_norm", "jensen_shannon"])


_ASSOC_NUM, _ASSOC_CAT = ["qty", "disc", "tax"], ["flag", "status", "line"]


def _assoc_sql() -> str:
    parts = [f"SELECT '{a}' AS a, '{b}' AS b, 'pearson' AS kind, count(CASE WHEN {a} IS NOT NULL AND {b} IS NOT NULL THEN 1 END) AS n, "
             f"corr({a}, {b}) AS value FROM gappy" for i, a in enumerate(_ASSOC_NUM) for b in _ASSOC_NUM[i + 1:]]
    for i, a in enumerate(_ASSOC_CAT):
        for b in _ASSOC_CAT[i + 1:]:
            parts.append(f"""SELECT '{a}', '{b}', 'cramers_v', CAST(sum(o) AS BIGINT), sqrt((sum(o * o / (r * c)) - 1) / (least(count(DISTINCT x), count(DISTINCT y)) - 1)) FROM (
  SELECT x, y, o, CAST(sum(o) OVER (PARTITION BY x) AS DOUBLE) AS r, CAST(sum(o) OVER (PARTITION BY y) AS DOUBLE) AS c FROM (
    SELECT {a} AS x, {b} AS y, count(*) AS o FROM gappy WHERE {a} IS NOT NULL AND {b} IS NOT NULL GROUP BY 1, 2))""")
    for a in _ASSOC_CAT:
        for b in _ASSOC_NUM:
            parts.append(f"""SELECT '{a}', '{b}', 'correlation_ratio', CAST(sum(k) AS BIGINT), sqrt(sum(k * (m - g) * (m - g)) / max(ss)) FROM (
  SELECT count({b}) AS k, avg({b}) AS m, (SELECT avg({b}) FROM gappy WHERE {a} IS NOT NULL) AS g,
    (SELECT var_pop({b}) * count({b}) FROM gappy WHERE {a} IS NOT NULL) AS ss FROM gappy WHERE {a} IS NOT NULL AND {b} IS NOT NULL GROUP BY {a})""")
    return " UNION ALL ".join(parts)


@register("associations", f"WITH {GAPPY_LINEITEM_SQL.strip()} SELECT a, b, kind, n, round(value, 6) AS value FROM ({_assoc_sql()})")
def q_q3_pairs(spark, d):
    """Q3: Pearson, Cramer's V and correlation ratio of all pairs, in one long table."""
    return _rounded(Q.associations(gappy_lineitem(spark, d), _ASSOC_NUM, _ASSOC_CAT), ["value"])


@register("drift_summary", f"""WITH {_ks_cte()}, {_chi_cte(True, with_sides=False)}, {_CHI_P},
flags AS (SELECT p_value < 0.05 AS drift FROM kp UNION ALL SELECT p_value < 0.05 FROM chip)
SELECT count(*) AS n_columns, count_if(drift) AS n_drifted, count_if(drift) / count(*) AS share_drifted, count_if(drift) / count(*) >= 0.5 AS dataset_drift
FROM flags""")
def q_q8(spark, d):
    """Q8: share of drifted columns and the dataset flag."""
    a, b = _drift_frames(spark, d)
    return Q.drift_summary(a.select(*LI_NUM, *_CAT), b.select(*LI_NUM, *_CAT))


# ---------------------------------------------------------------- V

# The four rule-based "models" (name, lower cut, upper cut on the discount).
MODELS = [("SVM", 0.03, 0.07), ("Random Forest", 0.02, 0.06), ("XGBoost", 0.04, 0.08),
          ("Logistic Regression", 0.01, 0.05)]
CLASSES = ["A", "N", "R"]
SENSITIVE = ["status_F", "status_O", "age"]


def predictions(spark, d):
    li = table(spark, d, "lineitem")
    s = li.agg(F.min("l_quantity").alias("lo"), F.max("l_quantity").alias("hi")).first()  # one row
    lo, hi = s["lo"], s["hi"]
    m = F.explode(F.array(*[F.struct(F.lit(n).alias("model"), F.lit(a).alias("t1"), F.lit(b).alias("t2"))
                            for n, a, b in MODELS])).alias("m")
    x = li.select("*", m)
    pred = (F.when(F.col("l_discount") < F.col("m.t1"), "A").when(F.col("l_discount") < F.col("m.t2"), "N")
            .otherwise("R"))
    return x.select(F.col("m.model").alias("model"), "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                    F.col("l_returnflag").alias("label"), pred.alias("prediction"),
                    (F.col("l_linestatus") == "F").cast("int").alias("status_F"),
                    (F.col("l_linestatus") == "O").cast("int").alias("status_O"),
                    F.col("l_quantity").alias("age"),
                    S.bin_label(S.equal_width_bin("l_quantity", lo, hi, 4), 4).alias("age_bin"))


PREDS_SQL = "preds AS (SELECT m.model, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag AS label, " \
    "CASE WHEN l_discount < m.t1 THEN 'A' WHEN l_discount < m.t2 THEN 'N' ELSE 'R' END AS prediction, " \
    "CAST(l_linestatus = 'F' AS INTEGER) AS status_F, CAST(l_linestatus = 'O' AS INTEGER) AS status_O, " \
    "l_quantity AS age, CASE WHEN bin BETWEEN 1 AND 4 THEN 'Bin ' || CAST(bin AS VARCHAR) ELSE 'nan' END AS age_bin " \
    "FROM (SELECT *, CASE WHEN l_quantity >= s.hi THEN 5 ELSE CAST(floor((l_quantity - s.lo) / ((s.hi - s.lo) / 4)) " \
    "AS BIGINT) + 1 END AS bin FROM lineitem, (SELECT min(l_quantity) AS lo, max(l_quantity) AS hi FROM lineitem) s) l, " \
    "(VALUES " + ", ".join(f"('{n}', {a}, {b})" for n, a, b in MODELS) + ") m(model, t1, t2))"


@register("model_accuracy", f"""WITH {PREDS_SQL}
SELECT model, round(avg(CAST(label = prediction AS DOUBLE)), 6) AS accuracy FROM preds GROUP BY 1""")
def q_v1(spark, d):
    """V1 + V11: accuracy per model, one pass over all models."""
    return _rounded(V.accuracy(predictions(spark, d), ["model"]), ["accuracy"])


@register("confusion_matrix", f"""WITH {PREDS_SQL},
cls AS (SELECT DISTINCT model, c FROM (SELECT model, label AS c FROM preds UNION ALL SELECT model, prediction FROM preds)),
grid AS (SELECT a.model, a.c AS label, b.c AS prediction FROM cls a JOIN cls b ON a.model = b.model)
SELECT g.model, g.label, g.prediction, count(p.model) AS count FROM grid g
LEFT JOIN preds p ON p.model = g.model AND p.label = g.label AND p.prediction = g.prediction
GROUP BY 1, 2, 3""")
def q_v2(spark, d):
    """V2: confusion counts completed with zeros."""
    return V.confusion(predictions(spark, d), ["model"])


_PC_SQL = """lab AS (SELECT model, label AS class, count(*) AS support, sum(CAST(label = prediction AS BIGINT)) AS tp
        FROM preds GROUP BY 1, 2),
prd AS (SELECT model, prediction AS class, count(*) AS predicted FROM preds GROUP BY 1, 2),
pc0 AS (SELECT COALESCE(lab.model, prd.model) AS model, COALESCE(lab.class, prd.class) AS class,
        COALESCE(support, 0) AS support, COALESCE(tp, 0) AS tp, COALESCE(predicted, 0) AS predicted
        FROM lab FULL JOIN prd ON lab.model = prd.model AND lab.class = prd.class),
pc1 AS (SELECT *, CASE WHEN predicted > 0 THEN tp / predicted ELSE 0.0 END AS p,
        CASE WHEN support > 0 THEN tp / support ELSE 0.0 END AS r FROM pc0),
pc AS (SELECT model, class, p AS precision, r AS recall, CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0.0 END AS f1,
       support FROM pc1)"""


@register("classification_report", f"""WITH {PREDS_SQL}, {_PC_SQL}
SELECT model, class, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, support FROM pc
UNION ALL SELECT model, 'accuracy', NULL, NULL, round(avg(CAST(label = prediction AS DOUBLE)), 6), count(*) FROM preds GROUP BY 1
UNION ALL SELECT model, 'macro avg', round(avg(precision), 6), round(avg(recall), 6), round(avg(f1), 6), CAST(sum(support) AS BIGINT)
  FROM pc GROUP BY 1
UNION ALL SELECT model, 'weighted avg', round(sum(precision * support) / sum(support), 6),
  round(sum(recall * support) / sum(support), 6), round(sum(f1 * support) / sum(support), 6), CAST(sum(support) AS BIGINT)
  FROM pc GROUP BY 1""")
def q_v3(spark, d):
    """V3: per-class precision / recall / F1 / support, accuracy, macro and weighted rows."""
    return _rounded(V.classification_report(predictions(spark, d), ["model"]), ["precision", "recall", "f1"])


@register("weighted_f1", f"""WITH {PREDS_SQL}, {_PC_SQL}
SELECT model, round(sum(f1 * support) / sum(support), 6) AS weighted_f1 FROM pc GROUP BY 1""")
def q_v4(spark, d):
    """V4."""
    return _rounded(V.weighted_f1(predictions(spark, d), ["model"]), ["weighted_f1"])


def class_scores(spark, d):
    li = table(spark, d, "lineitem")
    arr = F.array(*[F.struct(F.lit(c).alias("class"),
                             (F.when(F.col("l_returnflag") == c, 0.3).otherwise(0.0)
                              + ((F.col("l_orderkey") * 7 + F.col("l_partkey") * (k + 3)) % 100) / 100.0).alias("score"))
                    for k, c in enumerate(CLASSES)])
    return li.select(F.col("l_returnflag").alias("label"), F.explode(arr).alias("s")).select(
        "label", "s.class", "s.score", (F.col("label") == F.col("s.class")).alias("is_pos"))


SCORES_SQL = "scores AS (" + " UNION ALL ".join(
    f"SELECT l_returnflag AS label, '{c}' AS class, CASE WHEN l_returnflag = '{c}' THEN 0.3 ELSE 0.0 END + "
    f"((l_orderkey * 7 + l_partkey * {k + 3}) % 100) / 100.0 AS score, l_returnflag = '{c}' AS is_pos FROM lineitem"
    for k, c in enumerate(CLASSES)) + """),
g AS (SELECT class, score AS threshold, sum(CAST(is_pos AS BIGINT)) AS pos, sum(CAST(NOT is_pos AS BIGINT)) AS neg
      FROM scores GROUP BY 1, 2),
cum AS (SELECT *, sum(pos) OVER (PARTITION BY class ORDER BY threshold DESC) AS cum_pos,
               sum(neg) OVER (PARTITION BY class ORDER BY threshold DESC) AS cum_neg,
               sum(pos) OVER (PARTITION BY class) AS P, sum(neg) OVER (PARTITION BY class) AS N FROM g)"""


@register("roc_auc_one_vs_rest", f"""WITH {SCORES_SQL}
SELECT class, round(sum((neg / N) * ((cum_pos - pos / 2.0) / P)), 6) AS auc FROM cum GROUP BY 1""")
def q_v5(spark, d):
    """V5: one-vs-rest AUC per class (ties grouped, trapezoid)."""
    _, auc = V.roc_points(class_scores(spark, d), ["class"])
    return _rounded(auc, ["auc"])


@register("roc_auc_mean", f"""WITH {SCORES_SQL},
auc AS (SELECT class, sum((neg / N) * ((cum_pos - pos / 2.0) / P)) AS auc FROM cum GROUP BY 1)
SELECT round(avg(auc), 6) AS mean_auc, count(auc) AS n_classes FROM auc""")
def q_v5_mean(spark, d):
    """V5: mean one-vs-rest AUC over the classes that have one."""
    _, auc = V.roc_points(class_scores(spark, d), ["class"])
    return _rounded(auc.agg(F.avg("auc").alias("mean_auc"), F.count("auc").alias("n_classes")), ["mean_auc"])


@register("roc_curve_binary", f"""WITH {SCORES_SQL}
SELECT class, round(threshold, 6) AS threshold, round(cum_neg / N, 6) AS fpr, round(cum_pos / P, 6) AS tpr
FROM cum WHERE class = 'R'
UNION ALL SELECT 'R', CAST('Infinity' AS DOUBLE), 0.0, 0.0""")
def q_v6(spark, d):
    """V6: ROC curve of one class, from its start at (0, 0)."""
    curve, _ = V.roc_points(class_scores(spark, d).where(F.col("class") == "R"), ["class"])
    return _rounded(curve, ["threshold", "fpr", "tpr"])


def _fair_sql(feats) -> str:
    longs = " UNION ALL ".join(
        f"SELECT p.model, p.label, p.prediction, '{f}' AS feature, CAST({f} AS VARCHAR) AS grp, c.class "
        f"FROM preds p, cls c" for f in feats)
    return f"""cls AS (SELECT DISTINCT label AS class FROM preds),
lng AS ({longs}),
rates AS (SELECT model, class, feature, grp, avg(CAST(prediction = class AS DOUBLE)) AS sr,
  CASE WHEN sum(CAST(label = class AS BIGINT)) > 0 THEN sum(CAST(prediction = class AND label = class AS BIGINT))
       / sum(CAST(label = class AS BIGINT)) ELSE 0.0 END AS tpr,
  CASE WHEN sum(CAST(label <> class AS BIGINT)) > 0 THEN sum(CAST(prediction = class AND label <> class AS BIGINT))
       / sum(CAST(label <> class AS BIGINT)) ELSE 0.0 END AS fpr
  FROM lng GROUP BY 1, 2, 3, 4),
fair AS (SELECT model, class, feature, max(sr) - min(sr) AS dp_diff,
  greatest(max(tpr) - min(tpr), max(fpr) - min(fpr)) AS eo_diff FROM rates GROUP BY 1, 2, 3)"""


@register("fairness_metrics", f"""WITH {PREDS_SQL}, {_fair_sql(SENSITIVE + ['age_bin'])}
SELECT model, class, feature, round(dp_diff, 6) AS dp_diff, round(eo_diff, 6) AS eo_diff FROM fair""")
def q_v7(spark, d):
    """V7 + V8: demographic parity and equalized odds differences per model, class, feature."""
    fl = V.fairness_long(predictions(spark, d), "label", SENSITIVE + ["age_bin"], ["model"])
    return _rounded(fl, ["dp_diff", "eo_diff"])


@register("accuracy_by_group", f"""WITH {PREDS_SQL}
SELECT model, 'age_bin' AS feature, age_bin AS "group", round(avg(CAST(label = prediction AS DOUBLE)), 6) AS accuracy
FROM preds GROUP BY 1, 3
UNION ALL SELECT model, 'status_F', CAST(status_F AS VARCHAR), round(avg(CAST(label = prediction AS DOUBLE)), 6)
FROM preds GROUP BY 1, 3""")
def q_v9(spark, d):
    """V9: accuracy per sensitive group."""
    p = predictions(spark, d)
    parts = []
    for f in ["age_bin", "status_F"]:
        a = V.accuracy(p.withColumn("group", F.col(f).cast("string")), ["model", "group"])
        parts.append(a.select("model", F.lit(f).alias("feature"), "group", "accuracy"))
    return _rounded(parts[0].unionByName(parts[1]), ["accuracy"])


_REPORT_SQL = f"""{_fair_sql(SENSITIVE + ['age_bin'])},
acc AS (SELECT model, avg(CAST(label = prediction AS DOUBLE)) AS accuracy FROM preds GROUP BY 1),
bins AS (SELECT model, age_bin AS bin, avg(CAST(label = prediction AS DOUBLE)) AS slice_accuracy FROM preds GROUP BY 1, 2),
report AS (
  SELECT f.model, f.class, f.feature AS slice, f.dp_diff, f.eo_diff, a.accuracy, a.accuracy AS slice_accuracy
  FROM fair f JOIN acc a USING (model) WHERE f.feature <> 'age_bin'
  UNION ALL
  SELECT f.model, f.class, 'AGE_' || b.bin, f.dp_diff, f.eo_diff, a.accuracy, b.slice_accuracy
  FROM fair f JOIN acc a USING (model) JOIN bins b USING (model) WHERE f.feature = 'age_bin')"""


def fairness_report(spark, d):
    return V.fairness_report(predictions(spark, d), SENSITIVE, "age_bin")


@register("fairness_report", f"""WITH {PREDS_SQL}, {_REPORT_SQL}
SELECT model, class, slice, round(dp_diff, 6) AS dp_diff, round(eo_diff, 6) AS eo_diff, round(accuracy, 6) AS accuracy,
       round(slice_accuracy, 6) AS slice_accuracy FROM report""")
def q_v10(spark, d):
    """Models x classes x sensitive slices, binned age one row per bin."""
    return _rounded(fairness_report(spark, d), ["dp_diff", "eo_diff", "accuracy", "slice_accuracy"])


_RANK_SQL = """pen AS (SELECT model, avg(abs(dp_diff) + abs(eo_diff)) AS penalty FROM report GROUP BY 1),
ranked AS (SELECT a.model, a.accuracy, COALESCE(p.penalty, 0.0) AS penalty,
  a.accuracy - 0.7 * COALESCE(p.penalty, 0.0) AS score,
  CASE WHEN upper(a.model) LIKE '%XGB%' OR upper(a.model) LIKE '%BOOST%' THEN 'xgboost'
       WHEN upper(a.model) LIKE '%RF%' OR upper(a.model) LIKE '%FOREST%' THEN 'random_forest'
       WHEN upper(a.model) LIKE '%LR%' OR upper(a.model) LIKE '%LOGISTIC%' THEN 'logistic_regression'
       WHEN upper(a.model) LIKE '%SVM%' THEN 'svm' END AS model_type
  FROM acc a LEFT JOIN pen p USING (model))"""


def ranking(spark, d):
    cells = V.contingency(predictions(spark, d), [*SENSITIVE, "age_bin"])
    report = V.fairness_report(cells, SENSITIVE, "age_bin", cells=cells)
    return V.rank_models(V.accuracy_of_cells(cells, ["model"]), report)


@register("model_ranking", f"""WITH {PREDS_SQL}, {_REPORT_SQL}, {_RANK_SQL}
SELECT model, round(accuracy, 6) AS accuracy, round(penalty, 6) AS penalty, round(score, 6) AS score, model_type
FROM ranked""")
def q_v12(spark, d):
    """V12 + A11 + F9: score = accuracy - 0.7 x mean(|dp| + |eo|), type by name."""
    return _rounded(ranking(spark, d), ["accuracy", "penalty", "score"])


@register("best_model", f"""WITH {PREDS_SQL}, {_REPORT_SQL}, {_RANK_SQL}
SELECT model, round(accuracy, 6) AS accuracy, round(penalty, 6) AS penalty, round(score, 6) AS score, model_type
FROM ranked ORDER BY score DESC, model LIMIT 1""")
def q_v13(spark, d):
    """V13 selection: the top of the ranking (limit 1 is the feature)."""
    return _rounded(V.best_model(ranking(spark, d)), ["accuracy", "penalty", "score"])
