"""Registered queries, part 3: encoding, sampling, descriptive statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortlab.operators import describe as T
from cohortlab.operators import encode as E
from cohortlab.operators import relational as R
from cohortlab.operators import sampling as D
from cohortlab.functions import scalars as S
from cohortlab.plans.more_queries import AGE_EDGES, AGE_LABELS, LI_NUM, _age_group_sql, _rounded
from cohortlab.plans.queries import cohort_rows, register, r6
from cohortlab.plans.tables import COHORT_PEOPLE_SQL, cohort_people, table

KEYS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
KEYS_SQL = ", ".join(KEYS)


def _li(spark, d):
    return table(spark, d, "lineitem")


# ---------------------------------------------------------------- E

@register("standard_scale", "WITH s AS (SELECT " + ", ".join(
    f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in LI_NUM) + f" FROM lineitem) SELECT {KEYS_SQL}, " + ", ".join(
    f"round(({c} - m_{c}) / CASE WHEN s_{c} = 0 THEN 1 ELSE s_{c} END, 6) AS {c}" for c in LI_NUM)
    + " FROM lineitem, s")
def q_e1(spark, d):
    """Population-std scaling."""
    li = _li(spark, d).select(*KEYS, *LI_NUM)
    return _rounded(E.StandardScaler(LI_NUM).fit(li).transform(li), LI_NUM)


_OH = {"l_returnflag": ["A", "N", "R"], "l_linestatus": ["F", "O"], "l_linenumber": [1, 2, 3, 4, 5, 6, 7]}


def _onehot_sql(drop_first: bool) -> str:
    cols = []
    for c, vals in _OH.items():
        for v in (vals[1:] if drop_first else vals):
            name = f"{c}_{float(v)!r}" if isinstance(v, int) else f"{c}_{v}"
            lit = v if isinstance(v, int) else f"'{v}'"
            cols.append(f'CASE WHEN {c} = {lit} THEN 1 ELSE 0 END AS "{name}"')
    return f"SELECT l_orderkey, l_partkey, l_suppkey, l_quantity, {', '.join(cols)} FROM lineitem"


@register("one_hot_all", _onehot_sql(False))
def q_e2(spark, d):
    """Every category, names <col>_<value> (numbers print as 1.0)."""
    li = _li(spark, d).select("l_orderkey", "l_partkey", "l_suppkey", "l_quantity", *_OH)
    return E.OneHot(list(_OH)).fit(li).transform(li)


@register("dummies_drop_first", _onehot_sql(True))
def q_e3(spark, d):
    """First category dropped, originals replaced."""
    li = _li(spark, d).select("l_orderkey", "l_partkey", "l_suppkey", "l_quantity", *_OH)
    return E.OneHot(list(_OH), drop_first=True).fit(li).transform(li)


@register("column_composer", "WITH s AS (SELECT avg(l_quantity) AS mq, stddev_pop(l_quantity) AS sq, "
          "avg(l_extendedprice) AS mp, stddev_pop(l_extendedprice) AS sp FROM lineitem) "
          "SELECT round((l_quantity - mq) / sq, 6) AS l_quantity, round((l_extendedprice - mp) / sp, 6) AS l_extendedprice, "
          + ", ".join(f'CASE WHEN l_returnflag = \'{v}\' THEN 1 ELSE 0 END AS "l_returnflag_{v}"' for v in "ANR")
          + ", " + ", ".join(f'CASE WHEN l_linestatus = \'{v}\' THEN 1 ELSE 0 END AS "l_linestatus_{v}"' for v in "FO")
          + f", {KEYS_SQL} FROM lineitem, s")
def q_e4(spark, d):
    """Scaled numerics + one-hot + passthrough in one select."""
    li = _li(spark, d).select(*KEYS, "l_quantity", "l_extendedprice", "l_returnflag", "l_linestatus")
    comp = E.ColumnComposer(["l_quantity", "l_extendedprice"], ["l_returnflag", "l_linestatus"]).fit(li)
    return _rounded(comp.transform(li), ["l_quantity", "l_extendedprice"])


@register("label_encode", """
SELECT c_custkey, CAST(dense_rank() OVER (ORDER BY c_mktsegment) - 1 AS INTEGER) AS cohort_code FROM customer""")
def q_e5(spark, d):
    """E5: sorted distinct labels -> 0..k-1."""
    c = table(spark, d, "customer").select("c_custkey", "c_mktsegment")
    return E.label_encode(c, "c_mktsegment", "cohort_code").select("c_custkey", "cohort_code")


@register("label_encode_many", f"""
SELECT {KEYS_SQL}, CAST(dense_rank() OVER (ORDER BY l_extendedprice) - 1 AS INTEGER) AS price_code FROM lineitem""")
def q_e5_many(spark, d):
    """E5 on a column with nearly as many labels as rows: ranks from a distributed index, joined back."""
    li = _li(spark, d).select(*KEYS, "l_extendedprice")
    return E.label_encode(li, "l_extendedprice", "price_code").select(*KEYS, "price_code")


_SLOT_COLS = ["l_partkey", "l_returnflag", "l_suppkey"]


def _slots_sql(drop_first: bool) -> str:
    skip = int(drop_first)
    at, parts = "1", []
    for c in _SLOT_COLS:
        parts.append(f"CASE WHEN r_{c} > {skip} THEN CAST(r_{c} - 1 - {skip} + {at} AS INTEGER) END")
        at += f" + (SELECT count(DISTINCT {c}) - {skip} FROM lineitem)"
    ranks = ", ".join(f"dense_rank() OVER (ORDER BY {c}) AS r_{c}" for c in _SLOT_COLS)
    return (f"SELECT {KEYS_SQL}, round((l_quantity - (SELECT avg(l_quantity) FROM lineitem)) / (SELECT stddev_pop(l_quantity) FROM lineitem), 6) "
            f"AS quantity, list_filter([0, {', '.join(parts)}], lambda s: s IS NOT NULL) AS slots, CAST({at} AS INTEGER) AS size "
            f"FROM (SELECT *, {ranks} FROM lineitem)")


def _slots(spark, d, drop_first):
    li = _li(spark, d)
    got = E.VectorEncoder(_SLOT_COLS, ["l_quantity"], drop_first).fit(li).transform(li)
    return got.select(*KEYS, r6(F.get("features.values", F.lit(0))).alias("quantity"), F.col("features.indices").alias("slots"),
                      F.col("features.size").alias("size"))


@register("vector_encoder", _slots_sql(False))
def q_e2_vector(spark, d):
    """E2 + E4: one sparse vector a row, categories as a joined table, however many there are."""
    return _slots(spark, d, False)


@register("vector_encoder_drop_first", _slots_sql(True))
def q_e3_vector(spark, d):
    """The first category of each column has no slot."""
    return _slots(spark, d, True)


_DIMS = 64


def _flat(spark, d):
    return table(spark, d, "embeddings").select("vec_id", "label", *[F.col("embedding")[i].cast("double").alias(f"f{i}") for i in range(_DIMS)])


_LONG_SQL = f"""x AS (SELECT vec_id, label, CAST(unnest(embedding) AS DOUBLE) AS v, unnest(range({_DIMS})) AS i FROM embeddings)"""


@register("correlation_wide", f"""WITH {_LONG_SQL}
SELECT 'f' || a.i AS a, 'f' || b.i AS b, CAST(a.i AS INTEGER) AS i, CAST(b.i AS INTEGER) AS j, round(corr(a.v, b.v), 6) AS r
FROM x a JOIN x b ON a.vec_id = b.vec_id GROUP BY a.i, b.i""")
def q_t3_wide(spark, d):
    """T3 on 64 columns: outer products per batch, added in a tree, instead of an expression a pair."""
    return _rounded(T.correlation_long(_flat(spark, d), [f"f{i}" for i in range(_DIMS)]), ["r"])


@register("class_scatter", f"""WITH {_LONG_SQL},
m AS (SELECT label, i, avg(v) AS mu FROM x GROUP BY 1, 2)
SELECT 'mean' AS kind, label AS a, CAST(i AS INTEGER) AS b, round(mu, 6) AS value FROM m
UNION ALL SELECT 'within', CAST(a.i AS INTEGER), CAST(b.i AS INTEGER), round(sum((a.v - ma.mu) * (b.v - mb.mu)), 6) FROM x a JOIN x b ON a.vec_id = b.vec_id
JOIN m ma ON ma.label = a.label AND ma.i = a.i JOIN m mb ON mb.label = b.label AND mb.i = b.i GROUP BY a.i, b.i""")
def q_e8_scatter(spark, d):
    """Class means and within-class scatter, which the discriminant is made from."""
    lda = E.LinearDiscriminant([f"f{i}" for i in range(_DIMS)], "label")
    classes, _, means, within = lda.scatter(_flat(spark, d))
    rows = [("mean", int(c), i, float(v)) for c, mu in zip(classes, means) for i, v in enumerate(mu)]
    rows += [("within", i, j, float(v)) for i, row in enumerate(within) for j, v in enumerate(row)]
    return _rounded(spark.createDataFrame(rows, "kind string, a int, b int, value double"), ["value"])


CORR_COLS = ["l_quantity", "l_extendedprice", "revenue", "l_discount", "l_tax"]


def _corr_frame(spark, d):
    return _li(spark, d).select(*LI_NUM, (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("revenue"))


def _corr_sql(pair_filter: str) -> str:
    rows = []
    for i, a in enumerate(CORR_COLS):
        for j, b in enumerate(CORR_COLS):
            src = "" if i == j else " FROM x"
            r = "1.0" if i == j else f"corr({a}, {b})"
            rows.append(f"SELECT '{a}' AS a, '{b}' AS b, {i} AS i, {j} AS j, {r} AS r{src}")
    return ("WITH x AS (SELECT *, l_extendedprice * (1 - l_discount) AS revenue FROM lineitem), "
            f"c AS ({' UNION ALL '.join(rows)}) SELECT a, b, i, j, round(r, 6) AS r FROM c {pair_filter}")


@register("correlation_matrix", _corr_sql(""))
def q_t3(spark, d):
    """Pearson r for every pair, long form, one pass."""
    return _rounded(T.correlation_long(_corr_frame(spark, d), CORR_COLS), ["r"])


@register("correlated_pairs", _corr_sql("WHERE i > j AND abs(r) > 0.9"))
def q_e6(spark, d):
    """|r| > 0.9, strict lower triangle."""
    return _rounded(E.correlated_pairs(T.correlation_long(_corr_frame(spark, d), CORR_COLS), 0.9), ["r"])


@register("drop_id_and_date", f"""
WITH {COHORT_PEOPLE_SQL.strip()} SELECT c_mktsegment, round(age, 6) AS age, c_nationkey FROM people""")
def q_e7(spark, d):
    """Identifier and date columns leave before modelling (strict drop)."""
    p = cohort_people(spark, d).withColumn("enroll_date", F.lit(None).cast("date")).withColumn("age", r6("age"))
    return E.drop_id_and_date(p, ("c_custkey", "enroll_date"))


# ---------------------------------------------------------------- D

def _u_sql(col: str, seed: int) -> str:
    return f"('0x' || substr(md5(CAST({col} AS VARCHAR) || ':{seed}'), 1, 15))::BIGINT"


@register("split_train_val_test", f"""
WITH h AS (SELECT c_custkey, {_u_sql('c_custkey', 42)} AS u FROM customer),
r AS (SELECT c_custkey, row_number() OVER (ORDER BY u, c_custkey) - 1 AS rk, count(*) OVER () AS n FROM h),
z AS (SELECT *, n - ceil(0.3 * n) AS n_train, ceil(0.3 * n) - ceil(0.5 * ceil(0.3 * n)) AS n_val FROM r)
SELECT c_custkey, CASE WHEN rk < n_train THEN 'train' WHEN rk < n_train + n_val THEN 'val' ELSE 'test' END AS split
FROM z""")
def q_d1(spark, d):
    """70 / 15 / 15 with exact sizes, hash order, no global sort."""
    c = table(spark, d, "customer").select("c_custkey")
    return D.train_val_test(c, "c_custkey", seed=42)


@register("split_train_test", f"""
WITH h AS (SELECT o_orderkey, {_u_sql('o_orderkey', 42)} AS u FROM orders),
r AS (SELECT o_orderkey, row_number() OVER (ORDER BY u, o_orderkey) - 1 AS rk, count(*) OVER () AS n FROM h)
SELECT o_orderkey, CASE WHEN rk < n - ceil(0.2 * n) THEN 'train' ELSE 'test' END AS split FROM r""")
def q_d2(spark, d):
    """80 / 20."""
    o = table(spark, d, "orders").select("o_orderkey")
    return D.train_test(o, "o_orderkey", 0.2, seed=42)


def _people_groups(spark, d):
    return cohort_people(spark, d).select("c_custkey", S.bin_fixed("age", AGE_EDGES, AGE_LABELS).alias("age_group"))


_GROUPS_SQL = f"""{COHORT_PEOPLE_SQL.strip()},
g AS (SELECT c_custkey, {_age_group_sql()} AS age_group FROM people),
target AS (SELECT count(*) AS t FROM g WHERE age_group = '70-79'),
under AS (SELECT c_custkey, age_group FROM (
  SELECT *, row_number() OVER (ORDER BY {_u_sql('c_custkey', 1)}, c_custkey) - 1 AS rk FROM g WHERE age_group = '60-69')
  WHERE rk < (SELECT t FROM target)),
grp AS (SELECT c_custkey, age_group, row_number() OVER (ORDER BY {_u_sql('c_custkey', 1)}, c_custkey) - 1 AS rk
        FROM g WHERE age_group = '80 and above'),
draws AS (SELECT range AS i FROM range((SELECT t FROM target) - (SELECT count(*) FROM grp))),
over AS (SELECT grp.c_custkey, grp.age_group FROM draws
         JOIN grp ON grp.rk = {_u_sql('draws.i', 2)} % (SELECT count(*) FROM grp))"""


@register("under_sample", f"WITH {_GROUPS_SQL} SELECT c_custkey, age_group FROM under")
def q_d3(spark, d):
    """D3: the 60-69 group cut to exactly the size of the 70-79 group."""
    g = _people_groups(spark, d)
    n = g.where(F.col("age_group") == "70-79").count()
    return D.under_sample(g, "age_group", "60-69", n, "c_custkey", seed=1)


@register("over_sample", f"WITH {_GROUPS_SQL} SELECT c_custkey, age_group FROM over")
def q_d4(spark, d):
    """Draws with replacement that bring 80+ up to the 70-79 size."""
    g = _people_groups(spark, d)
    counts = {r[0]: r[1] for r in g.groupBy("age_group").count().collect()}
    return D.over_sample(g, "age_group", "80 and above", counts["70-79"] - counts["80 and above"], "c_custkey", 1)


@register("rebalance", f"""WITH {_GROUPS_SQL}
SELECT c_custkey, age_group FROM g WHERE age_group IS DISTINCT FROM '60-69'
UNION ALL SELECT * FROM under UNION ALL SELECT * FROM over""")
def q_d5(spark, d):
    """Others (null group kept) + under-sampled + over-sampled extra rows."""
    g = _people_groups(spark, d)
    return D.rebalance(g, "age_group", "60-69", "80 and above", "70-79", "c_custkey", seed=1)


@register("stratified_folds", f"""
SELECT vec_id, label, CAST((row_number() OVER (PARTITION BY label ORDER BY {_u_sql('vec_id', 42)}, vec_id) - 1) % 3
  AS INTEGER) AS fold FROM embeddings""")
def q_d6(spark, d):
    """fold = rank inside the class (hash order) mod 3, skew-safe ranking."""
    e = table(spark, d, "embeddings").select("vec_id", "label")
    return D.stratified_folds(e, "label", "vec_id", 3, 42)


# ---------------------------------------------------------------- T

def _describe_sql(extra: bool) -> str:
    rows = []
    for c in LI_NUM:
        base = (f"SELECT '{c}' AS column, count({c}) AS count, round(avg({c}), 6) AS mean, "
                f"round(stddev_samp({c}), 6) AS std, round(min({c}), 6) AS min, round(quantile_cont({c}, 0.25), 6) AS p25, "
                f"round(quantile_cont({c}, 0.5), 6) AS p50, round(quantile_cont({c}, 0.75), 6) AS p75, "
                f"round(max({c}), 6) AS max")
        if extra:
            base += (f", round(quantile_cont({c}, 0.5), 6) AS median, (SELECT round({c}, 6) FROM lineitem "
                     f"GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1) AS mode")
        rows.append(base + " FROM lineitem")
    return " UNION ALL ".join(rows)


_DESC_COLS = ["mean", "std", "min", "p25", "p50", "p75", "max"]


@register("describe", _describe_sql(False))
def q_t1(spark, d):
    """Count, mean, std, min, quartiles, max per numeric column, one pass."""
    return _rounded(T.describe(_li(spark, d), LI_NUM), _DESC_COLS)


@register("describe_median_mode", _describe_sql(True))
def q_t2(spark, d):
    """T2 + A6: plus median and first mode."""
    return _rounded(T.describe_plus(_li(spark, d), LI_NUM), _DESC_COLS + ["median", "mode"])


@register("center_table", " UNION ALL ".join(
    f"SELECT '{c}' AS column, round(avg({c}), 6) AS mean, round(quantile_cont({c}, 0.5), 6) AS median, "
    f"(SELECT round({c}, 6) FROM lineitem GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1) AS mode FROM lineitem"
    for c in LI_NUM))
def q_t8(spark, d):
    """Mean / median / mode table."""
    return _rounded(T.center_table(_li(spark, d), LI_NUM), ["mean", "median", "mode"])


def _hist_sql(bins: int) -> str:
    parts = []
    for c in LI_NUM:
        parts.append(f"""SELECT '{c}' AS column, CAST(b.bin AS INTEGER) AS bin, round(lo + b.bin * (hi - lo) / {bins}, 6) AS bin_lo,
  round(lo + (b.bin + 1) * (hi - lo) / {bins}, 6) AS bin_hi, coalesce(n, 0) AS count
  FROM (SELECT range AS bin FROM range({bins})) b
  JOIN (SELECT min({c}) AS lo, max({c}) AS hi FROM lineitem) s ON b.bin = 0 OR hi > lo
  LEFT JOIN (SELECT CASE WHEN hi = lo THEN 0 ELSE least(CAST(floor(({c} - lo) / ((hi - lo) / {bins})) AS INTEGER), {bins - 1}) END AS bin,
    count(*) AS n FROM lineitem, (SELECT min({c}) AS lo, max({c}) AS hi FROM lineitem) WHERE {c} IS NOT NULL GROUP BY 1) k
  ON k.bin = b.bin""")
    return " UNION ALL ".join(parts)


@register("histogram", _hist_sql(20))
def q_t4(spark, d):
    """T4: 20 equal-width bins per column, last bin closed."""
    return _rounded(T.histogram(_li(spark, d), LI_NUM, 20), ["bin_lo", "bin_hi"])


def _box_sql() -> str:
    parts = []
    for c in LI_NUM:
        parts.append(f"""SELECT '{c}' AS column, round(p25, 6) AS p25, round(p50, 6) AS p50, round(p75, 6) AS p75,
  round(min(CASE WHEN {c} BETWEEN p25 - 1.5 * (p75 - p25) AND p75 + 1.5 * (p75 - p25) THEN {c} END), 6) AS whisker_lo,
  round(max(CASE WHEN {c} BETWEEN p25 - 1.5 * (p75 - p25) AND p75 + 1.5 * (p75 - p25) THEN {c} END), 6) AS whisker_hi,
  count(CASE WHEN NOT ({c} BETWEEN p25 - 1.5 * (p75 - p25) AND p75 + 1.5 * (p75 - p25)) THEN 1 END) AS n_outliers
  FROM lineitem, (SELECT quantile_cont({c}, 0.25) AS p25, quantile_cont({c}, 0.5) AS p50,
                         quantile_cont({c}, 0.75) AS p75 FROM lineitem) WHERE {c} IS NOT NULL GROUP BY p25, p50, p75""")
    return " UNION ALL ".join(parts)


@register("box_stats", _box_sql())
def q_t5(spark, d):
    """T5: quartiles, 1.5 IQR whiskers, outlier count."""
    return _rounded(T.box_stats(_li(spark, d), LI_NUM),
                    ["p25", "p50", "p75", "whisker_lo", "whisker_hi"])


_LI_TYPES = [("l_orderkey", "bigint"), ("l_partkey", "bigint"), ("l_suppkey", "bigint"), ("l_linenumber", "int"),
             ("l_quantity", "double"), ("l_extendedprice", "double"), ("l_discount", "double"), ("l_tax", "double"),
             ("l_returnflag", "string"), ("l_linestatus", "string"), ("l_shipdate", "timestamp_ntz")]


@register("table_info", " UNION ALL ".join(
    f"SELECT {i} AS position, '{c}' AS column, '{t}' AS dtype, count({c}) AS non_null FROM lineitem"
    for i, (c, t) in enumerate(_LI_TYPES)))
def q_t7(spark, d):
    """Types and non-null counts."""
    return T.table_info(_li(spark, d))


@register("kde_density", """
WITH v AS (SELECT l_quantity AS v, count(*) AS c FROM lineitem WHERE l_quantity IS NOT NULL GROUP BY 1),
s AS (SELECT min(l_quantity) AS lo, max(l_quantity) AS hi, count(l_quantity) AS n,
             stddev_samp(l_quantity) * pow(CAST(count(l_quantity) AS DOUBLE), -0.2) AS h FROM lineitem),
g AS (SELECT range AS i, lo + range * ((hi - lo) / 199) AS x FROM s, range(200))
SELECT CAST(g.i AS INTEGER) AS i, round(g.x, 6) AS x,
       round(sum(v.c * exp(-0.5 * ((g.x - v.v) / s.h) * ((g.x - v.v) / s.h))) / (s.n * s.h * sqrt(2 * pi())), 6) AS density
FROM g, v, s GROUP BY g.i, g.x, s.n, s.h""")
def q_t9(spark, d):
    """Gaussian KDE on a 200-point grid, Scott bandwidth, no value x grid product."""
    return _rounded(T.kde(_li(spark, d), "l_quantity", 200), ["x", "density"])
