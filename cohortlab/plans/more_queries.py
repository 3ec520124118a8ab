"""Registered queries, part 2: projections, aggregates, duplicates, sorts,
unions, scalar functions, missing values, outliers."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortlab.functions import scalars as S
from cohortlab.operators import knn as KN
from cohortlab.operators import missing as M
from cohortlab.operators import outliers as X
from cohortlab.operators import relational as R
from cohortlab.plans.queries import register, r6
from cohortlab.plans.tables import (COHORT_PEOPLE_SQL, EVENT_TYPES, GAPPY_LINEITEM_SQL, cohort_people,
                                    gappy_lineitem, table)

LI_NUM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
GAPPY_COLS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "qty", "disc", "tax", "price",
              "status", "flag", "line", "empty_col"]


def _rounded(df, cols):
    return df.withColumns({c: r6(c) for c in cols})


def _sel(cols, repl=None, prefix=""):
    repl = repl or {}
    return ", ".join(repl.get(c, f"{prefix}{c}") for c in cols)


# ---------------------------------------------------------------- P

@register("drop_columns_strict", """
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_returnflag
FROM lineitem""")
def q_drop_strict(spark, d):
    """P1."""
    return R.drop_strict(table(spark, d, "lineitem"), "l_tax", "l_linestatus", "l_shipdate")


@register("rename_columns", """
SELECT c_custkey AS Participant_ID, c_mktsegment AS COHORT, c_nationkey FROM customer""")
def q_rename(spark, d):
    """P2."""
    c = table(spark, d, "customer").select("c_custkey", "c_mktsegment", "c_nationkey")
    return R.rename(c, {"c_custkey": "Participant_ID", "c_mktsegment": "COHORT"})


@register("keep_rows_in_list", """
SELECT event_id, user_id, event_type FROM events WHERE event_type IN ('click', 'view')""")
def q_keep_in(spark, d):
    """P3."""
    return R.keep_in(table(spark, d, "events"), "event_type", ["click", "view"]).select(
        "event_id", "user_id", "event_type")


@register("keep_rows_equal", """
SELECT o_orderkey, o_custkey FROM orders WHERE o_orderstatus = 'F'""")
def q_keep_eq(spark, d):
    """P4."""
    return R.keep_equal(table(spark, d, "orders"), "o_orderstatus", "F").select("o_orderkey", "o_custkey")


@register("keep_rows_not_equal_null_safe", f"""
WITH {GAPPY_LINEITEM_SQL.strip()}
SELECT l_orderkey, l_linenumber, l_partkey, status FROM gappy WHERE status IS DISTINCT FROM 'O'""")
def q_keep_ne(spark, d):
    """P5: pandas ``!=`` keeps null rows."""
    g = gappy_lineitem(spark, d)
    return R.keep_not_equal(g, "status", "O").select("l_orderkey", "l_linenumber", "l_partkey", "status")


@register("select_numeric_columns", """
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax
FROM lineitem""")
def q_numeric_cols(spark, d):
    """P6."""
    li = table(spark, d, "lineitem")
    return li.select(*R.columns_of_type(li, "numeric"))


@register("target_split_by_key", f"""
WITH {COHORT_PEOPLE_SQL.strip()}
SELECT c_custkey, c_mktsegment, round(age, 6) AS age, c_nationkey FROM people""")
def q_target_split(spark, d):
    """P7 + E9: target leaves the features and comes back by key, not by position."""
    p = cohort_people(spark, d)
    feats, target = R.split_target(p, "c_mktsegment", key="c_custkey")
    from cohortlab.operators.encode import attach_target
    return attach_target(feats.withColumn("age", r6("age")), target, "c_custkey")


@register("columns_named_like_date", """
SELECT o_orderkey, o_orderdate FROM orders""")
def q_name_pattern(spark, d):
    """Pick the columns whose name contains 'date'."""
    o = table(spark, d, "orders")
    return o.select("o_orderkey", *R.columns_matching(o, "date"))


@register("mask_assignment", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
       CASE WHEN l_quantity > 45 THEN 0.0 ELSE l_discount END AS l_discount FROM lineitem""")
def q_mask(spark, d):
    """P10."""
    li = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                                            "l_quantity", "l_discount")
    return R.assign_where(li, "l_discount", F.col("l_quantity") > 45, 0.0).drop("l_quantity")


# ---------------------------------------------------------------- A

_NULL_ROWS = " UNION ALL ".join(
    f"SELECT '{c}' AS column, count(*) AS n_rows, count(*) - count({c}) AS n_null, "
    f"round((count(*) - count({c})) / count(*), 6) AS null_share FROM gappy" for c in GAPPY_COLS)


@register("null_profile", f"WITH {GAPPY_LINEITEM_SQL.strip()} {_NULL_ROWS}")
def q_null_profile(spark, d):
    """A2 + A3 + M9: null count and share of every column, one pass."""
    return _rounded(R.null_stats(gappy_lineitem(spark, d)), ["null_share"])


_DISTINCT_ROWS = " UNION ALL ".join(
    f"SELECT '{c}' AS column, count(DISTINCT {c}) AS n_unique FROM gappy" for c in GAPPY_COLS)


@register("distinct_counts", f"WITH {GAPPY_LINEITEM_SQL.strip()} {_DISTINCT_ROWS}")
def q_distinct_counts(spark, d):
    """A4: exact distinct count per column, nulls ignored."""
    return R.distinct_counts(gappy_lineitem(spark, d))


@register("distinct_values", "SELECT DISTINCT o_orderpriority FROM orders")
def q_distinct_values(spark, d):
    """A5."""
    return R.distinct_values(table(spark, d, "orders"), "o_orderpriority")


@register("value_counts", "SELECT o_orderpriority, count(*) AS count FROM orders GROUP BY 1")
def q_value_counts(spark, d):
    """A7 / T6."""
    return R.value_counts(table(spark, d, "orders"), "o_orderpriority")


@register("value_shares", """
SELECT o_orderpriority, round(count(*) / sum(count(*)) OVER (), 6) AS share FROM orders GROUP BY 1""")
def q_value_shares(spark, d):
    """A8."""
    return _rounded(R.value_counts(table(spark, d, "orders"), "o_orderpriority", normalize=True), ["share"])


@register("duplicate_row_count", """
SELECT CAST(count(*) - (SELECT count(*) FROM (SELECT DISTINCT text, lang FROM documents)) AS BIGINT)
  AS n_duplicate_rows FROM documents""")
def q_dup_count(spark, d):
    """Full-row duplicates (documents projected to text, lang)."""
    return R.duplicate_row_count(table(spark, d, "documents").select("text", "lang"))


@register("table_shape", "SELECT count(*) AS n_rows, CAST(11 AS BIGINT) AS n_columns FROM lineitem")
def q_shape(spark, d):
    """A10."""
    return R.shape(table(spark, d, "lineitem"))


# ---------------------------------------------------------------- W, O, U

@register("drop_duplicates_all_columns", """
SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem""")
def q_dedup_all(spark, d):
    """W2, all columns, keep first."""
    return R.drop_duplicates(table(spark, d, "lineitem").select("l_orderkey", "l_linenumber"))


@register("drop_duplicates_subset_first", """
SELECT doc_id, lang, n_chars FROM (
  SELECT *, row_number() OVER (PARTITION BY text ORDER BY doc_id) AS rn FROM documents) WHERE rn = 1""")
def q_dedup_first(spark, d):
    """W2, subset (text), keep first by doc_id."""
    doc = table(spark, d, "documents")
    return R.drop_duplicates(doc, ["text"], "first", order_by=["doc_id"]).select("doc_id", "lang", "n_chars")


@register("drop_duplicates_subset_last", """
SELECT doc_id, lang, n_chars FROM (
  SELECT *, row_number() OVER (PARTITION BY text ORDER BY doc_id DESC) AS rn FROM documents) WHERE rn = 1""")
def q_dedup_last(spark, d):
    """W2, keep last."""
    doc = table(spark, d, "documents")
    return R.drop_duplicates(doc, ["text"], "last", order_by=["doc_id"]).select("doc_id", "lang", "n_chars")


@register("drop_all_duplicated", """
SELECT doc_id, lang FROM documents WHERE text IN (
  SELECT text FROM documents GROUP BY text HAVING count(*) = 1)""")
def q_dedup_none(spark, d):
    """W2, keep=False: every row whose text repeats is dropped."""
    doc = table(spark, d, "documents")
    return R.drop_duplicates(doc, ["text"], keep=False).select("doc_id", "lang")


@register("rows_involved_in_duplication", """
SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey FROM lineitem l
JOIN (SELECT l_orderkey, l_linenumber FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1) k
  ON l.l_orderkey = k.l_orderkey AND l.l_linenumber = k.l_linenumber""")
def q_dup_rows(spark, d):
    """W3."""
    li = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return R.rows_by_duplication(li, ["l_orderkey", "l_linenumber"])


@register("row_index", """
SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1 AS index FROM orders""")
def q_row_index(spark, d):
    """Exact global position without a single-partition window."""
    o = table(spark, d, "orders").select("o_orderkey", "o_orderdate")
    return R.with_row_index(o, ["o_orderdate", "o_orderkey"]).select("o_orderkey", "index")


@register("sort_nulls_last", f"""
WITH {GAPPY_LINEITEM_SQL.strip()}
SELECT l_orderkey, l_linenumber, l_partkey, qty FROM gappy ORDER BY qty NULLS LAST, l_orderkey, l_linenumber, l_partkey""")
def q_sort(spark, d):
    """O1: ascending, nulls last (pandas NaT/NaN placement)."""
    g = gappy_lineitem(spark, d).select("l_orderkey", "l_linenumber", "l_partkey", "qty")
    return R.sort_asc(g, ["qty", "l_orderkey", "l_linenumber", "l_partkey"])


# Age bins and labels of the rebalancing script.
AGE_EDGES = [0, 50, 60, 70, 80, 100]
AGE_LABELS = ["Under 50", "50-59", "60-69", "70-79", "80 and above"]


def _age_group_sql(col: str = "age") -> str:
    parts = [f"WHEN {col} >= {lo} AND {col} < {hi} THEN '{lab}'"
             for lo, hi, lab in zip(AGE_EDGES[:-1], AGE_EDGES[1:], AGE_LABELS)]
    return "CASE " + " ".join(parts) + " END"


@register("age_group_counts", f"""
WITH {COHORT_PEOPLE_SQL.strip()}
SELECT {_age_group_sql()} AS age_group, count(*) AS count FROM people GROUP BY 1""")
def q_age_groups(spark, d):
    """F5 + O2 + A7: fixed-edge left-closed bins, counted, in label order."""
    p = cohort_people(spark, d).withColumn("age_group", S.bin_fixed("age", AGE_EDGES, AGE_LABELS))
    vc = p.groupBy("age_group").agg(F.count(F.lit(1)).alias("count"))
    return R.sort_by_label_order(vc, "age_group", AGE_LABELS)


@register("top_k_customers", """
SELECT o_custkey, round(sum(o_totalprice), 6) AS total FROM orders GROUP BY 1
ORDER BY total DESC, o_custkey LIMIT 10""")
def q_topk(spark, d):
    """O3: top 10 by score, name as tie-break (the limit is the feature)."""
    t = table(spark, d, "orders").groupBy("o_custkey").agg(r6(F.sum("o_totalprice")).alias("total"))
    return R.top_k(t, "total", 10, ["o_custkey"])


@register("head_rows", """
SELECT o_orderkey, o_custkey FROM orders ORDER BY o_orderkey LIMIT 5""")
def q_head(spark, d):
    """O4 (on a defined order)."""
    return R.head(table(spark, d, "orders").select("o_orderkey", "o_custkey").orderBy("o_orderkey"), 5)


@register("stack_by_name", """
SELECT user_id, event_id, value AS click_value, NULL::DOUBLE AS view_value, NULL::VARCHAR AS props
  FROM events WHERE event_type = 'click'
UNION ALL
SELECT user_id, event_id, NULL::DOUBLE, value, props FROM events WHERE event_type = 'view'""")
def q_stack(spark, d):
    """Stack tables by column name, missing columns filled."""
    ev = table(spark, d, "events")
    a = ev.where(F.col("event_type") == "click").select("user_id", "event_id", F.col("value").alias("click_value"))
    b = ev.where(F.col("event_type") == "view").select("user_id", "event_id", F.col("value").alias("view_value"),
                                                       "props")
    return R.stack_by_name([a, b])


# ---------------------------------------------------------------- F

def _month_text():
    return (F.when(F.col("o_orderkey") % 50 == 0, F.lit("13/2020"))
            .when(F.col("o_orderkey") % 77 == 0, F.lit("n/a"))
            .otherwise(F.date_format("o_orderdate", "MM/yyyy")))
_MONTH_TEXT_SQL = ("CASE WHEN o_orderkey % 50 = 0 THEN '13/2020' WHEN o_orderkey % 77 = 0 THEN 'n/a' "
                   "ELSE strftime(o_orderdate, '%m/%Y') END")


@register("parse_month_lenient", f"""
SELECT o_orderkey, try_strptime({_MONTH_TEXT_SQL}, '%m/%Y') AS enroll_month FROM orders""")
def q_parse_month(spark, d):
    """month text with junk -> timestamp or null."""
    o = table(spark, d, "orders")
    return o.select("o_orderkey", S.parse_month(_month_text()).alias("enroll_month"))


@register("parse_month_strict", """
SELECT o_orderkey, strptime(strftime(o_orderdate, '%m/%Y'), '%m/%Y') AS entry_month FROM orders""")
def q_parse_month_strict(spark, d):
    """clean month text parsed with the raising parser."""
    o = table(spark, d, "orders")
    return o.select("o_orderkey", S.parse_month(F.date_format("o_orderdate", "MM/yyyy"), strict=True)
                    .alias("entry_month"))


@register("parse_day_lenient", """
SELECT o_orderkey, try_strptime(CASE WHEN o_orderkey % 45 = 0 THEN '2020-02-30'
  ELSE strftime(o_orderdate, '%Y-%m-%d') END, '%Y-%m-%d') AS run_date FROM orders""")
def q_parse_day(spark, d):
    """day text, invalid dates -> null."""
    o = table(spark, d, "orders")
    txt = F.when(F.col("o_orderkey") % 45 == 0, F.lit("2020-02-30")).otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    return o.select("o_orderkey", S.parse_day(txt).alias("run_date"))


@register("parse_free_dates", """
SELECT o_orderkey, COALESCE(try_strptime(t, '%Y-%m-%d'), try_strptime(t, '%m/%d/%Y'),
                            try_strptime(t, '%Y%m%d')) AS order_date
FROM (SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d')
  WHEN 1 THEN strftime(o_orderdate, '%m/%d/%Y') WHEN 2 THEN strftime(o_orderdate, '%Y%m%d')
  ELSE 'unknown' END AS t FROM orders)""")
def q_free_dates(spark, d):
    """F4 + P9: every '*date*' column parsed by the first matching pattern."""
    o = table(spark, d, "orders")
    k = F.col("o_orderkey") % 4
    txt = (F.when(k == 0, F.date_format("o_orderdate", "yyyy-MM-dd"))
           .when(k == 1, F.date_format("o_orderdate", "MM/dd/yyyy"))
           .when(k == 2, F.date_format("o_orderdate", "yyyyMMdd")).otherwise(F.lit("unknown")))
    t = o.select("o_orderkey", txt.alias("order_date"))
    return t.select("o_orderkey", *[S.parse_free_date(c).alias(c) for c in R.columns_matching(t, "date")])


@register("equal_width_bins", """
WITH s AS (SELECT min(l_quantity) AS lo, max(l_quantity) AS hi FROM lineitem),
b AS (SELECT CASE WHEN l_quantity >= s.hi THEN 5 ELSE CAST(floor((l_quantity - s.lo) / ((s.hi - s.lo) / 4)) AS BIGINT) + 1 END AS bin
      FROM lineitem, s)
SELECT CASE WHEN bin BETWEEN 1 AND 4 THEN 'Bin ' || CAST(bin AS VARCHAR) ELSE 'nan' END AS age_bin, count(*) AS count
FROM b GROUP BY 1""")
def q_equal_bins(spark, d):
    """F6 + F10: 4 equal-width left-closed bins between min and max; the max is 'nan'."""
    li = table(spark, d, "lineitem")
    s = li.agg(F.min("l_quantity").alias("lo"), F.max("l_quantity").alias("hi")).first()
    b = S.equal_width_bin("l_quantity", s["lo"], s["hi"], 4)
    return li.select(S.bin_label(b, 4).alias("age_bin")).groupBy("age_bin").agg(F.count(F.lit(1)).alias("count"))


@register("split_text_to_doubles", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
       [l_quantity, l_discount, l_tax] AS features FROM lineitem""")
def q_split_text(spark, d):
    """comma text -> array<double> (the scoring input format)."""
    li = table(spark, d, "lineitem")
    txt = F.concat_ws(",", *[F.col(c).cast("string") for c in ["l_quantity", "l_discount", "l_tax"]])
    return li.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                     S.split_to_doubles(txt).alias("features"))


@register("truncated_means", """
SELECT o_orderpriority, CAST(trunc(avg(o_totalprice)) AS BIGINT) AS mean_int,
       round(abs(min(o_totalprice) - max(o_totalprice)), 6) AS spread FROM orders GROUP BY 1""")
def q_trunc(spark, d):
    """F8: int(mean) truncates toward zero; abs, min, max."""
    o = table(spark, d, "orders")
    return o.groupBy("o_orderpriority").agg(
        S.trunc_int(F.avg("o_totalprice")).alias("mean_int"),
        r6(F.abs(F.min("o_totalprice") - F.max("o_totalprice"))).alias("spread"))


# ---------------------------------------------------------------- M

def _mode_sql(col: str) -> str:
    return (f"(SELECT {col} FROM gappy WHERE {col} IS NOT NULL GROUP BY {col} "
            f"ORDER BY count(*) DESC, {col} LIMIT 1)")


@register("drop_sparse_columns", f"""
WITH {GAPPY_LINEITEM_SQL.strip()}
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, qty, tax, status, flag, line FROM gappy""")
def q_m1(spark, d):
    """M1: null share > 0.5 -> dropped (disc 55 %, price 75 %, empty_col)."""
    return M.drop_sparse_columns(gappy_lineitem(spark, d), 0.5)


@register("drop_by_null_count", f"""
WITH {GAPPY_LINEITEM_SQL.strip()}
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, qty, disc, tax, status, flag, line FROM gappy""")
def q_m2(spark, d):
    """M2: null count > 0.6 n -> dropped."""
    return M.drop_by_null_count(gappy_lineitem(spark, d), 0.6)


@register("drop_empty_columns", f"""
WITH {GAPPY_LINEITEM_SQL.strip()}
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, qty, disc, tax, price, status, flag, line FROM gappy""")
def q_m3(spark, d):
    """M3: all-null columns dropped."""
    return M.drop_empty_columns(gappy_lineitem(spark, d))


def _roles_sql() -> str:
    numeric = {"l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "qty", "disc", "tax", "price", "line",
               "empty_col"}
    rows = []
    for c in GAPPY_COLS:
        isnum = "TRUE" if c in numeric else "FALSE"
        rows.append(f"SELECT '{c}' AS column, count(DISTINCT {c}) AS n_unique, {isnum} AS isnum FROM gappy")
    return (f"WITH {GAPPY_LINEITEM_SQL.strip()}, u AS ({' UNION ALL '.join(rows)}) "
            "SELECT \"column\", n_unique, CASE WHEN n_unique < 9 THEN 'categorical' WHEN isnum THEN 'numerical' "
            "ELSE 'other' END AS role FROM u")


@register("column_roles", _roles_sql())
def q_m4(spark, d):
    """M4: categorical if fewer than 9 distinct values, else numerical when numeric."""
    return M.column_roles(gappy_lineitem(spark, d), 9)


@register("column_roles_sketch", f"SELECT \"column\", role FROM ({_roles_sql()})")
def q_m4_sketch(spark, d):
    """M4 in one pass without unpivot: sets that stop growing, instead of full distinct counts."""
    return M.quick_roles(gappy_lineitem(spark, d), 9)


@register("tiered_impute", f"""
WITH {GAPPY_LINEITEM_SQL.strip()}
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, qty, disc,
  COALESCE(tax, (SELECT quantile_cont(tax, 0.5) FROM gappy)) AS tax, price,
  COALESCE(status, {_mode_sql('status')}) AS status, flag,
  COALESCE(line, {_mode_sql('line')}) AS line, empty_col FROM gappy""")
def q_m5(spark, d):
    """M5: roles from M4; share < 5 %: median (numerical) / mode (categorical)."""
    g = gappy_lineitem(spark, d)
    roles = M.roles_dict(g, 9)
    return M.fit_tiered_impute(g, roles["categorical"], roles["numerical"], 0.05).transform(g)


def _mean_mode_sql(trunc: bool) -> str:
    def num(c, cast_double=False):
        m = f"(SELECT avg({c}) FROM gappy)"
        if trunc:
            m = f"trunc({m})"
        x = f"CAST({c} AS DOUBLE)" if cast_double else c
        return f"COALESCE({x}, {m}) AS {c}"
    cols = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    sel = cols + [num("qty"), num("disc"), num("tax"), num("price"),
                  f"COALESCE(status, {_mode_sql('status')}) AS status", "flag",
                  (f"COALESCE(line, CAST(trunc((SELECT avg(line) FROM gappy)) AS INTEGER)) AS line" if trunc
                   else num("line", cast_double=True))]
    return f"WITH {GAPPY_LINEITEM_SQL.strip()} SELECT {', '.join(sel)} FROM gappy"


@register("mean_trunc_mode_impute", _mean_mode_sql(True))
def q_m6(spark, d):
    """M6: int(mean) for numeric, mode for text."""
    g = gappy_lineitem(spark, d).drop("empty_col")
    return M.fit_mean_mode(g, truncate=True).transform(g)


@register("mean_mode_impute", _mean_mode_sql(False))
def q_m7(spark, d):
    """M7: mean (integral columns become double), mode for text."""
    g = gappy_lineitem(spark, d).drop("empty_col")
    return M.fit_mean_mode(g, truncate=False).transform(g)


@register("strategy_impute", f"""
WITH {GAPPY_LINEITEM_SQL.strip()}
SELECT l_orderkey, l_linenumber, l_partkey,
  COALESCE(qty, (SELECT quantile_cont(qty, 0.5) FROM gappy)) AS qty,
  COALESCE(disc, 100.0) AS disc,
  COALESCE(tax, (SELECT min(tax) FROM gappy)) AS tax FROM gappy""")
def q_m8(spark, d):
    """M8 + UD1: median / constant / user function given the fitted stats."""
    g = gappy_lineitem(spark, d).select("l_orderkey", "l_linenumber", "l_partkey", "qty", "disc", "tax")
    strategy = {"qty": "median", "disc": "constant",
                "tax": lambda col, st: F.coalesce(col, F.lit(st["min"])), "absent": "median"}
    return M.fit_strategy(g, strategy, constant_value=100).transform(g)


# ---------------------------------------------------------------- X

def _outlier_sql(kind: str) -> str:
    keys = "l_orderkey, l_linenumber, l_partkey, l_suppkey"
    stats = ", ".join(
        f"avg({c}) AS m_{c}, stddev_pop({c}) AS sp_{c}, stddev_samp({c}) AS ss_{c}, "
        f"quantile_cont({c}, 0.5) AS md_{c}, quantile_cont({c}, 0.25) AS q1_{c}, quantile_cont({c}, 0.75) AS q3_{c}"
        for c in LI_NUM)
    exprs = []
    for c in LI_NUM:
        if kind == "z_median":
            e = f"CASE WHEN sp_{c} > 0 AND abs(({c} - m_{c}) / sp_{c}) < 3 THEN {c} ELSE md_{c} END"
        elif kind == "iqr_median":
            e = (f"CASE WHEN {c} >= q1_{c} - 1.5 * (q3_{c} - q1_{c}) AND {c} <= q3_{c} + 1.5 * (q3_{c} - q1_{c}) "
                 f"THEN {c} ELSE md_{c} END")
        elif kind == "z_null":
            e = f"CASE WHEN ss_{c} > 0 AND abs(({c} - m_{c}) / ss_{c}) > 2 THEN NULL ELSE {c} END"
        else:
            e = (f"CASE WHEN q3_{c} - q1_{c} <> 0 AND ({c} < q1_{c} - 1.0 * (q3_{c} - q1_{c}) OR "
                 f"{c} > q3_{c} + 1.0 * (q3_{c} - q1_{c})) THEN NULL ELSE {c} END")
        exprs.append(f"round({e}, 6) AS {c}")
    return f"WITH s AS (SELECT {stats} FROM lineitem) SELECT {keys}, {', '.join(exprs)} FROM lineitem, s"


def _li_num(spark, d):
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", *LI_NUM)


@register("zscore_to_median", _outlier_sql("z_median"))
def q_x1(spark, d):
    """|z| (population std) >= 3 -> median."""
    return _rounded(X.clip_to_median(_li_num(spark, d), LI_NUM, "zscore", 3.0), LI_NUM)


@register("iqr_to_median", _outlier_sql("iqr_median"))
def q_x2(spark, d):
    """Outside [Q1 - 1.5 IQR, Q3 + 1.5 IQR] -> median."""
    return _rounded(X.clip_to_median(_li_num(spark, d), LI_NUM, "iqr"), LI_NUM)


@register("zscore_to_null", _outlier_sql("z_null"))
def q_x4(spark, d):
    """|z| (sample std) > 2 -> null."""
    return _rounded(X.clean_outliers(_li_num(spark, d), LI_NUM, "zscore", 2.0), LI_NUM)


@register("iqr_to_null", _outlier_sql("iqr_null"))
def q_x5(spark, d):
    """Outside 1.0 IQR -> null."""
    return _rounded(X.clean_outliers(_li_num(spark, d), LI_NUM, "iqr"), LI_NUM)


def _report_sql() -> str:
    rows = []
    for c in LI_NUM:
        rows.append(
            f"SELECT '{c}' AS Column, round(avg(o.{c}), 6) AS Original_Mean, round(avg(k.{c}), 6) AS Cleaned_Mean, "
            f"round(stddev_samp(o.{c}), 6) AS Original_Std, round(stddev_samp(k.{c}), 6) AS Cleaned_Std, "
            f"count(*) - count(k.{c}) AS Points_Modified FROM cleaned k POSITIONAL JOIN lineitem o")
    clean = _outlier_sql("z_null").split(" SELECT ", 1)
    return (f"{clean[0]}, cleaned AS (SELECT {clean[1]}) " + " UNION ALL ".join(rows))


@register("outlier_report", _report_sql())
def q_x6(spark, d):
    """Means / sample stds before and after z-score cleaning, points modified."""
    li = _li_num(spark, d)
    rep = X.outlier_report(li.select(*LI_NUM), X.clean_outliers(li, LI_NUM, "zscore", 2.0).select(*LI_NUM))
    return _rounded(rep, ["Original_Mean", "Cleaned_Mean", "Original_Std", "Cleaned_Std"])


# ---------------------------------------------------------------- M10

# The part types in the order of their codes.
PART_TYPES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]
PART_CODES = ["size", "brand", "kind", "band"]


def coded_parts(spark, d):
    """``part`` as four coded columns with gaps of known shares."""
    p, k = table(spark, d, "part"), F.col("p_partkey")
    kind = F.array_position(F.array(*[F.lit(t) for t in PART_TYPES]), F.col("p_type")) - 1
    return p.select("p_partkey", F.when(k % 7 != 0, F.col("p_size")).cast("double").alias("size"),
                    F.when(k % 5 != 1, F.substring("p_brand", 7, 3).cast("int")).cast("double").alias("brand"),
                    F.when(k % 11 > 2, kind).cast("double").alias("kind"),
                    F.when(k % 35 != 21, F.floor("p_retailprice") % 4).cast("double").alias("band"))


CODED_PARTS_SQL = f"""coded AS (
  SELECT p_partkey, CAST(CASE WHEN p_partkey % 7 <> 0 THEN p_size END AS DOUBLE) AS size,
    CAST(CASE WHEN p_partkey % 5 <> 1 THEN CAST(substr(p_brand, 7, 3) AS INTEGER) END AS DOUBLE) AS brand,
    CAST(CASE WHEN p_partkey % 11 > 2 THEN list_position({PART_TYPES!r}, p_type) - 1 END AS DOUBLE) AS kind,
    CAST(CASE WHEN p_partkey % 35 <> 21 THEN CAST(floor(p_retailprice) AS BIGINT) % 4 END AS DOUBLE) AS band FROM part)"""


def _knn_sql(k: int) -> str:
    both = " + ".join(f"CAST(r.{c} IS NOT NULL AND d.{c} IS NOT NULL AS INTEGER)" for c in PART_CODES)
    squares = " + ".join(f"coalesce((r.{c} - d.{c}) * (r.{c} - d.{c}), 0.0)" for c in PART_CODES)
    pairs = " UNION ALL ".join(
        f"SELECT r.p_partkey, '{c}' AS col, 4.0 * ({squares}) / ({both}) AS d2, d.{c} AS v FROM coded r, coded d "
        f"WHERE r.{c} IS NULL AND d.{c} IS NOT NULL AND ({both}) > 0" for c in PART_CODES)
    fill = ", ".join(f"round(coalesce(c.{c}, max(v) FILTER (WHERE col = '{c}'), (SELECT avg({c}) FROM coded)), 6) AS {c}" for c in PART_CODES)
    return f"""WITH {CODED_PARTS_SQL},
pairs AS ({pairs}),
rings AS (SELECT p_partkey, col, d2, count(*) AS n, avg(v) AS v FROM pairs GROUP BY 1, 2, 3),
shares AS (SELECT *, least(n, greatest({k} - (sum(n) OVER (PARTITION BY p_partkey, col ORDER BY d2) - n), 0)) AS w FROM rings),
vals AS (SELECT p_partkey, col, sum(v * w) / sum(w) AS v FROM shares WHERE w > 0 GROUP BY 1, 2)
SELECT c.p_partkey, {fill} FROM coded c LEFT JOIN vals x ON x.p_partkey = c.p_partkey
GROUP BY c.p_partkey, {', '.join('c.' + c for c in PART_CODES)}"""


@register("knn_impute", _knn_sql(5))
def q_m10(spark, d):
    """Gaps of four coded columns filled by the mean of the five nearest donors."""
    return _rounded(KN.nearest_fill(coded_parts(spark, d), PART_CODES, 5), PART_CODES)


_LINE_CODES = ["line", "tax", "status"]


@register("knn_impute_dense", f"""WITH {GAPPY_LINEITEM_SQL.strip()},
coded AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(line AS DOUBLE) AS line, round(tax * 100) AS tax,
  CAST(CASE status WHEN 'F' THEN 0 WHEN 'O' THEN 1 END AS DOUBLE) AS status FROM gappy),
prof AS (SELECT line, tax, status, count(*) AS n FROM coded GROUP BY 1, 2, 3),
pairs AS (""" + " UNION ALL ".join(
    f"SELECT r.line, r.tax, r.status, '{c}' AS col, d.n, d.{c} AS v, 3.0 * (" + " + ".join(
        f"coalesce((r.{x} - d.{x}) * (r.{x} - d.{x}), 0.0)" for x in _LINE_CODES) + ") / nullif(" + " + ".join(
        f"CAST(r.{x} IS NOT NULL AND d.{x} IS NOT NULL AS INTEGER)" for x in _LINE_CODES)
    + f", 0) AS d2 FROM prof r, prof d WHERE r.{c} IS NULL AND d.{c} IS NOT NULL" for c in _LINE_CODES) + """),
rings AS (SELECT line, tax, status, col, d2, sum(n) AS n, sum(v * n) / sum(n) AS v FROM pairs WHERE d2 IS NOT NULL GROUP BY 1, 2, 3, 4, 5),
shares AS (SELECT *, least(n, greatest(5 - (sum(n) OVER (PARTITION BY line, tax, status, col ORDER BY d2) - n), 0)) AS w FROM rings),
vals AS (SELECT line, tax, status, """ + ", ".join(
    f"sum(v * w) FILTER (WHERE col = '{c}') / sum(w) FILTER (WHERE col = '{c}') AS new_{c}" for c in _LINE_CODES) + """
  FROM shares WHERE w > 0 GROUP BY 1, 2, 3)
SELECT c.l_orderkey, c.l_linenumber, c.l_partkey, c.l_suppkey, """ + ", ".join(
    f"round(coalesce(c.{c}, new_{c}, (SELECT avg({c}) FROM coded)), 6) AS {c}" for c in _LINE_CODES) + """
FROM coded c LEFT JOIN vals v ON """ + " AND ".join(f"c.{c} IS NOT DISTINCT FROM v.{c}" for c in _LINE_CODES))
def q_m10_dense(spark, d):
    """M10 on many rows of few profiles: a profile is searched for once, however many rows have it."""
    g = gappy_lineitem(spark, d)
    coded = g.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.col("line").cast("double").alias("line"),
                     F.round(F.col("tax") * 100).alias("tax"),
                     F.when(F.col("status") == "F", 0.0).when(F.col("status") == "O", 1.0).alias("status"))
    return _rounded(KN.nearest_fill(coded, _LINE_CODES, 5), _LINE_CODES)
