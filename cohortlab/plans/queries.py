"""Registered queries: one per operator of the inventory, each with the
equivalent DuckDB SQL where one exists. Every query reads whole tables.

Doubles are rounded to 6 decimals on both sides (summation order differs).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlab.operators import relational as R
from cohortlab.plans.tables import (COHORT_PEOPLE_SQL, EVENT_TYPES, GAPPY_LINEITEM_SQL, VALID_SEGMENTS,
                                    cohort_people, gappy_lineitem, table)

QUERIES: dict = {}
ORACLE: dict = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return deco


def r6(c):
    return F.round(F.col(c) if isinstance(c, str) else c, 6)


def _seg_list_sql() -> str:
    return ", ".join(f"'{s}'" for s in VALID_SEGMENTS)


# ---------------------------------------------------------------- W1, J1-J3

def earliest_baseline_orders(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders")
    bl = R.keep_equal(o, "o_orderstatus", "F")
    return R.earliest_per_key(bl, "o_custkey", ["o_orderdate", "o_orderkey"]).select(
        "o_custkey", "o_orderkey", "o_orderdate", "o_totalprice")


EARLIEST_SQL = """
SELECT o_custkey, o_orderkey, o_orderdate, o_totalprice FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate NULLS LAST, o_orderkey) AS rn
  FROM orders WHERE o_orderstatus = 'F') WHERE rn = 1"""


@register("earliest_row_per_key", EARLIEST_SQL)
def q_earliest(spark, d):
    """W1 + P4: earliest baseline ('F') order per customer."""
    return earliest_baseline_orders(spark, d)


def motor_tables(spark: SparkSession, d: str) -> list[DataFrame]:
    ev = table(spark, d, "events")
    out = []
    for e in EVENT_TYPES:
        t = R.keep_equal(ev, "event_type", e)
        t = R.earliest_per_key(t, "user_id", ["ts", "event_id"])
        out.append(t.select("user_id", "event_id", "props", F.col("value").alias(f"{e}_value")))
    return out


def motor_fold(spark: SparkSession, d: str) -> DataFrame:
    return R.full_outer_fold(motor_tables(spark, d), "user_id", "_dup", one_row_per_key=True)


def _motor_fold_sql() -> str:
    parts = []
    for i, e in enumerate(EVENT_TYPES):
        parts.append(f"""t{i} AS (SELECT user_id, event_id, props, value AS {e}_value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts NULLS LAST, event_id) AS rn
  FROM events WHERE event_type = '{e}') WHERE rn = 1)""")
    joins = "t0"
    keys = ["t0.user_id"]
    for i in range(1, len(EVENT_TYPES)):
        joins += f" FULL OUTER JOIN t{i} ON COALESCE({', '.join(keys)}) = t{i}.user_id"
        keys.append(f"t{i}.user_id")
    vals = ", ".join(f"t{i}.{e}_value" for i, e in enumerate(EVENT_TYPES))
    sel = (f"COALESCE({', '.join(keys)}) AS user_id, t0.event_id, t0.props, "
           f"t1.event_id AS event_id_dup, t1.props AS props_dup, {vals}")
    return "WITH " + ",\n".join(parts) + f"\nSELECT {sel} FROM {joins}"


MOTOR_FOLD_SQL = _motor_fold_sql()


@register("full_outer_fold", MOTOR_FOLD_SQL)
def q_motor_fold(spark, d):
    """W1 x5 + J3 + P8: earliest event per user and type, full-outer folded."""
    return motor_fold(spark, d)


def cohort_rows(spark: SparkSession, d: str) -> DataFrame:
    """Flagship: participants x demographics (J1) filtered by status (P3),
    + earliest baseline visit (J2) + motor fold (J2): one row per participant."""
    people = cohort_people(spark, d)
    nation = table(spark, d, "nation")
    pd_ = R.inner_join_keep_keys(people, nation, "c_nationkey", "n_nationkey")
    pd_ = R.keep_in(pd_, "c_mktsegment", VALID_SEGMENTS)
    bio = earliest_baseline_orders(spark, d).select(
        "o_custkey", F.col("o_orderdate").alias("first_visit"), F.col("o_totalprice").alias("visit_price"))
    x = R.left_join_drop_right_key(pd_, bio, "c_custkey", "o_custkey")
    motor = motor_fold(spark, d).drop("event_id", "props", "event_id_dup", "props_dup")
    x = R.left_join_drop_right_key(x, motor, "c_custkey", "user_id")
    return x.select("c_custkey", "c_mktsegment", r6("age").alias("age"), "n_nationkey", "n_name", "n_regionkey",
                    "first_visit", "visit_price", *[f"{e}_value" for e in EVENT_TYPES])





def _cohort_sql() -> str:
    motor_body = MOTOR_FOLD_SQL[len("WITH "):]
    # motor CTEs, then the cohort query
    ctes, final = motor_body.rsplit("\nSELECT ", 1)
    vals = ", ".join(f"m.{e}_value" for e in EVENT_TYPES)
    return f"""WITH {ctes},
motor AS (SELECT {final}),
{COHORT_PEOPLE_SQL.strip()},
bio AS (SELECT o_custkey, o_orderdate AS first_visit, o_totalprice AS visit_price FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate NULLS LAST, o_orderkey) AS rn
  FROM orders WHERE o_orderstatus = 'F') WHERE rn = 1)
SELECT p.c_custkey, p.c_mktsegment, round(p.age, 6) AS age, n.n_nationkey, n.n_name, n.n_regionkey,
       b.first_visit, b.visit_price, {vals}
FROM people p JOIN nation n ON p.c_nationkey = n.n_nationkey
LEFT JOIN bio b ON p.c_custkey = b.o_custkey
LEFT JOIN motor m ON p.c_custkey = m.user_id
WHERE p.c_mktsegment IN ({_seg_list_sql()})"""


@register("cohort_feature_rows", _cohort_sql())
def q_cohort(spark, d):
    return cohort_rows(spark, d)


@register("inner_join_keep_keys", f"""
SELECT c.c_custkey, c.c_name, c.c_nationkey, n.n_nationkey, n.n_name, n.n_regionkey, r.r_name
FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
JOIN region r ON n.n_regionkey = r.r_regionkey
WHERE c.c_mktsegment IN ({_seg_list_sql()})""")
def q_inner_join(spark, d):
    """J1 + P3: status filter after the join (Catalyst pushes it below)."""
    c = table(spark, d, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    n = table(spark, d, "nation")
    r = table(spark, d, "region")
    j = R.inner_join_keep_keys(c, n, "c_nationkey", "n_nationkey")
    j = R.inner_join_keep_keys(j, r, "n_regionkey", "r_regionkey")
    j = R.keep_in(j, "c_mktsegment", VALID_SEGMENTS)
    return j.select("c_custkey", "c_name", "c_nationkey", "n_nationkey", "n_name", "n_regionkey", "r_name")


@register("left_join_drop_key", """
SELECT c.c_custkey, c.c_mktsegment, b.o_orderkey, b.o_totalprice FROM customer c
LEFT JOIN (SELECT o_custkey, o_orderkey, o_totalprice FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate NULLS LAST, o_orderkey) AS rn
  FROM orders WHERE o_orderstatus = 'P') WHERE rn = 1) b ON c.c_custkey = b.o_custkey""")
def q_left_join(spark, d):
    """Left join of the earliest pending order, right key dropped."""
    o = R.keep_equal(table(spark, d, "orders"), "o_orderstatus", "P")
    b = R.earliest_per_key(o, "o_custkey", ["o_orderdate", "o_orderkey"]).select(
        "o_custkey", "o_orderkey", "o_totalprice")
    c = table(spark, d, "customer").select("c_custkey", "c_mktsegment")
    return R.left_join_drop_right_key(c, b, "c_custkey", "o_custkey")


@register("inner_join_fold", """
WITH a AS (SELECT o_custkey AS k, count(*) AS n_orders, round(sum(o_totalprice), 6) AS total FROM orders GROUP BY 1),
b AS (SELECT user_id AS k, count(*) AS n_events, round(sum(value), 6) AS total FROM events GROUP BY 1),
c AS (SELECT c_custkey AS k, c_mktsegment FROM customer)
SELECT a.k, a.n_orders, a.total AS total_x, b.n_events, b.total AS total_y, c.c_mktsegment
FROM a JOIN b ON a.k = b.k JOIN c ON a.k = c.k""")
def q_inner_fold(spark, d):
    """Inner-join fold on one key; overlapping names get _x/_y."""
    o = table(spark, d, "orders").groupBy(F.col("o_custkey").alias("k")).agg(
        F.count(F.lit(1)).alias("n_orders"), r6(F.sum("o_totalprice")).alias("total"))
    e = table(spark, d, "events").groupBy(F.col("user_id").alias("k")).agg(
        F.count(F.lit(1)).alias("n_events"), r6(F.sum("value")).alias("total"))
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("k"), "c_mktsegment")
    return R.inner_fold([o, e, c], "k")


@register("rows_at_group_min", """
SELECT o.o_custkey, o.o_orderkey, o.o_orderdate FROM orders o
JOIN (SELECT o_custkey, min(o_orderdate) AS m FROM orders WHERE o_orderstatus = 'F' GROUP BY 1) g
  ON o.o_custkey = g.o_custkey AND o.o_orderdate = g.m
WHERE o.o_orderstatus = 'F'""")
def q_group_min_join(spark, d):
    """J5 + A1: baseline rows at the per-customer minimum date; ties kept."""
    o = R.keep_equal(table(spark, d, "orders"), "o_orderstatus", "F").select("o_custkey", "o_orderkey", "o_orderdate")
    return R.rows_at_group_min(o, "o_custkey", "o_orderdate")


@register("group_min", """
SELECT o_custkey, min(o_orderdate) AS min_o_orderdate FROM orders GROUP BY 1""")
def q_group_min(spark, d):
    """A1."""
    return R.group_min(table(spark, d, "orders"), "o_custkey", "o_orderdate")
