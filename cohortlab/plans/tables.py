"""Loading the test tables and the shared derived views.

The reference's clinical tables map onto the test tables like this:
participants = ``customer``, demographics = ``nation``/``region``,
biospecimen visits = ``orders`` (status 'F' is the baseline event), the
five motor assessments = ``events`` split by ``event_type``. The tables
have no gaps, so gaps are injected by fixed rules, identically in Spark
and in the oracle SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


# The five event types in name order (one motor table each).
EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]
# The segments that count as valid statuses.
VALID_SEGMENTS = ["AUTOMOBILE", "BUILDING", "MACHINERY"]


def gappy_lineitem(spark: SparkSession, d: str) -> DataFrame:
    """``lineitem`` with injected nulls of known shares per column."""
    l = table(spark, d, "lineitem")
    c = F.col
    return l.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        F.when((c("l_orderkey") + c("l_linenumber")) % 13 == 0, None).otherwise(c("l_quantity")).alias("qty"),
        F.when(c("l_partkey") % 20 < 11, None).otherwise(c("l_discount")).alias("disc"),
        F.when(c("l_suppkey") % 50 == 0, None).otherwise(c("l_tax")).alias("tax"),
        F.when(c("l_orderkey") % 4 != 0, None).otherwise(c("l_extendedprice")).alias("price"),
        F.when(c("l_orderkey") % 37 == 0, None).otherwise(c("l_linestatus")).alias("status"),
        c("l_returnflag").alias("flag"),
        F.when(c("l_partkey") % 41 == 0, None).otherwise(c("l_linenumber")).alias("line"),
        F.lit(None).cast("double").alias("empty_col"),
    )


GAPPY_LINEITEM_SQL = """
gappy AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
    CASE WHEN (l_orderkey + l_linenumber) % 13 = 0 THEN NULL ELSE l_quantity END AS qty,
    CASE WHEN l_partkey % 20 < 11 THEN NULL ELSE l_discount END AS disc,
    CASE WHEN l_suppkey % 50 = 0 THEN NULL ELSE l_tax END AS tax,
    CASE WHEN l_orderkey % 4 <> 0 THEN NULL ELSE l_extendedprice END AS price,
    CASE WHEN l_orderkey % 37 = 0 THEN NULL ELSE l_linestatus END AS status,
    l_returnflag AS flag,
    CASE WHEN l_partkey % 41 = 0 THEN NULL ELSE l_linenumber END AS line,
    CAST(NULL AS DOUBLE) AS empty_col
  FROM lineitem)"""


def cohort_people(spark: SparkSession, d: str) -> DataFrame:
    """Participants: one row per customer with an "age" in [30, 85) peaking near 57 derived from
    the balance and the segment as cohort label."""
    c = table(spark, d, "customer")
    age = (F.lit(30.0) + (F.col("c_acctbal") + 1000.0) * 40.0 / 11000.0
           + (F.col("c_custkey") % 11).cast("double") * 1.5)
    return c.select("c_custkey", "c_nationkey", "c_mktsegment", age.alias("age"))


COHORT_PEOPLE_SQL = """
people AS (
  SELECT c_custkey, c_nationkey, c_mktsegment,
         30.0 + (c_acctbal + 1000.0) * 40.0 / 11000.0 + CAST(c_custkey % 11 AS DOUBLE) * 1.5 AS age
  FROM customer)"""
