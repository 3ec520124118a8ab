"""Descriptive statistics, inventory IDs T1-T9. All outputs are long tables
(one row per column or per bin). Quantiles are searched for when the operator
is called, in a few passes; the rest is lazy."""

from __future__ import annotations

from functools import reduce
from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlab.functions.colstats import column_stats, numeric_columns
from cohortlab.operators.gram import pearson
from cohortlab.operators.relational import to_long
from cohortlab.session import bounded_broadcast

# Columns whose pairs are written out as expressions: 276 pairs.
NARROW = 24


def describe(df: DataFrame, cols: Sequence[str] | None = None, exact: bool = True) -> DataFrame:
    """``(column, count, mean, std, min, p25, p50, p75, max)`` per numeric
    column; std is the sample std, quantiles interpolate linearly."""
    cols = list(cols or numeric_columns(df))
    st = column_stats(df, cols, ["count", "mean", "std", "min", "max"], [0.25, 0.5, 0.75], exact)
    number = lambda v: None if v is None else float(v)
    rows = [(c, st[c]["count"], *[number(st[c][k]) for k in ("mean", "std", "min", "q0.25", "q0.5", "q0.75", "max")])
            for c in cols]
    return df.sparkSession.createDataFrame(rows, "column string, count long, mean double, std double, min double, "
                                                 "p25 double, p50 double, p75 double, max double")


def mode_table(df: DataFrame, cols: Sequence[str], value_type: str = "double") -> DataFrame:
    """First mode per column as a table ``(column, mode)``: max count, then smallest value."""
    counts = (to_long(df, cols, value_type).where(F.col("value").isNotNull())
              .groupBy("column", "value").agg(F.count(F.lit(1)).alias("n")))
    return counts.groupBy("column").agg(
        F.min_by("value", F.struct((-F.col("n")).alias("k"), F.col("value"))).alias("mode"))


def describe_plus(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """T1 plus ``median`` and first ``mode``."""
    cols = list(cols or numeric_columns(df))
    d = describe(df, cols)
    m = mode_table(df, cols)
    return d.join(m, "column", "left").withColumn("median", F.col("p50"))


def center_table(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """``(column, mean, median, mode)``."""
    return describe_plus(df, cols).select("column", "mean", "median", "mode")


def correlation_long(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Pearson r for every pair (nulls skipped per pair), long
    ``(a, b, i, j, r)``; the diagonal is 1. One pass: up to ``NARROW`` columns as expressions, beyond that, where there
    would be hundreds of them and more, by the Gram matrix (after a pass for the means)."""
    cols = list(cols or numeric_columns(df))
    if len(cols) > NARROW:
        names = F.array(*[F.lit(c) for c in cols])
        r = F.when(F.col("i") == F.col("j"), F.lit(1.0)).otherwise(F.col("r"))
        return pearson(df, cols).select(F.get(names, F.col("i")).alias("a"), F.get(names, F.col("j")).alias("b"), "i", "j", r.alias("r"))
    aggs = [F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"r{i}_{j}")
            for i, a in enumerate(cols) for j, b in enumerate(cols) if i < j]
    wide = df.agg(*aggs) if aggs else df.limit(1).select()
    items = []
    for i, a in enumerate(cols):
        for j, b in enumerate(cols):
            if i == j:
                r = F.lit(1.0)
            else:
                r = F.col(f"r{min(i, j)}_{max(i, j)}")
            items.append(F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"),
                                  F.lit(i).alias("i"), F.lit(j).alias("j"), r.alias("r")))
    return wide.select(F.inline(F.array(*items)))


def _ranges(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    aggs = [F.struct(F.lit(c).alias("column"), F.min(F.col(c).cast("double")).alias("lo"),
                     F.max(F.col(c).cast("double")).alias("hi"),
                     F.count(F.col(c)).alias("n")) for c in cols]
    return df.agg(F.array(*aggs).alias("a")).select(F.inline("a"))


def histogram(df: DataFrame, cols: Sequence[str] | None = None, bins: int = 20) -> DataFrame:
    """T4: ``(column, bin, lo, hi, count)`` with ``bins`` equal-width bins between
    min and max; the last bin is right-closed. Empty bins count 0."""
    cols = list(cols or numeric_columns(df))
    rng = bounded_broadcast(_ranges(df, cols), 100_000)  # one row per column
    long = to_long(df, cols, "double").where(F.col("value").isNotNull())
    j = long.join(rng, "column")
    width = (F.col("hi") - F.col("lo")) / bins
    b = F.when(F.col("hi") == F.col("lo"), F.lit(0)).otherwise(
        F.least(F.floor((F.col("value") - F.col("lo")) / width).cast("int"), F.lit(bins - 1)))
    counts = j.withColumn("bin", b).groupBy("column", "bin").agg(F.count(F.lit(1)).alias("count"))
    last = F.when(F.col("hi") == F.col("lo"), F.lit(0)).otherwise(F.lit(bins - 1))
    every = rng.where("n > 0").select("column", "lo", "hi", F.explode(F.sequence(F.lit(0), last)).alias("bin"))
    return (every.join(counts, ["column", "bin"], "left").fillna(0, ["count"])
             .select("column", "bin",
                     (F.col("lo") + F.col("bin") * (F.col("hi") - F.col("lo")) / bins).alias("bin_lo"),
                     (F.col("lo") + (F.col("bin") + 1) * (F.col("hi") - F.col("lo")) / bins).alias("bin_hi"),
                     "count"))


def box_stats(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """T5: quartiles, 1.5 IQR whiskers (most extreme data inside the fences)
    and the number of points outside, per column."""
    cols = list(cols or numeric_columns(df))
    d = describe(df, cols).select("column", "p25", "p50", "p75")
    d = bounded_broadcast(d, 100_000)
    long = to_long(df, cols, "double").where(F.col("value").isNotNull()).join(d, "column")
    iqr = F.col("p75") - F.col("p25")
    lo_f, hi_f = F.col("p25") - 1.5 * iqr, F.col("p75") + 1.5 * iqr
    inside = (F.col("value") >= lo_f) & (F.col("value") <= hi_f)
    return long.groupBy("column", "p25", "p50", "p75").agg(
        F.min(F.when(inside, F.col("value"))).alias("whisker_lo"),
        F.max(F.when(inside, F.col("value"))).alias("whisker_hi"),
        F.count(F.when(~inside, 1)).alias("n_outliers"))


def table_info(df: DataFrame) -> DataFrame:
    """``(position, column, dtype, non_null)``."""
    aggs = [F.count(F.col(c)).alias(f"n{i}") for i, c in enumerate(df.columns)]
    wide = df.agg(*aggs)
    arr = F.array(*[F.struct(F.lit(i).alias("position"), F.lit(c).alias("column"),
                             F.lit(df.schema[c].dataType.simpleString()).alias("dtype"),
                             F.col(f"n{i}").alias("non_null")) for i, c in enumerate(df.columns)])
    return wide.select(F.inline(arr))


def kde(df: DataFrame, col: str, grid: int = 200, group: int = 20) -> DataFrame:
    """Gaussian kernel density on ``grid`` points spanning [min, max],
    bandwidth by Scott's rule ``h = std * n^(-1/5)``. Output ``(i, x, density)``.

    Values are counted per distinct value first. The sums of all points are
    aggregates over that one table, ``group`` of them in each aggregation so
    that the generated code stays small: no value x grid rows, every point
    comes back, no tail is cut. A constant column has one point, of density null
    (no bandwidth); a column without values has none.
    """
    x = F.col(col).cast("double")
    s = df.agg(F.min(x).alias("lo"), F.max(x).alias("hi"), F.count(x).alias("n"), F.stddev_samp(x).alias("sd")).first()
    out = "i int, x double, density double"
    if not s["n"]:
        return df.sparkSession.createDataFrame([], out)
    if not s["sd"]:
        return df.sparkSession.createDataFrame([(0, s["lo"], None)], out)
    h, step = s["sd"] * s["n"] ** -0.2, (s["hi"] - s["lo"]) / (grid - 1)
    norm = s["n"] * h * (2 * 3.141592653589793) ** 0.5
    vals = df.where(x.isNotNull()).groupBy(x.alias("v")).agg(F.count(F.lit(1)).alias("c"))

    def point(i):
        z = (F.lit(s["lo"] + i * step) - F.col("v")) / F.lit(h)
        return F.struct(F.lit(i).alias("i"), F.lit(s["lo"] + i * step).alias("x"),
                        (F.sum(F.col("c") * F.exp(-0.5 * z * z)) / F.lit(norm)).alias("density"))

    parts = [vals.agg(F.array(*[point(i) for i in range(at, min(grid, at + group))]).alias("a")).select(F.inline("a"))
             for at in range(0, grid, group)]
    return reduce(DataFrame.unionAll, parts)
