"""Outlier treatment, inventory IDs X1-X6.

Fit: one aggregation (mean, std, quartiles, median) over all chosen columns.
Transform: one ``select`` of ``when`` expressions.
"""

from __future__ import annotations

from typing import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlab.functions.colstats import column_stats, numeric_columns
from cohortlab.functions.quantiles import exact_quantiles
from cohortlab.session import checkpointed


def _cols(df: DataFrame, columns: Sequence[str] | None) -> list[str]:
    num = set(numeric_columns(df))
    return [c for c in (columns or numeric_columns(df)) if c in num]


def clip_to_median(df: DataFrame, columns: Sequence[str] | None = None, method: str = "zscore",
                   threshold: float = 3.0) -> DataFrame:
    """X1 (zscore, population std, keep ``|z| < threshold``) and X2 (IQR 1.5, inclusive
    bounds): values outside are replaced by the column median. As in the
    reference (NaN compares False) a null also becomes the median.
    """
    cols = _cols(df, columns)
    if not cols:
        return df
    st = column_stats(df, cols, ["mean", "std_pop"], quantiles=[0.25, 0.5, 0.75] if method == "iqr" else [0.5])
    exprs = {}
    for c in cols:
        s, x = st[c], F.col(c)
        med = s["q0.5"]
        if med is None:
            continue
        if method == "zscore":
            if not s["std_pop"]:
                keep = F.lit(False)  # scipy: z is NaN for zero spread -> replaced
            else:
                keep = F.abs((x - F.lit(s["mean"])) / F.lit(s["std_pop"])) < threshold
        elif method == "iqr":
            iqr = s["q0.75"] - s["q0.25"]
            keep = (x >= s["q0.25"] - 1.5 * iqr) & (x <= s["q0.75"] + 1.5 * iqr)
        else:
            raise ValueError(f"unknown method {method}")
        t = df.schema[c].dataType
        if t.typeName() in ("integer", "long", "short", "byte") and not float(med).is_integer():
            x, t = x.cast("double"), None  # pandas upcasts an int column receiving a .5 median
        exprs[c] = F.when(F.coalesce(keep, F.lit(False)), x).otherwise(F.lit(med) if t is None else F.lit(med).cast(t))
    return df.withColumns(exprs)


def clean_outliers(df: DataFrame, columns: Sequence[str] | None = None, method: str = "zscore",
                   threshold: float = 2.0) -> DataFrame:
    """X4 (zscore, sample std, ``> threshold`` -> null, skip std 0) and X5
    (IQR 1.0 -> null, skip IQR 0). Nulls stay null."""
    cols = _cols(df, columns)
    if not cols:
        return df
    st = column_stats(df, cols, ["mean", "std"], quantiles=[0.25, 0.75] if method == "iqr" else [])
    exprs = {}
    for c in cols:
        s, x = st[c], F.col(c)
        if method == "zscore":
            if not s["std"]:
                continue
            bad = F.abs((x - F.lit(s["mean"])) / F.lit(s["std"])) > threshold
        elif method == "iqr":
            if s["q0.25"] is None:
                continue
            iqr = s["q0.75"] - s["q0.25"]
            if iqr == 0:
                continue
            bad = (x < s["q0.25"] - 1.0 * iqr) | (x > s["q0.75"] + 1.0 * iqr)
        else:
            raise ValueError(f"unknown method {method}")
        exprs[c] = F.when(bad, F.lit(None)).otherwise(x)
    return df.withColumns(exprs) if exprs else df


def outlier_report(original: DataFrame, cleaned: DataFrame, key: str | None = None) -> DataFrame:
    """Per numeric column: means and sample stds before/after, and
    ``Points_Modified`` = all nulls after cleaning (original ones included).

    Two one-pass aggregations, stacked to one row per column.
    """
    cols = [c for c in numeric_columns(original) if c != key]
    before = original.agg(*[F.avg(c).alias(f"m{i}") for i, c in enumerate(cols)],
                          *[F.stddev_samp(c).alias(f"s{i}") for i, c in enumerate(cols)])
    after = cleaned.agg(*[F.avg(c).alias(f"m{i}") for i, c in enumerate(cols)],
                        *[F.stddev_samp(c).alias(f"s{i}") for i, c in enumerate(cols)],
                        *[F.count(F.when(F.col(c).isNull(), 1)).alias(f"z{i}") for i, c in enumerate(cols)])
    b, a = before.first(), after.first()
    rows = [(c, b[f"m{i}"], a[f"m{i}"], b[f"s{i}"], a[f"s{i}"], a[f"z{i}"]) for i, c in enumerate(cols)]
    return original.sparkSession.createDataFrame(
        rows, "Column string, Original_Mean double, Cleaned_Mean double, Original_Std double, "
              "Cleaned_Std double, Points_Modified long")


def hash_threshold(n: int, sample_size: int) -> int:
    """Share of the 63-bit hash range that draws about 1.5 * sample_size of n rows.

    Integer arithmetic over the full range: never zero, however large n is."""
    return min(2 ** 63 - 1, max(1, 3 * sample_size * 2 ** 63 // (2 * n)))


def step_function(tree, c_factor) -> tuple[np.ndarray, np.ndarray]:
    """A tree on one column as sorted split points and the path length between them."""
    cuts: list[float] = []
    lengths: list[float] = []

    def walk(node, depth):
        if node[0] == "leaf":
            lengths.append(depth + c_factor(node[1]))
        else:
            walk(node[2], depth + 1)
            cuts.append(node[1])
            walk(node[3], depth + 1)

    walk(tree, 0)
    return np.array(cuts), np.array(lengths)


def mean_steps(trees: Sequence[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """The mean of step functions as one step function, so a value is looked up once instead of once a tree."""
    cuts = np.unique(np.concatenate([c for c, _ in trees])) if trees else np.zeros(0)
    at = np.concatenate([[-np.inf], cuts])
    return cuts, sum(lengths[np.searchsorted(own, at, side="right")] for own, lengths in trees) / max(1, len(trees))


def isolation_scores(df: DataFrame, column: str, n_trees: int = 100, sample_size: int = 256,
                     seed: int = 42) -> DataFrame:
    """X3 support: isolation-forest anomaly score of one numeric column, as ``__score``."""
    return df.withColumn("__score", isolation_scorer(df, column, n_trees, sample_size, seed))


def isolation_scorer(df: DataFrame, column: str, n_trees: int = 100, sample_size: int = 256, seed: int = 42) -> Column:
    """The score of a column as an expression over its values.

    Trees are grown on the driver from ``n_trees`` hash-samples of at most
    ``sample_size`` values each (a bounded ``n_trees * sample_size`` rows,
    the algorithm's own sub-sampling, Liu et al. 2008), broadcast, and every
    row is scored in a vectorised pandas UDF.
    """
    spark = df.sparkSession
    x = F.col(column).cast("double")
    n = df.where(x.isNotNull()).count()
    if n == 0:
        return F.lit(None).cast("double")
    # One pass for all trees, one hash a row: trees own arcs of a circle, each long enough for about 1.5 * sample_size
    # of the n rows, and a row joins the trees whose arcs cover its place. Per tree the smallest of other hashes are kept.
    # Hashes cover the whole row: equal rows are drawn together, equal values of different rows one by one.
    width = hash_threshold(n, sample_size) / 2 ** 63 * n_trees
    place = F.shiftrightunsigned(F.xxhash64("row", F.lit(seed)), 1).cast("double") / F.lit(2.0 ** 63) * n_trees
    first = F.greatest(F.floor(F.col("place") - F.lit(width)) + 1, F.floor("place") - F.lit(n_trees - 1))
    picked = (df.where(x.isNotNull()).select(x.alias("v"), F.xxhash64(*df.columns).alias("row")).withColumn("place", place)
              .where(first <= F.floor("place"))
              .withColumn("t", F.explode(F.sequence(first, F.floor("place")))).withColumn("t", F.pmod("t", F.lit(n_trees)))
              .withColumn("h", F.xxhash64("row", F.lit(seed) + F.col("t"))))
    from pyspark.sql import Window
    w = Window.partitionBy("t").orderBy("h")
    picked = picked.withColumn("r", F.row_number().over(w)).where(F.col("r") <= sample_size)
    trees_src = [[] for _ in range(n_trees)]
    for r in picked.select("t", "v").collect():  # bounded: n_trees * sample_size rows
        trees_src[r["t"]].append(r["v"])
    rng = np.random.default_rng(seed)

    def grow(vals, depth, limit):
        if depth >= limit or len(vals) <= 1 or vals.min() == vals.max():
            return ("leaf", len(vals))
        split = rng.uniform(vals.min(), vals.max())
        return ("node", split, grow(vals[vals < split], depth + 1, limit),
                grow(vals[vals >= split], depth + 1, limit))

    def c_factor(m):
        if m <= 1:
            return 0.0
        return 2.0 * (np.log(m - 1) + 0.5772156649) - 2.0 * (m - 1) / m

    forest = []
    for vals in trees_src:
        arr = np.asarray(vals, dtype=float)
        forest.append(grow(arr, 0, int(np.ceil(np.log2(max(len(arr), 2))))))
    psi = min(sample_size, n)
    bc = spark.sparkContext.broadcast((mean_steps([step_function(t, c_factor) for t in forest]), c_factor(psi)))

    @F.pandas_udf("double")
    def score(v: pd.Series) -> pd.Series:
        (cuts, lengths), cn = bc.value
        vals = v.to_numpy(dtype=float, na_value=np.nan)
        h = lengths[np.searchsorted(cuts, vals, side="right")]
        return pd.Series(np.where(np.isnan(vals), np.nan, 2.0 ** (-h / cn) if cn > 0 else 0.5))

    return score(x)


def isolation_forest_to_median(df: DataFrame, columns: Sequence[str], contamination: float = 0.1,
                               **kw) -> DataFrame:
    """Per column, the top ``contamination`` share of isolation scores is
    replaced by the median. Columns do not depend on each other: all are scored from the input in one select, whose scores
    are written once, as the search for the cuts reads them several times."""
    columns = list(columns)
    if not columns:
        return df
    scores = {c: isolation_scorer(df, c, **kw) for c in columns}
    written = checkpointed(df.select(*[F.col(f"`{c}`").cast("double").alias(f"v{i}") for i, c in enumerate(columns)],
                                     *[scores[c].alias(f"s{i}") for i, c in enumerate(columns)]))
    found = exact_quantiles(written, {**{f"s{i}": [1 - contamination] for i in range(len(columns))}, **{f"v{i}": [0.5] for i in range(len(columns))}})
    new = {}
    for i, c in enumerate(columns):
        cut, med = found[f"s{i}"][1 - contamination], found[f"v{i}"][0.5]
        new[c] = F.when(scores[c] > F.lit(cut), F.lit(med).cast(df.schema[c].dataType)).otherwise(F.col(f"`{c}`"))
    return df.withColumns(new)
