"""Missing-value operators, inventory IDs M1-M10.

Each fit is one aggregation over all columns; each transform is one
``select`` of ``coalesce`` expressions, so it also runs on a stream.
"""

from __future__ import annotations

from typing import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortlab.functions.colstats import column_stats, modes
from cohortlab.operators.relational import INTEGRAL_TYPES, NUMERIC_TYPES, distinct_counts, null_stats


def null_counts(df: DataFrame, cols: Sequence[str] | None = None) -> dict[str, int]:
    """M9 / A3: ``{column: n_null}`` (identify only)."""
    return {r["column"]: r["n_null"] for r in null_stats(df, cols).collect()}


def _null_table(df: DataFrame) -> list:
    return null_stats(df).collect()  # one row per column


def drop_sparse_columns(df: DataFrame, threshold: float = 0.5) -> DataFrame:
    """M1: drop columns whose null share is strictly greater than ``threshold``."""
    drop = [r["column"] for r in _null_table(df)
            if r["null_share"] is not None and r["null_share"] > threshold]
    return df.drop(*drop)


def drop_by_null_count(df: DataFrame, fraction: float = 0.6) -> DataFrame:
    """M2: drop columns with null count > ``fraction * n_rows``."""
    drop = [r["column"] for r in _null_table(df) if r["n_null"] > fraction * r["n_rows"]]
    return df.drop(*drop)


def drop_empty_columns(df: DataFrame, threshold: float | None = None) -> DataFrame:
    """M3: without threshold drop all-null columns; with one, also share > threshold."""
    drop = []
    for r in _null_table(df):
        all_null = r["n_rows"] > 0 and r["n_null"] == r["n_rows"]
        over = threshold is not None and r["n_rows"] > 0 and r["n_null"] / r["n_rows"] > threshold
        if all_null or over:
            drop.append(r["column"])
    return df.drop(*drop)


def column_roles(df: DataFrame, threshold: int = 9, cols: Sequence[str] | None = None) -> DataFrame:
    """M4: ``(column, n_unique, role)``; categorical if n_unique < threshold,
    numerical if not categorical and numeric-typed, else 'other'."""
    cols = list(cols or df.columns)
    numeric = {f.name for f in df.schema.fields if isinstance(f.dataType, NUMERIC_TYPES)}
    num_lit = F.array(*[F.lit(c) for c in numeric]) if numeric else F.array().cast("array<string>")
    return distinct_counts(df, cols).select(
        "column", "n_unique",
        F.when(F.col("n_unique") < threshold, "categorical")
         .when(F.array_contains(num_lit, F.col("column")), "numerical")
         .otherwise("other").alias("role"))


def few_distinct(df: DataFrame, threshold: int = 9, cols: Sequence[str] | None = None) -> DataFrame:
    """``(column, n_few)``: the number of distinct values (nulls ignored) where it is below ``threshold``, else null.

    One pass without unpivot, whatever the number of columns: each column keeps a mergeable sketch of at least twice
    ``threshold`` hashes. As long as it is not full, which is certain below ``threshold``, it holds the hash of
    every distinct value, so the count is exact (but for 64-bit collisions); beyond that it stops growing.
    """
    cols = list(cols or df.columns)
    entries = max(4, threshold.bit_length() + 1)
    if entries > 20:
        raise ValueError("threshold is too large for a sketch; use distinct_counts")

    def hashed(f: T.StructField) -> Column:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, INTEGRAL_TYPES):
            return c.cast("long")
        if isinstance(f.dataType, (T.FloatType, T.DoubleType)):
            return c.cast("double") + F.lit(0.0)  # -0.0 is 0.0
        return F.concat(F.lit("v"), c.cast("string"))  # the sketch would skip an empty text

    types = {f.name: f for f in df.schema.fields}
    wide = df.agg(*[F.theta_sketch_estimate(F.theta_sketch_agg(hashed(types[c]), entries)).alias(f"n{i}") for i, c in enumerate(cols)])
    few = lambda i: F.when(F.coalesce(F.col(f"n{i}"), F.lit(0)) < threshold, F.coalesce(F.col(f"n{i}"), F.lit(0)))
    return wide.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column"), few(i).cast("long").alias("n_few")) for i, c in enumerate(cols)])))


def quick_roles(df: DataFrame, threshold: int = 9, cols: Sequence[str] | None = None) -> DataFrame:
    """M4: ``(column, role)`` as in ``column_roles``, without full distinct counts: see ``few_distinct``."""
    cols = list(cols or df.columns)
    numeric = [f.name for f in df.schema.fields if isinstance(f.dataType, NUMERIC_TYPES)]
    role = F.when(F.col("n_few").isNotNull(), "categorical").when(F.col("column").isin(numeric), "numerical").otherwise("other")
    return few_distinct(df, threshold, cols).select("column", role.alias("role"))


def roles_dict(df: DataFrame, threshold: int = 9) -> dict[str, list[str]]:
    rows = quick_roles(df, threshold).collect()
    order = {c: i for i, c in enumerate(df.columns)}
    out = {"categorical": [], "numerical": [], "other": []}
    for r in sorted(rows, key=lambda r: order[r["column"]]):
        out[r["role"]].append(r["column"])
    return out


class FittedFill:
    """Transform side of every imputer: ``coalesce(col, fitted value)``."""

    def __init__(self, values: Mapping[str, object], exprs: Mapping[str, Callable[[Column], Column]] | None = None):
        self.values = dict(values)
        self.exprs = dict(exprs or {})

    def transform(self, df: DataFrame) -> DataFrame:
        sel = []
        types = {f.name: f.dataType for f in df.schema.fields}
        for c in df.columns:
            if c in self.exprs:
                sel.append(self.exprs[c](F.col(c)).alias(c))
            elif c in self.values and self.values[c] is not None:
                v = self.values[c]
                t = types[c]
                lit = F.lit(v)
                # keep integral columns integral when the fill is integral
                if isinstance(t, (T.IntegerType, T.LongType)) and not float(v).is_integer():
                    sel.append(F.coalesce(F.col(c).cast("double"), lit).alias(c))
                else:
                    sel.append(F.coalesce(F.col(c), lit.cast(t)).alias(c))
            else:
                sel.append(F.col(c))
        return df.select(*sel)


def fit_tiered_impute(df: DataFrame, categorical: Sequence[str], numerical: Sequence[str],
                      max_share: float = 0.05, numeric_rest: str = "keep") -> FittedFill:
    """M5: columns with null share < ``max_share``: median (numerical), mode (categorical).

    ``numeric_rest='median'`` also fills numerical columns above the share
    (a gap of the reference, off by default for compatibility).
    """
    shares = {r["column"]: r["null_share"] or 0.0 for r in null_stats(df, list(categorical) + list(numerical)).collect()}
    num = [c for c in numerical if shares[c] < max_share or numeric_rest == "median"]
    cat = [c for c in categorical if shares[c] < max_share]
    values: dict[str, object] = {}
    if num:
        st = column_stats(df, num, [], quantiles=[0.5])
        values.update({c: st[c]["q0.5"] for c in num})
    values.update(modes(df, cat))
    return FittedFill(values)


def fit_mean_mode(df: DataFrame, truncate: bool = False,
                  cols: Sequence[str] | None = None) -> FittedFill:
    """M6 (``truncate=True``: ``int(mean)``) and M7: mean for numeric, mode otherwise."""
    cols = list(cols or df.columns)
    types = {f.name: f.dataType for f in df.schema.fields}
    num = [c for c in cols if isinstance(types[c], NUMERIC_TYPES)]
    oth = [c for c in cols if c not in num]
    st = column_stats(df, num, ["mean", "n_null"]) if num else {}
    values: dict[str, object] = {}
    for c in num:
        if st[c]["n_null"] == 0 and isinstance(types[c], INTEGRAL_TYPES):
            continue  # null-free integral columns keep their type (pandas fillna)
        m = st[c]["mean"]
        values[c] = (int(m) if truncate else m) if m is not None else None
    values.update(modes(df, oth))
    return FittedFill(values)


def fit_strategy(df: DataFrame, strategy: Mapping[str, object],
                 constant_value=None) -> FittedFill:
    """M8 / UD1: per-column strategy: 'median', 'constant' or a callable.

    A callable receives ``(column, stats)`` where ``stats`` is the fitted
    ``{min, max, mean, median}`` of that column, and returns a Column; it is
    applied as a column expression (no Python UDF). Unknown columns are
    skipped; anything else raises ``ValueError``.
    """
    if not isinstance(strategy, Mapping):
        raise ValueError("fills are given as a mapping of column to method")
    known = {c: m for c, m in strategy.items() if c in df.columns}
    for c, m in known.items():
        if not (m == "median" or (m == "constant" and constant_value is not None) or callable(m)):
            raise ValueError(f"column {c}: no way to fill by {m!r}")
    stat_cols = [c for c, m in known.items() if m == "median" or callable(m)]
    st = column_stats(df, stat_cols, ["min", "max", "mean"], quantiles=[0.5]) if stat_cols else {}
    values, exprs = {}, {}
    for c, m in known.items():
        if m == "median":
            values[c] = st[c]["q0.5"]
        elif m == "constant":
            values[c] = constant_value
        else:
            s = dict(st[c])
            s["median"] = s.pop("q0.5")
            exprs[c] = (lambda fn, s: (lambda col: fn(col, s)))(m, s)
    return FittedFill(values, exprs)


def clean_missing(df: DataFrame, max_null_share: float | None = None, fills: Mapping[str, object] | None = None,
                  fill_value=None) -> DataFrame:
    """M3, then M8 with the ``fills`` of a column or, without any, M7: empty columns go (and those with a larger share of nulls
    than ``max_null_share``), the gaps of the others are filled. To count nulls only: ``null_counts``."""
    if not isinstance(df, DataFrame):
        raise TypeError(f"a DataFrame is needed, not {type(df).__name__}")
    left = drop_empty_columns(df, max_null_share)
    fit = fit_mean_mode(left) if fills is None else fit_strategy(left, fills, fill_value)
    return fit.transform(left)
