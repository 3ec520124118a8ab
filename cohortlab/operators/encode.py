"""Encoding and feature building, inventory IDs E1-E9."""

from __future__ import annotations

from functools import reduce
from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortlab.functions.colstats import column_stats
from cohortlab.operators.gram import pair_sums
from cohortlab.operators.relational import NUMERIC_TYPES, drop_strict, join_keyed, to_long, with_row_index


def _value_text(v, dtype) -> str:
    """Category text used in one-hot names: numbers print as floats (``1.0``)."""
    if isinstance(dtype, NUMERIC_TYPES):
        return repr(float(v))
    return str(v)


class StandardScaler:
    """``(x - mean) / std_pop``; std 0 divides by 1; null passes through.

    Spark ML's StandardScaler uses the sample std, so it is not used here.
    """

    def __init__(self, cols: Sequence[str]):
        self.cols = list(cols)
        self.params: dict[str, tuple[float, float]] = {}

    def fit(self, df: DataFrame) -> "StandardScaler":
        st = column_stats(df, self.cols, ["mean", "std_pop"])
        self.params = {c: (st[c]["mean"] or 0.0, st[c]["std_pop"] or 1.0) for c in self.cols}
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        return df.withColumns({c: (F.col(c).cast("double") - F.lit(m)) / F.lit(s if s else 1.0)
                               for c, (m, s) in self.params.items()})


class OneHot:
    """E2 (all categories) / E3 (``drop_first=True``, original replaced).

    Output columns ``<col>_<value>`` in sorted value order; an unseen or
    null value gives all zeros. The fit is one partially aggregated
    ``groupBy(column, value)`` on the unpivoted table; its size is the
    number of categories, checked against ``max_categories``.
    """

    def __init__(self, cols: Sequence[str], drop_first: bool = False, max_categories: int = 10_000):
        self.cols = list(cols)
        self.drop_first = drop_first
        self.max_categories = max_categories
        self.categories: dict[str, list] = {}
        self.dtypes: dict[str, T.DataType] = {}

    def fit(self, df: DataFrame) -> "OneHot":
        self.dtypes = {c: df.schema[c].dataType for c in self.cols}
        num = [c for c in self.cols if isinstance(self.dtypes[c], NUMERIC_TYPES)]
        oth = [c for c in self.cols if c not in num]
        cats: dict[str, list] = {c: [] for c in self.cols}
        for group, vt in ((num, "double"), (oth, "string")):
            if not group:
                continue
            pairs = (to_long(df, group, vt).where(F.col("value").isNotNull())
                     .select("column", "value").distinct())
            rows = pairs.limit(self.max_categories + 1).collect()
            if len(rows) > self.max_categories:
                raise ValueError("too many categories for a column-wise one-hot; use VectorEncoder")
            for r in rows:
                cats[r["column"]].append(r["value"])
        self.categories = {c: sorted(v) for c, v in cats.items()}
        return self

    def output_names(self) -> list[str]:
        out = []
        for c in self.cols:
            vals = self.categories[c][1:] if self.drop_first else self.categories[c]
            out += [f"{c}_{_value_text(v, self.dtypes[c])}" for v in vals]
        return out

    def exprs(self):
        out = []
        for c in self.cols:
            vals = self.categories[c][1:] if self.drop_first else self.categories[c]
            x = F.col(c).cast("double") if isinstance(self.dtypes[c], NUMERIC_TYPES) else F.col(c)
            for v in vals:
                out.append(F.when(x == F.lit(v), 1).otherwise(0).alias(f"{c}_{_value_text(v, self.dtypes[c])}"))
        return out

    def transform(self, df: DataFrame, keep_rest: bool = True) -> DataFrame:
        rest = [F.col(c) for c in df.columns if c not in self.cols] if keep_rest else []
        return df.select(*rest, *self.exprs())


def value_ranks(df: DataFrame, col: str) -> DataFrame:
    """(value, n, code): the distinct values of a column, how often each occurs, and its rank from 0 in sorted order.

    Ranks come from a distributed row index over the distinct values; nothing is collected but one count a partition.
    Nulls have no rank.
    """
    from cohortlab.session import checkpointed
    counts = checkpointed(df.select(F.col(f"`{col}`").alias("value")).where(F.col("value").isNotNull())
                          .groupBy("value").agg(F.count(F.lit(1)).alias("n")))
    return with_row_index(counts, ["value"], "code")


def label_encode(df: DataFrame, col: str, out: str | None = None) -> DataFrame:
    """E5: sorted distinct values -> 0..k-1 (numeric order for numbers); null stays null.

    The ranks are a table that is joined back: broadcast while it is small, else with its hot values apart.
    """
    out, name = out or col, "__value"
    while name in df.columns or f"{name}_code" in df.columns:
        name += "_"
    ranks = value_ranks(df, col).select(F.col("value").alias(name), "n", F.col("code").cast("int").alias(f"{name}_code"))
    joined = join_keyed(df.withColumnRenamed(col, name) if out == col else df.withColumn(name, F.col(f"`{col}`")),
                        ranks.withColumnRenamed("n", f"{name}_n"), name, count=f"{name}_n")
    cols = [c for c in df.columns if c != out] + ([out] if out not in df.columns else [])
    order = df.columns if out in df.columns else cols
    return joined.select(*[F.col(f"{name}_code" if c == out else f"`{c}`").alias(c) for c in order])


class VectorEncoder:
    """E2 to E4 without a limit of categories: one sparse vector a row instead of a column a category.

    Slots: the scaled ``numeric`` columns, then the categories of each categorical column in sorted order
    (without the first of each if ``drop_first``). The categories are a table (column, value, rank) that is joined, broadcast
    while it is small, else with its hot values apart; only one count a column reaches the driver. A value unseen
    in the fit, or null, has no slot; a null number counts as 0 after scaling.

    ``transform`` adds ``out``: struct of ``size``, ``indices`` (ascending) and ``values``, in plain expressions;
    ``as_ml_vector`` turns it into a vector of Spark ML; ``names`` and ``unpack`` give the named columns back.
    """

    def __init__(self, categorical: Sequence[str], numeric: Sequence[str] = (), drop_first: bool = False):
        self.categorical, self.numeric, self.drop_first = list(categorical), list(numeric), drop_first
        self.scaler = StandardScaler(numeric)
        self.tables: dict[str, DataFrame] = {}
        self.starts: dict[str, int] = {}
        self.size = len(self.numeric)

    def fit(self, df: DataFrame) -> "VectorEncoder":
        if self.numeric:
            self.scaler.fit(df)
        at = len(self.numeric)
        skip = int(self.drop_first)
        for c in self.categorical:
            ranks = value_ranks(df, c)
            number = F.when(F.col("code") >= skip, F.col("code") - skip + at).cast("int")
            self.tables[c], self.starts[c] = ranks.select("value", "n", number.alias("slot")), at
            at += max(0, ranks.count() - skip)
        self.size = at
        self.dtypes = {c: df.schema[c].dataType for c in self.categorical}
        return self

    def transform(self, df: DataFrame, out: str = "features") -> DataFrame:
        rows = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"))
        for i, c in enumerate(self.categorical):
            side = self.tables[c].select(F.col("value").alias("key"), "n", F.col("slot").alias(f"slot{i}"))
            rows = join_keyed(rows.withColumn("key", F.col(f"row.`{c}`")), side, "key").drop("key")
        slots = F.filter(F.array(*[F.col(f"slot{i}") for i in range(len(self.categorical))]).cast("array<int>"), lambda s: s.isNotNull())
        scaled = [F.coalesce((F.col(f"row.`{c}`").cast("double") - F.lit(m)) / F.lit(sd), F.lit(0.0)) for c, (m, sd) in self.scaler.params.items()]
        indices = F.concat(F.array(*[F.lit(i) for i in range(len(scaled))]).cast("array<int>"), slots)
        values = F.concat(F.array(*scaled).cast("array<double>"), F.transform(slots, lambda s: F.lit(1.0)))
        vector = F.struct(F.lit(self.size).alias("size"), indices.alias("indices"), values.alias("values"))
        return rows.select("row.*", vector.alias(out))

    def names(self) -> DataFrame:
        """(slot, name): names as of the one-hot columns, ``<col>_<value>``, and of the numeric columns."""
        spark = next(iter(self.tables.values())).sparkSession if self.tables else None
        parts = []
        for c in self.categorical:
            text = F.col("value").cast("double") if isinstance(self.dtypes[c], NUMERIC_TYPES) else F.col("value")
            parts.append(self.tables[c].where(F.col("slot").isNotNull()).select("slot", F.concat(F.lit(f"{c}_"), text.cast("string")).alias("name")))
        if self.numeric:
            if spark is None:
                from pyspark.sql import SparkSession
                spark = SparkSession.getActiveSession()
            parts.append(spark.createDataFrame(list(enumerate(self.numeric)), "slot int, name string"))
        return reduce(DataFrame.unionByName, parts)

    def unpack(self, df: DataFrame, keys: Sequence[str], vector: str = "features") -> DataFrame:
        """(*keys, name, value): the slots of each row that are not zero, by name."""
        long = df.select(*keys, F.inline(F.arrays_zip(F.col(f"{vector}.indices").alias("slot"), F.col(f"{vector}.values").alias("value"))))
        return long.join(self.names(), "slot").select(*keys, "name", "value")


def as_ml_vector(df: DataFrame, col: str = "features") -> DataFrame:
    """A struct of ``VectorEncoder`` as a sparse vector of Spark ML, which only a Python function can make."""
    from pyspark.ml.linalg import SparseVector, VectorUDT
    return df.withColumn(col, F.udf(lambda v: v and SparseVector(v["size"], v["indices"], v["values"]), VectorUDT())(F.col(col)))


class ColumnComposer:
    """Numeric columns scaled, categorical one-hot, the rest passed through but for ``passthrough_exclude``,
    output order ``numeric + one-hot + rest`` as in the reference; one ``select``. Beyond some thousand categories
    ``VectorEncoder`` does the same in one sparse vector."""

    def __init__(self, numeric: Sequence[str], categorical: Sequence[str], passthrough_exclude=()):
        self.scaler = StandardScaler(numeric)
        self.onehot = OneHot(categorical)
        self.numeric, self.categorical = list(numeric), list(categorical)
        self.exclude = set(passthrough_exclude)

    def fit(self, df: DataFrame) -> "ColumnComposer":
        self.scaler.fit(df)
        self.onehot.fit(df)
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        scaled = [((F.col(c).cast("double") - F.lit(m)) / F.lit(s)).alias(c)
                  for c, (m, s) in self.scaler.params.items()]
        rest = [F.col(c) for c in df.columns
                if c not in self.numeric and c not in self.categorical and c not in self.exclude]
        return df.select(*scaled, *self.onehot.exprs(), *rest)


def correlated_pairs(corr_long: DataFrame, threshold: float = 0.9, compat: bool = False) -> DataFrame:
    """Pairs with ``|r| > threshold`` from the long correlation table
    ``(a, b, r, i, j)`` (T3). Strict lower triangle; ``compat=True`` keeps the
    diagonal like the reference mask."""
    cond = (F.col("i") >= F.col("j")) if compat else (F.col("i") > F.col("j"))
    return corr_long.where(cond & (F.abs("r") > threshold))


def drop_id_and_date(df: DataFrame, cols=("Participant_ID", "ENROLL_DATE")) -> DataFrame:
    """Drop identifier and date before modelling (strict)."""
    return drop_strict(df, *cols)


def attach_target(features: DataFrame, target: DataFrame, key: str) -> DataFrame:
    """Bring the target back by key (never by position)."""
    return features.join(target, on=key, how="inner")


class LinearDiscriminant:
    """Fisher linear discriminant projection onto
    ``min(n_features, n_classes - 1)`` components.

    Fit: class counts and means in one ``groupBy(label)``, the features' Gram matrix by ``gram.pair_sums``, the
    eigen-problem of the features x features scatter matrices on the driver. Rows without label or with a null
    feature are left out. Transform: one dot product per component as column expressions.
    """

    def __init__(self, features: Sequence[str], label: str, n_components: int | None = None):
        self.features, self.label, self.n_components = list(features), label, n_components
        self.scalings = None
        self.xbar = None

    def scatter(self, df: DataFrame):
        """(classes, counts, class means, within-class scatter), arrays in the order of the classes."""
        import numpy as np
        rows = df.select(F.col(f"`{self.label}`").alias("label"), *[F.col(f"`{c}`").cast("double").alias(f"x{i}") for i, c in enumerate(self.features)])
        rows = rows.dropna()
        names = [f"x{i}" for i in range(len(self.features))]
        got = sorted(rows.groupBy("label").agg(F.count(F.lit(1)).alias("n"), *[F.avg(c).alias(c) for c in names]).collect(), key=lambda r: r["label"])
        counts = np.array([r["n"] for r in got], float)
        means = np.array([[r[c] for c in names] for r in got], float).reshape(len(got), len(names))
        shift = counts @ means / max(counts.sum(), 1)
        sums = {r["i"]: r["c"] for r in pair_sums(rows, names, list(shift)).select("i", "c").collect()}
        total = np.array([sums[i] for i in range(len(names))]) if sums else np.zeros((len(names),) * 2)
        off = means - shift
        return [r["label"] for r in got], counts, means, total - (off * counts[:, None]).T @ off

    def fit(self, df: DataFrame) -> "LinearDiscriminant":
        import numpy as np
        _, counts, means, sw = self.scatter(df)
        xbar = counts @ means / counts.sum()
        off = means - xbar
        sb = (off * counts[:, None]).T @ off
        evals, evecs = np.linalg.eig(np.linalg.pinv(sw) @ sb)
        order = np.argsort(-evals.real)
        m = self.n_components or min(len(self.features), len(counts) - 1)
        self.scalings = evecs.real[:, order[:m]]
        self.xbar = xbar
        return self

    def transform(self, df: DataFrame, prefix: str = "ld") -> DataFrame:
        comps = []
        for j in range(self.scalings.shape[1]):
            expr = None
            for i, c in enumerate(self.features):
                term = (F.col(c) - F.lit(float(self.xbar[i]))) * F.lit(float(self.scalings[i, j]))
                expr = term if expr is None else expr + term
            comps.append(expr.alias(f"{prefix}{j + 1}"))
        return df.select("*", *comps)
