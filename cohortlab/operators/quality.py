"""Data quality, profile, schema and drift, inventory IDs Q1-Q9."""

from __future__ import annotations

from functools import reduce
from typing import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortlab.functions.colstats import column_stats, numeric_columns
from cohortlab.functions.stats import chi2_sf
from cohortlab.operators.describe import describe
from cohortlab.operators.gram import pearson
from cohortlab.operators.relational import (assert_same_columns, cumulative_sums, distinct_counts,
                                            missing_columns, null_stats, to_long)
from cohortlab.session import bounded_broadcast, checkpointed


def validate(df: DataFrame, required: Sequence[str] = (), raise_on_fail: bool = False) -> DataFrame:
    """Q1: not empty, required columns present, no null anywhere.

    One aggregation; report ``(check, passed, detail)``.
    """
    missing = sorted(missing_columns(df, required))
    any_null = F.greatest(F.lit(0), F.lit(0), *[F.max(F.col(c).isNull().cast("int")) for c in df.columns])
    row = df.agg(F.count(F.lit(1)).alias("n"), any_null.alias("z")).first()
    n, z = row["n"], row["z"] or 0
    checks = [("not_empty", n > 0 and len(df.columns) > 0, f"rows={n} columns={len(df.columns)}"),
              ("required_columns", not missing, f"missing={missing}"),
              ("no_nulls", z == 0, "nulls found" if z else "none")]
    if raise_on_fail:
        for name, ok, detail in checks:
            if not ok:
                raise ValueError(f"validation failed: {name}: {detail}")
    return df.sparkSession.createDataFrame(checks, "check_name string, passed boolean, detail string")


def require(**inputs) -> None:
    """Q2: raise if a required input is None."""
    for k, v in inputs.items():
        if v is None:
            raise ValueError(f"{k} is None")


def top_values(df: DataFrame, cols: Sequence[str], k: int = 5) -> DataFrame:
    """Most frequent ``k`` values per column ``(column, value, count, rank)``; the
    counts are partially aggregated; the per-column top-k runs on that table."""
    counts = (to_long(df, cols, "string").where(F.col("value").isNotNull())
              .groupBy("column", "value").agg(F.count(F.lit(1)).alias("count")))
    w = Window.partitionBy("column").orderBy(F.col("count").desc(), F.col("value"))
    return counts.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def profile(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Q3 / Q4: one row per column: type, missing, distinct, zeros, numeric
    summary, string lengths and the top value."""
    cols = list(cols or df.columns)
    nums = set(numeric_columns(df))
    ns = null_stats(df, cols)
    dc = distinct_counts(df, cols)
    num_cols = [c for c in cols if c in nums]
    desc = describe(df, num_cols) if num_cols else None
    str_cols = [c for c in cols if c not in nums]
    lens = None
    if str_cols:
        aggs = [F.struct(F.lit(c).alias("column"), F.min(F.length(F.col(c).cast("string"))).alias("min_len"),
                         F.max(F.length(F.col(c).cast("string"))).alias("max_len"),
                         F.avg(F.length(F.col(c).cast("string"))).alias("mean_len")) for c in str_cols]
        lens = df.agg(F.array(*aggs).alias("a")).select(F.inline("a"))
    zeros_aggs = [F.struct(F.lit(c).alias("column"), F.count(F.when(F.col(c) == 0, 1)).alias("n_zero"))
                  for c in num_cols]
    top = top_values(df, cols, 1).select("column", F.col("value").alias("top"), F.col("count").alias("top_count"))
    types = df.sparkSession.createDataFrame([(c, df.schema[c].dataType.simpleString()) for c in cols],
                                            "column string, dtype string")
    out = types.join(ns, "column", "left").join(dc, "column", "left").join(top, "column", "left")
    if num_cols:
        zeros = df.agg(F.array(*zeros_aggs).alias("a")).select(F.inline("a"))
        out = out.join(desc, "column", "left").join(zeros, "column", "left")
    if lens is not None:
        out = out.join(lens, "column", "left")
    return out


def infer_schema(df: DataFrame, domain_limit: int = 20) -> DataFrame:
    """Q5: ``(column, dtype, presence, n_unique, domain)``; ``domain`` lists the
    sorted distinct values of string columns with at most ``domain_limit`` (``domains`` has all, as rows)."""
    str_cols = [f.name for f in df.schema.fields if f.dataType.simpleString() == "string"]
    ns = null_stats(df).select("column", (1 - F.col("null_share")).alias("presence"))
    dc = distinct_counts(df)
    types = df.sparkSession.createDataFrame([(f.name, f.dataType.simpleString()) for f in df.schema.fields],
                                            "column string, dtype string")
    out = types.join(ns, "column").join(dc, "column")
    if str_cols:
        vals = (to_long(df, str_cols).where(F.col("value").isNotNull()).select("column", "value").distinct()
                .join(dc.where(F.col("n_unique") <= domain_limit).select("column"), "column", "left_semi")
                .groupBy("column").agg(F.array_sort(F.collect_list("value")).alias("domain")))
        out = out.join(vals, "column", "left")
    else:
        out = out.withColumn("domain", F.lit(None).cast("array<string>"))
    return out


def domains(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Q5: ``(column, value, count)``: all values of the string columns, however many, as rows; nulls are left out."""
    cols = list(cols or [f.name for f in df.schema.fields if f.dataType.simpleString() == "string"])
    return to_long(df, cols).where(F.col("value").isNotNull()).groupBy("column", "value").agg(F.count(F.lit(1)).alias("count"))


def _ks_lambda_p(d, en) -> F.Column:
    lam = (F.sqrt(en) + 0.12 + F.try_divide(F.lit(0.11), F.sqrt(en))) * d
    s = F.aggregate(F.sequence(F.lit(1), F.lit(100)), F.lit(0.0),
                    lambda acc, k: acc + F.when(k % 2 == 1, 1.0).otherwise(-1.0) * F.exp(-2.0 * k * k * lam * lam))
    return F.when(lam < 1e-3, F.lit(1.0)).otherwise(F.least(F.lit(1.0), F.greatest(F.lit(0.0), 2.0 * s)))


def _running_shares(ref: DataFrame, cur: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(column, value, n1, n2, gap, before): both sides' distribution functions subtracted, at and just below each value.

    Counts per (column, value) are combined before their shuffle, running sums are distributed.
    """
    la = to_long(ref, cols, "double").where(F.col("value").isNotNull()).select(
        "column", "value", F.lit(1).alias("c1"), F.lit(0).alias("c2"))
    lb = to_long(cur, cols, "double").where(F.col("value").isNotNull()).select(
        "column", "value", F.lit(0).alias("c1"), F.lit(1).alias("c2"))
    counts = la.unionByName(lb).groupBy("column", "value").agg(
        F.sum("c1").cast("long").alias("c1"), F.sum("c2").cast("long").alias("c2"))
    cum = cumulative_sums(counts, "column", ["value"], ["c1", "c2"])
    tot = cum.groupBy("column").agg(F.sum("c1").alias("n1"), F.sum("c2").alias("n2"))
    return cum.join(bounded_broadcast(tot, 100_000), "column").select(
        "column", "value", "n1", "n2", (F.try_divide("cum_c1", "n1") - F.try_divide("cum_c2", "n2")).alias("gap"),
        (F.try_divide(F.col("cum_c1") - F.col("c1"), F.col("n1")) - F.try_divide(F.col("cum_c2") - F.col("c2"), F.col("n2"))).alias("before"))


def ks_drift(ref: DataFrame, cur: DataFrame, cols: Sequence[str] | None = None,
             alpha: float = 0.05) -> DataFrame:
    """Q6: two-sample Kolmogorov-Smirnov per numeric column.

    ``D = max |F1 - F2|`` from distributed running sums in value order, and the
    asymptotic p-value. ``(column, n1, n2, ks_stat, p_value, drift)``; null
    statistic, p-value and flag for a column without values on one side.
    """
    cols = list(cols or [c for c in numeric_columns(ref) if c in cur.columns])
    d = _running_shares(ref, cur, cols).groupBy("column", "n1", "n2").agg(F.max(F.abs("gap")).alias("ks_stat"))
    en = F.try_divide(F.col("n1") * F.col("n2"), F.col("n1") + F.col("n2"))
    p = _ks_lambda_p(F.col("ks_stat"), en)
    p = F.when(F.col("ks_stat").isNotNull(), p)
    return d.select("column", "n1", "n2", "ks_stat", p.alias("p_value"), (p < alpha).alias("drift"))


def _jensen_shannon(p, q):
    """Share of one value in the square of the distance: natural logarithm, 0 log 0 = 0."""
    mid = (p + q) / 2
    part = lambda x: F.when(x > 0, x * F.log(x / mid)).otherwise(0.0)
    return (part(p) + part(q)) / 2


def drift_distances(ref: DataFrame, cur: DataFrame, num: Sequence[str] | None = None, cat: Sequence[str] | None = None,
                    bins: int = 30) -> DataFrame:
    """Q8: distances between two snapshots per column: ``(column, kind, wasserstein, wasserstein_norm, jensen_shannon)``.

    Numerical: the area between the two distribution functions, the same divided by the population std of ``ref`` (0.001 at
    least), and the Jensen-Shannon distance over ``bins`` equal bins between the extremes of both sides.
    Categorical: the Jensen-Shannon distance of the value shares. Nulls are left out; a column without values on one
    side has null distances.

    The area needs no look at the next value: it is the sum of value x (|gap below it| - |gap at it|), so the same
    running sums serve as for the KS statistic.
    """
    num = list(num if num is not None else [c for c in numeric_columns(ref) if c in cur.columns])
    cat = list(cat if cat is not None else [f.name for f in ref.schema.fields if f.dataType.simpleString() == "string" and f.name in cur.columns])
    none = F.lit(None).cast("double")
    out = []
    if num:
        gaps = _running_shares(ref, cur, num)
        low = gaps.groupBy("column").agg(F.min("value").alias("lo"), F.max("value").alias("hi"))
        low = bounded_broadcast(low, 100_000)  # one row a column
        area = gaps.join(low, "column").groupBy("column", "n1", "n2").agg(
            F.sum((F.col("value") - F.col("lo")) * (F.abs("before") - F.abs("gap"))).alias("wasserstein"))
        spread = ref.agg(*[F.stddev_pop(F.col(f"`{c}`").cast("double")).alias(f"s{i}") for i, c in enumerate(num)])
        spread = spread.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"s{i}").alias("sd")) for i, c in enumerate(num)])))

        def binned(df: DataFrame, side: int) -> DataFrame:
            width = (F.col("hi") - F.col("lo")) / bins
            place = F.when(F.col("hi") == F.col("lo"), F.lit(0)).otherwise(F.least(F.floor((F.col("value") - F.col("lo")) / width).cast("int"), F.lit(bins - 1)))
            return (to_long(df, num, "double").where(F.col("value").isNotNull()).join(low, "column")
                    .select("column", place.cast("string").alias("value"), F.lit(1 - side).alias("c1"), F.lit(side).alias("c2")))

        js = _shares_distance(binned(ref, 0).unionByName(binned(cur, 1)))
        both = (F.col("n1") > 0) & (F.col("n2") > 0)
        out.append(area.join(spread, "column").join(js, "column").select(
            "column", F.lit("numerical").alias("kind"), F.when(both, F.col("wasserstein")).alias("wasserstein"),
            F.when(both, F.col("wasserstein") / F.greatest("sd", F.lit(0.001))).alias("wasserstein_norm"), "jensen_shannon"))
    if cat:
        side = lambda df, k: to_long(df, cat).where(F.col("value").isNotNull()).select(
            "column", "value", F.lit(1 - k).alias("c1"), F.lit(k).alias("c2"))
        out.append(_shares_distance(side(ref, 0).unionByName(side(cur, 1))).select(
            "column", F.lit("categorical").alias("kind"), none.alias("wasserstein"), none.alias("wasserstein_norm"), "jensen_shannon"))
    return reduce(DataFrame.unionByName, out)


def _shares_distance(marks: DataFrame) -> DataFrame:
    """(column, jensen_shannon) from rows (column, value, c1, c2) of both sides."""
    counts = marks.groupBy("column", "value").agg(F.sum("c1").alias("c1"), F.sum("c2").alias("c2"))
    tot = counts.groupBy("column").agg(F.sum("c1").alias("n1"), F.sum("c2").alias("n2"))
    share = counts.join(bounded_broadcast(tot, 100_000), "column")
    part = _jensen_shannon(F.try_divide("c1", "n1"), F.try_divide("c2", "n2"))
    return share.groupBy("column", "n1", "n2").agg(F.sum(part).alias("d")).select(
        "column", F.when((F.col("n1") > 0) & (F.col("n2") > 0), F.sqrt(F.greatest("d", F.lit(0.0)))).alias("jensen_shannon"))


def chi2_table(ref: DataFrame, cur: DataFrame, cols: Sequence[str], basis: str = "count", yates: bool = True) -> DataFrame:
    """Q7 statistic: 2 x K contingency per string column from value counts of
    both sides (``basis='share'`` feeds shares like the reference).

    ``(column, k, statistic, dof)``; Yates correction when dof = 1, unless ``yates`` is false.
    """
    mark = lambda df, side: to_long(df, cols).where(F.col("value").isNotNull()).select(
        "column", "value", F.lit(1.0 - side).alias("o1"), F.lit(0.0 + side).alias("o2"))
    t = mark(ref, 0).unionByName(mark(cur, 1)).groupBy("column", "value").agg(F.sum("o1").alias("o1"), F.sum("o2").alias("o2"))
    tot = t.groupBy("column").agg(F.sum("o1").alias("r1"), F.sum("o2").alias("r2"),
                                  F.count(F.lit(1)).alias("k"))
    j = t.join(bounded_broadcast(tot, 100_000), "column")
    o1, o2, r1, r2 = F.col("o1"), F.col("o2"), F.col("r1"), F.col("r2")
    if basis == "share":
        o1, o2 = F.coalesce(F.try_divide(o1, r1), F.lit(0.0)), F.coalesce(F.try_divide(o2, r2), F.lit(0.0))
        r1, r2 = F.when(r1 > 0, 1.0).otherwise(0.0), F.when(r2 > 0, 1.0).otherwise(0.0)
    e1, e2 = r1 * (o1 + o2) / (r1 + r2), r2 * (o1 + o2) / (r1 + r2)
    less = F.when(F.col("k") == 2, F.lit(0.5)).otherwise(F.lit(0.0)) if yates else F.lit(0.0)

    def term(o, e):
        dev = F.greatest(F.abs(o - e) - F.least(less, F.abs(o - e)), F.lit(0.0))
        return F.when(e > 0, dev * dev / e).otherwise(F.lit(0.0))

    return (j.groupBy("column", "k").agg(F.sum(term(o1, e1) + term(o2, e2)).alias("statistic"))
             .withColumn("dof", (F.col("k") - 1).cast("long")))


def chi2_drift(ref: DataFrame, cur: DataFrame, cols: Sequence[str] | None = None, basis: str = "count",
               alpha: float = 0.05) -> DataFrame:
    """Q7: statistic, p-value (chi-square survival on the O(columns) result) and flag."""
    cols = list(cols or [f.name for f in ref.schema.fields if f.dataType.simpleString() == "string"])
    rows = chi2_table(ref, cur, cols, basis).collect()
    out = []
    for r in rows:
        p = chi2_sf(r["statistic"], r["dof"]) if r["dof"] > 0 else 1.0
        out.append((r["column"], r["k"], r["statistic"], r["dof"], p, p < alpha))
    return ref.sparkSession.createDataFrame(
        out, "column string, k long, statistic double, dof long, p_value double, drift boolean")


def drift_summary(ref: DataFrame, cur: DataFrame, alpha: float = 0.05, share: float = 0.5) -> DataFrame:
    """Q8: per-column tests (KS numeric, chi-square categorical; distances: ``drift_distances``) and a dataset flag:
    ``(n_columns, n_drifted, share_drifted, dataset_drift)``."""
    assert_same_columns(ref, cur)
    ks = ks_drift(ref, cur, alpha=alpha).select("column", "drift")
    cat = [f.name for f in ref.schema.fields if f.dataType.simpleString() == "string"]
    parts = ks
    if cat:
        parts = parts.unionByName(chi2_drift(ref, cur, cat, alpha=alpha).select("column", "drift"))
    return parts.agg(F.count(F.lit(1)).alias("n_columns"),
                     F.sum(F.col("drift").cast("long")).alias("n_drifted")).select(
        "n_columns", "n_drifted", (F.col("n_drifted") / F.col("n_columns")).alias("share_drifted"),
        (F.col("n_drifted") / F.col("n_columns") >= share).alias("dataset_drift"))


def feature_drift_scores(ref: DataFrame, cur: DataFrame) -> DataFrame:
    """Q9: numeric columns: KS statistic; categorical: Cramer's V of the 2 x K
    count table (no continuity correction). ``(column, kind, score)``."""
    num = [c for c in numeric_columns(ref) if c in cur.columns]
    cat = [f.name for f in ref.schema.fields if f.dataType.simpleString() == "string"]
    out = ks_drift(ref, cur, num).select("column", F.lit("numerical").alias("kind"), F.col("ks_stat").alias("score"))
    if cat:
        n = ref.count() + cur.count()
        raw = chi2_table_no_yates(ref, cur, cat)
        out = out.unionByName(raw.select("column", F.lit("categorical").alias("kind"),
                                         F.sqrt(F.col("statistic") / F.lit(float(n))).alias("score")))
    return out


def chi2_table_no_yates(ref: DataFrame, cur: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(column, statistic) without the continuity correction."""
    return chi2_table(ref, cur, cols, yates=False).select("column", "statistic")


def associations(df: DataFrame, num: Sequence[str], cat: Sequence[str], top: int | None = None) -> DataFrame:
    """Q3: how strongly pairs of columns go together: ``(a, b, kind, n, value)``, over the rows that have both.

    Numbers by Pearson's r (from the Gram matrix), categories by Cramer's V, a category and a number by the correlation
    ratio (the share of the number's spread that lies between the categories, as a root). Undefined values (one category,
    no spread) are null. ``top``: only the strongest so many pairs of each kind, ties by name, cut before the shuffle.

    Counts per pair of values are combined before they are shuffled; their number is bounded by the categories.
    """
    num, cat, out = list(num), list(cat), []
    if len(num) > 1:
        names = F.array(*[F.lit(c) for c in num])
        out.append(pearson(df, num).where("i < j").select(F.get(names, F.col("i")).alias("a"), F.get(names, F.col("j")).alias("b"),
                                                         F.lit("pearson").alias("kind"), "n", F.col("r").alias("value")))
    if len(cat) > 1:
        text = lambda c: F.col(f"`{c}`").cast("string")
        pairs = F.array(*[F.struct(F.lit(x).alias("a"), F.lit(y).alias("b"), text(x).alias("x"), text(y).alias("y"))
                          for i, x in enumerate(cat) for y in cat[i + 1:]])
        cells = checkpointed(df.select(F.inline(pairs)).where(F.col("x").isNotNull() & F.col("y").isNotNull())
                             .groupBy("a", "b", "x", "y").agg(F.count(F.lit(1)).alias("o")))
        rows = cells.groupBy("a", "b", "x").agg(F.sum("o").alias("r"))
        cols = cells.groupBy("a", "b", "y").agg(F.sum("o").alias("c"))
        size = rows.groupBy("a", "b").agg(F.sum("r").alias("n"), F.count(F.lit(1)).alias("kr")).join(
            cols.groupBy("a", "b").agg(F.count(F.lit(1)).alias("kc")), ["a", "b"])
        phi = (cells.join(rows, ["a", "b", "x"]).join(cols, ["a", "b", "y"]).groupBy("a", "b")
               .agg((F.sum(F.col("o") / F.col("r") * (F.col("o") / F.col("c"))) - 1).alias("phi2")))
        least = F.least("kr", "kc") - 1
        out.append(phi.join(size, ["a", "b"]).select("a", "b", F.lit("cramers_v").alias("kind"), "n",
                                                     F.when(least > 0, F.sqrt(F.greatest("phi2", F.lit(0.0)) / least)).alias("value")))
    if num and cat:
        mean = column_stats(df, num, ["mean"])
        x = [F.col(f"`{c}`").cast("double") - F.lit(float(mean[c]["mean"] or 0.0)) for c in num]
        for c in cat:
            sums = df.where(F.col(f"`{c}`").isNotNull()).groupBy(F.col(f"`{c}`").alias("g")).agg(
                *[F.struct(F.lit(name).alias("b"), F.count(v).alias("k"), F.sum(v).alias("s"), F.sum(v * v).alias("q")).alias(f"t{i}")
                  for i, (name, v) in enumerate(zip(num, x))])
            each = sums.select(F.inline(F.array(*[F.col(f"t{i}") for i in range(len(num))]))).where("k > 0")
            got = each.groupBy("b").agg(F.sum("k").alias("n"), F.sum("s").alias("s"), F.sum("q").alias("q"), F.sum(F.col("s") * F.col("s") / F.col("k")).alias("within"))
            middle = F.col("s") * F.col("s") / F.col("n")
            spread = F.col("q") - middle
            out.append(got.select(F.lit(c).alias("a"), "b", F.lit("correlation_ratio").alias("kind"), "n", F.when(
                spread > F.col("q") * 1e-14, F.sqrt(F.greatest(F.lit(0.0), F.least(F.lit(1.0), (F.col("within") - middle) / spread)))).alias("value")))
    if not out:
        return df.sparkSession.createDataFrame([], "a string, b string, kind string, n long, value double")
    every = reduce(DataFrame.unionByName, out)
    if top is None:
        return every
    w = Window.partitionBy("kind").orderBy(F.abs("value").desc_nulls_last(), "a", "b")
    return every.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= top).drop("rank")
