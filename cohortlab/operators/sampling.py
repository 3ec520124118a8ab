"""Deterministic sampling and splitting, inventory IDs D1-D6.

Every row gets a 60-bit number ``u = md5('<key>:<seed>')`` (first 15 hex
digits). Spark and DuckDB compute it identically, so every split has an
exact SQL oracle. Order ``(u, key)`` is total when ``key`` is unique.

Exact sizes need the row at a given rank. ``rank_cut`` finds it without a
global sort: a histogram of ``u`` by its top bits (one partially aggregated
group-by, bounded to 2^16 buckets) locates the bucket holding the rank,
and only that bucket is refined; the final step sorts at most
``exact_rows`` rows. Assignment is then a plain comparison per row.
"""

from __future__ import annotations

import math
from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlab.session import bounded_broadcast
from cohortlab.operators.relational import keep_not_equal, stack_by_name, with_row_index

U_BITS = 60


def hash_u(key, seed: int = 42) -> Column:
    """60-bit unsigned hash of ``'<key>:<seed>'`` as a long; a null key is written ``null``."""
    k = F.col(key) if isinstance(key, str) else key
    s = F.concat(F.coalesce(k.cast("string"), F.lit("null")), F.lit(f":{seed}"))
    return F.conv(F.substring(F.md5(s), 1, 15), 16, 10).cast("long")


def _histogram(df: DataFrame, u: str, shift: int) -> list:
    """(b, n) of the buckets of ``u``, in order; at most 2^bits rows."""
    return (df.groupBy(F.shiftright(F.col(u), shift).alias("b"))
            .agg(F.count(F.lit(1)).alias("n")).orderBy("b").collect())


def rank_cut(df: DataFrame, u: str, key: str, k: int, bits: int = 16,
             exact_rows: int = 2_000_000, histogram: list | None = None):
    """``(u_k, key_k)`` of the row with 0-based rank ``k`` in ``(u, key)`` order,
    or ``None`` if ``k >= n``. Rows before it are exactly ``k``. ``histogram``: that of the first ``bits``, if it is there."""
    lo_bit = U_BITS
    sub = df.select(u, key)
    while True:
        shift = max(lo_bit - bits, 0)
        hist = histogram if lo_bit == U_BITS and histogram is not None else _histogram(sub, u, shift)
        if k >= sum(r["n"] for r in hist):
            return None
        acc = 0
        for r in hist:
            if acc + r["n"] > k:
                bucket, inside = r["b"], r["n"]
                break
            acc += r["n"]
        k -= acc
        sub = sub.where(F.shiftright(F.col(u), shift) == bucket)
        lo_bit = shift
        if inside <= exact_rows or shift == 0:
            row = sub.orderBy(u, key).offset(k).limit(1).first()
            return row[u], row[key]


def _before(u: str, key: str, cut) -> Column:
    if cut is None:
        return F.lit(True)
    uk, kk = cut
    return (F.col(u) < F.lit(uk)) | ((F.col(u) == F.lit(uk)) & (F.col(key) < F.lit(kk)))


def _unique(df: DataFrame, key: str) -> DataFrame:
    """``df`` if no key repeats (a null counts as a value): exact sizes rest on it.

    Only 8-byte hashes are counted; keys are looked at where a hash repeats."""
    h = F.xxhash64(F.col(key))
    again = df.select(h.alias("h")).groupBy("h").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("h")
    if again.isEmpty():
        return df
    keys = df.select(F.struct(F.col(key)).alias("k"), h.alias("h")).join(again, "h", "left_semi")
    if not keys.groupBy("k").agg(F.count(F.lit(1)).alias("n")).where("n > 1").isEmpty():
        raise ValueError(f"{key} repeats; exact sizes need a key that tells all rows apart")
    return df


def split_sizes_two(n: int, test: float) -> tuple[int, int]:
    """scikit-learn sizes: ``n_test = ceil(test * n)``, train is the rest."""
    nt = math.ceil(test * n)
    return n - nt, nt


def train_test(df: DataFrame, key: str, test: float = 0.2, seed: int = 42,
               out: str = "split") -> DataFrame:
    """Adds ``split`` in {'train', 'test'} with exact sizes."""
    d = _unique(df, key).withColumn("__u", hash_u(key, seed))
    hist = _histogram(d, "__u", U_BITS - 16)  # the number of rows, and the way to the cut
    n_train, _ = split_sizes_two(sum(r["n"] for r in hist), test)
    cut = rank_cut(d, "__u", key, n_train, histogram=hist)
    return d.withColumn(out, F.when(_before("__u", key, cut), "train").otherwise("test")).drop("__u")


def train_val_test(df: DataFrame, key: str, rest: float = 0.30, test_of_rest: float = 0.5,
                   seed: int = 42, out: str = "split") -> DataFrame:
    """70 / 15 / 15 with exact sizes: rest = ceil(0.3 n), test = ceil(0.5 rest)."""
    d = _unique(df, key).withColumn("__u", hash_u(key, seed))
    hist = _histogram(d, "__u", U_BITS - 16)  # one for both cuts
    n_train, n_rest = split_sizes_two(sum(r["n"] for r in hist), rest)
    n_val, _ = split_sizes_two(n_rest, test_of_rest)
    c1 = rank_cut(d, "__u", key, n_train, histogram=hist)
    c2 = rank_cut(d, "__u", key, n_train + n_val, histogram=hist)
    return d.withColumn(out, F.when(_before("__u", key, c1), "train")
                              .when(_before("__u", key, c2), "val").otherwise("test")).drop("__u")


def under_sample(df: DataFrame, group_col: str, group, n: int, key: str, seed: int = 1) -> DataFrame:
    """D3: exactly ``n`` rows of one group (first ``n`` in hash order)."""
    g = _unique(df.where(F.col(group_col) == F.lit(group)), key).withColumn("__u", hash_u(key, seed))
    hist = _histogram(g, "__u", U_BITS - 16)
    size = sum(r["n"] for r in hist)
    if n > size:
        raise ValueError(f"Cannot take a larger sample ({n}) than the group ({size})")
    cut = rank_cut(g, "__u", key, n, histogram=hist)
    return g.where(_before("__u", key, cut)).drop("__u")


def over_sample(df: DataFrame, group_col: str, group, n: int, key: str, seed: int = 1) -> DataFrame:
    """``n`` draws with replacement from one group.

    Draw ``i`` picks the group row of rank ``u(i) % size``. Ranks come from
    the distributed ``with_row_index``; draws are ``spark.range(n)`` joined
    on the rank (a hot rank is just a repeated key of the join).
    """
    if n < 0:
        raise ValueError("n must be >= 0")
    spark = df.sparkSession
    g = df.where(F.col(group_col) == F.lit(group)).withColumn("__u", hash_u(key, seed))
    size = g.count()
    if n == 0:
        return df.limit(0)
    if size == 0:
        raise ValueError(f"cannot draw {n} rows from an empty group")
    ranked = with_row_index(g, ["__u", key], "__r")
    draws = (spark.range(n).withColumn("__r", F.pmod(hash_u(F.col("id"), seed + 1), F.lit(size)))
                 .select("__r"))
    return draws.join(ranked, "__r").drop("__r", "__u")


def rebalance(df: DataFrame, group_col: str, under_group, over_group, reference_group,
              key: str, seed: int = 1) -> DataFrame:
    """Others (null group kept) + under-sampled group + over-sampled extra rows.

    Target size = size of ``reference_group``; the over-sampled group keeps
    all its rows and gets ``target - size`` extra draws.
    """
    # Two groups' sizes, however many groups there are.
    asked = df.where(F.col(group_col).isin([g for g in {reference_group, over_group} if g is not None]))
    counts = {r[0]: r[1] for r in asked.groupBy(group_col).count().collect()}
    target = counts.get(reference_group, 0)
    others = keep_not_equal(df, group_col, under_group)
    under = under_sample(df, group_col, under_group, target, key, seed)
    extra = over_sample(df, group_col, over_group, target - counts.get(over_group, 0), key, seed)
    return stack_by_name([others, under, extra])


def stratified_folds(df: DataFrame, label: str, key: str, k: int = 3, seed: int = 42,
                     out: str = "fold") -> DataFrame:
    """fold = (rank inside its class in hash order) mod k.

    The rank is global index minus the class start, from one range sort on
    ``(label, u, key)``: a class holding a third of the rows is split over
    many partitions, never gathered in one task.
    """
    d = df.withColumn("__u", hash_u(key, seed))
    idx = with_row_index(d, [label, "__u", key], "__i")
    starts = idx.groupBy(label).agg(F.min("__i").alias("__s")).withColumnRenamed(label, "__l")
    starts = bounded_broadcast(starts, 100_000)  # one row per class, size checked
    return (idx.join(starts, idx[label].eqNullSafe(starts["__l"]), "inner").drop("__l")
               .withColumn(out, ((F.col("__i") - F.col("__s")) % k).cast("int"))
               .drop("__i", "__s", "__u"))
