"""Projections, filters, joins, aggregations, de-duplication, sorts, unions.

Inventory IDs P1-P10, J1-J5, A1-A11, W1-W4, O1-O4, U1-U3.
"""

from __future__ import annotations

from functools import reduce
from typing import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

NUMERIC_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType,
                 T.FloatType, T.DoubleType, T.DecimalType)
INTEGRAL_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


# --------------------------------------------------------------------------
# P: projections and predicates
# --------------------------------------------------------------------------

def drop_strict(df: DataFrame, *cols: str) -> DataFrame:
    """Drop columns, raising on a name that is not present."""
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise KeyError(f"columns not found: {missing}")
    return df.drop(*cols)


def rename(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Rename columns; one projection for the whole mapping."""
    missing = [c for c in mapping if c not in df.columns]
    if missing:
        raise KeyError(f"columns not found: {missing}")
    return df.withColumnsRenamed(mapping)


def keep_in(df: DataFrame, col: str, values: Iterable) -> DataFrame:
    """Keep rows whose value is in ``values`` (null never matches)."""
    return df.filter(F.col(col).isin(list(values)))


def keep_equal(df: DataFrame, col: str, value) -> DataFrame:
    """Keep rows equal to a constant."""
    return df.filter(F.col(col) == F.lit(value))


def keep_not_equal(df: DataFrame, col: str, value) -> DataFrame:
    """P5: keep rows not equal to a constant; null rows are kept (pandas ``!=``)."""
    return df.filter(~F.col(col).eqNullSafe(F.lit(value)))


def columns_of_type(df: DataFrame, kind: str) -> list[str]:
    """Column names by type class: 'numeric', 'integral', 'string', 'date'."""
    out = []
    for f in df.schema.fields:
        t = f.dataType
        if kind == "numeric" and isinstance(t, NUMERIC_TYPES):
            out.append(f.name)
        elif kind == "integral" and isinstance(t, INTEGRAL_TYPES):
            out.append(f.name)
        elif kind == "string" and isinstance(t, T.StringType):
            out.append(f.name)
        elif kind == "date" and isinstance(t, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            out.append(f.name)
    return out


def split_target(df: DataFrame, target: str, key: str | None = None):
    """Features and target; the key stays in both so rows never align by position."""
    feats = [c for c in df.columns if c != target]
    keep = [key] if key else []
    return df.select(*feats), df.select(*keep, target)


def dedupe_column_names(names: Sequence[str]) -> list[int]:
    """P8 helper: positions of the first occurrence of every name."""
    seen, keep = set(), []
    for i, n in enumerate(names):
        if n not in seen:
            seen.add(n)
            keep.append(i)
    return keep


def select_first_of_duplicate_names(df: DataFrame) -> DataFrame:
    """Keep the first column of each repeated name (positional select)."""
    keep = dedupe_column_names(df.columns)
    if len(keep) == len(df.columns):
        return df
    tmp = [f"__c{i}" for i in range(len(df.columns))]
    renamed = df.toDF(*tmp)
    return renamed.select(*[F.col(tmp[i]).alias(df.columns[i]) for i in keep])


def columns_matching(df: DataFrame, needle: str) -> list[str]:
    """Names containing ``needle`` case-insensitively (``'date' in col.lower()``)."""
    return [c for c in df.columns if needle.lower() in c.lower()]


def assign_where(df: DataFrame, col: str, mask: Column, value) -> DataFrame:
    """P10: boolean-mask assignment. A null mask leaves the value untouched."""
    v = value if isinstance(value, Column) else F.lit(value)
    return df.withColumn(col, F.when(mask, v).otherwise(F.col(col)))


# --------------------------------------------------------------------------
# J: joins (equi-joins only, as in the reference)
# --------------------------------------------------------------------------

def inner_join_keep_keys(left: DataFrame, right: DataFrame, left_on: str, right_on: str,
                         suffix: str = "_drop") -> DataFrame:
    """Inner join on differently named keys; both keys kept, right overlaps suffixed.

    Null keys never match (SQL semantics; pandas would match NaN with NaN).
    """
    overlap = (set(left.columns) & set(right.columns)) - {right_on}
    r = right.withColumnsRenamed({c: c + suffix for c in overlap}) if overlap else right
    return left.join(r, left[left_on] == r[right_on], "inner")


def left_join_drop_right_key(left: DataFrame, right: DataFrame, left_on: str,
                             right_on: str) -> DataFrame:
    """Left join, then drop the right key."""
    if left_on == right_on:
        return left.join(right, on=left_on, how="left")
    return left.join(right, left[left_on] == right[right_on], "left").drop(right[right_on])


def _suffix_overlaps(dfs: Sequence[DataFrame], key: str, suffix: str) -> list[DataFrame]:
    """Rename later overlaps to ``<name><suffix>``; the first holder of a name wins."""
    seen = set(dfs[0].columns)
    out = [dfs[0]]
    for d in dfs[1:]:
        ren = {}
        for c in d.columns:
            if c == key:
                continue
            if c in seen:
                new = c + suffix
                ren[c] = None if new in seen else new  # repeated `_dup`: first kept (P8)
            seen.add(ren.get(c) or c)
        drops = [c for c, v in ren.items() if v is None]
        d = d.drop(*drops).withColumnsRenamed({c: v for c, v in ren.items() if v})
        out.append(d)
    return out


def full_outer_fold(dfs: Sequence[DataFrame], key: str, suffix: str = "_dup",
                    one_row_per_key: bool = False) -> DataFrame:
    """J3 (+P8): fold of full outer joins on one key, ``('', suffix)`` naming.

    When every input holds at most one row per key (the case after W1), the
    fold equals ``unionByName`` + one ``groupBy(key)`` taking the single
    non-null value per column: one shuffle for N tables instead of N-1 join
    exchanges, and partial aggregation keeps hot keys cheap. The caller asks
    for that form with ``one_row_per_key``; a table that repeats a key then
    raises when the plan runs, and rows with a null key stay apart as they do
    in a join. The default is the plain join fold (which can fan out, like the
    reference).
    """
    parts = _suffix_overlaps(list(dfs), key, suffix)
    if not one_row_per_key:
        return reduce(lambda a, b: a.join(b, on=key, how="full"), parts)
    cols = [c for d in parts for c in d.columns if c != key]
    union = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True),
                   [d.withColumn("__part", F.lit(i)) for i, d in enumerate(parts)])
    counts = [F.count(F.when(F.col("__part") == i, 1)) for i in range(len(parts))]
    once = F.greatest(*counts, F.lit(0)) <= 1
    keyed = union.where(F.col(key).isNotNull())
    out = keyed.groupBy(key).agg(*[F.max(c).alias(c) for c in cols], once.alias("__once"))
    checked = F.when(F.col("__once"), F.col(key)).otherwise(
        F.raise_error(F.lit(f"full_outer_fold: a table repeats a value of {key}")).cast(parts[0].schema[key].dataType))
    alone = union.where(F.col(key).isNull()).select(key, *cols)
    return out.select(checked.alias(key), *cols).unionByName(alone)


def inner_fold(dfs: Sequence[DataFrame], key: str) -> DataFrame:
    """Fold of inner joins on one key (overlaps suffixed ``_x``/``_y`` like pandas)."""
    def step(a: DataFrame, b: DataFrame) -> DataFrame:
        overlap = (set(a.columns) & set(b.columns)) - {key}
        a2 = a.withColumnsRenamed({c: c + "_x" for c in overlap})
        b2 = b.withColumnsRenamed({c: c + "_y" for c in overlap})
        return a2.join(b2, on=key, how="inner")
    return reduce(step, dfs)


def rows_at_group_min(df: DataFrame, key: str, col: str) -> DataFrame:
    """Rows equal to their group's minimum (ties survive).

    The group minimum is a partially aggregated ``groupBy`` (O(keys) rows);
    the self-join back is an equi-join on (key, min) that AQE can split when
    a key is hot.
    """
    mins = df.groupBy(key).agg(F.min(col).alias("__min"))
    return (df.join(mins, (df[key] == mins[key]) & (df[col] == mins["__min"]), "inner")
              .drop(mins[key]).drop("__min"))


# --------------------------------------------------------------------------
# A: aggregations (all columns in ONE aggregation)
# --------------------------------------------------------------------------

def group_min(df: DataFrame, key: str, col: str, alias: str | None = None) -> DataFrame:
    """A1."""
    return df.groupBy(key).agg(F.min(col).alias(alias or f"min_{col}"))


def null_stats(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """A2 + A3: one pass, long output ``(column, n_rows, n_null, null_share)``."""
    cols = list(cols or df.columns)
    aggs = [F.count(F.lit(1)).alias("__n")]
    aggs += [F.count(F.when(F.col(c).isNull(), 1)).alias(f"__z{i}") for i, c in enumerate(cols)]
    wide = df.agg(*aggs)
    rows = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"__z{i}").alias("n_null"))
                     for i, c in enumerate(cols)])
    return (wide.select(F.col("__n").alias("n_rows"), F.inline(rows))
                .withColumn("null_share", F.when(F.col("n_rows") > 0,
                                                 F.col("n_null") / F.col("n_rows")))
                .select("column", "n_rows", "n_null", "null_share"))


def to_long(df: DataFrame, cols: Sequence[str], value_type: str = "string",
            ids: Sequence[str] = ()) -> DataFrame:
    """Unpivot ``cols`` to ``(*ids, column, value)`` with a common value type."""
    casted = df.select(*ids, *[F.col(c).cast(value_type).alias(c) for c in cols])
    return casted.unpivot(list(ids), list(cols), "column", "value")


def distinct_counts(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """A4: exact distinct count per column, nulls ignored -> ``(column, n_unique)``.

    Unpivot then two partially aggregated group-bys: the per-(column, value)
    pass is combined map-side, so a hot value costs one row per task.
    All-null columns still appear with 0.
    """
    cols = list(cols or df.columns)
    types = {f.name: f.dataType for f in df.schema.fields}
    # Unpivot per type family so values keep a native type (no costly cast
    # to text, and longs never collapse through a double).
    families: dict[str, list[str]] = {}
    for c in cols:
        t = types[c]
        fam = ("long" if isinstance(t, INTEGRAL_TYPES) else "double" if isinstance(t, NUMERIC_TYPES)
               else "boolean" if isinstance(t, T.BooleanType) else "string")
        families.setdefault(fam, []).append(c)
    counts = None
    for fam, group in families.items():
        pairs = (to_long(df, group, fam).where(F.col("value").isNotNull())
                 .select("column", "value").distinct())
        part = pairs.groupBy("column").agg(F.count(F.lit(1)).alias("n_unique"))
        counts = part if counts is None else counts.unionByName(part)
    names = df.sparkSession.createDataFrame([(c,) for c in cols], "column string")
    return (names.join(counts, "column", "left")
                 .select("column", F.coalesce("n_unique", F.lit(0)).cast("long").alias("n_unique")))


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    """A5: distinct values of one column (nulls kept as one value, like ``unique``)."""
    return df.select(col).distinct()


def value_counts(df: DataFrame, col: str, normalize: bool = False) -> DataFrame:
    """Counts (or shares) per value, nulls excluded."""
    vc = df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("count"))
    if not normalize:
        return vc
    total = vc.agg(F.sum("count")).scalar()  # scalar subquery, no single-task window
    return vc.select(col, (F.col("count") / total).alias("share"))


def duplicate_row_count(df: DataFrame) -> DataFrame:
    """Number of rows that repeat an earlier full row."""
    per_row = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("__n"))
    return per_row.agg(F.coalesce(F.sum(F.col("__n") - 1), F.lit(0)).cast("long")
                       .alias("n_duplicate_rows"))


def shape(df: DataFrame) -> DataFrame:
    """A10: row and column count as a one-row table."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn(
        "n_columns", F.lit(len(df.columns)).cast("long"))


# --------------------------------------------------------------------------
# W: earliest row per key and duplicate handling
# --------------------------------------------------------------------------

def _order_cols(order_by: Sequence, descending: bool = False) -> list[Column]:
    out = []
    for c in order_by:
        c = F.col(c) if isinstance(c, str) else c
        out.append(c.desc_nulls_last() if descending else c.asc_nulls_last())
    return out


def earliest_per_key(df: DataFrame, key: str | Sequence[str], order_by: Sequence,
                     keep: str = "first") -> DataFrame:
    """One row per key: the first (or last) in ``order_by`` order, nulls last.

    ``order_by`` must make the order total (add a tie-break column); pandas
    relies on file order, Spark has none. ``row_number() = 1`` is planned as
    a partial ``WindowGroupLimit`` before the shuffle, so every map task
    ships at most one row per key and a hot key does not land whole in one
    task.
    """
    keys = [key] if isinstance(key, str) else list(key)
    w = Window.partitionBy(*keys).orderBy(*_order_cols(order_by, keep == "last"))
    return (df.withColumn("__rn", F.row_number().over(w))
              .where(F.col("__rn") == 1).drop("__rn"))


def drop_duplicates(df: DataFrame, subset: Sequence[str] | None = None, keep="first",
                    order_by: Sequence | None = None) -> DataFrame:
    """``keep`` in {'first', 'last', False}.

    * all columns, first/last: identical rows, so ``dropDuplicates`` (partial
      aggregation) is exact;
    * subset + first/last: needs ``order_by`` to define first (W1);
    * ``keep=False``: drop every row whose subset repeats; counts per subset
      come from a partially aggregated group-by joined back, so a hot subset
      never collects into one task.
    """
    subset = list(subset) if subset else None
    if keep is False:
        return rows_by_duplication(df, subset, duplicated=False)
    if subset is None or set(subset) == set(df.columns):
        return df.dropDuplicates()
    if order_by is None:
        raise ValueError("keep='first'/'last' on a subset needs order_by: Spark has no row order")
    return earliest_per_key(df, subset, order_by, keep=keep)


def rows_by_duplication(df: DataFrame, subset: Sequence[str] | None = None,
                        duplicated: bool = True) -> DataFrame:
    """W3 (duplicated=True): every row involved in duplication; False: the rest.

    Subset groups are null-safe (null equals null, as in pandas).
    """
    subset = list(subset) if subset else list(df.columns)
    counts = df.groupBy(*subset).agg(F.count(F.lit(1)).alias("__n"))
    dup_keys = counts.where(F.col("__n") > 1).drop("__n")
    cond = reduce(lambda a, b: a & b, [df[c].eqNullSafe(dup_keys[c]) for c in subset])
    return df.join(dup_keys, cond, "left_semi" if duplicated else "left_anti")


# Rows that one partition of a distributed ranking or running sum holds on average.
ROWS_PER_PARTITION = 1_000_000


def partitions_for(df: DataFrame) -> int:
    """Partitions of a range sort, from the counted rows: the same on any session."""
    return max(1, -(-df.count() // ROWS_PER_PARTITION))


def join_keyed(rows: DataFrame, table: DataFrame, on: str, how: str = "left", count: str = "n",
               max_rows: int = 1_000_000, share: int = 1000) -> DataFrame:
    """``rows`` joined (``left`` or ``inner``) to ``table``, which has one row per value of ``on`` and counts in ``count``
    how often the value occurs.

    A table of at most ``max_rows`` rows is broadcast. Beyond that, values with more than one in ``share`` of all
    occurrences are fewer than ``share`` and are broadcast, the rest is shuffled: no task holds a hot value.
    """
    from cohortlab.session import fits_in_rows
    if fits_in_rows(table, max_rows):
        return rows.join(F.broadcast(table.drop(count)), on, how)
    total = table.agg(F.sum(count)).first()[0] or 0
    is_hot = F.coalesce(F.col(count) * share > F.lit(total), F.lit(False))
    hot, cold = table.where(is_hot).drop(count), table.where(~is_hot).drop(count)
    # Null keys match nothing: they stay out of the shuffle.
    none = rows.where(F.col(on).isNull())
    rest = rows.where(F.col(on).isNotNull()).join(F.broadcast(hot.select(on)), on, "left_anti").join(cold, on, how)
    out = rows.join(F.broadcast(hot), on, "inner").unionByName(rest)
    return out.unionByName(none, allowMissingColumns=True) if how == "left" else out


def with_row_index(df: DataFrame, order_by: Sequence, name: str = "index",
                   partitions: int | None = None) -> DataFrame:
    """Exact 0-based position in ``order_by`` order, fully distributed.

    Range-partition + sort inside partitions (a hot value is split across
    partitions by the later sort keys), number rows inside each partition
    with ``monotonically_increasing_id``, and add the partition's offset.
    The offsets (one per partition) are a bounded literal array, so no
    join and no single-partition window. ``order_by`` must be a total order.
    """
    n = partitions or partitions_for(df)
    cols = _order_cols(order_by)
    from cohortlab.session import checkpointed
    # Materialised once (reliable checkpoint in the shared folder): the
    # counts and the final numbering must see the same partitioning, and a
    # lost executor must not re-sample the range bounds.
    staged = checkpointed(df.repartitionByRange(n, *cols).sortWithinPartitions(*cols)
                          .withColumn("__pid", F.spark_partition_id())
                          .withColumn("__mid", F.monotonically_increasing_id()))
    counts = {r["__pid"]: r["n"] for r in
              staged.groupBy("__pid").agg(F.count(F.lit(1)).alias("n")).collect()}
    offsets, acc = [], 0
    for pid in range(max(counts, default=-1) + 1):
        offsets.append(acc)
        acc += counts.get(pid, 0)
    if not offsets:
        return df.withColumn(name, F.lit(None).cast("long")).limit(0)
    off = F.element_at(F.array(*[F.lit(o).cast("long") for o in offsets]), F.col("__pid") + 1)
    local = F.col("__mid").bitwiseAND(F.lit((1 << 33) - 1))
    return staged.withColumn(name, local + off).drop("__pid", "__mid")


# --------------------------------------------------------------------------
# O: sorts and limits
# --------------------------------------------------------------------------

def sort_asc(df: DataFrame, cols: Sequence) -> DataFrame:
    """O1: ascending multi-column sort, nulls last (pandas NaT placement)."""
    return df.orderBy(*_order_cols(cols))


def sort_by_label_order(df: DataFrame, col: str, labels: Sequence[str]) -> DataFrame:
    """O2: sort by the position of ``col`` in ``labels`` (ordered categorical)."""
    pos = F.array_position(F.array(*[F.lit(l) for l in labels]), F.col(col))
    return df.orderBy(F.when(pos > 0, pos).asc_nulls_last())


def top_k(df: DataFrame, score: str, k: int, tiebreak: Sequence[str] = ()) -> DataFrame:
    """O3: top-k by score, descending; planned as TakeOrderedAndProject."""
    return df.orderBy(F.col(score).desc_nulls_last(), *[F.col(c).asc() for c in tiebreak]).limit(k)


def head(df: DataFrame, n: int = 5) -> DataFrame:
    """O4."""
    return df.limit(n)


# --------------------------------------------------------------------------
# U: set operations
# --------------------------------------------------------------------------

def stack_by_name(dfs: Sequence[DataFrame]) -> DataFrame:
    """Stack by column name; missing columns filled with null."""
    dfs = [d.select(*d.columns) for d in dfs]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)


def assert_same_columns(a: DataFrame, b: DataFrame) -> None:
    """Raise if the two column-name sets differ."""
    if set(a.columns) != set(b.columns):
        raise ValueError(f"Column names do not match: {sorted(set(a.columns) ^ set(b.columns))}")


def missing_columns(df: DataFrame, expected: Iterable[str]) -> set[str]:
    """Expected names not present."""
    return set(expected) - set(df.columns)


def cumulative_sums(df: DataFrame, group: str, order: Sequence[str], sums: Sequence[str],
                    partitions: int | None = None, prefix: str = "cum_") -> DataFrame:
    """Running sums of ``sums`` per ``group`` in ``order`` order (inclusive).

    Distributed prefix sum: range-partition on ``(group, *order)`` so one
    group may span many partitions, take the local running sum inside each
    (partition, group), and add the totals of earlier partitions of the
    same group. Those totals form a table of at most partitions + groups
    rows; no task ever holds a whole group. ``order`` must be total within
    a group.
    """
    from cohortlab.session import checkpointed
    df = checkpointed(df) if not partitions else df  # counted and dealt out: computed once
    n = partitions or partitions_for(df)
    staged = checkpointed(df.repartitionByRange(n, F.col(group).asc_nulls_last(),
                                                *[F.col(c).asc_nulls_last() for c in order])
                            .withColumn("__pid", F.spark_partition_id()))
    w = (Window.partitionBy("__pid", group).orderBy(*[F.col(c).asc_nulls_last() for c in order])
               .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    local = staged.select("*", *[F.sum(s).over(w).alias(f"__l_{s}") for s in sums])
    tot = staged.groupBy("__pid", group).agg(*[F.sum(s).alias(f"__t_{s}") for s in sums])
    wo = Window.partitionBy(group).orderBy("__pid")
    offs = tot.select("__pid", F.col(group).alias("__g"),
                      *[(F.coalesce(F.sum(f"__t_{s}").over(wo), F.lit(0)) - F.coalesce(F.col(f"__t_{s}"), F.lit(0)))
                        .alias(f"__o_{s}") for s in sums])
    from cohortlab.session import bounded_broadcast
    offs = bounded_broadcast(offs, 1_000_000)
    j = local.join(offs, (local["__pid"] == offs["__pid"]) & local[group].eqNullSafe(offs["__g"]), "inner")
    return j.select(*[local[c] for c in df.columns],
                    *[(F.col(f"__l_{s}") + F.col(f"__o_{s}")).alias(f"{prefix}{s}") for s in sums])
