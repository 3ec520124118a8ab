"""Nearest-neighbour imputation of coded columns, without recipients x donors.

Rows are grouped to profiles (the distinct combinations of codes) with counts,
so work grows with the number of profiles. Neighbours are found in rings: ring
j joins a recipient, on the values of the columns that both have but j of them,
with the donors that differ from it in exactly those j columns. Donors that
no ring has reached yet differ in more columns, which bounds their distance from
below; as soon as k donors lie within that bound, the recipient is done. So
most recipients end in ring 0 or 1, and only the rest go on.
"""

from __future__ import annotations

from itertools import combinations
from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortlab.session import bounded_broadcast, checkpointed


def _masked(values: str, mask: Column, m: int) -> Column:
    """The values at the bits of ``mask``, 0 elsewhere."""
    return F.array(*[F.when(mask.bitwiseAND(F.lit(1 << i)) > 0, F.get(values, F.lit(i))).otherwise(F.lit(0.0)) for i in range(m)])


def _ring(patterns: Sequence[int], m: int, j: int, full: int) -> list[tuple[int, int, int, int, int]]:
    """Joins of ring ``j``: (recipient pattern, donor pattern, columns joined on, columns that differ, columns both have)."""
    out = []
    for p in patterns:
        for q in patterns:
            both = p & q
            if p == full or not q & ~p or not both:
                continue
            bits = [1 << i for i in range(m) if both >> i & 1]
            for free in combinations(bits, j):
                out.append((p, q, both & ~sum(free), sum(free), len(bits)))
    return out


def nearest_fill(df: DataFrame, cols: Sequence[str], k: int = 5) -> DataFrame:
    """``df`` with the nulls of the numeric ``cols`` filled by their ``k`` nearest donors' mean; the columns become doubles.

    The distance of two rows is ``sqrt(m / n_both x sum of squared differences)`` over the ``n_both`` of ``m`` columns
    that both have. Donors of a column are the rows that have it and share a column with the recipient. Donors tied at
    the k-th distance count with equal shares of the places left, so the result does not depend on the order
    of rows. Fewer than k donors: the mean of all; none: the mean of the column; a column without values
    stays null. NaN counts as null. Other columns pass through, an empty table stays empty.

    What reaches the driver: the distinct patterns of nulls (at most 2^m) and one flag. A table with very many
    patterns needs as many joins in a ring as pairs of patterns, so m should be small, as with coded categories.
    """
    cols, m = list(cols), len(cols)
    full = (1 << m) - 1
    x = [F.nanvl(F.col(f"`{c}`").cast("double"), F.lit(None)) for c in cols]
    profile = F.array(*x)
    mask = sum((F.when(F.get("x", F.lit(i)).isNotNull(), F.lit(1 << i)).otherwise(F.lit(0)) for i in range(m)), F.lit(0)).cast("long")
    profiles = checkpointed(df.select(profile.alias("x")).groupBy("x").agg(F.count(F.lit(1)).alias("n")).withColumn("mask", mask))
    patterns = [r["mask"] for r in profiles.select("mask").distinct().collect()]
    if not any(p != full for p in patterns):
        return df.withColumns({c: v for c, v in zip(cols, x)})
    # Codes are whole numbers: two that differ are at least 1 apart. Otherwise nothing is certain before the last ring.
    whole = profiles.agg(F.coalesce(F.bool_and(F.forall("x", lambda v: v.isNull() | (v == F.rint(v)))), F.lit(True))).first()[0]
    means = profiles.agg(*[(F.sum(F.get("x", F.lit(i)) * F.col("n")) / F.sum(F.when(F.get("x", F.lit(i)).isNotNull(), F.col("n")))).alias(f"m{i}")
                           for i in range(m)]).first()

    asked = profiles.where(F.col("mask") != full).select("x", "mask", F.explode(F.array(*[F.lit(i) for i in range(m)])).alias("t"))
    opened = asked.where(F.get("x", F.col("t")).isNull())
    found = None
    for j in range(m):
        plan = _ring(patterns, m, j, full)
        if not plan:
            break
        ring = df.sparkSession.createDataFrame(plan, "mask long, donor long, joined long, free long, n_both int")
        left = (opened.join(bounded_broadcast(ring), "mask").where(F.get(F.array(*[F.col("donor").bitwiseAND(F.lit(1 << i)) > 0 for i in range(m)]), F.col("t")))
                .withColumn("key", _masked("x", F.col("joined"), m)))
        right = (profiles.select(F.col("x").alias("y"), "n", F.col("mask").alias("donor"))
                 .join(bounded_broadcast(ring.select("donor", "joined").distinct()), "donor").withColumn("key", _masked("y", F.col("joined"), m)))
        pairs = left.join(right, ["donor", "joined", "key"])
        gaps = [F.when(F.col("free").bitwiseAND(F.lit(1 << i)) > 0, F.get("x", F.lit(i)) - F.get("y", F.lit(i))) for i in range(m)]
        differ = [F.coalesce(g != 0, F.lit(True)) for g in gaps]
        cond = differ[0]
        for g in differ[1:]:
            cond = cond & g
        squares = sum((F.coalesce(g * g, F.lit(0.0)) for g in gaps), F.lit(0.0))
        got = (pairs.where(cond).select("x", "mask", "t", (F.lit(float(m)) * squares / F.col("n_both")).alias("d2"), "n",
                                        (F.get("y", F.col("t")) * F.col("n")).alias("s"))
               .groupBy("x", "mask", "t", "d2").agg(F.sum("n").alias("n"), F.sum("s").alias("s")))
        got = got if found is None else found.unionByName(got)
        found = checkpointed(got.groupBy("x", "mask", "t", "d2").agg(F.sum("n").alias("n"), F.sum("s").alias("s")))
        if not whole:
            continue
        # A donor that is not found yet differs in j + 1 columns or more.
        bounds = {}
        for p, q, joined, free, n_both in plan:
            if n_both > j:
                bounds[p] = min(bounds.get(p, float("inf")), m * (j + 1) / n_both)
        if not bounds:
            break
        least = bounded_broadcast(df.sparkSession.createDataFrame(list(bounds.items()), "mask long, least double"))
        done = found.join(least, "mask").where("d2 < least").groupBy("x", "t").agg(F.sum("n").alias("sure")).where(F.col("sure") >= k)
        opened = checkpointed(opened.join(done, ["x", "t"], "left_anti").join(least.select("mask"), "mask", "left_semi"))
        if opened.isEmpty():
            break

    mean = F.get(F.array(*[F.lit(means[i]).cast("double") for i in range(m)]), F.col("t"))
    if found is None:
        filled = asked.where(F.get("x", F.col("t")).isNull()).select("x", "t", mean.alias("v"))
    else:
        before = F.coalesce(F.sum("n").over(Window.partitionBy("x", "t").orderBy("d2").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        part = found.withColumn("w", F.least(F.col("n"), F.greatest(F.lit(k) - before, F.lit(0)))).where("w > 0")
        value = part.groupBy("x", "t").agg((F.sum(F.col("s") / F.col("n") * F.col("w")) / F.sum("w")).alias("v"))
        filled = asked.where(F.get("x", F.col("t")).isNull()).join(value, ["x", "t"], "left").select("x", "t", F.coalesce("v", mean).alias("v"))
    values = filled.groupBy("x").agg(F.map_from_entries(F.collect_list(F.struct("t", "v"))).alias("fill"))  # at most m entries
    rows = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"), profile.alias("x"))
    holes = F.exists("x", lambda v: v.isNull())

    def back(rows: DataFrame, fill) -> DataFrame:
        one = {c: F.coalesce(F.get("x", F.lit(i)), fill(i)) for i, c in enumerate(cols)}
        return rows.select(*[(one[c] if c in one else F.col(f"row.`{c}`")).alias(c) for c in df.columns])

    joined = rows.where(holes).join(bounded_broadcast(checkpointed(values)), "x", "left")
    return back(rows.where(~holes), lambda i: F.lit(None).cast("double")).unionByName(
        back(joined, lambda i: F.element_at("fill", F.lit(i))))
