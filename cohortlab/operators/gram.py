"""Gram matrix of many columns: T3, E6, E8 and the associations of Q3 rest on it.

A task turns its Arrow batches into matrices and adds up their products, so the work is p x p numbers a task
instead of p x p expressions in the plan. The tasks' rows are added in a tree: by 128 tasks, by 128 of those sums, and
once more, so that no group holds the rows of all tasks.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PARTS = ["n", "c", "a", "at", "b", "bt"]
FAN = 128


def _rows(matrices: Sequence[np.ndarray], **fixed) -> pa.RecordBatch:
    p = matrices[0].shape[1]
    first = [pa.array(v, pa.int32()) for v in fixed.values()]
    lists = [pa.ListArray.from_arrays(pa.array(np.arange(0, m.size + 1, p, dtype=np.int32)), pa.array(m.ravel())) for m in matrices]
    return pa.RecordBatch.from_arrays([*first, *lists], [*fixed, *PARTS])


def pair_sums(df: DataFrame, cols: Sequence[str], shift: Sequence[float] | None = None) -> DataFrame:
    """One row per column i with arrays over the columns j, over the rows that have both: ``n`` (rows), ``c`` (products),
    ``a`` and ``b`` (sums and squares of i), ``at`` and ``bt`` (of j). Values are taken less ``shift``; NaN counts as null.

    Exact up to rounding, which a shift near the means keeps small. Memory of a task: six matrices of p x p doubles.
    """
    p = len(cols)
    off = np.zeros(p) if shift is None else np.array([0.0 if s is None else s for s in shift], float)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, part = None, 0
        for b in batches:
            if not b.num_rows:
                continue
            part = b.column(p)[0].as_py()
            x = np.column_stack([b.column(i).to_numpy(zero_copy_only=False).astype(float) for i in range(p)]) - off
            there = ~np.isnan(x)
            x[~there] = 0.0
            m = there.astype(float)
            a, sq = x.T @ m, (x * x).T @ m
            new = [m.T @ m, x.T @ x, a, a.T, sq, sq.T]
            sums = new if sums is None else [s + y for s, y in zip(sums, new)]
        if sums is not None:
            yield _rows([np.ascontiguousarray(s) for s in sums], i=np.arange(p), part=np.full(p, part))

    arrays = ", ".join(f"{c} array<double>" for c in PARTS)
    out = (df.select(*[F.col(f"`{c}`").cast("double").alias(f"x{i}") for i, c in enumerate(cols)], F.spark_partition_id().alias("part"))
           .mapInArrow(partial, f"i int, part int, {arrays}"))

    def added(table: pa.Table) -> pa.Table:
        sums = [table.column(c).combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(table.num_rows, p).sum(axis=0) for c in PARTS]
        return pa.Table.from_batches([_rows([s[None] for s in sums], i=[table.column("i")[0].as_py()], part=[table.column("part")[0].as_py()])])

    for _ in range(2):
        out = out.withColumn("part", F.floor(F.col("part") / FAN).cast("int"))
        out = out.groupBy("i", "part").applyInArrow(added, f"i int, part int, {arrays}")
    return out.groupBy("i").applyInArrow(added, f"i int, part int, {arrays}").drop("part")


def pearson(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(i, j, n, r) of all ordered pairs of columns: the rows that have both, and their correlation (null where undefined)."""
    cols = list(cols)
    means = df.agg(*[F.avg(F.nanvl(F.col(f"`{c}`").cast("double"), F.lit(None))).alias(f"m{i}") for i, c in enumerate(cols)]).first()
    sums = pair_sums(df, cols, list(means))
    each = sums.select("i", F.posexplode(F.arrays_zip(*PARTS)).alias("j", "s")).select("i", "j", "s.*")
    var_i, var_j = F.col("b") - F.col("a") * F.col("a") / F.col("n"), F.col("bt") - F.col("at") * F.col("at") / F.col("n")
    cov = F.col("c") - F.col("a") * F.col("at") / F.col("n")
    # A spread that is only rounding is none.
    some = (F.col("n") > 1) & (var_i > F.col("b") * 1e-14) & (var_j > F.col("bt") * 1e-14)
    r = F.when(some, F.greatest(F.lit(-1.0), F.least(F.lit(1.0), cov / F.sqrt(var_i * var_j))))
    return each.where("n > 0").select("i", "j", F.col("n").cast("long").alias("n"), r.alias("r")).unionByName(
        each.where("n = 0").select("i", "j", F.lit(0).cast("long").alias("n"), F.lit(None).cast("double").alias("r")))
