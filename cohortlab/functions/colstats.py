"""Per-column statistics computed in one distributed aggregation, and exact quantiles in a few more.

The result of a fit is O(columns) and is the only thing that reaches the
driver. Quantiles interpolate linearly (as pandas and DuckDB ``quantile_cont``
do) and are exact; ``exact=False`` takes them from a sketch, in one pass.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlab.functions.quantiles import exact_quantiles
from cohortlab.operators.relational import NUMERIC_TYPES, to_long

_SIMPLE = {
    "count": lambda c: F.count(c),
    "mean": lambda c: F.avg(c),
    "std": lambda c: F.stddev_samp(c),
    "std_pop": lambda c: F.stddev_pop(c),
    "min": lambda c: F.min(c),
    "max": lambda c: F.max(c),
    "sum": lambda c: F.sum(c),
    "n_null": lambda c: F.count(F.when(F.col(c).isNull(), 1)),
    "n_zero": lambda c: F.count(F.when(F.col(c) == 0, 1)),
}


def column_stats(df: DataFrame, cols: Sequence[str], stats: Sequence[str],
                 quantiles: Sequence[float] = (), exact: bool = True,
                 accuracy: int = 100_000) -> dict[str, dict[str, float]]:
    """``{column: {stat: value, 'q0.25': value, ...}}``: one ``agg``, then exact quantiles."""
    cols = list(cols)
    aggs = []
    for i, c in enumerate(cols):
        for s in stats:
            aggs.append(_SIMPLE[s](c).alias(f"s{i}_{s}"))
        if quantiles:
            x = F.col(c).cast("double")
            aggs.append(F.count(x).alias(f"s{i}_size") if exact
                        else F.percentile_approx(x, list(quantiles), accuracy).alias(f"s{i}_q"))
    if not aggs:
        return {c: {} for c in cols}
    row = df.agg(*aggs).first().asDict()
    if quantiles and exact:
        found = exact_quantiles(df, {c: quantiles for c in cols}, {c: row[f"s{i}_size"] for i, c in enumerate(cols)})
    out = {}
    for i, c in enumerate(cols):
        d = {s: row[f"s{i}_{s}"] for s in stats}
        if quantiles:
            qs = [found[c][p] for p in quantiles] if exact else row[f"s{i}_q"] or [None] * len(quantiles)
            for p, v in zip(quantiles, qs):
                d[f"q{p}"] = v
        out[c] = d
    return out


def modes(df: DataFrame, cols: Sequence[str]) -> dict[str, object]:
    """First mode per column (largest count, then smallest value), nulls ignored.

    Unpivot + a partially aggregated ``groupBy(column, value)``; the final
    pick is ``min_by`` per column, so no group ever gathers raw rows.
    Numeric columns are compared as numbers, the rest as strings.
    """
    cols = list(cols)
    types = {f.name: f.dataType for f in df.schema.fields}
    out: dict[str, object] = {c: None for c in cols}
    num = [c for c in cols if isinstance(types[c], NUMERIC_TYPES)]
    oth = [c for c in cols if c not in num]
    for group, vt in ((num, "double"), (oth, "string")):
        if not group:
            continue
        counts = (to_long(df, group, vt).where(F.col("value").isNotNull())
                  .groupBy("column", "value").agg(F.count(F.lit(1)).alias("n")))
        best = counts.groupBy("column").agg(
            F.min_by("value", F.struct((-F.col("n")).alias("k"), F.col("value"))).alias("mode"))
        for r in best.collect():  # one row per column
            out[r["column"]] = r["mode"]
    for c in num:  # give integral columns their integral value back
        if out[c] is not None and types[c].typeName() in ("integer", "long", "short", "byte"):
            out[c] = int(out[c])
    return out


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NUMERIC_TYPES)]
