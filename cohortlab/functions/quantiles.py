"""Exact quantiles of a whole table, without a sort and without one task that holds all values.

A quantile lies between the values of two neighbouring ranks. Each rank is
enclosed by two cut points from a mergeable sketch, the rows below, at and
between the cut points are counted, and the search goes on inside, until few
values are left there; those are sorted. A sketch that is off costs a round,
never a wrong result: a rank is found by counts only.
"""

from __future__ import annotations

import math
from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Entries of a sketch, and the share of ranks that its cut points stay away from the rank asked for.
ACCURACY = 4000
MARGIN = 2 / ACCURACY
# Values between two cut points that may be sorted in one go.
SORTED_AT_ONCE = 50_000
# Aggregates in one pass: keeps the generated code small.
PER_PASS = 60

Interval = tuple[str, float | None, float | None]


def _value(column: str) -> Column:
    return F.col(f"`{column}`").cast("double")


def _inside(at: Interval) -> Column:
    """The values of a column strictly between two others (None: no bound); null elsewhere."""
    column, low, high = at
    x = _value(column)
    cond = x.isNotNull()
    if low is not None:
        cond = cond & (x > F.lit(low))
    if high is not None:
        cond = cond & (x < F.lit(high))
    return F.when(cond, x)


def aggregate(df: DataFrame, exprs: dict) -> dict:
    """``{name: value}`` of aggregates over ``df``, ``PER_PASS`` in one pass."""
    names, out = list(exprs), {}
    for at in range(0, len(names), PER_PASS):
        part = names[at:at + PER_PASS]
        out.update(zip(part, df.agg(*[exprs[k].alias(f"a{i}") for i, k in enumerate(part)]).first()))
    return out


def values_at(df: DataFrame, sizes: dict[str, int], wanted: dict[str, Sequence[int]]) -> dict[tuple[str, int], float]:
    """The value at each 0-based rank of ``wanted``, per column; ``sizes`` holds the numbers of non-null values."""
    found: dict[tuple[str, int], float] = {}
    # Rank -> interval it lies in, rank inside it, number of values inside it.
    open_ranks = {(c, r): ((c, None, None), r, sizes[c]) for c, ranks in wanted.items() for r in ranks}
    while open_ranks:
        few = {t: s for t, s in open_ranks.items() if s[2] <= SORTED_AT_ONCE}
        many = {t: s for t, s in open_ranks.items() if t not in few}
        by_interval: dict[Interval, set[int]] = {}
        for at, inner, _ in few.values():
            by_interval.setdefault(at, set()).add(inner)

        def pick(at: Interval) -> Column:
            ordered = F.array_sort(F.collect_list(_inside(at)))
            return F.transform(F.array(*[F.lit(r) for r in sorted(by_interval[at])]), lambda r: F.get(ordered, r))

        picked = aggregate(df, {at: pick(at) for at in by_interval})
        for t, (at, inner, _) in few.items():
            found[t] = picked[at][sorted(by_interval[at]).index(inner)]

        ends = {t: (at, max(0.0, (inner + 0.5) / size - MARGIN), min(1.0, (inner + 0.5) / size + MARGIN))
                for t, (at, inner, size) in many.items()}
        asked = {at: sorted({p for a, *ps in ends.values() if a == at for p in ps}) for at in {e[0] for e in ends.values()}}
        sketch = aggregate(df, {at: F.percentile_approx(_inside(at), ps, ACCURACY) for at, ps in asked.items()})
        cuts = {t: (at, sketch[at][asked[at].index(a)], sketch[at][asked[at].index(b)]) for t, (at, a, b) in ends.items()}
        counts = {}
        for at, a, b in set(cuts.values()):
            x = _inside(at)
            counts.update({((at, a, b), "below"): F.count_if(x < F.lit(a)), ((at, a, b), "at a"): F.count_if(x == F.lit(a)),
                           ((at, a, b), "between"): F.count_if((x > F.lit(a)) & (x < F.lit(b))),
                           ((at, a, b), "at b"): F.count_if((x == F.lit(b)) & F.lit(a != b))})
        counted = aggregate(df, counts)
        open_ranks = {}
        for t, cut in cuts.items():
            (c, low, high), a, b = cut
            inner, size = many[t][1:]
            for name, place in (("below", (c, low, a)), ("at a", a), ("between", (c, a, b)), ("at b", b), ("above", (c, b, high))):
                n = counted.get((cut, name), size)
                if inner < n:
                    break
                inner, size = inner - n, size - n
            if isinstance(place, tuple):
                open_ranks[t] = (place, inner, n)
            else:
                found[t] = place
    return found


def exact_quantiles(df: DataFrame, probabilities: dict[str, Sequence[float]],
                    sizes: dict[str, int] | None = None) -> dict[str, dict[float, float | None]]:
    """``{column: {p: value}}`` with linear interpolation between ranks, nulls skipped.

    A column without values has null quantiles. NaN counts as the largest
    value. ``sizes``: numbers of non-null values, if they are known already.
    """
    columns = list(probabilities)
    if sizes is None:
        sizes = aggregate(df, {c: F.count(f"`{c}`") for c in columns})
    spots = {c: {p: (sizes[c] - 1) * p for p in probabilities[c]} for c in columns if sizes[c]}
    ranks = {c: sorted({r for s in at.values() for r in (math.floor(s), math.ceil(s))}) for c, at in spots.items()}
    values = values_at(df, sizes, ranks)
    out: dict[str, dict[float, float | None]] = {c: dict.fromkeys(probabilities[c]) for c in columns}
    for c, at in spots.items():
        for p, s in at.items():
            low, high = values[c, math.floor(s)], values[c, math.ceil(s)]
            out[c][p] = low if low == high else low + (high - low) * (s - math.floor(s))
    return out
