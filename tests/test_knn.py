"""Imputation by nearest donors against an exhaustive search."""
import math
import random

import pytest

from cohortlab.operators import knn

COLS = ["a", "b", "c", "d"]


def plainly(rows, k):
    m = len(COLS)
    out = []
    for r in rows:
        new = list(r)
        for t in range(m):
            if r[t] is not None:
                continue
            near = {}
            for q in rows:
                both = [i for i in range(m) if r[i] is not None and q[i] is not None]
                if q[t] is None or not both:
                    continue
                near.setdefault(m * sum((r[i] - q[i]) ** 2 for i in both) / len(both), []).append(q[t])
            left, total, used = k, 0.0, 0
            for d in sorted(near):
                take = min(left, len(near[d]))
                total, used, left = total + take * sum(near[d]) / len(near[d]), used + take, left - take
            have = [q[t] for q in rows if q[t] is not None]
            new[t] = total / used if used else sum(have) / len(have) if have else None
        out.append(tuple(new))
    return out


def check(spark, rows, k=5):
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "id int, " + ", ".join(f"{c} double" for c in COLS))
    got = [r[1:] for r in sorted(map(tuple, knn.nearest_fill(df, COLS, k).collect()))]
    want = plainly(rows, k)
    assert len(got) == len(want)
    for g, w in zip(got, want):
        assert all((x is None and y is None) or math.isclose(x, y, abs_tol=1e-9) for x, y in zip(g, w)), (g, w)


@pytest.mark.parametrize("levels,step", [(3, 1), (40, 1), (6, 0.25)])
def test_rings_equal_the_exhaustive_search(spark, levels, step):
    rng = random.Random(levels)
    rows = [tuple(None if rng.random() < 0.25 else float(rng.randrange(levels)) * step for _ in COLS) for _ in range(150)]
    check(spark, rows)


def test_ties_empty_profiles_and_missing_donors(spark):
    n = None
    check(spark, [(1.0, n, n, n), (1.0, 2.0, n, n), (1.0, 4.0, n, n), (1.0, 9.0, n, n), (n, n, n, n), (2.0, 5.0, n, n)], k=2)
    check(spark, [(n, 1.0, n, n), (2.0, n, n, n)], k=5)  # no donor shares a column: the mean of the column
    check(spark, [(1.0, 1.0, 1.0, 1.0)] * 40 + [(1.0, 1.0, 1.0, n), (5.0, n, 5.0, 5.0)], k=5)
    check(spark, [(1.0, 2.0, 3.0, 4.0)], k=1)


def test_edges(spark):
    none = spark.createDataFrame([], "id int, a double, b double")
    assert knn.nearest_fill(none, ["a", "b"]).count() == 0
    df = spark.createDataFrame([(1, 1, float("nan"), 7), (2, 1, 4.0, 8), (3, None, 4.0, 9)], "x int, a int, b double, n int")
    assert sorted(map(tuple, knn.nearest_fill(df, ["a", "b"], 1).collect())) == [(1, 1.0, 4.0, 7), (2, 1.0, 4.0, 8), (3, 1.0, 4.0, 9)]


def test_no_product_of_recipients_and_donors(spark):
    rows = [(float(i % 7), float(i % 5), float(i % 3), None if i % 4 == 0 else float(i % 2)) for i in range(3000)]
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in COLS))
    plan = knn.nearest_fill(df, COLS)._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan and "Python" not in plan
