"""Exact quantiles against pandas, with the search forced through several rounds."""
import numpy as np
import pandas as pd
import pytest

from cohortlab.functions import quantiles as Q

PS = [0.0, 0.1, 0.25, 0.5, 0.75, 0.999, 1.0]


@pytest.mark.parametrize("at_once", [1, 40, 50_000])
def test_as_pandas(spark, monkeypatch, at_once):
    monkeypatch.setattr(Q, "SORTED_AT_ONCE", at_once)
    rng = np.random.default_rng(3)
    n = 4001
    pdf = pd.DataFrame({"wide": 10 ** rng.uniform(-200, 200, n) * rng.choice([-1, 1], n),
                        "coded": rng.integers(0, 5, n).astype(float),
                        "hot": np.where(rng.random(n) < 0.6, 7.0, rng.normal(7, 1, n)),
                        "constant": 3.0,
                        "gaps": np.where(rng.random(n) < 0.5, np.nan, rng.normal(size=n))})
    df = spark.createDataFrame(pdf).replace(float("nan"), None)
    got = Q.exact_quantiles(df, {c: PS for c in pdf})
    for c in pdf:
        want = pdf[c].quantile(PS)
        assert np.allclose([got[c][p] for p in PS], want.values, rtol=1e-12, atol=0), c


def test_without_values(spark):
    df = spark.createDataFrame([(None, 1.0)], "a double, b double")
    assert Q.exact_quantiles(df, {"a": [0.5], "b": [0.5]}) == {"a": {0.5: None}, "b": {0.5: 1.0}}
    assert Q.exact_quantiles(df.where("false"), {"b": [0.5]}) == {"b": {0.5: None}}


def test_inexact_sketch(spark, monkeypatch):
    monkeypatch.setattr(Q, "SORTED_AT_ONCE", 5)
    monkeypatch.setattr(Q, "ACCURACY", 10)
    monkeypatch.setattr(Q, "MARGIN", 0.001)
    df = spark.range(3000).selectExpr("cast(id * id as double) as x")
    assert Q.exact_quantiles(df, {"x": [0.31]})["x"][0.31] == pytest.approx(np.quantile(np.arange(3000.0) ** 2, 0.31))
