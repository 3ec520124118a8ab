"""Ported from the reference's missing-value spec, plus M1-M5 checks."""
import pytest

from cohortlab.operators import missing as M

# The data of the reference's specification.
COLS = "AV133STDY double, TAUSTDY double, GAITSTDY double, PISTDY double, NP4DYSTN double, NP4TOT double"
ROWS = [(1.0, None, 1.0, None, 1.0, 10.0), (None, 2.0, 2.0, None, 2.0, None), (3.0, None, 3.0, None, None, 30.0),
        (None, 4.0, 4.0, None, 4.0, None), (5.0, 5.0, None, None, 5.0, 50.0)]


@pytest.fixture
def data(spark):
    return spark.createDataFrame(ROWS, COLS)


def test_identify(data):
    n = M.null_counts(data)
    assert n == {"AV133STDY": 2, "TAUSTDY": 2, "GAITSTDY": 1, "PISTDY": 5, "NP4DYSTN": 1, "NP4TOT": 2}


def test_default_handling(data):
    out = M.clean_missing(data)
    assert "PISTDY" not in out.columns
    means = out.agg(*[__import__("pyspark.sql.functions", fromlist=["avg"]).avg(c).alias(c)
                      for c in ["AV133STDY", "TAUSTDY", "GAITSTDY"]]).first()
    assert means["AV133STDY"] == pytest.approx(3.0)
    assert means["TAUSTDY"] == pytest.approx(3.67, abs=0.01)
    assert means["GAITSTDY"] == pytest.approx(2.5)
    assert out.where("NP4DYSTN IS NULL OR NP4TOT IS NULL").count() == 0


def test_threshold(data):
    out = M.clean_missing(data, max_null_share=0.5)
    assert "PISTDY" not in out.columns and "AV133STDY" in out.columns


def test_strategy(data):
    from pyspark.sql import functions as F
    strategy = {"AV133STDY": "median", "TAUSTDY": "constant",
                "GAITSTDY": lambda col, st: F.coalesce(col, F.lit(st["min"]))}
    out = M.clean_missing(data, fills=strategy, fill_value=100)
    assert out.agg(F.median("AV133STDY")).first()[0] == 3.0
    assert [r[0] for r in out.select("TAUSTDY").collect()] == [100.0, 2.0, 100.0, 4.0, 5.0]
    assert out.agg(F.min("GAITSTDY")).first()[0] == 1.0


def test_errors(data):
    with pytest.raises(ValueError):
        M.clean_missing(data, fills="invalid_strategy")
    with pytest.raises(TypeError):
        M.clean_missing("not_a_dataframe")


def test_drop_sparse_strict(data):
    out = M.drop_sparse_columns(data, 0.4)  # 2/5 = 0.4 is not > 0.4
    assert set(out.columns) == {"AV133STDY", "TAUSTDY", "GAITSTDY", "NP4DYSTN", "NP4TOT"}


def test_roles_and_tiered(spark):
    df = spark.createDataFrame([(float(i), i % 3 if i % 25 else None, "x" if i % 2 else "y") for i in range(100)],
                               "num double, code int, txt string")
    roles = M.roles_dict(df, 9)
    assert roles["categorical"] == ["code", "txt"] and roles["numerical"] == ["num"]
    out = M.fit_tiered_impute(df, roles["categorical"], roles["numerical"], 0.05).transform(df)
    assert out.where("code IS NULL").count() == 0


def test_imputed_no_nulls_property(spark):
    from hypothesis import given, settings, strategies as st

    @settings(max_examples=5, deadline=None)
    @given(st.lists(st.one_of(st.none(), st.floats(-100, 100)), min_size=2, max_size=20).filter(
        lambda xs: any(x is not None for x in xs)))
    def check(xs):
        df = spark.createDataFrame([(x,) for x in xs], "v double")
        out = M.fit_mean_mode(df).transform(df)
        assert out.where("v IS NULL").count() == 0
    check()
