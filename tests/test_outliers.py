"""Ported from the reference's outlier spec."""
import pytest
from pyspark.sql import functions as F

from cohortlab.operators import outliers as X

# The data of the reference's specification.
COLS = "NP3TOT int, NP2SPCH int, NP1DPRS int, ENROLL_AGE int, COHORT int"
DATA = list(zip([20, 25, 22, 100, 24, 23, 21, 150, 26, 200], [1, 2, 1, 15, 2, 1, 2, 20, 1, 2],
                [2, 3, 2, 20, 3, 2, 3, 25, 2, 30], [65, 70, 68, 150, 67, 71, 69, 25, 72, 200], [1] * 10))


@pytest.fixture
def data(spark):
    return spark.createDataFrame(DATA, COLS)


def test_iqr(data):
    out = X.clean_outliers(data, ["NP2SPCH", "NP1DPRS"], "iqr")
    q = data.agg(F.percentile("NP2SPCH", [0.25, 0.75])).first()[0]
    upper = q[1] + 1.0 * (q[1] - q[0])
    assert out.agg(F.max("NP2SPCH")).first()[0] <= upper
    assert out.agg(F.stddev("NP1DPRS")).first()[0] < data.agg(F.stddev("NP1DPRS")).first()[0]


def test_auto_columns(data):
    out = X.clean_outliers(data, threshold=2)
    assert "COHORT" in out.columns
    assert out.where("NP3TOT IS NULL").count() > 0
    assert out.where("COHORT IS NULL").count() == 0  # std 0 is skipped


def test_report(data):
    rep = X.outlier_report(data, X.clean_outliers(data, threshold=2))
    assert set(rep.columns) == {"Column", "Original_Mean", "Cleaned_Mean", "Original_Std", "Cleaned_Std",
                                "Points_Modified"}
    assert rep.where("Points_Modified > 0").count() > 0


def test_threshold_sensitivity(data):
    strict = X.clean_outliers(data, method="zscore", threshold=2).where("NP3TOT IS NULL").count()
    regular = X.clean_outliers(data, method="zscore", threshold=3).where("NP3TOT IS NULL").count()
    assert strict > regular


def test_clip_to_median(data):
    out = X.clip_to_median(data, ["NP3TOT"], "iqr")
    med = data.agg(F.median("NP3TOT")).first()[0]
    assert out.where(F.col("NP3TOT") == med).count() == 1  # only 200 lies above Q3 + 1.5 IQR = 170.375
    assert out.agg(F.max("NP3TOT")).first()[0] == 150
