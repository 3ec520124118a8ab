"""Plan checks: filters reach the scan, no Python UDF in relational operators,
earliest-row is a pre-shuffle group limit, every query registered runs."""
import re
from pathlib import Path

import pytest

import __spark_entry__ as E
from cohortlab.plans import queries as Q
from tests.conftest import SF


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_pushdown_and_pruning(spark):
    from cohortlab.plans.more_queries import q_keep_eq
    p = _plan(q_keep_eq(spark, SF))
    assert "PushedFilters: [IsNotNull(o_orderstatus), EqualTo(o_orderstatus,F)]" in p
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_orderstatus:string>" in p


def test_no_python_udf_in_relational(spark):
    for name in ["cohort_feature_rows", "tiered_impute", "zscore_to_median", "one_hot_all", "describe",
                 "ks_drift", "fairness_report"]:
        p = _plan(E.queries()[name](spark, SF))
        assert "PythonUDF" not in p and "BatchEvalPython" not in p and "ArrowEvalPython" not in p, name


def test_no_quantile_in_one_task():
    """Quantiles come from ``functions/quantiles.py``: the built-in exact one holds all values in one task."""
    for path in [p for d in ("functions", "operators", "plans") for p in Path(E.__file__).parent.joinpath("cohortlab", d).glob("*.py")]:
        assert not re.search(r"\bpercentile\(", path.read_text()), path


def test_earliest_is_group_limited(spark):
    from cohortlab.plans.queries import q_earliest
    q = q_earliest(spark, SF)
    q.collect()
    s = q._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in s


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns[0] == "c_custkey"


E.queries()  # registers every module
# The library's own queries; those of the optional subpackage have their own tests.
FAST = [n for n in Q.QUERIES if n not in {"fixed_param_classifiers", "tune_logistic_cv", "sensitivity_curve",
                                           "lda_projection", "isolation_forest_outliers", "permutation_importance", "svm_grid", "forest_grid", "best_model_kept"}]


@pytest.mark.parametrize("name", FAST)
def test_every_query_runs(spark, name):
    df = E.queries()[name](spark, SF)
    df.limit(1).collect()
    assert name in E.oracle_sql() or name in {"drift_summary", "feature_importance_top10", "score_comma_text",
                                              "stream_scoring"}
