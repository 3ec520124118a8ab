"""Ported from the reference's duplicate-handling spec (same frame, same counts)."""
import pytest

from cohortlab.operators import relational as R

ROWS = [(1, "John", 30, "New York"), (2, "Jane", 25, "London"), (3, "Bob", 35, "Paris"),
        (2, "Jane", 25, "London"), (4, "Alice", 28, "Berlin"), (5, "Charlie", 32, "Tokyo"),
        (1, "John", 30, "New York"), (6, "David", 27, "Sydney")]


@pytest.fixture
def data(spark):
    df = spark.createDataFrame(ROWS, "ID int, Name string, Age int, City string")
    from pyspark.sql import functions as F
    return df.withColumn("pos", F.monotonically_increasing_id())


def test_all_columns(data):
    out = R.drop_duplicates(data.drop("pos"))
    assert out.count() == 6
    assert R.duplicate_row_count(out).first()[0] == 0


def test_subset(data):
    out = R.drop_duplicates(data, ["Name", "Age"], "first", order_by=["pos"])
    assert out.count() == 6


def test_keep_last(data):
    out = R.drop_duplicates(data, ["ID", "Name", "Age", "City"], "last", order_by=["pos"])
    assert out.count() == 6
    assert out.orderBy("pos").collect()[-1]["Name"] == "David"


def test_drop_all(data):
    assert R.drop_duplicates(data.drop("pos"), keep=False).count() == 4


def test_analyze_subset(data):
    assert R.rows_by_duplication(data, ["Name"]).count() == 4


def test_analyze_all(data):
    assert R.rows_by_duplication(data.drop("pos")).count() == 4


def test_row_index(data):
    out = R.with_row_index(R.drop_duplicates(data.drop("pos")), ["ID"], "index")
    assert sorted(r["index"] for r in out.collect()) == list(range(6))


def test_subset_needs_order(data):
    with pytest.raises(ValueError):
        R.drop_duplicates(data, ["Name"], "first")


def test_empty(spark):
    df = spark.createDataFrame([], "A int")
    assert R.drop_duplicates(df).count() == 0


def test_no_duplicates(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "A int, B string")
    assert R.drop_duplicates(df).count() == 3


def test_idempotent(data):
    once = R.drop_duplicates(data.drop("pos"))
    assert R.drop_duplicates(once).count() == once.count()
