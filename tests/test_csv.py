"""The CSV boundary: missing markers, bad fields, inferred types, folders."""
import pytest

from cohortlab.sources import io as IO


@pytest.fixture()
def folder(tmp_path):
    (tmp_path / "b.csv").write_text("n,x,day,t,none\n1,NA,2020-01-02,null,NA\n2,1.5,,ok,\nNaN,2,2021-05-06,1.#IND,NaN\n")
    parts = tmp_path / "a.csv"
    parts.mkdir()
    (parts / "part-0.csv").write_text("k\n1\n")
    (parts / "part-1.csv").write_text("k\n2\n")
    return str(tmp_path)


def test_markers_and_types(spark, folder):
    df = IO.read_csv(spark, f"{folder}/b.csv")
    assert [t for _, t in df.dtypes] == ["bigint", "double", "date", "string", "string"]
    rows = [tuple(r) for r in df.orderBy("n").collect()]
    assert [r[0] for r in rows] == [None, 1, 2] and [r[1] for r in rows] == [2.0, None, 1.5]
    assert [r[3] for r in rows] == [None, None, "ok"] and all(r[4] is None for r in rows)


def test_bad_field(spark, folder):
    ddl = "n bigint, x bigint, day date, t string, none string"
    with pytest.raises(Exception, match="bad field 1.5"):
        IO.read_csv(spark, f"{folder}/b.csv", ddl).collect()
    assert sorted(r["x"] or 0 for r in IO.read_csv(spark, f"{folder}/b.csv", ddl, bad="null").collect()) == [0, 0, 2]


def test_folder(spark, folder):
    got = IO.read_csv_dir(spark, folder)
    assert list(got) == ["a", "b"] and got["a"].count() == 2 and got["b"].count() == 3


def test_rows_with_too_many_or_too_few_fields(spark, tmp_path):
    (tmp_path / "x.csv").write_text("a,b\n1,2\n3,4,5\n6\n")
    for ddl in (None, "a bigint, b bigint"):
        with pytest.raises(Exception, match="more than 2 fields: 5"):
            IO.read_csv(spark, f"{tmp_path}/x.csv", ddl).select("a").collect()
        got = IO.read_csv(spark, f"{tmp_path}/x.csv", ddl, bad="null")
        assert got.columns == ["a", "b"] and sorted(map(tuple, got.collect())) == [(1, 2), (3, 4), (6, None)]
    (tmp_path / "y.csv").write_text("a,b\n1,2\n6\n")
    assert sorted(map(tuple, IO.read_csv(spark, f"{tmp_path}/y.csv").collect())) == [(1, 2), (6, None)]
