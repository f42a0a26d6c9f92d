import pytest

from assaykit.operators.profile import (
    invalid_normal_sample,
    invalid_normal_values,
    invalid_result_sample,
    invalid_result_values,
    profile_normals,
    profile_result,
    require_convertible,
)
from conftest import rows

SCHEMA = "uid string, id string, itemresult string, normallowvalue string, normalhighvalue string"
DATA = [
    ("u1", "1", "5", "1", "9"),
    ("u1", "2", " 5. ", None, "无"),
    ("u2", "1", None, "", "无"),
    ("u2", "2", "阳性", "  ", None),
    ("u3", "1", "阳性", "1d", "1e400"),
    ("u3", "2", "  ", "\t", "9"),
    ("u4", "1", "1e400", "1", "无"),
]


@pytest.fixture
def df(spark):
    return spark.createDataFrame(DATA, SCHEMA)


def test_result_profile(df):
    assert profile_result(df).first().asDict() == {
        "total_rows": 7, "null_rows": 1, "blank_rows": 1, "numeric_rows": 3,
        "non_convertible_rows": 4,
    }


def test_normal_profile(df):
    assert rows(profile_normals(df)) == [
        ("normallowvalue", 7, 1, 2, 2, 4),
        ("normalhighvalue", 7, 1, 0, 3, 3),
    ]


def test_empty_table(df):
    none = df.limit(0)
    assert rows(profile_result(none)) == [(0, None, None, None, None)]
    assert rows(profile_normals(none))[1] == ("normalhighvalue", 0, None, None, None, None)
    require_convertible(profile_result(none))


def test_invalid_values(df):
    assert rows(invalid_result_values(df)) == [("阳性", 2), (None, 1), ("  ", 1)]
    assert rows(invalid_result_values(df, limit=1)) == [("阳性", 2)]
    assert rows(invalid_normal_values(df)) == [
        ("normalhighvalue", "无", 3),
        ("normallowvalue", "", 1),
        ("normallowvalue", "\t", 1),
        ("normallowvalue", "  ", 1),
        ("normallowvalue", "1d", 1),
    ]


def test_samples(df):
    everything = rows(invalid_result_sample(df, stable=True))
    assert everything == [
        ("u2", "1", None), ("u2", "2", "阳性"), ("u3", "1", "阳性"), ("u3", "2", "  "),
    ]
    assert set(rows(invalid_result_sample(df, limit=2))) < set(everything)
    stacked = rows(invalid_normal_sample(df, stable=True))
    assert len(stacked) == 7 and stacked[0] == ("normalhighvalue", "u1", "2", "无")
    assert len(rows(invalid_normal_sample(df, limit=3))) == 3


def test_gate(df):
    with pytest.raises(ValueError, match="'non_convertible_rows': 4"):
        require_convertible(profile_result(df))
    require_convertible(profile_result(df.where("itemresult = '5'")))


def test_one_scan_for_two_columns(df, spark, tmp_path):
    df.write.parquet(str(tmp_path / "t"))
    stored = spark.read.parquet(str(tmp_path / "t"))
    for frame in (profile_normals(stored), invalid_normal_values(stored)):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert plan.count("FileScan") == 1
        assert "ReadSchema: struct<normallowvalue:string,normalhighvalue:string>" in plan
