"""Profiles of many datasets at once against those of each one alone."""

import pytest
from pyspark.sql import functions as F

from assaykit.operators import profile
from assaykit.operators.profile_all import count_cells, invalid_sample_of_all, invalid_values_of_all, profiles
from assaykit.plans import profile_datasets
from assaykit.plans.profile import INVALID_SAMPLE, INVALID_VALUES, PROFILE
from conftest import rows

SCHEMA = "uid string, id string, itemresult string, normallowvalue string, normalhighvalue string, filename string"
NAMES = ["甲 a%b__1.parquet", "b.parquet", "c.parquet", "none.parquet"]


def data(spark):
    """A hot dataset with many different invalid values, ties among them, and small ones."""
    made = [(f"u{i % 37}", str(i), [None, "", "  ", "x", "5", "1e400", f"v{i % 211}"][i % 7],
             [None, "1", "无", f"w{i % 150}"][i % 4], ["2", None, "\t"][i % 3], NAMES[0]) for i in range(2000)]
    made += [("u", str(i), "7", None, "9", NAMES[1]) for i in range(3)]
    made += [(None, None, None, "y", "y", NAMES[2])] * 2
    return spark.createDataFrame(made, SCHEMA).repartition(5)


@pytest.fixture
def folder(spark, tmp_path):
    for name in NAMES:
        data(spark).where(F.col("filename") == name).drop("filename").write.parquet(f"{tmp_path}/in/{name}")
    profile_datasets(spark, f"{tmp_path}/in", f"{tmp_path}/out")
    return tmp_path


def test_same_reports_as_one_by_one(spark, folder):
    read = lambda name: spark.read.parquet(f"{folder}/out/{name}")
    counts, values, sample = read(PROFILE), read(INVALID_VALUES), read(INVALID_SAMPLE)
    assert counts.count() == 12
    for name in NAMES:
        df = data(spark).where(F.col("filename") == name)
        columns = {**profile.RESULT_TARGET, **profile.NORMAL_TARGETS}
        mine = F.col("filename") == name
        assert sorted(rows(counts.where(mine).drop("filename"))) == sorted(rows(profile.profile_columns(df, columns)))

        def shown(report, frame, *names):
            return rows(frame.where(mine & (F.col("report") == report)).orderBy("place").select(*names))

        assert shown("result", values, "invalid_value", "rows_count") == rows(profile.invalid_result_values(df))
        assert shown("normals", values, "column_name", "invalid_value", "rows_count") == rows(
            profile.invalid_normal_values(df))
        assert shown("result", sample, "uid", "id", "invalid_value") == rows(
            profile.invalid_result_sample(df, stable=True))
        assert shown("normals", sample, "column_name", "uid", "id", "invalid_value") == rows(
            profile.invalid_normal_sample(df, stable=True))
    assert values.where("report = 'result'").groupBy("filename").count().agg(F.max("count")).first()[0] == 100


def test_tasks_send_only_what_is_shown(spark):
    """Ranks are cut before the shuffle, so a hot table does not gather in one task."""
    counted = count_cells(data(spark), "filename")
    for report in (invalid_values_of_all(counted, "filename"), invalid_sample_of_all(data(spark), "filename")):
        plan = report._jdf.queryExecution().sparkPlan().toString()
        assert plan.count("WindowGroupLimit") == 2 and "Partial" in plan


def test_empty_table(spark):
    listed = spark.createDataFrame([("a",)], "filename string")
    counted = count_cells(data(spark).limit(0), "filename")
    assert sorted(rows(profiles(counted, listed, "filename")))[0] == ("a", "itemresult", 0, None, None, None, None)
    assert rows(invalid_values_of_all(counted, "filename")) == []


def test_refusals(spark, folder):
    with pytest.raises(FileExistsError, match=PROFILE):
        profile_datasets(spark, f"{folder}/in", f"{folder}/out")
    profile_datasets(spark, f"{folder}/in", f"{folder}/out", overwrite=True)
    spark.range(1).write.parquet(f"{folder}/in/zz.parquet")
    with pytest.raises(ValueError, match="schema"):
        profile_datasets(spark, f"{folder}/in", f"{folder}/other")
    with pytest.raises(ValueError, match="lack|miss|column"):
        profile_datasets(spark, f"{folder}/in", f"{folder}/other", pattern="zz*")
