"""Tasks hold a bounded number of rows, however well these compress."""

import posixpath

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import lab_views as lab
from assaykit import sizing
from assaykit.storage import Storage
from conftest import SMALL, rows


@pytest.mark.parametrize("millions", [36, 216])
def test_partitions_follow_the_rows(spark, millions):
    assert sizing.partitions_for(spark, 1 << 20, millions * 1_000_000) == millions


def test_sorted_datasets_get_more_files_as_rows_grow(spark, monkeypatch):
    """The ranges of the datasets that the cohort filter reads follow the rows; their order stays."""
    usual = entry.cohort_order(spark, SMALL).orderBy("filename", "position")
    usual = rows(usual.select("filename", "position"))
    lines = spark.read.parquet(f"{SMALL}/lineitem.parquet").count()
    monkeypatch.setattr(sizing, "MOST_ROWS", lines // 20, raising=False)
    kept, _ = entry.run_cohort_export(spark, SMALL)
    items = posixpath.join(posixpath.dirname(kept), "items")
    assert len(Storage(spark).children(f"{items}/MAN.parquet", "part-*")) >= 20
    got = entry.cohort_order(spark, SMALL).orderBy("filename", "position").collect()
    assert [(r.filename, r.position) for r in got] == usual
    places = [(r.filename, int(r.uid[1:]), r.id) for r in got]
    assert places == sorted(places)


def test_item_tables_are_grouped_in_tasks_of_few_rows(spark, monkeypatch):
    """The rows are dealt by key before they are grouped, in as many parts as their number asks."""
    usual = sorted(rows(entry.label_dataset(spark, SMALL)), key=repr)
    lines = spark.read.parquet(f"{SMALL}/lineitem.parquet").count()
    monkeypatch.setattr(sizing, "MOST_ROWS", lines // 20, raising=False)
    item = lab.item_table(spark, SMALL, lab.QUANTITY)
    for grouped in (item, lab.text_item_table(spark, SMALL)):
        assert grouped.rdd.getNumPartitions() >= 20
    parts = item.groupBy(F.spark_partition_id()).count().collect()
    assert max(r["count"] for r in parts) < lines // 10
    assert sorted(rows(entry.label_dataset(spark, SMALL)), key=repr) == usual


def test_a_null_key_and_repeats_make_one_item_row(spark, tmp_path):
    made = [(1, 1, 5.0, 3), (1, 1, 2.0, 4), (None, 1, 7.0, 3), (None, 1, 6.0, 3), (2, 1, 9.0, 22)]
    schema = "l_orderkey bigint, l_linenumber bigint, l_quantity double, l_suppkey bigint"
    spark.createDataFrame(made, schema).write.parquet(f"{tmp_path}/lineitem.parquet")
    got = rows(lab.item_table(spark, str(tmp_path), lab.QUANTITY))
    assert sorted(got, key=repr) == sorted(
        [("u1", "1", 2.0, 10.0, 30.0), (None, "1", 6.0, 10.0, 30.0), ("u2", "1", 9.0, None, 30.0)], key=repr)
