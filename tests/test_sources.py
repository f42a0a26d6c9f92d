import pyarrow as pa
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from assaykit.sources.cohort import distinct_keys, read_cohort
from assaykit.sources.dictionary import read_items
from assaykit.sources.directory import Origin, list_sources, read_footers, scan
from assaykit.storage import Storage
from conftest import rows
from lab_files import two_raw_files, write_table


def items_of(spark, tmp_path, content):
    path = tmp_path / "items.csv"
    path.write_bytes(content if isinstance(content, bytes) else content.encode())
    return read_items(spark, str(path))


def test_dictionary_is_stripped_and_numbered(spark, tmp_path):
    text = '﻿note,itemname,itemcode\nx, 甲/乙　,\t2.1 \n\ny,"a ""b"", c\\d",3.1\n'
    assert rows(items_of(spark, tmp_path, text)) == [
        (2, "甲/乙", "2.1", "甲_乙__2.1.parquet"),
        (3, 'a "b", c\\d', "3.1", 'a "b", c_d__3.1.parquet'),
    ]


@pytest.mark.parametrize(
    "text, message",
    [
        ("itemname,code\na,1\n", "itemcode"),
        ("itemname,itemcode\n", "no items"),
        ("itemname,itemcode\na,1\n ,2\n", "line 3.*empty"),
        ("itemname,itemcode\na\n", "line 2.*empty"),
        ("itemname,itemcode\na,1\nb, 1\n", "line 3.*twice"),
        ("itemname,itemcode\na/b,1\na_b,1_\na\\b,1\n", "line 4.*twice"),
        ("itemname,itemcode\na/b,1/\na_b,1\\\n", "line 3.*same file name"),
        ("itemname,itemcode\na,1\na,1\n,\n", "line 3"),
        (b"itemname,itemcode\n\xff,1\n", "UTF-8"),
    ],
)
def test_bad_dictionaries(spark, tmp_path, text, message):
    with pytest.raises(ValueError, match=message):
        items_of(spark, tmp_path, text)


def test_cohort_keys(spark, tmp_path):
    path = tmp_path / "c.parquet"
    write_table(
        path,
        uid=pa.array([b"u1", b"u2", b"u1", None, b"u3", b""], pa.large_binary()),
        id=pa.array(["i1", "i2", "i1", "i4", None, ""]),
        extra=pa.array([1, 2, 3, 4, 5, 6]),
    )
    cohort = read_cohort(spark, str(path))
    assert cohort.columns == ["uid", "id"]
    assert sorted(rows(distinct_keys(cohort))) == [("", ""), ("u1", "i1"), ("u2", "i2")]
    plan = distinct_keys(cohort)._jdf.queryExecution().executedPlan().toString()
    assert "extra" not in plan


def test_cohort_key_types(spark, tmp_path):
    write_table(tmp_path / "n.parquet", uid=pa.array([1]), id=pa.array(["a"]))
    with pytest.raises(TypeError, match="uid"):
        read_cohort(spark, str(tmp_path / "n.parquet"))
    write_table(tmp_path / "m.parquet", uid=pa.array(["a"]))
    with pytest.raises(ValueError, match=r"\['id'\]"):
        read_cohort(spark, str(tmp_path / "m.parquet"))
    write_table(tmp_path / "b.parquet", uid=pa.array([b"\xc3("]), id=pa.array(["a"]))
    with pytest.raises(PySparkException):
        distinct_keys(read_cohort(spark, str(tmp_path / "b.parquet"))).collect()


def test_listing_is_flat_and_sorted(spark, tmp_path):
    two_raw_files(tmp_path / "raw")
    (tmp_path / "raw" / "deep").mkdir()
    write_table(tmp_path / "raw" / "deep" / "z.parq", x=pa.array([1]))
    (tmp_path / "raw" / ".north.parq.crc").write_bytes(b"")
    (tmp_path / "raw" / "_SUCCESS").write_bytes(b"")
    found = list_sources(spark, str(tmp_path / "raw"), "*.parq")
    assert [entry.name for entry in found] == ["north.parq", "south.parq"]
    with pytest.raises(ValueError, match="subdirectories"):
        list_sources(spark, str(tmp_path / "raw"), "deep/*.parq")
    write_table(tmp_path / "raw" / "_c.parq", x=pa.array([1]))
    with pytest.raises(ValueError, match="_c.parq"):
        list_sources(spark, str(tmp_path / "raw"), "*.parq")


def test_footers_and_origin(spark, tmp_path):
    folder = tmp_path / "odd [x] {y}"
    folder.mkdir()
    write_table(folder / "a*1.parquet", x=pa.array([1, 2]))
    write_table(folder / "b?%20.parquet", x=pa.array([3]))
    write_table(folder / "c.parquet", x=pa.array([], pa.int64()))
    found = list_sources(spark, str(folder), "*.parquet")
    footers = read_footers(spark, found).orderBy("path").collect()
    assert [(f.path.rsplit("/", 1)[1], f.rows) for f in footers] == [
        ("a*1.parquet", 2),
        ("b?%20.parquet", 1),
        ("c.parquet", 0),
    ]
    for limit in (0, 10**8):
        origin = Origin.of(found, Storage(spark).qualify(str(folder)), read_footers(spark, found), limit)
        assert origin.rows == 3 and origin.size == sum(p.stat().st_size for p in folder.iterdir())
        df = origin.add(scan(spark, found))
        assert sorted(rows(df.select("x", "__number"))) == [(1, 0), (2, 1), (3, 2)]
        counted = origin.with_names(df.groupBy("__source").agg(F.max("__number").alias("last")))
        assert sorted(rows(counted.select("filename", "last"))) == [
            ("a*1.parquet", 1),
            ("b?%20.parquet", 2),
        ]


def test_rows_of_files_that_were_not_listed(spark, tmp_path):
    for name in ("a", "b"):
        write_table(tmp_path / f"{name}.parquet", x=pa.array([1, 2]))
    found = list_sources(spark, str(tmp_path), "*.parquet")
    origin = Origin.of(found[:1], Storage(spark).qualify(str(tmp_path)), read_footers(spark, found))
    assert origin.rows == 2
    with pytest.raises(PySparkException, match="not among the listed files"):
        origin.add(scan(spark, found)).collect()
