import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from assaykit.operators.wide import label_wide
from assaykit.plans import export_labels, verify_export
from conftest import rows

BASE = (
    "uid string, id string, hospid bigint, usex string, examage double, image_path_1 string, "
    "image_path_2 string, result_alt int, split string"
)
ITEM = "uid string, id string, itemresult double, normallowvalue double, normalhighvalue double"


@pytest.fixture
def base(spark):
    data = [
        ("p3", "may", 71, "MAN", 29.5, "/scan/31", "/scan/32", 5, "train"),
        ("p1", "june", 12, "WOMAN", 63.0, "/scan/11", "/scan/12", 7, "test"),
        ("p2", "may", 71, "MAN", 44.0, "/scan/21", "/scan/22", 9, "train"),
    ]
    return spark.createDataFrame(data, BASE)


@pytest.fixture
def items(spark):
    """At a bound, above one, without one; and a visit that the second table lacks."""
    iron = [("p1", "june", 7.0, 2.0, 7.0), ("p2", "may", 3.0, 2.0, 7.0), ("p3", "may", 7.1, 2.0, 7.0)]
    zinc = [("p1", "june", 0.4, None, 3.0), ("p2", "april", 1.0, 0.5, 3.0), ("p3", "may", 0.5, 0.5, 3.0)]
    return [
        (spark.createDataFrame(iron, ITEM), "result_iron"),
        (spark.createDataFrame(zinc, ITEM), "result_zinc"),
    ]


EXPECTED = [
    ("p1", "june", 12, "WOMAN", 63.0, "/scan/11", "/scan/12", 0, None, "test"),
    ("p3", "may", 71, "MAN", 29.5, "/scan/31", "/scan/32", 1, 0, "train"),
]


@pytest.mark.parametrize("small", [False, True])
def test_wide(base, items, small):
    wide = label_wide(base, items, broadcast_base=small)
    assert wide.columns == [
        "uid", "id", "hospid", "usex", "examage", "image_path_1", "image_path_2",
        "result_iron", "result_zinc", "split",
    ]
    assert dict(wide.dtypes)["result_zinc"] == "tinyint"
    assert rows(wide) == EXPECTED


def test_repeated_item_keys_multiply_rows(spark, base, items):
    table = items[0][0]
    assert label_wide(base, [(table.unionAll(table), "x")]).count() == 6


def test_bad_mappings(spark, base, items):
    table = items[0][0]
    for names, message in [(["x", "x"], "twice"), (["split"], "hide"), (["uid"], "hide"), ([], "one")]:
        with pytest.raises(ValueError, match=message):
            label_wide(base, [(table, name) for name in names])
    text = table.selectExpr("uid", "id", "cast(itemresult as string) itemresult",
                            "normallowvalue", "normalhighvalue")
    with pytest.raises(TypeError, match="itemresult"):
        label_wide(base, [(text, "x")])
    with pytest.raises(ValueError, match="split"):
        label_wide(base.drop("split"), [(table, "x")])


@pytest.mark.parametrize("limit", [0, 10**8])
def test_export(spark, base, items, tmp_path, limit):
    out = str(tmp_path / "wide.parquet")
    assert export_labels(base, items, out, expected_rows=2, broadcast_limit=limit) == 2
    stored = spark.read.parquet(out)
    assert sorted(rows(stored)) == EXPECTED
    count, first = verify_export(spark, out)
    assert count == 2 and tuple(first) == EXPECTED[0]
    with pytest.raises(FileExistsError):
        export_labels(base, items, out, expected_rows=2)
    assert export_labels(base, items[:1], out, expected_rows=0, overwrite=True) == 3
    assert spark.read.parquet(out).count() == 3
    assert sorted(p.name for p in tmp_path.iterdir()) == ["wide.parquet"]


def test_failed_export_leaves_the_old_result(spark, base, items, tmp_path):
    out = str(tmp_path / "wide.parquet")
    with pytest.raises(RuntimeError, match="2 rows instead of the expected 3"):
        export_labels(base, items, out, expected_rows=3)
    assert list(tmp_path.iterdir()) == []
    export_labels(base, items, out, expected_rows=2)
    with pytest.raises(RuntimeError):
        export_labels(base, items, out, expected_rows=9, overwrite=True)
    assert spark.read.parquet(out).count() == 2


def test_file_layout(spark, base, items, tmp_path):
    many = base.withColumn("n", F.explode(F.sequence(F.lit(1), F.lit(1000)))).drop("n")
    item = many.selectExpr("uid", "id", "5D as itemresult", "1D as normallowvalue", "9D as normalhighvalue")
    export_labels(many, [(item.distinct(), "x")], str(tmp_path / "wide.parquet"), expected_rows=3000)
    part = next((tmp_path / "wide.parquet").glob("part-*.parquet"))
    footer = pq.read_metadata(part)
    group = footer.row_group(0)
    for i in range(group.num_columns):
        column = group.column(i)
        encoded = any("DICTIONARY" in e for e in column.encodings)
        assert column.compression == "ZSTD"
        assert column.is_stats_set
        assert encoded is (column.path_in_schema in ("usex", "split"))


def test_empty_result(spark, base, items, tmp_path):
    none = items[0][0].limit(0)
    out = str(tmp_path / "none.parquet")
    assert export_labels(base, [(none, "x")], out, expected_rows=0) == 0
    assert verify_export(spark, out) == (0, None)
