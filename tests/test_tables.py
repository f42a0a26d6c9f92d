import uuid

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from assaykit.operators.wide import label_wide
from assaykit.plans import (
    convert_item_keys,
    convert_item_table,
    convert_normal_columns,
    convert_result_column,
    convert_unit_column,
    load_parquet,
)
from assaykit.schema import ITEM_TABLE
from assaykit.sinks.tables import bucketing, convert_table, load_jdbc, load_table
from assaykit.sources.tables import read_jdbc
from conftest import rows
from test_convert import lab


@pytest.fixture
def table():
    return f"t_{uuid.uuid4().hex[:12]}"


SCHEMA = "uid string, id string, value string, count bigint, score double, active boolean"
DATA = [("p4", "noon", "阴性", 31, 2.25, False), ("p6", "dusk", None, 47, float("nan"), True)]


def own_tables(spark, table):
    return sorted(t.name for t in spark.catalog.listTables() if t.name.startswith(table))


def test_load(spark, table, tmp_path):
    df = spark.createDataFrame(DATA + DATA[1:], SCHEMA)
    df.write.parquet(str(tmp_path / "d.parquet"))
    assert load_parquet(spark, str(tmp_path / "d.parquet"), table) == 3
    stored = spark.table(table)
    assert stored.dtypes == df.dtypes
    assert sorted(rows(stored))[1:] == [("p6", "dusk", None, 47, None, True)] * 2
    assert own_tables(spark, table) == [table]


def test_modes(spark, table):
    df = spark.createDataFrame(DATA, SCHEMA)
    load_table(df, table)
    with pytest.raises(FileExistsError, match=table):
        load_table(df, table)
    assert load_table(df, table, "append") == 2
    assert spark.table(table).count() == 4
    swapped = df.select("id", "uid", *df.columns[2:])
    with pytest.raises(ValueError, match="columns"):
        load_table(swapped, table, "append")
    with pytest.raises(ValueError, match="columns"):
        load_table(df.drop("active"), table, "append")
    assert load_table(swapped.limit(1), table, "replace") == 1
    assert spark.table(table).columns[:2] == ["id", "uid"]
    assert load_table(df, table + "x", "append") == 2
    assert load_table(df, table + "y", "replace") == 2
    with pytest.raises(ValueError, match="if_exists"):
        load_table(df, table, "ignore")
    with pytest.raises(ValueError, match="letters"):
        load_table(df, "中文")


def test_failed_replace_keeps_the_table(spark, table):
    df = spark.createDataFrame(DATA, SCHEMA)
    load_table(df, table)
    broken = df.selectExpr("uid", "cast(raise_error('no') as string) as id")
    with pytest.raises(PySparkException):
        load_table(broken, table, "replace")
    assert spark.table(table).count() == 2
    assert own_tables(spark, table) == [table]


def test_refused_shapes(spark, table):
    with pytest.raises(TypeError, match="'a'"):
        load_table(spark.sql("select array(1) as a"), table)
    with pytest.raises(TypeError, match="struct"):
        load_table(spark.sql("select named_struct('x', 1) as a"), table)
    with pytest.raises(ValueError, match="letter case"):
        load_table(spark.sql("select 1 as a, 2 as A"), table)
    assert load_table(spark.sql("select null as a, 1 as b"), table) == 1
    assert spark.table(table).dtypes[0] == ("a", "string")


def test_not_null(spark, table):
    df = spark.createDataFrame(DATA, SCHEMA)
    with pytest.raises(PySparkException, match="value must not be NULL"):
        load_table(df, table, not_null=["uid", "value"])
    assert not spark.catalog.tableExists(table)
    assert load_table(df, table, not_null=["uid"]) == 2


def test_failed_attempts_are_in_nobody_s_way(spark, table):
    """Fail, then succeed, many times under one name, for loads and for conversions."""
    df = spark.createDataFrame(DATA * 20, SCHEMA).repartition(8)
    for _ in range(20):
        with pytest.raises(PySparkException, match="must not be NULL"):
            load_table(df, table, "replace", not_null=["value"])
        assert load_table(df, table, "replace") == 40
        with pytest.raises(PySparkException):
            convert_table(spark, table, lambda t: t.selectExpr("uid", "cast(raise_error(id) as string) as id"),
                          keep_backup=False)
        assert convert_table(spark, table, lambda t: t.withColumn("count", t["count"] + 1), keep_backup=False) == 40
    assert own_tables(spark, table) == [table]


def test_other_tables_with_such_names_stay(spark, table):
    df = spark.createDataFrame(DATA, SCHEMA)
    for name in ("", "__old", "__loading", "__new"):
        load_table(df, table + name)
    load_table(df.limit(1), table, "replace")
    convert_table(spark, table, lambda t: t, keep_backup=False)
    assert [spark.table(table + n).count() for n in ("", "__old", "__loading", "__new")] == [1, 2, 2, 2]


def test_conversions_keep_buckets(spark, table):
    load_table(lab(spark, {}, dict(id="i2")), table)
    convert_item_keys(spark, table, buckets=4)
    assert bucketing(spark, table) == (4, ["uid", "id"], ["uid", "id"])
    convert_result_column(spark, table)
    assert bucketing(spark, table) == (4, ["uid", "id"], ["uid", "id"])
    load_table(lab(spark, {}), table + "x")
    convert_result_column(spark, table + "x")
    assert bucketing(spark, table + "x") is None


def test_stepwise_conversion(spark, table):
    load_table(lab(spark, {}, dict(id="i2", itemresult="7", usex="男")), table)
    assert convert_item_keys(spark, table) == 2
    assert rows(spark.table(table).select("uid", "usex").orderBy("usex")) == [
        ("p4", "MAN"),
        ("p4", "WOMAN"),
    ]
    assert spark.table(f"{table}__backup").first().uid == " p4 "
    convert_result_column(spark, table)
    convert_normal_columns(spark, table)
    convert_unit_column(spark, table)
    assert spark.table(table).dtypes == [(name, kind) for name, kind in ITEM_TABLE]
    with pytest.raises(FileExistsError, match="__backup"):
        convert_item_keys(spark, table)


def test_conversion_gates(spark, table):
    load_table(lab(spark, dict(itemresult="阳性")), table)
    with pytest.raises(ValueError, match="non_convertible_rows"):
        convert_result_column(spark, table)
    load_table(lab(spark, dict(itemresult="1e400")), table, "replace")
    with pytest.raises(PySparkException):
        convert_result_column(spark, table)
    load_table(lab(spark, {}, dict(uid="p4", id="noon")), table, "replace")
    with pytest.raises(ValueError, match="unique"):
        convert_item_table(spark, table)
    assert rows(spark.table(table).select("uid"))[0] in [(" p4 ",), ("p4",)]
    assert own_tables(spark, table) == [table]


@pytest.mark.parametrize("buckets", [None, 1, 4])
def test_keys_are_checked_with_and_without_buckets(spark, table, buckets):
    """Repeats may come from trimming alone; a key's rows meet in one bucket, whatever their number."""
    many = [dict(uid=" p4" + " " * (i % 3), id="noon") for i in range(7)]
    load_table(lab(spark, dict(uid="p1"), *many, dict(uid="p9")), table)
    with pytest.raises(ValueError, match="one pair occurs 7 times"):
        convert_item_table(spark, table, buckets=buckets)
    load_table(lab(spark, {}, dict(id="i2"), dict(uid="u3")), table, "replace")
    renamed = lambda df: df.withColumn("id", F.expr("nullif(id, 'i2')"))
    with pytest.raises(ValueError, match="a part is NULL"):
        convert_table(spark, table, renamed, buckets=buckets, unique_keys=True)
    assert convert_table(spark, table, renamed, buckets=buckets, keep_backup=False) == 3
    load_table(lab(spark, {}).limit(0), table, "replace")
    assert convert_item_table(spark, table, buckets=buckets) == 0
    assert own_tables(spark, table) == [table, f"{table}__backup"]


def test_a_bucketed_conversion_reads_its_table_once(spark, table, monkeypatch):
    """No profile and no reading back; the keys are checked behind the write's only shuffle."""
    import assaykit.plans.convert as plan
    import assaykit.sinks.tables as tables

    def forbidden(*args):
        raise AssertionError("read again")

    written, real = [], tables.observed_keys

    def kept(df):
        frame, check = real(df)
        written.append(frame)
        return frame, check

    load_table(lab(spark, {}, dict(id="i2"), dict(uid="u2")), table)
    monkeypatch.setattr(plan, "profile_columns", forbidden)
    monkeypatch.setattr(tables, "require_unique_keys", forbidden)
    monkeypatch.setattr(tables, "observed_keys", kept)
    assert convert_item_table(spark, table, buckets=4) == 3
    physical = written[0]._jdf.queryExecution().executedPlan().toString()
    assert physical.count("Exchange") == 1 and physical.count("FileScan") == 1
    assert "HashAggregate" not in physical


def test_row_count_must_agree(spark, table):
    load_table(lab(spark, {}, dict(id="i2")), table)
    with pytest.raises(RuntimeError, match="2 rows"):
        convert_table(spark, table, lambda df: df.limit(1))
    assert spark.table(table).count() == 2


def test_failed_swap_is_undone(spark, table, monkeypatch):
    import assaykit.sinks.tables as tables

    load_table(lab(spark, {}), table)
    real = tables._rename

    def failing(spark, old, new):
        if "__new_" in old:
            raise RuntimeError("lost")
        real(spark, old, new)

    monkeypatch.setattr(tables, "_rename", failing)
    with pytest.raises(RuntimeError, match="lost"):
        convert_item_table(spark, table)
    assert spark.table(table).count() == 1
    assert not spark.catalog.tableExists(f"{table}__backup")


def test_bucketed_tables_join_without_shuffle(spark, table):
    names = [f"{table}_{i}" for i in range(2)]
    for name in names:
        load_table(lab(spark, {}, dict(id="i2"), dict(uid="u2")), name)
        assert convert_item_table(spark, name, buckets=4) == 3
    items = [(spark.table(name), f"result_{i}") for i, name in enumerate(names)]
    base = spark.table(names[0]).selectExpr(
        "uid", "id", "hospid", "usex", "examage", "'a' as image_path_1", "'b' as image_path_2",
        "'train' as split",
    )
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        wide = label_wide(base, items)
        plan = wide._jdf.queryExecution().executedPlan().toString()
        assert wide.count() == 3
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "hashpartitioning" not in plan and plan.count("SortMergeJoin") == 2


class Recorder:
    def __init__(self):
        self.calls = []

    def jdbc(self, *args, **options):
        self.calls.append((args, options))
        return self


def test_jdbc_read_options():
    class Session:
        read = Recorder()

    read_jdbc(Session, "jdbc:x", "t", {"user": "me"})
    read_jdbc(Session, "jdbc:x", "t", {}, batch_rows=10, split_on=("id", 0, 9, 3))
    (plain, first), (ranged, second) = Session.read.calls
    assert plain == ranged == ("jdbc:x", "t")
    assert first == {"properties": {"user": "me", "fetchsize": "5000"}}
    assert second == {"column": "id", "lowerBound": 0, "upperBound": 9, "numPartitions": 3,
                      "properties": {"fetchsize": "10"}}
    with pytest.raises(ValueError):
        read_jdbc(Session, "jdbc:x", "t", {}, batch_rows=0)


@pytest.fixture
def database(spark, monkeypatch):
    """Stands in for a database: what exists is set, what is written is recorded."""
    import assaykit.sinks.tables as tables
    from pyspark.sql.readwriter import DataFrameWriter

    state = {"columns": None, "written": []}

    def write(writer, url, table, properties):
        state["written"].append((table, properties, writer._df.columns))
        writer.format("noop").mode("overwrite").save()

    monkeypatch.setattr(tables, "jdbc_table_exists", lambda *a: state["columns"] is not None)
    monkeypatch.setattr(
        tables,
        "read_jdbc",
        lambda *a: spark.createDataFrame([], ", ".join(f"{c} string" for c in state["columns"])),
    )
    monkeypatch.setattr(DataFrameWriter, "jdbc", write)
    return state


def test_jdbc_load(spark, database):
    df = spark.createDataFrame(DATA, SCHEMA)
    assert load_jdbc(df, "jdbc:x", "t", {"user": "me"}, batch_rows=7) == 2
    assert database["written"] == [("t", {"user": "me", "batchsize": "7"}, df.columns)]
    database["columns"] = df.columns
    with pytest.raises(FileExistsError):
        load_jdbc(df, "jdbc:x", "t", {})
    assert load_jdbc(df, "jdbc:x", "t", {}, "append") == 2
    with pytest.raises(ValueError, match="columns"):
        load_jdbc(df.select(*reversed(df.columns)), "jdbc:x", "t", {}, "append")
    assert load_jdbc(df.drop("value"), "jdbc:x", "t", {}, "replace") == 2
    assert len(database["written"]) == 3
    for bad in (dict(if_exists="ignore"), dict(batch_rows=0), dict(table="a b")):
        with pytest.raises(ValueError):
            load_jdbc(df, "jdbc:x", bad.pop("table", "t"), {}, **bad)
    with pytest.raises(TypeError):
        load_jdbc(spark.sql("select array(1) a"), "jdbc:x", "t", {})
