import pyarrow as pa
import pytest
from pyspark.errors import PySparkException

from assaykit.plans import filter_by_cohort, split_by_item
from assaykit.operators.cohort import (
    coverage,
    file_summary,
    keep_cohort,
    key_stats,
    missing_from,
    tag_tables,
)
from assaykit.operators.coverage import inner_rows
from assaykit.plans.filter import retained_rows
from assaykit.sources.cohort import read_cohort
from assaykit.sources.directory import Origin, list_sources, read_footers, scan
from assaykit.storage import Storage
from conftest import rows
from lab_files import two_raw_files, write_items, write_table


@pytest.fixture
def folders(tmp_path):
    """Pairs that share one part with a cohort pair, a repeated cohort pair, a source without any."""
    source = tmp_path / "items"
    source.mkdir()
    write_table(
        source / "iron.parquet",
        uid=pa.array(["p7", "p9", "p9", "p8", "p7"]),
        id=pa.array(["spring", "autumn", "spring", "autumn", "spring"]),
        note=pa.array(["first", "second", "other visit", "other person", "third"]),
    )
    write_table(source / "zinc.parquet", uid=pa.array(["p5"]), id=pa.array(["summer"]), note=pa.array(["-"]))
    write_table(
        tmp_path / "cohort.parquet",
        score=pa.array([0.5, 0.25, 0.75, 1.0]),
        id=pa.array([b"autumn", b"spring", b"spring", b"winter"]),
        uid=pa.array([b"p9", b"p7", b"p7", b"p8"]),
    )
    return str(source), str(tmp_path / "cohort.parquet"), str(tmp_path / "out")


@pytest.mark.parametrize("limit", [0, 10**8])
def test_exact_pairs_per_file(spark, folders, limit):
    source, cohort, out = folders
    told = []
    summary = filter_by_cohort(spark, source, cohort, out, broadcast_limit=limit, report=told.append)
    assert [(r["rows"], r["keys"], r["unusable"]) for r in told] == [(4, 3, 1)]
    assert rows(summary) == [("iron.parquet", 5, 3), ("zinc.parquet", 1, 0)]
    kept = spark.read.parquet(f"{out}/iron.parquet")
    assert [r.note for r in kept.collect()] == ["first", "second", "third"]
    assert kept.schema == spark.read.parquet(f"{source}/iron.parquet").schema
    empty = spark.read.parquet(f"{out}/zinc.parquet")
    assert empty.count() == 0 and empty.schema == kept.schema
    with pytest.raises(FileExistsError, match="zinc.parquet"):
        filter_by_cohort(spark, source, cohort, out)
    again = filter_by_cohort(spark, source, cohort, out, overwrite=True, compression="snappy")
    assert rows(again)[0] == ("iron.parquet", 5, 3)


def test_no_row_kept(spark, folders, tmp_path):
    source, _, out = folders
    write_table(tmp_path / "other.parquet", uid=pa.array(["x"]), id=pa.array(["y"]))
    summary = filter_by_cohort(spark, source, str(tmp_path / "other.parquet"), out)
    assert rows(summary) == [("iron.parquet", 5, 0), ("zinc.parquet", 1, 0)]
    assert spark.read.parquet(f"{out}/iron.parquet").columns == ["uid", "id", "note"]


def test_schemas_may_differ_and_bytes_stay_bytes(spark, folders, tmp_path):
    source, cohort, out = folders
    write_table(
        f"{source}/c d+%.parquet",
        id=pa.array([b"autumn", None, b"spring"]),
        uid=pa.array([b"p9", b"p7", b"p7"]),
        n=pa.array([1, 2, 3], pa.int16()),
        raw=pa.array([b"\xff", b"", None]),
    )
    write_table(f"{source}/e.parquet", uid=pa.array([], pa.string()), id=pa.array([], pa.string()),
                note=pa.array([], pa.string()))
    summary = filter_by_cohort(spark, source, cohort, out)
    assert rows(summary) == [
        ("iron.parquet", 5, 3),
        ("c d+%.parquet", 3, 2),
        ("e.parquet", 0, 0),
        ("zinc.parquet", 1, 0),
    ]
    odd = spark.read.parquet(f"{out}/c d+%.parquet")
    assert odd.dtypes == [("id", "binary"), ("uid", "binary"), ("n", "smallint"), ("raw", "binary")]
    assert [(r.n, r.raw) for r in odd.collect()] == [(1, bytearray(b"\xff")), (3, None)]


def test_runs_on_the_split_output(spark, tmp_path):
    two_raw_files(tmp_path / "raw")
    items = write_items(tmp_path / "items.csv")
    split_by_item(spark, str(tmp_path / "raw"), items, str(tmp_path / "by_item"))
    write_table(tmp_path / "c.parquet", uid=pa.array(["person-v20", "person-v12"]), id=pa.array(["v20", "v12"]))
    summary = filter_by_cohort(
        spark, str(tmp_path / "by_item"), str(tmp_path / "c.parquet"), str(tmp_path / "kept")
    )
    assert rows(summary) == [
        ("血_糖__G.7.parquet", 2, 1),
        ("血钾__K.1.parquet", 1, 1),
        ("钠__N.5.parquet", 0, 0),
    ]
    assert spark.read.parquet(str(tmp_path / "kept" / "血_糖__G.7.parquet")).first().id == "v20"


def test_order_is_kept_in_large_files(spark, tmp_path):
    source = tmp_path / "s"
    source.mkdir()
    n = 20_000
    write_table(source / "a.parquet", uid=pa.array([str(i % 7) for i in range(n)]),
                id=pa.array(["k"] * n), seq=pa.array(range(n)))
    write_table(tmp_path / "c.parquet", uid=pa.array(["1", "3", "5"]), id=pa.array(["k"] * 3))
    expected = [i for i in range(n) if i % 7 in (1, 3, 5)]
    for limit in (0, 10**8):
        out = tmp_path / f"out-{limit}"
        filter_by_cohort(spark, str(source), str(tmp_path / "c.parquet"), str(out),
                         broadcast_limit=limit)
        got = []
        for part in sorted((out / "a.parquet").glob("part-*.parquet")):
            got += [r.seq for r in spark.read.parquet(str(part)).collect()]
        assert got == expected


@pytest.mark.parametrize("limit", [0, 10**8])
def test_order_over_files_of_unequal_length(spark, tmp_path, limit):
    """A short file before longer ones: their rows stay in the order of the listing."""
    source = tmp_path / "s" / "a.parquet"
    source.mkdir(parents=True)
    seq = 0
    for number, size in enumerate([200, 5_000, 30, 9_000]):
        write_table(source / f"part-{number}.parquet", uid=pa.array([str(i % 3) for i in range(size)]),
                    id=pa.array(["k"] * size), seq=pa.array(range(seq, seq + size)))
        seq += size
    write_table(tmp_path / "c.parquet", uid=pa.array(["0", "2"]), id=pa.array(["k"] * 2))
    filter_by_cohort(spark, str(tmp_path / "s"), str(tmp_path / "c.parquet"), str(tmp_path / "out"),
                     broadcast_limit=limit)
    got = []
    for part in sorted((tmp_path / "out" / "a.parquet").glob("part-*.parquet")):
        got += [r.seq for r in spark.read.parquet(str(part)).collect()]
    whole = spark.read.parquet(*map(str, sorted(source.glob("part-*")))).where("uid <> '1'")
    assert got == sorted(r.seq for r in whole.collect())
    assert len(list((tmp_path / "out" / "a.parquet").glob("part-*.parquet"))) <= 8


def test_runs_from_another_folder(tmp_path):
    """Executors that cannot import the package still read footers."""
    import os
    import subprocess
    import sys

    two_raw_files(tmp_path / "raw")
    items = write_items(tmp_path / "items.csv")
    code = (
        f"import sys; sys.path.insert(0, {str(os.getcwd())!r})\n"
        "from pyspark.sql import SparkSession\n"
        "spark = SparkSession.builder.master('local[2]').config('spark.ui.enabled', 'false')"
        f".config('spark.sql.warehouse.dir', {str(tmp_path / 'wh')!r}).getOrCreate()\n"
        "from assaykit.plans import split_by_item\n"
        f"print('ROWS', split_by_item(spark, {str(tmp_path / 'raw')!r}, {items!r}, {str(tmp_path / 'out')!r}).count())\n"
    )
    env = {k: v for k, v in os.environ.items() if k not in ("PYTHONPATH", "PYSPARK_GATEWAY_PORT", "PYSPARK_GATEWAY_SECRET")}
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True)
    assert "ROWS 3" in done.stdout, done.stderr[-2000:]


def test_bad_inputs(spark, folders, tmp_path):
    source, cohort, out = folders
    write_table(tmp_path / "none.parquet", uid=pa.array([None, "a"]), id=pa.array(["b", None]))
    with pytest.raises(ValueError, match="complete"):
        filter_by_cohort(spark, source, str(tmp_path / "none.parquet"), out)
    with pytest.raises(ValueError, match="differ"):
        filter_by_cohort(spark, source, cohort, source)
    (tmp_path / "near").mkdir()
    near = str(tmp_path / "near" / "iron.parquet")
    write_table(near, uid=pa.array(["p7"]), id=pa.array(["spring"]))
    with pytest.raises(ValueError, match="overlaps"):
        filter_by_cohort(spark, source, near, str(tmp_path / "near"), overwrite=True)
    write_table(f"{source}/z.parquet", uid=pa.array([b"\xff"]), id=pa.array([b"i"]))
    with pytest.raises(PySparkException):
        filter_by_cohort(spark, source, cohort, out)
    write_table(f"{source}/z.parquet", uid=pa.array(["x"]))
    with pytest.raises(ValueError, match="id"):
        filter_by_cohort(spark, source, cohort, out)


def frame(spark, data, names="uid string, id string"):
    return spark.createDataFrame(data, names)


def test_null_keys_never_match_but_empty_text_does(spark):
    data = frame(spark, [(None, "a"), ("a", None), ("", ""), ("a", "a"), ("a", "b")])
    cohort = frame(spark, [(None, "a"), ("a", None), ("", ""), ("a", "a"), ("b", "b"), ("a", "a")])
    kept = keep_cohort(data, cohort)
    assert sorted(rows(kept)) == [("", ""), ("a", "a")]
    stats = key_stats(cohort).first()
    assert (stats["rows"], stats["keys"], stats["unusable"]) == (6, 3, 3)
    assert key_stats(cohort.limit(0)).first()["keys"] == 0


def test_missing_and_coverage(spark):
    cohort = frame(spark, [("a", "1"), ("b", "2"), ("c", "3"), ("c", "3")])
    one = frame(spark, [("a", "1"), ("a", "1"), ("b", "9"), ("c", "3")])
    none = frame(spark, [("x", "1")])
    assert rows(missing_from(cohort, one)) == [("b", "2")]
    assert inner_rows([cohort, one]) == cohort.join(one, ["uid", "id"]).count() == 4
    assert inner_rows([cohort, one, none]) == 0
    tables = [("one", one), ("none", none), ("all", cohort)]
    listed = frame(spark, [(name,) for name, _ in tables], "table string")
    assert rows(coverage(cohort, tag_tables(tables), listed)) == [
        ("all", 3),
        ("none", 0),
        ("one", 2),
    ]


@pytest.mark.parametrize("small", [False, True])
def test_small_cohort_cuts_the_tables_at_the_scan(spark, tmp_path, small):
    spark.range(1000).selectExpr("cast(id % 50 as string) as uid", "'v' as id", "'t' as table").write.parquet(
        str(tmp_path / "t"))
    data = spark.read.parquet(str(tmp_path / "t"))
    cohort = frame(spark, [("1", "v"), ("2", "v"), ("77", "v")])
    missing = missing_from(cohort, data, broadcast_keys=small)
    counts = coverage(cohort, data, frame(spark, [("t",)], "table string"), broadcast_keys=small)
    assert rows(missing) == [("77", "v")] and rows(counts) == [("t", 2)]
    for df in (missing, counts):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert ("LeftSemi" in plan) is small
        assert "collect_set" not in plan


def test_coverage_of_many_tables_in_one_aggregate(spark):
    """More tables than a word has bits; pairs with a null part count nowhere."""
    present = spark.range(4000).selectExpr(
        "concat('t', id % 130) as table", "if(id % 10 = 9, null, concat('u', id % 7)) as uid", "'v' as id")
    cohort = frame(spark, [("u1", "v"), ("u2", "v"), ("u9", "v"), ("u1", "v"), (None, "v")])
    listed = spark.range(131).selectExpr("concat('t', id) as table")
    got = coverage(cohort, present, listed)
    pairs = {(r.table, r.uid) for r in present.collect()}
    assert rows(got) == sorted(
        (f"t{n}", sum((f"t{n}", u) in pairs for u in ("u1", "u2", "u9"))) for n in range(131))
    for df in (got, missing_from(cohort, present)):
        plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan.replace("BroadcastHashJoin", "")


def test_file_summary_lists_every_file(spark):
    data = frame(spark, [("a", "1", "f1"), ("a", None, "f1"), ("b", "2", "f2"), ("a", "1", "f3"),
                         ("c", "3", "f3"), ("a", "1", "f1")], "uid string, id string, f string")
    files = frame(spark, [("f1",), ("f2",), ("f3",), ("f4",)], "filename string")
    keys = frame(spark, [("a", "1"), ("c", "3")])
    assert rows(file_summary(data, keys, files, "f")) == [
        ("f1", 3, 2),
        ("f3", 2, 2),
        ("f2", 1, 0),
        ("f4", 0, 0),
    ]


def test_small_cohort_needs_no_shuffle_of_the_data(spark, folders):
    source, cohort_path, _ = folders
    found = list_sources(spark, source, "*.parquet")
    origin = Origin.of(found, Storage(spark).qualify(source), read_footers(spark, found))
    rows, cohort = scan(spark, found), read_cohort(spark, cohort_path)
    plan = retained_rows(rows, cohort, origin, small=True)._jdf.queryExecution().executedPlan()
    assert plan.toString().count("Exchange hashpartitioning") == 1
    assert "hashpartitioning(pair" in plan.toString()
    # The kept rows go to ranges of their numbers; nothing is sampled.
    assert plan.toString().count("REPARTITION_BY_NUM") == 1
    assert "rangepartitioning" not in plan.toString()
    assert "LeftSemi, BuildRight" in plan.toString()
