"""A pair that holds a third of all rows must not end up in one task."""

import re
import uuid

import pytest
from pyspark.sql import functions as F

from assaykit.operators.cohort import file_summary, keep_cohort
from assaykit.operators.heavy import SALT, measure, salted
from assaykit.operators.wide import label_wide, sized_label_wide
from assaykit.plans import split_by_item

SETTINGS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "200k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}
N = 120_000


@pytest.fixture
def hot(spark, tmp_path):
    """Rows of which a third share one pair, stored so that many tasks read them."""
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    rows = spark.range(0, N, 1, 16).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("u"), "id")).alias("uid"),
        F.lit("1").alias("id"),
        F.concat(F.lit("f"), F.col("id") % 4).alias("file"),
        F.sha2(F.col("id").cast("string"), 512).alias("payload"),
    )
    rows.write.parquet(str(tmp_path / "rows"))
    yield spark.read.parquet(str(tmp_path / "rows"))
    for name in SETTINGS:
        spark.conf.unset(name)


def final_plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_semi_join_is_split(spark, hot):
    wanted = hot.where("uid = 'hot' or file = 'f1'")
    kept = keep_cohort(hot, wanted)
    assert len(kept.collect()) == wanted.count()
    assert re.search(r"SortMergeJoin\(skew=true\).*LeftSemi", final_plan(kept))


def test_left_join_is_split(spark, hot):
    files = spark.range(5).selectExpr("concat('f', id) as filename")
    summary = file_summary(hot, hot.where("uid = 'hot'"), files, "file")
    rows = {row.filename: (row.source_rows, row.retained_rows) for row in summary.collect()}
    assert rows["f4"] == (0, 0) and rows["f0"] == (N // 4, N // 12)
    assert re.search(r"SortMergeJoin\(skew=true\).*LeftOuter", final_plan(summary))


def typed(rows, *more):
    return rows.selectExpr(
        "uid", "id", "5D as itemresult", "1D as normallowvalue", "9D as normalhighvalue", *more)


def wide_base(rows):
    return rows.selectExpr(
        "uid", "id", "1L as hospid", "'MAN' as usex", "1D as examage", "'a' as image_path_1",
        "'b' as image_path_2", "'train' as split")


def jobs_of(spark, action):
    """What the action returns, and how many jobs it ran."""
    group = f"counted-{uuid.uuid4().hex}"
    spark.sparkContext.setJobGroup(group, "")
    try:
        result = action()
        return result, len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    finally:
        spark.sparkContext.setJobGroup("", "")


def test_one_pass_measures_all_tables(spark, hot, tmp_path):
    hot.select("uid", "id").distinct().write.parquet(str(tmp_path / "pairs"))
    pairs = spark.read.parquet(str(tmp_path / "pairs"))
    few, jobs = jobs_of(spark, lambda: measure([hot, pairs], 10_000))
    many, more = jobs_of(spark, lambda: measure([pairs, hot, *[pairs] * 6], 10_000))
    assert jobs == more
    assert few.rows == [N, pairs.count()] and many.rows[1] == N
    assert [len(h) for h in few.heavy] == [1, 0] and [len(h) for h in many.heavy] == [0, 1, *[0] * 6]
    (pair, count), = few.heavy[0].items()
    assert count == pytest.approx(N // 3, rel=0.01)
    assert few.dealt(10_000) == {pair: (0, -(-count // 10_000))}
    assert many.dealt(10_000) == {pair: (1, -(-count // 10_000))}
    null = spark.createDataFrame([(None, None)] * 5, "uid string, id string")
    assert measure([null, hot.limit(0)], 2).rows == [5, 0]


@pytest.mark.parametrize("limit", [0, 10**9])
def test_heavy_pairs_are_dealt_over_tasks(spark, hot, limit):
    """In the base, in one item table and in two at once; the same rows as in a plain join."""
    pairs = hot.select("uid", "id").distinct()
    few = hot.where("uid = 'hot'").limit(3).unionAll(hot.where("uid <> 'hot'")).select("uid", "id")
    cases = [
        (wide_base(hot), [(typed(pairs), "a"), (typed(pairs), "b")], N),
        (wide_base(pairs), [(typed(hot), "a"), (typed(pairs), "b")], N),
        (wide_base(few), [(typed(pairs), "a"), (typed(hot), "b")], N - N // 3 + N),
    ]
    for base, items, count in cases:
        wide = sized_label_wide(base, items, broadcast_limit=limit, heavy_rows=5_000)
        rows = wide.collect()
        assert len(rows) == count and {(r.a, r.b) for r in rows} == {(0, 0)}
        plain = label_wide(base, items)
        assert sorted(map(tuple, rows)) == sorted(map(tuple, plain.collect()))


def test_no_task_joins_a_heavy_pair_alone(spark, hot):
    pairs = hot.select("uid", "id").distinct()
    found = measure([hot, pairs], 5_000)
    dealt = found.dealt(5_000)
    sides = [salted(wide_base(hot), 0, dealt), salted(typed(pairs), 1, dealt)]
    assert sides[0].count() == N // 3 and sides[1].count() == dealt[next(iter(dealt))][1]
    joined = sides[0].join(sides[1], ["uid", "id", SALT])
    sizes = [r["count"] for r in joined.groupBy(SALT).count().collect()]
    assert len(sizes) == dealt[next(iter(dealt))][1] and max(sizes) <= 1.2 * N // 3 / len(sizes)


def test_hot_item_becomes_many_files(spark, hot, tmp_path):
    hot.selectExpr(
        "encode(case when uid = 'hot' then 'A' else concat('B', id) end, 'utf-8') as itemcode",
        "uid", "id", "payload as itemresult", "'' as normalhighvalue", "'' as normallowvalue",
        "monotonically_increasing_id() as rn",
    ).write.parquet(str(tmp_path / "raw"))
    (tmp_path / "items.csv").write_text("itemname,itemcode\nhot,A\nrest,B1\n")
    summary = split_by_item(
        spark, str(tmp_path / "raw"), str(tmp_path / "items.csv"), str(tmp_path / "out"),
        pattern="*.parquet",
    )
    assert [row["rows"] for row in summary.collect()] == [N // 3, N - N // 3]
    for name in ("hot__A", "rest__B1"):
        parts = list((tmp_path / "out" / f"{name}.parquet").glob("part-*.parquet"))
        assert len(parts) >= 3
