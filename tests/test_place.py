"""Placing rows by numbers, Bloom filters of keys, and digests, against plain versions."""

import random

import pytest
from pyspark.sql import functions as F

from assaykit.operators.bloom import bloom_pages, may_hold, word_count
from assaykit.operators.cohort import keep_cohort
from assaykit.operators.digest import content_digest
from assaykit.operators.place import in_groups, in_ranges, ranks
from conftest import rows


def parts(df):
    """The rows of each partition, in order."""
    listed = df.withColumn("part", F.spark_partition_id()).collect()
    found = {}
    for row in listed:
        found.setdefault(row.part, []).append(tuple(row)[:-1])
    return [found[p] for p in sorted(found)]


@pytest.mark.parametrize("step, partitions", [(1, 5), (7, 5), (100, 3), (1000, 1)])
def test_groups_lie_in_even_ordered_ranges(spark, step, partitions):
    random.seed(step)
    # Group 3 lies at the front alone, group 9 everywhere.
    data = [(3 if n < 120 and random.random() < 0.9 else random.choice([5, 9, 9, 9]), n) for n in range(600)]
    df = spark.createDataFrame(data, "g int, n bigint").repartition(7)
    chunks = df.groupBy("g", F.floor(F.col("n") / step).alias("chunk")).agg(F.count("*").alias("rows"))
    placed = parts(in_groups(df, "g", "n", ranks(chunks, "g"), step, len(data), partitions))
    assert sum(placed, []) == sorted(data)
    if step < 100:
        assert len(placed) == partitions and max(map(len, placed)) <= 1.3 * len(data) / partitions


def test_ranges_are_not_sampled(spark):
    df = spark.range(1000).withColumnRenamed("id", "n").repartition(5)
    placed = in_ranges(df, "n", 1000, 4)
    assert parts(placed) == [[(n,) for n in range(a, a + 250)] for a in (0, 250, 500, 750)]
    assert "rangepartitioning" not in placed._jdf.queryExecution().executedPlan().toString()
    assert rows(in_ranges(df.limit(0), "n", 0, 3)) == []


def test_bloom_filter_holds_every_key(spark):
    pairs = spark.range(0, 20_000, 2).selectExpr("concat('u', id) as uid", "cast(id % 7 as string) as id")
    other = spark.range(1, 200_000, 2).selectExpr("concat('u', id) as uid", "cast(id % 7 as string) as id")
    pages, words = bloom_pages(pairs, 10_000), word_count(10_000)
    assert pages.count() == 1 and len(pages.first().pages) * 4096 == words
    keys = [F.col("uid"), F.col("id")]
    assert pairs.where(may_hold(pages.scalar(), keys, words)).count() == 10_000
    assert other.where(may_hold(pages.scalar(), keys, words)).count() < 0.03 * 100_000
    assert word_count(0) == 4096 and word_count(10**12) * 8 == 64 << 20
    empty = bloom_pages(pairs.limit(0), 0)
    assert pairs.where(may_hold(empty.scalar(), keys, word_count(0))).count() == 0


def test_few_rows_beyond_the_kept_ones_are_shuffled(spark, tmp_path):
    data = spark.range(100_000).selectExpr("concat('u', id) as uid", "'v' as id", "id as n")
    data.write.parquet(str(tmp_path / "data"))
    data = spark.read.parquet(str(tmp_path / "data"))
    cohort = spark.range(0, 100_000, 20).selectExpr("concat('u', id) as uid", "'v' as id")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        kept = keep_cohort(data, cohort, bloom_keys=5_000)
        assert sorted(r.n for r in kept.collect()) == list(range(0, 100_000, 20))
        plan = kept._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
    # The filter lies between the scan and the exchange of the data.
    data_side = plan[plan.index("SortMergeJoin"):]
    assert data_side.index("Exchange hashpartitioning(uid") < data_side.index("Filter") < data_side.index("FileScan")
    assert "Subquery" in data_side
    pages, words = bloom_pages(cohort, 5_000), word_count(5_000)
    sent = data.where(may_hold(pages.scalar(), [F.col("uid"), F.col("id")], words)).count()
    assert 5_000 <= sent <= 1.3 * 5_000


CASES = [
    ("same rows", [(1, "a"), (2, None), (2, None)], True),
    ("other order", [(2, None), (1, "a"), (2, None)], True),
    ("value changed", [(1, "b"), (2, None), (2, None)], False),
    ("null moved", [(1, None), (2, "a"), (2, None)], False),
    ("null to empty", [(1, "a"), (2, ""), (2, None)], False),
    ("row lost", [(1, "a"), (2, None)], False),
    ("row exchanged", [(1, "a"), (1, "a"), (2, None)], False),
    ("pair cancelled", [(1, "a"), (3, "x"), (3, "x")], False),
]


@pytest.mark.parametrize("name, data, same", CASES)
def test_content_digest(spark, name, data, same):
    digest = lambda d: tuple(spark.createDataFrame(d, "n int, s string").agg(*content_digest(
        spark.createDataFrame(d, "n int, s string"), ["n", "s"])).first())
    assert (digest(data) == digest(CASES[0][1])) is same
