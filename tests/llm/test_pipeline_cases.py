"""Every stage of the pipeline on nulls, empty and long texts, repeated rows, other columns, no rows."""

from collections import Counter

import pytest
from conftest import SMALL
from pyspark.sql import functions as F

import corpus_pipeline as pipeline
from assaykit.llm.tables import table

LINE = "a passage that stands in several documents and is for certain longer than one hundred bytes, as it goes on and on"
FIRST = "quite other words come first in this document and they go on for some time before "
LONG = "word " * 200_000
HARD = [(None, LINE), (900001, None), (900002, ""), (900003, LINE + " once"), (900003, LINE + " once"), (None, None),
        (900004, LONG), (900005, FIRST + LINE), (900006, "\t \n"), (900007, "é" * 70_000)]
#: Names that the operators use for columns of their own.
CLASHING = ["node", "hub", "score", "predicted", "row", "block", "spans", "mark", "piece", "value", "kept",
            "component", "n_hit", "left", "contaminated", "ids", "length", "shard"]
OWN = "coalesce(doc_id, 900000) >= 900000"


@pytest.fixture(scope="module")
def docs(spark, tmp_path_factory):
    given = spark.read.parquet(f"{SMALL}/documents.parquet").withColumn("n_chars", F.col("n_chars").cast("long"))
    hard = spark.createDataFrame(HARD, "doc_id long, text string").select(
        "doc_id", "text", F.lit(None).cast("string").alias("lang"), F.lit(None).cast("string").alias("source"),
        F.lit(None).cast("long").alias("n_chars"))
    folder = str(tmp_path_factory.mktemp("cases"))
    given.unionByName(hard).select("*", *[F.lit(n).alias(n) for n in CLASHING]).write.parquet(f"{folder}/in")
    return spark.read.parquet(f"{folder}/in")


def hard_rows(df):
    return Counter((r.doc_id, r.text) for r in df.where(OWN).select("doc_id", "text").collect())


@pytest.mark.parametrize("stage", [stage for _, stage in pipeline.STAGES[:4]])
def test_columns_are_carried(spark, docs, stage):
    out = stage(spark, docs, SMALL)
    assert out.columns == docs.columns and dict(out.dtypes) == dict(docs.dtypes)
    assert out.where(" or ".join(f"`{n}` <> '{n}'" for n in CLASHING)).isEmpty()
    ids = Counter(r.doc_id for r in docs.select("doc_id").collect())
    assert not Counter(r.doc_id for r in out.select("doc_id").collect()) - ids


@pytest.mark.parametrize("stage", [stage for _, stage in pipeline.STAGES])
def test_no_rows(spark, docs, stage):
    none = stage(spark, docs.limit(0), SMALL)
    assert none.isEmpty() and "doc_id" in none.columns


def test_quality(spark, docs):
    kept, given = hard_rows(pipeline.good_quality(spark, docs, SMALL)), Counter(HARD)
    assert all(kept[row] in (0, given[row]) for row in given) and not kept - given
    alike = [sum(n for (_, text), n in kept.items() if not text) > 0, (None, None) in kept, (900002, "") in kept]
    assert len(set(alike)) == 1


def test_near_duplicates(spark, docs):
    assert hard_rows(pipeline.first_of_group(spark, docs, SMALL)) == Counter(HARD)
    twin = docs.where("doc_id = 900005").withColumn("doc_id", F.lit(900999).cast("long"))
    again = pipeline.first_of_group(spark, docs.unionByName(twin).unionByName(twin), SMALL)
    assert hard_rows(again) == Counter(HARD)


def test_repeats(spark, docs):
    out = pipeline.first_occurrences(spark, docs, SMALL)
    assert hard_rows(out) == Counter([
        (None, LINE), (900001, None), (900002, ""), (900003, " once"), (900003, " once"), (None, None),
        (900004, "word "), (900005, FIRST),
        (900006, "\t \n"), (900007, "é")])
    sizes = out.where(OWN).where("text is not null").select("text", "n_chars").collect()
    assert all(r.n_chars == len(r.text) for r in sizes)


def test_decontamination(spark, docs):
    item = table(spark, SMALL, "benchmark").where("length(text) > 200").first().text
    bad = docs.where("doc_id = 900002").withColumn("text", F.lit(item))
    some = bad.withColumn("text", F.concat(F.lit(item), F.lit(" and more"))).withColumn("doc_id", F.lit(900100).cast("long"))
    out = pipeline.without_test_items(spark, docs.where("doc_id <> 900002 or doc_id is null")
                                      .unionByName(bad).unionByName(some), SMALL)
    rest = Counter(row for row in HARD if row[0] != 900002)
    found = hard_rows(out)
    assert not rest - found
    (left, n), = (found - rest).items()
    assert left[0] == 900100 and left[1].replace(".", "").split() == ["and", "more"] and n == 1


def test_packing(spark, docs):
    out = pipeline.packed(spark, docs.where(OWN), SMALL)
    rows = out.groupBy("doc_id").agg(F.sum("length").alias("n"), F.count("*").alias("pieces")).collect()
    assert {r.doc_id for r in rows} == {row[0] for row in HARD}
    sizes = {r.doc_id: (r.n, r.pieces) for r in rows}
    assert sizes[900001] == sizes[900002] == (1, 1) and sizes[900003][1] == 2 and sizes[900004][1] > 40
    places = out.groupBy("sequence_id").agg(F.sum("length").alias("n"), F.max(F.col("offset") + F.col("length")).alias("end"))
    assert places.where("n <> end or n > 4096").isEmpty()
