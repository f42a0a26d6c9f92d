"""A corpus pipeline: documents in, packed training sequences out.

Every stage takes (spark, docs, sf_dir) and returns a frame, which is written as Parquet and
read again as the next stage's documents. All but the last return the columns of documents.
A stage that changes texts sets n_chars anew; a document that loses all its text goes.

In every stage: rows with a null id take part and are judged by their texts; repeated rows (one id,
one text) share one fate; null and empty texts hold nothing that could be cut and stay, but where a
stage says otherwise; texts of any length are taken whole; an empty table gives an empty
one; further columns, whatever their names, are carried along (the last stage returns its own).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from assaykit.llm.fm_index import find_contamination, without_items
from assaykit.llm.near_duplicates import near_duplicates
from assaykit.llm.packing import pack_documents
from assaykit.llm.queries import vocabulary
from assaykit.llm.repeats import without_repeats
from assaykit.llm.rule_ensemble import score_quality
from assaykit.llm.tables import small_enough, stored, table

#: Ids that may be broadcast.
BROADCAST_IDS = 2_000_000


#: Rows of a batch between Spark and Python: whole texts travel in them, on both sides at once.
BATCH_ROWS = 1_000


def small_batches(spark: SparkSession) -> None:
    """Bound the memory of batches of whole documents, for this session; results do not change."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= BATCH_ROWS:
        spark.conf.set(name, str(BATCH_ROWS))


def counted(docs: DataFrame) -> DataFrame:
    """The documents with n_chars as their texts now have."""
    return docs.withColumn("n_chars", F.char_length("text").cast("long")).select(*docs.columns)


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rule ensemble accepts (a score of 0.3 or more).

    Null and empty texts are scored like others, by what was learned of texts without words; a
    null text counts as an empty one. Without labels of both kinds all documents have one score, the
    share of label 1.
    """
    small_batches(spark)
    scored = score_quality(docs, table(spark, sf_dir, "labels"), carry=True)
    return scored.where("predicted = 1").select("row.*")


def first_of_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: that of the least id.

    Null and empty texts are in no group, and rows with a null id in none either, so they stay. Rows
    that repeat an id are one document with several texts: all stay, or all go.
    """
    small_batches(spark)
    gone = stored(near_duplicates(docs).where("not kept").select("doc_id"))
    if small_enough(gone, BROADCAST_IDS):
        gone = F.broadcast(gone)
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def first_occurrences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the long byte strings that an earlier document, or place, already has.

    A null id comes before all others. Repeated rows are one document and lose the same. n_chars is
    set anew for all rows, null for a null text.
    """
    small_batches(spark)
    return counted(without_repeats(docs))


def without_test_items(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts of contaminated documents without the passages of the test set.

    Only what is contaminated by the rule of `find_contamination` is cut; other rows keep their
    texts, n_chars is set anew for all, null for a null text.
    """
    small_batches(spark)
    found = find_contamination(docs, table(spark, sf_dir, "benchmark"))
    return counted(without_items(found, docs.columns))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their token ids, and their places in sequences of 4096 tokens.

    A null text is packed as an empty one, which has its end token alone. Repeated rows are packed
    as often as they occur.
    """
    small_batches(spark)
    return pack_documents(docs, vocabulary("word_bpe_49k.json"))


STAGES = [
    ("quality classifier", good_quality),
    ("near duplicates", first_of_group),
    ("repeated strings", first_occurrences),
    ("decontamination", without_test_items),
    ("packing", packed),
]

#: Learned scores, sketches, suffix order and packing have no SQL; tests/llm/test_pipeline.py holds
#: every stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES, 1):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES):
            docs = stored(docs)
    return docs
