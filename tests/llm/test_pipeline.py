"""Each stage of the pipeline on what the one before kept, against plain versions of its rule."""

import zlib

import numpy as np
import public_tokenizers
import pytest
from cases import components, contaminated, ordered, removed, words
from conftest import SMALL
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline as pipeline
from assaykit.llm import queries

NAMES = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def steps(spark, tmp_path_factory):
    """The documents before and after every stage."""
    docs, out = spark.read.parquet(f"{SMALL}/documents.parquet"), []
    folder = tmp_path_factory.mktemp("stages")
    for number, (_, stage) in enumerate(pipeline.STAGES):
        stage(spark, docs, SMALL).write.parquet(f"{folder}/{number}")
        after = spark.read.parquet(f"{folder}/{number}")
        out.append(([r.asDict() for r in docs.collect()], [r.asDict() for r in after.collect()]))
        docs = after
    return out


def by_id(rows):
    return {r["doc_id"]: r for r in rows}


def test_shape(steps):
    assert len(steps) == 5
    for before, after in steps[:-1]:
        assert after and list(after[0]) == NAMES and len(after) <= len(before)
        assert all(r["n_chars"] == len(r["text"]) for r in after)


def test_rejected_documents_go(spark, steps):
    before, after = steps[0]
    scores = {r.doc_id: r.predicted for r in queries.op1_rule_ensemble(spark, SMALL).collect()}
    assert ordered(r.items() for r in after) == ordered(r.items() for r in before if scores[r["doc_id"]] == 1)


def test_one_of_each_group_stays(steps):
    before, after = steps[1]
    rows = [(r["doc_id"], r["text"]) for r in before]
    firsts = {d for d, _, c in components(rows, lambda both, union: 4 * both >= 3 * union) if d == c}
    assert ordered(r.items() for r in after) == ordered(r.items() for r in before if r["doc_id"] in firsts)


def test_repeats_go(steps):
    before, after = steps[2]
    left = by_id(after)
    for doc, size, gone, _, _ in removed([(r["doc_id"], r["text"]) for r in before], 100):
        if gone < size or not size:
            assert len(left[doc]["text"].encode()) == pytest.approx(size - gone, abs=6)
            if not gone:
                assert left[doc] == by_id(before)[doc]
        else:
            assert doc not in left


def test_test_items_go(spark, steps):
    before, after = steps[3]
    items = [tuple(r) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").select("item_id", "text").collect()]
    left = by_id(after)
    for doc, n, hit, _, _, bad in contaminated([(r["doc_id"], r["text"]) for r in before], items):
        if not bad:
            assert left[doc] == by_id(before)[doc]
        elif doc in left:
            assert len(words(left[doc]["text"])) <= len(words(by_id(before)[doc]["text"]))
        else:
            assert hit == n
    assert not any(r[5] for r in contaminated([(r["doc_id"], r["text"]) for r in after], items))


def test_all_that_is_left_is_packed(steps):
    before, after = steps[4]
    tokenizer, want = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")), []
    for r in before:
        ids = [*tokenizer.encode(r["text"], add_special_tokens=False).ids, 1]
        for number, start in enumerate(range(0, len(ids), 4096)):
            own = np.array(ids[start : start + 4096], "<u4").tobytes()
            want.append((r["doc_id"], number, start, len(own) // 4, zlib.crc32(own)))
    got = [(r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in after]
    assert ordered(got) == ordered(want)


def test_packed_pieces_hold_their_ids(steps):
    for r in steps[4][1]:
        assert len(r["ids"]) == 4 * r["length"] and zlib.crc32(r["ids"]) == r["ids_crc32"]


def test_run_is_all_stages(spark, steps):
    got = pipeline.run(spark, SMALL)
    names = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert ordered(got.select(*names).collect()) == ordered([tuple(r[n] for n in names) for r in steps[4][1]])


def test_registered():
    names = list(entry.queries())
    assert [sum(n.startswith(f"op{i}_") for n in names) for i in range(1, 11)] == [1] * 10
    assert "pipeline" in names and set(entry.oracle_sql()) <= set(names)
