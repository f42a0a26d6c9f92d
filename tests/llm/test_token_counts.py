import numpy as np
import public_tokenizers
import pytest
from cases import HARD, frame, ordered
from conftest import SMALL
from tokenizers import Tokenizer

from assaykit.llm import queries, token_counts
from assaykit.llm.arrays import text_bytes
from assaykit.llm.token_counts import count_tokens, pre_token_starts

PATH = public_tokenizers.path("byte_bpe_50k.json")


def expected(rows):
    tokenizer = Tokenizer.from_file(PATH)
    counts = [len(tokenizer.encode(t or "", add_special_tokens=False)) for _, t in rows]
    return ordered((d, len((t or "").encode()), n, n > 1024) for (d, t), n in zip(rows, counts))


def test_hard_texts(spark):
    assert ordered(count_tokens(frame(spark, HARD), PATH).collect()) == expected(HARD)


def test_small_blocks_and_hot_pre_tokens(spark, monkeypatch):
    monkeypatch.setattr(token_counts, "BLOCK_BYTES", 2_000)
    rows = [(i, f"the same words the whole time and number {i} once\n\nthe end") for i in range(200)]
    docs = frame(spark, rows).repartition(3)
    assert ordered(count_tokens(docs, PATH).collect()) == expected(rows)


def test_empty_table(spark):
    assert count_tokens(frame(spark, HARD).limit(0), PATH).collect() == []


def test_whole_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    assert ordered(queries.op4_token_counts(spark, SMALL).collect()) == expected(rows)


@pytest.mark.parametrize("text", ["a  b", "a\nb", "a \n b", "x's 's 'S", "1a1 .a. a.1", "  a", "a\x1fb c", "ü b", "  "])
def test_cuts_change_no_count(text):
    import pyarrow as pa

    tokenizer = Tokenizer.from_file(PATH)
    raw, offsets = text_bytes(pa.array([text]))
    starts = pre_token_starts(raw, offsets, np.zeros(1, bool)).tolist()
    parts = [raw[a:b].tobytes().decode() for a, b in zip(starts, [*starts[1:], len(raw)])]
    assert "".join(parts) == text
    split = [i for p in parts for i in tokenizer.encode(p, add_special_tokens=False).ids]
    assert split == tokenizer.encode(text, add_special_tokens=False).ids
