import random
import tracemalloc
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pyspark
import pytest
from cases import HARD, frame, ordered, removed
from conftest import SMALL

from assaykit.llm import queries, repeats
from assaykit.llm.repeats import (
    common_prefixes, previous_factors, remove_repeats, repeats_digest, suffix_ranks, without_repeats)
from assaykit.llm.tables import pack, unpack_sorted


def digest(docs, length):
    return ordered(repeats_digest(remove_repeats(docs, length)).collect())


def known(rows):
    return [r for r in rows if r[0] is not None]


def test_hard_texts(spark):
    assert digest(frame(spark, known(HARD)), 100) == ordered(removed(known(HARD), 100))


def test_null_ids_come_first(spark):
    text = "0123456789" * 12 + "abc"
    rows = removed([(-5, text), (1, text)], 100)
    got = digest(frame(spark, [(None, text), (1, text), (None, None)]), 100)
    assert [r[1:] for r in got if r[0] == 1] == [rows[1][1:]]
    assert sorted(r[2] for r in got if r[0] is None) == [0, removed([(1, text)], 100)[0][2]]


@pytest.mark.parametrize("block", [1, 1 << 20])
@pytest.mark.parametrize("parts", [1, 6])
@pytest.mark.parametrize("given", [7, None])
def test_repeated_rows_are_one_document(spark, monkeypatch, given, parts, block):
    """Rows of one id and text keep it, in one block and in several; later ids lose it."""
    monkeypatch.setattr(repeats, "BLOCK_BYTES", block)
    rng = random.Random(3)
    text, other = ("".join(rng.choice("abcdefgh ") for _ in range(400)) for _ in range(2))
    rows = [(given, text)] * 3 + [(given, other), (8, "x" + text), (9, text), (9, text), (10, other + "y")]
    # A null id comes first; the texts of one id share nothing, so that their order does not matter.
    want = [(given if r[0] == -5 else r[0], *r[1:]) for r in
            removed([(-5 if d is None else d, t) for d, t in rows], 100)]
    assert [r[2] for r in want[:4]] == [0] * 4
    assert digest(frame(spark, rows).coalesce(1).repartition(parts), 100) == ordered(want)


def passages(seed, n):
    rng = random.Random(seed)
    shared = ["".join(rng.choice("abcd ") for _ in range(rng.randrange(30, 150))) for _ in range(6)]
    rows = []
    for i in range(n):
        parts = [rng.choice(shared) if rng.random() < 0.6 else "".join(rng.choice("abé ") for _ in range(40))
                 for _ in range(rng.randrange(1, 6))]
        rows.append((i, "".join(parts)))
    return rows + [(n, "a" * 300), (n + 1, "ab" * 200), (n + 2, rows[0][1])]


@pytest.mark.parametrize("spread", [1, 10_000])
def test_passages_against_lookup(spark, monkeypatch, spread):
    """With one run to a bucket, every anchor is spread and settled by the last aggregation."""
    monkeypatch.setattr(repeats, "BUCKET_RUNS", spread)
    monkeypatch.setattr(repeats, "BLOCK_BYTES", 3_000)
    monkeypatch.setattr(repeats, "SLICE_BYTES", 700)
    rows = passages(spread, 120)
    random.Random(1).shuffle(rows)
    docs = frame(spark, rows).repartition(4)
    assert digest(docs, 45) == ordered(removed(rows, 45))


def test_without_broadcasts(spark, monkeypatch):
    monkeypatch.setattr(repeats, "BROADCAST_IDS", 0)
    rows = passages(5, 60)
    assert digest(frame(spark, rows), 45) == ordered(removed(rows, 45))


def test_texts_that_are_left(spark):
    text = "é" * 60
    rows = [(1, text), (2, text), (3, "x" + text + "yz"), (4, None), (5, "")]
    left = without_repeats(frame(spark, rows))
    assert left.columns == frame(spark, rows).columns
    got = dict(tuple(r) for r in left.select("doc_id", "text").collect())
    # Document 1 repeats within itself from its second character on; document 2 is all gone.
    assert got == {1: "é", 3: "xyz", 4: None, 5: ""}


def test_empty_table(spark):
    assert digest(frame(spark, []), 100) == []


def test_whole_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    assert ordered(queries.op8_repeats(spark, SMALL).collect()) == ordered(removed(rows, 100))


@pytest.mark.parametrize("length", [8, 9, 20, 73, 100, 150])
def test_ranks(length):
    rng = np.random.default_rng(length)
    text = rng.integers(97, 99, 2_000).astype(np.uint8)
    text[1_000:1_700] = text[100:800]
    at = np.sort(rng.choice(2_000 - length, 900, replace=False))
    prefixes = [text[i : i + length].tobytes() for i in at]
    order = {p: i for i, p in enumerate(sorted(set(prefixes)))}
    assert suffix_ranks(text, at, length).tolist() == [order[p] for p in prefixes]


@pytest.mark.parametrize("letters, length", [("a", 9), ("ab", 12), ("abc", 40), ("abcdefgh", 100)])
def test_longest_previous_factors_against_all_pairs(monkeypatch, letters, length):
    monkeypatch.setattr(repeats, "COMPARED_BYTES", 7 * length)
    rng = random.Random(length)
    part = "".join(rng.choice(letters) for _ in range(60))
    data = (part * 3 + "".join(rng.choice(letters) for _ in range(150)) + part[:50] * 2).encode()
    text = np.frombuffer(data, np.uint8)
    at = np.array(sorted(rng.sample(range(len(data) - length + 1), 150)))

    def agree(i, j):
        return next((k for k in range(length) if data[i + k] != data[j + k]), length)

    want = [max((agree(i, j) for j in at[:n].tolist()), default=0) for n, i in enumerate(at.tolist())]
    assert previous_factors(text, at, length).tolist() == want
    assert common_prefixes(text, at[1:], at[:-1], length).tolist() == [
        agree(i, j) for i, j in zip(at[1:].tolist(), at[:-1].tolist())]
    assert previous_factors(text, at[:1], length).tolist() == [0]


def letters_of(seed, n):
    return np.random.default_rng(seed).integers(97, 123, n, dtype=np.uint8)


def test_shards_are_even(monkeypatch):
    """Anchors are least hashes; shards by their size would give the first one half of them."""
    monkeypatch.setattr(pyspark, "TaskContext", SimpleNamespace(get=lambda: SimpleNamespace(partitionId=lambda: 0)))
    texts = ["".join(map(chr, letters_of(seed, 2_000))) for seed in range(200)]
    batch = pa.RecordBatch.from_pydict({"doc_id": range(200), "mark": [0] * 200, "text": texts})
    held = np.zeros(50, np.int64)
    for asked in repeats.ask(iter([batch]), 50, 100):
        for shard, hashes in zip(asked.column(0).to_pylist(), asked.column(4).to_pylist()):
            held[shard] += len(unpack_sorted(hashes)) if hashes else 0
    assert held.max() < 2 * held.mean() and held.min() > held.mean() / 2


def test_buckets_of_a_large_part_stay_small(monkeypatch):
    """A part that holds more than its share is put in order in more steps, not in larger ones."""
    ordered_bytes = []
    settle = repeats.settle_bucket
    monkeypatch.setattr(repeats, "GROUP_BYTES", 64 << 10)
    monkeypatch.setattr(repeats, "BUCKET_BYTES", 4 << 10)
    monkeypatch.setattr(
        repeats, "settle_bucket", lambda *a: ordered_bytes.append(len(a[5])) or settle(*a))
    texts = ["".join(map(chr, letters_of(seed % 50, 3_000))) for seed in range(60)]
    raw = np.frombuffer("".join(texts).encode(), np.uint8)
    owner = repeats.anchored_runs(raw, np.arange(0, len(raw) + 1, 3_000), 100)[3]
    many = np.bincount(owner)
    batch = pa.RecordBatch.from_pydict({
        "doc_id": range(60), "mark": [0] * 60, "text": texts,
        "numbers": [pack(np.arange(n)) for n in many], "spread": [pack(np.ones(n, np.int64)) for n in many]})
    monkeypatch.setattr(repeats, "BLOCK_BYTES", 1)
    sent = pa.Table.from_batches(list(repeats.send_runs(iter([batch]), 1, 100)))
    settled = repeats.settle_part(sent, 100)
    assert max(ordered_bytes) < 6 << 10 < 32 << 10 < sum(ordered_bytes)
    gone = np.zeros(60, np.int64)
    for doc_id, first, last in zip(*(settled.column(c).to_pylist() for c in ("doc_id", "first", "last"))):
        gone[doc_id] += last - first + 1
    assert gone.tolist() == [0] * 50 + [2_901] * 10


def test_open_strings_are_hashed_in_slices():
    """Hashing takes many bytes for each byte of the open strings, which overlap."""
    n, size = 300, 168
    tracemalloc.start()
    try:
        found = list(repeats.settle_bucket(
            np.arange(n), np.zeros(n, np.int64), np.zeros(n, np.int64), np.full(n, size),
            np.full(n, 2), letters_of(2, n * size), 100))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert sum(len(columns[0]) for columns in found) == n * (size - 99)
    assert len(found) > 2 and peak < 30 << 20
