import numpy as np
from cases import HARD, STORY, contaminated, frame, ordered
from conftest import SMALL

from assaykit.llm import fm_index, phrases, queries
from assaykit.llm.fm_index import FmIndex, contamination_digest, find_contamination, without_items

ITEMS = [
    (1, STORY), (1, STORY), (2, "three"), (3, None), (None, STORY), (4, "?!"), (10, "one two three"),
    (5, "nothing of this is in any of the documents here at all so it is never found anywhere"),
]


def items_frame(spark, rows):
    return spark.createDataFrame([(*r, None) for r in rows], "item_id long, text string, row string")


def digest(spark, rows, items):
    return ordered(contamination_digest(find_contamination(frame(spark, rows), items_frame(spark, items))).collect())


def test_index_finds_all_places():
    rng = np.random.default_rng(5)
    text = rng.integers(1, 4, 400)
    index = FmIndex(text, 4, rate=5)
    for size in (1, 3, 6):
        phrases = np.array([text[i : i + size] for i in range(0, 390, 7)] + [[3] * size])
        low, high = index.search(phrases, np.full(len(phrases), size))
        for phrase, a, b in zip(phrases, low, high):
            places = [i for i in range(len(text) - size + 1) if (text[i : i + size] == phrase).all()]
            assert sorted(index.locate(np.arange(a, b)).tolist()) == places


def test_hard_texts(spark):
    assert digest(spark, HARD, ITEMS) == ordered(contaminated(HARD, ITEMS))


def test_small_shards(spark, monkeypatch):
    monkeypatch.setattr(fm_index, "BLOCK_BYTES", 100)
    rows = [(i, f"w{i % 3} {STORY} tail {i} " * (i % 4)) for i in range(30)]
    assert digest(spark, rows, ITEMS) == ordered(contaminated(rows, ITEMS))


def test_no_items_and_no_documents(spark):
    assert digest(spark, HARD, []) == ordered(contaminated(HARD, []))
    assert digest(spark, [], ITEMS) == []


def test_cut(spark):
    rows = [(1, f"before, {STORY}; after"), (2, STORY), (3, "clean text"), (4, None)]
    found = find_contamination(frame(spark, rows), items_frame(spark, [(1, STORY)]))
    left = without_items(found, ["doc_id", "text", "row"])
    assert left.columns == ["doc_id", "text", "row"]
    assert ordered(left.select("doc_id", "text").collect()) == ordered(
        [(1, "before, ; after"), (3, "clean text"), (4, None)])


def test_whole_table(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    items = spark.read.parquet(f"{SMALL}/benchmark.parquet").select("item_id", "text").collect()
    found = queries.op6_decontamination(spark, SMALL).collect()
    assert ordered(found) == ordered(contaminated([tuple(r) for r in docs], [tuple(r) for r in items]))
    assert any(r.contaminated for r in found)
    assert found[0].__fields__ == ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]


def test_items_in_blocks_of_any_size(spark, monkeypatch):
    long_item = " ".join(f"w{i % 97} w{i % 89}" for i in range(400))
    rows = [*HARD, (20, f"{STORY} {long_item}"), (21, long_item[200:900]), (21, long_item[200:900]),
            (22, f"nothing {STORY} then one two three"), (23, "owls watch from an old oak tree one two")]
    items = [*ITEMS, (6, long_item), (7, STORY + " " + long_item), (8, "old oak tree one")]
    expected = ordered(contaminated(rows, items))
    monkeypatch.setattr(phrases, "PIECE_PHRASES", 20)
    monkeypatch.setattr(phrases, "TASK_BYTES", 1000)
    docs, tests = frame(spark, rows), items_frame(spark, items)
    spans = []
    for words in (1 << 18, 100, 15):
        found = find_contamination(docs, tests, block_words=words)
        assert ordered(contamination_digest(found).collect()) == expected
        spans.append(ordered(found.select("doc_id", "spans", "runs", "item_ids").collect()))
    assert spans[0] == spans[1] == spans[2]


def test_ids_with_commas_and_without_text(spark):
    items = spark.createDataFrame([("a,b", "one two three"), ("", "lazy dog"), (None, "fox")],
                                  "item_id string, text string")
    rows = [(1, "one two three"), (2, "a lazy dog"), (3, "one two three, lazy dog"), (4, "fox")]
    found = contamination_digest(find_contamination(frame(spark, rows), items)).collect()
    assert {r.doc_id: (r.n_items, r.n_hit) for r in found} == {1: (1, 3), 2: (1, 2), 3: (2, 5), 4: (0, 0)}


def test_blocks_hold_a_bounded_number_of_words(spark, monkeypatch):
    monkeypatch.setattr(phrases, "PIECE_PHRASES", 50)
    items = spark.createDataFrame(
        [(str(i), " ".join(f"t{i}x{j}" for j in range(i * 40))) for i in range(12)], "id string, text string")
    blocks = phrases.phrase_blocks(items, 13, 100)
    numbers = [r.block for r in blocks.select("block").collect()]
    sets = [phrases.phrase_set(blocks, number, 13) for number in numbers]
    assert len(numbers) > 10 and max(len(s["vocabulary"]) for s in sets) <= 100 + 50 + 12
    windows = sum(max(0, i * 40 - 12) for i in range(1, 12))
    assert sum(len(s["phrases"]) for s in sets) == windows
