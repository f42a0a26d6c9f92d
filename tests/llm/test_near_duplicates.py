import random

from cases import HARD, components, frame, ordered, words
from conftest import SMALL

from assaykit.llm import near_duplicates as near
from assaykit.llm import queries
from assaykit.llm.components import component_of


def alike(both, union):
    return 100 * both >= 75 * union


def found(docs, **options):
    return ordered(near.near_duplicates(docs, **options).select("doc_id", "n_shingles", "component_id").collect())


def test_hard_texts(spark):
    assert found(frame(spark, HARD)) == ordered(components(HARD, alike))


def test_kept_is_the_least(spark):
    for r in near.near_duplicates(frame(spark, HARD)).collect():
        assert r.kept == (r.doc_id == r.component_id)


def mutated(rng, text, n):
    out = words(text)
    for _ in range(n):
        out[rng.randrange(len(out))] = f"w{rng.randrange(10_000)}"
    return " ".join(out)


def groups(seed):
    """Groups around a centre, chains, and documents that share a passage only."""
    rng, rows = random.Random(seed), []
    passage = " ".join(f"p{i}" for i in range(40))
    for g in range(6):
        centre = " ".join(f"c{g}-{rng.randrange(500)}" for _ in range(rng.choice([12, 30, 80, 200])))
        text = centre
        for _ in range(12):
            rows.append(mutated(rng, centre, rng.randrange(0, 6)))
            text = mutated(rng, text, 2)
            rows.append(text)
    rows += [" ".join(f"u{rng.randrange(9_000)}" for _ in range(60)) + " " + passage for _ in range(40)]
    rng.shuffle(rows)
    return list(enumerate(rows))


def test_groups_against_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(near, "LIST_BLOCK", 4)
    for seed in (1, 2):
        rows = groups(seed)
        assert found(frame(spark, rows)) == ordered(components(rows, alike))


def test_small_sketches_lose_nothing_they_may_not(spark):
    assert near.least_common(32, 0.75, 1e-7) == 9 or near.least_common(32, 0.75, 1e-7) == 10
    assert near.least_common(4, 0.75, 1e-7) == 1


def test_rows_that_share_an_id(spark):
    rows = [(4, "a b c d e f g"), (9, "a b c d e f g"), (9, "k l m n o p q"), (7, "k l m n o p q")]
    assert found(frame(spark, rows)) == ordered(components(rows, alike))
    assert {c for _, _, c in components(rows, alike)} == {4}


def test_empty_table(spark):
    assert near.near_duplicates(frame(spark, [])).collect() == []


def test_components_of_paths_and_stars(spark):
    links = [(i, i + 1) for i in range(20)] + [(100, i) for i in range(101, 130)] + [(5, 5), (1, 0), (130, 129)]
    got = dict(tuple(r) for r in component_of(spark.createDataFrame(links, "u long, v long")).collect())
    assert got == {**dict.fromkeys(range(21), 0), **dict.fromkeys(range(100, 131), 100)}


def test_whole_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    got = queries.op10_near_duplicates(spark, SMALL).select("doc_id", "n_shingles", "component_id")
    assert ordered(got.collect()) == ordered(components(rows, alike))
