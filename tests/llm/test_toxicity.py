import random

import numpy as np
from cases import HARD, frame
from test_rule_ensemble import DATA, label_frame

from assaykit.llm import queries
from assaykit.llm.arrays import text_bytes
from assaykit.llm.toxicity import NAMES, features, score_toxicity


def test_held_out_labels(spark):
    labels = spark.read.parquet(f"{DATA}/labels.parquet")
    got = queries.op3_toxicity(spark, DATA).join(labels, "doc_id").where("held_out").collect()
    assert np.mean([r.predicted == r.toxic for r in got]) > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)


def test_learns_words_and_beginnings(spark):
    """Toxic words that no list holds, some of them with endings that were never labelled."""
    rng = random.Random(1)
    plain = [f"w{a}{b}" for a in "abcdefgh" for b in "ijklmnop"]
    rows, labels = [], []
    for i in range(400):
        text = [rng.choice(plain) for _ in range(40)]
        toxic = i % 4 == 0
        if toxic:
            for _ in range(4):
                text[rng.randrange(40)] = "zorg" + rng.choice("abcdefghij") + rng.choice("xyz")
        rows.append((i, " ".join(text)))
        labels.append((i, 1, int(toxic)))
    got = score_toxicity(frame(spark, rows), label_frame(spark, labels)).collect()
    held = [r for r in got if r.held_out]
    assert len(held) > 50 and all(r.predicted == (r.doc_id % 4 == 0) for r in held)


def test_hard_texts(spark):
    labels = label_frame(spark, [(1, 1, 0), (3, 0, 1), (8, 0, 1), (7, 0, 0), (12, 1, 0), (5, 1, None), (None, 1, 1)])
    got = score_toxicity(frame(spark, HARD), labels).collect()
    assert len(got) == len(HARD) and all(0 <= r.score <= 1 for r in got)


def test_no_labels_and_no_documents(spark):
    assert {r.score for r in score_toxicity(frame(spark, HARD), label_frame(spark, [])).collect()} == {0.5}
    assert score_toxicity(frame(spark, []), label_frame(spark, [(1, 1, 1)])).collect() == []


def test_features_by_hand():
    import pyarrow as pa

    raw, offsets = text_bytes(pa.array(["You are an idiot! ID10T 1d1ot", "", None]))
    row, empty, null = (dict(zip(NAMES, r)) for r in features(raw, offsets, {}).tolist())
    assert row["fixed_hits"] == 1 and row["near_person"] == 1 and row["hidden_hits"] == 2
    assert row["shouts"] > 0 and empty == null and set(empty.values()) == {0.0}
