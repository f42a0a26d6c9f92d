import math
import zlib
from collections import Counter

import numpy as np
import pytest
from cases import HARD, frame, words
from conftest import SMALL
from pyspark.sql import functions as F

from assaykit.llm import interpolation, queries
from assaykit.llm.interpolation import learn_weights, score_texts
from assaykit.llm.tables import crc_fold


def crc(doc, folds):
    return None if doc is None else zlib.crc32(str(doc).encode()) % folds


BUCKETS, STEPS, ROUNDS = 16, 4, 40


def rounded(p):
    """0 for no probability, else 1 and the steps of a quarter octave below 1, 254 at most."""
    return min(round(-math.log2(p) * STEPS), 254) + 1 if p else 0


def mixture(cells, order, vocabulary):
    """Weights per bucket by expectation-maximisation over (bucket, rounded estimates) counts."""
    def probabilities(steps):
        return [1 / (vocabulary + 1), *(2.0 ** (-(s - 1) / STEPS) if s else 0.0 for s in steps)]

    even = [1 / (order + 1)] * (order + 1)
    buckets = {b for b, _ in cells}
    weights = dict.fromkeys(buckets, even)
    for _ in range(ROUNDS):
        sums = {b: [0.01] * (order + 1) for b in buckets}
        for (b, steps), n in cells.items():
            share = [w * p for w, p in zip(weights[b], probabilities(steps))]
            for k, x in enumerate(share):
                sums[b][k] += n * x / sum(share)
        weights = {b: [x / sum(s) for x in s] for b, s in sums.items()}
    return lambda b: weights.get(b, even)


def expected(rows, order=2):
    """(id, held_out, n_tokens, n_known, train_tokens, base, score) by plain counting."""
    docs = [(d, [*words(t), None]) for d, t in rows]
    train = [crc(d, 7) != 2 for d, _ in docs]
    teaches = [t and crc(d, 5) == 0 for t, (d, _) in zip(train, docs)]
    grams = lambda w: [tuple(w[i - k : i + 1]) for k in range(order) for i in range(k, len(w))]
    counts, plain = Counter(), Counter()
    for t, own, (_, w) in zip(train, teaches, docs):
        if t:
            counts.update(grams(w))
            if not own:
                plain.update(grams(w))
    total, rest = (sum(n for g, n in c.items() if len(g) == 1) for c in (counts, plain))
    vocabulary = sum(len(g) == 1 for g in counts)

    def tokens(w, c, whole):
        for i in range(len(w)):
            bucket, found = 0, [c[(w[i],)] / max(whole, 1)]
            for k in range(1, order):
                context = c[tuple(w[i - k : i])] if i >= k else 0
                bucket = bucket * BUCKETS + min(context.bit_length(), BUCKETS - 1)
                found.append(c[tuple(w[i - k : i + 1])] / context if context else 0.0)
            yield bucket, found

    cells = Counter()
    for own, (_, w) in zip(teaches, docs):
        for bucket, found in tokens(w, plain, rest) if own else ():
            cells[bucket, tuple(map(rounded, found))] += 1
    weights = mixture(cells, order, vocabulary)
    out = []
    for t, (d, w) in zip(train, docs):
        base = sum(math.log10((counts[(x,)] + 1) / (total + 1 * (vocabulary + 1))) for x in w)
        score = sum(math.log10(weights(b)[0] / (vocabulary + 1) + sum(x * p for x, p in zip(weights(b)[1:], f)))
                    for b, f in tokens(w, counts, total))
        out.append((d, not t, len(w), sum(counts[(x,)] > 0 for x in w), total, base, score))
    return out


def compare(got, rows, order=2):
    key = lambda r: (str(r[0]), r[2], r[5], r[6])
    got, want = sorted(map(tuple, got), key=key), sorted(expected(rows, order), key=key)
    assert [r[:5] for r in got] == [r[:5] for r in want]
    for a, b in zip(got, want):
        assert a[5:] == pytest.approx(b[5:], rel=1e-9)


@pytest.mark.parametrize("order", [2, 3])
def test_hard_texts(spark, monkeypatch, order):
    monkeypatch.setattr(interpolation, "BLOCK_BYTES", 500)
    docs = frame(spark, HARD)
    compare(score_texts(docs, crc_fold("doc_id", 7) != 2, order).collect(), HARD, order)


def test_nothing_to_learn_from(spark):
    rows = score_texts(frame(spark, HARD[:3]), F.lit(False)).collect()
    assert {(r.held_out, r.n_known, r.train_tokens, r.base_score) for r in rows} == {(True, 0, 0, 0.0)}
    assert all(math.isfinite(r.score) for r in rows)


def test_empty_table(spark):
    assert score_texts(frame(spark, []), F.lit(True)).collect() == []


def test_whole_table(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    got = queries.op7_interpolation(spark, SMALL).collect()
    compare(got, docs)
    held = [r for r in got if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_base_probabilities_sum_to_one(spark):
    """Over every training token once, and one token never seen."""
    corpus = [(d, t) for d, t in HARD if d is not None]
    known = sorted({w for d, t in corpus if crc(d, 7) != 2 for w in words(t)})
    probe = [(10_000 + i, w) for i, w in enumerate(["neverseenbefore", *known])]
    docs = frame(spark, corpus + probe)
    train = (F.col("doc_id") < 10_000) & (crc_fold("doc_id", 7) != 2)
    got = {r.doc_id: r.base_score for r in score_texts(docs, train).collect()}
    end = got[2]  # a null text is the end alone
    total = 10 ** end + sum(10 ** (got[d] - end) for d, _ in probe)
    assert total == pytest.approx(1)


def test_weights_prefer_what_predicts():
    cells = np.array([1 * 256 * 256 + 40 * 256 + 5, 1 * 256 * 256 + 40 * 256 + 0])
    weights = learn_weights(cells, np.array([90, 10]), 2, 1_000)
    assert weights[1][2] > 0.8 and weights.sum(1) == pytest.approx(1)
