from collections import Counter, defaultdict

import numpy as np
import pytest
from cases import HARD, frame, ordered, words
from conftest import SMALL
from pyspark.sql import functions as F, types as T

from assaykit.llm import queries
from assaykit.llm.source_mix import flight, landing, mix_sources, word_count


def targets(sizes, weights=(1, 2, 3), most=3):
    """Target of each source by sharing again and again, with exact fractions."""
    from fractions import Fraction

    order = sorted(sizes, key=lambda s: (s is None, s.encode() if s is not None else b""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    left, open_, out = Fraction(sum(sizes.values())), set(order), {}
    while open_:
        share = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if share * weight[s] >= most * sizes[s]}
        if not full:
            return out | {s: float(share * weight[s]) for s in open_}
        for s in full:
            out[s] = float(most * sizes[s])
            left -= most * sizes[s]
        open_ -= full
    return out


def check(rows, got):
    """Whole result: every row once, its size and target, copies within bounds, sums near targets."""
    size = [(d, len(words(t)), s) for d, t, s in rows]
    by_source = defaultdict(int)
    for _, n, s in size:
        by_source[s] += n
    want = targets(by_source)
    assert Counter((r.doc_id, r.size, r.source) for r in got) == Counter(size)
    taken, copies, count = Counter(), Counter(), Counter()
    for r in got:
        assert r.source_size == by_source[r.source] and r.target == pytest.approx(want[r.source])
        assert r.taken == r.copies * r.size and r.taken <= 3 * r.size
        rate = r.target / r.source_size if r.source_size else 0
        assert int(rate) <= r.copies <= int(rate) + 1
        taken[r.source] += r.taken
        copies[r.source] += r.copies
        count[r.source] += rate
    for s, total in by_source.items():
        # Two documents are rounded, to the nearest sum: half of the second largest, at most.
        largest = sorted(n for _, n, x in size if x == s)[-1]
        assert abs(taken[s] - want[s]) <= largest / 2 + 1e-6
        assert abs(copies[s] - count[s]) <= 2


def sourced(spark, rows):
    fields = [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
              T.StructField("source", T.StringType())]
    more = ["size", "target", "n", "p", "number", "block", "left", "own", "copies", "row", "label"]
    fields += [T.StructField(name, T.StringType()) for name in more]
    return spark.createDataFrame([(*r, *["x"] * len(more)) for r in rows], T.StructType(fields))


def many():
    """A hot source, a hot repeated row, one size, few words, no words, no source."""
    rows = [(i, "w " * (1 + i * i % 97), "hot") for i in range(900)]
    rows += [(7, "a b c", "copies")] * 700 + [(None, "a b", None)] * 5 + [(None, None, None), (3, "", "é")]
    rows += [(i, "one size fits all", "ü") for i in range(60)] + [(1, "lone " * 500, "zz"), (1, None, "")]
    return rows + [(d, t, f"s{i % 3}") for i, (d, t) in enumerate(HARD)]


@pytest.mark.parametrize("block", [3, 4096])
def test_every_kind_of_source(spark, monkeypatch, block):
    monkeypatch.setattr("assaykit.llm.source_mix.FAN", 4)
    monkeypatch.setattr("assaykit.llm.source_mix.CHUNK", 64)
    rows = many()
    check(rows, mix_sources(sourced(spark, rows), block=block).collect())


def test_two_runs_agree_however_rows_lie(spark):
    rows = many()
    one = mix_sources(sourced(spark, rows), block=16).collect()
    two = mix_sources(sourced(spark, rows[::-1]).repartition(13), block=16).collect()
    assert ordered(one) == ordered(two)


def test_joined_by_shuffle(spark, monkeypatch):
    monkeypatch.setattr("assaykit.llm.source_mix.BROADCAST_SOURCES", 0)
    check(many(), mix_sources(sourced(spark, many())).collect())


@pytest.mark.parametrize("rows", [[], [(1, None, "a"), (2, " ", None)], [(1, "x", "a")]])
def test_few_rows(spark, rows):
    got = mix_sources(sourced(spark, rows)).collect()
    check(rows, got)
    assert len(got) == len(rows)


def test_word_count(spark):
    got = frame(spark, HARD).select("text", word_count(F.col("text")).alias("n")).collect()
    assert [r.n for r in got] == [len(words(r.text)) for r in got]


def test_flight_keeps_sums_and_expectations():
    random = np.random.default_rng(5)
    size = random.integers(0, 50, 400).astype(np.float64)
    p = random.random(400)
    size[::7] = 11
    total = np.zeros(400)
    for seed in range(200):
        q = flight(size, p, np.random.default_rng(seed))
        assert ((q > 0) & (q < 1)).sum() <= 2
        assert q.sum() == pytest.approx(p.sum()) and (q * size).sum() == pytest.approx((p * size).sum())
        total += q
    assert np.abs(total / 200 - p).max() < 0.2 and np.abs(total / 200 - p).mean() < 0.05


def test_landing_takes_the_nearest_sum():
    size, p = np.array([10.0, 4.0, 9.0]), np.array([0.4, 0.5, 1.0])
    best = min(abs(a * 10 + b * 4 - 6) for a in (0, 1) for b in (0, 1))
    q = landing(size, p)
    assert q[2] == 1 and abs(q[0] * 10 + q[1] * 4 - 6) == best and set(q) <= {0, 1}


def test_whole_table(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    source = {r.doc_id: (r.text, r.source) for r in docs.collect()}
    got = queries.op13_cube_mix(spark, SMALL).collect()
    assert len(got) == len(source)
    rows = [(d, t, s) for d, (t, s) in source.items()]
    check(rows, mix_sources(docs).collect())
