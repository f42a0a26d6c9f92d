import random
import re
from collections import Counter, defaultdict

import pytest
from cases import HARD, LOW, ordered
from conftest import SMALL
from pyspark.sql import types as T

from assaykit.llm import collocations as module, queries
from assaykit.llm.collocations import collocations, counted_stream

import pyarrow as pa


def expected(rows, least, first=2000):
    """(lang, rank, phrase, a, l, r, n, score) by counting every phrase."""
    counts, totals = defaultdict(Counter), Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(LOW)):
            found = re.findall("[^\x20\x09]+", piece)
            totals[lang] += len(found)
            for k in range(1, 6):
                for i in range(len(found) - k + 1):
                    counts[lang][tuple(found[i : i + k])] += 1
    out = []
    for lang, f in counts.items():
        candidates = {p: a for p, a in f.items() if a >= least and len(p) > 1}
        covered = set()
        for p, a in candidates.items():
            for size in range(2, len(p)):
                for i in range(len(p) - size + 1):
                    if 100 * a >= 100 * candidates[p[i : i + size]]:
                        covered.add(p[i : i + size])
        best = []
        for p, a in candidates.items():
            if p not in covered:
                score, _, left, right = min((1000 * a * totals[lang] // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]])
                                            for k in range(1, len(p)))
                best.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(best)[:first], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, totals[lang], -score))
    return out


def documents(spark, rows):
    fields = [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
              T.StructField("lang", T.StringType())]
    more = ["words", "f", "n", "block", "level", "rank", "phrase", "parts", "kind"]
    fields += [T.StructField(name, T.StringType()) for name in more]
    return spark.createDataFrame([(*r, *["x"] * len(more)) for r in rows], T.StructType(fields))


def corpus():
    """Phrases that always go together, a hot word, control characters, several languages."""
    random.seed(4)
    vocabulary = ["the"] * 8 + ["new", "york", "times", "of", "a", "a\x01b", "é", "日本", "x" * 300, "don't", "the\x0bend"]
    rows = []
    for i in range(300):
        parts = []
        for _ in range(random.randrange(30)):
            parts.append(random.choice(["new york times", "by and large", "of the", "in the long run we are all dead"]
                                       + vocabulary) + random.choice([" ", "\t", ", ", ".\n", " "]))
        rows.append((i, "".join(parts), random.choice(["en", "en", "de", None, "und", ""])))
    return rows + [(d, t, "hard") for d, t in HARD] + [(1, "new york " * 40, "en")] * 5


@pytest.mark.parametrize("least, block", [(4, 1500), (1, 1 << 20)])
def test_against_plain_counting(spark, monkeypatch, least, block):
    monkeypatch.setattr(module, "BLOCK_BYTES", block)
    rows = corpus() if least > 1 else corpus()[:40] + [(d, t, "hard") for d, t in HARD if len(t or "") < 10_000]
    got = collocations(documents(spark, rows), least, 60).collect()
    assert ordered(got) == ordered(expected(rows, least, 60))


@pytest.mark.parametrize("rows", [[], [(1, None, None), (2, "one two", "en"), (None, " . ", "en")]])
def test_nothing_frequent(spark, rows):
    assert collocations(documents(spark, rows)).collect() == []


def test_whole_table(spark):
    docs = [(r.doc_id, r.text, r.lang) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    got = queries.op11_collocations(spark, SMALL)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert ordered(got.collect()) == ordered(expected(docs, 100))


def test_stream_leaves_open_what_lies_before():
    rows = [("en", [b"a", b"b", b"c"], 2), ("en", [b"a", b"c"], 5), ("en", [b"b"], 9), ("en", [b"b", b"a"], 4)]
    table = pa.table({"lang": [r[0] for r in rows], "words": pa.array([r[1] for r in rows], pa.list_(pa.binary())),
                      "f": [r[2] for r in rows]})
    got = [tuple(r.values()) for b in counted_stream(table.to_batches(2)) for r in b.to_pylist()]
    assert sorted(got, key=repr) == sorted([
        ("en", [b"a", b"b", b"c"], 2, [None, None], 0, 2), ("en", [b"a", b"b"], None, [None], 2, 1),
        ("en", [b"a", b"c"], 5, [None], 0, 1), ("en", [b"a"], None, [], 5, 0),
        ("en", [b"b", b"a"], 4, [9], 0, 0), ("en", [b"b"], 9, [], 4, 0)], key=repr)
