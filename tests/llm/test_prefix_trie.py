import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from cases import ordered
from conftest import SMALL
from pyspark.sql import types as T

from assaykit.llm import prefix_trie as module, queries
from assaykit.llm.prefix_trie import Parentheses, prefix_trie


def rebuild(rows):
    """{conv_id: [(role, text), ...]} by the rules, plainly."""
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append(((turn is not None, turn or 0), role or "", text or ""))
    # Turns of one number are in the order of a hash.
    key = lambda t: (t[0], hashlib.md5(f"{len(t[1].encode())}:{t[1]}{t[2]}".encode()).hexdigest())
    own = {c: [t[1:] for t in sorted(turns, key=key)] for c, turns in own.items()}
    h = {c: zlib.crc32(str(c).encode()) % 9 for c in own}
    return {c: own.get(c - c % 5, [])[: h[c]] + own[c][h[c]:] for c in own}


def expected(rows):
    convs = rebuild(rows)
    members = defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children = defaultdict(int)
    leaves, saved = defaultdict(int), defaultdict(int)
    for node in members:
        if node:
            children[node[:-1]] += 1
    for node, own in members.items():
        value = (len(own) - 1) * len(node[-1][1].encode()) if node else 0
        for d in range(len(node) + 1):
            leaves[node[:d]] += not children[node]
            saved[node[:d]] += value
    out = []
    for node, own in members.items():
        ends = ",".join(str(c) for c in sorted(own) if len(convs[c]) == len(node))
        out.append((min(own), len(node), min(members[node[:-1]]) if node else None, len(own), children[node],
                    leaves[node], saved[node], hashlib.sha256(ends.encode()).hexdigest()))
    return out


def conversations(spark, rows):
    fields = [T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()),
              T.StructField("role", T.StringType()), T.StructField("text", T.StringType())]
    more = ["key", "size", "id", "seg", "path", "depth", "number", "r1", "copies", "least", "n"]
    fields += [T.StructField(name, T.StringType()) for name in more]
    return spark.createDataFrame([(*r, *["x"] * len(more)) for r in rows], T.StructType(fields))


def talk(seed, convs=120):
    """Few different turns, so that fronts are shared; copies, a long one, nulls, ties, gaps."""
    random.seed(seed)
    rows = []
    for c in range(convs):
        if c % 11 == 3:
            continue
        same = random.Random(c % 7)
        for turn in range(random.choice([1, 2, 3, 5, 9, 14])):
            rows.append((c, turn * 2, "user" if turn % 2 else None, same.choice(["hi", "no", "é ü", None, "yes"])))
    rows += [(500, t, "user", f"turn {t}") for t in range(60)] + [(505, t, "user", f"turn {t}") for t in range(60)]
    rows += [(501, t, "user", f"turn {t}") for t in range(41)]
    rows += [(600, None, "a", "first"), (600, None, None, "first"), (600, 1, "a", "b"), (600, 1, "a", "b")]
    rows += [(None, 0, "user", "lost"), (700, 0, None, None), (702, 5, "", "")]
    rows += [(800 + i, t, "user", "copy") for i in range(90) for t in range(12)]
    return rows


@pytest.mark.parametrize("segment, broadcast", [(512, 200_000), (4, 0)])
def test_against_plain_counting(spark, monkeypatch, segment, broadcast):
    monkeypatch.setattr(module, "BROADCAST_NODES", broadcast)
    rows = talk(segment)
    assert ordered(prefix_trie(conversations(spark, rows), segment).collect()) == ordered(expected(rows))


def test_many_small_shards(spark, monkeypatch):
    """Spines that pass through many shards, and shards of one segment."""
    monkeypatch.setattr(module, "SHARD_TURNS", 20)
    rows = talk(3, 60)
    assert ordered(prefix_trie(conversations(spark, rows), 4).collect()) == ordered(expected(rows))


@pytest.mark.parametrize("rows", [[(None, 1, "a", "b")], [(4, None, None, None), (7, 0, "a", "b")]])
def test_few_rows(spark, rows):
    assert ordered(prefix_trie(conversations(spark, rows)).collect()) == ordered(expected(rows))


def test_whole_table(spark):
    table = spark.read.parquet(f"{SMALL}/conversations.parquet")
    rows = [tuple(r) for r in table.select("conv_id", "turn", "role", "text").collect()]
    got = queries.op12_prefix_trie(spark, SMALL)
    assert {n: t for n, t in got.dtypes if n != "ends_sha256"} == {n: "bigint" for n in got.columns if n != "ends_sha256"}
    assert ordered(got.collect()) == ordered(expected(rows))


def test_findclose():
    random.seed(2)
    steps, closes, stack = [], {}, []
    while len(steps) < 4000 or stack:
        if stack and (len(steps) > 4000 or random.random() < 0.48):
            closes[stack.pop()] = len(steps)
            steps.append(-1)
        else:
            stack.append(len(steps))
            steps.append(1)
    for block in (1, 7, 64, 10_000):
        tree = Parentheses(np.array(steps), block)
        assert {i: tree.findclose(i) for i in closes} == closes
