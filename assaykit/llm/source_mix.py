"""Mixing sources to target weights by balanced sampling with the cube method.

Each source shall give a share of the corpus. A document of a source with t target words for s
words is taken floor(t / s) times, and once more with the inclusion probability of the rest.
The cube method draws these: in the flight phase the probabilities of a block of documents move
along directions that change neither the words nor the number of documents expected,
until all but two are 0 or 1. What is left of the blocks of a source meets in the next round,
until one block holds the source's last two documents, which the landing phase rounds.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .numbering import numbered
from .tables import small_enough, stored

#: Weights of the sources in order, repeating.
WEIGHTS = (1, 2, 3)
#: A source, and a document, is repeated at most so often.
MOST = 3
#: Documents of a block on average, and blocks whose rests meet in the next round.
BLOCK = 4096
FAN = 1024
#: Sources that may be broadcast.
BROADCAST_SOURCES = 200_000
#: Repeated rows that one task writes.
CHUNK = 10_000

#: Probabilities this close to 0 or 1 are decided.
EPSILON = 1e-9


def word_count(text: Column) -> Column:
    """Number of `[^\\x20\\x09-\\x0D]+` in a text, 0 for null; no list of words is built."""
    marks = F.regexp_replace(text.cast("string"), r"[^\x20\x09-\x0D]+", "a")
    letters = F.length(F.translate(marks, " \t\n\x0b\x0c\r", ""))
    return F.coalesce(letters.cast("long"), F.lit(0).cast("long"))


def source_targets(sizes: DataFrame, weights: tuple = WEIGHTS, most: int = MOST) -> DataFrame:
    """(source, source_size) in; also number (by code point, null last) and target out.

    Targets share the words of all sources by weight; one that would pass `most` times its source's
    words stops there, and the rest is shared again until none is above.
    """
    order = [F.col("source").isNull(), F.col("source")]
    listed = numbered(sizes, order, "number").withColumn(
        "weight", F.element_at(F.array(*map(F.lit, weights)), (F.col("number") % len(weights) + 1).cast("int")))
    listed = stored(listed.withColumn("top", most * F.col("source_size")))
    total = listed.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]
    fair, stopped, before = F.lit(0.0), F.lit(False), -1
    while True:
        facts = listed.agg(
            F.coalesce(F.sum(F.when(stopped, F.col("top"))), F.lit(0)).alias("held"),
            F.coalesce(F.sum(F.when(~stopped, F.col("weight"))), F.lit(0)).alias("share"),
            F.count_if(stopped).alias("n"),
        ).first()
        if facts.n == before or not facts.share:
            break
        before = facts.n
        # What a weight gets only grows, so a source that has stopped stays stopped.
        fair = F.lit(float(total - facts.held)) * F.col("weight") / float(facts.share)
        stopped = fair >= F.col("top")
    target = F.least(fair, F.col("top").cast("double"))
    return listed.select("source", "source_size", "number", target.alias("target"))


def flight(size: np.ndarray, p: np.ndarray, random) -> np.ndarray:
    """Probabilities after the flight phase: all but two, or fewer, are 0 or 1.

    Documents enter in the given order. Three open ones, of sizes a, b and c, move along
    (b - c, c - a, a - b), two of one size along (1, -1): this changes neither the sum of
    sizes nor the number expected. One step takes at least one of them to 0 or 1; up or down is
    drawn so that every probability keeps its expectation.
    """
    p = p.copy()
    open_: list[int] = []
    draws = random.random(2 * len(p) + 2).tolist()
    sizes, chances = size.tolist(), p.tolist()
    for new in range(len(sizes)):
        open_.append(new)
        while True:
            if len(open_) >= 2 and sizes[open_[-1]] == sizes[open_[-2]]:
                moved = open_[-2:]
                direction = (1.0, -1.0)
            elif len(open_) >= 2 and sizes[open_[-1]] == sizes[open_[0]]:
                moved = [open_[0], open_[-1]]
                direction = (1.0, -1.0)
            elif len(open_) == 3:
                moved = open_
                a, b, c = (sizes[i] for i in moved)
                scale = float(max(abs(b - c), abs(c - a), abs(a - b)))
                direction = ((b - c) / scale, (c - a) / scale, (a - b) / scale)
            else:
                break
            up = min((1 - chances[i]) / d if d > 0 else chances[i] / -d
                     for i, d in zip(moved, direction) if d)
            down = min(chances[i] / d if d > 0 else (1 - chances[i]) / -d
                       for i, d in zip(moved, direction) if d)
            step = up if draws.pop() * (up + down) < down else -down
            for i, d in zip(moved, direction):
                x = chances[i] + step * d
                chances[i] = 0.0 if x < EPSILON else 1.0 if x > 1 - EPSILON else x
            open_ = [i for i in open_ if 0 < chances[i] < 1]
    return np.array(chances)


def landing(size: np.ndarray, p: np.ndarray) -> np.ndarray:
    """The open documents, two at most, rounded so that the words taken come nearest to those
    expected; then their number, then fewer words."""
    p = p.copy()
    open_ = np.flatnonzero((p > 0) & (p < 1))
    choices = []
    for number in range(1 << len(open_)):
        s = (number >> np.arange(len(open_))) & 1
        gap = s - p[open_]
        choices.append((abs(float((gap * size[open_]).sum())), abs(float(gap.sum())), number))
    p[open_] = (min(choices)[2] >> np.arange(len(open_))) & 1
    return p


def settle(key: tuple, group: pa.Table, seed: int) -> pa.Table:
    """One block after its flight, and after its landing if its source has no other block."""
    number, block, left = (k.as_py() for k in key)
    group = group.sort_by([("size", "descending"), ("doc_id", "ascending")])
    size = group["size"].to_numpy()
    random = np.random.default_rng([seed, number, block, left])
    p = flight(size, group["p"].to_numpy(), random)
    if left == 1:
        p = landing(size, p)
    at = group.schema.get_field_index("p")
    return group.set_column(at, "p", pa.array(p))


def mix_sources(
    docs: DataFrame, weights: tuple = WEIGHTS, most: int = MOST, seed: int = 1,
    id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", block: int = BLOCK,
) -> DataFrame:
    """One row per input row: doc_id, source, size, source_size, target, copies, taken.

    `size` is the number of words, `target` the words that the source shall give, `copies` how often
    the mix takes the document and `taken` the words of all copies. A null or empty text has
    size 0 and adds nothing; documents of a source without words are not taken. A null
    source is one of its own, the last. A null id stays null. Rows of one source, id and size
    are alike: of n such rows as many take a further copy as the balance gives, and it does not
    matter which. An empty table gives no rows; other columns are not read. A second run takes
    the same copies, as draws depend only on sources, ids and sizes.
    """
    units = stored(docs.select(
        F.col(source_col).cast("string").alias("source"), F.col(id_col).cast("long").alias("doc_id"),
        word_count(F.col(text_col)).alias("size"),
    ).groupBy("source", "doc_id", "size").agg(F.count("*").alias("n")))
    sizes = stored(units.groupBy("source").agg(
        F.sum(F.col("size") * F.col("n")).alias("source_size"), F.count("*").alias("units")))
    targets = source_targets(sizes.select("source", "source_size"), weights, most).join(
        sizes.select(F.col("source").alias("own"), "units"), F.col("source").eqNullSafe(F.col("own"))
    ).drop("own")
    targets = stored(targets)
    if small_enough(targets, BROADCAST_SOURCES):
        targets = F.broadcast(targets)
    same = units["source"].eqNullSafe(targets["source"])
    share = F.coalesce(F.col("target") / F.nullif(F.col("source_size"), F.lit(0)), F.lit(0.0))
    # Of n rows alike, `more` take a copy more for certain, and one with probability p.
    even = F.col("n") * F.col("part")
    blocks = F.ceil(F.col("units") / F.lit(block)).cast("long")
    opened = (
        units.join(targets, same).drop(targets["source"])
        .withColumn("base", F.floor(share).cast("long"))
        .withColumn("part", share - F.col("base"))
        .withColumn("more", F.least(F.floor(even).cast("long"), F.col("n") - 1))
        .withColumn("p", even - F.col("more"))
        .withColumn("left", blocks)
        .withColumn("block", F.pmod(F.xxhash64("doc_id", "size"), F.col("left")))
        .drop("part", "units")
    )
    settled = []
    while True:
        schema = opened.schema
        done = stored(opened.groupBy("number", "block", "left").applyInArrow(
            lambda key, group: settle(key, group, seed), schema))
        still = (F.col("p") > 0) & (F.col("p") < 1)
        settled.append(done.where(~still))
        opened = done.where(still).withColumn("left", F.ceil(F.col("left") / FAN).cast("long"))
        opened = opened.withColumn("block", F.col("block") % F.col("left")).select(*schema.names)
        if opened.isEmpty():
            break
    decided = reduce(DataFrame.unionByName, settled)
    # Rows alike are written again, a bounded number a task.
    chunks = decided.withColumn("first", F.explode(F.sequence(F.lit(0), F.col("n") - 1, F.lit(CHUNK))))
    spread = chunks.where("n > 1").repartition("number", "doc_id", "size", "first")
    spread = spread.withColumn("row", F.explode(F.sequence(
        F.col("first"), F.least(F.col("first") + CHUNK, F.col("n")) - 1)))
    rows = chunks.where("n = 1").withColumn("row", F.lit(0).cast("long")).unionByName(spread)
    copies = F.col("base") + (F.col("row") < F.col("more") + F.col("p")).cast("long")
    return rows.select(
        "doc_id", "source", "size", "source_size", "target", copies.alias("copies"),
        (copies * F.col("size")).alias("taken"))
