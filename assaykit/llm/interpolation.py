"""Language-model scores by deleted interpolation of n-gram estimates.

Maximum-likelihood estimates of order 1 to n and the uniform one are mixed with weights that
depend on how often the context was seen. The weights come from expectation-maximisation over
held-out counts: a fifth of the training documents is scored with its own counts taken off.

Blocks of documents are kept as word codes with a dictionary. Every block asks the shards, by
hash, for the corpus counts of its distinct n-grams and gets them back in its own order, so what
travels is a hash and a count per distinct n-gram of a block, not a row per word.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from .arrays import SPACED, chunked, from_ragged, lowered_words, mix, string_hashes, text_bytes
from .tables import pack, pack_sorted, shards, stored, unpack, unpack_sorted
from .token_counts import rows_batch

ORDER = 2
BLOCK_BYTES = 8 << 20
SHARD_BYTES = 8 << 20
#: Context counts from 2^(i-1) on share a bucket of weights; the last holds all greater ones.
BUCKETS = 16
#: Steps of an octave to which probabilities are rounded before the weights are learned.
STEPS = 4
ROUNDS = 40
#: One of so many training documents teaches the weights: those whose crc32 has remainder 0.
FOLDS = 5

_BLOCKS = "block long, teaches boolean, ids binary, no_id binary, train binary, starts binary, " \
    "codes binary, words binary"
_ASKED = "shard int, block long, level int, hashes binary, seen binary"
_GIVEN = "block long, level int, hashes binary, counts binary, words long, plain long, teaching long"
_CELLS = "cell long, n long"
_SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, " \
    "base_score double, score double"

END = np.uint64(0x2545F4914F6CDD1D)


def word_blocks(batches):
    """Blocks as word codes: code 0 ends a document, the others index the hashes in `words`."""
    from pyspark import TaskContext

    for number, both in enumerate(chunked(batches, "text", BLOCK_BYTES)):
        for teaches in (False, True):
            batch = both.filter(pc.equal(both.column(2), teaches))
            if not batch.num_rows:
                continue
            block = (TaskContext.get().partitionId() << 32) + 2 * number + teaches
            raw, offsets = text_bytes(batch.column(3))
            codes, strings, first = lowered_words(raw, offsets, SPACED)
            n = batch.num_rows
            stream = np.zeros(len(codes) + n, np.int64)
            at = first + np.arange(n + 1)
            inside = np.ones(len(stream), bool)
            inside[at[1:] - 1] = False
            stream[inside] = codes.astype(np.int64) + 1
            ids = batch.column(0)
            yield rows_batch([(
                block, teaches, ids.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64).tobytes(),
                pack(ids.is_null().to_numpy(zero_copy_only=False)),
                pack(batch.column(1).to_numpy(zero_copy_only=False)),
                pack(at), pack(stream), string_hashes(strings).tobytes())], _BLOCKS)


class Block:
    """The n-grams of a block: `keys[k]` holds the hashes of its distinct ones of k + 1 words,
    sorted, and `place[k]` the one that ends at each token, or -1 near a document's front."""

    def __init__(self, row: dict, order: int):
        self.row = row
        self.starts, codes = unpack(row["starts"]), unpack(row["codes"])
        self.train, self.teaches = unpack(row["train"]) > 0, row["teaches"]
        hashes = np.concatenate([[END], np.frombuffer(row["words"], np.uint64)])[codes]
        sizes = np.diff(self.starts)
        self.owner = np.repeat(np.arange(len(sizes)), sizes)
        depth = np.arange(len(codes)) - np.repeat(self.starts[:-1], sizes)
        self.keys, self.place = [], []
        gram = np.zeros(len(codes), np.uint64)
        for k in range(order):
            # The hash of the k words before, and this one; built from the older to the newer.
            gram = mix(hashes) if k == 0 else mix(np.r_[np.zeros(1, np.uint64), gram[:-1]] ^ hashes)
            whole = depth >= k
            keys, place = np.unique(gram[whole], return_inverse=True)
            full = np.full(len(codes), -1, np.int64)
            full[whole] = place
            self.keys.append(keys)
            self.place.append(full)

    def seen(self, k: int) -> np.ndarray:
        """Occurrences of each n-gram in training documents: plain ones, then those that teach."""
        at = np.flatnonzero(self.train[self.owner] & (self.place[k] >= 0))
        counts = np.zeros((2, len(self.keys[k])), np.int64)
        counts[int(self.teaches)] = np.bincount(self.place[k][at], minlength=len(self.keys[k]))
        return counts


def ask_counts(batches, order: int, parts: int):
    """Each block's distinct n-grams, per shard, with their training counts."""
    for batch in batches:
        for row in batch.to_pylist():
            block, rows = Block(row, order), []
            for k in range(order):
                seen, keys = block.seen(k), block.keys[k]
                shard = np.minimum((keys >> np.uint64(32)).astype(np.float64) * parts / 2.0**32,
                                   parts - 1).astype(np.int64)
                cuts = np.searchsorted(shard, np.arange(parts + 1))
                for s in np.flatnonzero(np.diff(cuts)):
                    a, b = cuts[s], cuts[s + 1]
                    rows.append((int(s), row["block"], k, pack_sorted(keys[a:b]),
                                 pack(seen[:, a:b].ravel())))
            yield rows_batch(rows, _ASKED)


def give_counts(group: pa.Table) -> pa.Table:
    """The corpus counts of the n-grams asked for, in the asking block's order; in a row of its
    own the shard's number of distinct training words and its training tokens of both kinds."""
    out = []
    rows = group.to_pylist()
    for level in sorted({r["level"] for r in rows}):
        held = [r for r in rows if r["level"] == level]
        hashes = [unpack_sorted(r["hashes"]) for r in held]
        keys, code = np.unique(np.concatenate(hashes), return_inverse=True)
        total = np.zeros((2, len(keys)), np.int64)
        done = 0
        for r, own in zip(held, hashes):
            total[:, code[done : done + len(own)]] += unpack(r["seen"]).reshape(2, -1)
            done += len(own)
        if level == 0:
            out.append((-1, -1, None, None, int((total.sum(0) > 0).sum()), *total.sum(1).tolist()))
        done = 0
        for r, own in zip(held, hashes):
            mine = code[done : done + len(own)]
            done += len(own)
            # The shard is a range of hashes: rows go back together by their first hash.
            out.append((r["block"], level, pack_sorted(own[:1]), pack(total[:, mine].ravel()),
                        None, None, None))
    return pa.Table.from_batches([rows_batch(out, _GIVEN)])


def corpus_counts(given: list[dict], order: int, deleted: bool) -> list[np.ndarray]:
    """Per level the counts of the block's distinct n-grams; deleted ones without documents that
    teach."""
    counts = []
    for k in range(order):
        parts = sorted(((int(unpack_sorted(r["hashes"])[0]), r["counts"]) for r in given
                        if r["level"] == k), key=lambda x: x[0])
        held = [unpack(blob).reshape(2, -1)[: 1 if deleted else 2].sum(0) for _, blob in parts]
        counts.append(np.concatenate([np.zeros(0, np.int64), *held]))
    return counts


def estimates(block: Block, counts: list[np.ndarray], total: int):
    """Per token: the bucket of its contexts, and the estimate of each order.

    A context never seen gives the estimate 0, and so does one that would reach over the front.
    """
    n = len(block.owner)

    def count(k: int, place: np.ndarray) -> np.ndarray:
        found = np.zeros(n, np.int64)
        at = np.flatnonzero(place >= 0)
        found[at] = counts[k][place[at]]
        return found

    result, bucket = [], np.zeros(n, np.int64)
    for k in range(len(counts)):
        context = np.full(n, total)
        if k:
            before = np.r_[np.full(1, -1), block.place[k - 1][:-1]]
            context = count(k - 1, np.where(block.place[k] >= 0, before, -1))
            seen = np.minimum(np.frexp(context.astype(np.float64))[1], BUCKETS - 1)
            bucket = bucket * BUCKETS + seen
        result.append(count(k, block.place[k]) / np.maximum(context, 1))
    return bucket, result


def rounded(p: np.ndarray) -> np.ndarray:
    """Probabilities as steps of an octave below 1: 0 for none, at most 255."""
    with np.errstate(divide="ignore"):
        steps = np.rint(-np.log2(p) * STEPS)
    return np.where(p > 0, np.minimum(steps, 254) + 1, 0).astype(np.int64)


def held_out_cells(rows: list[dict], order: int, total: int) -> pa.Table:
    """How many tokens of a block that teaches fall on each (bucket, rounded estimates)."""
    block = Block(rows[0], order)
    cell, found = estimates(block, corpus_counts(rows[1:], order, True), total)
    for p in found:
        cell = cell * 256 + rounded(p)
    values, n = np.unique(cell, return_counts=True)
    return pa.table({"cell": values, "n": n})


def learn_weights(cells: np.ndarray, n: np.ndarray, order: int, vocabulary: int) -> np.ndarray:
    """Weights per bucket of the uniform estimate and those of order 1 to n, by
    expectation-maximisation. A bucket without held-out tokens shares evenly between the
    uniform and the first order."""
    p = np.zeros((len(cells), order + 1))
    rest = cells.copy()
    for k in range(order, 0, -1):
        step = rest % 256
        p[:, k] = np.where(step > 0, 2.0 ** (-(step - 1) / STEPS), 0)
        rest //= 256
    p[:, 0] = 1 / (vocabulary + 1)
    buckets = BUCKETS ** (order - 1)
    weights = np.full((buckets, order + 1), 1 / (order + 1))
    n = n.astype(np.float64)
    for _ in range(ROUNDS):
        share = weights[rest] * p
        share *= (n / share.sum(1))[:, None]
        sums = np.stack([np.bincount(rest, share[:, k], buckets) for k in range(order + 1)], 1)
        # A small even count keeps every order alive.
        sums = sums + 0.01
        weights = sums / sums.sum(1, keepdims=True)
    return weights


def score_block(rows: list[dict], order: int, total: int, vocabulary: int, weights) -> pa.Table:
    block = Block(rows[0], order)
    counts = corpus_counts(rows[1:], order, False)
    bucket, found = estimates(block, counts, total)
    mixture = weights[bucket]
    p = mixture[:, 0] / (vocabulary + 1)
    for k, estimate in enumerate(found):
        p = p + mixture[:, k + 1] * estimate
    once = counts[0][block.place[0]]
    base = np.log10((once + 1.0) / (total + vocabulary + 1.0))
    n = len(block.train)
    ids = pa.array(np.frombuffer(rows[0]["ids"], np.int64), mask=unpack(rows[0]["no_id"]) > 0)

    def add(values: np.ndarray) -> np.ndarray:
        return np.bincount(block.owner, values, n)

    return pa.table({
        "doc_id": ids, "held_out": ~block.train, "n_tokens": np.diff(block.starts),
        "n_known": add(once > 0).astype(np.int64), "train_tokens": np.full(n, total),
        "base_score": add(base), "score": add(np.log10(p))})


def with_counts(blocks: DataFrame, given: DataFrame) -> DataFrame:
    """Each block's row and the counts given back to it, as rows of one frame."""
    names = ["ids", "no_id", "train", "starts", "codes", "words"]
    missing = F.lit(None).cast("binary")
    head = blocks.select("block", F.lit(-1).alias("level"), "teaches", *names,
                         missing.alias("hashes"), missing.alias("counts"))
    tail = given.select("block", "level", F.lit(None).cast("boolean").alias("teaches"),
                        *[missing.alias(n) for n in names], "hashes", "counts")
    return head.unionByName(tail)


def rows_of(group: pa.Table) -> list[dict]:
    """The block's own row, then those of its counts."""
    return sorted(group.to_pylist(), key=lambda r: r["level"])


def score_texts(
    docs: DataFrame, train: F.Column, order: int = ORDER, id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per input row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    `train` is a condition on the input that picks the documents to learn from; null counts
    as true. Tokens are words `[^\\x20\\x09-\\x0D]+` after lower-casing A-Z, then one end. `score`
    is the log10 probability of the tokens under the mixture, `base_score` that of add-one single
    words. A null or empty text is the end alone. Repeated rows count as often as they occur; a
    null id stays null. Without training documents every token has the uniform estimate.
    An empty table gives no rows. N-grams count as equal when their 64-bit hashes do.

    The driver sees the number of tokens by fold and of distinct words, and the learned cells,
    whose number is bound by the rounding of the estimates.
    """
    train = F.coalesce(train, F.lit(True))
    first = F.coalesce(F.crc32(F.col(id_col).cast("string")) % FOLDS == 0, F.lit(False))
    chosen = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), train.cast("int").alias("train"),
        (train & first).alias("teaches"), F.col(text_col).cast("string").alias("text"))
    blocks = stored(chosen.mapInArrow(word_blocks, _BLOCKS))
    parts = 2 * shards(chosen, "text", SHARD_BYTES)
    asked = blocks.mapInArrow(lambda batches: ask_counts(batches, order, parts), _ASKED)
    given = stored(asked.groupBy("shard").applyInArrow(give_counts, _GIVEN))
    sizes = [F.coalesce(F.sum(name), F.lit(0)) for name in ("words", "plain", "teaching")]
    vocabulary, plain, teaching = given.where("block < 0").agg(*sizes).first()

    given = given.where("block >= 0")
    taught = with_counts(blocks.where("teaches"), given.where("block % 2 = 1"))
    cells = (taught.groupBy("block")
             .applyInArrow(lambda group: held_out_cells(rows_of(group), order, plain), _CELLS)
             .groupBy("cell").agg(F.sum("n").alias("n")).toArrow())
    weights = learn_weights(cells["cell"].to_numpy(), cells["n"].to_numpy(), order, vocabulary)
    total = plain + teaching
    return with_counts(blocks, given).groupBy("block").applyInArrow(
        lambda group: score_block(rows_of(group), order, total, vocabulary, weights), _SCORES)
