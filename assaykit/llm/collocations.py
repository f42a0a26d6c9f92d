"""Phrases whose words occur together more often than apart, from sorted streams of counts.

Counting: blocks of documents are kept as word codes. Every block sends its distinct word pairs, by
hash, to the shards, which answer which pairs are frequent. Longer phrases are counted only where
all their pairs are frequent, as no phrase is more frequent than its parts. One block that holds
a frequent phrase spells it out.

Scoring: the counts are laid out as two sorted streams, by the words from the first on (prefix
order) and from the last on (suffix order). A stream is read once with a stack: the fronts of a
phrase lie open below it in prefix order, so its left counts are at hand, and a phrase passes its
count down as an extension of the one below; suffix order does the same for right counts and
words added on the left. Both streams are then joined by merging, phrase by phrase.
"""

from __future__ import annotations

import json

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from .arrays import LOWER, byte_table, chunked, distinct_spans, from_ragged, mix, string_hashes, text_bytes, word_spans
from .tables import pack, pack_sorted, shards, small_enough, stored, unpack, unpack_sorted
from .token_counts import rows_batch

def names_of(ddl: str) -> list[str]:
    return [field.strip().split(" ")[0] for field in ddl.split(",")]


#: Words `[^\x20\x09]+` of pieces, which end at `[.,;:!?\x0A-\x0D]`.
CUT = ~byte_table(r".,;:!?\x0A-\x0D")
WORD = byte_table(r".,;:!?\x0A-\x0D\x20\x09")

LONGEST = 5
LEAST = 100
FIRST = 2000
#: A phrase goes if a longer one has so many hundredths of its count.
COVER = 100
BLOCK_BYTES = 8 << 20
SHARD_BYTES = 8 << 20
#: Languages that may be broadcast.
BROADCAST_LANGS = 100_000

_BLOCKS = "block long, langs string, lang_of binary, starts binary, opens binary, codes binary, " \
    "words binary, lengths binary"
_ASKED = "shard int, block long, level int, spoken boolean, hashes binary, counts binary"
_GIVEN = "block long, level int, head binary, frequent binary, hashes binary, counts binary"
_LONGER = ", ".join([_ASKED, *_BLOCKS.split(", ")[1:]])
_TOTALS = "lang string, n long"
_SPELLED = "lang string, words array<binary>, f long"
_STREAM = "lang string, words array<binary>, f long, parts array<bigint>, added long, missing int"


BLOCK_FIELDS, GIVEN_FIELDS = names_of(_BLOCKS), names_of(_GIVEN)


def word_blocks(batches):
    """Blocks of documents: word codes by falling frequency, where pieces begin, languages."""
    from pyspark import TaskContext

    for number, batch in enumerate(chunked(batches, "text", BLOCK_BYTES)):
        raw, offsets = text_bytes(batch.column(1))
        low = LOWER[raw]
        starts, ends, first = word_spans(low, offsets, WORD)
        if not len(starts):
            continue
        codes, words = distinct_spans(low, starts, ends)
        times = np.bincount(codes, minlength=len(words))
        order = np.argsort(-times, kind="stable")
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        cuts = np.cumsum(CUT[low], dtype=np.int32)[starts]
        opens = np.r_[True, cuts[1:] != cuts[:-1]]
        opens[first[:-1][first[:-1] < len(opens)]] = True
        langs = batch.column(0).dictionary_encode()
        words = words.take(pa.array(order))
        lengths = np.diff(np.frombuffer(words.buffers()[1], np.int64)[words.offset : words.offset + len(words) + 1])
        yield rows_batch([(
            (TaskContext.get().partitionId() << 32) + number, json.dumps(langs.dictionary.to_pylist()),
            pack(langs.indices.to_numpy(zero_copy_only=False)), pack(first), np.packbits(opens).tobytes(),
            planes(rank[codes]), b"".join(words.to_pylist()), pack(lengths))], _BLOCKS)


def planes(values: np.ndarray) -> bytes:
    """Numbers below 2^32 as four byte planes; those of small numbers compress to nothing."""
    return np.ascontiguousarray(values.astype(">u4").view(np.uint8).reshape(-1, 4).T).tobytes()


def from_planes(blob: bytes) -> np.ndarray:
    found = np.ascontiguousarray(np.frombuffer(blob, np.uint8).reshape(4, -1).T)
    return found.view(">u4").ravel().astype(np.int64)


class Block:
    """A block's words in text order, with hashes of the phrases that begin at each."""

    def __init__(self, row: dict):
        self.number, self.codes = row["block"], from_planes(row["codes"])
        n = len(self.codes)
        self.opens = np.unpackbits(np.frombuffer(row["opens"], np.uint8), count=n).astype(bool)
        starts = unpack(row["starts"])
        self.lang = np.repeat(unpack(row["lang_of"]), np.diff(starts))
        self.langs = json.loads(row["langs"])
        at = np.concatenate([[0], np.cumsum(unpack(row["lengths"]))]).astype(np.int64)
        self.words = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(at) - 1, [None, pa.py_buffer(at), pa.py_buffer(row["words"])])
        self.word_hash = string_hashes(self.words)[self.codes]
        langs = pa.array([lang.encode() for lang in self.langs], pa.large_binary())
        self.lang_hash = mix(string_hashes(langs, 7))[self.lang]
        #: How many words of the piece lie from each word on.
        piece = np.append(np.flatnonzero(self.opens), n)
        self.ahead = np.repeat(piece[1:], np.diff(piece)) - np.arange(n)

    def phrases(self, size: int):
        """Hashes of the phrases of 1, 2, ... `size` words, each beginning where words are left."""
        n, gram = len(self.codes), self.lang_hash
        for k in range(size):
            begins = max(n - k, 0)
            gram = mix(gram[:begins]) ^ self.word_hash[k:]
            yield k + 1, gram


def pair_hashes(block: Block) -> tuple[np.ndarray, np.ndarray]:
    """Where word pairs of one piece begin, and their hashes."""
    (_, _), (_, gram) = block.phrases(2)
    at = np.flatnonzero(block.ahead[: len(gram)] >= 2)
    return at, gram[at]


def per_shard(keys: np.ndarray, counts: np.ndarray, parts: int):
    """Sorted hashes and their counts, cut where the shards' ranges of hashes end."""
    shard = np.minimum((keys >> np.uint64(32)).astype(np.float64) * parts / 2.0**32, parts - 1).astype(np.int64)
    cuts = np.searchsorted(shard, np.arange(parts + 1))
    for s in np.flatnonzero(np.diff(cuts)):
        yield int(s), pack_sorted(keys[cuts[s] : cuts[s + 1]]), pack(counts[cuts[s] : cuts[s + 1]])


def ask_pairs(batches, parts: int):
    """Every block's distinct word pairs with their counts, per shard."""
    for batch in batches:
        for row in batch.to_pylist():
            block = Block(row)
            keys, counts = np.unique(pair_hashes(block)[1], return_counts=True)
            yield rows_batch([(s, block.number, 2, True, h, c) for s, h, c in
                              per_shard(keys, counts, parts)], _ASKED)


def answer(group: pa.Table, least: int, reply: bool) -> pa.Table:
    """Which of the phrases asked for are frequent, to each block in its order; and the frequent
    ones with their counts, to one block that can spell them."""
    rows = sorted(group.to_pylist(), key=lambda r: (not r["spoken"], r["block"]))
    out = []
    for level in sorted({r["level"] for r in rows}):
        held = [r for r in rows if r["level"] == level]
        hashes = [unpack_sorted(r["hashes"]) for r in held]
        keys, first, code = np.unique(np.concatenate(hashes), return_index=True, return_inverse=True)
        total = np.bincount(code, np.concatenate([unpack(r["counts"]) for r in held])).astype(np.int64)
        frequent = total >= least
        done = 0
        for r, own in zip(held, hashes):
            mine = code[done : done + len(own)]
            # Rows that can spell come first, so they hold the first place of all they know.
            chosen = mine[frequent[mine] & (first[mine] == done + np.arange(len(own)))] if r["spoken"] else mine[:0]
            done += len(own)
            bits = np.packbits(frequent[mine]).tobytes() if reply else None
            if reply or len(chosen):
                out.append((r["block"], level, pack_sorted(own[:1]), bits,
                            keys[chosen].tobytes(), pack(total[chosen])))
    return pa.Table.from_batches([rows_batch(out, _GIVEN)])


def with_answers(blocks: DataFrame, given: DataFrame) -> DataFrame:
    """Each block's row and the answers to it, as rows of one frame."""
    only_blocks = [F.lit(None).cast(f.split(" ")[1]).alias(f.split(" ")[0]) for f in _GIVEN.split(", ")[1:]]
    only_given = [F.lit(None).cast(f.split(" ")[1]).alias(f.split(" ")[0]) for f in _BLOCKS.split(", ")[1:]]
    return blocks.select(*BLOCK_FIELDS, *only_blocks).unionByName(given.select(*GIVEN_FIELDS, *only_given))


def frequent_pairs(block: Block, answers: list[dict]) -> np.ndarray:
    """At which words a frequent pair begins. Answers are ranges of the block's sorted pairs."""
    at, gram = pair_hashes(block)
    keys, place = np.unique(gram, return_inverse=True)
    heads = np.array([unpack_sorted(r["head"])[0] for r in answers], np.uint64)
    order = np.argsort(heads)
    cuts = np.append(np.searchsorted(keys, heads[order]), len(keys))
    frequent = np.zeros(len(keys), bool)
    for i, a, b in zip(order, cuts[:-1], cuts[1:]):
        frequent[a:b] = np.unpackbits(np.frombuffer(answers[i]["frequent"], np.uint8), count=b - a)
    begins = np.zeros(len(block.codes), bool)
    begins[at] = frequent[place]
    return begins


def longer_phrases(group: pa.Table, parts: int) -> pa.Table:
    """A block's words, and its phrases of three words on whose pairs are all frequent; and, in
    a row of shard -1, the part of the block in which frequent phrases lie."""
    rows = group.to_pylist()
    head = next(r for r in rows if r["codes"] is not None)
    block = Block(head)
    begins = frequent_pairs(block, [r for r in rows if r["codes"] is None])
    n = len(block.codes)
    # Consecutive frequent pairs from each word on.
    stop = np.append(np.flatnonzero(~begins), n)
    run = stop[np.searchsorted(stop, np.arange(n))] - np.arange(n)
    inside = begins.copy()
    inside[1:] |= begins[:-1]
    out, no_block = [], [None] * len(BLOCK_FIELDS[1:])
    for level, gram in block.phrases(LONGEST):
        chosen = {}
        if level == 1:
            chosen = {True: inside, False: ~inside}
        elif level > 2:
            chosen = {True: run[: len(gram)] >= level - 1}
        for spoken, at in chosen.items():
            keys, counts = np.unique(gram[at], return_counts=True)
            out.extend((s, block.number, level, spoken, h, c, *no_block)
                       for s, h, c in per_shard(keys, counts, parts))
    if inside.any():
        out.append((-1, block.number, None, None, None, None, *short_block(head, block, inside, begins)))
    return pa.Table.from_batches([rows_batch(out, _LONGER)])


def short_block(head: dict, block: Block, inside: np.ndarray, begins: np.ndarray) -> tuple:
    """The block's row, but for its number, with the words of frequent phrases alone; a piece ends where one was left
    out, or where the pair is not frequent."""
    at = np.flatnonzero(inside)
    codes, words = np.unique(block.codes[at], return_inverse=True)
    opens = block.opens[at].copy()
    opens[1:] |= ~begins[at[1:] - 1]
    opens[0] = True
    taken = block.words.take(pa.array(codes)).to_pylist()
    starts = unpack(head["starts"])
    upto = np.concatenate([[0], np.cumsum(inside)])[starts]
    return (head["langs"], head["lang_of"], pack(upto), np.packbits(opens).tobytes(),
            planes(words), b"".join(taken), pack(np.array([len(w) for w in taken], np.int64)))


def spelled(group: pa.Table) -> pa.Table:
    """The words of the frequent phrases that this block was chosen to spell."""
    rows = group.to_pylist()
    asked = [r for r in rows if r["codes"] is None and r["hashes"]]
    langs, phrases, counts = [], [], []
    if asked:
        block = Block(next(r for r in rows if r["codes"] is not None))
        for level, gram in block.phrases(LONGEST):
            own = [r for r in asked if r["level"] == level]
            if not own:
                continue
            wanted = np.concatenate([np.frombuffer(r["hashes"], np.uint64) for r in own])
            found = np.concatenate([unpack(r["counts"]) for r in own])
            order = np.argsort(wanted)
            wanted, found = wanted[order], found[order]
            at = np.flatnonzero(block.ahead[: len(gram)] >= level)
            place = np.searchsorted(wanted, gram[at])
            place[place == len(wanted)] = 0
            at, place = at[wanted[place] == gram[at]], place[wanted[place] == gram[at]]
            _, once = np.unique(place, return_index=True)
            at, place = at[once], place[once]
            codes = block.codes[from_ragged(np.full(len(at), level), at)]
            words = block.words.take(pa.array(codes)).to_pylist()
            phrases.extend(words[i * level : (i + 1) * level] for i in range(len(at)))
            langs.extend(block.langs[i] for i in block.lang[at].tolist())
            counts.extend(found[place].tolist())
    return pa.table({"lang": pa.array(langs, pa.string()), "words": pa.array(phrases, pa.list_(pa.binary())),
                     "f": pa.array(counts, pa.int64())})


def language_totals(batches):
    """Words per language of each block."""
    for batch in batches:
        for row in batch.to_pylist():
            langs = json.loads(row["langs"])
            words = np.bincount(unpack(row["lang_of"]), np.diff(unpack(row["starts"])), len(langs))
            yield rows_batch([(lang, int(n)) for lang, n in zip(langs, words)], _TOTALS)


def phrase_counts(docs: DataFrame, least: int = LEAST) -> tuple[DataFrame, DataFrame]:
    """(lang, words, f): every phrase of 2 to 5 words that occurs `least` times, and its words;
    and (lang, n): all words of a language.

    `docs` holds lang (not null) and text. A word that is in no frequent pair is left out.
    """
    blocks = stored(docs.mapInArrow(word_blocks, _BLOCKS))
    parts = 2 * shards(docs, "text", SHARD_BYTES)
    pairs = stored(blocks.mapInArrow(lambda batches: ask_pairs(batches, parts), _ASKED).groupBy("shard")
                   .applyInArrow(lambda group: answer(group, least, True), _GIVEN))
    none = F.lit(None).cast("binary")
    replies = pairs.withColumns({"hashes": none, "counts": none})
    longer = stored(
        with_answers(blocks, replies).groupBy("block")
        .applyInArrow(lambda group: longer_phrases(group, parts), _LONGER)
        .withColumn("kind", F.when(F.col("shard") < 0, "block").otherwise("asked")), "kind")
    others = (longer.where("kind = 'asked'").select(*names_of(_ASKED)).groupBy("shard")
              .applyInArrow(lambda group: answer(group, least, False), _GIVEN))
    chosen = pairs.where(F.octet_length("hashes") > 0).withColumn("frequent", none).unionByName(others)
    short = longer.where("kind = 'block'").select(*BLOCK_FIELDS)
    counts = stored(with_answers(short, chosen).groupBy("block").applyInArrow(spelled, _SPELLED))
    totals = blocks.select("langs", "lang_of", "starts").mapInArrow(language_totals, _TOTALS)
    return counts, stored(totals.groupBy("lang").agg(F.sum("n").alias("n")))


def counted_stream(batches):
    """One sorted range of phrases, read with a stack of those that begin the present one.

    parts[i] is the count of the first i + 1 words, added the greatest count of a phrase with one
    word more. What a range cannot know, as it lies in one before, is left null; each such front
    comes back as a row without count, with the extensions seen here. `missing` tells how many
    of the parts are null.
    """
    stack: list[list] = []
    lang = None

    def shut(keep: int, out: list) -> None:
        while len(stack) > keep:
            words, f, added = stack.pop()
            known = [entry[1] for entry in stack]
            out.append((lang, words, f, known, added, known.count(None)))

    for batch in batches:
        out: list = []
        for own, words, f in zip(*(c.to_pylist() for c in batch.columns)):
            common = 0
            if own == lang and stack:
                top = stack[-1][0]
                while common < min(len(top), len(words)) and top[common] == words[common]:
                    common += 1
            shut(common, out)
            lang = own
            while len(stack) < len(words) - 1:
                stack.append([words[: len(stack) + 1], None, 0])
            if stack:
                stack[-1][2] = max(stack[-1][2], f)
            stack.append([words, f, 0])
        if out:
            yield stream_batch(out)
    out = []
    shut(0, out)
    if out:
        yield stream_batch(out)


def stream_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.string(), pa.list_(pa.binary()), pa.int64(), pa.list_(pa.int64()), pa.int64(), pa.int32()]
    names = ["lang", "words", "f", "parts", "added", "missing"]
    return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*rows), kinds)], names=names)


def in_order(counts: DataFrame) -> DataFrame:
    """(lang, words, f, parts, added) of all phrases, from a stream in the order of their words.

    Fronts that lie in the range before are few, one for each length and range; their counts are
    looked up and broadcast.
    """
    key = ["lang", "words"]
    made = stored(counts.select(*key, "f").repartitionByRange(*key).sortWithinPartitions(*key)
                  .mapInArrow(counted_stream, _STREAM))
    fronts = made.where("f is null").groupBy(*key).agg(F.max("added").alias("more"))
    fronts = stored(F.broadcast(fronts).join(counts, key).select(*key, "f", "more"))
    whole = made.where("f is not null").join(
        F.broadcast(fronts.select(*key, "more")), key, "left").withColumn(
        "added", F.greatest("added", F.coalesce("more", F.lit(0))))
    names = [*key, "f", "parts", "added"]
    result = whole.where("missing = 0").select(*names)
    open_ = whole.where("missing > 0")
    for k in range(1, LONGEST):
        looked = fronts.where(F.size("words") == k).select(
            "lang", F.col("words").alias("front"), F.col("f").alias(f"front_{k}"))
        open_ = open_.withColumn("front", F.slice("words", 1, k)).join(
            F.broadcast(looked), ["lang", "front"], "left").drop("front")
    filled = [F.coalesce(F.get("parts", F.lit(k - 1)), F.col(f"front_{k}")) for k in range(1, LONGEST)]
    return result.unionByName(open_.withColumn("parts", F.slice(F.array(*filled), 1, F.size("parts"))).select(*names))


def scored(batches, cover: int):
    """Scores of candidates that no longer phrase covers; whole numbers of any size."""
    for batch in batches:
        out = []
        columns = (batch.column(batch.schema.get_field_index(c)).to_pylist() for c in (
            "lang", "words", "f", "lefts", "rights", "added", "n"))
        for lang, words, a, lefts, rights, added, n in zip(*columns):
            if 100 * added >= cover * a:
                continue
            # The cut after k words leaves the last size - k, which the suffix order counts.
            cuts = [(1000 * a * n // (left * right), k, left, right)
                    for k, (left, right) in enumerate(zip(lefts, rights[::-1]), 1)]
            score, _, left, right = min(cuts)
            out.append((lang, b" ".join(words), a, left, right, n, score))
        if out:
            yield rows_batch(out, "lang string, phrase binary, a long, l long, r long, n long, score long")


def collocations(
    docs: DataFrame, least: int = LEAST, first: int = FIRST, cover: int = COVER, text_col: str = "text",
    lang_col: str = "lang",
) -> DataFrame:
    """The first phrases of each language: lang, rank, phrase, a, l, r, n, score.

    Texts are lower-cased (A-Z) and cut into pieces at `[.,;:!?\\x0A-\\x0D]`, pieces into words
    `[^\\x20\\x09]+`. Candidates are phrases of 2 to 5 words of one piece that occur `least` times,
    overlaps counted. `a` counts the phrase, `l` and `r` the parts of the cut with the least
    score floor(1000 a n / (l r)), the first of equal ones, and `n` all words of the language.
    A candidate goes if a longer one around it has `cover` hundredths of its count. A null text
    is empty, a null language `und`. Repeated rows count as often as they occur. An empty
    table, and a language without candidates, give no rows. Phrases count as equal when their
    64-bit hashes do.
    """
    chosen = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"),
                         F.col(text_col).cast("string").alias("text"))
    counts, totals = phrase_counts(chosen, least)
    if small_enough(totals, BROADCAST_LANGS):
        totals = F.broadcast(totals)
    front = in_order(counts).where(F.size("words") > 1)
    back = in_order(counts.withColumn("words", F.reverse("words"))).where(F.size("words") > 1)
    back = back.select("lang", F.reverse("words").alias("words"), F.col("parts").alias("rights"),
                       F.col("added").alias("before"))
    both = front.hint("merge").join(back.hint("merge"), ["lang", "words"]).select(
        "lang", "words", "f", F.col("parts").alias("lefts"), "rights", F.greatest("added", "before").alias("added"))
    kept = both.join(totals, "lang").mapInArrow(
        lambda batches: scored(batches, cover),
        "lang string, phrase binary, a long, l long, r long, n long, score long")
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = kept.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= first)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"),
                         F.col("phrase").cast("string").alias("phrase"), "a", "l", "r", "n", "score")
