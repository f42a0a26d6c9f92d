"""Decontamination with an FM-index per training shard.

A shard is a block of whole documents, taken as a sequence over the words of the test set:
every other word is the symbol 0. Runs without such a word, and runs shorter than the shortest
phrase, cannot hold a phrase and are left out before the suffixes are sorted.
The index answers all phrases at once by backward search over wavelet-tree ranks;
occurrences are located from sampled suffix positions and merged into removal spans.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from .arrays import (
    ALNUM, LOWER, chunked, distinct_spans, from_ragged, string_hashes, text_bytes, with_fields,
    word_spans,
)
from .phrases import BLOCK_WORDS, phrase_blocks, phrase_set
from .tables import stored

BLOCK_BYTES = 8 << 20
SAMPLE_RATE = 8

_SPANS = "doc_id long, n_words long, n_hit long, item_ids array<string>, spans binary, " \
    "runs binary, left string"


class WaveletTree:
    """Ranks of symbols in a sequence, one bit level after the other (as a wavelet matrix)."""

    def __init__(self, symbols: np.ndarray, alphabet: int):
        self.levels = max(1, int(alphabet - 1).bit_length())
        self.zeros, self.ranks = [], []
        current = symbols
        for level in range(self.levels - 1, -1, -1):
            bit = (current >> level) & 1
            ranks = np.zeros(len(bit) + 1, np.int32)
            np.cumsum(bit, out=ranks[1:])
            self.ranks.append(ranks)
            self.zeros.append(len(bit) - int(ranks[-1]))
            current = np.concatenate([current[bit == 0], current[bit == 1]])

    def rank(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before its position."""
        low, high = np.zeros_like(at), at
        for depth, level in enumerate(range(self.levels - 1, -1, -1)):
            ranks, zeros = self.ranks[depth], self.zeros[depth]
            one = ((symbols >> level) & 1) == 1
            low = np.where(one, zeros + ranks[low], low - ranks[low])
            high = np.where(one, zeros + ranks[high], high - ranks[high])
        return high - low

    def symbols_at(self, at: np.ndarray) -> np.ndarray:
        out = np.zeros_like(at)
        for ranks, zeros in zip(self.ranks, self.zeros):
            bit = ranks[at + 1] - ranks[at]
            out = out * 2 + bit
            at = np.where(bit == 1, zeros + ranks[at], at - ranks[at])
        return out


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Suffix order by prefix doubling; the end of the text is the smallest."""
    n = len(text)
    rank = np.unique(text, return_inverse=True)[1].astype(np.int64) + 1
    step = 1
    while True:
        second = np.zeros(n, np.int64)
        second[: max(0, n - step)] = rank[step:]
        key = rank * (n + 2) + second
        order = np.argsort(key, kind="stable")
        fresh = np.empty(n, np.int64)
        fresh[order] = np.cumsum(np.r_[True, key[order][1:] != key[order][:-1]])
        if fresh.max(initial=0) == n:
            return order
        rank, step = fresh, step * 2


class FmIndex:
    """Burrows-Wheeler transform of a text over 1..alphabet-1, with 0 as its end."""

    def __init__(self, text: np.ndarray, alphabet: int, rate: int = SAMPLE_RATE):
        closed = np.append(text, 0)
        order = suffix_array(closed)
        self.alphabet, self.rate = alphabet, rate
        self.tree = WaveletTree(closed[order - 1], alphabet)
        self.before = np.concatenate([[0], np.cumsum(np.bincount(closed, minlength=alphabet))])
        kept = order % rate == 0
        self.sampled = np.concatenate([[0], np.cumsum(kept)])
        self.samples = order[kept]

    def search(self, phrases: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row ranges of phrases (one per row, padded at the end), all at once, last word first."""
        low = np.zeros(len(phrases), np.int64)
        high = np.full(len(phrases), int(self.before[-1]), np.int64)
        for back in range(phrases.shape[1]):
            live = np.flatnonzero((lengths > back) & (high > low))
            if not len(live):
                break
            symbol = phrases[live, lengths[live] - 1 - back]
            low[live] = self.before[symbol] + self.tree.rank(symbol, low[live])
            high[live] = self.before[symbol] + self.tree.rank(symbol, high[live])
        return low, np.maximum(high, low)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of suffix rows: steps back to a sampled row are added to its position."""
        found = np.full(len(rows), -1, np.int64)
        open_, at = np.arange(len(rows)), rows
        for steps in range(self.rate):
            known = self.sampled[at + 1] > self.sampled[at]
            found[open_[known]] = self.samples[self.sampled[at[known]]] + steps
            open_, at = open_[~known], at[~known]
            if not len(at):
                break
            symbol = self.tree.symbols_at(at)
            at = self.before[symbol] + self.tree.rank(symbol, at)
        return found


def kept_runs(symbols: np.ndarray, shortest: int) -> tuple[np.ndarray, np.ndarray]:
    """The runs of at least `shortest` symbols above 0, each closed by a separator, with the
    place of every entry; the separator is the symbol 1, so that 0 stays the end."""
    inside = np.r_[False, symbols > 0, False]
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[::2], edges[1::2]
    long_enough = ends - starts >= shortest
    starts, sizes = starts[long_enough], (ends - starts)[long_enough] + 1
    place = from_ragged(sizes, starts)
    closing = np.cumsum(sizes) - 1
    text = symbols[np.minimum(place, len(symbols) - 1)] + 1
    text[closing] = 1
    return text, place


def known_words(hashes: np.ndarray, vocabulary: np.ndarray) -> np.ndarray:
    """1 and more: the word's place in the vocabulary; 0: not one of them."""
    if not len(vocabulary):
        return np.zeros(len(hashes), np.int64)
    at = np.minimum(np.searchsorted(vocabulary, hashes), len(vocabulary) - 1)
    return np.where(vocabulary[at] == hashes, at + 1, 0)


def search_blocks(batches, sets: dict | None, rate: int, only_hit: bool = False):
    """Rows with a struct that holds doc_id and text (or, of the whole row, the fields so named):
    counts of words and hit words, the items, and the hit spans by bytes and by words."""
    for batch in chunked(batches, "text", BLOCK_BYTES):
        raw, offsets = text_bytes(batch.column(2))
        low = LOWER[raw]
        starts, ends, first = word_spans(low, offsets, ALNUM)
        n_docs, n_words = batch.num_rows, np.diff(first)
        hit = np.zeros(len(starts) + 1, np.int64)
        pairs, names = np.zeros(0, np.int64), []
        if len(starts) and sets:
            names, phrases, lengths = sets["names"], sets["phrases"], sets["lengths"]
            codes, words = distinct_spans(low, starts, ends)
            known = known_words(string_hashes(words), sets["vocabulary"])
            # One place more after each document keeps runs apart.
            owner = np.searchsorted(first, np.arange(len(starts)), "right") - 1
            spread = np.zeros(len(starts) + n_docs, np.int64)
            spread[np.arange(len(starts)) + owner] = known[codes]
            text, place = kept_runs(spread, int(lengths.min()))
            if len(text):
                index = FmIndex(text, len(sets["vocabulary"]) + 2, rate)
                begin, end = index.search(np.where(phrases > 0, phrases + 1, 0), lengths)
                size = end - begin
                phrase = np.repeat(np.arange(len(phrases)), size)
                at = place[index.locate(from_ragged(size, begin))]
                doc = np.searchsorted(first[:-1] + np.arange(n_docs), at, "right") - 1
                at = at - doc
                hit += np.bincount(at, minlength=len(hit))
                hit -= np.bincount(at + lengths[phrase], minlength=len(hit))
                # A phrase that occurs many times in a document names its items once.
                met = np.unique(doc * len(phrases) + phrase)
                doc, phrase = met // len(phrases), met % len(phrases)
                begins = np.cumsum(sets["degrees"]) - sets["degrees"]
                many = sets["degrees"][phrase]
                item = sets["owners"][from_ragged(many, begins[phrase])]
                pairs = np.unique(np.repeat(doc, many) * len(names) + item)
        covered = np.cumsum(hit)[:-1] > 0
        n_hit = np.diff(np.concatenate([[0], np.cumsum(covered)])[first])
        item_at = np.searchsorted(pairs, np.arange(n_docs + 1) * max(1, len(names)))
        found, spans, runs = [[] for _ in range(n_docs)], [None] * n_docs, [None] * n_docs
        for i in np.flatnonzero(n_hit).tolist():
            own = np.r_[False, covered[first[i] : first[i + 1]], False]
            edges = np.flatnonzero(own[1:] != own[:-1]).reshape(-1, 2)
            a = starts[first[i] + edges[:, 0]] - offsets[i]
            b = ends[first[i] + edges[:, 1] - 1] - offsets[i]
            spans[i] = np.stack([a, b], 1).astype("<i8").tobytes()
            runs[i] = edges.astype("<i8").tobytes()
            # Names are in order and occur once, so their numbers are too.
            found[i] = [names[x] for x in (pairs[item_at[i] : item_at[i + 1]] % len(names)).tolist()]
        out = search_batch(batch, raw, offsets, n_words, n_hit, found, spans, runs)
        yield out.filter(pa.array(n_hit > 0)) if only_hit else out


def cut(data: bytes, spans: bytes) -> str:
    """What is left of a text without its hit spans."""
    left, at = [], 0
    for a, b in np.frombuffer(spans, "<i8").reshape(-1, 2).tolist():
        left.append(data[at:a])
        at = b
    return b"".join([*left, data[at:]]).decode("utf-8", "replace")


def search_batch(batch, raw, offsets, n_words, n_hit, found, spans, runs) -> pa.RecordBatch:
    left = [None] * len(spans)
    for i in np.flatnonzero((n_hit > 0) & (20 * n_hit >= n_words)).tolist():
        left[i] = cut(raw[offsets[i] : offsets[i + 1]].tobytes(), spans[i])
    columns = [
        batch.column(1).cast(pa.int64()), pa.array(n_words, pa.int64()), pa.array(n_hit, pa.int64()),
        pa.array(found, pa.list_(pa.string())), pa.array(spans, pa.binary()), pa.array(runs, pa.binary()),
        pa.array(left, pa.string()),
    ]
    names = [field.strip().split(" ")[0] for field in _SPANS.split(",")]
    return pa.RecordBatch.from_arrays([batch.column(0), *columns], names=["row", *names])


def merged_spans(spans: list[bytes], runs: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Spans of one document from several searches, made one where their words overlap or touch."""
    pairs, words = (np.concatenate([np.frombuffer(x, "<i8").reshape(-1, 2) for x in part])
                    for part in (spans, runs))
    order = np.argsort(words[:, 0], kind="stable")
    pairs, words = pairs[order], words[order]
    # Bytes and words of spans end in the same order.
    last, last_byte = (np.maximum.accumulate(x[:, 1]) for x in (words, pairs))
    opens = np.flatnonzero(np.r_[True, words[1:, 0] > last[:-1]])
    closes = np.r_[opens[1:], len(words)] - 1
    return (np.stack([pairs[opens, 0], last_byte[closes]], 1),
            np.stack([words[opens, 0], last[closes]], 1))


def merge_blocks(batches):
    """The rows of a search from what several searches found: lists of items, spans and runs."""
    for batch in chunked(batches, "text", BLOCK_BYTES):
        raw, offsets = text_bytes(batch.column(2))
        _, _, first = word_spans(LOWER[raw], offsets, ALNUM)
        n_docs = batch.num_rows
        n_hit = np.zeros(n_docs, np.int64)
        items, spans, runs = [[] for _ in range(n_docs)], [None] * n_docs, [None] * n_docs
        for i, parts in enumerate(zip(*(batch.column(c).to_pylist() for c in (3, 4, 5)))):
            if parts[1]:
                pairs, words = merged_spans(parts[1], parts[2])
                n_hit[i] = int((words[:, 1] - words[:, 0]).sum())
                items[i] = sorted(set(parts[0]))
                spans[i], runs[i] = (x.astype("<i8").tobytes() for x in (pairs, words))
        yield search_batch(batch, raw, offsets, np.diff(first), n_hit, items, spans, runs)


def find_contamination(
    docs: DataFrame, items: DataFrame, size: int = 13, id_col: str = "doc_id",
    text_col: str = "text", item_col: str = "item_id", item_text: str = "text",
    block_words: int = BLOCK_WORDS, rate: int = SAMPLE_RATE,
) -> DataFrame:
    """One row per input row: row (all of it), doc_id, n_words, n_hit, item_ids, spans, runs,
    left, contaminated.

    Words are `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+` after lower-casing A-Z. A phrase is a
    window of `size` consecutive words of an item, or all words of a shorter one. `item_ids` lists
    the ids with occurring phrases, sorted as text; `spans` holds the merged byte ranges to
    remove and `runs` their words, from 0 (pairs of little-endian 64-bit numbers), or null. A document
    counts as contaminated with a twentieth of its words hit, or more; `left` is its text without the
    spans, and null for others. Texts that are null or
    empty have no words; items with a null id or text, or no words, take no part; repeated items
    count once by id; repeated documents are searched each. No items: nothing is hit.

    The test set may be of any size: its phrases are searched in blocks of about `block_words`
    words, one broadcast after the other. What the blocks find in a document is put together before
    words and items are counted. The driver holds the phrases of one block, as hashes, and the ids
    of its items.
    """
    spark = docs.sparkSession
    listed = items.select(F.col(item_col).cast("string").alias("id"), F.col(item_text).alias("text"))
    blocks = phrase_blocks(listed, size, block_words)
    numbers = sorted(r.block for r in blocks.select("block").collect())

    def searched(rows: DataFrame, number: int | None, only_hit: bool, id_name: str, text_name: str):
        sets = spark.sparkContext.broadcast(None if number is None else phrase_set(blocks, number, size))
        schema = T.StructType([rows.schema["row"], *T.DataType.fromDDL(_SPANS).fields])
        return rows.mapInArrow(
            lambda batches: search_blocks(
                with_fields(batches, doc_id=id_name, text=text_name), sets.value, rate, only_hit), schema)

    whole = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"))
    if len(numbers) <= 1:
        found = searched(whole, numbers[0] if numbers else None, False, id_col, text_col)
    else:
        mark = F.unhex(F.sha2(F.coalesce(F.col(text_col).cast("string"), F.lit("")), 256))
        keyed = docs.select(F.struct(
            F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"),
            mark.alias("mark")).alias("row"))
        # Every search is stored, so that its broadcast has served when the next one begins.
        hits = reduce(DataFrame.unionByName, [
            stored(searched(keyed, number, True, "doc_id", "text")
                   .select("doc_id", F.col("row.mark").alias("mark"), "item_ids", "spans", "runs")
                   .dropDuplicates(["doc_id", "mark"])) for number in numbers])
        gathered = stored(hits.groupBy(F.col("doc_id").alias("hit_id"), "mark").agg(
            F.flatten(F.collect_list("item_ids")).alias("items"),
            F.collect_list("spans").alias("span_lists"), F.collect_list("runs").alias("run_lists")))
        key = mark.alias("own_mark")
        carried = docs.select(
            F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"),
            F.col(id_col).cast("long").alias("doc_id"), key)
        joined = carried.join(
            gathered, F.col("doc_id").eqNullSafe(F.col("hit_id")) & (F.col("own_mark") == F.col("mark")),
            "left").select("row", "doc_id", F.col(f"row.`{text_col}`").cast("string").alias("text"),
                           "items", "span_lists", "run_lists")
        schema = T.StructType([joined.schema["row"], *T.DataType.fromDDL(_SPANS).fields])
        found = joined.mapInArrow(merge_blocks, schema)
    hit = (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))
    return found.withColumn("contaminated", hit)


def contamination_digest(found: DataFrame) -> DataFrame:
    """The counts and a digest of the item ids instead of texts and spans."""
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"), "contaminated",
    )


def without_items(found: DataFrame, columns: list[str]) -> DataFrame:
    """The searched documents, columns and all, without the hit words of contaminated ones.

    A document of which no word is left goes; others stay, and those that are not contaminated
    stay as they are. `columns` has to hold `text`.
    """
    rest = found.where(~F.col("contaminated") | (F.col("n_hit") < F.col("n_words")))
    text = F.when(F.col("contaminated"), F.col("left")).otherwise(F.col("row.text")).alias("text")
    return rest.select(*(text if c == "text" else F.col(f"row.`{c}`") for c in columns))
