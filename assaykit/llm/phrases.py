"""Test items as blocks of distinct phrases, built by the executors.

A block holds a bounded number of words, whatever the size of the test set: words are 64-bit hashes,
and items longer than a piece are cut into pieces that overlap by one word less than a phrase, so
that every phrase lies in one of them.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .arrays import ALNUM, chunked, from_ragged, lowered_words, string_hashes, text_bytes
from .tables import stored

#: Words of a block, at most by one piece more, and phrases of a piece.
BLOCK_WORDS = 1 << 18
PIECE_PHRASES = 1 << 14
#: Bytes of items that are dealt to a task.
TASK_BYTES = 32 << 20

_BLOCK = "block long, names array<string>, vocabulary binary, phrases binary, lengths binary, " \
    "degrees binary, owners binary"


def word_hashes(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the lower-cased words in text order, and each text's first word."""
    codes, words, first = lowered_words(raw, offsets, ALNUM)
    return string_hashes(words)[codes] if len(codes) else np.zeros(0, np.uint64), first


def pieces(batches, size: int):
    """Names with the word hashes of their items, long items in overlapping pieces."""
    for batch in chunked(batches, "text"):
        hashes, first = word_hashes(*text_bytes(batch.column(1)))
        for name, a, b in zip(batch.column(0).to_pylist(), first[:-1].tolist(), first[1:].tolist()):
            for start in range(a, max(a + 1, b - size + 1) if b > a else a, PIECE_PHRASES):
                yield name, hashes[start : min(b, start + PIECE_PHRASES + size - 1)]


def phrase_block(held: list[tuple[str, np.ndarray]], size: int) -> tuple:
    """The distinct phrases of some pieces over their own vocabulary, and each one's names."""
    names = sorted({name for name, _ in held})
    number = {name: i for i, name in enumerate(names)}
    counts = np.array([len(words) for _, words in held], np.int64)
    vocabulary, codes = np.unique(np.concatenate([words for _, words in held]), return_inverse=True)
    windows = np.maximum(counts - size + 1, 1)
    starts = from_ragged(windows, np.cumsum(counts) - counts)
    lengths = np.repeat(np.minimum(counts, size), windows)
    at = np.minimum(starts[:, None] + np.arange(size), len(codes) - 1)
    every = np.where(np.arange(size) < lengths[:, None], codes[at] + 1, 0).astype(np.int32)
    phrases, phrase = np.unique(every, axis=0, return_inverse=True)
    owner = np.repeat([number[name] for name, _ in held], windows)
    pairs = np.unique(phrase.ravel().astype(np.int64) * len(names) + owner)
    degrees = np.bincount(pairs // len(names), minlength=len(phrases))
    return (names, vocabulary.tobytes(), phrases.tobytes(),
            (phrases > 0).sum(1).astype(np.int32).tobytes(), degrees.astype(np.int32).tobytes(),
            (pairs % len(names)).astype(np.int32).tobytes())


def build_blocks(batches, size: int, block_words: int):
    """Pieces gathered up to a number of words; long names count as words of eight bytes."""
    from pyspark import TaskContext

    task, held, weight, made = TaskContext.get().partitionId(), [], 0, 0
    for name, words in pieces(batches, size):
        held.append((name, words))
        weight += len(words) + len(name.encode()) // 8
        if weight >= block_words:
            yield block_batch((task << 32) + made, phrase_block(held, size))
            held, weight, made = [], 0, made + 1
    if held:
        yield block_batch((task << 32) + made, phrase_block(held, size))


def block_batch(number: int, block: tuple) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.list_(pa.string()), *[pa.binary()] * 5]
    names = [field.strip().split(" ")[0] for field in _BLOCK.split(",")]
    return pa.RecordBatch.from_arrays(
        [pa.array([value], kind) for value, kind in zip((number, *block), kinds)], names=names)


def phrase_blocks(items: DataFrame, size: int, block_words: int) -> DataFrame:
    """The blocks of the items (id, text), as a stored table; repeated items count once."""
    listed = items.dropna().dropDuplicates()
    held = listed.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    # Tasks of about TASK_BYTES: each may leave one block that is not full.
    dealt = listed.coalesce(max(1, -(-held // TASK_BYTES)))
    return stored(dealt.mapInArrow(lambda batches: build_blocks(batches, size, block_words), _BLOCK))


def phrase_set(blocks: DataFrame, number: int, size: int) -> dict:
    """One block as arrays, for a broadcast of bounded size."""
    row = blocks.where(F.col("block") == number).first()
    return {
        "names": list(row.names), "vocabulary": np.frombuffer(row.vocabulary, np.uint64),
        "phrases": np.frombuffer(row.phrases, np.int32).reshape(-1, size).astype(np.int64),
        "lengths": np.frombuffer(row.lengths, np.int32).astype(np.int64),
        "degrees": np.frombuffer(row.degrees, np.int32).astype(np.int64),
        "owners": np.frombuffer(row.owners, np.int32).astype(np.int64),
    }
