"""Vectorised text helpers: numpy over the UTF-8 bytes of many documents at once."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 4 << 20
GATHERED_BYTES = 1 << 20

_M1 = np.uint64(0x9E3779B97F4A7C15)
_M2 = np.uint64(0xBF58476D1CE4E5B9)
_M3 = np.uint64(0x94D049BB133111EB)


def mix(x: np.ndarray) -> np.ndarray:
    """The 64-bit finaliser of splitmix64: a bijection that spreads every input bit."""
    x = x.astype(np.uint64, copy=True)
    x += _M1
    x ^= x >> np.uint64(30)
    x *= _M2
    x ^= x >> np.uint64(27)
    x *= _M3
    x ^= x >> np.uint64(31)
    return x


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The joined UTF-8 bytes of a string column and its n + 1 offsets; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def give_back() -> None:
    """Hand freed memory back to the machine: a Python worker waits for its next task with all it has."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def chunked(
    batches: Iterator[pa.RecordBatch], name: str, limit: int = CHUNK_BYTES
) -> Iterator[pa.RecordBatch]:
    """The rows again, in slices of about `limit` text bytes; a longer text stands alone."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = np.diff(text_bytes(batch.column(batch.schema.get_field_index(name)))[1])
        start, held = 0, 0
        for i, size in enumerate(sizes.tolist()):
            if i > start and held + size > limit:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += size
        yield batch.slice(start)
    give_back()


def with_fields(batches: Iterator[pa.RecordBatch], **names: str) -> Iterator[pa.RecordBatch]:
    """Rows held in the struct of the first column, with some of its fields beside it under the
    given names; other columns stay."""
    for batch in batches:
        row = batch.column(0)
        fields = [row.field(name) for name in names.values()]
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, *fields], names=[*batch.schema.names, *names])


def byte_table(pattern: str) -> np.ndarray:
    """Which of the 256 bytes belong to a word, from text like '\\x20\\x09-\\x0D' left out."""
    import re

    left_out = re.compile(f"[{pattern}]")
    return np.array([b >= 128 or not left_out.match(chr(b)) for b in range(256)])


#: Lower-cases A-Z and leaves every other byte.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

#: Words `[^\x20\x09-\x0D]+` and `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`.
SPACED = byte_table(r"\x20\x09-\x0D")
ALNUM = byte_table(r"\x00-\x2F\x3A-\x60\x7B-\x7F")


def word_spans(
    raw: np.ndarray, offsets: np.ndarray, member: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of member bytes, and each document's first run.

    Runs never cross documents. The last array has n + 1 entries.
    """
    inside = member[raw]
    opens = inside.copy()
    opens[1:] &= ~inside[:-1]
    cuts = offsets[:-1][offsets[:-1] < len(raw)]
    opens[cuts] = inside[cuts]
    starts = np.flatnonzero(opens)
    closes = inside.copy()
    closes[:-1] &= ~inside[1:]
    last = offsets[1:][offsets[1:] > 0] - 1
    closes[last] = inside[last]
    ends = np.flatnonzero(closes) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def distinct_spans(
    raw: np.ndarray, starts: np.ndarray, ends: np.ndarray
) -> tuple[np.ndarray, pa.Array]:
    """Codes of the byte strings raw[start:end], and the distinct strings in code order."""
    sizes = ends - starts
    at = np.zeros(len(sizes) + 1, np.int64)
    np.cumsum(sizes, out=at[1:])
    # Gathered in parts, as an index takes eight times the bytes.
    joined = np.empty(at[-1], np.uint8)
    cuts = np.unique(np.append(np.searchsorted(at, np.arange(0, at[-1], GATHERED_BYTES)), len(sizes)))
    for a, b in zip(cuts[:-1], cuts[1:]):
        joined[at[a] : at[b]] = raw[from_ragged(sizes[a:b], starts[a:b])]
    spans = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(sizes), [None, pa.py_buffer(at), pa.py_buffer(joined)]
    )
    coded = spans.dictionary_encode()
    return coded.indices.to_numpy(zero_copy_only=False), coded.dictionary


def string_hashes(strings: pa.Array, seed: int = 0) -> np.ndarray:
    """64-bit hashes of byte strings: random table entries by place and byte, summed."""
    if not len(strings):
        return np.zeros(0, np.uint64)
    _, offsets, data = strings.buffers()
    at = np.frombuffer(offsets, np.int64)[strings.offset : strings.offset + len(strings) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    raw, at = raw[at[0] : at[-1]], at - at[0]
    return segment_hashes(raw, at, seed)


def segment_hashes(raw: np.ndarray, at: np.ndarray, seed: int = 0) -> np.ndarray:
    """64-bit hashes of the consecutive segments raw[at[i]:at[i + 1]]."""
    places = 64
    table = mix(np.arange(places * 256, dtype=np.uint64) + np.uint64(seed << 20))
    sizes = np.diff(at)
    place = np.arange(len(raw), dtype=np.int64) - np.repeat(at[:-1], sizes)
    values = table[(place & (places - 1)) * 256 + raw]
    if len(sizes) and sizes.max() > places:
        # 1 for the first places, so that short segments hash alike beside long ones.
        values *= (mix((place >> 6).astype(np.uint64)) ^ mix(np.zeros(1, np.uint64))) | np.uint64(1)
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(values, out=sums[1:])
    return mix((sums[at[1:]] - sums[at[:-1]]) ^ mix(sizes.astype(np.uint64)))


def lowered_words(
    raw: np.ndarray, offsets: np.ndarray, member: np.ndarray
) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """Word codes in text order, the distinct lower-cased words, and each document's first word."""
    low = LOWER[raw]
    starts, ends, first = word_spans(low, offsets, member)
    codes, words = distinct_spans(low, starts, ends)
    return codes, words, first


def gram_hashes(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hashes of the n consecutive entries that begin at each place; the last n - 1 are left out."""
    size = max(0, len(hashes) - n + 1)
    out = np.zeros(size, np.uint64)
    for k in range(n):
        out = mix(out ^ hashes[k : k + size])
    return out


def whole_grams(first: np.ndarray, n: int) -> np.ndarray:
    """Places at which n consecutive words of one document begin."""
    counts = np.maximum(np.diff(first) - n + 1, 0)
    total = int(counts.sum())
    before = np.cumsum(counts) - counts
    return np.arange(total) + np.repeat(first[:-1] - before, counts)


def from_ragged(sizes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Indices start, start + 1, ... for each piece of the given size, one piece after the other."""
    before = np.cumsum(sizes) - sizes
    return np.arange(int(sizes.sum()), dtype=np.int64) + np.repeat(starts - before, sizes)
