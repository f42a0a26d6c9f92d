"""Best-fit packing by sums of squares: token sequences of a fixed length from documents.

Tokens come from a lower-casing tokenizer that drops white space. Its pieces of a text are, in
order, those of the text's parts between blanks and between ASCII letters, digits and
punctuation, so each distinct lower-cased part is cut once. Only lengths decide the places. Pieces are numbered by task and place and dealt by the
hash of that number into shards of a few thousand; within a shard each
goes, longest first, where the squared counts of open sequences per residual gap sum to the least.
"""

from __future__ import annotations

import zlib
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .arrays import LOWER, SPACED, chunked, distinct_spans, from_ragged, text_bytes
from .tables import stored
from .token_counts import byte_classes, holding, rows_batch, special_strings, tokenizer_at, worker_cache

BLOCK_BYTES = 4 << 20
#: Pieces of a shard on average: sequences left open at its end are few against those it fills.
SHARD_PIECES = 4096
#: Distinct words of which a Python worker keeps the ids.
CACHED_WORDS = 400_000

_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, ids binary, " \
    "place long"
_PLACES = "doc_id long, piece int, start long, length long, ids_crc32 long, ids binary, " \
    "sequence_id long, offset long"


def word_ids(words: list[bytes], path: str, cache: dict) -> list[bytes]:
    """The ids of each word as little-endian 32-bit bytes; words not seen before are cut in one
    call."""
    missing = [w for w in words if w not in cache]
    if len(cache) + len(missing) > CACHED_WORDS:
        cache.clear()
        missing = words
    encoded = tokenizer_at(path).encode_batch_fast(
        [w.decode("utf-8", "replace") for w in missing], add_special_tokens=False
    )
    for word, found in zip(missing, encoded):
        cache[word] = array("I", found.ids).tobytes()
    return [cache[w] for w in words]


def part_spans(low: np.ndarray, offsets: np.ndarray, whole: np.ndarray):
    """Starts and ends of the parts that the tokenizer never joins, and each document's first.

    Documents marked in `whole` are one part. No cut is made next to an apostrophe, which may begin
    a contraction, nor next to bytes beyond ASCII.
    """
    kind, ink = byte_classes()[low], SPACED[low]
    solid = (kind >= 1) & (kind <= 3)
    opens, closes = ink.copy(), ink.copy()
    if len(low) > 1:
        cut = ~ink[:-1] | ~ink[1:] | (solid[:-1] & solid[1:] & (kind[:-1] != kind[1:]))
        opens[1:] &= cut
        closes[:-1] &= cut
    for i in np.flatnonzero(whole):
        opens[offsets[i] : offsets[i + 1]] = False
        closes[offsets[i] : offsets[i + 1]] = False
        ink = ink | False
        ink[offsets[i]] = ink[offsets[i + 1] - 1] = True
    fronts, backs = offsets[:-1][np.diff(offsets) > 0], offsets[1:][np.diff(offsets) > 0] - 1
    opens[fronts] = ink[fronts]
    closes[backs] = ink[backs]
    starts = np.flatnonzero(opens)
    return starts, np.flatnonzero(closes) + 1, np.searchsorted(starts, offsets)


def token_blocks(batches, path: str, end_id: int, text_col: str):
    """Slices of the input with the ids of their texts, each ended by `end_id`, and offsets."""
    cache = worker_cache("words", path)
    special = special_strings(tokenizer_at(path))
    for batch in chunked(batches, text_col, BLOCK_BYTES):
        raw, offsets = text_bytes(batch.column(batch.schema.get_field_index(text_col)))
        low = LOWER[raw]
        whole = holding(low, offsets, special)
        for i in np.flatnonzero(whole):
            low[offsets[i] : offsets[i + 1]] = raw[offsets[i] : offsets[i + 1]]
        starts, ends, first = part_spans(low, offsets, whole)
        codes, words = distinct_spans(low, starts, ends)
        held = word_ids(words.to_pylist(), path, cache)
        sizes = np.array([len(h) // 4 for h in held], np.int64)
        values = np.frombuffer(b"".join(held), "<u4")
        begins = np.cumsum(sizes) - sizes
        taken = sizes[codes] if len(codes) else np.zeros(0, np.int64)
        tokens = values[from_ragged(taken, begins[codes] if len(codes) else taken)]
        upto = np.concatenate([[0], np.cumsum(taken)])[first]
        n = batch.num_rows
        at = upto + np.arange(n + 1)
        ids = np.full(len(tokens) + n, end_id, "<u4")
        keep = np.ones(len(ids), bool)
        keep[at[1:] - 1] = False
        ids[keep] = tokens
        yield batch, ids, at


def pieces_of(batches, path: str, most: int, end_id: int, with_ids: bool):
    """The pieces of every document: all of at most `most` tokens, cut only if longer."""
    from pyspark import TaskContext

    place = TaskContext.get().partitionId() << 32
    for batch, ids, at in token_blocks(batches, path, end_id, "text"):
        rows = []
        for doc, (a, b) in zip(batch.column(0).to_pylist(), zip(at[:-1].tolist(), at[1:].tolist())):
            for number, start in enumerate(range(a, b, most)):
                own = ids[start : min(start + most, b)].tobytes()
                rows.append((doc, number, start - a, len(own) // 4, zlib.crc32(own),
                             own if with_ids else None, place))
                place += 1
        yield rows_batch(rows, _PIECES)


def sum_of_squares(lengths: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Sequence and offset of every item, in the given order.

    With n[g] open sequences of gap g, an item of length s goes where the sum of n[g]^2
    becomes smallest: into a gap g >= s, which changes it by 2 (n[g - s] - n[g]) + 2, or by
    1 - 2 n[s] when it fills the gap; or into a new sequence, by 2 n[most - s] + 1. Among equal
    gaps the smallest is taken, and a gap before a new sequence.
    """
    counts = np.zeros(most + 1, np.int64)
    waiting: dict[int, list[int]] = {}
    sequence = np.zeros(len(lengths), np.int64)
    offset = np.zeros(len(lengths), np.int64)
    opened, never = 0, 1 << 60
    for i, s in enumerate(lengths.tolist()):
        place = -1
        if s < most:
            there = counts[s:most]
            change = 2 * (counts[: most - s] - there) + 2
            change[0] = 1 - 2 * there[0]
            change[there == 0] = never
            best = int(np.argmin(change))
            if change[best] <= 2 * int(counts[most - s]) + 1:
                place = best
        if place < 0:
            number, gap = opened, most
            opened += 1
        else:
            gap = s + place
            number = waiting[gap].pop()
            counts[gap] -= 1
        sequence[i], offset[i] = number, most - gap
        if gap > s:
            counts[gap - s] += 1
            waiting.setdefault(gap - s, []).append(number)
    return sequence, offset


def pack_shard(key: tuple, group: pa.Table, most: int) -> pa.Table:
    group = group.drop_columns(["shard"]).sort_by(
        [("length", "descending"), ("doc_id", "ascending"), ("piece", "ascending"),
         ("place", "ascending")]
    ).drop_columns(["place"])
    sequence, offset = sum_of_squares(group["length"].to_numpy(), most)
    sequence += key[0].as_py() << 32
    return group.append_column("sequence_id", pa.array(sequence)).append_column(
        "offset", pa.array(offset)
    )


def pack_documents(
    docs: DataFrame, tokenizer_path: str, most: int = 4096, end_id: int = 1,
    with_ids: bool = True, id_col: str = "doc_id", text_col: str = "text",
    shard_pieces: int = SHARD_PIECES,
) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, ids, sequence_id, offset.

    `ids` holds little-endian 32-bit ids, or null without `with_ids`. Each document is one piece,
    or, with more than `most` tokens, pieces of `most` and a last shorter one. A null or
    empty text is the end id alone. Repeated rows are packed each; a null id stays null;
    an empty table gives no row; other columns are not read. The sequences left partly empty
    at the end of a shard are all that sharding costs.
    """
    chosen = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    # Stored, as only the cut texts tell the number of pieces, and texts are cut once.
    pieces = stored(chosen.mapInArrow(
        lambda batches: pieces_of(batches, tokenizer_path, most, end_id, with_ids), _PIECES
    ))
    count = max(1, -(-pieces.count() // shard_pieces))
    return (
        pieces.withColumn("shard", F.pmod(F.xxhash64("place"), F.lit(count)))
        .groupBy("shard")
        .applyInArrow(lambda key, group: pack_shard(key, group, most), _PLACES)
    )
