"""Token counts: pieces counted once per distinct pre-token, joined to document frequencies.

A text is cut into pre-tokens only where the byte-level pattern of the tokenizer always
ends a match, so that the pieces of a text are the pieces of its pre-tokens, in order.
Documents of a block share one dictionary. Each distinct pre-token goes with its postings
(document, frequency) to one shard by its hash; a shard counts the pieces of each distinct
pre-token once and multiplies. What travels grows with the distinct pre-tokens of a block.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from .arrays import chunked, distinct_spans, from_ragged, string_hashes, text_bytes
from .tables import pack, shards, unpack

BLOCK_BYTES = 8 << 20
SHARD_BYTES = 8 << 20
#: A pre-token in more than this share of a block's documents is spread over the shards by block.
HOT_SHARE = 1 / 16

_PARTS = "shard int, block long, doc_ids binary, no_id binary, sizes binary, strings binary, " \
    "lengths binary, degrees binary, members binary, times binary"
_SUMS = "block long, doc_ids binary, no_id binary, sizes binary, members binary, sums binary"
_COUNTS = "doc_id long, n_bytes long, n_tokens long"


def byte_classes() -> np.ndarray:
    """0 for bytes around which no cut is made, else 1 letter, 2 digit, 3 punctuation, 4 blank,
    5 line feed."""
    kinds = np.zeros(256, np.uint8)
    for b in range(33, 127):
        kinds[b] = 1 if chr(b).isalpha() else 2 if chr(b).isdigit() else 3
    kinds[ord("'")] = 0
    kinds[32], kinds[10] = 4, 5
    return kinds


def pre_token_starts(raw: np.ndarray, offsets: np.ndarray, whole: np.ndarray) -> np.ndarray:
    """Where pre-tokens begin. Documents marked in `whole` stay in one piece.

    A cut is made before a blank that a printable ASCII byte follows, around a single line feed
    between printable ASCII bytes, and between ASCII letters, digits and punctuation. None
    is made next to an apostrophe, whose contractions the pattern tries first, nor next to
    bytes of which only a decoder knows the class.
    """
    kind = byte_classes()[raw]
    cut = np.zeros(len(raw), bool)
    solid = (kind >= 1) & (kind <= 3)
    cut[1:] = solid[1:] & solid[:-1] & (kind[1:] != kind[:-1])
    ink = (raw > 32) & (raw < 127)
    cut[:-1] |= (kind[:-1] == 4) & ink[1:]
    feed = np.flatnonzero(kind == 5)
    feed = feed[(feed > 0) & (feed < len(raw) - 1)]
    feed = feed[ink[feed - 1] & ink[feed + 1]]
    cut[feed] = True
    cut[feed + 1] = True
    for i in np.flatnonzero(whole):
        cut[offsets[i] : offsets[i + 1]] = False
    cut[offsets[:-1][offsets[:-1] < len(raw)]] = True
    return np.flatnonzero(cut)


def worker_cache(*key) -> dict:
    """A dictionary that lives as long as the Python worker, over all of its tasks.

    This module travels with every task by value, so what it holds itself is gone with the task.
    """
    import sys
    import types

    name = "_assaykit_worker"
    return sys.modules.setdefault(name, types.ModuleType(name)).__dict__.setdefault(repr(key), {})


def tokenizer_at(path: str):
    """The tokenizer of a file, read once by each Python worker; it runs on one thread."""
    import os

    held = worker_cache("tokenizer")
    if path not in held:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        held[path] = Tokenizer.from_file(path)
    return held[path]


def holding(raw: np.ndarray, offsets: np.ndarray, strings: list[bytes]) -> np.ndarray:
    """Which documents hold one of the strings."""
    joined, found = raw.tobytes(), np.zeros(len(offsets) - 1, bool)
    for text in strings:
        if text in joined:
            found |= [text in joined[a:b] for a, b in zip(offsets[:-1], offsets[1:])]
    return found


def special_strings(tokenizer) -> list[bytes]:
    return [t.content.encode() for t in tokenizer.get_added_tokens_decoder().values()]


def postings(batches, path: str, parts: int, id_col: str, text_col: str):
    """Blocks of documents as rows per shard: distinct pre-tokens with their postings."""
    from pyspark import TaskContext

    special = special_strings(tokenizer_at(path))
    for number, batch in enumerate(chunked(batches, text_col, BLOCK_BYTES)):
        block = (TaskContext.get().partitionId() << 32) + number
        ids = batch.column(batch.schema.get_field_index(id_col))
        raw, offsets = text_bytes(batch.column(batch.schema.get_field_index(text_col)))
        n = len(ids)
        whole = holding(raw, offsets, special)
        starts = pre_token_starts(raw, offsets, whole)
        codes, strings = distinct_spans(raw, starts, np.append(starts[1:], len(raw)))
        owner = np.searchsorted(offsets, starts, "right") - 1
        pair, times = np.unique(codes.astype(np.int64) * max(n, 1) + owner, return_counts=True)
        code, member = pair // max(n, 1), pair % max(n, 1)
        degree = np.bincount(code, minlength=len(strings))
        hashes = string_hashes(strings)
        hashes[degree > max(64, n * HOT_SHARE)] += np.uint64(block % (1 << 61))
        shard = (hashes % np.uint64(parts)).astype(np.int64)
        first = np.cumsum(degree) - degree
        order = np.argsort(shard, kind="stable")
        cuts = np.searchsorted(shard[order], np.arange(parts + 1))
        rows = [(block % parts, block, ids.fill_null(0).to_numpy(zero_copy_only=False).tobytes(),
                 pack(ids.is_null().to_numpy(zero_copy_only=False)), pack(np.diff(offsets)),
                 None, None, None, None, None)]
        for s in np.flatnonzero(np.diff(cuts)):
            own = order[cuts[s] : cuts[s + 1]]
            taken = strings.take(pa.array(own))
            at = from_ragged(degree[own], first[own])
            lengths = pc.binary_length(taken).to_numpy(zero_copy_only=False)
            rows.append((int(s), block, None, None, None, b"".join(taken.to_pylist()),
                         pack(lengths), pack(degree[own]), pack(member[at]), pack(times[at])))
        yield rows_batch(rows, _PARTS)


def rows_batch(rows: list[tuple], ddl: str) -> pa.RecordBatch:
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "string": pa.string(),
             "boolean": pa.bool_(), "double": pa.float64()}
    fields = [f.strip().split(" ") for f in ddl.split(",")]
    columns = list(zip(*rows)) or [()] * len(fields)
    return pa.RecordBatch.from_arrays(
        [pa.array(list(c), kinds[kind]) for c, (_, kind) in zip(columns, fields)],
        names=[name for name, _ in fields],
    )


def piece_counts(tokenizer, strings: pa.Array, step: int = 50_000) -> np.ndarray:
    """Pieces of each string; ids are dropped after every step."""
    counts = np.zeros(len(strings), np.int64)
    for i in range(0, len(strings), step):
        texts = [s.decode("utf-8", "replace") for s in strings.slice(i, step).to_pylist()]
        encoded = tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        counts[i : i + step] = [len(e) for e in encoded]
    return counts


def shard_sums(group: pa.Table, path: str) -> pa.Table:
    """Counts the shard's distinct pre-tokens once and sums them per block and document."""
    rows = group.to_pylist()
    held = [r for r in rows if r["strings"] is not None]
    out = [(r["block"], r["doc_ids"], r["no_id"], r["sizes"], None, None)
           for r in rows if r["strings"] is None]
    if held:
        lengths = [unpack(r["lengths"]) for r in held]
        at = np.concatenate([[0], np.cumsum(np.concatenate(lengths))]).astype(np.int64)
        data = pa.py_buffer(b"".join(r["strings"] for r in held))
        strings = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(at) - 1, [None, pa.py_buffer(at), data]
        ).dictionary_encode()
        counts = piece_counts(tokenizer_at(path), strings.dictionary)
        counts = counts[strings.indices.to_numpy(zero_copy_only=False)]
        done = 0
        for r, own in zip(held, lengths):
            per_string = counts[done : done + len(own)]
            done += len(own)
            weights = np.repeat(per_string, unpack(r["degrees"])) * unpack(r["times"])
            sums = np.bincount(unpack(r["members"]), weights).astype(np.int64)
            member = np.flatnonzero(sums)
            out.append((r["block"], None, None, None, pack(member), pack(sums[member])))
    return pa.Table.from_batches([rows_batch(out, _SUMS)])


def block_counts(group: pa.Table) -> pa.Table:
    """One row per document of the block, from the sums of all shards."""
    rows = group.to_pylist()
    head = next(r for r in rows if r["sizes"] is not None)
    sizes = unpack(head["sizes"])
    total = np.zeros(len(sizes), np.int64)
    for r in rows:
        if r["members"] is not None:
            total[unpack(r["members"])] += unpack(r["sums"])
    ids = pa.array(np.frombuffer(head["doc_ids"], np.int64), mask=unpack(head["no_id"]) > 0)
    return pa.table({"doc_id": ids, "n_bytes": sizes, "n_tokens": total})


def count_tokens(
    docs: DataFrame, tokenizer_path: str, limit: int = 1024, id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per input row: doc_id, n_bytes, n_tokens, over_limit (n_tokens > limit).

    `tokenizer_path` names a byte-level tokenizers file that every executor can read. A null or
    empty text has no tokens; repeated rows are counted each; a null id stays null; other
    columns are not read. A text that holds one of the tokenizer's special strings is
    counted whole, by the library. The input has to give the same rows in the same order
    when a task is run again, as a table does.
    """
    chosen = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    parts = 2 * shards(chosen, "text", SHARD_BYTES)
    pieces = chosen.mapInArrow(
        lambda batches: postings(batches, tokenizer_path, parts, "doc_id", "text"), _PARTS
    )
    sums = pieces.groupBy("shard").applyInArrow(lambda t: shard_sums(t, tokenizer_path), _SUMS)
    counts = sums.groupBy("block").applyInArrow(block_counts, _COUNTS)
    return counts.withColumn("over_limit", F.col("n_tokens") > limit)
