"""Removal of repeated byte strings by longest previous factors in anchored buckets.

A string of `length` bytes is found through its anchor: the place of its least hash of ANCHOR
consecutive bytes. Equal strings have equal anchors, so strings can only repeat where an anchor's
hash occurs twice. Each anchor owns a run of neighbouring string starts. Runs whose anchor
repeats are dealt into buckets by that hash. A bucket puts the suffixes of its runs in order; the
nearest ones before and after a suffix that lie further to the front give its longest previous
factor, up to `length` bytes. Where that is reached, the string starts earlier elsewhere.
Copies of whole documents, and equal runs within a block of documents, are settled before
anything travels. An anchor with very many runs is spread over several buckets; what stays open
there is settled by one more aggregation over the strings themselves.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from .arrays import chunked, distinct_spans, from_ragged, give_back, mix, segment_hashes, text_bytes, with_fields
from .tables import pack, pack_sorted, shards, small_enough, stored, unpack, unpack_sorted
from .token_counts import rows_batch

LENGTH = 100
ANCHOR = 32
BLOCK_BYTES = 2 << 20
SHARD_BYTES = 8 << 20
#: Bytes that are hashed at a time; a longer text alone.
SLICE_BYTES = 256 << 10
#: Bytes that are compared, or hashed as open strings, at a time: their indices take eight times that.
COMPARED_BYTES = 512 << 10
#: Bytes of the runs that one task takes together, on average, and of those that it puts in order
#: at a time: buckets side by side, or a larger one alone. A part has so many buckets that anchors
#: with many runs seldom share one; of one anchor, a bucket has so many runs at most.
GROUP_BYTES = 8 << 20
BUCKET_BYTES = 256 << 10
BUCKETS = 1 << 16
BUCKET_RUNS = 8_192
#: Ids of copies that may be broadcast: 32 MB of them.
BROADCAST_IDS = 2_000_000

_ASKED = "shard int, block long, doc_ids binary, marks binary, hashes binary, owners binary, numbers binary"
_FOUND = "block long, doc_ids binary, marks binary, owners binary, numbers binary, spread binary"
_SHARED = "doc_id long, mark long, numbers binary, spread binary"
_RUNS = "part int, buckets binary, doc_ids binary, marks binary, starts binary, sizes binary, runs binary, " \
    "spread binary, gone_ids binary, gone_marks binary, gone_from binary, gone_to binary"
_SETTLED = "doc_id long, mark long, first long, last long, key_a long, key_b long"
_KEPT = "doc_id long, kept binary, n_bytes long, n_removed long, n_spans long, spans binary"

MULTIPLIER = 0x9E3779B97F4A7C15


def anchored_runs(raw: np.ndarray, offsets: np.ndarray, length: int):
    """Runs of string starts with one anchor: first and last start, anchor hash, document.

    Among equal hashes the leftmost is the anchor. Runs are in text order. Documents are hashed
    a slice at a time, as that takes many bytes for each byte of text.
    """
    parts, start = [], 0
    while start < len(offsets) - 1:
        stop = max(start + 1, int(np.searchsorted(offsets, offsets[start] + SLICE_BYTES, "right")) - 1)
        base = offsets[start]
        first, last, hashes, owner = sliced_runs(
            raw[base : offsets[stop]], offsets[start : stop + 1] - base, length)
        parts.append((first + base, last + base, hashes, owner + start))
        start = stop
    if not parts:
        return sliced_runs(raw, offsets, length)
    return tuple(np.concatenate(x) for x in zip(*parts))


def sliced_runs(raw: np.ndarray, offsets: np.ndarray, length: int):
    n, width, empty = len(raw), length - ANCHOR + 1, np.zeros(0, np.int64)
    sizes = np.diff(offsets)
    starts = from_ragged(np.maximum(sizes - length + 1, 0), offsets[:-1])
    if not len(starts):
        return empty, empty, empty.astype(np.uint64), empty
    powers = np.full(n + 1, np.uint64(MULTIPLIER))
    powers[0] = 1
    powers = np.multiply.accumulate(powers)
    inverse = np.full(n + 1, np.uint64(pow(MULTIPLIER, -1, 1 << 64)))
    inverse[0] = 1
    inverse = np.multiply.accumulate(inverse)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(mix(np.arange(256, dtype=np.uint64))[raw] * powers[:n], out=sums[1:])
    grams = mix((sums[ANCHOR:] - sums[:-ANCHOR]) * inverse[: n - ANCHOR + 1])
    del powers, inverse, sums
    low = np.uint64(31)
    least = (grams >> low << low) | np.arange(len(grams), dtype=np.uint64)
    span = 1
    while span * 2 <= width:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    least = np.minimum(least[: len(least) - (width - span)], least[width - span :])
    anchor = (least & np.uint64((1 << 31) - 1)).astype(np.int64)[starts]
    opens = np.r_[True, (anchor[1:] != anchor[:-1]) | (starts[1:] != starts[:-1] + 1)]
    first = np.flatnonzero(opens)
    last = np.r_[first[1:], len(starts)] - 1
    owner = np.searchsorted(offsets, starts[first], "right") - 1
    return starts[first], starts[last], grams[anchor[first]], owner


def numbered(owner: np.ndarray) -> np.ndarray:
    """0, 1, 2, ... within each owner; owners are sorted."""
    return np.arange(len(owner)) - np.searchsorted(owner, owner)


def shard_of(hashes: np.ndarray, parts: int) -> np.ndarray:
    """The shard of each anchor. Anchors are least hashes and lie close to 0, so they are mixed
    first: by their own size, most would go to the first shards."""
    return ((mix(hashes) >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)


def ask(batches, parts: int, length: int):
    """The anchors of a block's documents, per shard of their hashes."""
    from pyspark import TaskContext

    for number, batch in enumerate(chunked(batches, "text", BLOCK_BYTES)):
        block = (TaskContext.get().partitionId() << 32) + number
        _, _, hashes, owner = anchored_runs(*text_bytes(batch.column(2)), length)
        if not len(hashes):
            continue
        within = numbered(owner)
        ids, marks = (batch.column(i).to_numpy().astype(np.int64).tobytes() for i in (0, 1))
        rows = [(block % parts, block, ids, marks, None, None, None)]
        shard = shard_of(hashes, parts)
        order = np.lexsort((hashes, shard))
        cuts = np.searchsorted(shard[order], np.arange(parts + 1))
        for s in np.flatnonzero(np.diff(cuts)):
            own = order[cuts[s] : cuts[s + 1]]
            rows.append((int(s), block, None, None, pack_sorted(hashes[own]), pack(owner[own]),
                         pack(within[own])))
        yield rows_batch(rows, _ASKED)


def repeated_anchors(group: pa.Table) -> pa.Table:
    """Of each block, the anchors whose hash occurs twice, and over how many buckets to spread."""
    rows = group.to_pylist()
    out = [(r["block"], r["doc_ids"], r["marks"], None, None, None) for r in rows if r["doc_ids"]]
    held = [r for r in rows if not r["doc_ids"]]
    if held:
        hashes = [unpack_sorted(r["hashes"]) for r in held]
        _, code, count = np.unique(np.concatenate(hashes), return_inverse=True, return_counts=True)
        spread = np.where(count > 1, -(-count // BUCKET_RUNS), 0)[code]
        done = 0
        for r, own in zip(held, hashes):
            part = spread[done : done + len(own)]
            done += len(own)
            at = np.flatnonzero(part)
            if len(at):
                out.append((r["block"], None, None, pack(unpack(r["owners"])[at]),
                            pack(unpack(r["numbers"])[at]), pack(part[at])))
    return pa.Table.from_batches([rows_batch(out, _FOUND)])


def per_document(group: pa.Table) -> pa.Table:
    rows = group.to_pylist()
    head = next(r for r in rows if r["doc_ids"])
    ids, marks = np.frombuffer(head["doc_ids"], np.int64), np.frombuffer(head["marks"], np.int64)
    held = [r for r in rows if not r["doc_ids"]]
    out = []
    if held:
        owner, number, spread = (
            np.concatenate([unpack(r[name]) for r in held]) for name in ("owners", "numbers", "spread"))
        order = np.lexsort((number, owner))
        owner, number, spread = owner[order], number[order], spread[order]
        for a, b in zip(*edges(owner)):
            out.append((ids[owner[a]], marks[owner[a]], pack(number[a:b]), pack(spread[a:b])))
    return pa.Table.from_batches([rows_batch(out, _SHARED)])


def edges(values: np.ndarray) -> tuple[list[int], list[int]]:
    """Begins and ends of the runs of equal values."""
    cuts = np.flatnonzero(np.r_[True, values[1:] != values[:-1], True]) if len(values) else [0]
    cuts = np.asarray(cuts).tolist()
    return cuts[:-1], cuts[1:]


def send_runs(batches, parts: int, length: int):
    """Runs with a repeated anchor, per part, with their buckets in it: of equal runs in a block only the first in
    document order; the others are gone at once."""
    for batch in chunked(batches, "text", BLOCK_BYTES):
        raw, offsets = text_bytes(batch.column(2))
        first, last, hashes, owner = anchored_runs(raw, offsets, length)
        base = np.searchsorted(owner, np.arange(batch.num_rows))
        numbers = [unpack(x) for x in batch.column(3).to_pylist()]
        many = np.array([len(x) for x in numbers], np.int64)
        at = np.concatenate(numbers) + np.repeat(base, many)
        spread = np.concatenate([unpack(x) for x in batch.column(4).to_pylist()])
        first, last, hashes, owner = first[at], last[at], hashes[at], owner[at]
        ids = batch.column(0).to_numpy().astype(np.int64)[owner]
        marks = batch.column(1).to_numpy().astype(np.int64)[owner]
        starts = first - offsets[owner]
        codes, _ = distinct_spans(raw, first, last + length)
        order = np.lexsort((starts, marks, ids, codes))
        later = np.zeros(len(order), bool)
        later[order[1:]] = codes[order[1:]] == codes[order[:-1]]
        salt = np.where(spread > 1, mix(ids.view(np.uint64)) % np.maximum(spread, 1).astype(np.uint64),
                        np.uint64(0)).astype(np.uint64)
        dealt = mix(hashes + salt * np.uint64(MULTIPLIER))
        part = (dealt % np.uint64(parts)).astype(np.int64)
        bucket = (dealt // np.uint64(parts) % np.uint64(BUCKETS)).astype(np.int64)
        sizes = last - first + length
        order = np.argsort(part, kind="stable")
        cuts = np.searchsorted(part[order], np.arange(parts + 1))
        rows = []
        for s in np.flatnonzero(np.diff(cuts)):
            own = order[cuts[s] : cuts[s + 1]]
            gone, sent = own[later[own]], own[~later[own]]
            rows.append((
                int(s), pack(bucket[sent]), ids[sent].tobytes(), marks[sent].tobytes(), pack(starts[sent]),
                pack(sizes[sent]), raw[from_ragged(sizes[sent], first[sent])].tobytes(),
                pack(spread[sent]), ids[gone].tobytes(), marks[gone].tobytes(), pack(starts[gone]),
                pack(starts[gone] + sizes[gone] - length)))
        yield rows_batch(rows, _RUNS)


def ranked(parts: list[np.ndarray]) -> np.ndarray:
    """Ranks of tuples of ranks, which are packed into one number as far as they fit."""
    key = parts[0]
    for part in parts[1:]:
        size = int(part.max(initial=0)) + 1
        if int(key.max(initial=0)) * size >= 1 << 62:
            key = np.unique(key, return_inverse=True)[1]
        key = key * np.int64(size) + part
    return np.unique(key, return_inverse=True)[1]


def suffix_ranks(text: np.ndarray, at: np.ndarray, length: int) -> np.ndarray:
    """Ranks of the suffixes at the given places by their first `length` bytes.

    Prefixes grow from 8 bytes threefold; each step ranks only the places that the next one reads.
    """
    n = len(text)
    spread, offsets = [8], []
    while spread[-1] * 3 < length:
        spread.append(spread[-1] * 3)
    for have in reversed([*spread[1:], length]):
        offsets.append([0, have // 3, 2 * (have // 3)])
    last = spread[-1]
    offsets[0] = [0, length - last] if length <= 2 * last else [0, last, length - last]
    places = [at]
    for step in offsets[:-1]:
        wanted = np.zeros(n + length, bool)
        for offset in step:
            wanted[places[-1] + offset] = True
        places.append(np.flatnonzero(wanted))
    packed = np.concatenate([text, np.zeros(length + 8, np.uint8)]).astype(np.uint64)
    for width in (1, 2, 4):
        packed = (packed << np.uint64(8 * width)) | np.concatenate(
            [packed[width:], np.zeros(width, np.uint64)])
    rank = np.zeros(n + length + 8, np.int64)
    step = offsets[-1]
    wanted = np.zeros(n + length + 8, bool)
    for offset in step:
        wanted[places[-1] + offset] = True
    found = np.flatnonzero(wanted)
    packed = packed[found]
    rank[found] = np.unique(packed, return_inverse=True)[1]
    del packed, wanted, found
    for step, place in zip(reversed(offsets), reversed(places)):
        found = ranked([rank[place + offset] for offset in step])
        rank[place] = found
    return found


def common_prefixes(text: np.ndarray, one: np.ndarray, two: np.ndarray, length: int) -> np.ndarray:
    """How many of the first `length` bytes at places `one` and `two` agree."""
    found = np.zeros(len(one), np.int64)
    step = max(1, COMPARED_BYTES // length)
    inside = np.arange(length)
    for i in range(0, len(one), step):
        differ = text[one[i : i + step, None] + inside] != text[two[i : i + step, None] + inside]
        found[i : i + step] = np.where(differ.any(1), differ.argmax(1), length)
    return found


def previous_factors(text: np.ndarray, at: np.ndarray, length: int) -> np.ndarray:
    """Longest previous factors, up to `length`: for each of the places `at`, in their order, how
    many bytes from there on also start at an earlier one. `length` bytes follow every place.

    The suffixes are taken in order with the bytes that neighbours share. A suffix stays open
    until one that lies further to the front comes (its next smaller position), or one that shares
    no more with it than it does with its previous smaller position.
    """
    order = np.argsort(suffix_ranks(text, at, length), kind="stable")
    shared = np.zeros(len(order) + 1, np.int64)
    shared[1:-1] = common_prefixes(text, at[order[:-1]], at[order[1:]], length)
    factors = [0] * len(order)
    open_: list[tuple[int, int]] = []
    # The last one lies before all others and closes them.
    for position, common in zip([*order.tolist(), -1], shared.tolist()):
        while open_:
            top, before = open_[-1]
            if position < top:
                factors[top] = before if before > common else common
                common = before if before < common else common
            elif common <= before:
                factors[top] = before
            else:
                break
            open_.pop()
        open_.append((position, common))
    return np.array(factors, np.int64)


def settle_part(group: pa.Table, length: int) -> pa.Table:
    """Starts of strings that also start earlier, as ranges; the open strings of spread anchors.

    The buckets of a part are put in order one after the other, small ones together.
    """
    rows = group.to_pylist()
    gone = [np.concatenate([np.frombuffer(r["gone_ids"], np.int64) for r in rows]),
            np.concatenate([np.frombuffer(r["gone_marks"], np.int64) for r in rows]),
            np.concatenate([unpack(r["gone_from"]) for r in rows]),
            np.concatenate([unpack(r["gone_to"]) for r in rows])]
    ids = np.concatenate([np.frombuffer(r["doc_ids"], np.int64) for r in rows])
    marks = np.concatenate([np.frombuffer(r["marks"], np.int64) for r in rows])
    starts, sizes, spread, bucket = (
        np.concatenate([unpack(r[name]) for r in rows]) for name in ("starts", "sizes", "spread", "buckets"))
    text = np.frombuffer(b"".join(r["runs"] for r in rows), np.uint8)
    del rows, group
    begins = np.cumsum(sizes) - sizes
    bucket = side_by_side(bucket, sizes)
    order = np.lexsort((starts, marks, ids, bucket))
    none = pa.nulls(len(gone[0]), pa.int64())
    names = [f.strip().split(" ")[0] for f in _SETTLED.split(",")]
    found = [pa.table([*map(pa.array, gone), none, none], names=names)]
    for a, b in zip(*edges(bucket[order])):
        own = order[a:b]
        runs = text[from_ragged(sizes[own], begins[own])]
        found.extend(pa.table(list(map(pa.array, columns)), names=names) for columns in settle_bucket(
            ids[own], marks[own], starts[own], sizes[own], spread[own], runs, length))
    settled = pa.concat_tables([t.cast(found[0].schema) for t in found])
    give_back()
    return settled


def side_by_side(bucket: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Buckets numbered anew, so that small neighbours have one number: as many as begin within
    the same `BUCKET_BYTES`."""
    held = np.bincount(bucket, sizes).astype(np.int64)
    return ((np.cumsum(held) - held) // BUCKET_BYTES)[bucket]


def settle_bucket(ids, marks, starts, sizes, spread, text: np.ndarray, length: int):
    """One bucket's runs, in document order: ranges that are gone, and open strings with hashes."""
    begins = np.cumsum(sizes) - sizes
    windows = sizes - length + 1
    at = from_ragged(windows, begins)
    run = np.repeat(np.arange(len(ids)), windows)
    start = from_ragged(windows, starts)
    removed = previous_factors(text, at, length) >= length
    hit = np.flatnonzero(removed)
    breaks = np.r_[True, (run[hit][1:] != run[hit][:-1]) | (hit[1:] != hit[:-1] + 1)][: len(hit)]
    a = hit[breaks]
    b = hit[np.r_[np.flatnonzero(breaks)[1:], len(hit)] - 1] if len(hit) else hit
    none = np.ma.masked_all(len(a), np.int64)
    yield ids[run[a]], marks[run[a]], start[a], start[b], none, none
    every = np.flatnonzero(~removed & (spread[run] > 1))
    step = max(1, COMPARED_BYTES // length)
    for i in range(0, len(every), step):
        open_ = every[i : i + step]
        flat = text[from_ragged(np.full(len(open_), length), at[open_])]
        cuts = np.arange(len(open_) + 1) * length
        keys = [segment_hashes(flat, cuts, seed).view(np.int64) for seed in (1, 2)]
        yield ids[run[open_]], marks[run[open_]], start[open_], start[open_], *keys


def merged(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Overlapping or touching byte ranges made one."""
    order = np.argsort(starts, kind="stable")
    starts, ends = starts[order], np.maximum.accumulate(ends[order])
    opens = np.r_[True, starts[1:] > ends[:-1]]
    return starts[opens], ends[np.r_[np.flatnonzero(opens)[1:], len(starts)] - 1]


def cut_texts(batches, text_col: str, length: int):
    """The rows with what is left of the text, as bytes, and the spans that are gone."""
    names = [f.strip().split(" ")[0] for f in _KEPT.split(",")]
    for batch in chunked(with_fields(batches, text=text_col), "text"):
        rows = []
        for ranges, copy, text in zip(*(batch.column(i).to_pylist() for i in (2, 3, 4))):
            data = (text or "").encode()
            spans = np.zeros((0, 2), np.int64)
            if copy and len(data) >= length:
                spans = np.array([[0, len(data)]])
            elif ranges:
                pairs = np.array([(r["first"], r["last"]) for r in ranges], np.int64)
                spans = np.stack(merged(pairs[:, 0], pairs[:, 1] + length), 1)
            left, at = [], 0
            for a, b in spans.tolist():
                left.append(data[at:a])
                at = b
            rest = b"".join([*left, data[at:]])
            rows.append((rest, len(data), len(data) - len(rest), len(spans),
                         spans.astype("<i8").tobytes() if len(spans) else None))
        kinds = [pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1),
             *(pa.array(list(c), k) for c, k in zip(zip(*rows) if rows else [()] * 5, kinds))],
            names=["row", *names])


def readable(batches):
    """Rows of which anything is left, with that as text, without characters that were cut in two."""
    for batch in with_fields(batches, text="text"):
        size, gone = (batch.column(batch.schema.get_field_index(name)).to_numpy()
                      for name in ("n_bytes", "n_removed"))
        batch = batch.filter(pa.array((gone == 0) | (gone < size)))
        texts = [kept.decode("utf-8", "ignore") if lost else text for kept, lost, text in zip(
            *(batch.column(batch.schema.get_field_index(name)).to_pylist() for name in ("kept", "n_removed", "text")))]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(texts, pa.string())], names=["row", "text"])


def repeated_ranges(docs: DataFrame, length: int, id_col: str, text_col: str) -> DataFrame:
    """Each row of the input as a struct, its id, the ranges of starts that go, and whether it is a copy."""
    spark = docs.sparkSession
    # Null ids sort first; the mark tells the texts of one id apart.
    lowest = F.lit(-(1 << 63))
    docs = docs.select(
        F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"),
        F.col(id_col).cast("long").alias("given"),
        F.coalesce(F.col(id_col).cast("long"), lowest).alias("doc_id"),
        F.col(text_col).cast("string").alias("text"),
    ).withColumn("mark", F.xxhash64(F.coalesce("text", F.lit(""))))
    long_enough = F.octet_length("text") >= length
    digests = docs.where(long_enough).select("doc_id", "mark", F.unhex(F.sha2("text", 256)).alias("sha"))
    originals = digests.groupBy("sha").agg(F.min("doc_id").alias("least"), F.count("*").alias("n"))
    # Rows of one id and text are one document, of which one row is read; copies of other ids are not.
    alike = stored(
        digests.join(stored(originals.where("n > 1").drop("n")), "sha").groupBy("doc_id", "mark")
        .agg(F.max(F.col("doc_id") > F.col("least")).alias("copy"), F.count("*").alias("n"))
        .where("copy or n > 1").drop("n"))
    few = F.broadcast(alike) if small_enough(alike, BROADCAST_IDS) else alike
    texts = docs.where(long_enough).select("doc_id", "mark", "text")
    pair = ["doc_id", "mark"]
    repeated = stored(texts.join(few.where("not copy"), pair, "left_semi").dropDuplicates(pair))
    sources = texts.join(few, pair, "left_anti").unionByName(repeated)
    copies = alike.where("copy")

    parts = shards(docs, "text", SHARD_BYTES)
    asked = sources.mapInArrow(lambda batches: ask(batches, parts, length), _ASKED)
    found = asked.groupBy("shard").applyInArrow(repeated_anchors, _FOUND)
    shared = stored(found.groupBy("block").applyInArrow(per_document, _SHARED))
    anchors = shared.agg(F.coalesce(F.sum(F.octet_length("numbers")), F.lit(0))).first()[0]
    taken = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-anchors * 131 // GROUP_BYTES))
    runs = sources.join(shared.hint("merge"), pair).select(
        "doc_id", "mark", "text", "numbers", "spread")
    settled = stored(
        runs.mapInArrow(lambda batches: send_runs(batches, taken, length), _RUNS)
        .groupBy("part").applyInArrow(lambda group: settle_part(group, length), _SETTLED))

    left = settled.where("key_a is not null")
    place = F.struct("doc_id", "mark", "first")
    earliest = stored(left.groupBy("key_a", "key_b").agg(F.min(place).alias("least"), F.count("*").alias("n"))
                      .where("n > 1").drop("n"))
    later = left.join(earliest, ["key_a", "key_b"]).where(place > F.col("least"))
    names = ["doc_id", "mark", "first", "last"]
    ranges = stored(
        settled.where("key_a is null").select(*names).unionByName(later.select(*names))
        .groupBy("doc_id", "mark").agg(F.collect_list(F.struct("first", "last")).alias("ranges"))
        .withColumn("copy", F.lit(False))
        .unionByName(copies.select("doc_id", "mark", F.lit(None).cast(
            "array<struct<first:bigint,last:bigint>>").alias("ranges"), F.lit(True).alias("copy"))))
    return docs.select("row", "given", "doc_id", "mark").join(
        ranges.hint("merge"), ["doc_id", "mark"], "left").select("row", "given", "ranges", "copy")


def remove_repeats(
    docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """One row per input row: row (all of it), doc_id, kept (binary), n_bytes, n_removed, n_spans,
    spans.

    Texts are UTF-8 bytes, null counts as empty. Every byte is removed that lies in a string of
    `length` bytes which also starts earlier: in a document of a smaller id, or in the same
    one further to the front. Strings are judged on the input and never cross documents. `spans`
    holds the removed byte ranges (pairs of little-endian 64-bit numbers), or null. `kept`
    may end or begin within a character. Repeated rows with one id and text are one document;
    different texts of one id go in the order of their hash. A row with a null id
    comes before all others. An empty table gives no rows; other columns are only carried.
    """
    ranges = repeated_ranges(docs, length, id_col, text_col)
    schema = T.StructType([ranges.schema["row"], *T.DataType.fromDDL(_KEPT).fields])
    return ranges.mapInArrow(lambda batches: cut_texts(batches, text_col, length), schema)


def without_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """The documents with what is left of their texts, columns and all; n_chars is set anew.

    Texts that lose nothing stay as they are; a character cut in two goes, and so does a document
    of which nothing is left.
    """
    ranges = repeated_ranges(docs, length, "doc_id", "text")
    schema = T.StructType([ranges.schema["row"], T.StructField("text", T.StringType())])
    # One Python step for both: a second one in the stage would be a second worker a task.
    return ranges.mapInArrow(
        lambda batches: readable(cut_texts(batches, "text", length)), schema).select(
        *("text" if c == "text" else F.col(f"row.`{c}`") for c in docs.columns))


def repeats_digest(kept: DataFrame) -> DataFrame:
    """The counts and a digest of what is left instead of texts and spans."""
    return kept.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
