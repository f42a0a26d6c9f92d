"""Near duplicates by bottom-k sketches from one hash function.

Equal shingle sets become one class first. Inverted lists of the retained values give
candidates: in each list every class is held against the list's most typical one, not against
all others. The sketch of the union estimates the similarity and drops unlikely pairs; the
rest are confirmed on the full sets. Members of lists that then still are in different components
are compared with each other on their full sets, in blocks.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .arrays import SPACED, chunked, gram_hashes, lowered_words, mix, string_hashes, text_bytes, \
    whole_grams
from .components import component_of
from .tables import small_enough, stored
from .token_counts import rows_batch

WORDS = 5
SIMILARITY = (3, 4)
RETAINED = 32
#: Chance of losing a pair that is just similar enough, by its sketches.
MISS = 1e-7
#: Members of a list that are compared with each other in one task.
LIST_BLOCK = 512
#: Shingles of a slice of the incidence of a block's members.
INCIDENCE = 4096
#: Ids that may be broadcast: 16 MB of them.
BROADCAST_IDS = 2_000_000

_SETS = "doc_id long, n_shingles long, key_a long, key_b long, sketch array<long>"
_FULL = "node long, shingles binary"
_PAIRS = "a long, b long"


def shingle_sets(batch: pa.RecordBatch, words: int):
    """Each document's distinct shingle hashes in order; a short text is one shingle."""
    raw, offsets = text_bytes(batch.column(1))
    codes, strings, first = lowered_words(raw, offsets, SPACED)
    hashes = string_hashes(strings)[codes] if len(codes) else np.zeros(0, np.uint64)
    grams = gram_hashes(hashes, words)[whole_grams(first, words)]
    counts = np.diff(first)
    ends = np.cumsum(np.maximum(counts - words + 1, 0))
    for i, count in enumerate(counts.tolist()):
        if count >= words:
            yield np.unique(grams[ends[i] - (count - words + 1) : ends[i]])
        elif count:
            yield gram_hashes(hashes[first[i] : first[i + 1]], count)
        else:
            yield np.zeros(0, np.uint64)


def signatures(batches, words: int, retained: int):
    """Set size, a 128-bit key of the whole set and its least hashes, per document."""
    salt = np.uint64(0x5851F42D4C957F2D)
    for batch in chunked(batches, "text"):
        rows = []
        for doc, grams in zip(batch.column(0).to_pylist(), shingle_sets(batch, words)):
            keys = (None, None)
            if len(grams):
                keys = tuple(int(x.view(np.int64)) for x in
                             (mix(grams).sum(dtype=np.uint64), mix(grams ^ salt).sum(dtype=np.uint64)))
            least = grams[:retained].view(np.int64).tolist()
            rows.append((doc, len(grams), *keys, least))
        kinds = [pa.int64()] * 4 + [pa.list_(pa.int64())]
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(c), k) for c, k in zip(zip(*rows), kinds)],
            names=[f.strip().split(" ")[0] for f in _SETS.split(",")])


def least_common(retained: int, similarity: float, miss: float) -> int:
    """The most common retained values that a just similar pair lacks with chance below `miss`."""
    total, need = 0.0, 0
    for hits in range(retained + 1):
        total += math.comb(retained, hits) * similarity**hits * (1 - similarity) ** (retained - hits)
        if total > miss:
            break
        need = hits + 1
    return max(1, need)


def required(n: str, retained: int, similarity: tuple[int, int]):
    """Retained values that a class of size n has in common with any similar class.

    Up to the size at which similar classes are sure to be retained whole, this is exact.
    """
    top, bottom = similarity
    need = least_common(retained, top / bottom, MISS)
    exact = F.ceil(F.col(n) * top / bottom)
    return F.when(F.col(n) * bottom <= retained * top, exact).otherwise(
        F.least(F.lit(need), exact)).cast("int")


def estimated(retained: int, similarity: tuple[int, int]):
    """Whether sketches sa, sb of sets sized na, nb leave a chance that the sets are similar."""
    top, bottom = similarity
    union = F.slice(F.array_sort(F.array_union("sa", "sb")), 1, retained)
    shared = F.size(F.array_intersect(union, F.array_intersect("sa", "sb")))
    whole = (F.col("na") <= retained) & (F.col("nb") <= retained)
    all_of = F.size(F.array_intersect("sa", "sb")) * bottom >= F.size(F.array_union("sa", "sb")) * top
    sizes = bottom * F.least("na", "nb") >= top * F.greatest("na", "nb")
    need = least_common(retained, top / bottom, MISS)
    return sizes & F.when(whole, all_of).otherwise(shared >= need)


def retained_lists(classes: DataFrame, retained: int, similarity: tuple[int, int]) -> DataFrame:
    """(value, node, weight): each class in the lists of its rarest shared values.

    Two similar classes have at least `required` values in common, so a class may leave out that
    many less one of its most frequent values without losing a pair.
    """
    values = classes.select("node", "n", F.explode("sketch").alias("value"))
    frequent = stored(values.groupBy("value").agg(F.count("*").alias("df")).where("df > 1"))
    per_class = (
        values.join(frequent, "value").groupBy("node", "n")
        .agg(F.array_sort(F.collect_list(F.struct("df", "value"))).alias("shared"))
        .withColumn("keep", F.size("shared") - required("n", retained, similarity) + 1)
        .where("keep > 0")
        .withColumn("weight", F.expr("aggregate(shared, 0L, (s, x) -> s + x.df)"))
    )
    listed = per_class.select("node", "weight", F.explode(F.expr("slice(shared, 1, keep)")).alias("x"))
    return stored(listed.select(F.col("x.value").alias("value"), "node", "weight"))


def with_sketches(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    a = classes.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("sketch").alias("sa"))
    b = classes.select(F.col("node").alias("b"), F.col("n").alias("nb"), F.col("sketch").alias("sb"))
    return pairs.join(a, "a").join(b, "b")


def full_sets(batches, words: int):
    for batch in chunked(batches, "text"):
        rows = [(doc, grams.tobytes()) for doc, grams in
                zip(batch.column(0).to_pylist(), shingle_sets(batch, words))]
        yield rows_batch(rows, _FULL)


def similar_pairs(batches, similarity: tuple[int, int]):
    """The pairs whose full sets are similar."""
    top, bottom = similarity
    for batch in batches:
        rows = []
        for a, b, x, y in zip(*(batch.column(i).to_pylist() for i in range(4))):
            x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
            both = len(np.intersect1d(x, y, assume_unique=True))
            if both and bottom * both >= top * (len(x) + len(y) - both):
                rows.append((a, b))
        if rows:
            yield rows_batch(rows, _PAIRS)


def confirmed(pairs: DataFrame, docs: DataFrame, words: int, similarity: tuple[int, int]) -> DataFrame:
    """The stored pairs (a, b) that are similar on their full shingle sets."""
    nodes = stored(pairs.select(F.col("a").alias("doc_id")).unionByName(
        pairs.select(F.col("b").alias("doc_id"))).distinct())
    if small_enough(nodes, BROADCAST_IDS):
        nodes = F.broadcast(nodes)
    sets = stored(docs.join(nodes, "doc_id", "left_semi").select("doc_id", "text")
                  .mapInArrow(lambda batches: full_sets(batches, words), _FULL))
    left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("x"))
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("y"))
    both = pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y")
    return stored(both.mapInArrow(lambda batches: similar_pairs(batches, similarity), _PAIRS).distinct())


def overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of all pairs of sets, by products of slices of their incidence."""
    row = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    _, code, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = count > 1
    number = np.cumsum(shared) - 1
    row, code = row[shared[code]], number[code[shared[code]]]
    order = np.argsort(code, kind="stable")
    row, code = row[order], code[order]
    both = np.zeros((len(sets), len(sets)), np.float32)
    for start in range(0, int(shared.sum()), INCIDENCE):
        a, b = np.searchsorted(code, [start, start + INCIDENCE])
        part = np.zeros((len(sets), INCIDENCE), np.float32)
        part[row[a:b], code[a:b] - start] = 1
        both += part @ part.T
    return both


def link_block(group: pa.Table, similarity: tuple[int, int]) -> pa.Table:
    """Links that connect what is similar among a block's members: each with the least member
    that its links, or links of links, in the block reach. Members of one component are not
    compared anew."""
    top, bottom = similarity
    node, part = group["node"].to_numpy(), group["component"].to_numpy()
    sets = [np.frombuffer(x, np.uint64) for x in group["shingles"].to_pylist()]
    size = np.array([len(x) for x in sets])
    both = overlaps(sets)
    alike = bottom * both >= top * (size[:, None] + size[None, :] - both)
    alike &= part[:, None] != part[None, :]
    label = node.copy()
    while True:
        least = np.where(alike, label[None, :], label[:, None]).min(1)
        if (least == label).all():
            break
        label = least
    return pa.table({"a": node[label != node], "b": label[label != node]})


def open_links(lists, hubs, parts, docs, words: int, similarity: tuple[int, int]) -> DataFrame:
    """Links (a, b) that the first round left open, exact on full sets.

    Two classes that a link may still join are in one list, and in different components. Lists
    of one typical class have mostly the same members, so they are merged, and members of merged
    lists that hold several components are compared, in blocks, each met by all others. Links
    leave a block as a forest, not as all pairs.
    """
    members = stored(
        lists.join(hubs, "value").where("node <> hub").select("hub", "node").distinct()
        .join(parts, "node", "left")
        .select("hub", "node", F.coalesce("component", "node").alias("component")))
    unsettled = stored(
        members.groupBy("hub")
        .agg(F.min("component").alias("x"), F.max("component").alias("y"), F.count("*").alias("m"))
        .where("x <> y").select("hub", F.ceil(F.col("m") / LIST_BLOCK).cast("int").alias("blocks")))
    left = stored(members.join(unsettled, "hub"))
    ids = left.select(F.col("node").alias("doc_id")).distinct()
    if small_enough(ids, BROADCAST_IDS):
        ids = F.broadcast(ids)
    sets = stored(docs.join(ids, "doc_id", "left_semi").select("doc_id", "text")
                  .mapInArrow(lambda batches: full_sets(batches, words), _FULL))
    blocks = (
        left.join(sets, "node")
        .withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select("hub", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
                "node", "component", "shingles"))
    return stored(blocks.groupBy("hub", "i", "j")
                  .applyInArrow(lambda group: link_block(group, similarity), _PAIRS).distinct())


def several_texts(sets: DataFrame, classes: DataFrame) -> DataFrame:
    """Links from an id that has several texts to the classes of all of them."""
    named = sets.where("doc_id is not null and n_shingles > 0").select("doc_id", "key_a", "key_b")
    ids = (named.groupBy("doc_id").agg(F.min("key_a").alias("x"), F.max("key_a").alias("y"))
           .where("x <> y").select("doc_id"))
    found = named.join(ids, "doc_id", "left_semi").join(classes, ["key_a", "key_b"])
    return stored(found.where("doc_id <> node").select(F.col("doc_id").alias("u"), F.col("node").alias("v")))


def near_duplicates(
    docs: DataFrame, words: int = WORDS, similarity: tuple[int, int] = SIMILARITY,
    retained: int = RETAINED, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id, kept.

    Words are `[^\\x20\\x09-\\x0D]+` after lower-casing A-Z; a set holds the distinct shingles of
    `words` words, or the whole sequence of a shorter text. Documents are linked when their sets'
    intersection is at least `similarity` of their union. `component_id` is the least id that links
    reach. Texts that are null or empty have no shingles and no links. Rows that share an
    id count as one document with several texts. A row with a null id has no links, a null
    component and is kept. An empty table gives no rows; other columns are not read.

    Shingles count as equal when their 64-bit hashes do, whole sets when 128 bits do. A pair of
    large sets that is only just similar is missed with chance below 1e-7.
    """
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    sets = stored(docs.mapInArrow(lambda batches: signatures(batches, words, retained), _SETS))
    classes = stored(
        sets.where("doc_id is not null and n_shingles > 0").groupBy("key_a", "key_b")
        .agg(F.min("doc_id").alias("node"), F.first("n_shingles").alias("n"),
             F.first("sketch").alias("sketch")))
    lists = retained_lists(classes, retained, similarity)
    hubs = stored(lists.groupBy("value").agg(
        F.max(F.struct("weight", (-F.col("node")).alias("less"))).alias("top"))
        .select("value", (-F.col("top.less")).alias("hub")))
    starred = (lists.join(hubs, "value").where("node <> hub")
               .select(F.least("node", "hub").alias("a"), F.greatest("node", "hub").alias("b")).distinct())
    likely = stored(with_sketches(starred, classes).where(estimated(retained, similarity)).select("a", "b"))
    links = confirmed(likely, docs, words, similarity).select(F.col("a").alias("u"), F.col("b").alias("v"))
    links = links.unionByName(several_texts(sets, classes))
    parts = stored(component_of(links))
    rest = open_links(lists, hubs, parts, docs, words, similarity)
    if not rest.isEmpty():
        more = rest.select(F.col("a").alias("u"), F.col("b").alias("v"))
        parts = stored(component_of(links.unionByName(more)))
    placed = classes.join(parts, "node", "left").select(
        "key_a", "key_b", F.coalesce("component", "node").alias("component_id"))
    return (
        sets.select("doc_id", "n_shingles", "key_a", "key_b").join(placed, ["key_a", "key_b"], "left")
        .withColumn("component_id", F.when(F.col("doc_id").isNull(), F.lit(None)).otherwise(
            F.coalesce("component_id", "doc_id")))
        .select("doc_id", "n_shingles", "component_id",
                F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept")))
