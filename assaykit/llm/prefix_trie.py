"""A trie of conversation prefixes, encoded as balanced parentheses per shard.

Conversations are rebuilt, cut into segments of a bounded number of turns, and equal segments behind
equal fronts are counted once. The distinct ones are ranged in the order of their turns, so
that every shard holds a stretch of the trie: it writes it as balanced parentheses, whose
range minima find where a subtree closes; ranks of leaf pairs and cumulative sums between the two
ends are the subtree's numbers. Nodes on the first and last path of a shard may go on in other
shards. These spines are merged by the hash of their turns, and what the shards found below them
is added up. Deeper segments are worked out first and hang below the ends of the shallower ones;
a segment that only one conversation reaches is a chain and needs no trie.
"""

from __future__ import annotations

import hashlib
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from .numbering import numbered
from .tables import small_enough, stored

#: Conversations that share a front, turns of it at most (less one), and ids of one family.
HEADS = 9
FAMILY = 5
#: Turns of a segment, turns of a shard on average, and parentheses of a block of minima.
SEGMENT = 512
SHARD_TURNS = 200_000
BLOCK = 256
#: Spine nodes that may be broadcast.
BROADCAST_NODES = 200_000

NO_ENDS = hashlib.sha256(b"").hexdigest()

_NODES = "path long, r1 long, r2 long, id string, parent_id string, depth int, conv_id long, " \
    "parent_conv_id long, bytes long, n_convs long, n_children long, n_leaves long, saved long"
_ENDS = "seg int, r1 long, r2 long, id string, ends_sha256 string"
_RESULT = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
           "ends_sha256"]


class Parentheses:
    """A sequence of +1 and -1 with the minimum of the excess over every block."""

    def __init__(self, steps: np.ndarray, block: int = BLOCK):
        self.excess, self.block = np.cumsum(steps), block
        self.least = np.minimum.reduceat(self.excess, np.arange(0, len(steps), block))

    def findclose(self, i: int) -> int:
        """Where the parenthesis that opens at i closes: the first fall below its own level."""
        level, start = self.excess[i] - 1, i + 1
        number = start // self.block
        stop = (number + 1) * self.block
        found = np.flatnonzero(self.excess[start:stop] == level)
        if len(found):
            return start + int(found[0])
        number += 1 + int(np.argmax(self.least[number + 1 :] <= level))
        start = number * self.block
        return start + int(np.argmax(self.excess[start : start + self.block] == level))


class Shard:
    """The trie of sorted distinct segments; `row` dictionaries name root, keys, sizes and counts."""

    def __init__(self, rows: list[dict]):
        self.steps, self.opens = [], []
        self.parent, self.depth, self.bytes, self.root = [], [], [], []
        count = sum(len(r["keys"]) + 1 for r in rows) + 1
        self.copies, self.least = np.zeros(count, np.int64), np.full(count, np.iinfo(np.int64).max)
        self.below = np.zeros((3, count), np.int64)
        self.goes_on = np.zeros(count, bool)
        self.ids: dict[int, str] = {}
        self.paths = []
        stack, keys, root = [], [], None
        for place, row in enumerate(rows):
            if (row["r1"], row["r2"]) != root:
                self.close(stack, 0)
                root, keys = (row["r1"], row["r2"]), []
                self.open(stack, root, 0)
            own, common = row["keys"], 0
            while common < min(len(keys), len(own)) and keys[common] == own[common]:
                common += 1
            self.close(stack, common + 1)
            for size in row["sizes"][common:]:
                self.open(stack, root, size)
            node, keys = stack[-1], own
            self.copies[node], self.least[node] = row["copies"], row["least"]
            self.goes_on[node] = row["goes_on"]
            self.below[:, node] = row["children_below"], row["leaves_below"], row["saved_below"]
            self.ids[node] = row["id"]
            if place in (0, len(rows) - 1):
                self.paths.append((list(stack), own))
        self.close(stack, 0)
        n = len(self.opens)
        self.copies, self.least, self.goes_on = self.copies[:n], self.least[:n], self.goes_on[:n]
        self.below = self.below[:, :n]

    def open(self, stack: list[int], root: tuple, size: int) -> None:
        self.parent.append(stack[-1] if stack else -1)
        self.depth.append(len(stack))
        self.bytes.append(size)
        self.root.append(root)
        stack.append(len(self.opens))
        self.opens.append(len(self.steps))
        self.steps.append(1)

    def close(self, stack: list[int], keep: int) -> None:
        while len(stack) > keep:
            stack.pop()
            self.steps.append(-1)

    def rows(self, shard: int) -> list[tuple]:
        """One row per node inside the shard, and one per path and node of the spines."""
        steps, opens = np.array(self.steps, np.int64), np.array(self.opens, np.int64)
        tree = Parentheses(steps)
        leaf = steps[opens + 1] < 0
        closes = np.array([o + 1 if e else tree.findclose(o) for o, e in zip(opens.tolist(), leaf.tolist())])
        n = len(opens)
        parent, size = np.array(self.parent), np.array(self.bytes, np.int64)
        spine = np.zeros(n, bool)
        for nodes, _ in self.paths:
            spine[nodes] = True

        def under(weight: np.ndarray) -> np.ndarray:
            """Sums over the subtrees, as differences of one cumulative array."""
            at = np.zeros(len(steps), np.int64)
            at[opens] = weight
            upto = np.cumsum(at)
            return upto[closes] - upto[opens] + weight

        members = under(self.copies)
        ends = np.arange(n) + (closes - opens + 1) // 2
        padded = np.append(self.least, np.iinfo(np.int64).max)
        least = np.minimum.reduceat(padded, np.stack([np.arange(n), ends], 1).ravel())[::2]
        inner = ~spine
        # The number of leaf pairs: a place where a deeper segment hangs counts that one's leaves.
        leaves = under(np.where(self.goes_on, self.below[1], leaf & inner))
        saved = under(np.where(inner, (members - 1) * size, 0) + self.below[2])
        has_parent = (parent >= 0) & inner
        children = np.bincount(parent[has_parent], minlength=n) + self.below[0]

        out, names = [], {}
        for number, (nodes, keys) in enumerate(self.paths):
            digest, ids = hashlib.md5(), []
            for d in range(len(nodes)):
                if d:
                    digest.update(keys[d - 1].encode())
                ids.append(digest.hexdigest())
            for d, node in enumerate(nodes):
                # A node on both paths brings its numbers once.
                again = node in names
                names[node] = ids[d]
                values = (0, 0, 0, 0) if again else (
                    int(members[node]), int(children[node]), int(leaves[node]), int(saved[node]))
                out.append((2 * shard + number, *self.root[node], ids[d], ids[d - 1] if d else None, d,
                            int(least[node]), None, int(size[node]), *values))
        for node in np.flatnonzero(inner).tolist():
            above = int(parent[node])
            out.append((
                None, *self.root[node], self.ids.get(node), names.get(above), self.depth[node],
                int(least[node]), None if above < 0 or above in names else int(least[above]),
                int(size[node]), int(members[node]), int(children[node]), int(leaves[node]),
                int(saved[node])))
        return out


def node_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "int": pa.int32(), "string": pa.string()}
    fields = [f.strip().split(" ") for f in _NODES.split(",")]
    return pa.RecordBatch.from_arrays(
        [pa.array(list(c), kinds[kind]) for c, (_, kind) in zip(zip(*rows), fields)],
        names=[name for name, _ in fields])


def shard_nodes(batches):
    """The nodes of one range of sorted segments."""
    from pyspark import TaskContext

    rows = [row for batch in batches for row in batch.to_pylist()]
    if rows:
        yield node_batch(Shard(rows).rows(TaskContext.get().partitionId()))


def ends_digests(batches):
    """SHA-256 of the ascending ids of each end, over rows sorted by end and id, as they stream."""
    key, digest = None, None
    names = [f.strip().split(" ")[0] for f in _ENDS.split(",")]
    kinds = [pa.int32(), pa.int64(), pa.int64(), pa.string(), pa.string()]
    for batch in batches:
        done = []
        for *own, conv in zip(*(c.to_pylist() for c in batch.columns)):
            if own != key:
                if key:
                    done.append((*key, digest.hexdigest()))
                key, digest = own, hashlib.sha256(str(conv).encode())
            else:
                digest.update(f",{conv}".encode())
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*done), kinds)], names=names)
    if key:
        yield pa.RecordBatch.from_arrays(
            [pa.array([c], k) for c, k in zip((*key, digest.hexdigest()), kinds)], names=names)


def rebuilt(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv_id, length) of every rebuilt conversation, and its turns (conv_id, depth, key, size).

    `key` is a hash of role and text. Turns are numbered by ranges, so a long conversation is
    not gathered in one task.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    turns = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn",
        F.md5(F.concat(F.octet_length(role), F.lit(":"), role, text)).alias("key"),
        F.octet_length(text).alias("size"))
    placed = numbered(turns, [F.col("conv_id"), F.asc_nulls_first("turn"), F.col("key")], "number")
    own = placed.groupBy("conv_id").agg(F.min("number").alias("first"), F.count("*").alias("n"))
    own = own.select("conv_id", "first", "n", (F.col("conv_id") - F.col("conv_id") % FAMILY).alias("front"),
                     (F.crc32(F.col("conv_id").cast("string")) % HEADS).alias("h"))
    own = stored(own)
    fronts = own.select(F.col("conv_id").alias("front"), F.col("n").alias("front_n"))
    convs = stored(own.join(fronts, "front", "left").withColumn(
        "taken", F.least("h", F.coalesce("front_n", F.lit(0)))).withColumn(
        "length", F.col("taken") + F.greatest(F.col("n") - F.col("h"), F.lit(0))))
    place = F.col("number") - F.col("first")
    known = placed.join(convs.select("conv_id", "first", "h", "taken"), "conv_id")
    names = ["conv_id", "depth", "key", "size"]
    tails = known.where(place >= F.col("h")).withColumn("depth", place - F.col("h") + F.col("taken") + 1)
    heads = known.where(place < HEADS - 1).select(
        F.col("conv_id").alias("front"), (place + 1).alias("depth"), "key", "size")
    fronted = convs.where("taken > 0").select("conv_id", "front", "taken").join(heads, "front")
    fronted = fronted.where(F.col("depth") <= F.col("taken"))
    return convs.select("conv_id", "length"), tails.select(*names).unionByName(fronted.select(*names))


def segments(convs: DataFrame, turns: DataFrame, most: int) -> DataFrame:
    """(conv_id, seg, keys, sizes, last, id, r1, r2, next1, next2): each conversation's turns in
    pieces of `most`, one piece without turns for an empty one.

    r1 and r2 are a hash of all turns before the piece, next1 and next2 one of those and its own.
    """
    part = ((F.col("depth") - 1) / most).cast("int")
    listed = F.sort_array(F.collect_list(F.struct("depth", "key", "size")))
    pieces = turns.groupBy("conv_id", part.alias("seg")).agg(listed.alias("turns"))
    pieces = convs.join(pieces, "conv_id", "left").select(
        "conv_id", F.coalesce("seg", F.lit(0)).alias("seg"),
        F.coalesce(F.transform("turns", lambda t: t["key"]), F.array().cast("array<string>")).alias("keys"),
        F.coalesce(F.transform("turns", lambda t: t["size"]), F.array().cast("array<int>")).alias("sizes"),
        F.coalesce(F.col("length") <= (F.col("seg") + 1) * most, F.lit(True)).alias("last"), "length")
    pieces = stored(pieces.withColumn("id", F.md5(F.array_join("keys", ""))))
    before = Window.partitionBy("conv_id").orderBy("seg").rowsBetween(Window.unboundedPreceding, -1)
    own = [F.xxhash64(F.lit(s), "seg", "id") for s in (1, 2)]
    many = pieces.where(F.col("length") > most)
    # One piece needs no window: nothing is before it.
    fronts = many.withColumns({f"r{i}": F.coalesce(F.bit_xor(h).over(before), F.lit(0).cast("long"))
                               for i, h in enumerate(own, 1)})
    short = pieces.where(F.col("length") <= most).withColumns(
        {f"r{i}": F.lit(0).cast("long") for i in (1, 2)})
    return fronts.unionByName(short).withColumns(
        {f"next{i}": F.col(f"r{i}").bitwiseXOR(h) for i, h in enumerate(own, 1)})


def level_nodes(rows: DataFrame, parts: int) -> DataFrame:
    """The nodes of one level's tries, spines merged; columns as in _NODES, without path."""
    order = ["r1", "r2", "keys"]
    made = stored(rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)
                  .mapInArrow(shard_nodes, _NODES))
    key = ["r1", "r2", "id"]
    parts_of = made.where("path is not null")
    merged = stored(parts_of.groupBy(*key).agg(
        F.min("path").alias("owner"), F.first("parent_id").alias("parent_id"), F.first("depth").alias("depth"),
        F.min("conv_id").alias("conv_id"), F.first("bytes").alias("bytes"),
        *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved")]))
    kids = merged.where("parent_id is not null").groupBy("r1", "r2", F.col("parent_id").alias("id")).agg(
        F.count("*").alias("kids"))
    merged = stored(merged.join(kids, key, "left").withColumn(
        "n_children", F.col("n_children") + F.coalesce("kids", F.lit(0))).drop("kids"))
    # Every spine node counts on one of its paths, for itself and all nodes above it there.
    mine = F.col("owner") == F.col("path")
    deeper = Window.partitionBy("path").orderBy(F.desc("depth")).rowsBetween(Window.unboundedPreceding, 0)
    along = parts_of.select("path", *key).join(merged.select(
        *key, "depth", "owner", "n_children", ((F.col("n_convs") - 1) * F.col("bytes")).alias("value")), key)
    added = along.select(
        *key, F.sum(F.when(mine, F.col("value")).otherwise(0)).over(deeper).alias("value"),
        F.sum(F.when(mine & (F.col("n_children") == 0), 1).otherwise(0)).over(deeper).alias("leaf"),
    ).groupBy(*key).agg(F.sum("value").alias("value"), F.sum("leaf").alias("leaf"))
    above = merged.select("r1", "r2", F.col("id").alias("parent_id"), F.col("conv_id").alias("above"))
    if small_enough(merged, BROADCAST_NODES):
        above = F.broadcast(above)
    spines = merged.join(added, key).withColumns({
        "n_leaves": F.col("n_leaves") + F.col("leaf"), "saved": F.col("saved") + F.col("value")})
    names = [*key, "depth", "conv_id", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved"]
    inner = made.where("path is null")
    hung = inner.where("parent_id is not null").drop("parent_conv_id").unionByName(
        spines.drop("owner", "value", "leaf").withColumn("path", F.lit(None).cast("long"))
    ).join(above, ["r1", "r2", "parent_id"], "left").withColumnRenamed("above", "parent_conv_id")
    return stored(inner.where("parent_id is null").select(*names).unionByName(hung.select(*names)))


def prefix_trie(conversations: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """One row per distinct prefix of the rebuilt conversations: conv_id, depth, parent_conv_id,
    n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    Reads conv_id, turn, role, text; other columns are not read. Turns are ordered by `turn`, null
    first, turns of one number by a hash of role and text; a null role or text is empty. Rows
    with a null conv_id belong to no conversation and are not read. Repeated rows are turns
    of their own. A conversation without turns after rebuilding is a member of the root. Without
    any conversation there are no rows. Turns are equal when 128 bits of their hashes are.
    """
    convs, turns = rebuilt(conversations)
    pieces = stored(segments(convs, turns, segment))
    ends = (pieces.where("last").select("seg", "r1", "r2", "id", "conv_id")
            .repartition("seg", "r1", "r2", "id").sortWithinPartitions("seg", "r1", "r2", "id", "conv_id")
            .mapInArrow(ends_digests, _ENDS))
    root = ["seg", "r1", "r2"]
    distinct = pieces.groupBy(*root, "id").agg(
        F.count("*").alias("copies"), F.min("conv_id").alias("least"), F.max(~F.col("last")).alias("goes_on"),
        *[F.first(c).alias(c) for c in ("keys", "sizes", "next1", "next2")])
    distinct = stored(distinct)
    chains = None
    deepest = distinct.where("seg > 0").agg(F.coalesce(F.max("seg"), F.lit(0))).first()[0]
    if deepest:
        reached = distinct.where("seg > 0").groupBy(*root).agg(F.sum("copies").alias("convs"))
        lone = stored(reached.where("convs = 1").select(*root))
        chains = distinct.join(lone, root, "left_semi")
        distinct = stored(distinct.join(lone, root, "left_anti"))
        deepest = distinct.agg(F.max("seg")).first()[0]
    found = []
    for level in range(deepest, -1, -1):
        rows = distinct.where(F.col("seg") == level)
        hangs = []
        if level < deepest:
            hangs.append(found[-1].where("depth = 0").select(
                F.col("r1").alias("next1"), F.col("r2").alias("next2"), F.col("n_children").alias("children_below"),
                F.col("n_leaves").alias("leaves_below"), F.col("saved").alias("saved_below")))
        if chains is not None:
            hangs.append(chains.where(F.col("seg") == level + 1).select(
                F.col("r1").alias("next1"), F.col("r2").alias("next2"), F.lit(1).cast("long").alias("children_below"),
                F.lit(1).cast("long").alias("leaves_below"), F.lit(0).cast("long").alias("saved_below")))
        under = ["children_below", "leaves_below", "saved_below"]
        if hangs:
            below = reduce(DataFrame.unionByName, hangs)
            rows = rows.where("not goes_on").unionByName(
                rows.where("goes_on").join(below, ["next1", "next2"], "left"), allowMissingColumns=True)
            rows = rows.withColumns({c: F.coalesce(c, F.lit(0).cast("long")) for c in under})
        else:
            rows = rows.withColumns({c: F.lit(0).cast("long") for c in under})
        rows = rows.select("r1", "r2", "keys", "sizes", "id", "copies", "least", "goes_on", *under)
        size = rows.agg(F.coalesce(F.sum(F.size("keys") + 1), F.lit(0))).first()[0]
        parts = max(int(conversations.sparkSession.conf.get("spark.sql.shuffle.partitions")),
                    -(-size // SHARD_TURNS))
        found.append(level_nodes(rows, parts))
    nodes = []
    for level, own in zip(range(deepest, -1, -1), found):
        own = own.where("depth > 0") if level else own
        nodes.append(own.withColumn("seg", F.lit(level)).withColumn(
            "depth", F.col("depth").cast("long") + level * segment))
    nodes = reduce(DataFrame.unionByName, nodes).withColumnRenamed("saved", "saved_tokens")
    marked = nodes.where("id is not null").join(ends, [*root, "id"], "left")
    none = F.lit(NO_ENDS)
    result = marked.withColumn("ends_sha256", F.coalesce("ends_sha256", none)).select(*_RESULT).unionByName(
        nodes.where("id is null").withColumn("ends_sha256", none).select(*_RESULT))
    if chains is None:
        return result
    one, end = F.lit(1).cast("long"), F.col("depth") == F.col("upto")
    single = chains.select(
        F.col("least").alias("conv_id"), "goes_on", "seg", F.size("keys").alias("upto"),
        F.explode(F.sequence(F.lit(1), F.size("keys"))).alias("depth"))
    closes = end & ~F.col("goes_on")
    return result.unionByName(single.select(
        "conv_id", (F.col("depth") + F.col("seg") * F.lit(segment)).cast("long").alias("depth"),
        F.col("conv_id").alias("parent_conv_id"), one.alias("n_convs"),
        F.when(closes, 0).otherwise(1).cast("long").alias("n_children"), one.alias("n_leaves"),
        F.lit(0).cast("long").alias("saved_tokens"),
        F.when(closes, F.sha2(F.col("conv_id").cast("string"), 256)).otherwise(none).alias("ends_sha256")))
