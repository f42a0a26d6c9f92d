"""Exact top-k inner products by the threshold algorithm over sorted per-dimension lists.

Candidates are dealt into blocks. A block sorts each dimension once; every query walks the lists
from the end that its sign prefers, scores the vectors it meets, and stops when the bound, the
inner product of the query with the values at its depth, cannot beat its kth score.
The blocks' answers are merged. Queries come in batches of a checked size.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.window import Window

K = 10
SCALE = 1024
#: Candidates in a block, and queries that go to the tasks at a time.
BLOCK_ROWS = 16_384
QUERY_BATCH = 20_000
#: List entries that a query reads in each dimension before it first looks at the bound; each
#: next time it reads twice as many.
STEP = 64

_HITS = "query_id long, vec_id long, score long"


def scaled(column: str, scale: int):
    """floor(scale * x) of every component, as long; null unless all are finite numbers."""
    x = F.col(column).cast("array<double>")
    sound = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return F.when(sound & (F.size(x) > 0), F.transform(x, lambda v: F.floor(v * scale).cast("long")))


def as_matrix(column: pa.Array, width: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy().reshape(-1, width)


def threshold_search(query: np.ndarray, vectors: np.ndarray, ids: np.ndarray, lists: np.ndarray,
                     k: int, own: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and scores of the k best vectors of a block, ties to the smaller id.

    `lists` holds, per dimension, the rows in ascending order of that component. A list is read
    from its greatest value for a positive weight, from its least for a negative one; a weight
    of 0 adds nothing to the bound and its list is not read.
    """
    n = len(vectors)
    used = np.flatnonzero(query)
    weights = query[used]
    met = np.zeros(n, bool)
    best_ids, best = np.zeros(0, np.int64), np.zeros(0, np.int64)
    depth, step = 0, STEP
    while depth < n:
        upto = min(n, depth + step)
        ranks = np.arange(depth, upto)
        fresh = np.zeros(n, bool)
        if len(used):
            fresh[np.where(weights[:, None] > 0, lists[used[:, None], n - 1 - ranks],
                           lists[used[:, None], ranks])] = True
        else:
            fresh[ranks] = True
        fresh &= ~met
        met |= fresh
        rows = np.flatnonzero(fresh)
        rows = rows[ids[rows] != own]
        scores = (vectors[rows] @ query).astype(np.int64)
        if len(best) == k:
            rows, scores = rows[scores >= best[-1]], scores[scores >= best[-1]]
        best_ids = np.concatenate([best_ids, ids[rows]])
        best = np.concatenate([best, scores])
        order = np.lexsort((best_ids, -best))[:k]
        best_ids, best = best_ids[order], best[order]
        depth, step = upto, step * 2
        if met.all():
            break
        if len(used) and len(best) == k and depth < n:
            edge = np.where(weights > 0, lists[used, n - depth], lists[used, depth - 1])
            if int(weights @ vectors[edge, used]) < best[-1]:
                break
    return best_ids, best


def exact_floats(vectors: np.ndarray, queries: list) -> bool:
    """Whether all inner products, and their partial sums, are whole numbers that doubles hold."""
    top = max((int(np.abs(q).max()) for _, q in queries), default=0)
    return top * int(np.abs(vectors).max(initial=0)) * vectors.shape[1] < 1 << 53


def search_block(group: pa.Table, queries: dict, k: int) -> pa.Table:
    """The best of a block for every query of the same width, with ties to the smaller id."""
    width = int(group["width"][0].as_py())
    vectors = as_matrix(group["vector"], width)
    ids = group["vec_id"].to_numpy()
    lists = np.argsort(vectors, axis=0, kind="stable").T.copy()
    asked = queries.get(width, [])
    kind = np.float64 if exact_floats(vectors, asked) else np.int64
    vectors = vectors.astype(kind)
    found = []
    for name, query in asked:
        near, scores = threshold_search(query.astype(kind), vectors, ids, lists, k, name)
        found.append((np.full(len(near), name), near, scores))
    parts = [np.concatenate(x) for x in zip(*found)] if found else [np.zeros(0, np.int64)] * 3
    return pa.table(dict(zip(("query_id", "vec_id", "score"), parts)))


def block_search(queries, k: int):
    """The search of a block, for queries that were broadcast."""
    return lambda group: search_block(group, queries.value, k)


def top_k(
    vectors: DataFrame, queries: F.Column, k: int = K, scale: int = SCALE, id_col: str = "vec_id",
    vector_col: str = "embedding", block_rows: int = BLOCK_ROWS, query_batch: int = QUERY_BATCH,
) -> DataFrame:
    """For each row picked by the condition `queries`: query_id, rank, vec_id, score of the k rows
    with the greatest inner products of floor(scale * x), ties to the smaller id.

    A row is never its own answer. Rows with a null id, and vectors that are null, empty, or hold null
    or non-finite components, take no part; vectors answer only queries of their own width.
    Repeated rows with one id and vector count once; different vectors of one id each count, and
    none of them answers a query of that id. Fewer candidates give fewer rows; an empty
    table gives none.
    """
    spark = vectors.sparkSession
    sound = (
        vectors.select(F.col(id_col).cast("long").alias("vec_id"), queries.alias("asks"),
                       scaled(vector_col, scale).alias("vector"))
        .where("vec_id is not null and vector is not null")
        .withColumn("width", F.size("vector"))
    )
    rows = sound.select("vec_id", "vector", "width").dropDuplicates()
    total = max(1, sound.count())
    blocks = rows.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(-(-total // block_rows))))
    asked = sound.where("asks").select("vec_id", "vector", "width").dropDuplicates()
    batches = -(-asked.count() // query_batch)
    hits = spark.createDataFrame([], _HITS)
    for i in range(batches):
        own = asked.where(F.pmod(F.xxhash64("vec_id"), F.lit(batches)) == i).toArrow()
        by_width: dict[int, list] = {}
        for name, vector, width in zip(*(own[c].to_pylist() for c in ("vec_id", "vector", "width"))):
            by_width.setdefault(width, []).append((name, np.array(vector, np.int64)))
        search = block_search(spark.sparkContext.broadcast(by_width), k)
        hits = hits.unionByName(blocks.groupBy("block", "width").applyInArrow(search, _HITS))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
