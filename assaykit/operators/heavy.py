"""Key pairs that hold so many rows that a join must deal them over several tasks."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from assaykit.schema import KEYS
from assaykit.sizing import ROW_OVERHEAD
from assaykit.sources.cohort import key_rows

# Rows of a pair above which it is dealt, and rows that one task then gets of it.
HEAVY_ROWS = 1_000_000
# Pairs that a summary keeps of each table, and those that it reports at most.
TRACKED = 65_536
REPORTED = 1_000
# Tasks over which one pair is dealt at most.
MOST_PARTS = 1_000
SALT = "__salt"


@dataclass(frozen=True)
class Measured:
    """What one pass over all tables tells: each one's rows and key bytes, and its heavy pairs as
    {hash of the pair: about how many rows}."""

    rows: list[int]
    key_bytes: list[int]
    heavy: list[dict[int, int]]

    def dealt(self, least: int) -> dict[int, tuple[int, int]]:
        """{hash: (number of the table whose rows are dealt, parts)}; in other tables the pair's
        rows are repeated for every part. The table with the most rows of a pair is dealt."""
        found: dict[int, tuple[int, int]] = {}
        for table, pairs in enumerate(self.heavy):
            for pair, rows in pairs.items():
                found[pair] = max(found.get(pair, (0, 0)), (rows, -table))
        return {
            pair: (-table, min(MOST_PARTS, -(-rows // least))) for pair, (rows, table) in found.items()
        }


def pair_hash(columns: Sequence[Column]) -> Column:
    return F.xxhash64(*columns)


def measure(tables: Sequence[DataFrame], least: int = HEAVY_ROWS) -> Measured:
    """Rows, key bytes and heavy pairs of any number of tables, in one job.

    Tasks keep frequent-items summaries, which merge; one row a table reaches the driver. A summary
    may miss pairs below a 1/20,000th of a table's rows, which no task notices. Two pairs
    with one hash are dealt together, which is as right as apart.
    """
    size = reduce(Column.__add__, [F.coalesce(F.octet_length(name), F.lit(0)) for name in KEYS])
    tagged = [
        key_rows(df).select(F.lit(number).alias("table"), pair_hash([F.col(k) for k in KEYS]).alias("pair"),
                            (size + ROW_OVERHEAD).alias("size"))
        for number, df in enumerate(tables)
    ]
    facts = reduce(DataFrame.unionAll, tagged).groupBy("table").agg(
        F.count("*").alias("rows"), F.sum("size").alias("key_bytes"),
        F.expr(f"approx_top_k(pair, {REPORTED}, {TRACKED})").alias("top"),
    ).select("table", "rows", "key_bytes", F.filter("top", lambda t: t["count"] > least).alias("top"))
    rows, key_bytes, heavy = [0] * len(tables), [0] * len(tables), [{} for _ in tables]
    for fact in facts.collect():
        rows[fact["table"]], key_bytes[fact["table"]] = fact["rows"], fact["key_bytes"]
        heavy[fact["table"]] = {t["item"]: t["count"] for t in fact["top"]}
    return Measured(rows, key_bytes, heavy)


def without(df: DataFrame, pairs: Sequence[int]) -> DataFrame:
    """Rows of other pairs; those with a null key stay."""
    return df.where(~pair_hash([F.col(k) for k in KEYS]).isin(list(pairs))) if pairs else df


def salted(df: DataFrame, table: int, dealt: dict[int, tuple[int, int]]) -> DataFrame:
    """Rows of the heavy pairs with a part: one by turns where this table is dealt, else all."""
    hashed = pair_hash([F.col(k) for k in KEYS])
    own = df.where(hashed.isin(list(dealt)))
    parts = F.create_map(*[F.lit(x) for pair, (_, n) in dealt.items() for x in (pair, n)])[hashed]
    mine = [pair for pair, (chosen, _) in dealt.items() if chosen == table]
    turn = F.pmod(F.monotonically_increasing_id(), parts).cast("int")
    repeated = own.where(~hashed.isin(mine)) if mine else own
    repeated = repeated.withColumn(SALT, F.explode(F.sequence(F.lit(0), parts - 1)))
    if not mine:
        return repeated
    return own.where(hashed.isin(mine)).withColumn(SALT, turn).unionByName(repeated)
