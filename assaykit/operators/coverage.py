"""Which key pairs occur in which tables, from one aggregation of all their keys.

Each pair gets one row with a bit per table. Coverage, missing pairs and the size of an inner join
of all tables follow from these rows without joining or shuffling the tables again.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from assaykit.schema import KEYS
from assaykit.sources.cohort import key_rows

TABLE = "__table"
WANTED = "wanted"
# Tables whose bits share a column.
WORD = 63


def numbered_keys(tables: Sequence[DataFrame]) -> DataFrame:
    """Complete key pairs of all tables with the number of their table."""
    tagged = [key_rows(df).dropna().withColumn(TABLE, F.lit(n)) for n, df in enumerate(tables)]
    return reduce(DataFrame.unionAll, tagged)


def key_matrix(cohort: DataFrame, keys: DataFrame, tables: int) -> DataFrame:
    """``uid, id, wanted, bits_0, bits_1, ...``: every complete pair once, whether it is a cohort
    pair, and a bit for each table that holds it.

    ``keys`` holds (uid, id, __table). Repeats are combined before the only shuffle.
    """
    marked = key_rows(cohort).dropna().withColumn(TABLE, F.lit(-1)).unionAll(keys.select(*KEYS, TABLE))
    number = F.col(TABLE)
    words = [
        F.bit_or(
            F.when(
                number.between(first, first + WORD - 1),
                F.call_function("shiftleft", F.lit(1).cast("bigint"), number - first),
            ).otherwise(F.lit(0).cast("bigint"))
        ).alias(f"bits_{first // WORD}")
        for first in range(0, max(tables, 1), WORD)
    ]
    return marked.groupBy(*KEYS).agg(F.bool_or(number < 0).alias(WANTED), *words)


def in_table(number: int) -> str:
    """SQL text: whether a row of the matrix is a pair of the table."""
    return f"(bits_{number // WORD} & {1 << number % WORD}L) <> 0"


def table_coverage(matrix: DataFrame, names: Sequence[str]) -> DataFrame:
    """``table, count``: cohort pairs that each table holds, by name."""
    counts = matrix.where(WANTED).agg(
        F.count("*").alias("pairs"), *[F.expr(f"count_if({in_table(n)})").alias(f"n_{n}") for n in range(len(names))])
    listed = ", ".join(f"n_{n}" for n in range(len(names)))
    spread = counts.select(F.posexplode(F.expr(f"cast(array({listed}) as array<bigint>)")).alias("n", "count"))
    named = F.element_at(F.lit(list(names) or [""]), F.col("n") + 1).alias("table")
    return spread.select(named, "count").orderBy("table")


def missing_pairs(matrix: DataFrame, number: int = 0) -> DataFrame:
    """Cohort pairs that the table lacks."""
    return matrix.where(f"{WANTED} and not ({in_table(number)})").select(*KEYS)


def inner_rows(tables: Sequence[DataFrame]) -> int:
    """Rows that an inner join of all tables on the key pair has, without joining them."""
    counts = numbered_keys(tables).groupBy(*KEYS).agg(
        *[F.count_if(F.col(TABLE) == n).alias(f"n_{n}") for n in range(len(tables))])
    rows = reduce(Column.__mul__, [F.col(f"n_{n}") for n in range(len(tables))])
    return counts.agg(F.coalesce(F.sum(rows), F.lit(0))).first()[0]
