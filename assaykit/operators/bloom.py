"""A Bloom filter of key pairs, built and applied with column expressions.

Each key sets four bits of one 64-bit word. The words lie in pages, all pages in one row, which is
a scalar subquery of the filtered scan: rows that cannot match are dropped where they are read,
before any shuffle. It only thins rows out; the exact join follows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# Bits a key, words a page, and words at most (64 MiB); beyond, more rows pass.
KEY_BITS = 16
PAGE_WORDS = 4096
MOST_WORDS = 8 << 20


def word_count(keys: int) -> int:
    """Whole pages for so many distinct keys."""
    words = min(MOST_WORDS, -(-keys * KEY_BITS // 64))
    return max(1, -(-words // PAGE_WORDS)) * PAGE_WORDS


def word_of(keys: list[Column], words: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(words))


def bits_of(keys: list[Column]) -> Column:
    """Four bits of a word, from a second hash."""
    hashed = F.xxhash64(F.lit(1), *keys)
    mask = F.lit(0).cast("bigint")
    for k in range(4):
        place = F.shiftright(hashed, 6 * k).bitwiseAND(63).cast("int")
        mask = mask.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("bigint"), place))
    return mask


def bloom_pages(pairs: DataFrame, keys: int) -> DataFrame:
    """One row, one column: the pages of words of all given pairs (two columns, no nulls).

    Words are combined before the shuffle and pages built apart; one row of at most 64 MiB remains.
    """
    words = word_count(keys)
    columns = [F.col(name) for name in pairs.columns]
    empty = pairs.sparkSession.range(words).select(F.col("id").alias("word"), F.lit(0).cast("bigint").alias("bits"))
    filled = pairs.select(word_of(columns, words).alias("word"), bits_of(columns).alias("bits")).unionAll(empty)
    merged = filled.groupBy("word").agg(F.bit_or("bits").alias("bits"))
    page, slot = F.floor(F.col("word") / PAGE_WORDS).alias("page"), (F.col("word") % PAGE_WORDS).alias("slot")
    listed = merged.groupBy(page).agg(F.sort_array(F.collect_list(F.struct(slot, "bits"))).alias("slots"))
    pages = listed.select("page", F.col("slots.bits").alias("words"))
    return pages.agg(F.sort_array(F.collect_list(F.struct("page", "words"))).alias("all")).select(
        F.col("all.words").alias("pages"))


def may_hold(pages: Column, keys: list[Column], words: int) -> Column:
    """False only for keys that are not in the filter; null for a null key."""
    word, bits = word_of(keys, words), bits_of(keys)
    page = F.element_at(pages, (F.floor(word / PAGE_WORDS) + 1).cast("int"))
    held = F.element_at(page, (word % PAGE_WORDS + 1).cast("int"))
    return held.bitwiseAND(bits) == bits


def thinned(df: DataFrame, columns: list[Column], pairs: DataFrame, keys: int) -> DataFrame:
    """The rows whose key may be among the pairs, filtered where they are read."""
    pages = bloom_pages(pairs, keys).scalar()
    return df.where(may_hold(pages, columns, word_count(keys)))
