"""A set of hash buckets as one value: a bitmap of fixed size, sent to every task.

It answers "surely not" or "perhaps": what it lets through still has to be counted or compared,
so its size decides how much that is, and never a result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Of 2 to the power of these many buckets; the largest bitmap has 8 MB.
LEAST_BITS, MOST_BITS = 10, 26
WORD = 64


def bits_for(values: int, spare: int = 1) -> int:
    """Bits that give so many values 2 ** `spare` buckets each, within the bounds.

    With few full buckets, one value in about 2 ** (`spare` + 1) is let through by chance.
    """
    return max(LEAST_BITS, min(MOST_BITS, values.bit_length() + spare))


def bucket_of(bits: int, *columns: str | Column) -> Column:
    return F.pmod(F.xxhash64(*columns), F.lit(1 << bits))


def bitmap_of(buckets: DataFrame, bits: int) -> Column:
    """The buckets in the column `bucket` as one array of 64-bit words."""
    place = F.pmod("bucket", F.lit(WORD)).cast("int")
    held = buckets.groupBy(F.floor(F.col("bucket") / WORD).alias("word")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), place)).alias("bits")
    )
    return words_of(held, max(1, (1 << bits) // WORD))


def words_of(held: DataFrame, count: int) -> Column:
    """The words (word, bits) 0 to `count` - 1 as one array; those not held are zero."""
    every = held.sparkSession.range(count).withColumnRenamed("id", "word")
    word = F.struct("word", F.coalesce("bits", F.lit(0).cast("long")).alias("bits"))
    # One row of bounded size: all words, in order.
    whole = every.join(held, "word", "left").agg(F.array_sort(F.collect_list(word)).alias("words"))
    return whole.select(F.col("words.bits").alias("bitmap")).scalar()


def may_hold(bitmap: Column, bucket: Column) -> Column:
    word = F.get(bitmap, F.floor(bucket / WORD).cast("int"))
    return F.bit_get(word, F.pmod(bucket, F.lit(WORD)).cast("int")) == 1
