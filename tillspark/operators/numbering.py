"""Row numbers and running sums over a whole table, without one-task windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from tillspark.sources.staging import stage

# Of Spark's row ids, the lower bits that hold the place in the partition.
PLACE_BITS = 33


def running_before(df: DataFrame, order: list[Column], weight: Column, out: str) -> DataFrame:
    """Add `out`: the sum of `weight` over all rows ordered before this one.

    Rows are range-partitioned on `order`, which must be unique per row so that
    ties cannot pile up in one slice. Each slice sums its own rows; the slice
    totals (one row per shuffle partition) give every slice its starting value.
    The sliced table is staged because a range partitioning is sampled: reading
    it twice from the plan could cut it at different places.
    """
    slices = stage(
        df.repartitionByRange(*order).withColumn("_slice", F.spark_partition_id()), "sliced"
    )
    totals = slices.groupBy("_slice").agg(F.sum(weight).alias("_total"))
    earlier_slices = W.orderBy("_slice").rowsBetween(W.unboundedPreceding, -1)
    starts = totals.select(
        "_slice", F.coalesce(F.sum("_total").over(earlier_slices), F.lit(0)).alias("_start")
    )
    earlier_rows = (
        W.partitionBy("_slice").orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    )
    inside = F.coalesce(F.sum(weight).over(earlier_rows), F.lit(0))
    # One row per slice: bounded by the number of shuffle partitions.
    return (
        slices.join(F.broadcast(starts), "_slice")
        .withColumn(out, F.col("_start") + inside)
        .drop("_slice", "_start")
    )


def number_rows(df: DataFrame, order: list[Column], out: str) -> DataFrame:
    """Add `out`: 1..n in the given order, as a long, first column.

    Rows are range-partitioned, sorted and written once. Spark's row ids hold the slice and
    the place in it, so a number is that place after the rows of the slices before: one short
    table of slices, counted from the ids alone. No row is shuffled a second time.
    """
    placed = df.repartitionByRange(*order).sortWithinPartitions(*order)
    slices = stage(placed.withColumn("_id", F.monotonically_increasing_id()), "numbered")
    slice_ = F.shiftright("_id", PLACE_BITS)
    counts = dict(slices.groupBy(slice_.alias("s")).count().collect())
    starts, before = [], 0
    for at in sorted(counts):
        starts.append((at, before))
        before += counts[at]
    # One row per shuffle partition.
    table = df.sparkSession.createDataFrame(starts, "_slice long, _start long")
    place = F.col("_id").bitwiseAND(F.lit((1 << PLACE_BITS) - 1))
    met = slices.withColumn("_slice", slice_).join(F.broadcast(table), "_slice")
    return met.select((F.col("_start") + place + 1).alias(out), *df.columns)


def value_ranks(df: DataFrame, value: str) -> DataFrame:
    """One row per distinct non-null `value`: how many rows hold it, how many hold less.

    Ranks of any flavour follow from these two counts, and no group of equal
    values is ever gathered: they are counted before they move.
    """
    counts = df.where(F.col(value).isNotNull()).groupBy(value).agg(F.count(F.lit(1)).alias("peers"))
    return running_before(counts, [F.col(value)], F.col("peers"), "below")
