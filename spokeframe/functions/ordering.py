"""Numbers along an order of a whole table, without one task that sorts it.

Rows are dealt to partitions by range of the order and sorted there; a row's number is its place in its
partition plus the sizes of the partitions before. Rows that are equal in the order, were they a third
of the table, are dealt on over several partitions by where they stand, which no result can show if
the order names every column that matters.
"""

from pyspark.sql import Window
from pyspark.sql import functions as F

from spokeframe.session import through_table

# Bits that count rows inside a partition in what ``monotonically_increasing_id`` gives.
_PLACE_BITS = 33


def in_ranges(df, *order, partitions=None):
    """``df`` written sorted by ``order``, with columns ``_part`` and ``_place``, its place there.

    The table is written once, so the partitions are the same to all that read it.
    """
    keys = [F.col(c).asc_nulls_first() if isinstance(c, str) else c for c in order]
    spread = df.withColumn("_spread", F.monotonically_increasing_id())
    tasks = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = spread.repartitionByRange(tasks, *keys, "_spread").sortWithinPartitions(*keys, "_spread")
    # Named after the sort, by the task that has sorted the rows.
    number = F.monotonically_increasing_id()
    return through_table(dealt.withColumn("_number", number).select(
        *df.columns, F.shiftright("_number", _PLACE_BITS).alias("_part"),
        F.col("_number").bitwiseAND(F.lit((1 << _PLACE_BITS) - 1)).alias("_place")))


def _before(ranges, amount, name):
    """Per partition the sum over all partitions before it; the window has one row a partition."""
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    return ranges.groupBy("_part").agg(amount.alias("_sum")).select(
        "_part", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).cast("bigint").alias(name))


def numbered(df, name, *order, partitions=None):
    """Add ``name``: the row's number along ``order`` (nulls first), from 0."""
    ranges = in_ranges(df, *order, partitions=partitions)
    return ranges.join(_before(ranges, F.count("*"), "_rows"), "_part").select(
        *df.columns, (F.col("_rows") + F.col("_place")).alias(name))


def running_total(df, amount, name, *order, partitions=None):
    """Add ``name``: the sum of ``amount`` over the rows before this one along ``order``."""
    ranges = in_ranges(df, *order, partitions=partitions)
    earlier = Window.partitionBy("_part").orderBy("_place").rowsBetween(Window.unboundedPreceding, -1)
    within = F.coalesce(F.sum(amount).over(earlier), F.lit(0))
    return ranges.withColumn("_within", within).join(
        _before(ranges, F.sum(amount), "_sums"), "_part").select(
        *df.columns, (F.col("_sums") + F.col("_within")).cast("bigint").alias(name))
