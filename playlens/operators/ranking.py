"""Ranking without single-task windows.

``row_number() OVER (PARTITION BY kind ORDER BY views DESC)`` puts every
title of a kind into one task.  :func:`ordered_position` computes the same
numbers the way a distributed sort does: range-partition and sort by
``(group, order)``, materialise that once (a reliable checkpoint, so the
range bounds cannot change between the two passes), count rows per
``(partition, group)``, prefix-sum those small counts, and add each row's
offset inside its partition.  The prefix sum runs over at most one row per
range partition for each group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from playlens import params
from playlens.operators.barrier import materialize
from playlens.operators.textjoin import row_count_at_most


def ordered_position(df: DataFrame, partition_by: list[str], order_by: list[Column],
                     name: str = "rank") -> DataFrame:
    """Add ``name`` = 1-based position of each row within its group, in ``order_by`` order."""
    keys = [F.col(c).asc_nulls_first() for c in partition_by] + list(order_by)
    ordered = materialize(
        df.repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .withColumn("_pid", F.spark_partition_id())
        .withColumn("_mid", F.monotonically_increasing_id())
    )
    counts = ordered.groupBy("_pid", *partition_by).agg(
        F.count(F.lit(1)).alias("_n"), F.min("_mid").alias("_first"))
    before = Window.partitionBy(*partition_by).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        "_pid", *partition_by, "_first",
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"),
    )
    # One row per (range partition, group): broadcast it when its size checks out.
    if row_count_at_most(offsets, params.BROADCAST_ROW_LIMIT):
        offsets = F.broadcast(offsets)
    return ordered.join(offsets, ["_pid", *partition_by], "inner").select(
        *df.columns,
        (F.col("_before") + (F.col("_mid") - F.col("_first")) + 1).cast("int").alias(name),
    )
