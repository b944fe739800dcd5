"""Dense 1..n numbers in a given order, without sorting everything in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from spanloom.session import shared_dir

_POSITION_BITS = 33  # monotonically_increasing_id keeps the partition above this bit


def dense_number(rows: DataFrame, order: Sequence[str], name: str) -> DataFrame:
    """Add ``name``: 1..n in the order of the given columns, which must be unique together.

    Calling this runs ``rows`` once, as the sorted rows are checkpointed; Spark removes the files with the frame
    if ``spark.cleaner.referenceTracking.cleanCheckpoints`` is set.

    Range partitions are sorted in parallel; a partition's numbers start after
    the rows of the partitions before it. The sorted rows are checkpointed first
    so that both uses see the same partitions. What is broadcast has one row per
    partition.
    """
    shared_dir(rows.sparkSession)
    placed = (
        rows.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_at", F.monotonically_increasing_id())
        .checkpoint()
        .withColumn("_part", F.shiftrightunsigned("_at", _POSITION_BITS))
    )
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_rows"))
        .select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    )
    index = F.col("_at").bitwiseAND(F.lit((1 << _POSITION_BITS) - 1))
    return (
        placed.join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_offset") + index + 1)
        .drop("_part", "_at", "_offset")
    )
