"""Edges over many snapshots as validity intervals: runs of snapshots in which an edge has the same values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from spanloom.operators.carry import BUCKET, carried

EDGE = ["source", "source_provider", "source_tier", "destination", "destination_provider", "destination_tier"]
VALUES = ["count", "last_seen", "error_count", "effective_from", "effective_to"]
_SPAN = 64  # snapshots to a bucket


def numbered(names: DataFrame) -> DataFrame:
    """Snapshot names (``snapshot_ts``) with their place ``n`` in time and the name after them; a row per snapshot, so one task does."""
    order = Window.orderBy("snapshot_ts")
    return names.select("snapshot_ts").distinct().select(
        "snapshot_ts", F.row_number().over(order).cast("long").alias("n"), F.lead("snapshot_ts").over(order).alias("next_ts")
    )


def validity_intervals(history: DataFrame, names: DataFrame, key: Sequence[str] = EDGE, values: Sequence[str] = VALUES) -> DataFrame:
    """One row per edge and run of equal values: ``valid_from`` (the run's first snapshot), ``valid_to`` (the first one after it, null if it reaches the last), ``snapshots``.

    ``history`` has a row per snapshot and edge, ``names`` the names of all snapshots, as one without edges ends runs too. An edge that every one of a
    year's snapshots holds is cut into buckets of snapshots like any other.
    """
    places = numbered(names)
    rows = history.join(places.select("snapshot_ts", "n"), "snapshot_ts").select(*key, "n", F.struct(*values).alias("_now"))
    rows = rows.withColumn(BUCKET, F.floor(F.col("n") / _SPAN))
    inside = Window.partitionBy(*key, BUCKET).orderBy("n")
    state = F.max(F.struct("n", "_now"))
    rows = carried(rows, key, state, "_carried")
    last = F.coalesce(state.over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.col("_carried"))
    goes_on = (last["n"] == F.col("n") - 1) & last["_now"].eqNullSafe(F.col("_now"))
    rows = rows.withColumn("_begins", F.when(~F.coalesce(goes_on, F.lit(False)), F.col("n")))
    rows = carried(rows, key, F.max("_begins"), "_began")
    run = F.coalesce(F.max("_begins").over(inside.rowsBetween(Window.unboundedPreceding, 0)), F.col("_began"))
    runs = rows.withColumn("_run", run).groupBy(*key, "_run").agg(F.max("n").alias("_last"), F.count(F.lit(1)).alias("snapshots"), F.first("_now").alias("_now"))
    begun = places.select(F.col("n").alias("_run"), F.col("snapshot_ts").alias("valid_from"))
    ended = places.select(F.col("n").alias("_last"), F.col("next_ts").alias("valid_to"))
    return runs.join(begun, "_run").join(ended, "_last").select(*key, "_now.*", "valid_from", "valid_to", "snapshots")


def valid_at(intervals: DataFrame, instants: DataFrame, names: DataFrame) -> DataFrame:
    """For each ``snapshot_ts`` of ``instants`` (names of snapshots) the edges valid then. Both sides meet on buckets of snapshots, so no interval is compared with an instant far from it."""
    places = numbered(names)
    asked = instants.select("snapshot_ts").distinct().join(places.drop("next_ts"), "snapshot_ts").withColumn(BUCKET, F.floor(F.col("n") / _SPAN))
    begun = places.select(F.col("snapshot_ts").alias("valid_from"), F.col("n").alias("_first"))
    held = intervals.join(begun, "valid_from").withColumn("_last", F.col("_first") + F.col("snapshots") - 1)
    held = held.withColumn(BUCKET, F.explode(F.sequence(F.floor(F.col("_first") / _SPAN), F.floor(F.col("_last") / _SPAN))))
    met = held.join(asked, BUCKET).where(F.col("n").between(F.col("_first"), F.col("_last")))
    return met.select("snapshot_ts", *intervals.columns)
