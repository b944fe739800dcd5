"""Windowed edge statistics kept current from the edge stream, and the table that holds them.

Spark's own windowed aggregation holds the running values of each (window, edge) and of each of its tags,
and drops edges older than the retention. Every batch writes the rows it touched.

Layout of the table: ``window_date=…/version=N``. Rows are in long form: one with an empty ``side`` for the statistics of an edge and one per tag, each a whole
value, so that the row of the highest version is the current one. Every reader here goes by that rule. Versions of a day are merged from time to time, and days beyond
the retention are dropped; a reader finds the same values before, while and after.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from spanloom.functions import spans as fs
from spanloom.functions import times
from spanloom.operators.stats import EDGE_KEY, SIDES, fold_tags, labelled_tags
from spanloom.schemas import WINDOWED_EDGE
from spanloom.session import scratch_path
from spanloom.sources import files

WINDOW_SEC = 300
RETENTION = "7 days"
RETENTION_DAYS = 366
VERSIONS_PER_DAY = 16
AHEAD_MS = times.DAY_MS
_MARK = "_last_version"

DAY, VERSION = "window_date", "version"
STATISTICS = ("count", "last_seen", "error_count")
_ROW_KEY = ("window_start", "window_end", *EDGE_KEY, "side", "key")
STORED = T.StructType([
    *[f for f in WINDOWED_EDGE.fields if not f.name.endswith("_tags")],
    T.StructField("side", T.StringType()), T.StructField("key", T.StringType()), T.StructField("value", T.StringType()),
])


def _ahead(now_ms: Column) -> Column:
    return F.coalesce(F.col("source_timestamp") > now_ms + AHEAD_MS, F.lit(False))


def edges_ahead(edges: DataFrame, now_ms: Column | None = None) -> DataFrame:
    """Edges that claim to lie more than ``AHEAD_MS`` ahead of the clock, for a table of their own."""
    return edges.where(_ahead(F.unix_millis(F.current_timestamp()) if now_ms is None else now_ms))


def windowed_edges(
    edges: DataFrame, tag_keys: Sequence[str] = (), window_sec: int = WINDOW_SEC, retention: str = RETENTION,
    now_ms: Column | None = None,
) -> DataFrame:
    """Running statistics and latest tags per tumbling window and edge, in long form, for output mode ``update``.

    All tags but the error tag are kept, or those of ``tag_keys`` if given. Edges ahead of the clock are left out (``edges_ahead`` has them): a single one
    would move the watermark past all others.
    """
    timestamp = F.col("source_timestamp")
    now = F.unix_millis(F.current_timestamp()) if now_ms is None else now_ms
    edges = edges.where(~_ahead(now))
    failed = F.coalesce(F.try_element_at("source_tags", F.lit(fs.ERROR_TAG)) == "true", F.lit(False))
    running = (
        edges.withColumn("event_time", F.timestamp_millis(timestamp))
        .withColumn("_seen", F.when(timestamp == 0, now).otherwise(timestamp))
        .withColumn("_failed", failed.cast("long"))
        .withWatermark("event_time", retention)
        .withColumn("_tag", F.explode(labelled_tags(tag_keys)))
        .groupBy(F.window("event_time", f"{window_sec} seconds"), *EDGE_KEY, F.col("_tag.side").alias("side"), F.col("_tag.key").alias("key"))
        .agg(
            F.count(F.lit(1)).alias("count"),
            F.max("_seen").alias("last_seen"),
            F.sum("_failed").alias("error_count"),
            F.max(F.struct("emit_seq", "_tag.value"))["value"].alias("value"),
        )
    )
    return running.select(
        F.unix_millis(F.col("window.start")).alias("window_start"), F.unix_millis(F.col("window.end")).alias("window_end"),
        *STORED.fieldNames()[2:],
    )


def _stored(rows: DataFrame, version: int) -> DataFrame:
    return rows.select(*STORED.fieldNames()).withColumn(DAY, times.window_date(F.col("window_start"))).withColumn(VERSION, F.lit(version).cast("long"))


def _write(rows: DataFrame, table: str) -> None:
    """Replace exactly the (day, version) folders the rows belong to."""
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(DAY, VERSION).parquet(table)


def days(spark: SparkSession, table: str) -> list[str]:
    return files.partition_values(spark, table, DAY)


def _versions(spark: SparkSession, table: str, day: str) -> list[int]:
    return sorted(map(int, files.partition_values(spark, f"{table}/{DAY}={day}", VERSION)))


def _newest(rows: DataFrame) -> DataFrame:
    """Of each key its row of the highest version."""
    latest = F.max(F.struct(VERSION, *STATISTICS, "value")).alias("_latest")
    return rows.groupBy(DAY, *_ROW_KEY).agg(latest).select(DAY, *_ROW_KEY, "_latest.*")


def _all_rows(spark: SparkSession, table: str) -> DataFrame:
    stamped = T.StructType([*STORED.fields, T.StructField(DAY, T.StringType()), T.StructField(VERSION, T.LongType())])
    return spark.read.schema(stamped).parquet(table) if days(spark, table) else spark.createDataFrame([], stamped)


def _latest_rows(spark: SparkSession, table: str) -> DataFrame:
    """The current long-form rows; a filter on the day or the window reaches the files."""
    return _newest(_all_rows(spark, table)).drop(VERSION)


def read_windowed_edges(spark: SparkSession, table: str) -> DataFrame:
    """The current state of the table, streamed or stored: one row per window and edge, with the day column for pruning."""
    folded = fold_tags(_latest_rows(spark, table), [DAY, "window_start", "window_end", *EDGE_KEY], STATISTICS)
    return folded.select(*WINDOWED_EDGE.fieldNames(), DAY)


latest_windowed_edges = read_windowed_edges


def write_windowed_edges(windowed: DataFrame, table: str) -> None:
    """Store whole windows: each window in ``windowed`` replaces what the table holds of it; all others stay as they are."""
    spark = windowed.sparkSession
    unfolded = windowed.withColumn("_tag", F.explode(labelled_tags())).select("*", "_tag.*").drop("_tag")
    version = 1 + _last_version(spark, table)
    path = scratch_path(spark, "windows")
    _write(_stored(unfolded, version), path)
    touched = days(spark, path)
    new = (spark.read.schema(STORED).parquet(path) if touched else spark.createDataFrame([], STORED)).select(*STORED.fieldNames())
    held = _latest_rows(spark, table).where(F.col(DAY).isin(touched)) if touched else _latest_rows(spark, table).limit(0)
    others = held.join(new.select("window_start").distinct(), "window_start", "left_anti").select(*STORED.fieldNames())
    _write(_stored(new.unionByName(others), version), table)
    files.write_text(spark, f"{table}/{_MARK}", str(version))
    for day in touched:
        _drop_versions_before(spark, table, day, version)
    files.remove(spark, path)


def _drop_versions_before(spark: SparkSession, table: str, day: str, version: int) -> None:
    for old in _versions(spark, table, day):
        if old < version:
            files.drop_partition(spark, f"{table}/{DAY}={day}", VERSION, str(old))


def compact(
    spark: SparkSession, table: str, at_most: int = VERSIONS_PER_DAY, below: int | None = None, of_days: Sequence[str] | None = None,
) -> list[str]:
    """Merge versions of each day, or of those of ``of_days``, that has more than ``at_most``; returns the merged days.

    Only versions before ``below`` are merged, into the newest of them: the version of a batch that may be repeated holds what that batch
    wrote and nothing else. If not given, the table's newest version counts as such a batch's. A day keeps two versions then.

    Nothing is overwritten. Rows that the newest of the merged versions lacks are added to it, and then the older versions go; whoever reads meanwhile
    sees current values, and a merge that ends half-way leaves equal copies at most.
    """
    below = _last_version(spark, table) if below is None else below
    merged = []
    for day in days(spark, table) if of_days is None else of_days:
        versions = _versions(spark, table, day)
        before = [v for v in versions if v < below]
        if len(versions) > at_most and len(before) > 1:
            rows = _newest(_all_rows(spark, table).where((F.col(DAY) == day) & (F.col(VERSION) < below)))
            folder = files.partition_path(spark, f"{table}/{DAY}={day}", VERSION, str(before[-1]))
            rows.where(F.col(VERSION) < before[-1]).select(*STORED.fieldNames()).write.mode("append").parquet(folder)
            _drop_versions_before(spark, table, day, before[-1])
            merged.append(day)
    return merged


def drop_days_before(spark: SparkSession, table: str, day: str) -> list[str]:
    """Forget the days before ``day``; returns them."""
    gone = [d for d in days(spark, table) if d < day]
    for d in gone:
        files.drop_partition(spark, table, DAY, d)
    return gone


def _last_version(spark: SparkSession, table: str) -> int:
    """The greatest version that was written: noted in one small file, or else told by the folders. A batch that failed half-way may have left folders of one more."""
    noted = files.read_text(spark, f"{table}/{_MARK}")
    return int(noted) if noted is not None else max((v for day in days(spark, table) for v in _versions(spark, table, day)), default=-1)


def _clock_ms() -> int:
    return int(time.time() * 1000)


def batch_writer(
    table: str, versions_per_day: int = VERSIONS_PER_DAY, retention_days: int = RETENTION_DAYS, clock_ms: Callable[[], int] = _clock_ms,
) -> Callable[[DataFrame, int], None]:
    """What a stream does with each batch: write, merge the days it touched now and then, and forget days ``retention_days`` before the newest of them.

    A repeated batch is executed again and replaces its own version, which holds no other rows as only versions before it are merged. A batch older than what the table has can only come from a stream
    that began anew on an old table; it fails rather than lose rows.
    """
    def write(rows: DataFrame, batch_id: int) -> None:
        spark = rows.sparkSession
        last = _last_version(spark, table)
        if batch_id < last:
            raise ValueError(f"batch {batch_id} after batch {last} of {table}: a new checkpoint needs a new table")
        seen = Observation()
        _write(_stored(rows, batch_id).observe(seen, F.collect_set(DAY).alias("days")), table)
        files.write_text(spark, f"{table}/{_MARK}", str(batch_id))
        touched = sorted(seen.get.get("days") or [])
        compact(spark, table, versions_per_day, batch_id, touched)
        if touched:
            # No day of the future, whatever brought it here, makes days of the past too old.
            newest = min(touched[-1], times.date_of(clock_ms()))
            drop_days_before(spark, table, times.date_of(times.midnight_of(newest) - retention_days * times.DAY_MS))

    return write


def start_windowed_edges(
    edges: DataFrame, table: str, checkpoint: str, tag_keys: Sequence[str] = (), window_sec: int = WINDOW_SEC,
    retention: str = RETENTION, versions_per_day: int = VERSIONS_PER_DAY, retention_days: int = RETENTION_DAYS, **trigger,
) -> StreamingQuery:
    """Keep the windowed-edge table at ``table`` current."""
    return (
        windowed_edges(edges, tag_keys, window_sec, retention)
        .writeStream.outputMode("update").foreachBatch(batch_writer(table, versions_per_day, retention_days))
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "3 seconds"}))
        .start()
    )
