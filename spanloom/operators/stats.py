"""Edge statistics per window and their merges.

Tags make these aggregations awkward: maps cannot be grouped, and they must not
be gathered per group. Every function here therefore works in steps that all
combine on the map side first:

1. collapse rows that agree on key *and* tags (plain hash aggregation on
   numbers; tag sets are few, so a hot edge shrinks to a handful of rows),
2. unfold the tags of what is left and reduce each key on its own,
3. fold the reduced tags back into one map per edge.

The statistics ride through step 2 as one extra row with an empty side, which
saves joining them back.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from spanloom.functions import spans as fs
from spanloom.functions import times

EDGE_KEY = ("source", "destination", "operation")
SIDES = ("source", "destination")
_NO_TAGS = "array<struct<key:string,value:string>>"
_ENTRY = "array<struct<side:string,key:string,value:string>>"


def _tag_entries(tags: Column) -> Column:
    """A tag map as an array, fit for grouping.

    Equal maps in another order would only be collapsed less, so no sorting here.
    """
    return F.coalesce(F.map_entries(tags), F.array().cast(_NO_TAGS))


def _labelled(entries: Column, side: str) -> Column:
    return F.transform(entries, lambda e: F.struct(F.lit(side).alias("side"), e["key"].alias("key"), e["value"].alias("value")))


def labelled_tags(keys: Sequence[str] = ()) -> Column:
    """The tags of both sides of an edge but the error tag, or those of ``keys``, plus an entry with an empty side for the statistics."""
    def side(name: str) -> Column:
        kept = F.filter(_tag_entries(F.col(f"{name}_tags")), lambda e: e["key"].isin(*keys) if keys else e["key"] != fs.ERROR_TAG)
        return _labelled(kept, name)

    statistics = F.array(F.struct(F.lit("").alias("side"), F.lit("").alias("key"), F.lit(None).cast("string").alias("value")))
    return F.concat(statistics, *(side(name) for name in SIDES)).cast(_ENTRY)


def _unfold(rows: DataFrame, by_side: dict[str, Column]) -> DataFrame:
    """One row per tag but the error tag, plus one, with an empty side, for the statistics."""
    statistics = F.array(F.struct(F.lit("").alias("side"), F.lit("").alias("key"), F.lit(None).cast("string").alias("value")))
    tags = [_labelled(entries, side) for side, entries in by_side.items()]
    unfolded = rows.withColumn("_tag", F.explode(F.concat(statistics, *tags).cast(_ENTRY)))
    return unfolded.select("*", "_tag.side", "_tag.key", "_tag.value").drop("_tag").filter(F.col("key") != fs.ERROR_TAG)


def fold_tags(reduced: DataFrame, keys: Sequence[str], statistics: Sequence[str]) -> DataFrame:
    """Back to one row per key: statistics and one tag map per side."""
    def folded(side: str) -> Column:
        tag = F.when(F.col("side") == side, F.struct("key", "value"))
        return F.map_from_entries(F.sort_array(F.collect_list(tag))).alias(f"{side}_tags")

    return reduced.groupBy(*keys).agg(
        *[F.max(F.when(F.col("side") == "", F.col(c))).alias(c) for c in statistics],
        *[folded(side) for side in SIDES],
    )


def _windowed(edges: DataFrame, window_ms: int, now_ms: int) -> DataFrame:
    """Step 1 of ``edge_stats``."""
    timestamp = F.col("source_timestamp")
    failed = F.coalesce(F.try_element_at("source_tags", F.lit(fs.ERROR_TAG)) == "true", F.lit(False))
    arrival = F.col("emit_seq") if "emit_seq" in edges.columns else timestamp
    return (
        edges.select(
            times.window_start(timestamp, window_ms).alias("window_start"),
            *EDGE_KEY,
            _tag_entries(F.col("source_tags")).alias("_source"),
            _tag_entries(F.col("destination_tags")).alias("_destination"),
            F.when(timestamp == 0, F.lit(now_ms)).otherwise(timestamp).alias("_seen"),
            failed.cast("long").alias("_failed"),
            arrival.alias("_arrival"),
        )
        .groupBy("window_start", *EDGE_KEY, "_source", "_destination")
        .agg(
            F.count(F.lit(1)).alias("count"),
            F.max("_seen").alias("last_seen"),
            F.sum("_failed").alias("error_count"),
            F.max("_arrival").alias("_arrival"),
        )
    )


def _windowed_tags(collapsed: DataFrame) -> DataFrame:
    """Step 2 of ``edge_stats``: the latest value of each tag, ties to the greater value."""
    unfolded = _unfold(collapsed, {"source": F.col("_source"), "destination": F.col("_destination")})
    return unfolded.groupBy("window_start", *EDGE_KEY, "side", "key").agg(
        F.sum("count").alias("count"),
        F.max("last_seen").alias("last_seen"),
        F.sum("error_count").alias("error_count"),
        F.max(F.struct("_arrival", "value"))["value"].alias("value"),
    )


def edge_stats(edges: DataFrame, window_ms: int, now_ms: int) -> DataFrame:
    """Windowed edges: count, last seen, errors and latest tags per (window, source, destination, operation).

    An edge without a timestamp counts as seen at ``now_ms``. Errors are those
    flagged by the caller; the error tag itself is not kept.
    """
    tags = _windowed_tags(_windowed(edges, window_ms, now_ms))
    folded = fold_tags(tags, ["window_start", *EDGE_KEY], ["count", "last_seen", "error_count"])
    return folded.select(
        "window_start",
        (F.col("window_start") + window_ms).alias("window_end"),
        *EDGE_KEY, "count", "last_seen", "error_count", "source_tags", "destination_tags",
    )


def edge_tags_last(edges: DataFrame, window_ms: int) -> DataFrame:
    """The latest value of each tag per windowed edge, one row per side and key."""
    tags = _windowed_tags(_windowed(edges, window_ms, 0))
    return tags.filter(F.col("side") != "").select("window_start", *EDGE_KEY, "side", "key", "value")


def tag_values(value: Column) -> Column:
    """The comma-separated parts of a tag value; empty parts at the end do not count."""
    trimmed = F.split(F.regexp_replace(value, ",+$", ""), ",", -1)
    return F.when(value.rlike("^,+$"), F.array().cast("array<string>")).otherwise(trimmed)


def _totals() -> list[Column]:
    return [
        F.sum("count").alias("count"),
        F.max("last_seen").alias("last_seen"),
        F.sum("error_count").alias("error_count"),
        F.min("effective_from").alias("effective_from"),
        F.max("effective_to").alias("effective_to"),
    ]


def merge_parts(edges: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Step 1 of a merge: a row per (keys, side, tag, tag value); the rows of side ``''`` hold the statistics. Parts of any two sets of edges add up (``add_parts``)."""
    collapsed = (
        edges.withColumn("_source", _tag_entries(F.col("source_tags")))
        .withColumn("_destination", _tag_entries(F.col("destination_tags")))
        .groupBy(*keys, "_source", "_destination")
        .agg(*_totals())
    )
    unfolded = _unfold(collapsed, {"source": F.col("_source"), "destination": F.col("_destination")})
    return add_parts(unfolded.withColumn("value", F.explode_outer(tag_values(F.col("value")))), keys)


def add_parts(parts: DataFrame, keys: Sequence[str]) -> DataFrame:
    return parts.groupBy(*keys, "side", "key", "value").agg(*_totals())


def _union_tags(parts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Step 2 of a merge: one row per (keys, side, tag) with the union of its values."""
    union = F.array_join(F.sort_array(F.collect_list("value")), ",").alias("value")
    return parts.groupBy(*keys, "side", "key").agg(*_totals(), union)


def join_parts(parts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Merged edges from their parts."""
    return fold_tags(_union_tags(parts, keys), keys, ["count", "last_seen", "error_count", "effective_from", "effective_to"])


def _merge(edges: DataFrame, keys: Sequence[str]) -> DataFrame:
    return join_parts(merge_parts(edges, keys), keys)


def service_graph_merge(edges: DataFrame) -> DataFrame:
    """Merge edges over windows and operations into one per (source, destination)."""
    return _merge(edges, ["source", "destination"])


def operation_graph_merge(edges: DataFrame) -> DataFrame:
    """Merge edges over windows into one per (source, destination, operation), tags kept."""
    return _merge(edges, EDGE_KEY)


def tag_union(edges: DataFrame) -> DataFrame:
    """The union of tag values per (source, destination), one row per side and key, values sorted."""
    tags = _union_tags(merge_parts(edges, ["source", "destination"]), ["source", "destination"])
    return tags.filter(F.col("side") != "").select("source", "destination", "side", "key", "value")


def tag_union_values(edges: DataFrame) -> DataFrame:
    """The union of tag values per (source, destination) with a row per value, whatever their number.

    Nothing is gathered: a tag with as many values as there are edges stays spread over all tasks. A tag without any
    part, such as an empty or comma-only value, is a row with a null ``value``.
    """
    tags = edges.select("source", "destination", F.explode(labelled_tags()).alias("_tag")).select("source", "destination", "_tag.*").filter("side <> ''")
    return tags.distinct().withColumn("value", F.explode_outer(tag_values(F.col("value")))).distinct()
