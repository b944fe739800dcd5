"""From raw spans to the narrow, distinct spans that pairing works on."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from spanloom.functions import spans as fs

TRACE_SCOPE = ("trace_id",)
IDENTITY = ("span_id", "parent_span_id", "service_name")


def accumulable_filter(spans: DataFrame) -> DataFrame:
    return spans.filter(
        fs.is_accumulable(F.col("span_id"), F.col("service_name"), F.col("operation_name"), F.col("start_us"))
    )


def light_spans(spans: DataFrame, tag_keys: Sequence[str] = ()) -> DataFrame:
    """Accumulable spans cut down to what later steps read.

    ``arrival_seq`` is the ingest position; a source without one falls back to
    the start time. Everything is decided here, before any shuffle, so logs and
    uncollected tags never travel.
    """
    arrival = F.col("arrival_seq") if "arrival_seq" in spans.columns else F.col("start_us")
    trace = F.col("trace_id") if "trace_id" in spans.columns else F.lit("")
    return accumulable_filter(spans).select(
        trace.alias("trace_id"),
        "span_id",
        F.coalesce("parent_span_id", F.lit("")).alias("parent_span_id"),
        fs.integer_div(F.col("start_us"), 1000).alias("time_ms"),
        "service_name",
        "operation_name",
        "duration_us",
        fs.span_type(F.col("logs"), F.col("tags")).alias("span_type"),
        fs.collect_tags(F.col("tags"), tag_keys).alias("tags"),
        arrival.alias("arrival_seq"),
    )


def dedupe_spans(
    spans: DataFrame, scope: Sequence[str] = TRACE_SCOPE, arrival: Sequence[str] = ("arrival_seq",)
) -> DataFrame:
    """First arrival of each (span id, parent span id, service).

    The aggregate combines on the map side, so a span re-delivered any number of
    times travels once per task. Carrying the rest of the span as one value also
    makes every later use of the result ask for the same shuffle, which Spark
    then runs once: pairing reads its spans several times but scans them once.
    """
    identity = [*scope, *IDENTITY]
    rest = [c for c in spans.columns if c not in identity]
    order = F.struct(*arrival, *[c for c in ("time_ms", "duration_us", "operation_name", "span_type") if c in rest])
    # Keys that cannot be null keep the optimizer from adding a different filter for each use.
    keyed = spans.withColumns({c: F.coalesce(c, F.lit("")) for c in identity})
    first = keyed.groupBy(*identity).agg(F.min_by(F.struct(*rest), order).alias("_first"))
    return first.select(*[F.col(c) if c in identity else F.col("_first")[c].alias(c) for c in spans.columns])


def dedupe_spans_stream(spans: DataFrame, delay: str, scope: Sequence[str] = TRACE_SCOPE) -> DataFrame:
    """The same set semantics on a stream, remembered for ``delay`` of event time."""
    stamped = spans.withColumn("event_time", F.timestamp_millis("time_ms"))
    return (
        stamped.withWatermark("event_time", delay)
        .dropDuplicatesWithinWatermark([*scope, *IDENTITY])
        .drop("event_time")
    )
