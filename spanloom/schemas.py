"""Record layouts. Times are epoch longs: µs on raw spans, ms on everything derived, s on metrics."""

from __future__ import annotations

from pyspark.sql import types as T

TAG = T.StructType([
    T.StructField("key", T.StringType()),
    T.StructField("v_str", T.StringType()),
])

LOG = T.StructType([
    T.StructField("timestamp", T.LongType()),
    T.StructField("fields", T.ArrayType(TAG)),
])

TAGS = T.MapType(T.StringType(), T.StringType())

SPAN = T.StructType([
    T.StructField("trace_id", T.StringType()),
    T.StructField("span_id", T.StringType()),
    T.StructField("parent_span_id", T.StringType()),
    T.StructField("service_name", T.StringType()),
    T.StructField("operation_name", T.StringType()),
    T.StructField("start_us", T.LongType()),
    T.StructField("duration_us", T.LongType()),
    T.StructField("logs", T.ArrayType(LOG)),
    T.StructField("tags", T.ArrayType(TAG)),
    T.StructField("arrival_seq", T.LongType()),
])

LIGHT_SPAN = T.StructType([
    T.StructField("trace_id", T.StringType()),
    T.StructField("span_id", T.StringType()),
    T.StructField("parent_span_id", T.StringType()),
    T.StructField("time_ms", T.LongType()),
    T.StructField("service_name", T.StringType()),
    T.StructField("operation_name", T.StringType()),
    T.StructField("duration_us", T.LongType()),
    T.StructField("span_type", T.StringType()),
    T.StructField("tags", TAGS),
    T.StructField("arrival_seq", T.LongType()),
])

EDGE = T.StructType([
    T.StructField("pair_key", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("destination", T.StringType()),
    T.StructField("operation", T.StringType()),
    T.StructField("source_timestamp", T.LongType()),
    T.StructField("source_tags", TAGS),
    T.StructField("destination_tags", TAGS),
    T.StructField("emit_seq", T.LongType()),
])

LATENCY = T.StructType([
    T.StructField("pair_key", T.StringType()),
    T.StructField("metric", T.StringType()),
    T.StructField("type", T.StringType()),
    T.StructField("unit", T.StringType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("epoch_seconds", T.LongType()),
    T.StructField("tags", TAGS),
])

REGISTRY = T.StructType([
    T.StructField("service_name", T.StringType()),
    T.StructField("use_shared_span", T.BooleanType()),
    T.StructField("first_shared_seq", T.LongType()),
])

WINDOWED_EDGE = T.StructType([
    T.StructField("window_start", T.LongType()),
    T.StructField("window_end", T.LongType()),
    T.StructField("source", T.StringType()),
    T.StructField("destination", T.StringType()),
    T.StructField("operation", T.StringType()),
    T.StructField("count", T.LongType()),
    T.StructField("last_seen", T.LongType()),
    T.StructField("error_count", T.LongType()),
    T.StructField("source_tags", TAGS),
    T.StructField("destination_tags", TAGS),
])

# The graph document, field for field as it is exchanged between services (fixed values).
GRAPH_VERTEX = T.StructType([
    T.StructField("name", T.StringType()),
    T.StructField("tags", TAGS),
])
GRAPH_STATS = T.StructType([
    T.StructField("count", T.LongType()),
    T.StructField("lastSeen", T.LongType()),
    T.StructField("errorCount", T.LongType()),
])
GRAPH_EDGE = T.StructType([
    T.StructField("source", GRAPH_VERTEX),
    T.StructField("destination", GRAPH_VERTEX),
    T.StructField("stats", GRAPH_STATS),
    T.StructField("effectiveFrom", T.LongType()),
    T.StructField("effectiveTo", T.LongType()),
])
GRAPH_DOCUMENT = T.StructType([T.StructField("edges", T.ArrayType(GRAPH_EDGE))])

NODE = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("name", T.StringType()),
    T.StructField("provider", T.StringType()),
    T.StructField("tier", T.StringType()),
])

EDGE_FACT = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("sourceId", T.LongType()),
    T.StructField("destinationId", T.LongType()),
    T.StructField("statsCount", T.LongType()),
    T.StructField("statsLastSeen", T.LongType()),
    T.StructField("statsErrorCount", T.LongType()),
    T.StructField("effectiveFrom", T.LongType()),
    T.StructField("effectiveTo", T.LongType()),
])
