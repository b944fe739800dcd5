"""What an accepted pair stands for: a call edge and a latency point."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from spanloom.functions import spans as fs


def graph_edges(pairs: DataFrame) -> DataFrame:
    """``caller --operation--> callee`` at the client's start time; the operation is the client's."""
    return pairs.select(
        F.col("client_span_id").alias("pair_key"),
        F.col("client_service").alias("source"),
        F.col("server_service").alias("destination"),
        F.col("client_operation").alias("operation"),
        F.col("client_time_ms").alias("source_timestamp"),
        F.col("client_tags").alias("source_tags"),
        F.col("server_tags").alias("destination_tags"),
        "emit_seq",
    )


def latency_points(pairs: DataFrame) -> DataFrame:
    """Network latency gauge in whole ms, truncated toward zero; negative when the server took longer."""
    value = fs.integer_div(F.col("client_duration_us") - F.col("server_duration_us"), 1000)
    return pairs.select(
        F.col("client_span_id").alias("pair_key"),
        F.lit("latency").alias("metric"),
        F.lit("gauge").alias("type"),
        F.lit("ms").alias("unit"),
        value.cast("double").alias("value"),
        fs.integer_div(F.col("client_time_ms"), 1000).alias("epoch_seconds"),
        F.create_map(
            F.lit("serviceName"), F.col("client_service"),
            F.lit("operationName"), F.col("client_operation"),
            F.lit("unit"), F.lit("ms"),
            F.lit("mtype"), F.lit("gauge"),
        ).alias("tags"),
    )


def edge_constraints(edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Split edges into (valid, quarantined): ends and operation named, statistics present."""
    named = [F.coalesce(F.col(c) != "", F.lit(False)) for c in ("source", "destination", "operation") if c in edges.columns]
    present = [F.col(c).isNotNull() for c in ("count", "last_seen", "error_count") if c in edges.columns]
    valid = F.lit(True)
    for check in [*named, *present]:
        valid = valid & check
    return edges.filter(valid), edges.filter(~valid)
