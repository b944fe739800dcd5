"""Batch jobs that wire the operators between stored tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from spanloom.functions.times import snapshot_name_of
from spanloom.operators import edges as edge_ops
from spanloom.operators import pairs as pair_ops
from spanloom.operators import stats
from spanloom.operators.spans import TRACE_SCOPE, dedupe_spans, light_spans
from spanloom.plans.graph import service_graph
from spanloom.schemas import EDGE
from spanloom.sources.snapshots import SnapshotStore
from spanloom.streaming.windows import read_windowed_edges, write_windowed_edges

HOUR_MS = 3_600_000
YEAR_MS = 31_556_952_000


def run_span_job(
    spans: DataFrame, root: str, tag_keys: Sequence[str] = (), scope: Sequence[str] = TRACE_SCOPE, mode: str = "as_of"
) -> None:
    """Raw spans to the tables ``pairs``, ``edges``, ``latency`` and ``registry`` below ``root``.

    Pairs are written once and the other tables read from them, so a lost
    executor costs one stage and not the whole pairing.
    """
    spark = spans.sparkSession
    accepted = pair_ops.accepted_pairs(light_spans(spans, tag_keys), scope, mode=mode)
    accepted.write.mode("overwrite").parquet(f"{root}/pairs")
    stored = spark.read.parquet(f"{root}/pairs")
    edge_ops.graph_edges(stored).write.mode("overwrite").parquet(f"{root}/edges")
    edge_ops.latency_points(stored).write.mode("overwrite").parquet(f"{root}/latency")
    pair_ops.shared_registry(stored).write.mode("overwrite").parquet(f"{root}/registry")


def run_edge_job(spark: SparkSession, root: str, window_ms: int, now_ms: int) -> None:
    """Edges to the ``windowed`` table below ``root``; windows that are there already are replaced."""
    edges = spark.read.schema(EDGE).parquet(f"{root}/edges")
    write_windowed_edges(stats.edge_stats(edges, window_ms, now_ms), f"{root}/windowed")


def run_snapshot_job(
    store: SnapshotStore, windowed: DataFrame | str, now_ms: int, window_ms: int = 300_000,
    span_ms: int = HOUR_MS, purge_age_ms: int = YEAR_MS,
) -> tuple[str, int]:
    """Store the graph of the last ``span_ms`` under ``now_ms`` and purge what is older than ``purge_age_ms``.

    ``windowed`` is a table, streamed or stored, by its path, or its rows. Returns the snapshot's name and the number of items purged; an age of 0
    purges the new snapshot too.
    """
    table = read_windowed_edges(store.spark, windowed) if isinstance(windowed, str) else windowed
    store.write(service_graph(table, window_ms, now_ms, now_ms - span_ms, now_ms), now_ms)
    return snapshot_name_of(now_ms), store.purge(now_ms - purge_age_ms)
