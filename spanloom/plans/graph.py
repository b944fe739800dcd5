"""The graph queries over windowed edges."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, functions as F

from spanloom.functions import times
from spanloom.operators import stats


def _in_range(windowed: DataFrame, window_ms: int, now_ms: int, from_ms: int | None, to_ms: int | None) -> DataFrame:
    """Windows that start within the aligned range, bounds included.

    On the stored table the day filter prunes partitions and the window filter
    reaches the file statistics.
    """
    lower, upper = times.query_range(now_ms, window_ms, from_ms, to_ms)
    chosen = windowed.filter(F.col("window_start").between(lower, upper))
    if "window_date" in windowed.columns:
        chosen = chosen.filter(F.col("window_date").between(times.date_of(lower), times.date_of(upper)))
    return chosen.withColumn("effective_from", F.col("window_start")).withColumn(
        "effective_to", F.least(F.lit(now_ms), F.col("window_end"))
    )


def operation_graph(
    windowed: DataFrame, window_ms: int, now_ms: int, from_ms: int | None = None, to_ms: int | None = None
) -> DataFrame:
    """Every edge of every window in range, one row each."""
    return _in_range(windowed, window_ms, now_ms, from_ms, to_ms).select(
        "source", "destination", "operation", "count", "last_seen", "error_count",
        "source_tags", "destination_tags", "effective_from", "effective_to",
    )


def service_graph(
    windowed: DataFrame, window_ms: int, now_ms: int, from_ms: int | None = None, to_ms: int | None = None
) -> DataFrame:
    """The windows in range merged into one edge per (source, destination)."""
    return stats.service_graph_merge(_in_range(windowed, window_ms, now_ms, from_ms, to_ms))


def register_graph_views(
    windowed: DataFrame, window_ms: int, now_ms: int, from_ms: int | None = None, to_ms: int | None = None
) -> None:
    """Offer both graphs to SQL as ``servicegraph`` and ``operationgraph``."""
    service_graph(windowed, window_ms, now_ms, from_ms, to_ms).createOrReplaceTempView("servicegraph")
    operation_graph(windowed, window_ms, now_ms, from_ms, to_ms).createOrReplaceTempView("operationgraph")


_FUNCTION = """
CREATE OR REPLACE TEMPORARY FUNCTION {name}(from_ms BIGINT DEFAULT NULL, to_ms BIGINT DEFAULT NULL)
RETURNS TABLE({columns}) RETURN
WITH chosen AS (
  SELECT *, window_start AS effective_from, least({now}, window_end) AS effective_to FROM {view}
  WHERE window_start BETWEEN {lower} AND {upper} AND window_date BETWEEN {first_day} AND {last_day}
)
{body}
"""
_STATISTICS = "count BIGINT, last_seen BIGINT, error_count BIGINT, source_tags MAP<STRING, STRING>, destination_tags MAP<STRING, STRING>, effective_from BIGINT, effective_to BIGINT"
_OPERATIONS = """
SELECT source, destination, operation, count, last_seen, error_count, source_tags, destination_tags, effective_from, effective_to FROM chosen
"""
_SERVICES = """
, tags AS (
  SELECT source, destination, tag.side, tag.key, CASE WHEN tag.value RLIKE '^,+$' THEN array() ELSE split(regexp_replace(tag.value, ',+$', ''), ',') END AS parts
  FROM chosen LATERAL VIEW explode(concat(
    transform(map_entries(source_tags), e -> struct('source' AS side, e.key AS key, e.value AS value)),
    transform(map_entries(destination_tags), e -> struct('destination' AS side, e.key AS key, e.value AS value))
  )) AS tag
), unions AS (
  SELECT source, destination, side, key, array_join(sort_array(collect_set(part)), ',') AS value
  FROM tags LATERAL VIEW OUTER explode(parts) AS part GROUP BY source, destination, side, key
), folded AS (
  SELECT source, destination, map_from_entries(sort_array(collect_list(CASE WHEN side = 'source' THEN struct(key, value) END))) AS source_tags,
    map_from_entries(sort_array(collect_list(CASE WHEN side = 'destination' THEN struct(key, value) END))) AS destination_tags
  FROM unions GROUP BY source, destination
), totals AS (
  SELECT source, destination, sum(count) AS count, max(last_seen) AS last_seen, sum(error_count) AS error_count,
    min(effective_from) AS effective_from, max(effective_to) AS effective_to
  FROM chosen GROUP BY source, destination
)
SELECT t.source, t.destination, count, last_seen, error_count, coalesce(source_tags, map()) AS source_tags, coalesce(destination_tags, map()) AS destination_tags,
  effective_from, effective_to
FROM totals t LEFT JOIN folded f ON t.source = f.source AND t.destination = f.destination
"""


def register_graph_functions(windowed: DataFrame, window_ms: int, now_ms: int | None = None, view: str = "windowed_edges") -> None:
    """Offer both graphs to SQL as table functions ``servicegraph(from_ms, to_ms)`` and ``operationgraph(from_ms, to_ms)``.

    Either bound may be left out: the last 24 hours up to ``now_ms``, the clock of each query if None; the lower one is aligned. ``windowed`` is what
    ``read_windowed_edges`` gives and becomes the view ``view``. The bounds reach its partition filters. Files that a stream has written since the
    registration are seen after ``spark.catalog.refreshByPath`` or another registration.
    """
    spark = windowed.sparkSession
    windowed.createOrReplaceTempView(view)
    now = "unix_millis(current_timestamp())" if now_ms is None else f"CAST({now_ms} AS BIGINT)"
    for name, key, body in (("servicegraph", "source STRING, destination STRING", _SERVICES), ("operationgraph", "source STRING, destination STRING, operation STRING", _OPERATIONS)):
        since = f"coalesce({name}.from_ms, {now} - {times.DAY_MS})"
        lower, upper = f"({since} - pmod({since}, {window_ms}))", f"coalesce({name}.to_ms, {now})"
        day = lambda at: f"CAST(date_add(DATE'1970-01-01', CAST(floor({at} / {times.DAY_MS}) AS INT)) AS STRING)"
        spark.sql(_FUNCTION.format(
            name=name, columns=f"{key}, {_STATISTICS}", now=now, view=view, lower=lower, upper=upper, first_day=day(lower), last_day=day(upper), body=body
        ))


def with_edge_count(graph: DataFrame, name: str = "graph") -> tuple[DataFrame, Observation]:
    """The graph with its edge count observed while it is computed; read it with ``observation.get``."""
    observation = Observation(name)
    return graph.observe(observation, F.count(F.lit(1)).alias("edges")), observation
