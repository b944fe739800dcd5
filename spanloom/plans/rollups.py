"""Service graphs over long ranges from dyadic roll-ups.

Node n of level k holds the partial service graph of windows n * 2**k up to (n + 1) * 2**k: one row per edge, side, tag and tag value, as merging needs them, so
partial graphs of any nodes add up to the exact graph. A range of w windows is covered by at most two nodes of each level but the highest, and a query reads
the folders of those nodes and no others. A window that changes has its one node of each level computed again, from the two nodes below it.

Table: ``level=k/node=n/*.parquet``. ``update_rollups`` replaces whole nodes; one job updates a table at a time.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from spanloom.functions import times
from spanloom.operators import stats
from spanloom.sources import files

#: With windows of 300 s the highest level holds a week.
LEVELS = 12
_EDGE = ["source", "destination"]
_NODE = T.StructField("node", T.LongType())
PARTS = T.StructType([
    *[T.StructField(c, T.StringType()) for c in (*_EDGE, "side", "key", "value")],
    *[T.StructField(c, T.LongType()) for c in ("count", "last_seen", "error_count", "effective_from", "effective_to")],
])


def cover(first: int, last: int, levels: int = LEVELS) -> list[tuple[int, int]]:
    """The fewest (level, node) that hold windows ``first`` to ``last``, bounds included, and no others."""
    found = []
    while first <= last:
        level = 0
        while level + 1 < levels and first % (2 << level) == 0 and first + (2 << level) - 1 <= last:
            level += 1
        found.append((level, first >> level))
        first += 1 << level
    return found


def _folder(table: str, level: int, node: int | None = None) -> str:
    return f"{table}/level={level}" if node is None else f"{table}/level={level}/node={node}"


def _nodes(spark: SparkSession, table: str, level: int) -> set[int]:
    return {int(v) for v in files.partition_values(spark, _folder(table, level), "node")}


def _read_level(spark: SparkSession, table: str, level: int, nodes: Iterable[int]) -> DataFrame:
    schema, paths = T.StructType([*PARTS.fields, _NODE]), [_folder(table, level, n) for n in nodes]
    if not paths:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", _folder(table, level)).parquet(*paths)


def _write_level(rows: DataFrame, table: str, level: int, nodes: int) -> None:
    tasks = min(nodes, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    rows = rows.select(*PARTS.fieldNames(), "node").repartition(tasks, "node")
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("node").parquet(_folder(table, level))


def update_rollups(windowed: DataFrame, table: str, window_ms: int, starts: Iterable[int], levels: int = LEVELS) -> None:
    """Bring the roll-ups up to date with windowed edges of which the windows that begin at ``starts`` are new or changed."""
    spark, touched = windowed.sparkSession, sorted({start // window_ms for start in starts})
    if not touched:
        return
    changed = windowed.where(F.col("window_start").isin([n * window_ms for n in touched]))
    if "window_date" in windowed.columns:
        changed = changed.where(F.col("window_date").isin(sorted({times.date_of(n * window_ms) for n in touched})))
    changed = changed.select(
        "*", F.col("window_start").alias("effective_from"), F.col("window_end").alias("effective_to"), F.floor(F.col("window_start") / window_ms).alias("node")
    )
    _write_level(stats.merge_parts(changed, ["node", *_EDGE]), table, 0, len(touched))
    for level in range(1, levels):
        touched = sorted({n >> 1 for n in touched})
        below = [c for c in sorted(_nodes(spark, table, level - 1)) if c >> 1 in set(touched)]
        children = _read_level(spark, table, level - 1, below).withColumn("node", F.floor(F.col("node") / 2))
        _write_level(stats.add_parts(children, ["node", *_EDGE]), table, level, len(touched))


def rollup_service_graph(
    spark: SparkSession, table: str, window_ms: int, now_ms: int, from_ms: int | None = None, to_ms: int | None = None, levels: int = LEVELS,
) -> DataFrame:
    """What ``graph.service_graph`` gives for the range, read from the nodes that cover it."""
    lower, upper = times.query_range(now_ms, window_ms, from_ms, to_ms)
    by_level: dict[int, list[int]] = {}
    for level, node in cover(lower // window_ms, upper // window_ms, levels):
        by_level.setdefault(level, []).append(node)
    parts = spark.createDataFrame([], PARTS)
    for level, nodes in by_level.items():
        held = _nodes(spark, table, level) if len(nodes) > 2 else {n for n in nodes if files.exists(spark, _folder(table, level, n))}
        parts = parts.unionByName(_read_level(spark, table, level, sorted(held.intersection(nodes))).drop("node"))
    parts = parts.withColumn("effective_to", F.least(F.lit(now_ms), F.col("effective_to")))
    return stats.join_parts(stats.add_parts(parts, _EDGE), _EDGE)


def drop_rollups_before(spark: SparkSession, table: str, start_ms: int, window_ms: int, levels: int = LEVELS) -> int:
    """Forget nodes all of whose windows begin before ``start_ms``; returns their number."""
    first, gone = start_ms // window_ms, 0
    for level in range(levels):
        for node in sorted(_nodes(spark, table, level)):
            if (node + 1) << level <= first:
                gone += files.drop_partition(spark, _folder(table, level), "node", str(node))
    return gone
