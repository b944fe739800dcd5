"""A service graph as two relational tables, and questions over snapshots of it.

``provider`` and ``tier`` are the two vertex tags a node row keeps.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from spanloom.operators.numbering import dense_number

PROVIDER_TAG = "infrastructure_provider"
TIER_TAG = "tier"
STATS = {
    "statsCount": "count",
    "statsLastSeen": "last_seen",
    "statsErrorCount": "error_count",
    "effectiveFrom": "effective_from",
    "effectiveTo": "effective_to",
}
_NODE = ("name", "provider", "tier")
_DESTINATIONS_AFTER = 1 << 53  # all sources are numbered ahead of the first destination


def node_columns(graph: DataFrame, provider_tag: str = PROVIDER_TAG, tier_tag: str = TIER_TAG) -> DataFrame:
    """Replace both tag maps by the columns a node keeps."""
    def kept(side: str) -> list[Column]:
        tags = F.col(f"{side}_tags")
        return [
            F.try_element_at(tags, F.lit(provider_tag)).alias(f"{side}_provider"),
            F.try_element_at(tags, F.lit(tier_tag)).alias(f"{side}_tier"),
        ]

    rest = [c for c in graph.columns if c not in ("source_tags", "destination_tags")]
    return graph.select(*rest, *kept("source"), *kept("destination"))


def number_edges(edges: DataFrame) -> DataFrame:
    """Add ``edge_id`` 1..n; a merged graph has no input order, so its names give one."""
    return dense_number(edges, ["source", "destination"], "edge_id")


def node_dimension(edges: DataFrame) -> DataFrame:
    """Distinct (name, provider, tier) with ids 1..n by first appearance: sources in edge order, then destinations.

    The same name under different tags is a different node.
    """
    def ends(side: str, shift: int) -> DataFrame:
        return edges.select(
            F.col(side).alias("name"), F.col(f"{side}_provider").alias("provider"), F.col(f"{side}_tier").alias("tier"),
            (F.col("edge_id") + shift).alias("_position"),
        )

    nodes = (
        ends("source", 0).unionByName(ends("destination", _DESTINATIONS_AFTER))
        .filter(F.col("name").isNotNull())
        .groupBy(*_NODE)
        .agg(F.min("_position").alias("_position"))
    )
    return dense_number(nodes, ["_position"], "id").select("id", *_NODE)


def edge_fact(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """Edges with node ids in place of nodes; a missing end or statistic stays empty."""
    facts = edges
    for side, id_name in (("source", "sourceId"), ("destination", "destinationId")):
        end = nodes.select(F.col("id").alias(id_name), *[F.col(c).alias(f"_{c}") for c in _NODE])
        same = (
            F.col(side).eqNullSafe(F.col("_name"))
            & F.col(f"{side}_provider").eqNullSafe(F.col("_provider"))
            & F.col(f"{side}_tier").eqNullSafe(F.col("_tier"))
        )
        facts = facts.join(end, same, "left").drop("_name", "_provider", "_tier")
    return facts.select(
        F.col("edge_id").alias("id"), "sourceId", "destinationId",
        *[F.col(c).cast("long").alias(name) for name, c in STATS.items()],
    )


def snapshot_edge_join(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """Edges with both nodes looked up. An edge whose node is missing is left out; see ``dangling_edges``."""
    joined = edges
    for side in ("source", "destination"):
        end = nodes.select(
            F.col("id").alias(f"{side}Id"), F.col("name").alias(side),
            F.col("provider").alias(f"{side}_provider"), F.col("tier").alias(f"{side}_tier"),
            *[c for c in ("snapshot_ts",) if c in nodes.columns and c in edges.columns],
        )
        keys = [f"{side}Id", *[c for c in ("snapshot_ts",) if c in end.columns]]
        joined = joined.join(end, keys)
    return joined.select(
        *[c for c in ("snapshot_ts",) if c in joined.columns],
        F.col("id").alias("edge_id"), "source", "source_provider", "source_tier",
        "destination", "destination_provider", "destination_tier",
        *[F.col(name).alias(c) for name, c in STATS.items()],
    )


def dangling_edges(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """Edges whose source or destination id the node table lacks, or lists without a name; each within its own snapshot."""
    keys = [c for c in ("snapshot_ts",) if c in nodes.columns and c in edges.columns]
    known = nodes.filter(F.col("name").isNotNull()).select(*keys, F.col("id").alias("_id"))

    def end(side: str) -> DataFrame:
        return known.withColumnRenamed("_id", f"{side}Id").withColumn(f"_has_{side}", F.lit(True))

    marked = edges.join(end("source"), [*keys, "sourceId"], "left").join(end("destination"), [*keys, "destinationId"], "left")
    return marked.filter("_has_source is null or _has_destination is null").select(*edges.columns)


def snapshot_as_of(snapshots: DataFrame, instants: DataFrame, bucket_ms: int = 3_600_000) -> DataFrame:
    """For each distinct ``instant_ms`` the latest ``snapshot_ms`` at or before it, null if there is none.

    Time is cut into buckets. Inside a bucket, which has at most ``bucket_ms``
    distinct instants, a running maximum answers; what no snapshot of the same
    bucket precedes takes the last snapshot of the buckets before, found on one
    row per bucket.
    """
    bucket = F.floor(F.col("at") / F.lit(bucket_ms))
    asked = instants.select(F.col("instant_ms").alias("at"), F.lit(None).cast("long").alias("snapshot_ms"), F.lit(1).alias("asked"))
    taken = snapshots.select(F.col("snapshot_ms").alias("at"), "snapshot_ms", F.lit(0).alias("asked"))
    marks = asked.unionByName(taken).distinct().withColumn("_bucket", bucket)

    running = Window.partitionBy("_bucket").orderBy("at", "asked")
    within = marks.withColumn("_same", F.max("snapshot_ms").over(running)).filter(F.col("asked") == 1)

    earlier = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    per_bucket = (
        marks.groupBy("_bucket").agg(F.max("snapshot_ms").alias("_last"))
        .select("_bucket", F.max("_last").over(earlier).alias("_before"))
    )
    return within.join(per_bucket, "_bucket").select(
        F.col("at").alias("instant_ms"), F.coalesce("_same", "_before").alias("snapshot_ms")
    )


def snapshot_history(before: DataFrame, after: DataFrame) -> DataFrame:
    """What changed between two snapshots of the graph: edges added, removed, changed or unchanged."""
    key = ["source", "source_provider", "source_tier", "destination", "destination_provider", "destination_tier"]
    measures = ["count", "error_count", "last_seen"]

    def side(graph: DataFrame, label: str) -> DataFrame:
        return graph.select(
            *[F.col(c).alias(f"{label}_{c}") for c in [*key, *measures]], F.lit(True).alias(f"in_{label}")
        )

    old, new = side(before, "old"), side(after, "new")
    same = F.lit(True)
    for column in key:
        same = same & F.col(f"old_{column}").eqNullSafe(F.col(f"new_{column}"))
    moved = F.lit(False)
    for column in measures:
        moved = moved | (F.col(f"old_{column}") != F.col(f"new_{column}"))
    change = (
        F.when(F.col("in_old").isNull(), "added")
        .when(F.col("in_new").isNull(), "removed")
        .when(moved, "changed")
        .otherwise("same")
    )
    return old.join(new, same, "full").select(
        *[F.coalesce(f"old_{c}", f"new_{c}").alias(c) for c in key],
        change.alias("change"),
        *[
            (F.coalesce(f"new_{c}", F.lit(0)) - F.coalesce(f"old_{c}", F.lit(0))).alias(f"{c}_delta")
            for c in ("count", "error_count")
        ],
    )
