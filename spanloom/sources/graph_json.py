"""The graph as JSON documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from spanloom.operators.numbering import dense_number
from spanloom.schemas import GRAPH_DOCUMENT, GRAPH_EDGE


def _flat_edges(edges: DataFrame) -> DataFrame:
    edge = F.col("edge")
    return edges.select(
        "edge_id",
        edge["source"]["name"].alias("source"),
        edge["destination"]["name"].alias("destination"),
        edge["source"]["tags"].alias("source_tags"),
        edge["destination"]["tags"].alias("destination_tags"),
        edge["stats"]["count"].alias("count"),
        edge["stats"]["lastSeen"].alias("last_seen"),
        edge["stats"]["errorCount"].alias("error_count"),
        edge["effectiveFrom"].alias("effective_from"),
        edge["effectiveTo"].alias("effective_to"),
    )


def _numbered(documents: DataFrame, order: list[str]) -> DataFrame:
    """Edges of documents (``edges`` and the columns of ``order``), numbered 1..n over all of them in that order."""
    edges = documents.select(*order, F.posexplode("edges").alias("_at", "edge"))
    if documents.limit(2).count() < 2:
        return _flat_edges(edges.withColumn("edge_id", F.col("_at") + F.lit(1).cast("long")))
    return _flat_edges(dense_number(edges, [*order, "_at"], "edge_id"))


def parse_graph_json(documents: DataFrame, column: str = "json") -> DataFrame:
    """Edges of JSON documents ``{"edges": [...]}`` held in a string column; missing pieces are null.

    ``edge_id`` runs on over the documents, which are taken in the order of their text; equal documents count once for each.
    """
    parsed = documents.select(F.from_json(column, GRAPH_DOCUMENT)["edges"].alias("edges"), F.col(column).alias("_text"), F.monotonically_increasing_id().alias("_row"))
    return _numbered(parsed, ["_text", "_row"])


def read_graph_json(spark: SparkSession, path: str) -> DataFrame:
    """Edges of JSON document files ``{"edges": [...]}``, numbered in the order of file names and of each document."""
    documents = spark.read.schema(GRAPH_DOCUMENT).option("multiLine", True).json(path)
    return _numbered(documents.select("edges", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_row")), ["_file", "_row"])


def write_graph_document(graph: DataFrame, path: str, parts: int = 1) -> None:
    """Write the graph as ``parts`` documents ``{"edges": [...]}``, which ``read_graph_json`` reads together.

    One document is what a graph view shows and has an edge per pair of services. For larger graphs raise ``parts``: a document is built by one task. ``write_graph_json`` has no such bound.
    """
    nested = nested_edges(graph).select(F.struct("*").alias("edge"))
    part = F.pmod(F.xxhash64("edge.source.name", "edge.destination.name"), F.lit(parts))
    documents = nested.groupBy(part.alias("_part")).agg(F.collect_list("edge").alias("edges"))
    if parts == 1:
        documents = nested.agg(F.collect_list("edge").alias("edges"))
    documents.select("edges").repartition(parts).write.mode("overwrite").json(path)


def nested_edges(graph: DataFrame) -> DataFrame:
    """Graph rows in the layout of the document; absent tags become an empty object."""
    no_tags = F.create_map().cast("map<string,string>")

    def vertex(side: str):
        return F.struct(F.col(side).alias("name"), F.coalesce(F.col(f"{side}_tags"), no_tags).alias("tags")).alias(side)

    return graph.select(
        vertex("source"),
        vertex("destination"),
        F.struct(
            F.col("count"), F.col("last_seen").alias("lastSeen"), F.col("error_count").alias("errorCount")
        ).alias("stats"),
        F.col("effective_from").alias("effectiveFrom"),
        F.col("effective_to").alias("effectiveTo"),
    )


def graph_json(graph: DataFrame) -> DataFrame:
    """One JSON object per edge."""
    nested = nested_edges(graph)
    return nested.select(F.to_json(F.struct(*nested.columns)).alias("json"))


def write_graph_json(graph: DataFrame, path: str) -> None:
    """Write edges as JSON lines in parallel; the array around them would need a single writer."""
    nested_edges(graph).write.mode("overwrite").json(path)


def read_edge_lines(spark: SparkSession, path: str) -> DataFrame:
    """Read what ``write_graph_json`` wrote."""
    edges = spark.read.schema(GRAPH_EDGE).json(path)
    return _flat_edges(edges.select(F.lit(None).cast("long").alias("edge_id"), F.struct(*edges.columns).alias("edge"))).drop("edge_id")
