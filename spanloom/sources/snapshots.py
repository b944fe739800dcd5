"""Snapshots of the service graph on any Hadoop file system.

Layout below the root, one partition per snapshot name:

* ``nodes/snapshot_ts=…`` and ``edges/snapshot_ts=…`` – the two tables,
* ``taken/snapshot_ts=…`` – their row counts, written last. A snapshot exists
  once this is there, so a write that dies half-way is never read, and its
  retry replaces whatever it left.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from spanloom.functions.times import snapshot_name_of
from spanloom.operators import snapshots as ops
from spanloom.schemas import EDGE_FACT, NODE
from spanloom.sources import files

# RFC 4180: a quote inside a quoted field is doubled.
_CSV = {"header": "true", "quote": '"', "escape": '"', "nullValue": "", "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
_BAD = "_bad"


def _renamed(schema: T.StructType, provider_column: str) -> T.StructType:
    return T.StructType([
        T.StructField(provider_column if f.name == "provider" else f.name, f.dataType) for f in schema.fields
    ])


def _stamped(schema: T.StructType, *extra: str) -> T.StructType:
    return T.StructType([*schema.fields, *[T.StructField(name, T.StringType()) for name in extra]])


def read_csv_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Typed CSV rows; lines that do not fit the schema are left out."""
    # Without pruning every field of a line is checked, whatever columns are asked for;
    # asking for the id, which each line has, keeps a bare count from skipping that.
    rows = spark.read.schema(schema).options(**_CSV, mode="DROPMALFORMED", columnPruning="false").csv(path)
    return rows.filter(F.col(schema.fieldNames()[0]).isNotNull())


def rejected_csv_lines(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The lines ``read_csv_table`` leaves out."""
    rows = (
        spark.read.schema(_stamped(schema, _BAD))
        .options(**_CSV, mode="PERMISSIVE", columnNameOfCorruptRecord=_BAD, columnPruning="false").csv(path)
    )
    return rows.filter(F.col(_BAD).isNotNull()).select(F.col(schema.fieldNames()[0]), F.col(_BAD).alias("line"))


def read_nodes_csv(spark: SparkSession, path: str, provider_column: str = ops.PROVIDER_TAG) -> DataFrame:
    """A node file by itself: ``id, name, <provider>, tier``."""
    rows = read_csv_table(spark, path, _renamed(NODE, provider_column))
    return rows.withColumnRenamed(provider_column, "provider")


def read_edges_csv(spark: SparkSession, path: str) -> DataFrame:
    """An edge file by itself."""
    return read_csv_table(spark, path, EDGE_FACT)


class SnapshotStore:
    """Write, read as of an instant, and purge snapshots.

    ``provider_tag`` is both the vertex tag a node keeps and its column heading,
    so files that other tools wrote can be matched.
    """

    def __init__(
        self, spark: SparkSession, root: str, format: str = "csv",
        provider_tag: str = ops.PROVIDER_TAG, tier_tag: str = ops.TIER_TAG,
    ):
        if format not in ("csv", "parquet"):
            raise ValueError(f"format must be 'csv' or 'parquet', not {format!r}")
        self.spark, self.root, self.format = spark, root.rstrip("/"), format
        self.provider_tag, self.tier_tag = provider_tag, tier_tag

    def _path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def _write_table(self, rows: DataFrame, table: str, name: str, format: str) -> None:
        (
            rows.withColumn("snapshot_ts", F.lit(name))
            .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            .partitionBy("snapshot_ts").options(**(_CSV if format == "csv" else {})).format(format).save(self._path(table))
        )

    def names(self) -> list[str]:
        """Names of all snapshots, oldest first."""
        return files.partition_values(self.spark, self._path("taken"), "snapshot_ts")

    def write(self, graph: DataFrame, instant_ms: int) -> tuple[str, str]:
        """Store a service graph under the instant's name; returns the node and edge locations.

        ``graph`` may carry ``edge_id`` (its input order); otherwise edges are
        numbered by name.
        """
        name = snapshot_name_of(instant_ms)
        files.drop_partition(self.spark, self._path("taken"), "snapshot_ts", name)
        edges = ops.node_columns(graph, self.provider_tag, self.tier_tag)
        if "edge_id" not in edges.columns:
            edges = ops.number_edges(edges)
        for table in ("nodes", "edges"):
            files.drop_partition(self.spark, self._path(table), "snapshot_ts", name)
        nodes = ops.node_dimension(edges)
        stored_nodes = nodes.withColumnRenamed("provider", self.provider_tag)
        self._write_table(stored_nodes, "nodes", name, self.format)
        self._write_table(ops.edge_fact(edges, nodes), "edges", name, self.format)
        counts = self.spark.range(1).select(F.lit(instant_ms).alias("snapshot_ms"))
        self._write_table(counts, "taken", name, "parquet")
        return self._folder("nodes", name), self._folder("edges", name)

    def as_of(self, instant_ms: int) -> str | None:
        """Name of the latest snapshot at or before the instant."""
        wanted = snapshot_name_of(instant_ms)
        return max((name for name in self.names() if name <= wanted), default=None)

    def _folder(self, table: str, name: str) -> str:
        """Where a snapshot's table is; the name's colons are escaped in folder names."""
        return files.partition_path(self.spark, self._path(table), "snapshot_ts", name)

    def _table(self, table: str, schema: T.StructType, name: str | None) -> DataFrame:
        stamped = _stamped(schema, "snapshot_ts")
        path = self._path(table) if name is None else self._folder(table, name)
        if not files.exists(self.spark, path):
            return self.spark.createDataFrame([], stamped)
        if self.format == "csv":
            rows = read_csv_table(self.spark, path, stamped if name is None else schema)
        else:
            rows = self.spark.read.schema(stamped if name is None else schema).parquet(path)
        return rows if name is None else rows.withColumn("snapshot_ts", F.lit(name))

    def nodes(self, name: str | None = None) -> DataFrame:
        """The nodes of one snapshot, of which only its own folder is listed, or of all."""
        return self._table("nodes", _renamed(NODE, self.provider_tag), name).withColumnRenamed(self.provider_tag, "provider")

    def edges(self, name: str | None = None) -> DataFrame:
        """The edges of one snapshot or of all."""
        return self._table("edges", EDGE_FACT, name)

    def dangling_edges(self, name: str | None = None) -> DataFrame:
        """Edges that ``snapshot``, ``read`` and ``history`` leave out because a node of theirs is missing."""
        return ops.dangling_edges(self.edges(name), self.nodes(name))

    def rejected_lines(self) -> DataFrame:
        """Lines of CSV tables that could not be read."""
        tables = (("nodes", _renamed(NODE, self.provider_tag)), ("edges", EDGE_FACT))
        nodes, edges = (rejected_csv_lines(self.spark, self._path(name), _stamped(schema, "snapshot_ts")) for name, schema in tables)
        return nodes.unionByName(edges)

    def snapshot(self, name: str) -> DataFrame:
        """The graph of one snapshot."""
        return ops.snapshot_edge_join(self.edges(name), self.nodes(name))

    def read(self, instant_ms: int) -> DataFrame | None:
        """The graph as it was known at the instant, or None before the first snapshot."""
        name = self.as_of(instant_ms)
        return None if name is None else self.snapshot(name)

    def history(self) -> DataFrame:
        """The graphs of all snapshots together, for analysis over time."""
        return ops.snapshot_edge_join(self.edges(), self.nodes())

    def purge(self, instant_ms: int) -> int:
        """Remove snapshots at or before the instant; returns the number of tables' partitions removed."""
        limit = snapshot_name_of(instant_ms)
        removed = 0
        for name in [n for n in self.names() if n <= limit]:
            files.drop_partition(self.spark, self._path("taken"), "snapshot_ts", name)
            for table in ("nodes", "edges"):
                files.drop_partition(self.spark, self._path(table), "snapshot_ts", name)
                removed += 1
        return removed


def with_tags(snapshot: DataFrame, provider_tag: str = ops.PROVIDER_TAG, tier_tag: str = ops.TIER_TAG) -> DataFrame:
    """Fold a snapshot's node columns back into tag maps, as the graph document has them."""
    def tags(side: str):
        entries = F.create_map(F.lit(tier_tag), F.col(f"{side}_tier"), F.lit(provider_tag), F.col(f"{side}_provider"))
        return F.map_filter(entries, lambda _, value: value.isNotNull()).alias(f"{side}_tags")

    return snapshot.select(
        "edge_id", "source", "destination", tags("source"), tags("destination"),
        "count", "last_seen", "error_count", "effective_from", "effective_to",
    )
