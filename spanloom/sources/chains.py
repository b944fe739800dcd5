"""Snapshots of the service graph as a chain: a full base now and then, changes between.

Layout below the root: ``base/snapshot_ts=…`` holds a whole graph, ``delta/snapshot_ts=…`` the edges that differ from the snapshot before (removed ones marked), and
``taken/snapshot_ts=…`` is written last and makes a snapshot count. A snapshot is its latest base and the deltas since, ``base_every`` folders at most. A graph
that did not change costs an empty delta.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from spanloom.functions.times import snapshot_name_of
from spanloom.operators import snapshots as ops
from spanloom.operators.intervals import EDGE, VALUES
from spanloom.sources import files

_NAME = "snapshot_ts"
_GONE = "gone"
ROWS = T.StructType([
    *[T.StructField(c, T.StringType()) for c in EDGE], *[T.StructField(c, T.LongType()) for c in VALUES], T.StructField(_GONE, T.BooleanType()),
])


class SnapshotChain:
    """Write snapshots in order of time, read as of any instant, purge."""

    def __init__(self, spark: SparkSession, root: str, base_every: int = 24, provider_tag: str = ops.PROVIDER_TAG, tier_tag: str = ops.TIER_TAG):
        if base_every < 1:
            raise ValueError("base_every must be 1 at least")
        self.spark, self.root, self.base_every = spark, root.rstrip("/"), base_every
        self.provider_tag, self.tier_tag = provider_tag, tier_tag

    def _held(self, part: str) -> list[str]:
        return files.partition_values(self.spark, f"{self.root}/{part}", _NAME)

    def names(self) -> list[str]:
        """Names of all snapshots, oldest first. A purge may keep folders that later ones need; those do not count."""
        first = files.read_text(self.spark, f"{self.root}/_first")
        return [n for n in self._held("taken") if first is None or n > first]

    def _needed(self, name: str) -> list[tuple[str, str]]:
        """The folders (part, name) that make up the snapshot, its base first."""
        bases, taken = self._held("base"), self._held("taken")
        base = max(b for b in bases if b <= name and b in taken)
        return [("base", base), *[("delta", n) for n in taken if base < n <= name]]

    def _rows(self, folders: list[tuple[str, str]]) -> DataFrame:
        """The stored rows of some folders with their names."""
        rows = self.spark.createDataFrame([], T.StructType([*ROWS.fields, T.StructField(_NAME, T.StringType())]))
        for part in ("base", "delta"):
            paths = [files.partition_path(self.spark, f"{self.root}/{part}", _NAME, n) for p, n in folders if p == part]
            if paths:
                found = self.spark.read.schema(rows.schema).option("basePath", f"{self.root}/{part}").parquet(*paths)
                rows = rows.unionByName(found.select(*rows.columns))
        return rows

    def snapshot(self, name: str) -> DataFrame:
        """The edges of one snapshot: of each the row that was written last."""
        rest = [c for c in ROWS.fieldNames() if c not in EDGE]
        last = self._rows(self._needed(name)).groupBy(*EDGE).agg(F.max_by(F.struct(*rest), _NAME).alias("_last"))
        return last.select(*EDGE, "_last.*").where(~F.col(_GONE)).drop(_GONE)

    def as_of(self, instant_ms: int) -> str | None:
        wanted = snapshot_name_of(instant_ms)
        return max((n for n in self.names() if n <= wanted), default=None)

    def read(self, instant_ms: int) -> DataFrame | None:
        """The graph as it was known at the instant, None before the first snapshot."""
        name = self.as_of(instant_ms)
        return None if name is None else self.snapshot(name)

    def write(self, graph: DataFrame, instant_ms: int) -> str:
        """Store a service graph under the instant's name, which must be after all others; writing the last one again replaces it."""
        name, taken = snapshot_name_of(instant_ms), self._held("taken")
        if taken and name < taken[-1]:
            raise ValueError(f"{name} is before {taken[-1]}: a chain grows at its end")
        for part in ("taken", "base", "delta"):
            files.drop_partition(self.spark, f"{self.root}/{part}", _NAME, name)
        earlier = [n for n in taken if n < name]
        edges = ops.node_columns(graph, self.provider_tag, self.tier_tag).select(*EDGE, *VALUES).withColumn(_GONE, F.lit(False))
        since_base = len(self._needed(earlier[-1])) if earlier else self.base_every
        if since_base >= self.base_every:
            self._write(edges, "base", name)
        else:
            self._write(self._changes(self.snapshot(earlier[-1]), edges), "delta", name)
        self._write(self.spark.range(1).select(F.lit(instant_ms).alias("snapshot_ms")), "taken", name)
        return name

    @staticmethod
    def _changes(before: DataFrame, now: DataFrame) -> DataFrame:
        """Edges that are new or have other values, and marks for those that are gone. One aggregate brings both sides of an edge together, null parts too."""
        value = F.struct(*VALUES)
        both = before.select(*EDGE, value.alias("_old"), F.lit(None).cast(before.select(value).schema[0].dataType).alias("_new")).unionByName(
            now.select(*EDGE, F.lit(None).cast(now.select(value).schema[0].dataType).alias("_old"), value.alias("_new"))
        )
        sides = both.groupBy(*EDGE).agg(F.max("_old").alias("_old"), F.max("_new").alias("_new")).where(~F.col("_old").eqNullSafe(F.col("_new")))
        return sides.select(*EDGE, "_new.*", F.col("_new").isNull().alias(_GONE))

    def _write(self, rows: DataFrame, part: str, name: str) -> None:
        rows.write.mode("overwrite").parquet(files.partition_path(self.spark, f"{self.root}/{part}", _NAME, name))

    def changes(self) -> DataFrame:
        """All stored rows by snapshot, for sizes and audits."""
        return self._rows([(part, n) for part in ("base", "delta") for n in self._held(part)])

    def history(self) -> DataFrame:
        """The edges of all snapshots together. A stored row counts for every snapshot that needs its folder, of each edge the last one; ``base_every`` copies at most."""
        needs = [(n, part, written) for n in self.names() for part, written in self._needed(n)]
        rows = self._rows(sorted({(part, written) for _, part, written in needs})).withColumnRenamed(_NAME, "_written")
        places = self.spark.createDataFrame([(n, written) for n, _, written in needs], f"{_NAME} string, _written string")
        rest = [c for c in ROWS.fieldNames() if c not in EDGE]
        last = rows.join(places, "_written").groupBy(_NAME, *EDGE).agg(F.max_by(F.struct(*rest), "_written").alias("_last"))
        return last.select(_NAME, *EDGE, "_last.*").where(~F.col(_GONE)).drop(_GONE)

    def name_table(self) -> DataFrame:
        return self.spark.createDataFrame([(n,) for n in self.names()], f"{_NAME} string")

    def purge(self, instant_ms: int) -> int:
        """Forget snapshots at or before the instant; returns their number. The base and deltas that the first kept snapshot needs stay until it goes."""
        limit = snapshot_name_of(instant_ms)
        gone = [n for n in self.names() if n <= limit]
        kept = [n for n in self.names() if n > limit]
        if gone:
            files.write_text(self.spark, f"{self.root}/_first", gone[-1])
        needed = {n for _, n in self._needed(kept[0])} if kept else set()
        for name in [n for n in self._held("taken") if n <= limit and n not in needed]:
            for part in ("taken", "delta", "base"):
                files.drop_partition(self.spark, f"{self.root}/{part}", _NAME, name)
        return len(gone)
