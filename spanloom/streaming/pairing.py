"""Pairing on a live span stream.

A micro-batch is matched together with the spans earlier batches left waiting.
Traces short enough for a task are dealt to tasks and matched there, from one
shuffle; longer ones take the joins the batch operators use, so a trace, a span
id or a parent id of any size is spread and split as in batch. What waits is a
table, replaced batch by batch.

Two memberships are carried per span, because they end at different times:

* ``held``    – the span can be found by its id (a partner or a child may come),
* ``waiting`` – the span has not met its parent yet.

A span id (or a parent id) is forgotten once *all* spans filed under it ended
before stream time minus the interval. There is no lateness check: a late span
still matches whatever is held.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from spanloom import schemas
from spanloom.functions import spans as fs
from spanloom.operators import edges as edge_ops
from spanloom.operators import pairs as pair_ops
from spanloom.operators.spans import IDENTITY, TRACE_SCOPE, dedupe_spans, light_spans
from spanloom.session import small_methods
from spanloom.sources import files, tables

ARRIVAL = ("arrival_batch", "arrival_seq")
CARRIED = T.StructType([
    *schemas.LIGHT_SPAN.fields,
    T.StructField("arrival_batch", T.LongType()),
    T.StructField("held", T.BooleanType()),
    T.StructField("waiting", T.BooleanType()),
])


def arrived(light: DataFrame, batch_id: int) -> DataFrame:
    """New spans as they are carried."""
    new = (
        light.withColumn("arrival_batch", F.lit(batch_id).cast("long"))
        .withColumn("held", F.lit(True))
        .withColumn("waiting", F.col("parent_span_id") != "")
    )
    return new.select(*CARRIED.fieldNames())


def admit(light: DataFrame, carried: DataFrame, batch_id: int, scope: Sequence[str] = TRACE_SCOPE) -> DataFrame:
    """Carried and new spans together, a re-delivered one counted once."""
    return dedupe_spans(carried.unionByName(arrived(light, batch_id)), scope, arrival=ARRIVAL)


def batch_pairs(present: DataFrame, batch_id: int, scope: Sequence[str] = TRACE_SCOPE) -> DataFrame:
    """Complete pairs whose later half arrived in this batch."""
    leaders = pair_ops.leading_holders(present, scope, ARRIVAL, F.col("held"))
    matched = pair_ops.match_ranked(
        pair_ops.rank_holders(present, leaders, scope), scope, arrival=ARRIVAL, complete=True,
        child_open=F.col("waiting"), holder_open=F.col("held"), extra=["arrival_batch"],
    )
    return matched.filter(_is_new(batch_id)).drop("left_arrival_batch", "right_arrival_batch")


def _is_new(batch_id: int) -> Column:
    return F.greatest("left_arrival_batch", "right_arrival_batch") == batch_id


def batch_lookups(spans: DataFrame, batch_id: int, parts: int, scope: Sequence[str] = TRACE_SCOPE) -> DataFrame:
    """The distinct carried and new spans of short traces, their pairs of this batch, and all that ``lookup_evict`` asks for."""
    end = fs.end_time_ms(F.col("time_ms"), F.col("duration_us"))
    lookups = pair_ops.trace_lookups(
        spans, parts, scope, arrival=ARRIVAL, child_open=F.col("waiting"), holder_open=F.col("held"), end=end,
    )
    return pair_ops.spans_and_pairs(lookups, [*CARRIED.fieldNames(), "last_end"], _is_new(batch_id), scope, arrival=ARRIVAL)


def _still_waiting(lookups: DataFrame, cutoff_ms: int, scope: Sequence[str]) -> DataFrame:
    lives = (F.col("kind") == pair_ops.PARENT) & ~F.col("met") & (F.col("last_end") > cutoff_ms)
    return lookups.filter(lives).select(*scope, *IDENTITY)


def lookup_evict(lookups: DataFrame, still_waiting: DataFrame, cutoff_ms: int, scope: Sequence[str] = TRACE_SCOPE) -> DataFrame:
    """``evict`` for the spans of ``batch_lookups``, given those that still wait."""
    lives = F.coalesce(F.col("last_end") > cutoff_ms, F.lit(False))
    return (
        lookups.filter((F.col("kind") == pair_ops.SPAN) & ((F.col("held") & lives) | F.col("waiting")))
        .join(still_waiting.withColumn("_waiting", F.lit(True)), [*scope, *IDENTITY], "left")
        .withColumn("held", F.col("held") & lives)
        .withColumn("waiting", F.col("waiting") & F.col("_waiting").isNotNull())
        .filter(F.col("held") | F.col("waiting"))
        .select(*CARRIED.fieldNames())
    )


def evict(present: DataFrame, cutoff_ms: int, scope: Sequence[str] = TRACE_SCOPE) -> DataFrame:
    """What the next batch has to remember at the given cutoff."""
    outlives = fs.is_later_than(F.col("time_ms"), F.col("duration_us"), cutoff_ms)

    # An id lives on if any of its spans does, so only the spans that outlive the cutoff tell which ids do; those few are looked up again.
    held = present.filter(F.col("held") & outlives).select(*scope, "span_id").distinct()
    waited_for = present.filter(F.col("waiting") & outlives).select(*scope, "parent_span_id").distinct()
    by_parent = [*scope, "parent_span_id"]
    met = present.filter("held").select(*scope, F.col("span_id").alias("parent_span_id")).join(waited_for, by_parent, "left_semi").distinct()
    waiting = waited_for.join(met, by_parent, "left_anti")
    return (
        present.join(held.withColumn("_held", F.lit(True)), [*scope, "span_id"], "left")
        .join(waiting.withColumn("_waiting", F.lit(True)), by_parent, "left")
        .withColumn("held", F.col("held") & F.col("_held").isNotNull())
        .withColumn("waiting", F.col("waiting") & F.col("_waiting").isNotNull())
        .filter(F.col("held") | F.col("waiting"))
        .select(*CARRIED.fieldNames())
    )


@dataclass
class SpanJob:
    """One span stream in; edges, latency points and the merge-style registry out.

    Tables below ``root``: ``edges``, ``latency``, ``registry`` and ``carried``.
    """

    root: str
    interval_ms: int = 2_500
    tag_keys: Sequence[str] = field(default_factory=tuple)
    scope: Sequence[str] = TRACE_SCOPE

    def table(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    def process(self, spans: DataFrame, batch_id: int, stream_ms: int | None = None) -> None:
        """Handle one micro-batch. ``stream_ms`` defaults to the latest start time seen.

        Read several times, the light spans and the matches of short traces are
        written below ``root`` until the batch is done: as files they take a
        fraction of what kept rows do. Long traces are kept as rows.
        """
        spark = spans.sparkSession
        carried = tables.read_batch_before(spark, self.table("carried"), batch_id, CARRIED)
        known = tables.read_batch_before(spark, self.table("registry"), batch_id, schemas.REGISTRY)
        written, kept = self._work(batch_id), []
        try:
            new = written(arrived(light_spans(spans, self.tag_keys), batch_id), "new")
            parts, short, long = pair_ops.dealt_by_trace(carried.unionByName(new), self.scope)
            found, latest = [], []
            if short is not None:
                lookups = written(batch_lookups(short, batch_id, parts, self.scope), "lookups")
                found.append(pair_ops.stored_pairs(lookups, self.scope, arrival=ARRIVAL))
                latest.append(lookups.filter(F.col("kind") == pair_ops.SPAN))
            if long is not None:
                present = dedupe_spans(long, self.scope, arrival=ARRIVAL).persist()
                found.append(batch_pairs(present, batch_id, self.scope).persist())
                kept = [present, found[-1]]
                latest.append(present)
            pairs = found[0] if len(found) == 1 else found[0].unionByName(found[1])
            own = written(pair_ops.shared_registry(pairs), "registry")
            accepted = self._accepted(pairs, known, own)
            tables.write_batch(edge_ops.graph_edges(accepted), self.table("edges"), batch_id)
            tables.write_batch(edge_ops.latency_points(accepted), self.table("latency"), batch_id)
            tables.write_batch(self._registry(known, own), self.table("registry"), batch_id)
            if stream_ms is None:
                stream_ms = max((t for rows in latest if (t := rows.agg(F.max("time_ms")).first()[0]) is not None), default=None)
            left = []
            for rows in latest:
                if stream_ms is None:
                    left.append(rows)
                elif long is not None and rows is present:
                    left.append(evict(rows, stream_ms - self.interval_ms, self.scope))
                else:
                    cutoff = stream_ms - self.interval_ms
                    left.append(lookup_evict(lookups, written(_still_waiting(lookups, cutoff, self.scope), "waiting"), cutoff, self.scope))
            left = [rows.select(*CARRIED.fieldNames()) for rows in left]
            tables.write_batch(left[0] if len(left) == 1 else left[0].unionByName(left[1]), self.table("carried"), batch_id)
        finally:
            for rows in kept:
                rows.unpersist()
            self._work_done(spark, batch_id)
        for name in ("carried", "registry"):
            tables.drop_batches_before(spark, self.table(name), batch_id - 1)

    def _work(self, batch_id: int) -> Callable[[DataFrame, str], DataFrame]:
        """Writes and reads back what a batch uses several times, until ``_work_done``."""
        def written(rows: DataFrame, name: str) -> DataFrame:
            path = self.table(f"_work/{tables.BATCH}={batch_id}/{name}")
            with small_methods(rows.sparkSession):
                rows.write.mode("overwrite").parquet(path)
            return rows.sparkSession.read.schema(rows.schema).parquet(path)

        return written

    def _work_done(self, spark: SparkSession, batch_id: int) -> None:
        files.remove(spark, self.table(f"_work/{tables.BATCH}={batch_id}"))

    def _accepted(self, pairs: DataFrame, known: DataFrame, own: DataFrame | None = None) -> DataFrame:
        """Refuse by what earlier batches registered, then by this batch (``own``) in arrival order."""
        earlier = pair_ops.merge_style_filter(pairs, "final", known)
        return pair_ops.merge_style_filter(earlier, "as_of", own)

    def _registry(self, known: DataFrame, own: DataFrame) -> DataFrame:
        """A service stays registered with the moment it was first known."""
        return (
            known.unionByName(own)
            .groupBy("service_name")
            .agg(F.lit(True).alias("use_shared_span"), F.min("first_shared_seq").alias("first_shared_seq"))
        )

    def start(self, spans: DataFrame, checkpoint: str, **trigger) -> StreamingQuery:
        """Run on a stream of raw spans, e.g. ``availableNow=True`` or ``processingTime="3 seconds"``."""
        return (
            spans.writeStream.foreachBatch(self.process)
            .option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"processingTime": "3 seconds"}))
            .start()
        )
