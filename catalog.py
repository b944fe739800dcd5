"""The registered queries: each operator run over the whole driver tables.

Maps and structs are flattened so that results compare column by column.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

import testbed as tb
from spanloom.functions import spans as fs
from spanloom.functions import times
from spanloom.operators import edges as edge_ops
from spanloom.operators import generations, intervals
from spanloom.operators import pairs as pair_ops
from spanloom.operators import snapshots as snap_ops
from spanloom.operators import spans as span_ops
from spanloom.operators import stats
from spanloom.plans import graph, jobs, rollups
from spanloom.session import configure, scratch_path, written_once
from spanloom.sources import chains, graph_json, protobuf, tables
from spanloom.sources import snapshots as snap_io
from spanloom.sources import spans as span_io
from spanloom import schemas
from spanloom.streaming import keyed, pairing, windows

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
HOUR_MS = 3_600_000
INTERVAL_MS = 150


def query(function: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return function(configure(spark), sf_dir)

    QUERIES[function.__name__] = run
    return function


def tags_text(tags: Column) -> Column:
    """A tag map as ``key=value`` parts in key order."""
    parts = F.transform(F.map_entries(tags), lambda e: F.concat(e["key"], F.lit("="), e["value"]))
    return F.array_join(F.sort_array(parts), ";")


def flat_tags(rows: DataFrame) -> DataFrame:
    tags = [c for c, kind in rows.dtypes if kind.startswith("map")]
    return rows.withColumns({c: tags_text(F.col(c)) for c in tags})


# --- one span -------------------------------------------------------------------------------------------------------

def _marked_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with every mix of the four role events, odd spellings, and a kind tag on some."""
    key = F.col("o_orderkey")
    at = F.lit(tb.BASE_US) + (key % 86400) * 1_000_000

    def log(bit: int, event: str, offset: int) -> Column:
        name = F.when(key % 3 == 0, F.upper(F.lit(event))).otherwise(event)
        label = F.when(key % 5 == 0, "EVENT").otherwise("event")
        fields = F.array(
            F.struct(F.lit("event").alias("key"), F.lit("").alias("v_str")),
            F.struct(label.alias("key"), name.alias("v_str")),
        )
        return F.when(key.bitwiseAND(F.lit(bit)) > 0, F.struct((at + offset).alias("timestamp"), fields.alias("fields")))

    kind = F.when(F.col("o_orderstatus") == "F", "Client").when(F.col("o_orderstatus") == "O", "server").otherwise("producer")
    tags = F.array(
        F.struct(F.lit("Span.Kind").alias("key"), F.lit("client").alias("v_str")),
        F.struct(F.lit("span.kind").alias("key"), kind.alias("v_str")),
        F.struct(F.lit("span.kind").alias("key"), F.lit("client").alias("v_str")),
    )
    logs = F.array_compact(F.array(log(1, "cs", 0), log(2, "cr", 40), log(4, "ss", 30), log(8, "sr", 10)))
    return tb.table(spark, sf_dir, "orders").select(key, logs.alias("logs"), tags.alias("tags"))


@query
def accumulable_filter(spark, sf_dir):
    """Events as spans; some ids, names and start times are blank or missing."""
    key = F.col("event_id")
    spans = tb.table(spark, sf_dir, "events").select(
        key,
        F.when(key % 7 == 0, " \t").when(key % 7 == 1, "").otherwise(key.cast("string")).alias("span_id"),
        F.when(key % 11 != 0, F.col("event_type")).alias("service_name"),
        F.when(key % 13 == 0, "\n").otherwise("op").alias("operation_name"),
        F.when(key % 17 == 0, 0).when(key % 17 == 1, -5).otherwise(key + 1).cast("long").alias("start_us"),
    )
    return span_ops.accumulable_filter(spans).select("event_id", "span_id", "service_name", "operation_name", "start_us")


@query
def span_type(spark, sf_dir):
    return _marked_orders(spark, sf_dir).select(
        "o_orderkey", fs.event_bits(F.col("logs")).alias("bits"), fs.span_type(F.col("logs"), F.col("tags")).alias("span_type")
    )


@query
def event_timestamp(spark, sf_dir):
    logs = F.col("logs")
    return _marked_orders(spark, sf_dir).select(
        "o_orderkey", *[fs.event_timestamp(logs, e.upper()).alias(f"at_{e}") for e in ("cs", "cr", "ss", "sr")]
    )


@query
def light_span(spark, sf_dir):
    return flat_tags(tb.spans(spark, sf_dir))


@query
def span_source_protobuf(spark, sf_dir):
    """Light spans of protobuf messages, some of which come damaged first."""
    decoded = protobuf.decode_messages(tb.span_messages(spark, sf_dir), arrival=F.col("offset"))
    return flat_tags(span_ops.light_spans(protobuf.spans_of(decoded), tb.TAG_KEYS))


@query
def span_source_damaged(spark, sf_dir):
    """Messages that gave no span."""
    decoded = protobuf.decode_messages(tb.span_messages(spark, sf_dir), arrival=F.col("offset"))
    return protobuf.damaged_of(decoded).groupBy("wrong").agg(F.count(F.lit(1)).alias("messages"))


@query
def collect_tags(spark, sf_dir):
    raw = tb.raw_spans(spark, sf_dir)
    tags = fs.collect_tags(F.col("tags"), ["tier", "http.url"])
    return raw.select("trace_id", "span_id", "service_name", tags_text(tags).alias("tags"))


@query
def is_later_than(spark, sf_dir):
    """End times, and which spans outlive a cutoff taken from their own trace."""
    cutoff = F.col("time_ms") + F.col("arrival_seq") % 300
    return tb.spans(spark, sf_dir).select(
        "trace_id", "span_id", "service_name",
        fs.end_time_ms(F.col("time_ms"), F.col("duration_us")).alias("end_ms"),
        fs.is_later_than(F.col("time_ms"), F.col("duration_us"), cutoff).cast("int").alias("later"),
    )


@query
def dedupe_spans(spark, sf_dir):
    distinct = span_ops.dedupe_spans(tb.delivered_lines(spark, sf_dir))
    return distinct.select("trace_id", "span_id", "parent_span_id", "service_name", "arrival_seq", "duration_us")


@query
def default_role(spark, sf_dir):
    role = F.col("span_type")
    return tb.spans(spark, sf_dir).select(
        "trace_id", "span_id", "service_name",
        fs.default_role(role, fs.CLIENT).alias("as_parent"), fs.default_role(role, fs.SERVER).alias("as_child"),
    )


@query
def align_from(spark, sf_dir):
    at = F.unix_millis(F.col("ts").cast("timestamp"))
    return tb.table(spark, sf_dir, "events").select(
        "event_id", times.align_from(at, 300_000).alias("from_300s"), times.align_from(at, 1_800_000).alias("from_1800s")
    )


@query
def snapshot_name(spark, sf_dir):
    at = F.unix_millis(F.col("ts").cast("timestamp"))
    return tb.table(spark, sf_dir, "events").select("event_id", times.snapshot_name(at).alias("name"))


# --- pairs ----------------------------------------------------------------------------------------------------------

_PAIR = ["trace_id", "client_span_id", "client_service", "server_span_id", "server_service", "emit_seq"]


@query
def shared_span_pairs(spark, sf_dir):
    return pair_ops.shared_span_pairs(tb.spans(spark, sf_dir)).select(*_PAIR)


@query
def parent_child_pairs(spark, sf_dir):
    return pair_ops.parent_child_pairs(tb.spans(spark, sf_dir)).select(*_PAIR)


@query
def complete_filter(spark, sf_dir):
    """Services merged by region, so that some calls stay inside one service."""
    region = F.concat(F.lit("svc-"), F.length("service_name"))
    spans = tb.spans(spark, sf_dir).withColumn("service_name", region)
    return pair_ops.complete_filter(pair_ops.span_pairs(spans)).select(*_PAIR, F.col("shared").cast("int").alias("shared"))


@query
def merge_style_filter(spark, sf_dir):
    return pair_ops.accepted_pairs(tb.spans(spark, sf_dir)).select(*_PAIR, F.col("shared").cast("int").alias("shared"))


@query
def merge_style_filter_final(spark, sf_dir):
    pairs = pair_ops.complete_filter(pair_ops.span_pairs(tb.spans(spark, sf_dir)))
    accepted = pair_ops.merge_style_filter(pairs, "final")
    return accepted.select(*_PAIR, F.col("shared").cast("int").alias("shared"))


@query
def shared_registry(spark, sf_dir):
    pairs = pair_ops.complete_filter(pair_ops.shared_span_pairs(tb.spans(spark, sf_dir)))
    return pair_ops.shared_registry(pairs).select(
        "service_name", F.col("use_shared_span").cast("int").alias("use_shared_span"), "first_shared_seq"
    )


@query
def pair_window(spark, sf_dir):
    pairs = pair_ops.complete_filter(pair_ops.span_pairs(tb.spans(spark, sf_dir)))
    return pair_ops.within_interval(pairs, INTERVAL_MS).select(*_PAIR)


@query
def pair_window_generations(spark, sf_dir):
    """Pairs where ids come again after the interval, or before it is over."""
    return generations.window_pairs(tb.reused_spans(spark, sf_dir), 2_500, width_ms=10_000).select(
        *_PAIR, "client_time_ms", "server_time_ms", F.col("shared").cast("int").alias("shared")
    )


# --- edges and statistics -------------------------------------------------------------------------------------------

def _edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edge_ops.graph_edges(pair_ops.accepted_pairs(tb.spans(spark, sf_dir), by_trace=True))


def _windowed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.edge_stats(_edges(spark, sf_dir), tb.WINDOW_MS, tb.NOW_MS)


def _effective(windowed: DataFrame) -> DataFrame:
    return windowed.withColumn("effective_from", F.col("window_start")).withColumn("effective_to", F.col("window_end"))


@query
def graph_edges(spark, sf_dir):
    return flat_tags(_edges(spark, sf_dir))


@query
def latency_points(spark, sf_dir):
    points = edge_ops.latency_points(pair_ops.accepted_pairs(tb.spans(spark, sf_dir)))
    return flat_tags(points.withColumn("value", F.col("value").cast("long")))


@query
def edge_constraints(spark, sf_dir):
    """Order lines as edges, some without a name or a count; both halves of the split are counted."""
    key = F.col("l_orderkey")
    edges = tb.table(spark, sf_dir, "lineitem").select(
        F.when(key % 9 != 0, F.concat(F.lit("c"), F.col("l_suppkey"))).otherwise("").alias("source"),
        F.when(key % 10 != 0, F.concat(F.lit("p"), F.col("l_partkey") % 50)).alias("destination"),
        F.col("l_returnflag").alias("operation"),
        F.when(F.col("l_linenumber") != 7, F.col("l_linenumber").cast("long")).alias("count"),
    )
    valid, quarantined = edge_ops.edge_constraints(edges)

    def counted(rows: DataFrame, verdict: str) -> DataFrame:
        return rows.groupBy("operation", F.lit(verdict).alias("verdict")).agg(F.count(F.lit(1)).alias("edges"))

    return counted(valid, "valid").unionByName(counted(quarantined, "quarantined"))


@query
def edge_stats(spark, sf_dir):
    return flat_tags(_windowed(spark, sf_dir))


@query
def edge_tags_last(spark, sf_dir):
    return stats.edge_tags_last(_edges(spark, sf_dir), tb.WINDOW_MS)


@query
def service_graph_merge(spark, sf_dir):
    return flat_tags(stats.service_graph_merge(_effective(_windowed(spark, sf_dir))))


@query
def operation_graph_merge(spark, sf_dir):
    return flat_tags(stats.operation_graph_merge(_effective(_windowed(spark, sf_dir))))


@query
def tag_union(spark, sf_dir):
    return stats.tag_union(_effective(_windowed(spark, sf_dir)))


@query
def tag_union_values(spark, sf_dir):
    """The union of tag values with a row per value."""
    return stats.tag_union_values(_effective(_windowed(spark, sf_dir)))


# --- graph queries --------------------------------------------------------------------------------------------------

def _service_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.service_graph(_windowed(spark, sf_dir), tb.WINDOW_MS, tb.NOW_MS)


@query
def operation_graph(spark, sf_dir):
    return flat_tags(graph.operation_graph(_windowed(spark, sf_dir), tb.WINDOW_MS, tb.NOW_MS))


@query
def service_graph(spark, sf_dir):
    return flat_tags(_service_graph(spark, sf_dir))


@query
def service_graph_range(spark, sf_dir):
    """The graph between two instants, the lower one inside a window."""
    windowed = _windowed(spark, sf_dir)
    lower, upper = tb.BASE_MS + 1_234_567, tb.BASE_MS + 9_000_000
    return flat_tags(graph.service_graph(windowed, tb.WINDOW_MS, tb.BASE_MS + 9_100_000, lower, upper))


@query
def graph_views(spark, sf_dir):
    """SQL over both views."""
    graph.register_graph_views(_windowed(spark, sf_dir), tb.WINDOW_MS, tb.NOW_MS)
    return spark.sql("""
        SELECT s.source, s.destination, s.count AS calls, o.operations, o.windows
        FROM servicegraph s JOIN (
          SELECT source, destination, count(DISTINCT operation) AS operations, count(DISTINCT effective_from) AS windows
          FROM operationgraph GROUP BY source, destination
        ) o ON s.source = o.source AND s.destination = o.destination
    """)


RANGE = (tb.BASE_MS + 1_234_567, tb.BASE_MS + 61_234_567)


@query
def service_graph_rollup(spark, sf_dir):
    """The graph of an odd range from roll-ups; every fifth window came late and had its ancestors repaired."""
    table, written = scratch_path(spark, "rollups"), scratch_path(spark, "all-windowed")
    _windowed(spark, sf_dir).write.parquet(written)
    windowed = spark.read.schema(schemas.WINDOWED_EDGE).parquet(written)
    starts = [r.window_start for r in windowed.select("window_start").distinct().collect()]  # windows of a day
    late = {s for s in starts if s // tb.WINDOW_MS % 5 == 2}
    before = windowed.where(F.floor(F.col("window_start") / tb.WINDOW_MS) % 5 != 2)
    rollups.update_rollups(before, table, tb.WINDOW_MS, set(starts) - late, levels=8)
    rollups.update_rollups(windowed, table, tb.WINDOW_MS, late, levels=8)
    return flat_tags(rollups.rollup_service_graph(spark, table, tb.WINDOW_MS, RANGE[1] + 100_000, *RANGE, levels=8))


def _functions(spark: SparkSession, sf_dir: str) -> None:
    table = scratch_path(spark, "windowed")
    windows.write_windowed_edges(_windowed(spark, sf_dir), table)
    graph.register_graph_functions(windows.read_windowed_edges(spark, table), tb.WINDOW_MS, tb.NOW_MS)


@query
def graph_function_services(spark, sf_dir):
    """The service graph of a range and of the last 24 hours, asked for in SQL."""
    _functions(spark, sf_dir)
    found = spark.sql(f"SELECT 'range' AS asked, * FROM servicegraph({RANGE[0]}, {RANGE[1]}) UNION ALL SELECT 'day', * FROM servicegraph()")
    return flat_tags(found)


@query
def graph_function_operations(spark, sf_dir):
    """The operation graph since an instant, asked for in SQL."""
    _functions(spark, sf_dir)
    return flat_tags(spark.sql(f"SELECT * FROM operationgraph(from_ms => {RANGE[0]})"))


@query
def edge_count_metric(spark, sf_dir):
    """The number of edges each graph query returns, as observed while it runs."""
    counts, written = [], scratch_path(spark, "all-windowed")
    _windowed(spark, sf_dir).write.parquet(written)
    windowed = spark.read.schema(schemas.WINDOWED_EDGE).parquet(written)
    for name, edges in (("servicegraph", graph.service_graph(windowed, tb.WINDOW_MS, tb.NOW_MS)), (
        "operationgraph", graph.operation_graph(windowed, tb.WINDOW_MS, tb.NOW_MS)
    )):
        observed, metric = graph.with_edge_count(edges, name)
        observed.write.format("noop").mode("overwrite").save()
        counts.append(spark.range(1).select(F.lit(name).alias("graph"), F.lit(metric.get["edges"]).cast("long").alias("edges")))
    return counts[0].unionByName(counts[1])


# --- snapshots ------------------------------------------------------------------------------------------------------

def _numbered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The service graph with tier and provider per vertex, numbered by name."""
    return snap_ops.number_edges(snap_ops.node_columns(_service_graph(spark, sf_dir)))


def _hourly(spark: SparkSession, sf_dir: str, hours: tuple[int, ...]) -> snap_io.SnapshotStore:
    """Snapshots of the windowed edges taken at the given hours of the day, each over the whole time before it."""
    scratch = scratch_path(spark, "windowed")
    windows.write_windowed_edges(_windowed(spark, sf_dir), scratch)
    store = snap_io.SnapshotStore(spark, scratch_path(spark, "snapshots"))
    for hour in hours:
        jobs.run_snapshot_job(store, scratch, tb.BASE_MS + hour * HOUR_MS, tb.WINDOW_MS, span_ms=times.DAY_MS)
    return store


@query
def node_dimension(spark, sf_dir):
    return snap_ops.node_dimension(_numbered(spark, sf_dir))


@query
def edge_fact(spark, sf_dir):
    edges = _numbered(spark, sf_dir)
    return snap_ops.edge_fact(edges, snap_ops.node_dimension(edges))


@query
def snapshot_edge_join(spark, sf_dir):
    edges = _numbered(spark, sf_dir)
    nodes = snap_ops.node_dimension(edges)
    return snap_ops.snapshot_edge_join(snap_ops.edge_fact(edges, nodes), nodes)


@query
def snapshot_as_of(spark, sf_dir):
    """Errors as the moments a snapshot was taken; for every event the latest one so far."""
    at = F.unix_millis(F.col("ts").cast("timestamp"))
    events = tb.table(spark, sf_dir, "events")
    taken = events.filter(F.col("event_type") == "error").select(at.alias("snapshot_ms"))
    return snap_ops.snapshot_as_of(taken, events.select(at.alias("instant_ms")))


@query
def snapshot_write(spark, sf_dir):
    """Row counts of the stored tables."""
    store = _hourly(spark, sf_dir, (1, 2, 4))
    def counted(rows, name):
        return rows.groupBy("snapshot_ts").agg(F.count(F.lit(1)).alias("rows")).select("snapshot_ts", F.lit(name).alias("part"), "rows")
    return counted(store.nodes(), "nodes").unionByName(counted(store.edges(), "edges"))


@query
def snapshot_read(spark, sf_dir):
    """Read between two snapshots: the earlier one comes back."""
    store = _hourly(spark, sf_dir, (1, 2, 4))
    found = store.read(tb.BASE_MS + 3 * HOUR_MS)
    return found.select(*[c for c in found.columns if c not in ("snapshot_ts", "edge_id")])


@query
def snapshot_purge(spark, sf_dir):
    """Purge two of three snapshots; what is left, and how many items went."""
    store = _hourly(spark, sf_dir, (1, 2, 4))
    purged = store.purge(tb.BASE_MS + 2 * HOUR_MS)
    return store.edges().groupBy("snapshot_ts").agg(F.count(F.lit(1)).alias("edges"), F.lit(purged).cast("long").alias("purged"))


@query
def snapshot_job(spark, sf_dir):
    """One run of the job: graph of the last hour, written and read back."""
    scratch = scratch_path(spark, "windowed")
    windows.write_windowed_edges(_windowed(spark, sf_dir), scratch)
    store = snap_io.SnapshotStore(spark, scratch_path(spark, "snapshots"), format="parquet")
    now = tb.BASE_MS + 2 * HOUR_MS
    name, purged = jobs.run_snapshot_job(store, scratch, now, tb.WINDOW_MS, purge_age_ms=HOUR_MS)
    graph_rows = store.read(now)
    return graph_rows.select(
        F.lit(name).alias("name"), F.lit(purged).cast("long").alias("purged"), "source", "destination", "count", "error_count"
    )


@query
def snapshot_history(spark, sf_dir):
    """Edge changes between the snapshots of hour 1 and hour 4."""
    store = _hourly(spark, sf_dir, (1, 4))
    before, after = (store.read(tb.BASE_MS + hour * HOUR_MS) for hour in (1, 4))
    return snap_ops.snapshot_history(before, after)


CHAIN_HOURS = tuple(range(2, 25, 2))


def _chain(spark: SparkSession, sf_dir: str) -> chains.SnapshotChain:
    """24 snapshots: the graph of the last three hours every other hour, stored again half an hour later. At the end of the day nothing is left of it."""
    written = scratch_path(spark, "all-windowed")
    _windowed(spark, sf_dir).write.parquet(written)
    windowed = spark.read.schema(schemas.WINDOWED_EDGE).parquet(written)
    chain = chains.SnapshotChain(spark, scratch_path(spark, "chain"), base_every=5)
    for hour in CHAIN_HOURS:
        now = tb.BASE_MS + hour * HOUR_MS
        found = graph.service_graph(windowed, tb.WINDOW_MS, now, now - 3 * HOUR_MS, now)
        for instant in (now, now + HOUR_MS // 2):
            chain.write(found, instant)
    return chain


@query
def snapshot_chain_read(spark, sf_dir):
    """The graph as of an instant between two of 24 chained snapshots."""
    return _chain(spark, sf_dir).read(tb.BASE_MS + 5 * HOUR_MS)


@query
def snapshot_chain_changes(spark, sf_dir):
    """Rows that each snapshot of the chain stored."""
    chain = _chain(spark, sf_dir)
    stored = chain.changes().groupBy("snapshot_ts").agg(F.count(F.lit(1)).alias("stored"), F.count_if("gone").alias("gone"))
    return chain.name_table().join(stored, "snapshot_ts", "left").na.fill(0)


@query
def snapshot_intervals(spark, sf_dir):
    """Validity intervals of every edge over 24 snapshots."""
    chain = _chain(spark, sf_dir)
    return intervals.validity_intervals(chain.history(), chain.name_table())


@query
def snapshot_csv_write(spark, sf_dir):
    """The node table of a CSV snapshot, read as a plain file."""
    store = snap_io.SnapshotStore(spark, scratch_path(spark, "snapshots"))
    nodes_path, _ = store.write(_service_graph(spark, sf_dir), tb.NOW_MS)
    return snap_io.read_nodes_csv(spark, nodes_path)


@query
def snapshot_csv_read(spark, sf_dir):
    """The typed edge table of a CSV snapshot."""
    store = snap_io.SnapshotStore(spark, scratch_path(spark, "snapshots"))
    store.write(_service_graph(spark, sf_dir), tb.NOW_MS)
    return store.edges().drop("snapshot_ts")


@query
def graph_json_write(spark, sf_dir):
    """One JSON object per edge."""
    return graph_json.graph_json(_service_graph(spark, sf_dir))


@query
def graph_json_read(spark, sf_dir):
    """The graph written as JSON and read again."""
    path = scratch_path(spark, "graph-json")
    graph_json.write_graph_json(_service_graph(spark, sf_dir), path)
    return flat_tags(graph_json.read_edge_lines(spark, path))


# --- streams --------------------------------------------------------------------------------------------------------

#: Spans a micro-batch takes at most, about; a stream of more has more batches, and what one of them shuffles and keeps does not grow with the tables.
BATCH_SPANS = 4_000_000
#: Spans that a file of a micro-batch and a key of the keyed job have, about; there are more of both where there are more spans.
FILE_SPANS, KEY_SPANS = 100_000, 1_000


def _sent(spark: SparkSession, sf_dir: str) -> int:
    """Orders and order lines, about as many as there are spans."""
    return sum(tb.table(spark, sf_dir, name).count() for name in ("orders", "lineitem"))


def _files(spark: SparkSession, sf_dir: str, batches: int) -> int:
    """Files to a micro-batch, so that no task reads or writes more of it on larger tables."""
    return max(4, _sent(spark, sf_dir) // (batches * FILE_SPANS))


def _span_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw spans as a stream of files in order of arrival, several files to a batch; the spans of an order come together."""
    path, files = scratch_path(spark, "spans"), 8
    orders = tb.table(spark, sf_dir, "orders")
    found = orders.agg(F.count(F.lit(1)), F.max("o_orderkey")).first()
    batches = -(-(found[0] + tb.table(spark, sf_dir, "lineitem").count()) // BATCH_SPANS)
    if batches <= 1:
        tb.raw_spans(spark, sf_dir).repartitionByRange(files, "arrival_seq").write.parquet(path)
        return span_io.stream_spans(spark, path)
    width = found[1] // batches + 1
    return _fed(spark, tb.raw_spans(spark, sf_dir).withColumn("batch", F.floor(F.col("arrival_seq") / (16 * width))), batches, files)


def _arriving(spark: SparkSession, sf_dir: str, batches: int) -> DataFrame:
    """The raw spans as a stream of ``batches`` micro-batches in order of arrival, several files to each."""
    path, written, files = scratch_path(spark, "spans"), scratch_path(spark, "all-spans"), 8
    tb.raw_spans(spark, sf_dir).write.parquet(written)
    spans = spark.read.schema(schemas.SPAN).parquet(written)
    last = spans.agg(F.max("arrival_seq")).first()[0] or 0
    width = last // batches + 1
    for i in range(batches):  # one batch after the other, as a stream takes files by their time
        spans.where(F.floor(F.col("arrival_seq") / width) == i).repartition(files).write.mode("append").parquet(path)
    return span_io.stream_spans(spark, path, max_files=files)


def _fed(spark: SparkSession, rows: DataFrame, batches: int, files: int = 4) -> DataFrame:
    """Raw spans as a stream of one micro-batch per value of ``batch``, several files to each."""
    path, written = scratch_path(spark, "spans"), scratch_path(spark, "all-spans")
    rows.write.partitionBy("batch").parquet(written)
    spans = spark.read.schema(rows.schema).parquet(written)
    for i in range(batches):  # in turn, as a stream takes files by their time, and as many files each as it takes at once; only a batch's own rows are read
        spans.where(F.col("batch") == i).drop("batch").repartition(files).write.mode("append").parquet(path)
    return span_io.stream_spans(spark, path, max_files=files)


def _ran(query_handle) -> None:
    query_handle.awaitTermination()


def _span_job(spark: SparkSession, sf_dir: str) -> pairing.SpanJob:
    job = pairing.SpanJob(scratch_path(spark, "job"), interval_ms=2_500, tag_keys=tb.TAG_KEYS)
    _ran(job.start(_span_stream(spark, sf_dir), scratch_path(spark, "checkpoint"), availableNow=True))
    return job


def _table(spark: SparkSession, job: pairing.SpanJob, name: str, schema) -> DataFrame:
    return tables.read_table(spark, job.table(name), schema)


@query
def span_source(spark, sf_dir):
    """Spans counted on their way through the streaming source."""
    counted = scratch_path(spark, "counted")

    def count(rows: DataFrame, batch_id: int) -> None:
        tables.write_batch(rows.groupBy("service_name").agg(F.count(F.lit(1)).alias("spans")), counted, batch_id)

    _ran(_span_stream(spark, sf_dir).writeStream.foreachBatch(count)
         .option("checkpointLocation", scratch_path(spark, "checkpoint")).trigger(availableNow=True).start())
    return spark.read.parquet(counted).groupBy("service_name").agg(F.sum("spans").alias("spans"))


@query
def span_pairs_stream(spark, sf_dir):
    """Edges of the streaming span job."""
    return flat_tags(_table(spark, _span_job(spark, sf_dir), "edges", schemas.EDGE))


@query
def span_pairs_stream_batches(spark, sf_dir):
    """Edges of the streaming span job over four micro-batches, with all spans remembered."""
    job = pairing.SpanJob(scratch_path(spark, "job"), interval_ms=10 * times.DAY_MS, tag_keys=tb.TAG_KEYS)
    _ran(job.start(_arriving(spark, sf_dir, 4), scratch_path(spark, "checkpoint"), availableNow=True))
    return flat_tags(_table(spark, job, "edges", schemas.EDGE))


@query
def late_spans(spark, sf_dir):
    """All order lines arrive a batch after the orders, far behind stream time, and still match."""
    job = pairing.SpanJob(scratch_path(spark, "job"), interval_ms=10 * times.DAY_MS, tag_keys=tb.TAG_KEYS)
    raw = tb.raw_spans(spark, sf_dir)
    is_order = F.col("arrival_seq") % 16 == 0
    job.process(raw.filter(is_order), 0)
    job.process(raw.filter(~is_order), 1)
    return flat_tags(_table(spark, job, "edges", schemas.EDGE))


@query
def dedupe_spans_stream(spark, sf_dir):
    """Lines delivered again within the horizon of ten days, and once more after orders of a month later have moved the watermark past it."""
    light = written_once(tb.spans(spark, sf_dir), "all-light")  # five batches are made of it
    is_line, key = F.col("arrival_seq") % 16 > 0, F.col("trace_id").cast("long")
    later = lambda rows, days: rows.withColumn("time_ms", F.col("time_ms") + days * times.DAY_MS)
    lines = light.where(is_line)
    feed = [lines, lines.where(key % 2 == 0)]
    # A batch forgets by the watermark of the batches before it, after it has taken its own rows: the orders come in two.
    feed += [later(light.where(~is_line & (key % 2 == half)), 30) for half in (0, 1)]
    feed.append(later(lines.where(key % 3 == 0), 40))
    path, out = (scratch_path(spark, n) for n in ("light", "distinct"))
    files = _files(spark, sf_dir, 1)  # the first batch has all lines
    for rows in feed:
        rows.repartition(files).write.mode("append").parquet(path)
    stream = spark.readStream.schema(schemas.LIGHT_SPAN).option("maxFilesPerTrigger", files).parquet(path)
    distinct = span_ops.dedupe_spans_stream(stream.drop("tags"), "10 days")
    _ran(distinct.writeStream.format("parquet").option("path", out).option("checkpointLocation", scratch_path(spark, "checkpoint")).trigger(availableNow=True).start())
    return spark.read.schema(distinct.schema).parquet(out)


def _keyed_job(spark: SparkSession, sf_dir: str, interval_ms: int) -> keyed.KeyedSpanJob:
    """The keyed job, traces of nine spans at most dealt to keys of ``KEY_SPANS``: all batches of these streams touch most of what is held."""
    groups = _sent(spark, sf_dir) // KEY_SPANS + 1
    return keyed.KeyedSpanJob(scratch_path(spark, "job"), interval_ms=interval_ms, tag_keys=tb.TAG_KEYS, sub_keys=1, groups=groups)


@query
def late_spans_stream(spark, sf_dir):
    """All order lines come a micro-batch after the orders and still match, with keyed state."""
    is_line = (F.col("arrival_seq") % 16 > 0).cast("long")
    job = _keyed_job(spark, sf_dir, 10 * times.DAY_MS)
    feed = _fed(spark, tb.raw_spans(spark, sf_dir).withColumn("batch", is_line), 2, _files(spark, sf_dir, 2))
    _ran(job.start(feed, scratch_path(spark, "checkpoint"), availableNow=True))
    return flat_tags(_table(spark, job, "edges", schemas.EDGE))


@query
def state_eviction_stream(spark, sf_dir):
    """Edges of the keyed span job over seven micro-batches; spans that ended 2.5 s before stream time are forgotten."""
    job = _keyed_job(spark, sf_dir, 2_500)
    feed = _fed(spark, tb.delayed_spans(spark, sf_dir), tb.FEED_BATCHES, _files(spark, sf_dir, tb.FEED_BATCHES))
    _ran(job.start(feed, scratch_path(spark, "checkpoint"), availableNow=True))
    return flat_tags(_table(spark, job, "edges", schemas.EDGE))


@query
def state_eviction(spark, sf_dir):
    """What is remembered of all spans at a cutoff; some parents never came."""
    orphaned = (F.col("parent_span_id") != "") & (F.col("arrival_seq") % 2 == 1)
    light = tb.spans(spark, sf_dir).withColumn(
        "parent_span_id", F.when(orphaned, F.concat(F.lit("X"), F.col("trace_id"))).otherwise(F.col("parent_span_id"))
    )
    present = pairing.admit(light, spark.createDataFrame([], pairing.CARRIED), 0)
    kept = pairing.evict(present, tb.BASE_MS + 500_000)
    return kept.select(
        "trace_id", "span_id", "service_name", F.col("held").cast("int").alias("held"), F.col("waiting").cast("int").alias("waiting")
    )


@query
def fanout(spark, sf_dir):
    """Row counts of the three tables the span job feeds."""
    job = _span_job(spark, sf_dir)
    counts = None
    registry = tables.read_batch_before(spark, job.table("registry"), 1 << 40, schemas.REGISTRY)
    parts = {"edges": _table(spark, job, "edges", schemas.EDGE), "latency": _table(spark, job, "latency", schemas.LATENCY), "registry": registry}
    for name, table in parts.items():
        rows = table.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("part"), "rows")
        counts = rows if counts is None else counts.unionByName(rows)
    return counts


@query
def metric_sink(spark, sf_dir):
    points = _table(spark, _span_job(spark, sf_dir), "latency", schemas.LATENCY)
    return flat_tags(points.withColumn("value", F.col("value").cast("long")))


@query
def registry_sink(spark, sf_dir):
    """The registry the span job left."""
    job = _span_job(spark, sf_dir)
    last = tables.read_batch_before(spark, job.table("registry"), 1 << 40, schemas.REGISTRY)
    return last.withColumn("use_shared_span", F.col("use_shared_span").cast("int"))


@query
def registry_source(spark, sf_dir):
    """Pairs checked against the registry table the span job wrote."""
    job = _span_job(spark, sf_dir)
    known = tables.read_batch_before(spark, job.table("registry"), 1 << 40, schemas.REGISTRY)
    accepted = pair_ops.accepted_pairs(tb.spans(spark, sf_dir), mode="final", registry=known, by_trace=True)
    return accepted.select(*_PAIR, F.col("shared").cast("int").alias("shared"))


def _written_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The edges, derived once for all their uses."""
    written = scratch_path(spark, "all-edges")
    _edges(spark, sf_dir).write.parquet(written)
    return spark.read.schema(schemas.EDGE).parquet(written)


def _stored_edges(spark: SparkSession, sf_dir: str) -> str:
    path = scratch_path(spark, "edges")
    tables.write_batch(_edges(spark, sf_dir), path, 0)
    return path


@query
def edge_sink(spark, sf_dir):
    """Edges read back from their table."""
    return flat_tags(tables.read_table(spark, _stored_edges(spark, sf_dir), schemas.EDGE))


@query
def edge_source(spark, sf_dir):
    """Edges per hour of event time, counted from the stream over their table."""
    counted = scratch_path(spark, "counted")
    stream = tables.stream_table(spark, _stored_edges(spark, sf_dir), schemas.EDGE)
    timed = stream.withColumn("event_time", F.timestamp_millis("source_timestamp")).withWatermark("event_time", "7 days")
    counts = timed.groupBy(F.window("event_time", "1 hour")).agg(F.count(F.lit(1)).alias("edges"))
    hours = counts.select(F.unix_millis("window.start").alias("hour_ms"), "edges")
    _ran(hours.writeStream.outputMode("update").foreachBatch(lambda rows, batch_id: tables.write_batch(rows, counted, batch_id))
         .option("checkpointLocation", scratch_path(spark, "checkpoint")).trigger(availableNow=True).start())
    return spark.read.parquet(counted).groupBy("hour_ms").agg(F.max("edges").alias("edges"))


def _streamed_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Edges through their table, the stream over it and the windowed aggregation; the current state at the end."""
    table = scratch_path(spark, "windowed")
    stream = tables.stream_table(spark, _stored_edges(spark, sf_dir), schemas.EDGE)
    _ran(windows.start_windowed_edges(stream, table, scratch_path(spark, "checkpoint"), tb.TAG_KEYS, availableNow=True))
    return windows.latest_windowed_edges(spark, table)


@query
def tumbling_window(spark, sf_dir):
    return flat_tags(_streamed_windows(spark, sf_dir).drop("window_date"))


@query
def latest_state_view(spark, sf_dir):
    """The service graph over the table the stream keeps."""
    return flat_tags(graph.service_graph(_streamed_windows(spark, sf_dir), tb.WINDOW_MS, tb.NOW_MS))


def _windows_in_batches(spark: SparkSession, sf_dir: str, **options) -> str:
    """The windowed table of a stream that takes the edges in four batches; all tags are kept."""
    path, table = scratch_path(spark, "edges"), scratch_path(spark, "windowed")
    edges, files = _written_edges(spark, sf_dir), 8
    for part in range(4):
        tables.write_batch(edges.where(F.pmod(F.floor(F.col("emit_seq") / 16), F.lit(4)) == part).repartition(files), path, part)
    stream = tables.stream_table(spark, path, schemas.EDGE, max_files=files)
    _ran(windows.start_windowed_edges(stream, table, scratch_path(spark, "checkpoint"), availableNow=True, **options))
    return table


@query
def tumbling_window_batches(spark, sf_dir):
    """Windowed edges with all tags after four micro-batches."""
    return flat_tags(windows.read_windowed_edges(spark, _windows_in_batches(spark, sf_dir)).drop("window_date"))


@query
def windowed_compaction(spark, sf_dir):
    """The same with the versions of a day merged whenever there are two."""
    table = _windows_in_batches(spark, sf_dir, versions_per_day=1)
    return flat_tags(windows.read_windowed_edges(spark, table).drop("window_date"))


@query
def windowed_retention(spark, sf_dir):
    """A table of all days of the events, of which days before the 15th are dropped."""
    table = scratch_path(spark, "windowed")
    at = F.unix_millis(F.col("ts").cast("timestamp"))
    seen = tb.table(spark, sf_dir, "events").select(
        times.window_start(at, HOUR_MS).alias("window_start"), F.col("event_type").alias("source"), F.lit("store").alias("destination"), F.lit("op").alias("operation"), at.alias("at")
    )
    rows = seen.groupBy("window_start", "source", "destination", "operation").agg(
        F.count(F.lit(1)).alias("count"), F.max("at").alias("last_seen"), F.lit(0).cast("long").alias("error_count")
    )
    none = F.create_map().cast("map<string,string>")
    windowed = rows.withColumn("window_end", F.col("window_start") + HOUR_MS).withColumn("source_tags", none).withColumn("destination_tags", none)
    windows.write_windowed_edges(windowed, table)
    windows.drop_days_before(spark, table, "2024-01-15")
    return windows.read_windowed_edges(spark, table).select("window_start", "source", "count", "last_seen")


@query
def snapshot_job_live(spark, sf_dir):
    """The snapshot job over the table a stream wrote in four batches."""
    store = snap_io.SnapshotStore(spark, scratch_path(spark, "snapshots"), format="parquet")
    now = tb.BASE_MS + 2 * HOUR_MS
    name, purged = jobs.run_snapshot_job(store, _windows_in_batches(spark, sf_dir), now, tb.WINDOW_MS, purge_age_ms=HOUR_MS)
    return store.read(now).select(
        F.lit(name).alias("name"), F.lit(purged).cast("long").alias("purged"), "source", "destination", "count", "error_count"
    )


@query
def span_job(spark, sf_dir):
    """The batch span job: edges from its tables."""
    root = scratch_path(spark, "job")
    jobs.run_span_job(tb.raw_spans(spark, sf_dir), root, tb.TAG_KEYS)
    return flat_tags(spark.read.schema(schemas.EDGE).parquet(f"{root}/edges"))


@query
def edge_job_twice_same_day(spark, sf_dir):
    """The batch edge job on the edges before noon, then on the others: both halves of the day are there."""
    root = scratch_path(spark, "job")
    edges = _written_edges(spark, sf_dir)
    noon = tb.BASE_MS + 12 * HOUR_MS
    for half in (F.col("source_timestamp") < noon, F.col("source_timestamp") >= noon):
        edges.where(half).write.mode("overwrite").parquet(f"{root}/edges")
        jobs.run_edge_job(spark, root, tb.WINDOW_MS, tb.NOW_MS)
    return flat_tags(windows.read_windowed_edges(spark, f"{root}/windowed").drop("window_date"))


@query
def graph_document(spark, sf_dir):
    """The service graph as one document, read again."""
    path = scratch_path(spark, "graph-document")
    graph_json.write_graph_document(_service_graph(spark, sf_dir), path)
    return flat_tags(graph_json.read_graph_json(spark, path).drop("edge_id"))


@query
def dangling_edges(spark, sf_dir):
    """Two snapshots with the same ids, the first without the node of id 2: the edges that only it loses."""
    edges = _numbered(spark, sf_dir)
    nodes = snap_ops.node_dimension(edges)
    facts = snap_ops.edge_fact(edges, nodes)
    stamped = lambda rows, name: rows.withColumn("snapshot_ts", F.lit(name))
    all_nodes = stamped(nodes.where("id <> 2"), "s1").unionByName(stamped(nodes, "s2"))
    lost = snap_ops.dangling_edges(stamped(facts, "s1").unionByName(stamped(facts, "s2")), all_nodes)
    return lost.select("snapshot_ts", "id", "sourceId", "destinationId")


@query
def late_edges(spark, sf_dir):
    """Two deliveries of the edges; in the second, what is older than the retention is dropped."""
    edges_path, table, checkpoint = (scratch_path(spark, n) for n in ("edges", "windowed", "checkpoint"))
    edges = _written_edges(spark, sf_dir)
    for delivery in (0, 1):
        tables.write_batch(edges, edges_path, delivery)
        stream = tables.stream_table(spark, edges_path, schemas.EDGE)
        _ran(windows.start_windowed_edges(stream, table, checkpoint, tb.TAG_KEYS, retention="1 hour", availableNow=True))
    latest = windows.latest_windowed_edges(spark, table)
    return latest.groupBy("window_start").agg(F.sum("count").alias("calls"))
