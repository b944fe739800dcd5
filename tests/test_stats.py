from support import raw_span  # noqa: F401  (fixtures)
from pyspark.sql import functions as F

from spanloom import schemas
from spanloom.functions import times
from spanloom.operators import edges as edge_ops
from spanloom.operators import stats
from spanloom.plans import graph
from spanloom.streaming.windows import read_windowed_edges, write_windowed_edges


def edges(spark, *rows):
    """Edges (source, destination, operation, timestamp, source tags, destination tags)."""
    return spark.createDataFrame([(f"k{i}", *row, i) for i, row in enumerate(rows)], schemas.EDGE)


def test_edge_stats(spark):
    rows = edges(
        spark,
        ("a", "b", "op", 12, {"error": "true", "t": "1"}, {"error": "true", "d": "x"}),
        ("a", "b", "op", 15, {"error": "false", "t": "2", "u": "9"}, {}),
        ("a", "b", "op", 14, None, None),
        ("a", "b", "op", 300_000, {}, {}),
        ("a", "b", "op", 0, {}, {}),
        ("a", "c", "op", 7, {}, {}),
    )
    got = {(r.window_start, r.destination): r for r in stats.edge_stats(rows, 300_000, 99).collect()}
    first = got[0, "b"]
    assert (first["count"], first.last_seen, first.error_count, first.window_end) == (4, 99, 1, 300_000)
    assert (first.source_tags, first.destination_tags) == ({"t": "2", "u": "9"}, {"d": "x"})
    assert got[300_000, "b"]["count"] == 1 and got[0, "c"].source_tags == {}


def windowed(spark, *rows):
    return spark.createDataFrame([(s, s + 300_000, *rest) for s, *rest in rows], schemas.WINDOWED_EDGE)


def test_service_graph_merges_windows_and_operations(spark):
    table = windowed(
        spark,
        (0, "a", "b", "x", 1, 10, 100, {"p": "aws"}, {}),
        (300_000, "a", "b", "y", 3, 30, 300, {"p": "dc,aws,,", "q": ",,"}, {"z": ""}),
        (600_000, "a", "c", "x", 5, 50, 500, {}, {}),
    )
    got = {r.destination: r for r in graph.service_graph(table, 300_000, 700_000, 0, 700_000).collect()}
    assert (got["b"]["count"], got["b"].last_seen, got["b"].error_count) == (4, 30, 400)
    assert (got["b"].effective_from, got["b"].effective_to) == (0, 600_000)
    assert got["b"].source_tags == {"p": "aws,dc", "q": ""} and got["b"].destination_tags == {"z": ""}
    assert got["c"].effective_to == 700_000


def test_operation_graph_keeps_windows_apart(spark):
    table = windowed(spark, *[(s, "a", "b", "x", 1, 10, 0, {}, {}) for s in (0, 300_000, 600_000)])
    got = graph.operation_graph(table, 300_000, 1_000_000, 300_001, 600_000)
    assert sorted(r.effective_from for r in got.collect()) == [300_000, 600_000]
    merged = stats.operation_graph_merge(got).first()
    assert (merged["count"], merged.effective_from, merged.effective_to) == (2, 300_000, 900_000)


def test_inner_empty_tag_parts_count(spark):
    parts = spark.createDataFrame([("a,,b",), (",",), ("",), (",a",)], "v string").select(stats.tag_values(F.col("v"))).collect()
    assert [p[0] for p in parts] == [["a", "", "b"], [], [""], ["", "a"]]


def test_constraints_split(spark):
    rows = windowed(spark, (0, "a", "b", "x", 1, 1, 0, {}, {}), (0, "", "b", "x", 1, 1, 0, {}, {}), (0, "a", None, "x", 1, 1, 0, {}, {}),
                    (0, "a", "b", "x", None, 1, 0, {}, {}))
    valid, rejected = edge_ops.edge_constraints(rows)
    assert (valid.count(), rejected.count()) == (1, 3)


def test_observed_edge_count_and_views(spark):
    table = windowed(spark, (0, "a", "b", "x", 1, 10, 0, {}, {}), (0, "a", "b", "y", 1, 10, 0, {}, {}))
    counted, metric = graph.with_edge_count(graph.service_graph(table, 300_000, 10, 0, 10))
    counted.collect()
    assert metric.get["edges"] == 1
    graph.register_graph_views(table, 300_000, 10, 0, 10)
    assert spark.sql("SELECT (SELECT count(*) FROM servicegraph), (SELECT count(*) FROM operationgraph)").first()[:] == (1, 2)


def test_range_prunes_days(spark, tmp_path):
    path = str(tmp_path / "windowed")
    day = times.DAY_MS
    write_windowed_edges(windowed(spark, *[(n * day, "a", "b", "x", 1, n, 0, {}, {}) for n in range(5)]), path)
    got = graph.operation_graph(read_windowed_edges(spark, path), 300_000, 5 * day, 2 * day, 3 * day)
    assert sorted(r.last_seen for r in got.collect()) == [2, 3]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(window_date" in plan and "GreaterThanOrEqual(window_start" in plan


def test_tag_of_very_many_values_is_not_gathered(spark):
    rows = spark.range(100_000).select(
        F.lit("a").alias("source"), F.lit("b").alias("destination"), F.create_map(F.lit("url"), F.concat(F.lit("u"), "id")).alias("source_tags"),
        F.create_map().cast("map<string,string>").alias("destination_tags"),
    )
    union = stats.tag_union_values(rows)
    assert union.count() == 100_000
    assert "collect_" not in union._jdf.queryExecution().executedPlan().toString()
