import pytest
from pyspark.sql import functions as F

from spanloom import schemas
from spanloom.functions.times import snapshot_name_of
from spanloom.operators import snapshots as ops
from spanloom.operators.numbering import dense_number
from spanloom.plans.jobs import run_snapshot_job
from spanloom.sources import files, graph_json
from spanloom.sources.snapshots import SnapshotStore, read_nodes_csv, with_tags

P = ops.PROVIDER_TAG
GRAPH = """{"edges": [
 {"source": {"name": "gate way", "tags": {"tier": "gold,silver", "%s": "north,south"}}, "destination": {"name": "say \\"hi\\"", "tags": {}},
  "stats": {"count": 5, "lastSeen": 50, "errorCount": 1}, "effectiveFrom": 1, "effectiveTo": 9},
 {"source": {"name": "gate way", "tags": {"%s": "south"}}, "destination": {"name": "cart", "tags": {"%s": "north"}},
  "stats": {"count": 7, "lastSeen": 70, "errorCount": 0}, "effectiveFrom": 2, "effectiveTo": 8},
 {"source": {"name": "cart", "tags": {"%s": "north"}}, "destination": {"name": "gate way", "tags": {"%s": "south"}},
  "stats": {"count": 3, "lastSeen": 30, "errorCount": 3}, "effectiveFrom": 2, "effectiveTo": 8}
]}""" % (P, P, P, P, P)


@pytest.fixture
def graph(spark):
    return graph_json.parse_graph_json(spark.createDataFrame([(GRAPH,)], "json string"))


def test_ids_by_first_appearance(graph):
    nodes = ops.node_dimension(ops.node_columns(graph)).orderBy("id").collect()
    assert [(n.id, n.name, n.provider, n.tier) for n in nodes] == [
        (1, "gate way", "north,south", "gold,silver"), (2, "gate way", "south", None), (3, "cart", "north", None), (4, 'say "hi"', None, None)]
    facts = ops.edge_fact(ops.node_columns(graph), ops.node_dimension(ops.node_columns(graph))).orderBy("id").collect()
    assert [(f.id, f.sourceId, f.destinationId) for f in facts] == [(1, 1, 4), (2, 2, 3), (3, 3, 2)]


@pytest.mark.parametrize("format", ["csv", "parquet"])
def test_round_trip(spark, graph, tmp_path, format):
    store = SnapshotStore(spark, str(tmp_path), format)
    store.write(graph, 1000)
    store.write(graph, 1000)
    back = with_tags(store.read(1000))
    columns = sorted(graph.columns)
    assert sorted(map(str, back.select(columns).collect())) == sorted(map(str, graph.select(columns).collect()))
    assert '"stats":{"count":5,"lastSeen":50,"errorCount":1},"effectiveFrom":1' in "".join(r.json for r in graph_json.graph_json(back).collect())


def test_as_of_and_purge(spark, graph, tmp_path):
    store = SnapshotStore(spark, str(tmp_path))
    assert store.read(5) is None and store.purge(5) == 0 and store.edges().count() == 0
    for i, at in enumerate((1_000, 2_000, 3_000)):
        store.write(graph.withColumn("count", F.lit(i).cast("long")), at)
    assert store.read(999) is None
    assert [store.read(at).agg(F.max("count")).first()[0] for at in (1_000, 1_999, 2_000, 9_000)] == [0, 0, 1, 2]
    assert store.history().count() == 9
    assert store.purge(2_000) == 4
    assert store.names() == [snapshot_name_of(3_000)] and store.read(2_500) is None and store.purge(2_000) == 0


def test_unfinished_snapshot_is_not_read(spark, graph, tmp_path):
    store = SnapshotStore(spark, str(tmp_path))
    store.write(graph, 1_000)
    store.write(graph, 2_000)
    files.drop_partition(spark, str(tmp_path / "taken"), "snapshot_ts", snapshot_name_of(2_000))
    assert store.as_of(5_000) == snapshot_name_of(1_000)


def test_empty_graph_is_a_snapshot(spark, graph, tmp_path):
    store = SnapshotStore(spark, str(tmp_path))
    store.write(graph, 1_000)
    store.write(graph.limit(0), 2_000)
    assert store.read(2_000).count() == 0 and store.read(1_000).count() == 3


def test_bad_csv_lines_are_skipped_and_listed(spark, graph, tmp_path):
    store = SnapshotStore(spark, str(tmp_path))
    store.write(graph, 1_000)
    folder = next(iter((tmp_path / "edges").glob("snapshot_ts=*")))
    (folder / "part-extra.csv").write_text("id,sourceId,destinationId,statsCount,statsLastSeen,statsErrorCount,effectiveFrom,effectiveTo\n"
                                           "x,1,2,3,4,5,6,7\n9,1,2,3,4,5,6,7\n")
    assert store.edges().count() == 4 and store.edges().select("id").count() == 4
    assert [r.line for r in store.rejected_lines().collect()] == ["x,1,2,3,4,5,6,7"]


def test_foreign_node_file(spark, tmp_path):
    (tmp_path / "n.csv").write_text('id,name,region,tier\n4,"ledger ""old""",,\n2,mail,"r1,r2",\n9,a b,,"x, y"\n')
    rows = {r.id: r[1:] for r in read_nodes_csv(spark, str(tmp_path / "n.csv"), "region").collect()}
    assert rows == {4: ('ledger "old"', None, None), 2: ("mail", "r1,r2", None), 9: ("a b", None, "x, y")}


@pytest.mark.parametrize("text, expected", [
    ("{}", []),
    ('{"edges":[]}', []),
    ('{"edges":[{"source":{},"destination":{}}]}', [(None, None)]),
    ('{"edges":[{"source":{"name":"a"}}]}', [(1, None)]),
    ('{"edges":[{"destination":{"name":"b"}}]}', [(None, 1)]),
])
def test_sparse_documents(spark, tmp_path, text, expected):
    (tmp_path / "g.json").write_text(text)
    edges = ops.node_columns(graph_json.read_graph_json(spark, str(tmp_path / "g.json")))
    facts = ops.edge_fact(edges, ops.node_dimension(edges)).collect()
    assert [(f.sourceId, f.destinationId) for f in facts] == expected
    assert all(f.statsCount is None and f.effectiveTo is None for f in facts)


def test_dangling_edges(spark):
    nodes = spark.createDataFrame([(1, "a", None, None), (2, "b", None, None), (3, None, None, None)], schemas.NODE)
    facts = spark.createDataFrame([(1, 1, 2, 5, 5, 0, 0, 1), (2, 1, 9, 5, 5, 0, 0, 1), (3, 9, 1, 5, 5, 0, 0, 1), (4, None, 1, 5, 5, 0, 0, 1)], schemas.EDGE_FACT)
    assert [r.edge_id for r in ops.snapshot_edge_join(facts, nodes).collect()] == [1]
    assert sorted(r.id for r in ops.dangling_edges(facts, nodes).collect()) == [2, 3, 4]


def test_dangling_edges_keep_to_their_snapshot(spark):
    nodes = spark.createDataFrame([(1, "a", None, None), (2, "b", None, None)], schemas.NODE)
    facts = spark.createDataFrame([(7, 1, 2, 5, 5, 0, 0, 1)], schemas.EDGE_FACT)
    stamped = lambda rows, name: rows.withColumn("snapshot_ts", F.lit(name))
    all_nodes = stamped(nodes.filter("id = 1"), "s1").unionByName(stamped(nodes, "s2"))
    all_facts = stamped(facts, "s1").unionByName(stamped(facts, "s2"))
    assert [r.snapshot_ts for r in ops.snapshot_edge_join(all_facts, all_nodes).collect()] == ["s2"]
    assert [r.snapshot_ts for r in ops.dangling_edges(all_facts, all_nodes).collect()] == ["s1"]


def test_locations_exist(spark, graph, tmp_path):
    store = SnapshotStore(spark, str(tmp_path))
    nodes, edges = store.write(graph, 86_400_000)
    assert read_nodes_csv(spark, nodes).count() == 4 and files.exists(spark, edges)
    assert store.dangling_edges().count() == 0


def test_documents_come_back(spark, graph, tmp_path):
    columns = [c for c in sorted(graph.columns) if c != "edge_id"]
    for parts in (1, 2):
        path = str(tmp_path / str(parts))
        graph_json.write_graph_document(graph, path, parts)
        back = graph_json.read_graph_json(spark, path)
        assert sorted(r.edge_id for r in back.collect()) == [1, 2, 3]
        assert sorted(map(str, back.select(columns).collect())) == sorted(map(str, graph.select(columns).collect()))
    two = graph_json.parse_graph_json(spark.createDataFrame([(GRAPH,), (GRAPH,)], "json string"))
    assert sorted(r.edge_id for r in two.collect()) == [1, 2, 3, 4, 5, 6]


def test_many_instants_at_once(spark):
    taken = spark.createDataFrame([(10,), (25,), (3_600_010,), (20_000_000,)], "snapshot_ms long")
    asked = spark.createDataFrame([(5,), (10,), (24,), (30,), (3_600_009,), (9_000_000,), (99_000_000,)], "instant_ms long")
    got = {r.instant_ms: r.snapshot_ms for r in ops.snapshot_as_of(taken, asked).collect()}
    assert got == {5: None, 10: 10, 24: 10, 30: 25, 3_600_009: 25, 9_000_000: 3_600_010, 99_000_000: 20_000_000}


def test_history(spark, graph, tmp_path):
    store = SnapshotStore(spark, str(tmp_path))
    store.write(graph.filter("edge_id <= 2"), 1)
    store.write(graph.filter("edge_id >= 2").withColumn("count", F.col("count") + F.when(F.col("edge_id") == 2, 1).otherwise(0)), 2)
    changes = ops.snapshot_history(store.read(1), store.read(2)).collect()
    assert sorted((r.change, r.count_delta) for r in changes) == [("added", 3), ("changed", 1), ("removed", -5)]


def test_job_purges_by_age(spark, tmp_path):
    table = spark.createDataFrame([(0, 300_000, "a", "b", "x", 1, 10, 0, {}, {})], schemas.WINDOWED_EDGE)
    store = SnapshotStore(spark, str(tmp_path))
    assert run_snapshot_job(store, table, 400_000) == (snapshot_name_of(400_000), 0)
    assert run_snapshot_job(store, table, 500_000, purge_age_ms=100_000) == (snapshot_name_of(500_000), 2)
    assert run_snapshot_job(store, table, 600_000, purge_age_ms=0) == (snapshot_name_of(600_000), 4)


def test_dense_number(spark):
    rows = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("v")).repartition(7)
    assert all(r.n == r.v + 1 for r in dense_number(rows, ["v"], "n").collect())
