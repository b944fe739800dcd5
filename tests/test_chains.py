"""Chained snapshots against whole ones, and validity intervals against plain runs."""

import random

import pytest

from spanloom import schemas
from spanloom.functions.times import snapshot_name_of
from spanloom.operators import intervals
from spanloom.plans.graph import service_graph
from spanloom.sources import files
from spanloom.sources.chains import SnapshotChain

HOUR = 3_600_000


def graph_of(spark, edges):
    """A service graph from {(source, destination, provider or None): count}."""
    rows = [(0, 1, s, d, "op", n, 5, 0, {} if p is None else {"infrastructure_provider": p}, {"tier": "1"}) for (s, d, p), n in edges.items()]
    return service_graph(spark.createDataFrame(rows, schemas.WINDOWED_EDGE), 1, 10, 0, 10)


def told(df):
    return {(r.source, r.destination, r.source_provider): r["count"] for r in df.collect()}


def some_graphs(rng, n):
    graphs, now = [], {}
    for i in range(n):
        if i % 3:  # every third one is as the one before
            now = {k: v for k, v in now.items() if rng.random() < 0.8}
            for _ in range(3):  # an edge has one provider at a time; another one makes it another edge
                ends = rng.choice("ab"), rng.choice("uvw")
                now = {k: v for k, v in now.items() if k[:2] != ends} | {(*ends, rng.choice([None, "dc"])): rng.randrange(3)}
        graphs.append(dict(now))
    return graphs


def test_chain_reads_what_was_written_and_purges_what_nobody_needs(spark, tmp_path):
    graphs = some_graphs(random.Random(3), 8)
    chain = SnapshotChain(spark, str(tmp_path / "chain"), base_every=3)
    assert chain.read(0) is None and chain.names() == []
    for i, edges in enumerate(graphs):
        for _ in range(2 if i in (3, 4) else 1):  # a base and a delta written twice
            chain.write(graph_of(spark, edges), i * HOUR)
    with pytest.raises(ValueError):
        chain.write(graph_of(spark, {}), HOUR)
    for i, edges in enumerate(graphs):
        assert told(chain.read(i * HOUR + HOUR // 2)) == edges
    assert chain._held("base") == [snapshot_name_of(i * HOUR) for i in (0, 3, 6)]
    for i in (1, 2, 4, 5, 7):
        stored = chain.changes().where(f"snapshot_ts = '{snapshot_name_of(i * HOUR)}'").count()
        before, now = graphs[i - 1], graphs[i]
        assert stored == len({k for k in before.keys() | now.keys() if before.get(k) != now.get(k)})
    history = {}
    for r in chain.history().collect():
        history.setdefault(r.snapshot_ts, {})[r.source, r.destination, r.source_provider] = r["count"]
    assert [history.get(snapshot_name_of(i * HOUR), {}) for i in range(8)] == graphs
    assert chain.purge(4 * HOUR) == 5 and chain.names() == [snapshot_name_of(i * HOUR) for i in (5, 6, 7)]
    assert chain._held("taken") == [snapshot_name_of(i * HOUR) for i in (3, 4, 5, 6, 7)]  # 5 needs 3 and 4
    assert chain.read(4 * HOUR) is None
    assert [told(chain.read(i * HOUR)) for i in (5, 6, 7)] == graphs[5:]
    assert chain.purge(5 * HOUR) == 1 and chain._held("taken") == [snapshot_name_of(i * HOUR) for i in (6, 7)]
    assert chain.purge(9 * HOUR) == 2 and chain._held("taken") == []
    chain.write(graph_of(spark, graphs[4]), 10 * HOUR)
    assert told(chain.read(10 * HOUR)) == graphs[4]
    assert files.exists(spark, files.partition_path(spark, str(tmp_path / "chain" / "base"), "snapshot_ts", snapshot_name_of(10 * HOUR)))


def test_intervals_are_the_runs_of_equal_values(spark, monkeypatch):
    monkeypatch.setattr(intervals, "_SPAN", 5)
    rng = random.Random(6)
    names = [f"t{i:03d}" for i in range(37)]
    keys = [("a", None), ("a", "x"), ("b", "y")]
    rows, runs = [], []
    for source, provider in keys:
        value, run = None, None
        for i, name in enumerate(names):
            value = rng.choice([value, value, value, None, 1, 2])
            if value is None or run is None or run["value"] != value:
                if run is not None:
                    runs.append((source, provider, run["value"], names[run["from"]], name, run["n"]))
                run = None if value is None else {"value": value, "from": i, "n": 0}
            if run is not None:
                run["n"] += 1
                rows.append((name, source, provider, value))
        if run is not None:
            runs.append((source, provider, run["value"], names[run["from"]], None, run["n"]))
    history = spark.createDataFrame(rows, "snapshot_ts string, source string, provider string, value long").repartition(4)
    table = spark.createDataFrame([(n,) for n in names], "snapshot_ts string")
    found = intervals.validity_intervals(history, table, ["source", "provider"], ["value"])
    order = lambda r: tuple(str(v) for v in r)
    assert sorted([(r.source, r.provider, r.value, r.valid_from, r.valid_to, r.snapshots) for r in found.collect()], key=order) == sorted(runs, key=order)
    asked = spark.createDataFrame([(n,) for n in names[::7]], "snapshot_ts string")
    valid = intervals.valid_at(found, asked, table).select("snapshot_ts", "source", "provider", "value").collect()
    assert sorted(map(tuple, valid), key=order) == sorted([r for r in rows if r[0] in names[::7]], key=order)
    assert intervals.validity_intervals(history.limit(0), table, ["source", "provider"], ["value"]).count() == 0
