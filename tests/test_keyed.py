"""Keyed pairing on a stream, and tables kept as logs of changes."""

import random


from spanloom import schemas
from spanloom.sources import changelog, tables
from spanloom.sources import spans as span_io
from spanloom.streaming import keyed, pairing
from support import raw_span
from test_pairs import O, random_spans

NOW = 1_700_000_000_000


def edges_of(spark, job):
    return sorted((r.source, r.destination, r.pair_key) for r in tables.read_table(spark, job.table("edges"), schemas.EDGE).collect())


def run(spark, job, batches, tmp_path, name):
    feed = str(tmp_path / f"{name}-in")
    for rows in batches:
        spark.createDataFrame(rows, schemas.SPAN).coalesce(1).write.mode("append").parquet(feed)
    query = job.start(span_io.stream_spans(spark, feed, max_files=1), str(tmp_path / f"{name}-cp"), availableNow=True)
    query.awaitTermination()
    return query


def timed_batches(rng, traces, batches):
    """Spans of the random traces spread over time and, some of them late, over batches."""
    dealt = [[] for _ in range(batches)]
    for n in range(traces):
        for seq, span_id, parent, service, kind in random_spans(rng, n, cyclic=True):
            batch = rng.randrange(batches)
            start = NOW + 2_000 * max(0, batch - rng.randrange(3)) + rng.randrange(1_000)
            row = raw_span(span_id, parent, service, None if kind == O else kind, start_ms=start, duration_us=rng.randrange(3_000_000), seq=batch * 1_000 + seq, trace=str(n))
            dealt[batch].append(row)
            if rng.random() < 0.1:
                dealt[batch].append(row)  # delivered twice
    return dealt


def test_keyed_state_pairs_what_the_carried_table_pairs(spark, tmp_path):
    batches = timed_batches(random.Random(11), 70, 5)
    plain = pairing.SpanJob(str(tmp_path / "plain"), interval_ms=2_500)
    seen = 0
    for i, rows in enumerate(batches):
        seen = max([seen, *(r[5] // 1000 for r in rows)])
        plain.process(spark.createDataFrame(rows, schemas.SPAN), i, stream_ms=seen)
    job = keyed.KeyedSpanJob(str(tmp_path / "keyed"), interval_ms=2_500, sub_keys=3, compact_every=2)
    query = run(spark, job, batches, tmp_path, "keyed")
    assert edges_of(spark, job) == edges_of(spark, plain) != []
    forever = pairing.SpanJob(str(tmp_path / "forever"), interval_ms=10**12)
    forever.process(spark.createDataFrame([r for rows in batches for r in rows], schemas.SPAN), 0)
    assert len(edges_of(spark, forever)) > len(edges_of(spark, job))  # some were forgotten
    registry = {r.service_name: r.first_shared_seq for r in job.registry(spark).collect()}
    last = tables.read_batch_before(spark, plain.table("registry"), 99, schemas.REGISTRY).collect()
    assert registry == {r.service_name: r.first_shared_seq for r in last}
    assert changelog.bases(spark, job.table("registry"))
    states = [p["stateOperators"][0] for p in query.recentProgress]
    assert states[-1]["numRowsTotal"] < max(s["numRowsTotal"] for s in states)


def test_written_state_grows_with_the_batch(spark, tmp_path):
    many = [raw_span(f"c{n}", "", "desk", "CLIENT", start_ms=NOW, seq=n, trace=str(n)) for n in range(300)]
    few = [raw_span(f"k{n}", f"c{n}", "post", None, start_ms=NOW + 1, seq=1_000 + n, trace=str(n)) for n in range(4)]
    late = [raw_span("k9", "c9", "post", None, start_ms=NOW - 50_000, seq=2_000, trace="9")]
    job = keyed.KeyedSpanJob(str(tmp_path / "keyed"))
    query = run(spark, job, [many, few, late], tmp_path, "keyed")
    states = [p["stateOperators"][0] for p in query.recentProgress]
    assert states[0]["numRowsUpdated"] == 300 and states[1]["numRowsUpdated"] <= 8 and states[1]["numRowsTotal"] >= 300
    assert edges_of(spark, job) == [("desk", "post", f"c{n}") for n in (0, 1, 2, 3, 9)]


KEY, VALUE = ["name"], "name string, value long"


def state(spark, path, before=1 << 60):
    schema = spark.createDataFrame([], VALUE).schema
    return {r.name: r.value for r in changelog.read_state(spark, path, KEY, schema, before).collect()}


def test_log_of_changes_reads_alike_before_while_and_after_compaction(spark, tmp_path):
    path, schema = str(tmp_path / "log"), spark.createDataFrame([], VALUE).schema
    assert state(spark, path) == {}
    rng, expected, now = random.Random(5), [], {}
    for batch in range(9):
        changed = {f"k{rng.randrange(12)}": rng.randrange(100) for _ in range(4)}
        gone = {k for k in now if rng.random() < 0.2} - set(changed)
        rows = spark.createDataFrame(list(changed.items()), schema)
        deleted = spark.createDataFrame([(k,) for k in gone], "name string") if batch % 2 else None
        for _ in range(2 if batch == 4 else 1):  # a repeated batch
            changelog.write_changes(rows, path, batch, deleted)
        now = {k: v for k, v in now.items() if deleted is None or k not in gone} | changed
        expected.append(dict(now))
        assert state(spark, path) == now
        if batch in (3, 6):
            held = changelog.read_state(spark, path, KEY, schema)  # listed ahead of the compaction
            changelog.compact(spark, path, KEY, schema, batch - 1)
            changelog.compact(spark, path, KEY, schema, batch - 1)
            assert {r.name: r.value for r in held.collect()} == now == state(spark, path)
            changelog.write_changes(rows, path, batch, deleted)  # and the running batch again
    assert changelog.bases(spark, path) == [2, 5] and min(tables.batches(spark, path)) == 3
    for batch in range(5, 9):
        assert state(spark, path, batch + 1) == expected[batch]


def test_traces_dealt_to_groups_share_a_key_and_pair_alike(spark, tmp_path):
    """What a batch costs goes by its spans and not by its traces."""
    batches, found, keys = timed_batches(random.Random(12), 60, 4), {}, {}
    for name, groups in (("own", None), ("dealt", 5)):
        job = keyed.KeyedSpanJob(str(tmp_path / name), interval_ms=2_500, sub_keys=1, groups=groups)
        query = run(spark, job, batches, tmp_path, name)
        found[name] = edges_of(spark, job), sorted((r.service_name, r.first_shared_seq) for r in job.registry(spark).collect())
        keys[name] = max(p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress)
    assert found["own"] == found["dealt"] and found["own"][0] and keys["dealt"] <= 5 < keys["own"]


def test_stream_infers_no_constraints_of_its_events(spark, tmp_path, monkeypatch):
    """Those of texts made of texts fill the driver."""
    name, seen = "spark.sql.constraintPropagation.enabled", []
    monkeypatch.setattr(keyed.KeyedSpanJob, "process", lambda self, found, batch_id: seen.append((found.sparkSession.conf.get(name), found.count())))
    run(spark, keyed.KeyedSpanJob(str(tmp_path / "keyed")), [[raw_span("c", "", "desk", "CLIENT")]], tmp_path, "keyed")
    assert [conf for conf, _ in seen[:1]] == ["false"] and spark.conf.get(name) == "true"
