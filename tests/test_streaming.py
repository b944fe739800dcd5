import pytest
from pyspark.sql import functions as F

from support import raw_span
from spanloom import schemas
from spanloom.functions import times
from spanloom.operators import edges as edge_ops
from spanloom.operators import pairs
from spanloom.operators.spans import dedupe_spans_stream, light_spans
from spanloom.sources import spans as span_io
from spanloom.sources import tables
from spanloom.streaming import pairing, windows
from test_pairs import SCENARIOS, O, random_spans, simulate

C, S = "CLIENT", "SERVER"


def edges_of(spark, job):
    rows = tables.read_table(spark, job.table("edges"), schemas.EDGE).collect()
    return sorted((r.source, r.destination, r.pair_key) for r in rows)


def carried(spark, job):
    return tables.read_batch_before(spark, job.table("carried"), 1 << 40, pairing.CARRIED)


def test_any_split_into_batches_gives_the_same_edges(spark, raw, tmp_path):
    import random
    rng = random.Random(3)
    cases = {str(n): random_spans(rng, n, cyclic=True) for n in range(60)}
    rows = [
        raw_span(i, p, svc, None if kind == O else kind, seq=seq, trace=trace)
        for trace, spans in cases.items() for seq, i, p, svc, kind in spans
    ]
    job = pairing.SpanJob(str(tmp_path), interval_ms=10**9)
    for batch_id, (low, high) in enumerate([(0, 3), (3, 4), (4, 9), (9, 99)]):
        job.process(raw([r for r in rows if low <= r[9] < high]), batch_id)
    expected = sorted((a, b, key) for spans in cases.values() for a, b, key, _ in simulate(spans))
    assert edges_of(spark, job) == expected


def test_repeated_batch_changes_nothing(spark, raw, tmp_path):
    job = pairing.SpanJob(str(tmp_path))
    first, second = raw([raw_span("a", "", "s1", C, seq=1)]), raw([raw_span("a", "", "s2", S, seq=2)])
    job.process(first, 0)
    job.process(second, 1)
    job.process(second, 1)
    assert edges_of(spark, job) == [("s1", "s2", "a")]


def test_eviction_by_end_time(spark, raw, tmp_path):
    job = pairing.SpanJob(str(tmp_path), interval_ms=700)
    job.process(raw([
        raw_span("long", "", "desk", C, start_ms=50_000, duration_us=5_400_000, seq=1),
        raw_span("short", "", "desk", C, start_ms=50_000, duration_us=900_000, seq=2),
        raw_span("short", "", "post", S, start_ms=50_100, duration_us=800_000, seq=3),
    ]), 0, stream_ms=56_000)  # ends: 55.4 s and 50.9 s; what ended by 55.3 s is forgotten
    assert [r.span_id for r in carried(spark, job).filter("held").collect()] == ["long"]
    job.process(raw([raw_span("long", "", "post", S, start_ms=50_200, duration_us=5_000_000, seq=4)]), 1, stream_ms=60_000)
    assert carried(spark, job).count() == 0
    assert edges_of(spark, job) == [("desk", "post", "long"), ("desk", "post", "short")]
    registry = tables.read_batch_before(spark, job.table("registry"), 9, schemas.REGISTRY).collect()
    assert [(r.service_name, r.first_shared_seq) for r in registry] == [("post", 3)]


def test_evicted_span_is_not_found_and_an_id_lives_as_long_as_its_longest_span(spark, raw, tmp_path):
    job = pairing.SpanJob(str(tmp_path), interval_ms=1_000)
    job.process(raw([
        raw_span("gone", "", "s1", C, start_ms=1_000, seq=1),
        raw_span("kept", "", "s1", O and None, start_ms=1_000, seq=2),
        raw_span("kept", "x", "s9", None, start_ms=9_000, seq=3),
    ]), 0, stream_ms=9_000)
    assert sorted(r.arrival_seq for r in carried(spark, job).filter("held").collect()) == [2, 3]
    job.process(raw([
        raw_span("k1", "gone", "s2", S, start_ms=9_000, seq=4), raw_span("k2", "kept", "s2", S, start_ms=9_000, seq=5),
    ]), 1)
    assert edges_of(spark, job) == [("s1", "s2", "kept")]


def test_service_registered_by_an_earlier_batch_is_refused(spark, raw, tmp_path):
    rows, calls, _ = SCENARIOS["accepted_until_registered"]
    job = pairing.SpanJob(str(tmp_path), interval_ms=10**9)
    for batch_id, (span_id, parent, service, kind) in enumerate(rows):
        job.process(raw([raw_span(span_id, parent, service, kind, seq=batch_id)]), batch_id)
    assert sorted(f"{a}>{b}" for a, b, _ in edges_of(spark, job)) == calls
    assert len(tables.batches(spark, job.table("carried"))) == 2


def test_stream_equals_batch(spark, raw, tmp_path):
    rows = [raw_span(f"c{n}", "", f"s{n % 3}", C, seq=2 * n, trace=str(n)) for n in range(40)]
    rows += [raw_span(f"k{n}", f"c{n}", f"d{n % 2}", None, seq=2 * n + 1, trace=str(n)) for n in range(40)]
    spans = raw(rows)
    spans.repartition(5).write.parquet(str(tmp_path / "in"))
    job = pairing.SpanJob(str(tmp_path / "out"))
    stream = span_io.stream_spans(spark, str(tmp_path / "in"), max_files=2)
    job.start(stream, str(tmp_path / "cp"), availableNow=True).awaitTermination()
    batch = edge_ops.graph_edges(pairs.accepted_pairs(light_spans(spans)))
    assert edges_of(spark, job) == sorted((r.source, r.destination, r.pair_key) for r in batch.collect())
    assert tables.read_table(spark, job.table("latency"), schemas.LATENCY).count() == 40


def edge(source, at, seq, tags=None):
    return (f"k{seq}", source, "b", "op", at, tags or {}, {}, seq)


def run_windows(spark, tmp_path, rows, batch_id, retention="7 days"):
    tables.write_batch(spark.createDataFrame(rows, schemas.EDGE), str(tmp_path / "edges"), batch_id)
    stream = tables.stream_table(spark, str(tmp_path / "edges"), schemas.EDGE)
    query = windows.start_windowed_edges(
        stream, str(tmp_path / "windowed"), str(tmp_path / "cp"), ["tier"], retention=retention, availableNow=True
    )
    query.awaitTermination()
    return query


def test_windows_stay_current_and_late_edges_are_dropped(spark, tmp_path):
    hour = 3_600_000
    run_windows(spark, tmp_path, [edge("a", 1_000, 1, {"tier": "1", "error": "true"}), edge("a", 2_000, 2), edge("a", 300_000, 3)], 0, "1 hour")
    run_windows(spark, tmp_path, [edge("a", 1_500, 4, {"tier": "2"}), edge("a", 5 * hour, 5)], 1, "1 hour")
    query = run_windows(spark, tmp_path, [edge("a", 1_600, 6), edge("a", 5 * hour + 1, 7)], 2, "1 hour")
    got = {r.window_start: r for r in windows.latest_windowed_edges(spark, str(tmp_path / "windowed")).collect()}
    assert {start: r["count"] for start, r in got.items()} == {0: 3, 300_000: 1, 5 * hour: 2}
    assert (got[0].last_seen, got[0].error_count, got[0].source_tags) == (2_000, 1, {"tier": "2"})
    dropped = [s["numRowsDroppedByWatermark"] for p in query.recentProgress for s in p["stateOperators"]]
    assert sum(dropped) == 1


def test_all_tags_survive_and_later_values_win(spark, tmp_path):
    edges = str(tmp_path / "edges")
    for batch, rows in enumerate(([edge("a", 1_000, 1, {"tier": "1", "zone": "z", "error": "true"})], [edge("a", 2_000, 2, {"tier": "2", "odd key": ""})])):
        tables.write_batch(spark.createDataFrame(rows, schemas.EDGE), edges, batch)
    stream = tables.stream_table(spark, edges, schemas.EDGE, max_files=1)
    query = windows.start_windowed_edges(stream, str(tmp_path / "w"), str(tmp_path / "cp"), availableNow=True)
    query.awaitTermination()
    assert sum(p["numInputRows"] > 0 for p in query.recentProgress) == 2
    row = windows.read_windowed_edges(spark, str(tmp_path / "w")).first()
    assert (row["count"], row.error_count, row.source_tags) == (2, 1, {"tier": "2", "zone": "z", "odd key": ""})


def windowed_row(start, source, count):
    return (start, start + 300_000, source, "b", "op", count, start, 0, {"t": str(count)}, {})


def held(spark, table):
    return {(r.window_start, r.source): (r["count"], r.source_tags.get("t")) for r in windows.read_windowed_edges(spark, table).collect()}


def test_stored_windows_are_replaced_one_by_one(spark, tmp_path):
    table = str(tmp_path / "w")
    write = lambda *rows: windows.write_windowed_edges(spark.createDataFrame(rows, schemas.WINDOWED_EDGE), table)
    write(windowed_row(0, "a", 3), windowed_row(0, "c", 1), windowed_row(300_000, "a", 2))
    write(windowed_row(600_000, "a", 1))
    write(windowed_row(0, "a", 2))
    assert held(spark, table) == {(0, "a"): (2, "2"), (300_000, "a"): (2, "2"), (600_000, "a"): (1, "1")}
    write()
    assert len(held(spark, table)) == 3


def test_versions_are_merged_and_old_days_forgotten(spark, tmp_path):
    day, edges, table = 86_400_000, str(tmp_path / "edges"), str(tmp_path / "w")
    for batch in range(5):
        tables.write_batch(spark.createDataFrame([edge("a", batch * day // 2, 2 * batch), edge("a", 1, 2 * batch + 1)], schemas.EDGE), edges, batch)
    stream = tables.stream_table(spark, edges, schemas.EDGE, max_files=2)
    query = windows.start_windowed_edges(stream, table, str(tmp_path / "cp"), versions_per_day=2, availableNow=True)
    query.awaitTermination()
    counts = {k: v[0] for k, v in held(spark, table).items()}
    assert counts == {(0, "a"): 6, **{(n * day // 2, "a"): 1 for n in range(1, 5)}}
    assert max(len(windows._versions(spark, table, d)) for d in windows.days(spark, table)) <= 2
    assert windows.compact(spark, table, 1) and {k: v[0] for k, v in held(spark, table).items()} == counts
    assert windows.drop_days_before(spark, table, "1970-01-03") == ["1970-01-01", "1970-01-02"]
    assert set(held(spark, table)) == {(2 * day, "a")}


def test_replayed_batches(spark, tmp_path):
    edges, table, cp = str(tmp_path / "edges"), str(tmp_path / "w"), tmp_path / "cp"

    def deliver(batch):
        tables.write_batch(spark.createDataFrame([edge("a", 1_000, batch)], schemas.EDGE), edges, batch)

    def run():
        stream = tables.stream_table(spark, edges, schemas.EDGE, max_files=1)
        windows.start_windowed_edges(stream, table, str(cp), availableNow=True).awaitTermination()

    for batch in range(2):
        deliver(batch)
        run()
    last = max((cp / "commits").glob("[0-9]*"), key=lambda p: int(p.name))
    last.unlink()  # as if the driver had died just before its commit
    (last.parent / f".{last.name}.crc").unlink(missing_ok=True)
    run()
    assert held(spark, table)[0, "a"][0] == 2
    deliver(2)
    run()
    assert held(spark, table)[0, "a"][0] == 3


def test_a_batch_repeated_after_its_compaction_loses_nothing(spark, tmp_path):
    table = str(tmp_path / "w")
    write = windows.batch_writer(table, versions_per_day=1)

    def batch(batch_id, **counts):
        rows = [(0, 300_000, source, "b", "op", n, 1, 0, side, key, value) for source, n in counts.items()
                for side, key, value in (("", "", None), ("source", "t", str(n)))]
        write(spark.createDataFrame(rows, windows.STORED), batch_id)

    batch(0, a=1, c=5)
    batch(1, a=2, d=1)
    batch(2, a=3)
    for _ in range(2):  # as if the driver had died between the merge and the commit
        batch(3, a=4)
        assert held(spark, table) == {(0, "a"): (4, "4"), (0, "c"): (5, "5"), (0, "d"): (1, "1")}
        assert windows._versions(spark, table, "1970-01-01") == [2, 3]
    windows.compact(spark, table, 1)  # the newest version may still be repeated
    batch(3, a=4)
    assert held(spark, table) == {(0, "a"): (4, "4"), (0, "c"): (5, "5"), (0, "d"): (1, "1")}


def test_a_merge_that_ended_half_way_is_repeated(spark, tmp_path, monkeypatch):
    table = str(tmp_path / "w")
    write = windows.batch_writer(table, versions_per_day=1)
    frame = lambda *rows: spark.createDataFrame([(0, 300_000, s, "b", "op", n, 1, 0, "", "", None) for s, n in rows], windows.STORED)
    write(frame(("a", 1), ("c", 5)), 0)
    write(frame(("a", 2)), 1)
    with monkeypatch.context() as broken:
        broken.setattr(windows, "_drop_versions_before", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            write(frame(("a", 3)), 2)
    assert {k: v[0] for k, v in held(spark, table).items()} == {(0, "a"): 3, (0, "c"): 5}
    write(frame(("a", 3)), 2)
    assert {k: v[0] for k, v in held(spark, table).items()} == {(0, "a"): 3, (0, "c"): 5}


def test_other_rows_under_a_used_batch_are_an_error(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = lambda *seqs: spark.createDataFrame([edge("a", 1_000, s, {"k": "v"}) for s in seqs], schemas.EDGE)
    tables.write_batch(rows(1, 2), path, 0)
    tables.write_batch(rows(2, 1), path, 0)
    with pytest.raises(ValueError):
        tables.write_batch(rows(1, 3), path, 0)
    rows(9).write.parquet(f"{path}/_incoming/batch_id=1")  # a batch that died half-way
    assert tables.read_table(spark, path, schemas.EDGE).count() == 2 and tables.batches(spark, path) == [0]
    table = str(tmp_path / "w")
    write = windows.batch_writer(table)
    long_form = spark.createDataFrame([(0, 300_000, "a", "b", "op", 1, 1, 0, "", "", None)], windows.STORED)
    write(long_form, 4)
    with pytest.raises(ValueError):
        write(long_form, 0)


def test_edge_without_time_counts_as_seen_now(spark, tmp_path):
    run_windows(spark, tmp_path, [edge("a", 0, 1)], 0)
    assert windows.latest_windowed_edges(spark, str(tmp_path / "windowed")).first().last_seen > 1_700_000_000_000


def test_stream_dedupe(spark, light, tmp_path):
    rows = light([("a", "", "s", C), ("a", "", "s", C), ("a", "", "t", C)])
    rows.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(schemas.LIGHT_SPAN).parquet(str(tmp_path / "in"))
    out = dedupe_spans_stream(stream, "10 minutes").writeStream.format("parquet").option("path", str(tmp_path / "out"))
    out.option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start().awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 2


def dated_row(day, value=1):
    at = times.midnight_of(day)
    return (at, at + 300_000, "a", "b", "op", value, at, 0, {}, {})


def test_a_day_of_the_future_does_not_make_real_days_too_old(spark, tmp_path):
    table = str(tmp_path / "windowed")
    write = windows.batch_writer(table, retention_days=30, clock_ms=lambda: times.midnight_of("2024-03-20"))

    def rows(*given):
        wide = spark.createDataFrame([dated_row(*g) if isinstance(g, tuple) else dated_row(g) for g in given], schemas.WINDOWED_EDGE)
        return wide.select("*", F.lit("").alias("side"), F.lit("").alias("key"), F.lit("").alias("value"))

    write(rows("2024-02-01", "2024-03-18", "2024-03-19"), 0)
    assert windows.days(spark, table) == ["2024-03-18", "2024-03-19"]  # the first is beyond the retention at once
    write(rows("2100-01-19"), 1)
    write(rows().limit(0), 2)
    write(rows(("2024-03-19", 5)), 3)
    assert windows.days(spark, table) == ["2024-03-18", "2024-03-19", "2100-01-19"]
    assert {r["count"] for r in windows.read_windowed_edges(spark, table).where("window_date = '2024-03-19'").collect()} == {5}
    with pytest.raises(ValueError):
        write(rows("2024-03-19"), 2)


def test_edges_ahead_of_the_clock_do_not_move_the_watermark(spark, tmp_path):
    ahead = edge("a", 4_102_444_800_000, 9)
    now = 1_700_000_000_000
    run_windows(spark, tmp_path, [edge("a", now, 1), ahead], 0, "1 hour")
    run_windows(spark, tmp_path, [edge("a", now + 1, 2)], 1, "1 hour")
    found = windows.read_windowed_edges(spark, str(tmp_path / "windowed")).collect()
    assert [(r["count"], r.last_seen) for r in found] == [(2, now + 1)]
    both = spark.createDataFrame([edge("a", now, 1), ahead], schemas.EDGE)
    assert [r.emit_seq for r in windows.edges_ahead(both).collect()] == [9]
