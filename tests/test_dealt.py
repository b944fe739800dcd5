"""Pairing trace by trace: from one shuffle, and as the joins pair that take traces too long for a task."""

import random
import re

import pytest
from pyspark.sql import DataFrame

import catalog
import testbed
from spanloom import schemas
from spanloom.operators import pairs
from spanloom.sources import tables
from spanloom.streaming import keyed, pairing
from support import raw_span
from test_keyed import run, timed_batches
from test_pairs import O, random_spans, simulate

SMALL = "/root/testdata/sf0.001"


def told(rows):
    return sorted(map(str, rows.collect()))


def random_light(spark, cases):
    rows = [(trace, i, p, 1000 + seq, svc, "op", 1000, kind, {"n": str(seq)}, seq) for trace, spans in cases.items() for seq, i, p, svc, kind in spans]
    return spark.createDataFrame(rows + rows[::7], schemas.LIGHT_SPAN)  # some are delivered twice


@pytest.mark.parametrize("most", [100_000, 9, 1])
def test_pairs_by_trace_are_those_of_the_joins(spark, monkeypatch, most):
    monkeypatch.setattr(pairs, "TRACE_SPANS", most)
    rng = random.Random(8)
    cases = {str(case): random_spans(rng, case, cyclic=True) for case in range(150)}
    light = random_light(spark, cases)
    _, short, long = pairs.dealt_by_trace(light)
    assert (long is None) == (most == 100_000) and short is not None
    found = pairs.accepted_pairs(light, by_trace=True)
    assert told(found) == told(pairs.accepted_pairs(light)) != []
    assert sorted((r.client_service, r.server_service, r.client_span_id, r.shared) for r in found.collect()) == sorted(p for s in cases.values() for p in simulate(s))


def test_pairs_without_a_scope_take_the_joins(light):
    rows = [("a", "", "s1", "CLIENT"), ("b", "a", "s2", "SERVER")]
    both = light(rows[:1], trace="t1").unionByName(light(rows[1:], trace="t2", start=1))
    assert pairs.accepted_pairs(both, (), by_trace=True).count() == 1
    assert pairs.accepted_pairs(both, by_trace=True).count() == 0


def test_short_traces_are_shuffled_once(spark, light):
    spans = light([("a", "", "s1", "CLIENT"), ("b", "a", "s2", "SERVER"), ("b", "a", "s1", "CLIENT")])
    plan = pairs.pairs_by_trace(spans)._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall("Exchange", plan)) == 1 and "Join" not in plan


def ran(spark, root, batches, **options):
    job = pairing.SpanJob(root, interval_ms=2_500, **options)
    edges, carried = [], []
    for i, rows in enumerate(batches):
        job.process(spark.createDataFrame(rows, schemas.SPAN), i)
        carried.append(told(tables.read_batch_before(spark, job.table("carried"), i + 1, pairing.CARRIED)))
    edges = told(tables.read_table(spark, job.table("edges"), schemas.EDGE))
    return edges, carried, told(tables.read_batch_before(spark, job.table("registry"), 99, schemas.REGISTRY))


def test_a_stream_pairs_and_forgets_alike_whether_traces_are_short_or_long(spark, monkeypatch, tmp_path):
    batches = timed_batches(random.Random(21), 50, 4)
    short = ran(spark, str(tmp_path / "short"), batches)
    monkeypatch.setattr(pairs, "TRACE_SPANS", 4)  # of a batch with what is carried
    assert ran(spark, str(tmp_path / "mixed"), batches) == short
    assert short[0] and all(short[1]) and len(set(map(len, short[1]))) > 1


def test_a_batch_keeps_files_until_it_is_done_and_no_rows(spark, monkeypatch, tmp_path):
    """Kept rows take several times the room of files, in memory and then on disk."""
    spans = [raw_span("c", "", "desk", "CLIENT", seq=1), raw_span("k", "c", "post", None, seq=2)]
    monkeypatch.setattr(DataFrame, "persist", lambda self, *level: pytest.fail("rows are kept"))
    plain = pairing.SpanJob(str(tmp_path / "plain"))
    plain.process(spark.createDataFrame(spans, schemas.SPAN), 0)
    job = keyed.KeyedSpanJob(str(tmp_path / "keyed"), sub_keys=1, groups=2)
    assert run(spark, job, [spans], tmp_path, "keyed").exception() is None
    for one in (plain, job):
        assert tables.read_table(spark, one.table("edges"), schemas.EDGE).count() == 1
        assert tables.batches(spark, one.table("_work")) == []


def test_a_table_without_batches_is_known_to_be_empty(spark, tmp_path):
    none = tables.read_batch_before(spark, str(tmp_path / "t"), 9, schemas.REGISTRY)
    assert none.schema.simpleString() == schemas.REGISTRY.simpleString() and none.collect() == []
    ids = spark.range(9)
    found = ids.join(none, none.service_name == ids.id.cast("string"), "left")
    assert "Exchange" not in found._jdf.queryExecution().executedPlan().toString()


def test_stream_deduplication_derives_its_spans_once(spark, monkeypatch):
    made, original = spark.sparkContext.accumulator(0), testbed.spans

    def counted(batches):
        for batch in batches:
            made.add(batch.num_rows)
            yield batch

    monkeypatch.setattr(testbed, "spans", lambda *args: (lambda rows: rows.mapInArrow(counted, rows.schema))(original(*args)))
    assert catalog.QUERIES["dedupe_spans_stream"](spark, SMALL).count() > 0
    assert made.value == original(spark, SMALL).count()
