"""Work that has to stay small when the tables grow."""

import glob
import re

import pytest

import catalog
import testbed
from spanloom import schemas
from spanloom.operators import generations, pairs
from spanloom.operators.spans import light_spans
from spanloom.sources import spans as span_io
from spanloom.sources import tables

SMALL = "/root/testdata/sf0.001"


def test_a_larger_stream_has_more_micro_batches_and_the_same_edges(spark, monkeypatch):
    monkeypatch.setattr(catalog, "BATCH_SPANS", 2_000)
    job = catalog._span_job(spark, SMALL)
    assert len(tables.batches(spark, job.table("edges"))) == 4  # 7,500 orders and lines
    stored = catalog.flat_tags(catalog._table(spark, job, "edges", catalog.schemas.EDGE))
    assert sorted(map(tuple, stored.collect())) == sorted(map(tuple, catalog.QUERIES["graph_edges"](spark, SMALL).collect()))


def test_pairing_ranks_the_holders_of_an_id_once(spark, light, tmp_path):
    light([("a", "", "s1", "CLIENT"), ("b", "a", "s2", "SERVER"), ("b", "a", "s1", "CLIENT")]).write.parquet(str(tmp_path / "s"))
    frame = pairs.accepted_pairs(spark.read.parquet(str(tmp_path / "s")))
    frame.collect()
    final = frame._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert len(set(re.findall(r"Exchange hashpartitioning\(trace_id#\d+, span_id#\d+, \d+\)", final))) == 1  # the other uses reuse it


@pytest.mark.parametrize("name, step", [("edge_count_metric", "_windowed"), ("edge_job_twice_same_day", "_edges"), ("late_edges", "_edges")])
def test_a_query_that_uses_its_edges_twice_reads_them_from_files(spark, monkeypatch, name, step):
    made, original = spark.sparkContext.accumulator(0), getattr(catalog, step)

    def counted(batches):
        for batch in batches:
            made.add(batch.num_rows)
            yield batch

    monkeypatch.setattr(catalog, step, lambda *args: (lambda rows: rows.mapInArrow(counted, rows.schema))(original(*args)))
    found = catalog.QUERIES[name](spark, SMALL).count()
    assert found > 0 and made.value == original(spark, SMALL).count()


@pytest.mark.parametrize("feed", ["spans", "edges"])
def test_micro_batches_are_dealt_to_several_files(spark, monkeypatch, feed):
    """No batch, however large, is written and read by one task."""
    seen = []
    if feed == "spans":
        stream = span_io.stream_spans
        monkeypatch.setattr(span_io, "stream_spans", lambda s, path, **options: (seen.append((path, options["max_files"])), stream(s, path, **options))[1])
        catalog._arriving(spark, SMALL, 2)
        batches = 2
    else:
        stream = tables.stream_table
        monkeypatch.setattr(tables, "stream_table", lambda s, path, schema, **options: (seen.append((path, options["max_files"])), stream(s, path, schema, **options))[1])
        catalog._windows_in_batches(spark, SMALL)
        batches = 4
    (path, at_once), = seen
    assert at_once > 1 and len(glob.glob(f"{path}/**/*.parquet", recursive=True)) == batches * at_once


def test_batches_of_more_spans_have_more_files_and_the_same_rows(spark, monkeypatch):
    """Deduplication on a stream reads a batch by as many tasks as it has spans for, and has five batches still."""
    told = lambda rows: sorted(map(tuple, rows.collect()))
    plain, paths, original = told(catalog.QUERIES["dedupe_spans_stream"](spark, SMALL)), {}, catalog.scratch_path
    monkeypatch.setattr(catalog, "FILE_SPANS", 1_000)
    monkeypatch.setattr(catalog, "scratch_path", lambda s, label: paths.setdefault(label, original(s, label)))
    assert told(catalog.QUERIES["dedupe_spans_stream"](spark, SMALL)) == plain != []
    assert len(glob.glob(f"{paths['light']}/*.parquet")) == 5 * 7  # 7,500 orders and lines


def test_pairing_by_generations_derives_its_spans_once(spark, light):
    spans = light([("a", "", "s1", "CLIENT"), ("b", "a", "s2", "SERVER"), ("b", "a", "s1", "CLIENT")])
    made = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            made.add(batch.num_rows)
            yield batch

    found = generations.window_pairs(spans.mapInArrow(counted, schemas.LIGHT_SPAN), 1_000)
    assert found.count() > 0 and made.value == 3


def test_a_span_is_cut_down_with_one_walk_over_its_events(raw):
    """Lambdas are interpreted; their sources are worked out again for each of them."""
    plan = light_spans(raw([]), ["tier"])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("lambdafunction") == 3  # the fields, those of damaged logs (two: whether and which)


def test_lines_are_spans_without_arrays_of_whole_spans(spark):
    plan = testbed.raw_spans(spark, SMALL).select("span_id")._jdf.queryExecution().optimizedPlan().toString()
    assert "sr" not in re.findall(r"\b[a-z]+\b", plan) and "enqueued" not in plan  # logs that nobody asks for are not made
