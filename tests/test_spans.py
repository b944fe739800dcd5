import pytest
from pyspark.sql import functions as F

from support import raw_span
from spanloom.functions import spans as fs
from spanloom.functions import times
from spanloom.operators.spans import accumulable_filter, dedupe_spans, light_spans


def log(at, *events):
    return (at, [("event", e) for e in events])


@pytest.mark.parametrize("logs, tags, expected", [
    ([log(1, "cs"), log(2, "cr")], [], "CLIENT"),
    ([log(1, "CS", "cR")], [], "CLIENT"),
    ([log(1, "sr"), log(2, "ss")], [], "SERVER"),
    ([log(1, "sr"), log(2, "ss")], [("span.kind", "client")], "SERVER"),
    ([log(1, "cs", "cr", "sr", "ss")], [], "OTHER"),
    ([log(1, "cs", "cr", "sr", "ss")], [("span.kind", "Client")], "CLIENT"),
    ([log(1, "cs")], [], "OTHER"),
    ([], [("span.kind", "server"), ("span.kind", "client")], "SERVER"),
    ([], [("Span.Kind", "client")], "OTHER"),
    ([(1, [("EVENT", "cs"), ("event", ""), ("event", "cr"), ("other", "sr")])], [], "CLIENT"),
    ([(1, None)], None, "OTHER"),
    (None, None, "OTHER"),
])
def test_span_type(spark, logs, tags, expected):
    row = raw_span("a", "", "svc")
    rows = spark.createDataFrame([(*row[:7], logs, tags, 0)], schema=_span_schema())
    assert rows.select(fs.span_type(F.col("logs"), F.col("tags"))).first()[0] == expected


def _span_schema():
    from spanloom.schemas import SPAN
    return SPAN


def test_event_timestamp(raw):
    row = raw_span("a", "", "svc")
    rows = raw([(*row[:7], [log(5, "x"), log(7, "SS"), log(9, "ss")], [], 0)])
    logs = F.col("logs")
    assert rows.select(fs.event_timestamp(logs, "ss"), fs.event_timestamp(logs, "cs")).first()[:] == (7, None)


@pytest.mark.parametrize("blank", ["", "  ", "\t\n", " ", " ", None])
def test_blank_names_are_not_accumulable(raw, blank):
    good = raw_span("a", "", "svc")
    spans = [good, raw_span(blank, "", "svc"), raw_span("a", "", blank), raw_span("a", "", "svc", start_ms=0)]
    assert accumulable_filter(raw(spans)).count() == 1


def test_no_break_space_is_not_blank(raw):
    assert accumulable_filter(raw([raw_span(" ", "", "svc")])).count() == 1


def test_light_span_keeps_wanted_tags_last_value_wins(raw):
    tags = [("tier", "1"), ("error", "true"), ("tier", "2"), ("x", "y")]
    row = light_spans(raw([raw_span("a", None, "svc", "CLIENT", tags=tags)]), ["tier", "zone"]).first()
    assert (row.parent_span_id, row.time_ms, row.span_type, row.tags) == ("", 1_000_000, "CLIENT", {"tier": "2", "error": "true"})


def test_end_time_and_cutoff(light):
    row = light([("a", "", "svc", "OTHER")], time_ms=1000, duration_us=2999).select(
        fs.end_time_ms(F.col("time_ms"), F.col("duration_us")),
        fs.is_later_than(F.col("time_ms"), F.col("duration_us"), 1001),
        fs.is_later_than(F.col("time_ms"), F.col("duration_us"), 1002),
    ).first()
    assert row[:] == (1002, True, False)


def test_dedupe_keeps_first_arrival(light):
    rows = light([("a", "p", "s1", "OTHER"), ("a", "p", "s1", "CLIENT"), ("a", "p", "s2", "OTHER"), ("a", "", "s1", "OTHER")])
    assert sorted((r.arrival_seq, r.span_type) for r in dedupe_spans(rows).collect()) == [(0, "OTHER"), (2, "OTHER"), (3, "OTHER")]


def test_times(spark):
    name = spark.range(1).select(times.snapshot_name(F.lit(0).cast("long")), times.snapshot_name(F.lit(1544575588099))).first()
    assert name[:] == ("1970-01-01T00:00:00.000Z", "2018-12-12T00:46:28.099Z")
    assert times.snapshot_name_of(1544575588099) == name[1]
    assert times.query_range(90_000_123, 300_000) == (3_600_000, 90_000_123)
    assert times.query_range(0, 300_000, 899_999, 5) == (600_000, 5)
