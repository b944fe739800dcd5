"""Pairing with re-used ids against a plain replay, and against the stream."""

import random

import pytest

from spanloom import schemas
from spanloom.operators import edges as edge_ops
from spanloom.operators import generations
from spanloom.operators.pairs import merge_style_filter
from spanloom.operators.spans import light_spans
from spanloom.sources import tables
from spanloom.streaming import pairing
from support import raw_span

INTERVAL = 1_000


def some_spans(rng, n, spread):
    rows = []
    for seq in range(n):
        kind = rng.choice(["CLIENT", "SERVER", "OTHER"])
        start = rng.randrange(spread)
        rows.append((rng.choice("tu"), rng.choice("abc"), rng.choice(["", "a", "b", "c", "z"]), start, rng.choice(["s1", "s2", "s3"]), "op", rng.randrange(2_000) * 1000, kind, {}, seq))
    return rows + [(*r[:9], n + i) for i, r in enumerate(rows[: n // 8])]  # some delivered again


def replay(rows):
    """(server service, client service, emit seq, shared) of every match, from the definition."""
    def end(r):
        return r[3] + r[6] // 1000

    found, lives = [], {}
    ids = {}
    for r in sorted(rows, key=lambda r: (r[3], r[9])):
        gens = ids.setdefault((r[0], r[1]), [])
        if not gens or max(end(x) for g in gens for x in g) <= r[3] - INTERVAL:
            gens.append([])
        gens[-1].append(r)
    for key, gens in ids.items():
        distinct = []
        for gen in gens:
            once = {}
            for r in sorted(gen, key=lambda r: r[9]):
                once.setdefault((r[1], r[2], r[4]), r)
            distinct.append(list(once.values()))
        lives[key] = [(min(r[3] for r in g), max(map(end, g)) + INTERVAL, g) for g in distinct]

    def add(left, right, same_id, left_is_first):
        before = left[9] < right[9]
        if left[4] == right[4] or not (same_id or left_is_first or before):
            return
        names_right, names_left = left[2] == right[1], right[2] == left[1]
        left_calls = names_left and ((same_id and not names_right) or (not same_id and before))
        right_calls = names_right and not left_calls
        plays = lambda r, role, link: r[7] == role or (r[7] == "OTHER" and link)
        if plays(left, "CLIENT", left_calls) and plays(right, "SERVER", left_calls):
            client, server = left, right
        elif plays(right, "CLIENT", right_calls) and plays(left, "SERVER", right_calls):
            client, server = right, left
        else:
            return
        found.append((client[4], client[3], server[4], server[3], max(left[9], right[9]), same_id and not names_right and not names_left))

    for key, gens in lives.items():
        for _, _, holders in gens:
            if len(holders) > 1:
                add(holders[1], holders[0], True, False)
            for rank, x in enumerate(holders):
                forgotten = None
                for start, until, others in lives.get((x[0], x[2]), []) if x[2] else []:
                    held = start <= x[3] < until
                    waits = x[3] < start < end(x) + INTERVAL and (forgotten is None or forgotten <= x[3])
                    if held or waits:
                        add(x, others[0], False, rank == 0)
                    forgotten = until
    return sorted(found)


@pytest.mark.parametrize("spread, width", [(3_000, 500), (60_000, 700), (200_000, 60_000)])
def test_pairs_equal_a_replay(spark, spread, width):
    rows = some_spans(random.Random(spread), 220, spread)
    pairs = generations.window_pairs(spark.createDataFrame(rows, schemas.LIGHT_SPAN).repartition(5), INTERVAL, width_ms=width).collect()
    assert sorted((r.client_service, r.client_time_ms, r.server_service, r.server_time_ms, r.emit_seq, r.shared) for r in pairs) == replay(rows) != []


def test_batch_and_stream_agree_on_ids_used_again(spark, tmp_path):
    rng, batches, seq = random.Random(4), [], 0
    for hour in range(4):
        rows = []
        for trace in "tuvw":
            for span_id, parent, service, kind in (("a", "", "s1", "CLIENT"), ("a", "", "s2", "SERVER"), ("k", "a", rng.choice(["s3", "s4"]), None), ("m", "k", "s5", None)):
                if rng.random() < 0.7:
                    rows.append(raw_span(span_id, parent, service, kind, start_ms=1_700_000_000_000 + hour * 3_600_000 + seq, seq=seq, trace=trace))
                    seq += 1
        batches.append(rows)
    job = pairing.SpanJob(str(tmp_path / "job"), interval_ms=INTERVAL)
    for i, rows in enumerate(batches):
        job.process(spark.createDataFrame(rows, schemas.SPAN), i, stream_ms=1_700_000_000_000 + (i + 1) * 3_600_000 - 1)
    light = light_spans(spark.createDataFrame([r for rows in batches for r in rows], schemas.SPAN))
    pairs = generations.window_pairs(light, INTERVAL)
    told = lambda edges: sorted((r.pair_key, r.source, r.destination, r.source_timestamp) for r in edges.collect())
    assert told(edge_ops.graph_edges(merge_style_filter(pairs))) == told(tables.read_table(spark, job.table("edges"), schemas.EDGE)) != []


def test_no_spans(spark):
    assert generations.window_pairs(spark.createDataFrame([], schemas.LIGHT_SPAN), INTERVAL).count() == 0
