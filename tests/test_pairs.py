import itertools
import random

import pytest
from pyspark.sql import functions as F

from support import raw_span
from spanloom import schemas
from spanloom.operators import edges, pairs
from spanloom.operators.spans import light_spans

C, S, O = "CLIENT", "SERVER", "OTHER"


def found(frame):
    return sorted((r.client_service, r.server_service, r.client_span_id, r.shared) for r in frame.collect())


# (spans in order of arrival, calls, services registered as using shared ids), each written from one rule.
SCENARIOS = {
    "relay": ([("r", "", "web"), ("r.1", "r", "web"), ("a", "r.1", "auth"), ("a.1", "a", "auth"), ("d", "a.1", "db")], ["auth>db", "web>auth"], []),
    "within_one_service": ([("x", "", "solo"), ("y", "x", "solo"), ("z", "nowhere", "solo")], [], []),
    "roles": ([("c1", "", "shop", C), ("s1", "c1", "stock", S), ("c2", "s1", "stock", C), ("s2", "c2", "ledger", S)], ["shop>stock", "stock>ledger"], []),
    "parent_last": ([("d", "a.1", "db"), ("a.1", "a", "auth"), ("a", "r", "auth"), ("r", "", "web")], ["auth>db", "web>auth"], []),
    "fan": ([("f", "", "front"), ("g1", "f", "image"), ("g2", "f", "price"), ("g3", "f", "tax")], ["front>image", "front>price", "front>tax"], []),
    "delivered_twice": ([("p", "", "inner"), ("p", "", "inner"), ("q", "p", "outer"), ("q", "p", "outer")], ["inner>outer"], []),
    "one_id_two_ends": ([("s", "", "alpha", C), ("s", "", "beta", S)], ["alpha>beta"], ["beta"]),
    "refused_once_registered": ([("s", "", "alpha", C), ("s", "", "beta", S), ("t", "", "gamma", C), ("u", "t", "beta", S)], ["alpha>beta"], ["beta"]),
    "accepted_until_registered": ([("t", "", "gamma", C), ("u", "t", "beta", S), ("s", "", "alpha", C), ("s", "", "beta", S), ("v", "", "delta", C), ("w", "v", "beta", S)],
                                  ["alpha>beta", "gamma>beta"], ["beta"]),
}


def test_scenarios(spark):
    """Every scenario is a trace of its own, with services of its own."""
    rows = [
        (name, r[0], r[1], 1000, f"{name}/{r[2]}", "op", 1000, r[3] if len(r) > 3 else O, {}, seq)
        for name, (spans, _, _) in SCENARIOS.items() for seq, r in enumerate(spans)
    ]
    accepted = pairs.accepted_pairs(spark.createDataFrame(rows, schemas.LIGHT_SPAN)).persist()
    calls = sorted((r.trace_id, r.client_service, r.server_service) for r in accepted.collect())
    registered = sorted(r.service_name for r in pairs.shared_registry(accepted).collect())
    accepted.unpersist()
    assert calls == sorted(
        (name, *(f"{name}/{end}" for end in call.split(">"))) for name, (_, expected, _) in SCENARIOS.items() for call in expected
    )
    assert registered == sorted(f"{name}/{s}" for name, (_, _, services) in SCENARIOS.items() for s in services)


def test_isolated_and_shared_spans(raw):
    rows = []
    for i in range(10):
        rows += [raw_span(f"o{i}", f"x{i}", "foo"), raw_span(f"c{i}", f"y{i}", "foo", C), raw_span(f"s{i}", f"z{i}", "baz", S),
                 raw_span(f"p{i}", f"q{i}", "foo", C), raw_span(f"p{i}", f"q{i}", "baz", S)]
    rows = [(*r[:9], i) for i, r in enumerate(rows)]
    assert pairs.accepted_pairs(light_spans(raw(rows))).count() == 10


# --- the contract, simulated arrival by arrival ---------------------------------------------------------------------

def simulate(spans):
    """Pairs accepted when spans (seq, id, parent, service, type) arrive in order."""
    seen, holders, waiting, registry, accepted = set(), {}, {}, set(), []
    for span in spans:
        seq, span_id, parent, service, _ = span
        if (span_id, parent, service) in seen:
            continue
        seen.add((span_id, parent, service))
        holders.setdefault(span_id, []).append(span)
        if parent:
            waiting.setdefault(parent, []).append(span)
        met = []
        if len(holders[span_id]) == 2:
            met = [(holders[span_id][0], span)]
        elif len(holders[span_id]) == 1:
            met = [(p[0], span) for p in [holders.get(parent)] if p] + [(kid, span) for kid in waiting.get(span_id, [])]
        for one, two in met:
            roles = {}
            if one[1] == two[2]:
                defaults, shared = (C, S), False
            elif one[2] == two[1]:
                defaults, shared = (S, C), False
            else:
                defaults, shared = (O, O), True
            for half, default in ((one, defaults[0]), (two, defaults[1])):
                roles[default if half[4] == O else half[4]] = half
            client, server = roles.get(C), roles.get(S)
            if client and server and client[3] != server[3] and (shared or server[3] not in registry):
                accepted.append((client[3], server[3], client[1], shared))
                if shared:
                    registry.add(server[3])
    return sorted(accepted)


def random_spans(rng, case, cyclic):
    count = rng.randint(3, 14)
    ids = [f"i{n}" for n in range(rng.randint(2, 7))]
    spans = []
    for seq in range(count):
        at = rng.randrange(len(ids))
        parents = ids if cyclic else ids[:at]
        parent = rng.choice(parents) if parents and rng.random() < 0.8 else ""
        spans.append((seq, ids[at], parent, f"c{case}-s{rng.randrange(4)}", rng.choice([C, S, O])))
    return spans


@pytest.mark.parametrize("cyclic", [False, True])
def test_pairing_equals_simulation(spark, cyclic):
    rng = random.Random(7)
    cases = {str(case): random_spans(rng, case, cyclic) for case in range(400)}
    rows = [(trace, i, p, 1000 + seq, svc, "op", 1000, kind, {}, seq) for trace, spans in cases.items() for seq, i, p, svc, kind in spans]
    accepted = pairs.accepted_pairs(spark.createDataFrame(rows, schemas.LIGHT_SPAN))
    got = {trace: [] for trace in cases}
    for r in accepted.collect():
        got[r.trace_id].append((r.client_service, r.server_service, r.client_span_id, r.shared))
    assert sum(map(len, got.values())) > 500
    for trace, spans in cases.items():
        # More than two holders of one id: a later one that names itself is outside the contract.
        assert sorted(got[trace]) == simulate(spans), spans


def test_one_id_and_one_parent_hold_most_spans(spark):
    """A span id and a parent id repeated over and over pair exactly as the contract says."""
    spans = [(0, "root", "", "gate", C)]
    spans += [(1 + n, "hot", f"p{n}", f"s{n % 50}", (C, S, O)[n % 3]) for n in range(600)]
    spans += [(601 + n, f"kid{n}", "root", f"k{n % 40}", O) for n in range(600)]
    spans += [(1201 + n, f"p{n}", "", "late", C) for n in range(600)]
    rows = [("t", i, p, 1000, svc, "op", 1000, kind, {}, seq) for seq, i, p, svc, kind in spans]
    frame = spark.createDataFrame(rows, schemas.LIGHT_SPAN)
    assert found(pairs.accepted_pairs(frame)) == simulate(spans)


def test_scope(light):
    rows = [("a", "", "s1", C), ("b", "a", "s2", S)]
    both = light(rows[:1], trace="t1").unionByName(light(rows[1:], trace="t2", start=1))
    assert pairs.span_pairs(both).count() == 0
    assert pairs.span_pairs(both, ()).count() == 1


def test_final_mode_and_given_registry(spark, light):
    rows = [("I1", "", "svc1", C), ("I3", "I1", "svc3", S), ("I4", "", "svc2", C), ("I4", "", "svc3", S)]
    spans = light(rows)
    assert [p[0] for p in found(pairs.accepted_pairs(spans))] == ["svc1", "svc2"]
    assert [p[0] for p in found(pairs.accepted_pairs(spans, mode="final"))] == ["svc2"]
    given = spark.createDataFrame([("svc3", True, 0)], schemas.REGISTRY)
    assert [p[0] for p in found(pairs.accepted_pairs(spans, registry=given))] == ["svc2"]
    with pytest.raises(ValueError):
        pairs.accepted_pairs(spans, mode="never")


def test_interval(light):
    near = light([("a", "", "s1", C)], time_ms=1000).unionByName(light([("b", "a", "s2", S)], time_ms=1050, start=1))
    assert pairs.within_interval(pairs.span_pairs(near), 50).count() == 1
    assert pairs.within_interval(pairs.span_pairs(near), 49).count() == 0


def test_edge_and_latency(raw):
    spans = light_spans(raw([
        raw_span("k7", "", "till", C, start_ms=81_000, duration_us=9_400, seq=1, tags=[("tier", "edge")]),
        raw_span("k7", "", "bank", S, start_ms=81_004, duration_us=2_300, seq=2, tags=[("error", "true")]),
    ]), ["tier"])
    accepted = pairs.accepted_pairs(spans)
    edge = edges.graph_edges(accepted).first()
    assert (edge.source, edge.destination, edge.operation, edge.source_timestamp) == ("till", "bank", "oper", 81_000)
    assert (edge.source_tags, edge.destination_tags, edge.pair_key) == ({"tier": "edge"}, {"error": "true"}, "k7")
    point = edges.latency_points(accepted).first()
    assert (point.value, point.epoch_seconds, point.tags["serviceName"]) == (7.0, 81, "till")


def test_latency_truncates_toward_zero(light):
    slow = light([("a", "", "s1", C)], duration_us=500).unionByName(light([("b", "a", "s2", S)], duration_us=1999, start=1))
    assert edges.latency_points(pairs.span_pairs(slow)).first().value == -1.0


def test_pairing_scans_its_source_once(spark, tmp_path, light):
    """All uses of the distinct spans share one shuffle of the scanned source."""
    light([("a", "", "s1", C), ("b", "a", "s2", S), ("b", "a", "s1", C)]).write.parquet(str(tmp_path / "s"))
    frame = pairs.accepted_pairs(spark.read.parquet(str(tmp_path / "s")))
    frame.collect()
    final = frame._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert final.count("FileScan parquet") == 1
    assert "Cartesian" not in final and "NestedLoop" not in final
