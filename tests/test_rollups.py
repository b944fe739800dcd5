"""Graphs over ranges: dyadic roll-ups and SQL table functions against the plain query."""

import random

from spanloom import schemas
from spanloom.plans import graph, rollups
from spanloom.streaming import windows

WINDOW = 300_000
DAY = 86_400_000


def some_windows(rng, count):
    values = [None, "", ",", ",,", "a", "b,a", "a,,c", "c,", "é"]
    rows = []
    for n in range(count):
        for source, destination, operation in {(rng.choice("xyz"), rng.choice("uvw"), rng.choice("12")) for _ in range(4)}:
            tags = [{k: v for k in ("tier", "zone") if (v := rng.choice(values)) is not None} for _ in range(2)]
            rows.append((n * WINDOW, (n + 1) * WINDOW, source, destination, operation, rng.randrange(1, 9), n * WINDOW + rng.randrange(WINDOW), rng.randrange(2), *tags))
    return rows


def told(df):
    return sorted((r.source, r.destination, r["count"], r.last_seen, r.error_count, r.effective_from, r.effective_to, sorted(r.source_tags.items()), sorted(r.destination_tags.items())) for r in df.collect())


def test_cover_is_exact_and_logarithmic():
    rng = random.Random(1)
    for _ in range(300):
        first = rng.randrange(5_000)
        last = first + rng.randrange(3_000)
        found = rollups.cover(first, last)
        windows_of = [w for level, node in found for w in range(node << level, (node + 1) << level)]
        assert windows_of == list(range(first, last + 1))
        assert len(found) <= 2 * (last - first + 1).bit_length() + (last - first + 1 >> rollups.LEVELS - 1)
    assert rollups.cover(5, 4) == []


def test_rollups_add_up_to_the_plain_graph_and_read_few_nodes(spark, tmp_path):
    rng = random.Random(2)
    rows = some_windows(rng, 40)
    first = spark.createDataFrame([r for r in rows if r[0] // WINDOW % 4 != 1], schemas.WINDOWED_EDGE)
    windowed, table, now = spark.createDataFrame(rows, schemas.WINDOWED_EDGE), str(tmp_path / "rollups"), 39 * WINDOW + 7
    rollups.update_rollups(first, table, WINDOW, {r[0] for r in rows if r[0] // WINDOW % 4 != 1}, levels=6)
    assert told(rollups.rollup_service_graph(spark, table, WINDOW, now, 0, now, levels=6)) == told(graph.service_graph(first, WINDOW, now, 0, now))
    rollups.update_rollups(windowed, table, WINDOW, {r[0] for r in rows if r[0] // WINDOW % 4 == 1}, levels=6)  # late windows
    rollups.update_rollups(windowed, table, WINDOW, [], levels=6)
    for lower, upper in ((3 * WINDOW + 5, 37 * WINDOW), (0, now), (7 * WINDOW, 7 * WINDOW), (90 * WINDOW, 95 * WINDOW)):
        found = rollups.rollup_service_graph(spark, table, WINDOW, now, lower, upper, levels=6)
        assert told(found) == told(graph.service_graph(windowed, WINDOW, now, lower, upper))
        nodes = {"/".join(f.split("/")[-3:-1]) for f in found.inputFiles()}
        assert nodes <= {f"level={k}/node={n}" for k, n in rollups.cover(lower // WINDOW, upper // WINDOW, 6)} and len(nodes) <= 10
    assert rollups.drop_rollups_before(spark, table, 16 * WINDOW, WINDOW, levels=6) == 16 + 8 + 4 + 2 + 1
    late = (16 * WINDOW, 39 * WINDOW)
    assert told(rollups.rollup_service_graph(spark, table, WINDOW, now, *late, levels=6)) == told(graph.service_graph(windowed, WINDOW, now, *late))


def test_table_functions_give_the_plain_graph_and_prune_days(spark, tmp_path):
    rows = [(r[0] * 40, r[0] * 40 + WINDOW, *r[2:]) for r in some_windows(random.Random(3), 30)]  # four days
    windowed, table, now = spark.createDataFrame(rows, schemas.WINDOWED_EDGE), str(tmp_path / "windowed"), 3 * DAY + 1_234
    windows.write_windowed_edges(windowed, table)
    graph.register_graph_functions(windows.read_windowed_edges(spark, table), WINDOW, now)
    ask = lambda call: spark.sql(f"SELECT * FROM {call}")
    lower, upper = DAY + 12_345, 2 * DAY - 1
    assert told(ask(f"servicegraph({lower}, {upper})")) == told(graph.service_graph(windowed, WINDOW, now, lower, upper)) != []
    assert told(ask("servicegraph()")) == told(graph.service_graph(windowed, WINDOW, now))
    assert told(ask(f"operationgraph(to_ms => {now - 9})")) == told(graph.operation_graph(windowed, WINDOW, now, None, now - 9))
    for call in (f"servicegraph({lower}, {upper})", f"operationgraph({lower}, {upper})"):
        plan = ask(call)._jdf.queryExecution().executedPlan().toString()
        assert "window_date#" in plan.split("PartitionFilters: [")[1].split("PushedFilters")[0]
        assert ">= 1970-01-02" in plan and "<= 1970-01-02" in plan and "GreaterThanOrEqual(window_start,86400000)" in plan
