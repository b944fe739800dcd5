import re

import pytest

import __spark_entry__ as entry
from check_oracles import compare, duck

SF_DIR = "/root/testdata/sf0.001"
# A cross-section; tools/check_oracles.py runs them all.
CHOSEN = ["span_type", "collect_tags", "dedupe_spans", "merge_style_filter", "edge_stats", "service_graph", "snapshot_csv_read", "graph_json_write", "tumbling_window"]


@pytest.fixture(scope="module")
def connection():
    return duck(SF_DIR)


@pytest.mark.parametrize("name", CHOSEN)
def test_matches_oracle(spark, connection, name):
    assert compare(spark, connection, SF_DIR, entry.queries()[name], entry.oracle_sql()[name]) is None


def test_entry_and_registry(spark):
    assert entry.entry(spark).count() > 0
    ours = {name for name in entry.queries() if not (name == "pipeline" or re.match(r"op\d+_", name))}
    assert ours == set(entry.oracle_sql()) & ours
