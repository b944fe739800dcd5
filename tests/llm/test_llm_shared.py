import random

import numpy as np
from .brute import Sets

from spanloom.llm.shared import ByteHashes, block_pairs, components, text_batches


def test_components_of_stars_chains_and_random_links(spark):
    rng = random.Random(1)
    links = [(0, i) for i in range(1, 60)] + [(i, i + 1) for i in range(100, 160)] + [(rng.randrange(200, 300), rng.randrange(200, 300)) for _ in range(60)]
    links += [(300, 300), (5, 0), (0, 5)]
    sets = Sets(range(301))
    for a, b in links:
        sets.join(a, b)
    found = {r.id: r.component for r in components(spark.createDataFrame(links, "a long, b long"), "test").collect()}
    linked = {x for a, b in links if a != b for x in (a, b)}
    assert found == {x: sets.find(x) for x in linked}


def test_components_without_links(spark):
    assert components(spark.createDataFrame([], "a long, b long"), "test").count() == 0


def test_every_two_rows_of_a_group_meet_once(spark):
    rows = spark.createDataFrame([("g", i) for i in range(23)] + [("h", 1), ("k", 1), ("k", 2)], "g string, id long")
    met = {}
    for r in block_pairs(rows, ["g"], "id", 5).collect():
        met.setdefault((r.g, r.block_a, r.block_b), []).append((r.id, r.own_block))
    pairs = {}
    for (g, a, b), inside in met.items():
        for i, own_i in inside:
            for j, own_j in inside:
                if i < j and (a == b or own_i != own_j):
                    pairs[g, i, j] = pairs.get((g, i, j), 0) + 1
    assert pairs == {("g", i, j): 1 for i in range(23) for j in range(i + 1, 23)} | {("k", 1, 2): 1}


def test_slices_hash_by_value():
    data = np.frombuffer(b"abcabcabd" * 3, dtype=np.uint8)
    grams = ByteHashes(data).grams(3)
    assert grams[0] == grams[3] and grams[0] != grams[6]
    assert (ByteHashes(data).of(np.array([0, 9]), np.array([9, 18])) == ByteHashes(data[9:]).of(np.array([0]), np.array([9]))).all()
    assert len(ByteHashes(data[:2]).grams(3)) == 0


def test_text_batches_keep_all_texts():
    texts = [None, "", "x" * 50, "ab", None, "c"]
    assert [t for part in text_batches(texts, 3) for t in part] == texts
