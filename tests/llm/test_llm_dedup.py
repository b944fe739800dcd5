"""Near copies, repeated passages and linked embeddings against brute force."""

import random

import numpy as np
import pandas as pd
import pytest
from .brute import Sets, near_classes, repeats, repeats_report
from pyspark.sql import functions as F

from spanloom.llm import minhash, repeats as passages, vectors
from spanloom.llm.shingles import weighted
from spanloom.llm.suffixes import PERIOD, Block, shifts

VOCABULARY = [f"w{i}" for i in range(400)]


def some_words(rng, n):
    return [rng.choice(VOCABULARY) for _ in range(n)]


def near_docs():
    rng = random.Random(4)
    docs, next_id = [], 0
    for size in (3, 5, 8, 40, 200, 900):
        for copies in (1, 2, 6):
            base = some_words(rng, size)
            for k in range(copies):
                text = list(base)
                for _ in range(k * size // 150):
                    text[rng.randrange(size)] = rng.choice(VOCABULARY)
                docs.append((next_id, rng.choice([" ", ", ", "\n"]).join(text)))
                next_id += 1
    stutter = some_words(rng, 6) * 40
    docs += [(next_id, " ".join(stutter)), (next_id + 1, " ".join(stutter[:-20])), (next_id + 2, " ".join(stutter[:60]))]
    docs += [(next_id + 3, None), (next_id + 4, ""), (next_id + 5, "?!"), (next_id + 6, "Été 日本"), (next_id + 7, "été 日本"), (next_id + 8, "Éte 日本")]
    rng.shuffle(docs)
    return docs


def test_near_copies_against_brute_force(spark):
    docs = near_docs()
    table = spark.createDataFrame(docs, "doc_id long, text string").withColumn("n", F.lit("clash"))
    found = {r.doc_id: r.class_id for r in minhash.near_copies(table, block=4).collect()}
    assert found == near_classes(docs)


def test_repeated_rows_and_ids_that_are_missing(spark):
    text = " ".join(VOCABULARY[:30])
    rows = [(1, text), (1, text), (2, text), (None, text), (None, None), (3, "other words altogether in this one")]
    table = spark.createDataFrame(rows, "doc_id long, text string").withColumn("key", F.lit(7))
    assert sorted((r.doc_id or 0, r.class_id or 0) for r in minhash.near_copies(table).collect()) == [(0, 0), (0, 0), (1, 1), (1, 1), (2, 1), (3, 3)]
    kept = minhash.drop_near_copies(table)
    assert kept.columns == table.columns
    assert sorted((r.doc_id or 0) for r in kept.collect()) == [0, 0, 1, 3]
    assert minhash.near_copies(table.limit(0)).count() == 0
    assert minhash.drop_near_copies(table.limit(0)).count() == 0


def test_large_group_of_near_copies_is_one_class(spark):
    rng = random.Random(5)
    base = some_words(rng, 120)
    docs = []
    for i in range(300):
        text = list(base)
        text[rng.randrange(120)] = f"x{i}"
        docs.append((i, " ".join(text)))
    found = minhash.near_copies(spark.createDataFrame(docs, "doc_id long, text string"), block=32)
    assert found.where("class_id <> 0").count() == 0 and found.count() == 300


def test_coordinates_agree_as_often_as_weights_overlap():
    texts = [" ".join(f"a{i}" for i in range(400)), " ".join(f"a{i}" for i in range(100, 500)), "b c d e f " * 30, "b c d e f " * 20]
    owner, code, times = weighted(texts)
    best = minhash.signatures(owner, code, times.astype(float), 4, k=4096)
    for a, b in ((0, 1), (2, 3), (0, 2)):
        bags = [dict(zip(code[owner == t], times[owner == t])) for t in (a, b)]
        common = sum(min(w, bags[1].get(e, 0)) for e, w in bags[0].items())
        similar = common / (sum(bags[0].values()) + sum(bags[1].values()) - common)
        assert abs((best[a] == best[b]).mean() - similar) < 0.04
    halves = minhash.signatures(owner, code, times / 2, 4, k=4096)
    assert abs((halves[2] == halves[3]).mean() - 0.66) < 0.05


def test_signatures_do_not_depend_on_neighbours():
    texts = ["one two three four five six seven", "x y z", None, "one two three four five six seven"]
    together = minhash._describe(texts)
    for i, t in enumerate(texts):
        alone = minhash._describe([t])
        assert all(np.array_equal(a[i], b[0]) for a, b in zip(together, alone))


def passage_docs():
    rng = random.Random(6)
    letters = lambda n, of="abcdefgh ": "".join(rng.choice(of) for _ in range(n))
    shared = [letters(n) for n in (99, 100, 101, 130, 400)]
    docs = []
    for i in range(60):
        parts = [letters(rng.randrange(60))]
        for _ in range(rng.randrange(4)):
            passage = rng.choice(shared)
            a = rng.randrange(0, 20)
            parts += [passage[a:] if rng.random() < 0.4 else passage, letters(rng.randrange(40))]
        docs.append((rng.randrange(10**6), "".join(parts)))
    docs += [(-1, "z" * 350), (-2, "xy" * 200), (-3, None), (-4, ""), (-5, "é" * 120), (-6, "é" * 60 + "z" * 120), (-7, letters(100)), (-8, "日本語" * 50 + letters(90))]
    docs += [(-9, docs[3][1]), (-10, shared[4] + "Z" + shared[4]), (-11, letters(3000, "ab")), (-12, letters(3000, "ab"))]
    return docs


@pytest.mark.parametrize("wide", [passages.WIDE, 2])
def test_repeats_against_brute_force(spark, monkeypatch, wide):
    monkeypatch.setattr(passages, "WIDE", wide)
    monkeypatch.setattr(passages, "BLOCK_BYTES", 3000)
    docs = passage_docs()
    assert len({d for d, _ in docs}) == len(docs)
    table = spark.createDataFrame(docs, "doc_id long, text string").withColumn("runs", F.lit(1)).repartition(3)
    assert sorted(tuple(r) for r in passages.report(table).collect()) == sorted(repeats_report(docs))


@pytest.mark.parametrize("wide", [passages.WIDE, 2])
def test_repeats_in_buckets_cut_finer(spark, monkeypatch, wide):
    monkeypatch.setattr(passages, "FINE", 1)
    monkeypatch.setattr(passages, "WIDE", wide)
    docs = passage_docs()
    table = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    assert sorted(tuple(r) for r in passages.report(table).collect()) == sorted(repeats_report(docs))


def test_a_common_string_with_other_surroundings_costs_no_row_per_suffix(spark, monkeypatch):
    monkeypatch.setattr(passages, "FINE", 4, raising=False)
    monkeypatch.setattr(passages, "WIDE", 4)
    rng, made, original = random.Random(9), [], passages._sorted_buckets
    letters = lambda n: "".join(rng.choice("abcdefgh") for _ in range(n))
    common = letters(60)
    docs = [(i, letters(150) + common + letters(150)) for i in range(40)]
    monkeypatch.setattr(passages, "_sorted_buckets", lambda chunks: (made.append(original(chunks)), made[-1])[1])
    table = spark.createDataFrame(docs, "doc_id long, text string")
    assert sorted(tuple(r) for r in passages.report(table).collect()) == sorted(repeats_report(docs))
    assert made[0].count() == 0  # one row for each of over a thousand suffixes before


def test_repeats_of_rows_alike_and_without_id(spark):
    rng = random.Random(7)
    text = "".join(rng.choice("abcdefgh ") for _ in range(250))
    docs = [(1, text), (1, text), (None, text[:180]), (None, None), (2, text[50:] + "é"), (2, None)]
    table = spark.createDataFrame(docs, "doc_id long, text string")
    key = lambda r: tuple((x is not None, x) for x in r)
    assert sorted((tuple(r) for r in passages.report(table).collect()), key=key) == sorted(repeats_report(docs), key=key)
    assert passages.report(table.limit(0)).count() == 0


def test_cut_texts_keep_whole_characters(spark):
    docs = passage_docs()
    table = spark.createDataFrame([(d, t, "s") for d, t in docs], "doc_id long, text string, place string")
    cut = passages.drop_repeats(table)
    assert cut.columns == table.columns
    found = {r.doc_id: r.text for r in cut.collect()}
    texts = dict(docs)
    for doc, gone, data in repeats(docs):
        kept, at = [], 0
        for c in texts[doc] or "":
            size = len(c.encode())
            if not all(gone[at : at + size]):
                kept.append(c)
            at += size
        assert found[doc] == (None if texts[doc] is None else "".join(kept))


def test_suffix_blocks_sort_like_byte_strings():
    assert shifts(PERIOD).max() < PERIOD
    rng = random.Random(8)
    for alphabet in (b"ab", b"a", bytes(range(256))):
        text = bytes(rng.choice(alphabet) for _ in range(900))
        block = Block(np.frombuffer(text, dtype=np.uint8), 100)
        bucket = np.arange(800) % PERIOD
        order, new = block.equal_runs(np.arange(800), bucket)
        rows = [(int(bucket[i]), text[i : i + 100]) for i in order]
        assert rows == sorted(rows)
        assert new.tolist() == [True] + [a != b for a, b in zip(rows[1:], rows)]


def linked(rows, threshold=0.98):
    """vec_id -> (links, component) for (vec_id, vector, label)."""
    sound = [(i, np.array(v, dtype=float), x) for i, v, x in rows if v and x is not None and all(c is not None and np.isfinite(c) for c in v) and any(v)]
    sets, links = Sets([r[0] for r in rows]), dict.fromkeys([r[0] for r in rows], 0)
    for k, (i, a, x) in enumerate(sound):
        for j, b, y in sound[:k]:
            if x == y and len(a) == len(b) and a @ b / np.linalg.norm(a) / np.linalg.norm(b) >= threshold:
                links[i] += 1
                links[j] += 1
                sets.join(i, j)
    return {i: (links[i], sets.find(i)) for i in links}


def vector_rows():
    rng = np.random.default_rng(9)
    rows, next_id = [], 0
    for label in (1, 2, None):
        for size in (1, 1, 1, 3, 40):
            base = rng.normal(size=16)
            for _ in range(size):
                rows.append((next_id, (base + 0.04 * rng.normal(size=16)).tolist(), label))
                next_id += 1
    rows += [(next_id + k, rows[10][1], 1) for k in range(5)]
    rows += [(next_id + 5, [2 * x for x in rows[10][1]], 1), (next_id + 6, [0.0] * 16, 1), (next_id + 7, None, 1), (next_id + 8, [], 1), (next_id + 9, [float("nan")] * 16, 1)]
    rows += [(next_id + 10, [None] + rows[10][1][1:], 1), (next_id + 11, [float("inf")] + rows[10][1][1:], 1), (next_id + 12, rows[10][1][:8], 1), (next_id + 13, rows[10][1][:8], 1)]
    rows += [(next_id + 14, [1e-200 * x for x in rows[10][1]], 1), (next_id + 15, [-x for x in rows[10][1]], 1)]
    return rows


def test_a_close_pair_that_shares_one_pivot_links():
    a, b = np.eye(8)[0], np.eye(8)[0] + 0.1 * np.eye(8)[1]
    lists = np.arange(8, dtype=np.int32), np.array([0, *range(11, 18)], dtype=np.int32)
    rows = [(0, 0, 0, (v / np.linalg.norm(v)).tobytes(), n.tobytes(), 1, k, 0) for k, (v, n) in enumerate(zip((a, b), lists))]
    group = pd.DataFrame(rows, columns=["pivot", "block_a", "block_b", "unit", "nearest", "copies", "key", "own_block"])
    assert vectors._links(group, 0.98, vectors.SHARED)["links"].tolist() == [1, 1]


@pytest.mark.parametrize("block", [vectors.BLOCK, 4])
def test_links_against_brute_force(spark, block):
    # With all pivots listed every pair is a candidate, so nothing may be missing.
    rows = vector_rows()
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumn("key", F.lit("clash"))
    found = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in vectors.link_vectors(table, nearest=64, shared=1, block=block).collect()}
    expected = linked([(i, [1e200 * x for x in v] if v and i == len(rows) - 2 else v, x) for i, v, x in rows])
    assert found == {i: (n, c, i == c) for i, (n, c) in expected.items()}


def test_links_of_nothing_and_recall(spark):
    table = spark.createDataFrame(vector_rows(), "vec_id long, embedding array<double>, label int")
    assert vectors.link_vectors(table.limit(0)).count() == 0
    given = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    expected = {}
    for label in [r.label for r in given.select("label").distinct().collect()]:
        own = [(r.vec_id, [float(x) for x in r.embedding], r.label) for r in given.where(F.col("label") == label).collect()]
        unit = np.array([v for _, v, _ in own])
        unit /= np.linalg.norm(unit, axis=1, keepdims=True)
        near = unit @ unit.T >= 0.98
        expected |= {i: int(n) - 1 for (i, _, _), n in zip(own, near.sum(axis=1))}
    found = {r.vec_id: r.n_links for r in vectors.link_vectors(given).collect()}
    assert found.keys() == expected.keys() and all(found[i] <= expected[i] for i in found)
    assert sum(found.values()) >= 0.9 * sum(expected.values())
