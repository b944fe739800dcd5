"""Conversation repair against a shortest-path search over turns and grammar states."""

import collections
import heapq
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from spanloom.llm import repair
from spanloom.llm.alignment import ENDINGS, align
from spanloom.llm.queries import op13_turn_repair

from .brute import sha

TURN = "conv_id long, turn long, role string, text string"
SPACE = " \t\n\x0b\x0c\r"


def cheapest(letters):
    """(cost, audit): the first goal of a search ordered by cost and audit."""
    heap, done = [(0, "", 0, "-")], set()
    while True:
        cost, audit, i, state = heapq.heappop(heap)
        if (i, state) in done:
            continue
        done.add((i, state))
        if i == len(letters) and state in "-a":
            return cost, audit
        needed = "a" if state == "u" else "u"
        heapq.heappush(heap, (cost + 3, audit + "I", i, needed))
        if i < len(letters):
            turn = letters[i]
            heapq.heappush(heap, (cost + 4, audit + "D", i + 1, state))
            if turn != "x":
                cut = 3 * turn.isupper()
                heapq.heappush(heap, (cost + 3 + cut, audit + "R", i + 1, needed))
                if turn.lower() == needed:
                    heapq.heappush(heap, (cost + cut, audit + "K", i + 1, needed))
                if turn.lower() == "s" and state == "-":
                    heapq.heappush(heap, (cost + cut, audit + "K", i + 1, "s"))


def brute(rows):
    """conv_id -> (gaps, blank, duplicate, truncated, illegal, cost, audit, hash) of damaged rows."""
    convs = collections.defaultdict(list)
    for conv, turn, role, text in rows:
        convs[conv].append((turn is not None, turn or 0, " " if role is None else role, " " if text is None else text))
    found = {}
    for conv, turns in convs.items():
        turns.sort()
        letters, seen, counts = "", set(), collections.Counter()
        for _, _, role, text in turns:
            plain = text.strip(SPACE)
            letter = role[:1] if role[:1] in ("s", "u", "a") else "o"
            if not plain or (role, text) in seen:
                counts["duplicate" if plain else "blank"] += 1
                letter = "x"
            elif plain[-1] not in ".!?":
                counts["truncated"] += 1
                letter = letter.upper()
            seen.add((role, text))
            letters += letter
        illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(turns, turns[1:]))
        numbers = {t for known, t, *_ in turns if known}
        gaps = max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0
        cost, audit = cheapest(letters)
        said, i, state = [], 0, "-"
        for edit in audit:
            role, text = (None, "") if edit == "I" else turns[i][2:]
            i += edit != "I"
            if edit != "D":
                needed = "a" if state == "u" else "u"
                system = edit == "K" and role[:1] == "s"
                state = "s" if system else needed
                said.append((role if edit == "K" else {"u": "user", "a": "assistant"}[needed]) + ":" + text)
        found[conv] = (gaps, counts["blank"], counts["duplicate"], counts["truncated"], illegal, cost, audit, sha("\n".join(said)))
    return found


def damaged(rows):
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        hit = zlib.crc32(":".join(" " if x is None else str(x) for x in (conv, turn)).encode()) % 20
        if hit:
            role = "user" if hit == 4 else role
            text = "" if hit == 1 else re.sub("[.!?]", "", text) if hit == 2 else text
            yield from [(conv, turn, role, text)] * (2 if hit == 3 else 1)


COLUMNS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def told(df):
    return {r.conv_id: tuple(r[c] for c in COLUMNS) for r in df.collect()}


@pytest.mark.parametrize("block", [1, 3, 64])
def test_audits_are_the_cheapest_and_least(block):
    rng = random.Random(block)
    for _ in range(1500):
        letters = "".join(rng.choice("suaoxSUAOuaua") for _ in range(rng.randrange(12)))
        ways = {"-": (0, "")}
        for at in range(0, len(letters), block):
            after = {}
            for pair, (cost, audit) in align(letters[at : at + block]).items():
                if pair[0] in ways:
                    way = (ways[pair[0]][0] + cost, ways[pair[0]][1] + audit)
                    after[pair[1]] = min(after.get(pair[1], way), way)
            ways = after
        assert min((c + ENDINGS[q][0], a + ENDINGS[q][1]) for q, (c, a) in ways.items()) == cheapest(letters), letters


def some_rows(rng, convs, most):
    texts = ["Yes.", "No!", "Why?", "cut off", "", " \t", "end. ", "so, \n", None, "é?", "x" * 3000]
    rows = []
    for conv in range(convs):
        for _ in range(rng.randrange(1, most)):
            turn = rng.choice([None, *range(most)]) if rng.random() < 0.1 else rng.randrange(3 * most)
            rows.append((conv, turn, rng.choice(["user", "assistant", "user", "assistant", "system", "tool", None, "", "usher"]), rng.choice(texts) if rng.random() < 0.5 else f"text {rng.random()}."))
    return rows + rows[:3]


def test_report_matches_brute_force(spark):
    rows = some_rows(random.Random(7), 120, 14) + [(None, t, r, "Hm.") for t, r in ((1, "user"), (2, "user"), (9, "assistant"))]
    assert told(repair.report(spark.createDataFrame(rows, TURN))) == brute(rows)


def test_a_long_conversation_is_spread_over_blocks(spark):
    rng = random.Random(3)
    rows = [(5, t, rng.choice(["user", "assistant"]), rng.choice(["a.", "b", "", f"{t}?"])) for t in range(700)] + some_rows(rng, 4, 9)
    df = spark.createDataFrame(rows, TURN).repartition(7)
    assert told(repair.report(df)) == brute(rows)
    edits = repair.repair(df).where("conv_id = 5").orderBy("place", "step").collect()
    kept = [e for e in edits if e.edit != "D"]
    assert "".join(e.edit for e in edits) == brute(rows)[5][6]
    assert [e.role for e in kept] == ["user", "assistant"] * (len(kept) // 2) and len({e.place for e in edits}) > 1


def test_clashing_columns_nothing_and_other_keys(spark):
    rows = some_rows(random.Random(9), 5, 6)
    df = spark.createDataFrame(rows, TURN)
    for name in ("place", "said", "again", "conv", "known", "first", "cost", "audit", "copies", "copy", "_hit", "texts"):
        df = df.withColumn(name, F.lit("mine"))
    assert told(repair.report(df)) == brute(rows)
    assert repair.damage(df).count() == len(list(damaged(rows)))
    assert repair.report(spark.createDataFrame([], TURN)).count() == 0
    named = spark.createDataFrame([("k", 1, "user", "Hm."), ("k", 2, "assistant", "Ah.")], TURN.replace("conv_id long", "conv_id string"))
    assert repair.report(named).first().audit == "KK"


def test_query_matches_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.01/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    expected = dict.fromkeys({r[0] for r in rows}, (0, 0, 0, 0, 0, 0, "", sha(""))) | brute(list(damaged(rows)))
    assert told(op13_turn_repair(spark, "/root/testdata/sf0.01")) == expected
    assert {e for v in expected.values() for e in v[6]} == set("DIKR")
