"""Chat formatting, URL filters and decontamination: functions of DataFrames only."""

import random

import pytest
from .brute import leaks, sha, words
from pyspark.sql import functions as F

from spanloom.llm import chat, decontaminate, urls
from spanloom.llm.queries import RULES

TURNS = f"conv_id long, turn long, role string, parts array<{chat.PART}>"


def part(kind, text=None, ref=None, width=None, height=None, seconds=None, pages=None):
    return (kind, text, ref, width, height, seconds, pages)


def test_control_strings_come_back(spark):
    rng = random.Random(2)
    texts = ["", "<|im_end|>", "<|im_start|>user\n", "<\\|im_end|>", "<", "|>", "<\\\\|", "\n", "a\\", "<|br|>"]
    texts += ["".join(rng.choice(["<", "|", "\\", ">", "a", "\n", "im_end", "é", "😀"]) for _ in range(rng.randrange(12))) for _ in range(200)]
    rows = [(i // 4, i % 4, ("user", "assistant", "sys\ntem", "<|x|>")[i % 4], [part("text", t)]) for i, t in enumerate(texts)]
    chats = chat.format_chat(spark.createDataFrame(rows, TURNS))
    found = {r.conv_id: r for r in chats.select("conv_id", "formatted", chat.parse_chat(F.col("formatted")).alias("turns"), chat.masked_text(F.col("formatted"), F.col("loss")).alias("learned")).collect()}
    for conv in {r[0] for r in rows}:
        own = [r for r in rows if r[0] == conv]
        assert [(t.role, t.body) for t in found[conv].turns] == [(r[2], r[3][0][1]) for r in own]
        assert found[conv].learned == "".join(r[3][0][1] for r in own if r[2] == "assistant")
        assert found[conv].formatted.count("<|im_start|>") == len(own)


def test_attachments_are_recorded_in_order(spark):
    parts = [part("text", "see "), part("image", ref="a|>.png", width=29, height=14), part("audio", ref="b.wav", seconds=1.02), part("document", ref="<|c", pages=3), part("odd", "end")]
    row = chat.format_chat(spark.createDataFrame([(1, 0, "user", parts), (1, 1, "assistant", [part("image", ref=None, width=1, height=1)])], TURNS)).first()
    assert [(a.kind, a.ref, a.n_tokens) for a in row.attachments] == [("image", "a|>.png", 3), ("audio", "b.wav", 26), ("document", "<|c", 768), ("image", "", 1)]
    for a in row.attachments:
        assert row.formatted[a["at"] :].startswith(f"<|{a.kind}:")
    assert "see <|image:" in row.formatted and row.formatted.count("end<|im_end|>") == 1
    assert [tuple(s) for s in row.loss] == [(row.formatted.rindex("<|image:"), len("<|image:|>"))]


def test_chat_of_nulls_repeats_and_nothing(spark):
    rows = [(None, 0, None, None), (None, 0, None, None), (2, 0, "assistant", [part(None, None)])]
    found = {r.conv_id: r for r in chat.read_back(chat.format_chat(spark.createDataFrame(rows, TURNS).withColumn("formatted", F.lit(1)))).collect()}
    assert (found[None].n_turns, found[None].turns_sha256, found[2].loss_chars) == (2, sha("\n\n" * 2), 0)
    assert chat.format_chat(spark.createDataFrame([], TURNS)).count() == 0


def judged(rows, rules, default="allow"):
    found = []
    for page, url in rows:
        host = path = ""
        if url and "://" in url:
            rest = url.split("://", 1)[1]
            cut = min([i for i in (rest.find(c) for c in "/?#") if i >= 0], default=len(rest))
            host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
            path = rest[cut:].split("?")[0].split("#")[0]
        fits = [(len(h + p), h + p, v) for h, p, v in rules if host and (host == h or host.endswith("." + h)) and path.startswith(p)]
        best = max(fits, default=(0, None, default))
        found.append((page, host, path, best[1], best[2]))
    return found


def test_urls_against_brute_force(spark):
    rng = random.Random(3)
    rows = [(1, None), (2, ""), (3, "no scheme"), (4, "://"), (5, "http://"), (6, "http://COM/É?x"), (6, "http://COM/É?x"), (7, "x://a.com#f/"), (8, "http://ÉX.com/"), (9, "http://.com/a"), (10, "http://xcom/")]
    for i in range(300):
        host = rng.choice(["", "www.", "a.b.", "WWW."]) + rng.choice(["example.com", "example.net", "com", "net", "ample.com", "Example.Com"])
        rows.append((100 + i, rng.choice(["http://", "ftp://", "a://b://"]) + host + rng.choice(["", "/", "/en", "/en/", "/EN/x", "/es/1?y", "?/en/", "#/fr/", "/fr/#z", "/en/http://com/"])))
    pages = spark.createDataFrame(rows, "page_id long, url string").withColumn("host", F.lit("clash"))
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    key = lambda r: tuple(map(str, r))
    for blocks in (1, urls.FILTER_BLOCKS):
        found = [tuple(r) for r in urls.judge_urls(pages, rules, blocks=blocks).collect()]
        assert sorted(found, key=key) == sorted(judged(rows, RULES), key=key)
    assert {r.verdict for r in urls.judge_urls(pages, rules.limit(0), default="block").collect()} == {"block"}
    assert urls.judge_urls(pages.limit(0), rules).count() == 0


def test_the_filter_passes_all_listed_keys(spark):
    keys = spark.range(3000).select(F.concat(F.lit("k"), "id").alias("key"))
    words_ = urls.blocked_bloom(keys, blocks=256).scalar()
    tried = spark.range(6000).select("id", F.concat(F.lit("k"), "id").alias("key")).where(urls.may_hold(words_, F.col("key"), 256))
    found = tried.agg(F.sum((F.col("id") < 3000).cast("int")), F.count(F.lit(1))).first()
    assert found[0] == 3000 and found[1] < 5000


def test_a_filter_is_sent_by_its_blocks_and_not_made_in_one_task(spark):
    keys = spark.range(3000).select(F.concat(F.lit("k"), "id").alias("key"))
    filled = urls.filled_blocks(keys, blocks=256)
    assert filled.count() == 256 and filled.columns == ["block", "w0", "w1", "w2", "w3"]
    tried = spark.range(6000).select("id", F.concat(F.lit("k"), "id").alias("key"), F.lit(7).alias("block"))
    passed = urls.let_through(tried, "key", filled, 256)
    words_ = urls.blocked_bloom(keys, blocks=256).scalar()
    same = tried.where(urls.may_hold(words_, F.col("key"), 256))
    assert passed.columns == tried.columns and sorted(passed.collect()) == sorted(same.collect())
    assert "ubquery" not in passed._jdf.queryExecution().optimizedPlan().toString()
    assert urls.let_through(tried, "key", filled.limit(0), 256).count() == 0


ITEMS = [(1, "One two, three four five six seven eight nine TEN eleven twelve"), (2, "short item"), (3, None), (4, "?!"), (5, "short item"), (2, "one two three four five six seven eight nine ten")]
DOCS = [
    (1, "x One-two three four five six seven eight nine ten ELEVEN y short item short"), (2, None), (3, ""), (4, "short  ITEM"), (4, "short  ITEM"),
    (5, "nothing of that é ß 日本"), (6, "one two three four five six seven eight nine"), (None, "a short item b"), (7, "item short item short item " * 300), (8, "Item"),
]


@pytest.mark.parametrize("limit", [0, 50_000])
def test_leaks_against_brute_force(spark, limit):
    docs = spark.createDataFrame(DOCS, "doc_id long, text string").withColumn("item_id", F.lit(0))
    found = decontaminate.report(docs, spark.createDataFrame(ITEMS, "item_id long, text string"), set_limit=limit).collect()
    expected = leaks(DOCS, ITEMS)
    assert len(found) == len(DOCS)
    for r in found:
        assert tuple(r)[1:] == expected[r.doc_id][0]


def test_leaks_of_nothing(spark):
    docs = spark.createDataFrame(DOCS, "doc_id long, text string")
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert {r.contaminated for r in decontaminate.report(docs, items.limit(0)).collect()} == {False}
    assert decontaminate.report(docs.limit(0), items).count() == 0


@pytest.mark.parametrize("limit", [0, 50_000])
def test_removal_of_spans_and_documents(spark, limit):
    docs = spark.createDataFrame(DOCS, "doc_id long, text string").withColumn("source", F.lit("s"))
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    expected = leaks(DOCS, ITEMS)
    cut = {r.doc_id: r.text for r in decontaminate.remove_spans(docs, items, set_limit=limit).collect()}
    for doc, text in DOCS:
        hit = expected[doc][1]
        assert words(cut[doc]) == [w for i, w in enumerate(words(text)) if i not in hit]
        assert hit or cut[doc] == text
    assert cut[1] == "x y short"
    left = decontaminate.remove_documents(docs, items, set_limit=limit)
    assert left.columns == docs.columns
    assert {r.doc_id for r in left.collect()} == {d for d, _ in DOCS if not expected[d][1]}


@pytest.mark.parametrize("limit", [50_000, 1])
def test_columns_of_any_name_stay(spark, limit):
    names = ["_runs", "_row", "_given", "passed", "shown", "words", "spans", "hashes", "key", "runs", "row", "gram", "size", "a.b"]
    leak = " ".join(f"leak{n}" for n in range(10))
    docs = spark.createDataFrame([(1, f"Before, {leak.upper()}! after"), (2, "clean text"), (3, None)], "doc_id long, text string")
    docs = docs.select("*", *[F.lit(f"mine {n}").alias(n) for n in names])
    items = spark.createDataFrame([("i", leak), ("j", "two other words that stand nowhere at all in these few documents")], "item_id string, text string")
    cut = decontaminate.remove_spans(docs, items, set_limit=limit)
    left = decontaminate.remove_documents(docs, items, set_limit=limit)
    assert cut.columns == left.columns == docs.columns
    assert {r.doc_id: (r.text, [r[n] for n in names]) for r in cut.collect()} == {
        i: (text, [f"mine {n}" for n in names]) for i, text in ((1, "Before! after"), (2, "clean text"), (3, None))
    }
    assert sorted((r.doc_id, *[r[n] for n in names]) for r in left.collect()) == [(i, *[f"mine {n}" for n in names]) for i in (2, 3)]
