"""Quality field, token files, HTML text, byte-level BPE and the pipeline."""

import base64
import itertools
import math
import random
import re
import zlib

import corpus_pipeline
import numpy as np
import public_tokenizers
import pytest
import tiktoken
from .brute import leaks, near_classes, repeats, sha
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from spanloom.llm import bpe, crf, html, maxflow, quality, queries, rans, tokens
from spanloom.session import scratch_path

SF_DIR = "/root/testdata/sf0.001"
ODD = [None, "", " ", "\n\n a\n", "a\x00b", "\x00", "x \x00y", "É日本 ß", "don't  'S", "!!!!", "a" * 3000, " " * 500, "tab\tnbsp x 　 y", "<|endoftext|> a", "é İ", "1234 5"]


def test_marginals_against_all_labellings():
    rng = np.random.default_rng(1)
    lengths = np.array([3, 0, 1, 5])
    node, step = rng.normal(size=9), rng.normal(size=(2, 2))
    marginal, pairs, log_z = crf.forward_backward(node, lengths, step)
    at, expected, expected_pairs, total = 0, [], np.zeros((2, 2)), 0.0
    for n in lengths:
        weight, ones, moves = 0.0, np.zeros(n), np.zeros((2, 2))
        for y in itertools.product((0, 1), repeat=int(n)):
            w = math.exp(sum(node[at + i] for i in range(n) if y[i]) + sum(step[a, b] for a, b in zip(y, y[1:])))
            weight += w
            ones += w * np.array(y)
            for a, b in zip(y, y[1:]):
                moves[a, b] += w
        expected += (ones / weight).tolist()
        expected_pairs += moves / weight
        total += math.log(weight) if n else 0
        at += n
    assert np.allclose(marginal, expected) and np.allclose(pairs, expected_pairs) and math.isclose(log_z, total)


def test_quality_on_rows_held_out(spark):
    rows = queries.op3_quality_crf(spark, "/root/testdata/sf0.1")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet").select("doc_id", "quality")
    found = rows.join(labels, "doc_id").where("held_out").select("score", "quality").toPandas()
    assert len(found) > 500
    rank = found["score"].rank()
    good = found["quality"] == 1
    auc = (rank[good].mean() - (good.sum() + 1) / 2) / (~good).sum()
    assert auc > 0.98 and ((found["score"] >= 0.5) == good).mean() > 0.97


def test_scores_of_odd_texts_and_without_labels(spark):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(ODD)] + [(None, "x"), (1, "")], "doc_id long, text string").withColumn("quality", F.lit(3))
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert all(math.isclose(r.score, 0.5) for r in quality.score(docs, quality.train(docs, none)).collect())
    labels = spark.createDataFrame([(7, 1), (9, 0), (9, None), (None, 1), (7, 1), (77, 1)], "doc_id long, quality int")
    found = quality.score(docs, quality.train(docs, labels)).collect()
    assert len(found) == len(ODD) + 2 and all(0 <= r.score <= 1 for r in found)
    assert quality.score(docs.limit(0), quality.train(docs, labels)).count() == 0


def test_the_driver_describes_few_characters_at_a_time(spark, monkeypatch):
    docs = spark.range(60).select(F.col("id").alias("doc_id"), F.repeat(F.concat(F.lit("Some words "), "id", F.lit("!!\n")), 1500).alias("text"))
    sizes, describe = [], quality.describe
    monkeypatch.setattr(quality, "describe", lambda texts: sizes.append(sum(map(len, texts))) or describe(texts))
    quality.train(docs, spark.range(60).select(F.col("id").alias("doc_id"), (F.col("id") % 2).alias("quality")))
    assert sum(sizes) > 1_000_000 and max(sizes) <= 1 << 17


def test_scores_do_not_depend_on_neighbours():
    model = quality.Model(np.linspace(-1, 1, quality.describe(["x"])[0].shape[1]), np.eye(2), 0.0, 1.0)
    texts = ["one two\nthree", None, "A!! B!!\n\nc", "x " * 50]
    assert np.allclose(model.scores(texts), [model.scores([t])[0] for t in texts])


@pytest.mark.parametrize("lanes", [1, 7, 512])
def test_numbers_come_back(lanes):
    rng = np.random.default_rng(2)
    for values in ([], [5], [3] * 1000, rng.integers(0, 60000, 5000), rng.zipf(1.3, 4000) % 50000, np.arange(65536), [2**31, 7, 7]):
        values = np.array(values, dtype=np.uint32)
        if not len(values):
            continue
        table = rans.Table.of(values)
        assert int(table.frequencies.sum()) == rans.TOTAL and (table.frequencies > 0).all()
        states, words = rans.encode(values, table, lanes)
        assert (rans.decode(len(values), states, words, table) == values).all()


def test_blocks_are_read_alone_and_damage_is_found(monkeypatch):
    monkeypatch.setattr(tokens, "BLOCK", 1000)
    ids = np.random.default_rng(3).zipf(1.4, 4500).astype(np.uint32) % 40000
    packed = tokens.pack_segment(ids, 1)
    assert (tokens.unpack_segment(packed) == ids).all()
    assert (tokens.unpack_segment(packed, range(2, 4)) == ids[2000:4000]).all()
    harmed = bytearray(packed)
    harmed[-3] ^= 1
    with pytest.raises(ValueError):
        tokens.unpack_segment(bytes(harmed))
    assert (tokens.unpack_segment(bytes(harmed), range(0, 4)) == ids[:4000]).all()


def test_token_files_against_the_library(spark, monkeypatch):
    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as file:
        definition = file.read()
    whole = Tokenizer.from_str(definition)
    docs = [(i, t) for i, t in enumerate(ODD)] + [(r.doc_id + 100, r.text) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()] + [(None, "null id"), (5, "again")]
    table = spark.createDataFrame(docs, "doc_id long, text string").withColumn("start", F.lit(0)).repartition(3)
    path = scratch_path(spark, "tokens")
    tokens.write_tokens(table, path, definition, 2)
    found = tokens.read_tokens(spark, path).orderBy("start").collect()
    at = 0
    assert len(found) == len(docs)
    for row, (doc, text) in zip(found, sorted(docs, key=lambda d: (d[0] is not None, d[0], d[1] or ""))):
        ids = np.array([*whole.encode(text or "", add_special_tokens=False).ids, 2], dtype="<u4")
        assert tuple(row) == (doc, at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)


def test_unlike_words_are_handed_to_the_model_many_in_one_text(monkeypatch):
    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as file:
        encoder = tokens.WordEncoder(file.read())

    class Counted:
        def __init__(self, tokenizer):
            self.tokenizer, self.given = tokenizer, 0

        def encode_batch_fast(self, texts, **options):
            self.given += len(texts)
            return self.tokenizer.encode_batch_fast(texts, **options)

    encoder.model, encoder.ascii = Counted(encoder.model), Counted(encoder.ascii)
    monkeypatch.setattr(tokens, "REMEMBERED", 800)
    rng = random.Random(4)
    word = lambda: "".join(rng.choices("aeinrstöé", weights=[9] * 7 + [1, 1], k=rng.randint(1, 9))) + rng.choice(["", "", ".", "!!", "</w>", "</w", "'s", "4"])
    common = [word() for _ in range(200)]
    for _ in range(6):
        texts = [*ODD, *(rng.choice([" ", "\n", "  "]).join(rng.choices(common, k=40) + [word() for _ in range(60)]) for _ in range(10)), "x<|endoftext|>y <|endoftext|>"]
        assert encoder.encode(texts) == [np.array(encoder.whole.encode(t or "", add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    assert 0 < encoder.model.given <= 12 and 0 < encoder.ascii.given <= 12 and len(encoder._words.number) < 3000


def test_token_files_of_nothing(spark):
    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as file:
        definition = file.read()
    path = scratch_path(spark, "tokens")
    tokens.write_tokens(spark.createDataFrame([], "doc_id long, text string"), path, definition, 2)
    assert tokens.read_tokens(spark, path).count() == 0


def test_cuts_against_all_labellings():
    rng = random.Random(4)
    for _ in range(150):
        n = rng.randrange(1, 9)
        gain = [rng.choice([rng.uniform(-2, 2), rng.randrange(-2, 3)]) for _ in range(n)]
        links = [(rng.randrange(n), rng.randrange(n), rng.uniform(0, 1.5)) for _ in range(rng.randrange(12))]

        def cost(labels):
            return -sum(g for g, x in zip(gain, labels) if x) + sum(c for i, j, c in links if labels[i] != labels[j])

        best = min(cost(x) for x in itertools.product((False, True), repeat=n))
        assert math.isclose(cost(maxflow.min_cut(gain, links)), best, abs_tol=1e-9)


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body class="home">
<header><a href="/">Site</a></header><nav><ul><li><a href=/a>One</a><li><a href=/b>Two</a></ul></nav>
<div class="cookie-notice">We use cookies so that this site works well for all of you.</div>
<%s><h1>Title &amp; more</h1><p>First  para&shy;graph with <b>bold</b> text,<br>and enough words to be prose.<p>Second one, which is not
closed &lt;tag&gt;.</p><script>var x = "<p>no</p>";</script><p>Short.</p><form><label>Mail</label><input></form><!-- <p>gone</p> --></%s>
<aside><p>Related reading of some length that should not be part of it.</p></aside>
<section id="comments"><p>A reader says that this was a good read, and so on and on.</p></section>
<footer><p>Imprint and a longer line of legal text that nobody reads at all.</p></footer></body></html>"""


@pytest.mark.parametrize("holder", ["article", "main", "div"])
def test_article_of_a_page(holder):
    text = "Title & more\nFirst para\xadgraph with bold text, and enough words to be prose.\nSecond one, which is not closed <tag>.\nShort."
    assert html.main_text(PAGE % (holder, holder)) == text


PROSE = " ".join(f"word{n}" for n in range(70))
FRAMED = "<nav>Home</nav>%s<div class='sidebar no-print'><p>Something else of some length to read.</p></div><footer class='no-border'>Imprint</footer>"


@pytest.mark.parametrize("names", [
    "has-sidebar", "no-sidebar", "with-sidebar", "content-with-sidebar", "has-left-sidebar wide", "without_ads", "post layout--no-comments",
])
@pytest.mark.parametrize("holder", ["article", "main", "div", "section"])
def test_flags_of_the_layout_are_no_frames(holder, names):
    assert html.main_text(FRAMED % f"<{holder} class='{names}'><p>{PROSE}</p></{holder}>") == PROSE


@pytest.mark.parametrize("holder", ["article class='related-reading share'", "main id='search'", "main role='main' class='sidebar-left'"])
def test_articles_with_frame_names(holder):
    tag = holder.split()[0]
    assert html.main_text(FRAMED % f"<{holder}><p>{PROSE}</p><aside>Advert</aside></{tag}>") == PROSE


def test_headings_and_paragraphs_named_by_their_words():
    page = f"<article><p>{PROSE}</p><h2 id='related-work'>Related work</h2><p>{PROSE}</p><h3 class='header' id=side-effects>Side effects</h3><p id='notice-1'>{PROSE}</p></article>"
    assert html.main_text(FRAMED % page) == "\n".join([PROSE, "Related work", PROSE, "Side effects", PROSE])
    assert html.main_text(f"<html class='js cookies'><body class='has-sidebar sidebar'>{FRAMED % page}</body></html>").startswith(PROSE)


@pytest.mark.parametrize("names", ["sidebar", "sidebar-with-links", "comments no-border", "has-icon menu", "nosidebar related", "casino-ads"])
def test_frames_stay_frames(names):
    assert html.main_text(FRAMED % f"<article><p>{PROSE}</p></article><div class='{names}'><p>A text of some length that is not part of it.</p></div>") == PROSE


TWO = f"<h1>Title of it</h1><p>{PROSE}</p><p>{PROSE}</p>"


@pytest.mark.parametrize("page", [
    f'<form id="aspnetForm">{TWO}</form>', f'<div id="header-and-content">{TWO}</div>', f'<div class="search-algorithms">{TWO}</div>', f'<header><div>{TWO}</div></header>',
    f'<article>{TWO}</article><form><p>Write to us, if you like, about anything that you have read here today.</p></form>',
    f'<div class="overlay">{TWO}</div>',
])
def test_wrappers_around_the_text_are_no_frames(page):
    assert html.main_text(f"<nav><a href='/'>Home</a></nav>{page}<footer>Imprint</footer>") == f"Title of it\n{PROSE}\n{PROSE}"


@pytest.mark.parametrize("inner", [
    f'<div class="related-work"><h2>Related work</h2><p>{PROSE}</p></div>', f'<section id="side-effects"><h2>Side effects</h2><p>{PROSE}</p></section>',
    f'<div class="social_studies"><h2>Search trees</h2><p>Short.</p></div>',
])
def test_sections_named_by_their_subject_stay(inner):
    expected = " ".join(re.sub("<[^>]*>", "\n", inner).split(" "))
    assert html.main_text(f"<article><p>{PROSE}</p>{inner}</article>").split("\n") == [PROSE, *[x for x in expected.split("\n") if x]]


@pytest.mark.parametrize("inner", [
    '<p class="ad">Buy our great product now today</p>', '<p class="cookie-notice">We use cookies to make this site work well for all of you.</p>', '<div class="share-buttons">Share this text with friends</div>',
    '<div class="newsletter-signup">Get news by mail each week</div>', '<p class="sponsored">Paid for by a brand that you know</p>',
])
def test_notices_and_adverts_in_articles_go(inner):
    assert html.main_text(f"<article><p>{PROSE}</p>{inner}<p>{PROSE}</p></article>") == f"{PROSE}\n{PROSE}"


def test_an_advert_longer_than_the_article_goes():
    advert = f'<div class="ad">{PROSE}</div><div class="comments"><p>{PROSE}</p></div>'
    assert html.main_text(f"{advert}<article><h1>Short one</h1><p>It says little.</p></article>") == "Short one\nIt says little."


@pytest.mark.parametrize("mark", ['<svg class="i"/>', "<SVG/>", "<svg />", '<math alt=">"/>', '<svg class="i"><title>t</title><path d="M0"/></svg>'])
def test_text_after_an_icon(mark):
    page = f"<article><p>one {mark} two</p><p>three</p></article>"
    assert html.main_text(page) == "one two\nthree"


@pytest.mark.parametrize("name", ["title-card", "select-x", "object-view", "svg-icon", "math-field", "script-note"])
def test_custom_elements_are_not_the_elements_they_begin_with(name):
    assert html.main_text(f"<article><p>one</p><{name}>two</{name}><p>three</p><{name} /><p>four</p></article>") == "one\ntwo\nthree\nfour"
    assert html.main_text("<article><p>one</p><title>no</title><select ><option>no</select><script/>no</script><p>two</p></article>") == "one\ntwo"


def test_odd_pages(spark):
    pages = [None, "", "<", "<p", "<!--", "<script>", "</p></div>", "<p>\x00</p>", "<a href='" * 2000, "<div>" * 3000 + "x", "&#xD800;&bogus;&", "<p>a<p>" * 500]
    rows = spark.createDataFrame([(i, "u", p) for i, p in enumerate(pages)] + [(None, None, PAGE % ("article", "article"))] * 2, "page_id long, url string, html string")
    found = html.extract_text(rows.withColumn("text", F.lit(1))).collect()
    assert len(found) == len(pages) + 2 and all(r.n_chars == len(r.text) for r in found)
    assert sum(r.text.startswith("Title & more\n") for r in found) == 2
    assert html.extract_text(rows.limit(0)).count() == 0


def test_generated_pages(spark):
    for r in spark.read.parquet(f"{SF_DIR}/pages.parquet").collect():
        article = re.sub(r"<br>", " ", re.sub(r"</?b>", "", re.search(r"<article>(.*)</article>", r.html, re.S)[1]))
        parts = (" ".join(html.references.unescape(p).split()) for p in re.split(r"</?(?:p|h1)>", article))
        assert html.main_text(r.html) == "\n".join(p for p in parts if p)


@pytest.fixture(scope="module")
def vocabulary():
    return bpe.Vocabulary.load(None, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def library():
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_perfect_hash_is_minimal(vocabulary):
    slots = sorted(vocabulary.hash.slot(k) for k in vocabulary.keys)
    assert slots == list(range(len(vocabulary.keys)))
    assert vocabulary.id_of(b"no such token") is None


def test_ids_against_the_library(vocabulary, library, monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 50)
    encoder, rng = bpe.Encoder(vocabulary), random.Random(5)
    letters = " \n\t\r\x00\x0b\x1c\x85\xa0　'sStÉé日本12³!?.,*😀"
    texts = [t or "" for t in ODD] + ["".join(rng.choice(letters) for _ in range(rng.randrange(16))) for _ in range(5000)]
    for text in texts:
        ids = encoder.encode(text)
        assert ids == library.encode_ordinary(text)
        assert encoder.decode(ids) == text.encode()


def test_the_heap_of_a_word_holds_small_numbers(vocabulary, library, monkeypatch):
    seen, push = [], bpe.heappush
    monkeypatch.setattr(bpe, "heappush", lambda heap, x: seen.append(x) or push(heap, x))
    encoder, rng = bpe.Encoder(vocabulary), random.Random(6)
    for _ in range(200):
        text = "".join(rng.choices("abcdefginorst", k=rng.randint(20, 60)))
        assert encoder.encode(text) == library.encode_ordinary(text)
    assert seen and max(seen) < 1 << 30


def test_bpe_of_tables(spark, vocabulary, library):
    rows = list(enumerate(ODD)) + [(None, "a b"), (3, "a b")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("ids", F.lit(1))
    found = sorted(tuple(x or 0 for x in r) for r in bpe.digests(docs, vocabulary).collect())
    expected = [(d, library.encode_ordinary(t or ""), t) for d, t in rows]
    assert found == sorted((d or 0, len(i), sha(" ".join(map(str, i))), sha(t or "")) for d, i, t in expected)
    back = bpe.decode_documents(bpe.encode_documents(docs, vocabulary), vocabulary)
    assert sorted((r.doc_id or 0, r.text) for r in back.collect()) == sorted((d or 0, t or "") for d, t in rows)
    assert bpe.digests(docs.limit(0), vocabulary).count() == 0


def test_pipeline_against_brute_force(spark, library):
    documents = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    docs, kept = documents, []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF_DIR)
        assert docs.dtypes == documents.dtypes
        kept.append({r.doc_id: r.text for r in docs.collect()})
    scored = {r.doc_id: r.predicted for r in queries.op3_quality_crf(spark, SF_DIR).collect()}
    given = {r.doc_id: r.text for r in documents.collect()}
    assert kept[0] == {d: t for d, t in given.items() if scored[d]}
    classes = near_classes(list(kept[0].items()))
    assert kept[1] == {d: t for d, t in kept[0].items() if classes[d] == d}
    texts = {}
    for doc, gone, data in repeats(list(kept[1].items())):
        at, left = 0, []
        for c in kept[1][doc]:
            size = len(c.encode())
            left += [] if all(gone[at : at + size]) else [c]
            at += size
        texts[doc] = "".join(left)
    assert kept[2] == texts
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    before, after = leaks(list(texts.items()), items), leaks(list(kept[3].items()), items)
    for doc in texts:
        counts, hit = before[doc]
        assert after[doc][0][0] == counts[0] - len(hit) and (hit or kept[3][doc] == texts[doc])
    found = {r.doc_id: r.ids for r in corpus_pipeline.run(spark, SF_DIR).collect()}
    assert found == {d: library.encode_ordinary(t) for d, t in kept[3].items()}


def test_stages_take_empty_tables(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF_DIR)
        assert docs.count() == 0
