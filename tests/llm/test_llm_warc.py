"""Archives and their index: round trips, order of the merged index, revisits against brute force."""

import collections
import gzip
import hashlib
import heapq
import random

import pytest
from check_oracles import compare, duck
from pyspark.sql import functions as F

from spanloom.llm import cdx, warc
from spanloom.llm.queries import op11_warc_index
from spanloom.llm.sql import ORACLES
from spanloom.session import scratch_path

PAGE = "page_id long, url string, html string"


def test_loser_tree_merges_any_number_of_runs():
    rng = random.Random(4)
    for k in range(40):
        runs = [sorted(b"%d" % rng.randrange(50) for _ in range(rng.randrange(9))) for _ in range(k % 13)]
        assert list(cdx.merged([iter(r) for r in runs])) == list(heapq.merge(*runs))


def test_url_keys(spark):
    cases = {
        "http://www.Example.com:8080/A?b=C#d": "com,example)/a?b=c", "https://u:p@a.b.co.uk": "uk,co,b,a)/", "x.org/é y": "org,x)%2F%C3%A9%20y",
        "": "-", None: "-", "http://a.de?q": "de,a)?q",
    }
    df = spark.createDataFrame([(u, k) for u, k in cases.items()], "url string, key string")
    for row in df.select("url", "key", cdx.url_key(F.col("url")).alias("found")).collect():
        assert row.found == row.key, row


def some_pages(rng, n):
    bodies = ["", None, "short", "é" * 500, "é" * 499, "x" * 999, "x" * 1000, "a\r\n\r\nb" * 300, "<p>" + "y" * 5000]
    urls = [None, "", "http://a.com/", "http://a.com/", "https://www.b.org/ä b\n", "ftp://c", "http://hot.com/x"]
    return [(i, rng.choice(urls[-1:] if rng.random() < 0.4 else urls), rng.choice(bodies) if rng.random() < 0.7 else f"page {i} " * rng.randrange(400)) for i in range(n)]


def brute(rows):
    payloads = collections.defaultdict(list)
    for page, _, html in rows:
        payloads[html or ""].append(page)
    found = []
    for html, pages in payloads.items():
        data = html.encode()
        last = max((p for p in pages if p is not None), default=None) if len(data) >= 1000 and len(pages) > 1 else None
        for page in pages:
            revisit = last is not None and page != last
            found.append((page, len(data), hashlib.sha1(data).hexdigest(), "revisit" if revisit else "response", last if revisit else None))
    return sorted(found, key=str)


def told(df):
    return sorted(map(tuple, df.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()), key=str)


@pytest.mark.parametrize("fan, rows", [(64, 250_000), (3, 20)])
def test_archives_come_back_in_order(spark, monkeypatch, fan, rows):
    monkeypatch.setattr(cdx, "FAN", fan)
    monkeypatch.setattr(cdx, "ROWS", rows)
    pages = some_pages(random.Random(8), 400) + [(None, "http://a.com/", "x" * 1000), (None, None, None), (399, "http://z.com/", "x" * 1000)]
    df = spark.createDataFrame(pages, PAGE).repartition(23).withColumn("digest", F.lit("mine")).withColumn("last", F.lit(0))
    path = scratch_path(spark, "archives")
    index = warc.write_archives(df, path, F.timestamp_seconds(F.col("page_id") % 7))
    captures = warc.read_index(index).orderBy("place").collect()
    assert len(captures) == len(pages) and (index.count() > 5 or rows > 1000)
    keys = [(c.url_key.encode(), c.captured) for c in captures]
    assert keys == sorted(keys)
    assert told(warc.report(warc.read_index(index), path)) == brute(pages)
    texts = {r.page_id: bytes(r.payload).decode() for r in warc.read_archives(warc.read_index(index), path).where("record_type = 'response' and page_id < 399").collect()}
    assert texts and all(text == (pages[p][2] or "") for p, text in texts.items())


def test_archive_is_readable_as_whole_and_damage_is_found(spark):
    path = scratch_path(spark, "archives")
    index = warc.write_archives(spark.createDataFrame([(1, "http://a.com/", "hello"), (2, "http://b.com/", "world")], PAGE).coalesce(1), path, F.lit(None))
    place = warc.read_index(index).orderBy("offset").collect()
    with open(f"{path}/{place[0].file}", "rb") as file:
        raw = file.read()
    assert gzip.decompress(raw).count(b"WARC/1.1\r\nWARC-Type: response") == 2 and place[0].captured == "19700101000000"
    headers, payload = warc.parse_record(raw[: place[0].length])
    assert payload in (b"hello", b"world") and headers["WARC-Target-URI"].startswith("http://")
    with pytest.raises(ValueError):
        warc.parse_record(gzip.compress(gzip.decompress(raw[: place[0].length]).replace(payload, b"HELLO")))


def test_no_pages(spark):
    path = scratch_path(spark, "archives")
    index = warc.write_archives(spark.createDataFrame([], PAGE), path, F.lit(None))
    assert warc.report(warc.read_index(index), path).count() == 0


def test_query_matches_sql(spark):
    sf = "/root/testdata/sf0.01"
    assert compare(spark, duck(sf), sf, op11_warc_index, ORACLES["op11_warc_index"]) is None
