"""Benchmark decontamination: a hash set of normalised benchmark n-grams, scanned by every document's windows.

Words are runs of digits, letters a-z (A-Z lower-cased) and characters beyond ASCII. A window is ``WINDOW`` consecutive
words of an item, or the whole item if it has fewer. Document windows are looked up in a set of hashes of a few
of their words; what passes is verified against the windows themselves.

The set of windows goes to every task only if it is small (``SET_LIMIT`` windows). A larger one is
looked up by a shuffle join of hashes instead, with the same results.

Defined results: null or empty texts have no words and no hits; an empty benchmark leaves every document clean; repeated rows get a result
each; an item found in several ways counts once per id; items without words are never found. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from spanloom.llm.shared import ascii_lower

WINDOW = 10
SET_LIMIT = 50_000
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """The normalised words of a text; none for null."""
    return F.filter(F.split(ascii_lower(F.coalesce(text, F.lit(""))), GAP), lambda w: w != "")


def item_windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """``gram`` (words joined by a space), ``size`` and ``item_id`` of every distinct window of every item."""
    items = benchmark.select("item_id", words(F.col("text")).alias("words")).where(F.size("words") > 0)
    size = F.least(F.size("words"), F.lit(window))
    grams = F.transform(F.sequence(F.lit(1), F.size("words") - size + 1), lambda i: F.array_join(F.slice("words", i, size), " "))
    return items.select("item_id", size.alias("size"), F.explode(F.array_distinct(grams)).alias("gram")).distinct()


def _key(hashes: Column, start: Column, size: int) -> Column:
    """A hash of a window's first, middle and last words, from the word hashes; ``start`` counts from 0."""
    return F.xxhash64(F.get(hashes, start), F.get(hashes, start + (size // 2)), F.get(hashes, start + (size - 1)), F.lit(size))


def _gram_key(gram: Column, size: Column) -> Column:
    hashes = F.transform(F.split(gram, " "), lambda w: F.xxhash64(w))
    return F.xxhash64(F.get(hashes, F.lit(0)), F.get(hashes, F.floor(size / 2).cast("int")), F.get(hashes, size - 1), size)


def _starts(n: Column, size: int) -> Column:
    return F.when(n >= size, F.sequence(F.lit(0), n - size)).otherwise(F.array().cast("array<int>"))


def _covered(spans: Column) -> Column:
    """Words under spans (start, size) that are sorted by start."""
    zero = F.struct(F.lit(0).alias("total"), F.lit(0).alias("reach"))

    def step(a: Column, s: Column) -> Column:
        end = s["start"] + s["size"]
        return F.struct(
            (a["total"] + F.greatest(F.lit(0), end - F.greatest(a["reach"], s["start"]))).alias("total"),
            F.greatest(a["reach"], end).alias("reach"),
        )

    return F.aggregate(spans, zero, step, lambda a: a["total"])


def _merged(spans: Column) -> Column:
    """Disjoint runs (first word, end) of spans sorted by start."""
    none = F.array().cast("array<struct<first:int,end:int>>")

    def step(a: Column, s: Column) -> Column:
        last = F.element_at(a, -1)
        end = s["start"] + s["size"]
        meets = (F.size(a) > 0) & (F.coalesce(F.try_element_at(a, F.lit(-1))["end"], F.lit(-1)) >= s["start"])
        grown = F.struct(last["first"].alias("first"), F.greatest(last["end"], end).alias("end"))
        return F.when(meets, F.concat(F.slice(a, 1, F.size(a) - 1), F.array(grown))).otherwise(
            F.concat(a, F.array(F.struct(s["start"].alias("first"), end.alias("end"))))
        )

    return F.aggregate(spans, none, step)


def _looked_up(size: int, keys: list[int], texts: list[str]) -> Column:
    """The windows (start, size, gram) of one size whose key, then whose words, are listed (in SQL: one call for the whole list).

    Grams hold no quote and no backslash, as neither is part of a word.
    """
    starts = f"if(size(words) >= {size}, sequence(0, size(words) - {size}), cast(array() as array<int>))"
    key = f"xxhash64(get(hashes, i), get(hashes, i + {size // 2}), get(hashes, i + {size - 1}), {size})"
    passed = f"filter({starts}, i -> {key} in ({', '.join(f'{k}L' if k > -(1 << 63) else f'cast({k} as bigint)' for k in keys)}))"
    gram = f"array_join(slice(words, i + 1, {size}), ' ')"
    shown = f"transform({passed}, i -> struct(i as start, {size} as size, {gram} as gram))"
    listed = ", ".join(f"'{t}'" for t in texts)
    return F.expr(f"filter({shown}, s -> s.gram in ({listed}))")


def _keyed(n: Column, size: int) -> Column:
    """All windows (start, size, key) of one size."""
    return F.transform(_starts(n, size), lambda i: F.struct(
        i.alias("start"), F.lit(size).alias("size"), _key(F.col("hashes"), i, size).alias("key")
    ))


def leaks(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW, set_limit: int = SET_LIMIT) -> DataFrame:
    """Every row of ``documents`` with ``words`` and ``spans``: verified windows (start, size, gram), by start.

    ``documents`` needs ``text``; its other columns stay.
    """
    grams = item_windows(benchmark, window).select("gram", "size").distinct()
    keyed = grams.withColumn("key", _gram_key(F.col("gram"), F.col("size")))
    # One row more than the limit tells whether the set is small enough for every task.
    rows = keyed.limit(set_limit + 1).collect()
    n = F.size("words")
    found = documents.withColumn("words", words(F.col("text"))).withColumn("hashes", F.transform("words", lambda w: F.xxhash64(w)))
    none = F.array().cast("array<struct<start:int,size:int,gram:string>>")

    if len(rows) <= set_limit:
        parts = []
        for size in sorted({r["size"] for r in rows}):
            keys = [r["key"] for r in rows if r["size"] == size]
            texts = [r["gram"] for r in rows if r["size"] == size]
            parts.append(_looked_up(size, keys, texts))
        found = found.withColumn("spans", F.array_sort(F.concat(*parts)) if parts else none)
        return found.drop("hashes")
    found = found.withColumn("_row", F.monotonically_increasing_id())
    sizes = [r["size"] for r in keyed.select("size").distinct().collect()]
    windows = F.concat(*(_keyed(n, size) for size in sizes))
    tried = found.select("_row", F.explode(windows).alias("w")).select("_row", "w.*")
    passed = tried.join(keyed.select("key").distinct(), "key", "left_semi")
    # The rows a document gets back are at most its own windows.
    starts = passed.groupBy("_row").agg(F.collect_list(F.struct("start", "size")).alias("passed"))
    back = found.join(starts, "_row", "left")
    shown = F.transform(F.coalesce("passed", F.array().cast("array<struct<start:int,size:int>>")), lambda p: F.struct(
        p["start"].alias("start"), p["size"].alias("size"), F.array_join(F.slice("words", p["start"] + 1, p["size"]), " ").alias("gram")))
    back = back.withColumn("shown", shown)
    sure = back.select("_row", F.explode("shown").alias("s")).join(grams.select(F.col("gram").alias("g")).distinct(), F.col("s.gram") == F.col("g"), "left_semi")
    sure = sure.groupBy("_row").agg(F.array_sort(F.collect_list("s")).alias("spans"))
    return back.drop("hashes", "passed", "shown").join(sure, "_row", "left").withColumn("spans", F.coalesce("spans", none)).drop("_row")


def report(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW, set_limit: int = SET_LIMIT) -> DataFrame:
    """``doc_id``, ``n_words``, ``n_hit``, ``n_items``, ``items_sha256``, ``contaminated`` for each document."""
    found = leaks(documents.select("doc_id", "text"), benchmark, window, set_limit)
    found = found.withColumn("row", F.monotonically_increasing_id()).select(
        "row", "doc_id", F.size("words").cast("long").alias("n_words"),
        _covered(F.col("spans")).cast("long").alias("n_hit"),
        F.explode_outer(F.array_distinct(F.transform("spans", lambda s: s["gram"]))).alias("gram"),
    )
    items = item_windows(benchmark, window).groupBy("gram").agg(F.collect_set(F.col("item_id").cast("string")).alias("ids"))
    named = found.withColumn("gram", F.coalesce("gram", F.concat(F.lit(" "), F.col("row").cast("string")))).join(items, "gram", "left")
    per = named.groupBy("row", "doc_id", "n_words", "n_hit").agg(F.collect_set("ids").alias("ids"))
    per = per.withColumn("ids", F.array_sort(F.array_distinct(F.flatten("ids"))))
    return per.select(
        "doc_id", "n_words", "n_hit", F.size("ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("ids", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


def _leaks_of(documents: DataFrame, benchmark: DataFrame, window: int, set_limit: int) -> DataFrame:
    """``leaks`` with all columns of a document in ``_given``, so that none can clash with a name used on the way."""
    return leaks(documents.select(F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("_given"), "text"), benchmark, window, set_limit)


def remove_documents(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW, set_limit: int = SET_LIMIT) -> DataFrame:
    """The documents without any hit, with their own columns, whatever they are called."""
    return _leaks_of(documents, benchmark, window, set_limit).where(F.size("spans") == 0).select("_given.*")


def remove_spans(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW, set_limit: int = SET_LIMIT) -> DataFrame:
    """The documents with every hit run of words cut from ``text``, with the marks between its words; other columns stay, whatever they are called.

    The words around a cut keep what follows the run. Documents without hits keep their text; null stays null.
    """
    found = _leaks_of(documents, benchmark, window, set_limit)
    # Marks and words alternate: mark 0, word 0, mark 1, ..., so that any word's own spelling can be left out.
    marks = F.regexp_extract_all("text", F.lit(r"([\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]*)([^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]*)"), F.lit(0))
    pieces = F.filter(marks, lambda m: m != "")
    kept = F.filter(F.transform(pieces, lambda p, i: F.struct(p.alias("p"), i.alias("i"))), lambda x: ~F.exists(F.col("_runs"), lambda r: (x["i"] >= r["first"]) & (x["i"] < r["end"])))
    cut = F.array_join(F.transform(kept, lambda x: x["p"]), "")
    found = found.withColumn("_runs", _merged(F.col("spans")))
    text = F.when(F.size("spans") > 0, cut).otherwise(F.col("text")).alias("text")
    return found.select(*[text if c == "text" else F.col("_given").getField(c).alias(c) for c in documents.columns])
