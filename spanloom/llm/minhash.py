"""Near copies by DartMinHash: signatures of weighted shingle sets, joined by bands, then verified.

Every shingle owns an unbounded strip, as wide as its weight and cut into regions of doubling width. Hashing throws the same
darts into a region in every document: their ranks arrive one after another, each with a place across the region and a
coordinate of the signature. A document keeps the darts under its own weights, and per coordinate the earliest. Two
documents agree on a coordinate with the probability of their weighted Jaccard similarity. Darts are drawn up to a
rank that fills all coordinates on average; documents with an empty one draw further.

Documents with equal shingles are one class from the start. Classes that agree on a whole band are candidates: first each
with the smallest of its bucket, then, in buckets that still hold unlike components, all pairs whose signatures are not
too far apart, block against block in one task, which returns a spanning forest of what it finds. Every candidate is verified by the weighted Jaccard similarity of its shingles.

Defined results: null texts, texts without words and rows without doc_id are classes of their own; a text of fewer than five words is one shingle;
rows repeated with one doc_id are one document; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType

from spanloom.llm.shared import U64, block_pairs, components, mix, stored, text_batches
from spanloom.llm.shingles import numbered, weighted
from spanloom.llm.urls import filled_blocks, let_through

COORDINATES, ROWS = 64, 4  # 16 bands: a pair of similarity 0.8 is missed with probability 0.0002, one of 0.9 with 10**-7
BATCH = 1 << 20  # characters at a time
BLOCK = 512
WANTED_BLOCKS = 1 << 15  # of a filter of document ids, 1 MB at most
AGREE = 0.5  # share of agreeing coordinates below which a pair is not verified: six deviations under 0.8


def _uniform(code: np.ndarray) -> np.ndarray:
    """(0, 1] from 64 hash bits."""
    return ((code >> U64(11)).astype(np.float64) + 1.0) * 2.0**-53


def _throw(owner: np.ndarray, code: np.ndarray, weight: np.ndarray, reach: np.ndarray, best: np.ndarray) -> None:
    """Lower ``best`` (documents x coordinates) by all darts of rank up to ``reach`` of their document."""
    k = best.shape[1]
    flat = best.reshape(-1)
    low, width, region = 0.0, 1.0, 1
    while len(owner):
        at, rank, number = np.arange(len(owner)), np.zeros(len(owner)), 1
        while len(at):
            with np.errstate(over="ignore"):
                dart = mix(code[at] + U64(region) * U64(0xA24BAED4963EE407) + U64(number) * U64(0x9FB21C651E98DF25))
            rank = rank - np.log(_uniform(dart)) / width
            inside = rank <= reach[owner[at]]
            at, rank, dart = at[inside], rank[inside], dart[inside]
            place = mix(dart ^ U64(0xD1B54A32D192ED03))
            under = low + width * _uniform(place) <= weight[at]
            coordinate = (mix(place) % U64(k)).astype(np.int64)
            np.minimum.at(flat, owner[at][under] * k + coordinate[under], rank[under])
            number += 1
        more = weight > low + width
        owner, code, weight = owner[more], code[more], weight[more]
        low, width, region = low + width, low + width, region + 1


def signatures(owner: np.ndarray, code: np.ndarray, weight: np.ndarray, texts: int, k: int = COORDINATES) -> np.ndarray:
    """Earliest rank per document and coordinate; infinity throughout for documents without shingles."""
    best = np.full((texts, k), np.inf)
    total = np.bincount(owner, weight, texts)
    reach = (k * np.log(k) + 2 * k) / np.maximum(total, 1e-300)
    todo = total > 0
    while todo.any():
        rows = todo[owner]
        _throw(owner[rows], code[rows], weight[rows], reach, best)
        todo &= np.isinf(best).any(axis=1)
        reach = np.where(todo, 2 * reach, reach)
    return best


def _describe(texts: list[str | None]) -> tuple[np.ndarray, ...]:
    """(two sums over all shingles, number of shingles, bands, short signature) of each text."""
    n = len(texts)
    owner, code, times = weighted(texts)
    best = signatures(owner, code, times.astype(float), n)
    bits = mix(best.view(U64))
    bands = np.zeros((n, COORDINATES // ROWS), dtype=U64)
    with np.errstate(over="ignore"):
        for i in range(ROWS):
            bands = mix(bands + bits[:, i::ROWS] + U64(i))
        bands = mix(bands + np.arange(bands.shape[1], dtype=U64)).view(np.int64)
        each = mix(code + times.astype(U64) * U64(0x8CB92BA72F3D8DD7))
        sums = np.zeros((2, n), dtype=U64)
        np.add.at(sums[0], owner, each)
        np.add.at(sums[1], owner, mix(each ^ U64(0xE7037ED1A0B428DB)))
    return sums.view(np.int64)[0], sums.view(np.int64)[1], np.bincount(owner, times, n).astype(np.int64), bands, (bits & U64(255)).astype(np.uint8)


def _sketches(documents: DataFrame) -> DataFrame:
    schema = documents.select("doc_id").schema.add("key_a", "long").add("key_b", "long").add("n", "long")
    schema = schema.add("bands", ArrayType(LongType())).add("short", "binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for part in text_batches(batch.column("text").to_pylist(), BATCH):
                key_a, key_b, n, bands, short = _describe(part)
                columns = [
                    batch.column("doc_id").slice(at, len(part)), pa.array(key_a), pa.array(key_b), pa.array(n),
                    pa.array(list(bands), pa.list_(pa.int64())), pa.array([s.tobytes() for s in short], pa.binary()),
                ]
                at += len(part)
                yield pa.RecordBatch.from_arrays(columns, schema.names)

    return documents.select("doc_id", "text").mapInArrow(run, schema)


def _elements(documents: DataFrame) -> DataFrame:
    """``doc_id`` and ``items``: 32-bit hashes of all shingle occurrences, a set that stands for the weighted one."""
    schema = documents.select("doc_id").schema.add("items", ArrayType(IntegerType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for part in text_batches(batch.column("text").to_pylist(), BATCH):
                owner, code, times = weighted(part)
                row, each = numbered(code, times)
                short = (each >> U64(32)).astype(np.uint32).view(np.int32)
                ends = np.searchsorted(owner[row], np.arange(len(part)), side="right")
                offsets = pa.array(np.concatenate([[0], ends]), pa.int32())
                items = pa.ListArray.from_arrays(offsets, pa.array(short, pa.int32()))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(at, len(part)), items], schema.names)
                at += len(part)

    return documents.select("doc_id", "text").mapInArrow(run, schema)


def _verified(pairs: DataFrame, elements: DataFrame, threshold: float) -> DataFrame:
    """The pairs (``a``, ``b``) whose weighted Jaccard similarity reaches the threshold."""
    one = elements.select(F.col("doc_id").alias("a"), F.col("items").alias("items_a"))
    other = elements.select(F.col("doc_id").alias("b"), F.col("items").alias("items_b"))
    both = pairs.select("a", "b").join(other, "b").join(one, "a")
    common = F.size(F.array_intersect("items_a", "items_b"))
    return both.where(common / (F.size("items_a") + F.size("items_b") - common) >= threshold).select("a", "b")


def _apart(group: pd.DataFrame, threshold: float) -> pd.DataFrame:
    """Links of a spanning forest between unlike components of one pair of blocks of a bucket, each verified here.

    A pair is judged in the first band it agrees on, if its lengths and signatures allow the threshold and no link found before joins it.
    """
    short = np.array([np.frombuffer(s, dtype=np.uint8) for s in group["short"]])
    bands = np.array(group["bands"].tolist())
    own_band = int(np.flatnonzero(bands[0] == group["band"].iloc[0])[0])
    n, ids = group["n"].to_numpy().astype(float), group["rep"].to_numpy()
    own = group["own_block"].to_numpy()
    across = group["block_a"].iloc[0] != group["block_b"].iloc[0]
    sizes = np.array([len(i) for i in group["items"]])
    begins = np.cumsum(sizes) - sizes
    places, flat = np.unique(np.concatenate(group["items"].tolist()), return_inverse=True)
    marked = np.zeros(len(places), dtype=bool)
    part = np.unique(group["component"].to_numpy(), return_inverse=True)[1]
    a, b = [], []
    for i in range(len(group)):
        others = (ids > ids[i]) & (part != part[i]) & (np.minimum(n, n[i]) >= threshold * np.maximum(n, n[i]))
        if across:
            others &= own != own[i]
        at = np.flatnonzero(others)
        if len(at):
            at = at[~(bands[at, :own_band] == bands[i, :own_band]).any(axis=1)]
            at = at[(short[at] == short[i]).mean(axis=1) >= AGREE]
        if not len(at):
            continue
        mine = flat[begins[i] : begins[i] + sizes[i]]
        marked[mine] = True
        common = np.add.reduceat(marked[flat], begins)[at]
        marked[mine] = False
        for j in at[common / (sizes[i] + sizes[at] - common) >= threshold]:
            if part[j] != part[i]:
                part[part == part[j]] = part[i]
                a.append(ids[i])
                b.append(ids[j])
    return pd.DataFrame({"a": np.array(a, dtype=ids.dtype), "b": np.array(b, dtype=ids.dtype)})


def near_copies(documents: DataFrame, threshold: float = 0.8, block: int = BLOCK) -> DataFrame:
    """``doc_id`` and ``class_id``: the smallest doc_id that links of the given similarity lead to, for every row of ``documents`` (``doc_id``, ``text``)."""
    sketches = stored(_sketches(documents), "sketches")
    sound = sketches.where("n > 0 and doc_id is not null")
    reps = stored(
        sound.groupBy("key_a", "key_b").agg(F.min(F.struct("doc_id", "n", "bands", "short")).alias("r")).select(
            "key_a", "key_b", F.col("r.doc_id").alias("rep"), "r.n", "r.bands", "r.short"
        ), "representatives",
    )
    listed = reps.select("rep", "n", F.explode("bands").alias("band"))
    heads = listed.groupBy("band").agg(F.min(F.struct("rep", "n")).alias("head"), F.count(F.lit(1)).alias("size")).where("size > 1")
    members = stored(listed.join(heads, "band").select("band", "rep", "n", F.col("head.rep").alias("a"), F.col("head.n").alias("head_n")), "buckets")
    near = F.least("n", "head_n") >= threshold * F.greatest("n", "head_n")
    first = members.where(near & (F.col("a") < F.col("rep"))).select("a", F.col("rep").alias("b")).distinct()
    wanted = members.select(F.col("rep").alias("doc_id")).distinct()
    # The filter keeps most texts that nobody asked for out of the shuffle; the join decides.
    texts = let_through(documents.select("doc_id", "text"), "doc_id", filled_blocks(wanted, "doc_id", WANTED_BLOCKS), WANTED_BLOCKS)
    texts = texts.join(wanted, "doc_id", "left_semi")
    elements = stored(_elements(texts).dropDuplicates(["doc_id"]) if _has_repeats(sketches) else _elements(texts), "shingles")
    links = stored(_verified(first, elements, threshold), "links")
    parts = components(links, "components").withColumnRenamed("id", "rep")
    placed = members.select("band", "rep").join(parts, "rep", "left").withColumn("component", F.coalesce("component", "rep"))
    mixed = placed.groupBy("band").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low < high").select("band")
    rest = placed.join(mixed, "band", "left_semi").join(reps.select("rep", "n", "short", "bands"), "rep")
    rest = rest.join(elements.select(F.col("doc_id").alias("rep"), "items"), "rep")
    kind = documents.schema["doc_id"].dataType.simpleString()
    second = block_pairs(rest, ["band"], "rep", block).groupBy("band", "block_a", "block_b").applyInPandas(
        lambda group: _apart(group, threshold), f"a {kind}, b {kind}"
    )
    links = links.union(stored(second, "links"))
    parts = components(links, "components").withColumnRenamed("id", "rep")
    classes = reps.select("key_a", "key_b", "rep").join(parts, "rep", "left").select("key_a", "key_b", F.coalesce("component", "rep").alias("class_id"))
    found = sound.select("doc_id", "key_a", "key_b").join(classes, ["key_a", "key_b"]).select("doc_id", "class_id")
    alone = sketches.where("not coalesce(n > 0 and doc_id is not null, false)").select("doc_id", F.col("doc_id").alias("class_id"))
    return found.union(alone)


def _has_repeats(rows: DataFrame) -> bool:
    """Whether a doc_id occurs twice."""
    return bool(rows.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").limit(1).count())


def drop_near_copies(documents: DataFrame, threshold: float = 0.8) -> DataFrame:
    """One document of each class, that of the smallest doc_id, with all columns; rows without doc_id stay."""
    classes = near_copies(documents, threshold)
    removed = stored(classes.where("doc_id <> class_id").select("doc_id").distinct(), "removed")
    kept = documents.join(removed, "doc_id", "left_anti").select(*documents.columns)
    known = documents.select("doc_id").where("doc_id is not null")
    if not _has_repeats(known):
        return kept
    # Rows of one doc_id are one document; which of them stays is told by their values.
    named = kept.where("doc_id is not null").dropDuplicates(["doc_id"])
    return named.union(kept.where("doc_id is null"))
