"""Embedding near copies: a pivot-permutation index over vectors, then exact cosines.

Reference points (pivots) are a bounded sample of the vectors. Every vector is described by its ``NEAREST`` nearest
pivots in order and listed below each of them. Two vectors that share at least ``SHARED`` of their nearest pivots are candidates;
their cosine in double precision decides. All vectors are indexed; the number of pivots grows with the square root of
their number up to ``PIVOTS_AT_MOST``.

Equal vectors of a label are compared once, and a list that is long is cut into blocks that meet pair by pair, so no
task holds a long list and no pair of vectors becomes a row: a task returns link counts and the links of a spanning forest.

Defined results: vectors that are null, empty, zero or hold null or non-finite components, and vectors without a label, link with
nothing and are components of their own; vectors of unlike length do not link; a null vec_id links with nothing; rows are told apart by ``vec_id``, so
rows repeated with the same id are one vector linked once for each further row; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from spanloom.llm.shared import block_pairs, components, stored

NEAREST = 8
SHARED = 1  # the cosine of every pair that meets in a list decides
APART = 0.9  # pivots are less alike than this
PIVOTS_AT_MOST = 4096
BLOCK = 512


def _pivots(vectors: DataFrame, total: int, at_most: int) -> dict[int, np.ndarray]:
    """For every dimension, a matrix of unit pivots: of twice as many vectors as wanted, those with the smallest hashes, the first that lie apart.

    Pivots side by side would tell vectors near them apart by nothing but noise, as in a large group of near copies.
    """
    n = int(min(at_most, max(16, 4 * math.isqrt(max(total, 1)))))
    rows = vectors.orderBy(F.xxhash64("key", F.lit("pivot")), "vec_id").limit(2 * n).select("vector").collect()
    found: dict[int, list[np.ndarray]] = {}
    for (vector,) in rows:
        v = np.asarray(vector, dtype=np.float64)
        v /= np.linalg.norm(v)
        chosen = found.setdefault(len(v), [])
        if len(chosen) < n and (not chosen or (np.array(chosen) @ v).max() < APART):
            chosen.append(v)
    return {size: np.array(rows) for size, rows in found.items()}


def _nearest(vectors: np.ndarray, pivots: np.ndarray | None, count: int) -> np.ndarray:
    """The numbers of the nearest pivots of each vector, nearest first; ties go to the smaller number."""
    if pivots is None:
        return np.zeros((len(vectors), 1), dtype=np.int32)  # a dimension no pivot has: one list for all its vectors
    similar = vectors @ pivots.T
    return np.argsort(-similar, axis=1, kind="stable")[:, :count].astype(np.int32)


def _links(group: pd.DataFrame, threshold: float, shared: int) -> pd.DataFrame:
    """Counts and forest links of one pair of blocks of one pivot's list."""
    pivot, block_a, block_b = int(group["pivot"].iloc[0]), int(group["block_a"].iloc[0]), int(group["block_b"].iloc[0])
    vectors = np.array([np.frombuffer(v, dtype=np.float64) for v in group["unit"]])
    nearest = np.array([np.frombuffer(p, dtype=np.int32) for p in group["nearest"]])
    copies, ids, own = group["copies"].to_numpy(), group["key"].to_numpy(), group["own_block"].to_numpy()
    places, place = np.unique(nearest, return_inverse=True)
    listed = np.zeros((len(group), len(places)), dtype=np.float32)
    np.put_along_axis(listed, place.reshape(nearest.shape), 1, axis=1)
    common = listed @ listed.T
    # A pair is judged in the list of its smallest shared pivot only.
    smaller = places < pivot
    first = (listed[:, smaller] @ listed[:, smaller].T) == 0
    near = first & (common >= min(shared, nearest.shape[1])) & (vectors @ vectors.T >= threshold)
    if block_a != block_b:
        near &= own[:, None] != own[None, :]
    np.fill_diagonal(near, False)
    counts = near @ copies.astype(np.float64)
    low = np.arange(len(group))
    order = np.argsort(ids, kind="stable")
    near = near[np.ix_(order, order)]
    while True:  # the smallest place each row reaches within the block
        reach = np.where(near, low[None, :], len(low)).min(axis=1, initial=len(low))
        grown = np.minimum(low, reach)
        grown = grown[grown]
        if (grown == low).all():
            break
        low = grown
    ids = ids[order]
    found = pd.DataFrame({"key": ids, "links": counts[order].astype(np.int64), "other": ids[low]})
    return found[found["links"] > 0]


def link_vectors(
    embeddings: DataFrame, threshold: float = 0.98, nearest: int = NEAREST, shared: int = SHARED,
    pivots_at_most: int = PIVOTS_AT_MOST, block: int = BLOCK,
) -> DataFrame:
    """``vec_id``, ``n_links``, ``component_id``, ``kept`` for each row of ``embeddings`` (``vec_id``, ``embedding``, ``label``)."""
    rows = embeddings.select("vec_id", "label", F.col("embedding").cast("array<double>").alias("vector"))
    none = F.lit(0.0)
    sound = F.coalesce(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & (F.size("vector") > 0) & ~F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))), F.lit(False))
    peak = F.array_max(F.transform("vector", F.abs))
    sound = sound & F.coalesce(peak > none, F.lit(False))
    # Scaling by the greatest component keeps squares of very large or small numbers finite.
    ready = rows.where(sound).withColumn("vector", F.transform("vector", lambda x: x / peak + 0.0))
    same = F.col("label"), F.col("vector")
    classes = stored(
        ready.groupBy(*same).agg(F.min("vec_id").alias("key"), F.count(F.lit(1)).alias("copies")).withColumn("vec_id", F.col("key")), "vectors"
    )
    total = classes.count()
    pivots = _pivots(classes, total, pivots_at_most)

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = batch.column("vector").to_pylist()
            units, places = [], []
            for v in raw:
                v = np.asarray(v, dtype=np.float64)
                v = v / np.linalg.norm(v)
                units.append(v.tobytes())
                places.append(v)
            lists: list[np.ndarray | None] = [None] * len(raw)
            sizes = np.array([len(v) for v in places])
            for size in np.unique(sizes):
                at = np.flatnonzero(sizes == size)
                for i, found in zip(at, _nearest(np.array([places[i] for i in at]), pivots.get(int(size)), nearest)):
                    lists[i] = found
            columns = [batch.column("label"), pa.array(sizes, pa.int32()), batch.column("key"), batch.column("copies"),
                       pa.array(units, pa.binary()), pa.array([x.tobytes() for x in lists], pa.binary()), pa.array([x.tolist() for x in lists], pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays(columns, ["label", "size", "key", "copies", "unit", "nearest", "pivots"])

    label, key = (classes.schema[c].dataType.simpleString() for c in ("label", "key"))
    indexed = classes.select("label", "vector", "key", "copies").mapInArrow(
        index, f"label {label}, size int, key {key}, copies bigint, unit binary, nearest binary, pivots array<int>"
    )
    lists = indexed.select("label", "size", F.explode("pivots").alias("pivot"), "key", "copies", "unit", "nearest")
    dealt = block_pairs(lists, ["label", "size", "pivot"], "key", block)
    links = stored(
        dealt.groupBy("label", "size", "pivot", "block_a", "block_b").applyInPandas(
            lambda group: _links(group, threshold, shared), f"key {key}, links bigint, other {key}"
        ), "links",
    )
    joined = components(links.where("key <> other").select(F.col("key").alias("a"), F.col("other").alias("b")), "components")
    counted = links.groupBy("key").agg(F.sum("links").alias("links"))
    linked = classes.join(counted, "key", "left").join(joined.withColumnRenamed("id", "key"), "key", "left").select(
        "label", "vector", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "key").alias("component_id")
    )
    # Rows find their class by value; equal vectors are few to a class or split by adaptive execution.
    found = ready.join(linked, ["label", "vector"]).select("vec_id", "n_links", "component_id")
    alone = rows.where(~sound).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return found.union(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
