"""Embedding whitening: vectors projected on the leading components of their covariance, each scaled to variance 1.

Components are fitted on all vectors. Entries are read as integers, so counts, sums and products are exact whatever the order in which tasks add them up; the covariance is
one rounding away from the true one. Tasks add up their own vectors and hand on d sums or d * d / 2 products. The eigenvalue intervals of the covariance are solved by FEAST, a task each.

Defined results: vectors that are null or hold null, NaN, infinite or huge (2**40 and above) entries are left out, so are those whose length is not the most frequent one
(of equally frequent lengths, the greatest). Rows with a null id or an id seen before count as any other. Components of variance zero are left out, so one
vector, equal vectors, or none give no rows. Other columns are ignored. More than ``DIMENSIONS_AT_MOST`` entries are an error, as d * d numbers go to every task.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from spanloom.llm import feast
from spanloom.llm.shared import stored

COMPONENTS = 32
SCALE, SHIFT = 64, 1_000_000
DIMENSIONS_AT_MOST = 2048
ROWS = 4096  # vectors multiplied at a time
_LONG = (1 << 63) - 1


def _usable(vectors: DataFrame) -> DataFrame:
    """``vec_id`` and ``entries`` (doubles) of the vectors to fit on."""
    rows = vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("entries"))
    return rows.where(F.col("entries").isNotNull() & F.forall("entries", lambda c: F.coalesce(F.abs(c) < 2.0**40, F.lit(False))))


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, int, np.ndarray]]:
    """(rows' ids, length, matrix of integer entries) of vectors of one length, ``ROWS`` at most."""
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            ids, entries = (batch.column(c).slice(at, ROWS) for c in ("vec_id", "entries"))
            flat = np.asarray(entries.flatten())
            lengths = np.asarray(entries.value_lengths())
            starts = np.cumsum(lengths) - lengths
            for size in np.unique(lengths).tolist():
                rows = np.flatnonzero(lengths == size)
                values = flat[starts[rows][:, None] + np.arange(size)]
                yield ids.take(pa.array(rows)), size, np.floor(SCALE * values).astype(np.int64) + SHIFT


def _decimals(values: list[int]) -> pa.Array:
    return pa.array([Decimal(v) for v in values], pa.decimal128(38, 0))


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per length: the sum of each entry, and at -1 the number of vectors."""
    held: dict[int, list] = {}
    for _, size, x in _parts(batches):
        own = held.setdefault(size, [0, np.zeros(size, dtype=object)])
        own[0] += len(x)
        own[1] += x.sum(axis=0)  # 4,096 entries below 2**47 stay below 2**63
    for size, (n, sums) in held.items():
        yield pa.RecordBatch.from_arrays(
            [pa.array([size] * (size + 1), pa.int32()), pa.array(range(-1, size), pa.int32()), _decimals([n, *sums.tolist()])], ["size", "at", "total"]
        )


def _products(y: np.ndarray) -> np.ndarray:
    """y'y exactly: through doubles where no sum can pass 2**53, else through unbounded integers."""
    if len(y) * int(np.abs(y).max(initial=0)) ** 2 < 1 << 53:
        y = y.astype(float)
        return (y.T @ y).astype(np.int64)
    y = y.astype(object)
    return y.T @ y


class Fit:
    """What whitening needs to know of all vectors: their number, sums, covariance and its components."""

    def __init__(self, n: int, sums: list[int]) -> None:
        self.n, self.size = n, len(sums)
        self.near = np.array([(2 * s + n) // (2 * n) for s in sums], dtype=np.int64)  # the mean, rounded
        self.rest = [s - n * c for s, c in zip(sums, self.near.tolist())]
        self.values, self.vectors, self.trace = np.zeros(0), np.zeros((self.size, 0)), 0.0

    def centred(self, x: np.ndarray) -> np.ndarray:
        """n * x - sums, exactly."""
        y = x - self.near
        if self.n * (int(np.abs(y).max(initial=0)) + 1) < 1 << 62:
            return y * self.n - np.array(self.rest, dtype=np.int64)
        return y.astype(object) * self.n - np.array(self.rest, dtype=object)

    def whitened(self, centred: np.ndarray) -> np.ndarray:
        return (centred / self.n).astype(float) @ self.vectors / np.sqrt(self.values)


def _deviations(centred: np.ndarray) -> pa.Array:
    """Sums of squares of each row; null where a long cannot hold them."""
    if centred.dtype != object and centred.shape[1] * int(np.abs(centred).max(initial=0)) ** 2 <= _LONG:
        return pa.array((centred * centred).sum(axis=1), pa.int64())
    wide = centred.astype(object)
    return pa.array([v if v <= _LONG else None for v in (wide * wide).sum(axis=1)], pa.int64())


def fit(usable: DataFrame) -> Fit | None:
    """The fit on all rows of ``usable``, None if there are none."""
    spark = usable.sparkSession
    sums = stored(usable.mapInArrow(_sums, "size int, at int, total decimal(38,0)").groupBy("size", "at").agg(F.sum("total").alias("total")), "sums")
    best = sums.where("at = -1").orderBy(F.desc("total"), F.desc("size")).first()
    if best is None or best.size == 0:
        return None
    if best.size > DIMENSIONS_AT_MOST:
        raise ValueError(f"vectors of {best.size} entries; at most {DIMENSIONS_AT_MOST} are supported")
    own = sums.where((F.col("size") == best.size) & (F.col("at") >= 0)).orderBy("at").collect()
    found = Fit(int(best.total), [int(r.total) for r in own])

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((found.size, found.size), dtype=object)
        for _, size, x in _parts(batches):
            if size == found.size:
                total += _products(x - found.near)
        for i in range(found.size):
            row = total[i, i:].tolist()
            yield pa.RecordBatch.from_arrays(
                [pa.array([i] * len(row), pa.int32()), pa.array(range(i, found.size), pa.int32()), _decimals(row)], ["i", "j", "total"]
            )

    summed = usable.mapInArrow(products, "i int, j int, total decimal(38,0)").groupBy("i", "j").agg(F.sum("total").alias("total"))
    matrix, n = np.zeros((found.size, found.size)), found.n
    for row in summed.toLocalIterator():
        matrix[row.i, row.j] = matrix[row.j, row.i] = (n * int(row.total) - found.rest[row.i] * found.rest[row.j]) / (n * n)
    found.trace = float(np.trace(matrix))
    cuts = feast.intervals(matrix, COMPONENTS)
    shared = spark.sparkContext.broadcast(matrix)

    def spaces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for cut in batch.to_pylist():
                space = feast.solve(shared.value, cut["low"], cut["high"], cut["inside"])
                yield pa.RecordBatch.from_pylist([{"space": space.tobytes(), "inside": cut["inside"]}], pa.schema([("space", pa.binary()), ("inside", pa.int32())]))

    if cuts:
        table = spark.createDataFrame(cuts, "low double, high double, inside int").repartition(len(cuts))
        solved = [np.frombuffer(bytes(r.space)).reshape(found.size, r.inside) for r in table.mapInArrow(spaces, "space binary, inside int").collect()]
        found.values, found.vectors = feast.combine(matrix, solved, COMPONENTS)
    shared.unpersist()
    return found


def _identity_error(usable: DataFrame, found: Fit) -> float:
    """The largest entry, by amount, of the whitened vectors' covariance minus the identity."""
    k = len(found.values)

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, squares = np.zeros(k), np.zeros((k, k))
        for _, size, x in _parts(batches):
            if size == found.size:
                w = found.whitened(found.centred(x))
                sums += w.sum(axis=0)
                squares += w.T @ w
        for i in range(k):
            yield pa.RecordBatch.from_arrays(
                [pa.array([i] * (k + 1), pa.int32()), pa.array(range(-1, k), pa.int32()), pa.array([sums[i], *squares[i]])], ["i", "j", "total"]
            )

    rows = usable.mapInArrow(moments, "i int, j int, total double").groupBy("i", "j").agg(F.sum("total").alias("total")).collect()
    means, squares = np.zeros(k), np.zeros((k, k))
    for row in rows:
        if row.j < 0:
            means[row.i] = row.total / found.n
        else:
            squares[row.i, row.j] = row.total / found.n
    return float(np.abs(squares - np.outer(means, means) - np.eye(k)).max())


def whiten(vectors: DataFrame) -> DataFrame:
    """A row per vector of ``vectors`` (``vec_id``, ``embedding``) and component: ``component``, ``n``, ``deviation``, ``whitened``, ``explained``, ``identity_error``."""
    usable = _usable(vectors)
    found = fit(usable)
    schema = vectors.select("vec_id").schema
    for name, kind in (("component", "integer"), ("n", "long"), ("deviation", "long"), ("whitened", "double"), ("explained", "double"), ("identity_error", "double")):
        schema = schema.add(name, kind)
    if found is None or not len(found.values):
        return vectors.sparkSession.createDataFrame([], schema)
    error, k = _identity_error(usable, found), len(found.values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shares = found.values / found.trace
        for ids, size, x in _parts(batches):
            if size == found.size:
                centred = found.centred(x)
                each = pa.array(np.repeat(np.arange(len(x)), k))
                yield pa.RecordBatch.from_arrays([
                    ids.take(each), pa.array(np.tile(np.arange(1, k + 1), len(x)), pa.int32()), pa.array(np.full(len(each), found.n)),
                    _deviations(centred).take(each), pa.array(found.whitened(centred).reshape(-1)), pa.array(np.tile(shares, len(x))), pa.array(np.full(len(each), error)),
                ], names=schema.names)

    return usable.mapInArrow(run, schema)
