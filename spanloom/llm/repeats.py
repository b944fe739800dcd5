"""Repeated passages by suffix sorting, one suffix bucket at a time.

A byte goes if a string of ``DEPTH`` bytes covers it that also starts earlier in the table (smaller doc_id, or same document, earlier start).

Suffixes that agree on ``DEPTH`` bytes share the smallest hashed ``GRAM``-byte string in these bytes, at one distance: their anchor. The anchor is the
suffix bucket. A document's consecutive suffixes of one anchor are a chunk, one row. Rows of anchors that occur once are done with; of
equal chunks all but the first go as a whole (aggregated before the shuffle). What is left are unlike chunks of one anchor. They meet bucket by bucket
in sorted blocks of bounded size, where their suffixes are sorted with a difference cover (``suffixes``): ties beyond its period are told by ranks
of the cover's sample. Buckets of more than ``FINE`` unlike chunks are cut finer first: a chunk falls into pieces whose suffixes stand at distances to the anchor
within one class of ``STEP``; these suffixes share ``DEPTH - STEP + 1`` bytes at one place, whose hash is the piece's own bucket. Pieces that
are alone there are done with, equal ones go as chunks do, so that a common string with ever new surroundings costs a row per piece and none per suffix. Of these buckets, those of more
than ``WIDE`` unlike pieces are dealt to parts, sorted each by itself; the suffixes that come first in a part are named by their hash, and an
aggregate finds the first of a name.

Defined results: null and empty texts have no bytes and lose none; rows repeated with one doc_id, and rows without one, are documents of their own, ordered by
doc_id (nulls first), then text; an empty table gives no rows; other columns stay in ``drop_repeats`` and are ignored elsewhere.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructType

from spanloom.llm.shared import U64, ByteHashes, mix, stored, text_batches
from spanloom.llm.suffixes import PERIOD, Block

DEPTH = 100
GRAM = 20
BATCH = 1 << 19  # characters at a time
FINE = 128  # unlike chunks
STEP = 20
WIDE = 2048
BLOCK_BYTES = 1 << 19


def _joined(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bytes of all texts, where each begins, where each ends)."""
    encoded = [(t or "").encode() for t in texts]
    ends = np.cumsum([len(e) for e in encoded], dtype=np.int64)
    return np.frombuffer(b"".join(encoded), dtype=np.uint8), ends - np.array([len(e) for e in encoded], dtype=np.int64), ends


def _packed(low: np.ndarray, count: np.ndarray, inner: np.ndarray) -> np.ndarray:
    """First suffix, number of suffixes and distance to the anchor (both below 128) as one number, in the order of the first suffix."""
    return (low * 128 + count) * 128 + inner


class Chunks:
    """The chunks of some texts: ``text``, ``low`` (first suffix), ``count`` (suffixes), ``anchor`` (positions in the joined bytes), ``bucket`` and ``name``."""

    def __init__(self, texts: list[str | None]) -> None:
        self.data, self.begins, self.ends = _joined(texts)
        self.hashes = ByteHashes(self.data)
        last = np.maximum(self.ends - DEPTH + 1, self.begins)
        sizes = last - self.begins
        starts = np.repeat(self.begins - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
        grams = self.hashes.grams(GRAM)
        place = np.arange(len(grams), dtype=U64)
        low = (grams & U64(0xFFFFFFFF00000000)) | place  # the leftmost of the smallest
        span = 1
        width = DEPTH - GRAM + 1
        while 2 * span <= width:
            low = np.minimum(low[:-span], low[span:]) if len(low) > span else low[:0]
            span *= 2
        if span < width:
            rest = width - span
            low = np.minimum(low[:-rest], low[rest:]) if len(low) > rest else low[:0]
        anchors = (low[starts] & U64(0xFFFFFFFF)).astype(np.int64) if len(starts) else np.zeros(0, np.int64)
        new = np.ones(len(starts), dtype=bool)
        new[1:] = (anchors[1:] != anchors[:-1]) | (starts[1:] != starts[:-1] + 1)
        at = np.flatnonzero(new)
        self.low, self.count, self.anchor = starts[at], np.diff(np.append(at, len(starts))), anchors[at]
        self.text = np.searchsorted(self.ends, self.low, side="right")
        self.bucket = grams[self.anchor] if len(at) else np.zeros(0, U64)
        with np.errstate(over="ignore"):
            shape = (self.anchor - self.low).astype(U64) * U64(0x9E3779B97F4A7C15) + self.count.astype(U64)
            self.name = mix(self.hashes.of(self.low, self.low + self.count + DEPTH - 1) ^ mix(shape))

    def first_in_text(self) -> tuple[np.ndarray, np.ndarray]:
        """(chunks that are the first of their kind in their text, how many of the kind it has)."""
        order = np.lexsort((self.low, self.name, self.bucket, self.text))
        new = np.ones(len(order), dtype=bool)
        new[1:] = (self.name[order][1:] != self.name[order][:-1]) | (self.bucket[order][1:] != self.bucket[order][:-1]) | (self.text[order][1:] != self.text[order][:-1])
        at = np.flatnonzero(new)
        return order[at], np.diff(np.append(at, len(order)))


def _rows(documents: DataFrame) -> DataFrame:
    """(``bucket``, ``name``, ``key``, ``place``, ``times``) of every chunk that is the first of its kind in its document."""
    schema = StructType().add("bucket", "long").add("name", "long").add("key", documents.schema["key"].dataType).add("place", "long").add("times", "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for part in text_batches(batch.column("text").to_pylist(), BATCH):
                found = Chunks(part)
                rows, times = found.first_in_text()
                text = found.text[rows]
                place = _packed(found.low[rows] - found.begins[text], found.count[rows], found.anchor[rows] - found.low[rows])
                keys = batch.column("key").slice(at, len(part)).take(pa.array(text))
                at += len(part)
                yield pa.RecordBatch.from_arrays([
                    pa.array(found.bucket[rows].view(np.int64)), pa.array(found.name[rows].view(np.int64)), keys, pa.array(place), pa.array(times.astype(np.int64)),
                ], schema.names)

    return documents.select("key", "text").mapInArrow(run, schema)


def _cut_out(unlike: DataFrame, documents: DataFrame) -> DataFrame:
    """Bytes of the chunks of ``unlike``: (``bucket``, ``n`` (chunks of the bucket), ``key``, ``low``, ``inner`` (anchor), ``bytes``)."""
    listed = unlike.groupBy("key").agg(F.collect_list(F.struct("place", "bucket", "n")).alias("chunks"))
    both = documents.select("key", "text").join(listed, "key")
    schema = StructType().add("bucket", "long").add("n", "long").add("key", documents.schema["key"].dataType)
    schema = schema.add("low", "long").add("inner", "long").add("bytes", "binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("chunks")
            size = np.diff(lists.offsets.to_numpy())
            chunks, row = lists.flatten(), np.repeat(np.arange(len(size)), size)
            place = chunks.field("place").to_numpy()
            low, count, inner = place // 16384, place // 128 % 128, place % 128
            begin, end = low.tolist(), (low + count + DEPTH - 1).tolist()
            texts = [t.encode() for t in batch.column("text").to_pylist()]
            pieces = [texts[i][a:e] for i, a, e in zip(row.tolist(), begin, end)]
            yield pa.RecordBatch.from_arrays([
                chunks.field("bucket"), chunks.field("n"), batch.column("key").take(pa.array(row)), pa.array(low), pa.array(inner), pa.array(pieces, pa.binary()),
            ], schema.names)

    return both.select("key", "text", "chunks").mapInArrow(run, schema)


def _finer(chunks: DataFrame) -> DataFrame:
    """The pieces of chunks: (``bucket`` and ``name`` of the piece, ``key``, ``low``, ``inner``, ``bytes``)."""
    schema = StructType().add("bucket", "long").add("name", "long").add("key", chunks.schema["key"].dataType)
    schema = schema.add("low", "long").add("inner", "long").add("bytes", "binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("bytes").to_pylist()
            size = np.array([len(t) for t in texts], dtype=np.int64)
            begins = np.cumsum(size) - size
            low, inner = batch.column("low").to_numpy(), batch.column("inner").to_numpy()
            count = size - DEPTH + 1
            hashes = ByteHashes(np.frombuffer(b"".join(texts), dtype=np.uint8))
            # Distances from the anchor fall by one from suffix to suffix, from ``inner`` on.
            least = inner - count + 1
            classes = inner // STEP - least // STEP + 1
            row = np.repeat(np.arange(len(size)), classes)
            of = (inner // STEP)[row] - (np.arange(len(row)) - np.repeat(np.cumsum(classes) - classes, classes))
            far, near = np.minimum(inner[row], of * STEP + STEP - 1), np.maximum(least[row], of * STEP)
            start, end = inner[row] - far, inner[row] - near + DEPTH  # within the chunk
            shared = begins[row] + inner[row] - of * STEP
            with np.errstate(over="ignore"):
                old = batch.column("bucket").to_numpy().view(U64)[row]
                bucket = mix(old ^ mix(hashes.of(shared, shared + DEPTH - STEP + 1) + of.astype(U64)))
                shape = far.astype(U64) * U64(0x9E3779B97F4A7C15) + near.astype(U64)
                name = mix(hashes.of(begins[row] + start, begins[row] + end) ^ mix(shape))
            pieces = [texts[i][a:e] for i, a, e in zip(row.tolist(), start.tolist(), end.tolist())]
            yield pa.RecordBatch.from_arrays([
                pa.array(bucket.view(np.int64)), pa.array(name.view(np.int64)), batch.column("key").take(pa.array(row)),
                pa.array(low[row] + start), pa.array(far), pa.array(pieces, pa.binary()),
            ], schema.names)

    return chunks.select("bucket", "key", "low", "inner", "bytes").mapInArrow(run, schema)


def _judged(
    number: np.ndarray, wide: np.ndarray, keys: np.ndarray, low: np.ndarray, inner: np.ndarray, pieces: list[bytes]
) -> tuple[tuple[np.ndarray, ...], tuple[np.ndarray, ...]]:
    """Among the chunks of whole parts of buckets (``number``): (row, start, end) of runs of suffixes that start earlier too,
    and (row, start, distance to the anchor, name) of the first of every suffix in wide buckets.
    """
    sizes = np.array([len(p) for p in pieces])
    # Anchors stand at multiples of the period, so suffixes at one distance from their anchors have one remainder.
    begins = np.empty(len(pieces), dtype=np.int64)
    parts, at = [], 0
    for i, (piece, anchor) in enumerate(zip(pieces, inner.tolist())):
        gap = -(at + anchor) % PERIOD
        parts += [bytes(gap), piece]
        begins[i] = at + gap
        at += gap + len(piece)
    text = np.frombuffer(b"".join(parts), dtype=np.uint8)
    block = Block(text, DEPTH)
    count = sizes - DEPTH + 1
    row = np.repeat(np.arange(len(pieces)), count)
    step = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
    where = number[row] * 256 + (step - inner[row] + 128)
    order, new = block.equal_runs(begins[row] + step, where)
    start = low[row] + step
    several = ~new
    several[:-1] |= ~new[1:]
    order, run = order[several], np.cumsum(new)[several]
    later = np.lexsort((start[order], np.unique(keys, return_inverse=True)[1][row[order]], run))
    first = np.ones(len(later), dtype=bool)
    first[1:] = run[later][1:] != run[later][:-1]
    gone = np.sort(order[later[~first]])
    stays = wide[row]
    stays[gone] = False
    told = np.flatnonzero(stays)
    at = begins[row[told]] + step[told]
    firsts = (row[told], start[told], step[told] - inner[row[told]], ByteHashes(text).of(at, at + DEPTH).view(np.int64) if len(told) else np.zeros(0, np.int64))
    edge = np.ones(len(gone), dtype=bool)
    edge[1:] = (row[gone][1:] != row[gone][:-1]) | (step[gone][1:] != step[gone][:-1] + 1)
    begin = np.flatnonzero(edge)
    end = np.append(begin[1:], len(gone))[: len(begin)] - 1
    return (row[gone[begin]], start[gone[begin]], start[gone[end]] + DEPTH), firsts


def _sorted_buckets(chunks: DataFrame) -> DataFrame:
    """(``key``, ``start``, ``end``) of repeated runs within the parts of buckets; of wide buckets also the first of every suffix in
    a part (``end`` null), with ``bucket``, ``off`` and ``name``.
    """
    schema = StructType().add("key", chunks.schema["key"].dataType).add("start", "long").add("end", "long")
    schema = schema.add("bucket", "long").add("off", "long").add("name", "long")

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            if sum(b.nbytes for b in held) < BLOCK_BYTES:
                continue
            table = pa.Table.from_batches(held).combine_chunks()
            other = np.flatnonzero(numbers(table) != numbers(table)[-1])
            # Whole parts of buckets only: the last one may go on in the next batch.
            cut = int(other[-1]) + 1 if len(other) else 0
            held = table.slice(cut).to_batches()
            yield from pieces(table.slice(0, cut))
        if held:
            yield from pieces(pa.Table.from_batches(held).combine_chunks())

    def numbers(table: pa.Table) -> np.ndarray:
        """The parts of buckets in the order of the rows, from 0."""
        bucket, part = (table.column(c).to_numpy() for c in ("bucket", "part"))
        return np.cumsum(np.concatenate([[False], (bucket[1:] != bucket[:-1]) | (part[1:] != part[:-1])]))

    def pieces(table: pa.Table) -> Iterator[pa.Table]:
        """Runs of whole parts of about BLOCK_BYTES."""
        if not table.num_rows:
            return
        bucket = numbers(table)
        size = np.cumsum(table.column("size").to_numpy())
        edges = np.append(np.flatnonzero(bucket[1:] != bucket[:-1]) + 1, len(bucket))
        at = 0
        while at < len(bucket):
            done = size[at - 1] if at else 0
            fits = edges[(edges > at) & (size[edges - 1] - done <= BLOCK_BYTES)]
            end = int(fits[-1]) if len(fits) else int(edges[edges > at][0])
            yield table.slice(at, end - at)
            at = end

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in blocks(batches):
            keys = table.column("key").combine_chunks()
            (row, start, end), (first, begin, off, name) = _judged(
                numbers(table), table.column("wide").to_numpy(), keys.to_numpy(zero_copy_only=False), table.column("low").to_numpy(),
                table.column("inner").to_numpy(), table.column("bytes").to_pylist(),
            )
            bucket = table.column("bucket").combine_chunks().take(pa.array(first))
            none = pa.nulls(len(row), pa.int64())
            yield pa.RecordBatch.from_arrays([keys.take(pa.array(row)), pa.array(start), pa.array(end), none, none, none], schema.names)
            yield pa.RecordBatch.from_arrays(
                [keys.take(pa.array(first)), pa.array(begin), pa.nulls(len(first), pa.int64()), bucket, pa.array(off), pa.array(name)], schema.names
            )

    dealt = chunks.select("bucket", "part", "wide", "key", "low", "inner", "bytes", F.octet_length("bytes").cast("long").alias("size"))
    return dealt.repartition("bucket", "part").sortWithinPartitions("bucket", "part").mapInArrow(run, schema)


def _across_parts(firsts: DataFrame) -> DataFrame:
    """(``key``, ``start``, ``end``) of suffixes that are the first of their part but not of their bucket."""
    named = ["bucket", "off", "name"]
    first = firsts.groupBy(*named).agg(F.min(F.struct("key", "start")).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    later = firsts.join(first.drop("n"), named).where("struct(key, start) <> first")
    return later.select("key", "start", (F.col("start") + DEPTH).alias("end"))


def keyed(documents: DataFrame) -> DataFrame:
    """``documents`` with ``key``: its doc_id, or where ids repeat or are missing, a number in their order."""
    ids = documents.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1 or doc_id is null")
    if not ids.limit(1).count():
        return documents.withColumn("key", F.col("doc_id"))
    return stored(documents.orderBy("doc_id", "text").withColumn("key", F.monotonically_increasing_id()), "ordered")


def repeated(documents: DataFrame) -> DataFrame:
    """(``key``, ``start``, ``end``): runs of bytes that start earlier too, in or across the texts of ``documents`` (``key``, ``text``).

    Chunks that repeat within one document are left to ``_removed``, which sees them in the text itself.
    """
    rows = _rows(documents)
    often = rows.groupBy("bucket").agg(F.sum("times").alias("n")).where("n > 1").select("bucket")
    alive = stored(rows.join(often, "bucket", "left_semi"), "chunks")
    first = stored(alive.groupBy("bucket", "name").agg(F.min(F.struct("key", "place")).alias("first")), "first")
    kinds = first.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    unlike = first.join(kinds, "bucket").select("bucket", "n", "first.key", "first.place")
    chunks = stored(_cut_out(unlike, documents), "unlike")
    low, count = F.shiftright("place", 14), F.shiftright("place", 7) % 128
    whole = alive.join(first, ["bucket", "name"]).where("struct(key, place) <> first").select("key", low.alias("start"), (low + count + DEPTH - 1).alias("end"))

    pieces = stored(_finer(chunks.where(F.col("n") > FINE)), "pieces")
    met = pieces.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("bucket")
    met = pieces.join(met, "bucket", "left_semi")
    first = met.groupBy("bucket", "name").agg(F.min(F.struct("key", "low")).alias("first"))
    kinds = first.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))
    met = stored(met.join(first, ["bucket", "name"]).join(kinds, "bucket").withColumn("is_first", F.expr("struct(key, low) = first")).drop("name", "first"), "met")
    whole = whole.union(met.where("not is_first").select("key", F.col("low").alias("start"), (F.col("low") + F.octet_length("bytes")).alias("end")))

    columns = ["bucket", "n", "key", "low", "inner", "bytes"]
    dealt = chunks.where(F.col("n") <= FINE).select(*columns).union(met.where("is_first and n > 1").select(*columns))
    part = F.pmod(F.xxhash64("key", "low"), F.ceil(F.col("n") / WIDE)).cast("int")
    judged = stored(_sorted_buckets(dealt.withColumn("part", part).withColumn("wide", F.col("n") > WIDE)), "judged")
    return whole.union(judged.where("end is not null").select("key", "start", "end")).union(_across_parts(judged.where("end is null")))


def _own_repeats(found: Chunks) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, start, end) of chunks that are not the first of their kind in their text."""
    later = np.ones(len(found.low), dtype=bool)
    later[found.first_in_text()[0]] = False
    at = np.flatnonzero(later)
    text = found.text[at]
    start = found.low[at] - found.begins[text]
    return text, start, start + found.count[at] + DEPTH - 1


def _removed(found: Chunks, runs: list[list[dict] | None]) -> np.ndarray:
    """Which of the joined bytes go."""
    change = np.zeros(len(found.data) + 1, dtype=np.int64)
    text, start, end = _own_repeats(found)
    np.add.at(change, found.begins[text] + start, 1)
    np.add.at(change, found.begins[text] + end, -1)
    for begin, spans in zip(found.begins.tolist(), runs):
        for span in spans or ():
            change[begin + span["start"]] += 1
            change[begin + span["end"]] -= 1
    return np.cumsum(change[:-1]) > 0


def _with_runs(documents: DataFrame) -> DataFrame:
    """``documents`` (with ``key``) and ``runs``: the repeated runs of each document, all of them its own bytes."""
    listed = repeated(documents).groupBy("key").agg(F.collect_list(F.struct("start", "end")).alias("runs"))
    return documents.join(listed, "key", "left")


def report(documents: DataFrame) -> DataFrame:
    """``doc_id``, ``n_bytes``, ``n_removed``, ``n_spans``, ``kept_sha256`` of every row of ``documents`` (``doc_id``, ``text``)."""
    schema = documents.select("doc_id").schema.add("n_bytes", "long").add("n_removed", "long").add("n_spans", "long").add("kept_sha256", "string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for part in text_batches(batch.column("text").to_pylist(), BATCH):
                found = Chunks(part)
                gone = _removed(found, batch.column("runs").slice(at, len(part)).to_pylist())
                counts, spans, kept = [], [], []
                for begin, end in zip(found.begins, found.ends):
                    own = gone[begin:end]
                    counts.append(int(own.sum()))
                    spans.append(int((own[1:] & ~own[:-1]).sum() + own[:1].sum()))
                    kept.append(hashlib.sha256(found.data[begin:end][~own].tobytes()).hexdigest())
                ids = batch.column("doc_id").slice(at, len(part))
                at += len(part)
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(found.ends - found.begins), pa.array(counts, pa.int64()), pa.array(spans, pa.int64()), pa.array(kept, pa.string())], schema.names
                )

    return _with_runs(keyed(documents.select("doc_id", "text"))).select("doc_id", "text", "runs").mapInArrow(run, schema)


def drop_repeats(documents: DataFrame) -> DataFrame:
    """``documents`` without repeated passages: characters all of whose bytes are repeated go from ``text``. Null texts stay null; no row goes."""
    if {"key", "runs"} & set(documents.columns):
        raise ValueError("documents must not have columns named key or runs")
    names = documents.columns
    text = names.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, kept = 0, []
            for part in text_batches(batch.column(text).to_pylist(), BATCH):
                found = Chunks(part)
                gone = _removed(found, batch.column("runs").slice(at, len(part)).to_pylist())
                at += len(part)
                # A character stays with all its bytes if any of them stays.
                begins = (found.data & 0xC0) != 0x80
                character = np.cumsum(begins) - 1
                stays = np.bincount(character, ~gone, int(begins.sum())) > 0 if len(gone) else np.zeros(0, bool)
                keep = stays[character]
                kept += [None if t is None else found.data[b:e][keep[b:e]].tobytes().decode() for t, b, e in zip(part, found.begins, found.ends)]
            columns = [pa.array(kept, pa.string()) if i == text else batch.column(i) for i in range(len(names))]
            yield pa.RecordBatch.from_arrays(columns, names)

    return _with_runs(keyed(documents)).select(*names, "runs").mapInArrow(run, documents.schema)
