"""Quality classifier: a linear-chain conditional random field labels every line good or bad.

A line is described by shares of kinds of bytes and by its words, and by the same of the lines before and after it. Forward-backward
gives each line's probability of being good; a document's quality is their mean, weighted by length.

The field is fitted on a bounded sample (``SAMPLE`` labelled documents, those with the smallest hashes of their ids), whose lines take their document's
label. Scoring is one pass over all texts without a shuffle.

Defined results: null and empty texts are one empty line; labels that are null are not learned from; with no labelled rows every
score is 0.5; repeated label rows count as often as they occur in the sample; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from spanloom.llm import crf
from spanloom.llm.shared import ByteHashes, text_batches

SAMPLE = 4000
BATCH = 1 << 20  # characters described at a time
TRAIN_BATCH = 1 << 17  # the same in training, which is done by the driver

_KINDS = {
    "lower": b"abcdefghijklmnopqrstuvwxyz", "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", "digit": b"0123456789", "space": b" \t\r",
    "stop": b".", "comma": b",;:", "loud": b"!?", "bar": b"|", "mark": b"#$%&*+<=>@^_~\\/{}[]", "quote": b"\"'()-`",
}


def _tables() -> np.ndarray:
    """A row of 0/1 over the 256 bytes for each kind, and one for bytes beyond ASCII that begin a character."""
    rows = np.zeros((len(_KINDS) + 1, 256), dtype=np.uint8)
    for row, members in zip(rows, _KINDS.values()):
        row[list(members)] = 1
    rows[-1, 0xC0:] = 1
    return rows


def _line_sums(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    sums = np.zeros(len(values) + 1, dtype=np.int32)
    np.cumsum(values, out=sums[1:])
    return sums[ends] - sums[starts]


def describe(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(features of every line, bytes of every line, lines of every text)."""
    encoded = [(t or "").encode("utf-8", "surrogatepass") + b"\n" for t in texts]
    data = np.frombuffer(b"".join(encoded), dtype=np.uint8)
    line_feeds = np.flatnonzero(data == 10)
    starts = np.concatenate([[0], line_feeds[:-1] + 1]).astype(np.int64) if len(line_feeds) else np.zeros(0, np.int64)
    ends = line_feeds
    text_ends = np.cumsum([len(e) for e in encoded]) if encoded else np.zeros(0, np.int64)
    lengths = np.diff(np.searchsorted(line_feeds, text_ends - 1, side="right"), prepend=0)
    size = (ends - starts).astype(float)
    some = np.maximum(size, 1)
    tables = _tables()
    shares = [_line_sums(row[data], starts, ends) / some for row in tables]
    marks = (tables[6] | tables[7] | tables[8])[data].astype(bool)
    again = np.zeros(len(data), dtype=np.uint8)
    again[1:] = marks[1:] & (data[1:] == data[:-1])
    upper = tables[1][data].astype(bool)
    loud = np.zeros(len(data), dtype=np.uint8)
    loud[1:] = upper[1:] & upper[:-1]
    # Words between white space, and how many of a line's are there for the first time.
    gap = (data == 32) | (data == 10) | (data == 9) | (data == 13)
    word = ~gap
    first = np.flatnonzero(word & np.concatenate([[True], gap[:-1]]))
    last = np.flatnonzero(word & np.concatenate([gap[1:], [True]])) + 1
    line = np.searchsorted(line_feeds, first)
    n_words = np.bincount(line, minlength=len(starts)).astype(float)
    text_of_line = np.repeat(np.arange(len(lengths)), lengths)
    with np.errstate(over="ignore"):
        code = ByteHashes(data).of(first, last) + text_of_line[line].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    order = np.argsort(code, kind="stable")
    new = np.ones(len(code), dtype=bool)
    new[order[1:]] = code[order][1:] != code[order][:-1]
    fresh = np.bincount(line[new], minlength=len(starts)) / np.maximum(n_words, 1)
    stutter = np.bincount(line[1:][code[1:] == code[:-1]], minlength=len(starts)) / np.maximum(n_words, 1)
    own = np.column_stack([
        *shares, _line_sums(again, starts, ends) / some, _line_sums(loud, starts, ends) / some,
        np.log1p(size), size / np.maximum(n_words, 1) / 10, fresh, stutter, size == 0,
    ]).reshape(len(starts), len(tables) + 7)
    before, after = np.zeros_like(own), np.zeros_like(own)
    inner = np.ones(len(own), dtype=bool)
    begins = (np.cumsum(lengths) - lengths).astype(np.int64)
    inner[begins] = False
    at = np.flatnonzero(inner)
    before[at], after[at - 1] = own[at - 1], own[at]
    lone = np.ones(len(own))
    alone = np.column_stack([~inner, np.append(~inner[1:], True) if len(inner) else np.zeros(0)])
    return np.column_stack([lone, own, before, after, alone]), size + 1, lengths


class Model:
    """A fitted field with the scale of its features."""

    def __init__(self, weights: np.ndarray, step: np.ndarray, centre: np.ndarray, spread: np.ndarray) -> None:
        self.weights, self.step, self.centre, self.spread = weights, step, centre, spread

    def scores(self, texts: list[str | None]) -> np.ndarray:
        """Quality of each text, 0 to 1."""
        found = []
        for part in text_batches(texts, BATCH):
            features, size, lengths = describe(part)
            good, _, _ = crf.forward_backward(((features - self.centre) / self.spread) @ self.weights, lengths, self.step)
            text = np.repeat(np.arange(len(lengths)), lengths)
            found.append(np.bincount(text, good * size, len(part)) / np.bincount(text, size, len(part)))
        return np.clip(np.concatenate(found), 0.0, 1.0) if found else np.zeros(0)


def train(documents: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Fit on ``labels`` (``doc_id``, ``quality``), of which at most ``sample`` documents are used."""
    chosen = labels.where("doc_id is not null and quality is not null").select("doc_id", F.col("quality").cast("int").alias("quality"))
    # A bounded number of rows, and so small enough to send to every task.
    chosen = chosen.orderBy(F.xxhash64("doc_id"), "doc_id", "quality").limit(sample)
    texts = documents.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").orderBy(F.xxhash64("doc_id"), "doc_id", "text")
    rows = texts.select("text", "quality").collect()
    parts = [describe(part) for part in text_batches([r["text"] for r in rows], TRAIN_BATCH)] or [describe([])]
    features, lengths = np.concatenate([p[0] for p in parts]), np.concatenate([p[2] for p in parts])
    if not rows:
        return Model(np.zeros(features.shape[1]), np.zeros((2, 2)), np.zeros(features.shape[1]), np.ones(features.shape[1]))
    centre, spread = features.mean(axis=0), features.std(axis=0)
    centre[0], spread[spread < 1e-9] = 0.0, 1.0
    marked = np.repeat(np.array([int(r["quality"] > 0) for r in rows]), lengths)
    weights, step = crf.fit((features - centre) / spread, lengths, marked)
    return Model(weights, step, centre, spread)


def score(documents: DataFrame, model: Model, column: str = "score") -> DataFrame:
    """``documents`` with the quality of ``text`` in ``column``; one pass, no shuffle."""
    if column in documents.columns:
        raise ValueError(f"documents already has a column {column}")
    names = documents.columns
    text = names.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = model.scores(batch.column(text).to_pylist())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.float64())], [*names, column])

    return documents.mapInArrow(run, documents.select("*").schema.add(column, "double"))


def held_out(doc_id: Column) -> Column:
    """Rows that are not learned from: crc32 of the id as text leaves 1 modulo 3."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1
