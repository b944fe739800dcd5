"""Protobuf spans in binary columns, as a message bus delivers them, to raw spans.

A whole Arrow batch is decoded at once: all messages step through their fields side by side in NumPy, nested messages become messages of their own in the next round, and
the columns are cut out of the batch's bytes. No Python object is made per field. Unknown fields, and known ones of another wire type, are skipped;
of a field that repeats where it should not, the last one counts; absent fields are empty or zero.

Messages that are null, cut short or otherwise damaged give no span. ``decode_messages`` keeps them with what is wrong, ``spans_of`` and ``damaged_of`` split the result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame, functions as F, types as T

from spanloom.schemas import SPAN

# Field numbers of the messages as they are exchanged between services (fixed values).
SPAN_FIELDS = {"trace_id": 1, "span_id": 2, "parent_span_id": 3, "service_name": 4, "operation_name": 5, "start_us": 6, "duration_us": 7, "logs": 8, "tags": 9}
LOG_FIELDS = {"timestamp": 1, "fields": 2}
TAG_FIELDS = {"key": 1, "v_str": 3, "v_long": 4, "v_double": 5, "v_bool": 6}

_VARINT, _FIXED64, _BYTES, _FIXED32 = 0, 1, 2, 5
_TEXTS = ("trace_id", "span_id", "parent_span_id", "service_name", "operation_name")
_RESULT = T.StructType([*[f for f in SPAN.fields if f.name != "arrival_seq"], T.StructField("wrong", T.StringType())])


def _varints(data: np.ndarray, at: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(values, places after them, whether each is whole) of the varints at ``at``."""
    value, place = np.zeros(len(at), dtype=np.uint64), at.copy()
    open_ = np.ones(len(at), dtype=bool)
    for shift in range(0, 70, 7):
        open_ &= place < end
        here = np.flatnonzero(open_)
        if not len(here):
            break
        byte = data[place[here]]
        value[here] |= (byte & 0x7F).astype(np.uint64) << np.uint64(shift)
        place[here] += 1
        open_[here] = byte >= 0x80
    ended = (place > at) & (data[np.maximum(place, 1) - 1] < 0x80) if len(data) else np.zeros(len(at), dtype=bool)
    return value, place, ended


class _Fields:
    """The fields of many messages: for each field its message, number, wire type, and its value or the place of its bytes."""

    def __init__(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> None:
        self.data, self.messages = data, len(start)
        self.bad = np.zeros(len(start), dtype=bool)
        cursor, rows, found = start.copy(), np.flatnonzero(start < end), []
        while len(rows):
            limit = end[rows]
            key, place, whole = _varints(data, cursor[rows], limit)
            number, wire = (key >> np.uint64(3)).astype(np.int64), (key & np.uint64(7)).astype(np.int64)
            whole &= (number > 0) & np.isin(wire, (_VARINT, _FIXED64, _BYTES, _FIXED32))
            value, after, read = _varints(data, place, limit)
            # A length can claim any number of bytes; what does not fit is damage.
            size = np.minimum(value, np.uint64(1 << 40)).astype(np.int64)
            stop = np.select([wire == _VARINT, wire == _FIXED64, wire == _FIXED32], [after, place + 8, place + 4], after + size)
            whole &= (read | (wire == _FIXED64) | (wire == _FIXED32)) & (stop <= limit)
            first = np.where(wire == _BYTES, after, place)
            found.append(np.stack([rows, number, wire, value.view(np.int64), first, stop])[:, whole])
            self.bad[rows[~whole]] = True
            cursor[rows] = stop
            rows = rows[whole & (stop < limit)]
        table = np.concatenate(found, axis=1) if found else np.zeros((6, 0), dtype=np.int64)
        self.of, self.number, self.wire, self.value, self.first, self.stop = table

    def _chosen(self, number: int, wire: int) -> np.ndarray:
        return np.flatnonzero((self.number == number) & (self.wire == wire))

    def has(self, number: int, wire: int) -> np.ndarray:
        held = np.zeros(self.messages, dtype=bool)
        held[self.of[self._chosen(number, wire)]] = True
        return held

    def longs(self, number: int) -> np.ndarray:
        chosen, values = self._chosen(number, _VARINT), np.zeros(self.messages, dtype=np.int64)
        values[self.of[chosen]] = self.value[chosen]  # in order, so the last one stays
        return values

    def doubles(self, number: int) -> np.ndarray:
        chosen, values = self._chosen(number, _FIXED64), np.zeros(self.messages)
        if len(chosen):
            values[self.of[chosen]] = self.data[self.first[chosen][:, None] + np.arange(8)].copy().view("<f8")[:, 0]
        return values

    def places(self, number: int) -> tuple[np.ndarray, np.ndarray]:
        """First and last place of the bytes of a field that is there once."""
        chosen, first, stop = self._chosen(number, _BYTES), np.zeros(self.messages, dtype=np.int64), np.zeros(self.messages, dtype=np.int64)
        first[self.of[chosen]], stop[self.of[chosen]] = self.first[chosen], self.stop[chosen]
        return first, stop

    def texts(self, number: int) -> pa.Array:
        """A text field; a message whose text is no UTF-8 is damaged."""
        first, stop = self.places(number)
        sizes = stop - first
        offsets = np.concatenate([[0], np.cumsum(sizes)])
        raw = self.data[np.repeat(first - offsets[:-1], sizes) + np.arange(offsets[-1])]
        made = pa.LargeStringArray.from_buffers(self.messages, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(raw.tobytes()))
        try:
            made.validate(full=True)
        except pa.ArrowInvalid:
            wrong = np.array([not _is_utf8(bytes(raw[a:b])) for a, b in zip(offsets[:-1], offsets[1:])])
            self.bad |= wrong
            return pa.array(["" if w else bytes(raw[a:b]).decode() for w, a, b in zip(wrong, offsets[:-1], offsets[1:])], pa.string())
        return made.cast(pa.string())

    def inner(self, number: int) -> tuple[_Fields, np.ndarray, np.ndarray]:
        """The nested messages of a field in order, which message each is part of, and list offsets per message."""
        chosen = self._chosen(number, _BYTES)
        chosen = chosen[np.argsort(self.of[chosen], kind="stable")]
        offsets = np.concatenate([[0], np.cumsum(np.bincount(self.of[chosen], minlength=self.messages))])
        return _Fields(self.data, self.first[chosen], self.stop[chosen]), self.of[chosen], offsets


def _is_utf8(raw: bytes) -> bool:
    try:
        raw.decode()
    except UnicodeDecodeError:
        return False
    return True


def _lists(offsets: np.ndarray, values: pa.Array) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values)


def _tags(outer: _Fields, number: int) -> pa.Array:
    """Lists of tags; values that are no text are written as text."""
    fields, of, offsets = outer.inner(number)
    key, text = fields.texts(TAG_FIELDS["key"]), fields.texts(TAG_FIELDS["v_str"])
    for name, wire, values in (
        ("v_long", _VARINT, lambda n: pa.array(fields.longs(n)).cast(pa.string())),
        ("v_double", _FIXED64, lambda n: pa.array(fields.doubles(n)).cast(pa.string())),
        ("v_bool", _VARINT, lambda n: pa.array(fields.longs(n) != 0).cast(pa.string())),
    ):
        there = fields.has(TAG_FIELDS[name], wire)
        if there.any():
            text = pa.compute.if_else(pa.array(there), values(TAG_FIELDS[name]), text)
    outer.bad[of[fields.bad]] = True
    return _lists(offsets, pa.StructArray.from_arrays([key, text], ["key", "v_str"]))


def decode_batch(messages: pa.Array) -> list[pa.Array]:
    """The columns of spans and of what is wrong for an array of binary messages."""
    messages = messages.cast(pa.large_binary())
    _, offsets, data = messages.buffers()
    bounds = np.frombuffer(offsets, dtype=np.int64)[messages.offset : messages.offset + len(messages) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(1, dtype=np.uint8)
    fields = _Fields(raw, bounds[:-1].copy(), bounds[1:])
    columns = {name: fields.texts(SPAN_FIELDS[name]) for name in _TEXTS}
    columns |= {name: pa.array(fields.longs(SPAN_FIELDS[name])) for name in ("start_us", "duration_us")}
    logs, of, starts = fields.inner(SPAN_FIELDS["logs"])
    entries = [pa.array(logs.longs(LOG_FIELDS["timestamp"])), _tags(logs, LOG_FIELDS["fields"])]
    columns["logs"] = _lists(starts, pa.StructArray.from_arrays(entries, ["timestamp", "fields"]))
    fields.bad[of[logs.bad]] = True
    columns["tags"] = _tags(fields, SPAN_FIELDS["tags"])
    empty = np.asarray(messages.is_null())
    wrong = np.select([empty, fields.bad], ["null", "damaged"], "").astype(object)
    return [*[columns[f.name] for f in _RESULT.fields[:-1]], pa.array([w or None for w in wrong], pa.string())]


def decode_messages(messages: DataFrame, column: str = "value", arrival: Column | None = None) -> DataFrame:
    """Raw spans of the binary ``column``, batch or stream, with ``message`` and ``wrong`` (null for a sound one).

    ``arrival`` gives the ingest position, such as an offset; the start time stands in for it.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = ["message", "arrival", *_RESULT.fieldNames()]
            yield pa.RecordBatch.from_arrays([batch.column("message"), batch.column("arrival"), *decode_batch(batch.column("message"))], names)

    given = messages.select(F.col(column).alias("message"), (F.lit(None) if arrival is None else arrival).cast("long").alias("arrival"))
    decoded = given.mapInArrow(run, T.StructType([*given.schema.fields, *_RESULT.fields]))
    return decoded.withColumn("arrival_seq", F.coalesce("arrival", "start_us")).select(*SPAN.fieldNames(), "message", "wrong")


def spans_of(decoded: DataFrame) -> DataFrame:
    return decoded.where(F.col("wrong").isNull()).select(*SPAN.fieldNames())


def damaged_of(decoded: DataFrame) -> DataFrame:
    """Messages that gave no span, for a table of their own."""
    return decoded.where(F.col("wrong").isNotNull()).select("message", "wrong")
