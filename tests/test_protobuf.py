"""Protobuf spans: round trips, unknown fields, damage."""

import random
import struct

import pyarrow as pa
import pytest

import testbed as tb
from spanloom.schemas import SPAN
from spanloom.sources import protobuf as pb

EMPTY = {"trace_id": "", "span_id": "", "parent_span_id": "", "service_name": "", "operation_name": "", "start_us": 0, "duration_us": 0, "logs": [], "tags": []}


def decode(messages, kind=None):
    columns = pb.decode_batch(pa.array(messages, kind or pa.binary()))
    return pa.RecordBatch.from_arrays(columns, [f.name for f in pb._RESULT.fields]).to_pylist()


def some_span(rng):
    text = lambda: "".join(rng.choice("aé😀 z") for _ in range(rng.randrange(200 if rng.random() < 0.1 else 6)))
    tags = lambda: [{"key": text(), "v_str": text()} for _ in range(rng.randrange(4))]
    number = lambda: rng.choice([0, 1, 127, 128, 1 << 40, -1, -(1 << 63), (1 << 63) - 1])
    logs = [{"timestamp": number(), "fields": tags()} for _ in range(rng.randrange(4))]
    return {**{n: text() for n in pb._TEXTS}, "start_us": number(), "duration_us": number(), "logs": logs, "tags": tags()}


@pytest.mark.parametrize("kind", [pa.binary(), pa.large_binary()])
def test_spans_come_back(kind):
    rng = random.Random(1)
    spans = [some_span(rng) for _ in range(400)]
    assert decode([tb.span_message(s) for s in spans], kind) == [{**s, "wrong": None} for s in spans]
    sliced = pa.array([b"x", *[tb.span_message(s) for s in spans]], kind).slice(5, 7)
    assert pb.decode_batch(sliced)[0].to_pylist() == [s["trace_id"] for s in spans[4:11]]


def test_unknown_repeated_and_typed_fields():
    field, tag = tb._field, lambda raw: tb._field(9, raw)
    fixed = lambda number, value: tb._varint(number << 3 | 1) + struct.pack("<d", value)
    message = field(77, b"abc") + field(1, "old") + field(1, "new") + field(6, 5) + field(6, b"not a number") + tb._varint(80 << 3 | 5) + b"1234" + fixed(81, 1.0)
    message += tag(field(1, "n") + field(2, 3) + field(4, -7)) + tag(field(1, "b") + field(6, 1)) + tag(field(1, "d") + fixed(5, 0.5)) + tag(b"")
    row = decode([message])[0]
    assert (row["trace_id"], row["start_us"], row["wrong"]) == ("new", 5, None)
    assert [(t["key"], t["v_str"]) for t in row["tags"]] == [("n", "-7"), ("b", "true"), ("d", "0.5"), ("", "")]


def test_damage_is_told_and_never_spreads():
    rng, messages, sound = random.Random(2), [], []
    for _ in range(300):
        raw = tb.span_message(some_span(rng))
        cut = bytearray(raw[: rng.randrange(len(raw) + 1)] if rng.random() < 0.5 else raw)
        for _ in range(rng.randrange(3)):
            if cut:
                cut[rng.randrange(len(cut))] = rng.randrange(256)
        good = some_span(rng)
        messages += [bytes(cut), tb.span_message(good), None, b""]
        sound.append(good)
    rows = decode(messages)
    assert rows[1::4] == [{**s, "wrong": None} for s in sound]
    assert {r["wrong"] for r in rows[2::4]} == {"null"} and rows[3::4] == [{**EMPTY, "wrong": None}] * 300
    assert {r["wrong"] for r in rows[0::4]} == {None, "damaged"}
    bad = [b"\x0a\x05ab", b"\x0a", b"\x08", b"\x80" * 11, b"\x0b", b"\x02\x00", b"\x0a\x02\xff\xfe", b"\x31\x00", b"\x0a\xff\xff\xff\xff\xff\xff\xff\xff\xff\x01", b"\x42\x03\x12\x05a", b"\x4a\x03\x0a\x01\xff"]
    assert {r["wrong"] for r in decode(bad)[:7] + decode(bad)[8:]} == {"damaged"}
    assert decode([]) == []


def test_against_the_protobuf_library():
    descriptors = pytest.importorskip("google.protobuf.descriptor_pb2")
    from google.protobuf import descriptor_pool, message_factory

    kinds = descriptors.FieldDescriptorProto
    file = descriptors.FileDescriptorProto(name="s.proto", syntax="proto3")
    shapes = {
        "Tag": [("key", 1, kinds.TYPE_STRING, None), ("v_str", 3, kinds.TYPE_STRING, None)],
        "Log": [("timestamp", 1, kinds.TYPE_INT64, None), ("fields", 2, kinds.TYPE_MESSAGE, "Tag")],
        "Span": [*[(n, i, kinds.TYPE_INT64 if n.endswith("_us") else kinds.TYPE_STRING, None) for n, i in pb.SPAN_FIELDS.items() if i < 8], ("logs", 8, kinds.TYPE_MESSAGE, "Log"), ("tags", 9, kinds.TYPE_MESSAGE, "Tag")],
    }
    for name, fields in shapes.items():
        message = file.message_type.add(name=name)
        for field, number, kind, inner in fields:
            message.field.add(name=field, number=number, type=kind, type_name=f".{inner}" if inner else None, label=kinds.LABEL_REPEATED if inner else kinds.LABEL_OPTIONAL)
    pool = descriptor_pool.DescriptorPool()
    pool.Add(file)
    span_type = message_factory.GetMessageClass(pool.FindMessageTypeByName("Span"))
    rng = random.Random(9)
    spans = [some_span(rng) for _ in range(100)]
    assert decode([span_type(**s).SerializeToString() for s in spans]) == [{**s, "wrong": None} for s in spans]


def test_column_of_messages(spark):
    rng = random.Random(4)
    spans = [some_span(rng) for _ in range(50)]
    df = spark.createDataFrame([(i, tb.span_message(s)) for i, s in enumerate(spans)] + [(99, b"\x0a"), (98, None)], "at long, wire binary")
    decoded = pb.decode_messages(df.repartition(3), "wire", df["at"])
    assert [r.trace_id for r in pb.spans_of(decoded).orderBy("arrival_seq").collect()] == [s["trace_id"] for s in spans]
    assert sorted(r.wrong for r in pb.damaged_of(decoded).collect()) == ["damaged", "null"]
    assert pb.spans_of(pb.decode_messages(df.limit(0), "wire")).count() == 0


def test_spans_become_messages_without_python(spark):
    """The feed of messages is made by column functions, byte by byte as span by span."""
    rng = random.Random(8)
    spans = [{**some_span(rng), "arrival_seq": n} for n in range(40)]
    spans.append({**spans[0], "service_name": "\u00e9\u4e16" * 90, "start_us": -1, "duration_us": 1 << 62, "logs": [], "tags": [], "arrival_seq": 40})
    made = spark.createDataFrame(spans, SPAN).select("arrival_seq", tb.span_message_of().alias("m")).collect()
    assert [bytes(r.m) for r in sorted(made)] == [tb.span_message(s) for s in spans]
    assert "MapInArrow" not in tb.span_messages(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
