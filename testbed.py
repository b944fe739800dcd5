"""The driver tables as raw spans.

Orders are client spans, order lines are child spans, and the first line of some
orders is a server span under the order's own id. Roles are told partly by log
events and partly by the ``span.kind`` tag.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import StructType

from spanloom.operators.spans import light_spans
from spanloom.schemas import SPAN
from spanloom.sources import protobuf as pb

BASE_US = 1_704_067_200_000_000  # 2024-01-01 UTC
BASE_MS = BASE_US // 1000
WINDOW_MS = 300_000
NOW_MS = BASE_MS + 86_250_000
TAG_KEYS = ("infrastructure_provider", "tier")


_schemas: dict[str, StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table; its schema is looked up once, not by a job per use."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _schemas:
        _schemas[path] = spark.read.parquet(path).schema
    return spark.read.schema(_schemas[path]).parquet(path)


def _tag(key: str, value: Column | str) -> Column:
    value = F.lit(value) if isinstance(value, str) else value
    return F.struct(F.lit(key).alias("key"), value.alias("v_str"))


def _event(at: Column, value: str, key: str = "event") -> Column:
    fields = F.array(_tag("message", "seen"), _tag(key, value))
    return F.struct(at.alias("timestamp"), fields.alias("fields"))


def _some(*tags: Column | tuple[Column, Column]) -> Column:
    """An array of tags, those given with a condition only where it holds."""
    none = F.array().cast(SPAN["tags"].dataType)
    parts = [F.when(t[0], F.array(t[1])).otherwise(none) if isinstance(t, tuple) else F.array(t) for t in tags]
    return F.concat(*parts)


def _logs(condition: Column, *events: Column) -> Column:
    return F.when(condition, F.array(*events)).otherwise(F.array().cast(SPAN["logs"].dataType))


def _order_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").join(
        table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey")
    )
    key = F.col("o_orderkey")
    start = F.lit(BASE_US) + (key % 86400) * 1_000_000
    duration = F.lit(200_000) + (key % 1000) * 100
    by_log = key % 2 == 0
    provider = F.when(key % 5 == 0, "dc").when(key % 5 == 1, "aws,dc").otherwise("aws")
    tags = _some(
        (~by_log, _tag("span.kind", "Client")),
        (F.col("o_orderstatus") == "F", _tag("error", "true")),
        (F.col("o_orderstatus") == "O", _tag("error", "false")),
        _tag("infrastructure_provider", "unset"),
        _tag("infrastructure_provider", provider),
        _tag("tier", (F.col("c_nationkey") % 3 + 1).cast("string")),
        _tag("http.url", F.concat(F.lit("/order/"), key.cast("string"))),
    )
    return rows.select(
        key.cast("string").alias("trace_id"),
        F.concat(F.lit("O"), key).alias("span_id"),
        F.lit("").alias("parent_span_id"),
        F.lower("c_mktsegment").alias("service_name"),
        F.col("o_orderpriority").alias("operation_name"),
        start.alias("start_us"),
        duration.alias("duration_us"),
        _logs(by_log, _event(start, "cs"), _event(start + duration, "CR", "Event")).alias("logs"),
        tags.alias("tags"),
        (key * 16).alias("arrival_seq"),
    )


def _served_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Dealt by order once, for the lines of an order and for their numbers in it.
    lines = table(spark, sf_dir, "lineitem").repartition("l_orderkey").groupBy("l_orderkey", "l_linenumber").agg(
        F.min("l_suppkey").alias("suppkey"),
        F.max("l_quantity").cast("long").alias("quantity"),
        F.char(F.max(F.ascii("l_returnflag"))).alias("flag"),  # one letter; numbers aggregate by hash
    )
    return lines.join(table(spark, sf_dir, "supplier"), F.col("suppkey") == F.col("s_suppkey")).join(
        table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey")
    )


def _server_tags(*extra: tuple[Column, Column]) -> Column:
    nation = F.col("s_nationkey") % 3
    return _some(
        *extra,
        (F.col("flag") == "R", _tag("error", "true")),
        (nation == 0, _tag("infrastructure_provider", "aws")),
        (nation == 1, _tag("infrastructure_provider", "dc")),
    )


def _line_spans(served: DataFrame) -> DataFrame:
    """A child span per line, and a span sharing the order's id for some first lines."""
    key, line = F.col("l_orderkey"), F.col("l_linenumber")
    order_start = F.lit(BASE_US) + (key % 86400) * 1_000_000
    duration = F.col("quantity") * 1000
    in_order = Window.partitionBy("l_orderkey").orderBy("l_linenumber")
    shares = (F.col("nth") == 1) & (key % 3 == 0) & (F.col("s_nationkey") % 4 == 0)
    order_id = F.concat(F.lit("O"), key)

    is_server, by_log = line % 2 == 0, line % 4 == 0
    child_start, shared_start = order_start + line * 1000, order_start + 500
    # A lone "sr" is no role; neither is any event of an unknown name.
    child_logs = F.when(by_log, F.array(_event(child_start, "sr"), _event(child_start + duration, "ss"))).otherwise(
        F.array(_event(child_start, "sr"), _event(child_start, "enqueued"))
    )
    # A line gives its child span, and where ``shares`` the shared span too: told by a flag, so that no span is built inside an array and copied out.
    told = served.withColumn("nth", F.row_number().over(in_order)).withColumn(
        "is_shared", F.explode(F.when(shares, F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False))))
    )
    by_span = lambda shared, child: F.when(F.col("is_shared"), shared).otherwise(child)
    shared_logs = F.array(_event(shared_start, "SR"), _event(shared_start + duration, "ss"))
    return told.select(
        key.cast("string").alias("trace_id"),
        by_span(order_id, F.concat(F.lit("L"), key, F.lit("-"), line)).alias("span_id"),
        by_span(F.lit(""), order_id).alias("parent_span_id"),
        F.lower("n_name").alias("service_name"),
        F.concat(F.lit("op-"), F.col("flag")).alias("operation_name"),
        by_span(shared_start, child_start).alias("start_us"),
        duration.alias("duration_us"),
        by_span(shared_logs, child_logs).alias("logs"),
        _server_tags((is_server & ~by_log & ~F.col("is_shared"), _tag("span.kind", "SERVER"))).alias("tags"),
        by_span(key * 16 + 8, key * 16 + line).alias("arrival_seq"),
    )


def raw_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _order_spans(spark, sf_dir).unionByName(_line_spans(_served_lines(spark, sf_dir)))


def spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Light spans with the configured tags."""
    return light_spans(raw_spans(spark, sf_dir), TAG_KEYS)


def delivered_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order line as a light span; lines sharing order and number are copies of one span or not, by supplier."""
    rows = (
        table(spark, sf_dir, "lineitem")
        .join(table(spark, sf_dir, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
        .join(table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    )
    key, line = F.col("l_orderkey"), F.col("l_linenumber")
    return rows.select(
        key.cast("string").alias("trace_id"),
        F.concat(F.lit("L"), key, F.lit("-"), line).alias("span_id"),
        F.concat(F.lit("O"), key).alias("parent_span_id"),
        (F.lit(BASE_MS) + (key % 86400) * 1000 + line).alias("time_ms"),
        F.lower("n_name").alias("service_name"),
        F.concat(F.lit("op-"), F.col("l_returnflag")).alias("operation_name"),
        (F.col("l_quantity").cast("long") * 1000).alias("duration_us"),
        F.lit("OTHER").alias("span_type"),
        F.create_map().cast("map<string,string>").alias("tags"),
        F.col("l_partkey").alias("arrival_seq"),
    )


def reused_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Light spans of 5 ms an order, whose ids and traces come again.

    Orders of odd numbers repeat an id after five seconds or more, those of even numbers after two: with an interval of 2.5 s the former are forgotten in between.
    """
    key = F.col("trace_id").cast("long")
    short = F.when(key % 2 == 1, key % 1000).otherwise(key % 400).cast("string")
    # A letter, the order's number, and what follows it.
    rename = lambda c: F.when(c == "", "").otherwise(F.concat(F.substring(c, 1, 1), short, F.substr(c, F.length("trace_id") + 2)))
    return spans(spark, sf_dir).select(
        "*", rename(F.col("span_id")).alias("id"), rename(F.col("parent_span_id")).alias("up")
    ).select(
        F.concat(F.lit("T"), short).alias("trace_id"), F.col("id").alias("span_id"), F.col("up").alias("parent_span_id"),
        (F.col("time_ms") - (key % 86400) * 995).alias("time_ms"), "service_name", "operation_name", "duration_us", "span_type", "tags", "arrival_seq",
    )


FEED_BATCHES = 7


def delayed_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw spans within eight seconds, two seconds to a micro-batch (column ``batch``), many of them late.

    Lines come up to three batches after their time, some orders one batch, so a parent may come before or after its child and be held or forgotten by then.
    """
    key, place = F.col("trace_id").cast("long"), F.col("arrival_seq") % 16
    delay = F.when(place == 0, F.when(key % 3 == 0, 1).otherwise(0)).when(place == 8, key % 2).otherwise(place % 4)
    batch = (F.floor(key % 8 / 2) + delay).cast("long")
    return raw_spans(spark, sf_dir).select(
        "*", batch.alias("batch")
    ).withColumn("start_us", F.col("start_us") - (key % 86400 - key % 8) * 1_000_000).withColumn(
        "arrival_seq", F.col("arrival_seq") + F.col("batch") * (1 << 40)
    )


def _varint(n: int) -> bytes:
    n &= (1 << 64) - 1
    out = bytearray()
    while n > 0x7F:
        out.append(n & 0x7F | 0x80)
        n >>= 7
    return bytes([*out, n])


def _field(number: int, value: str | bytes | int) -> bytes:
    if isinstance(value, int):
        return _varint(number << 3) + _varint(value)
    raw = value.encode() if isinstance(value, str) else value
    return _varint(number << 3 | 2) + _varint(len(raw)) + raw


def span_message(span: dict) -> bytes:
    """A raw span as a protobuf message, with a field that readers do not know."""
    tag = lambda t: _field(pb.TAG_FIELDS["key"], t["key"]) + _field(pb.TAG_FIELDS["v_str"], t["v_str"])
    message = b"".join(_field(number, span[name]) for name, number in pb.SPAN_FIELDS.items() if name not in ("logs", "tags") and span[name])
    for log in span["logs"]:
        fields = b"".join(_field(pb.LOG_FIELDS["fields"], tag(t)) for t in log["fields"])
        message += _field(pb.SPAN_FIELDS["logs"], _field(pb.LOG_FIELDS["timestamp"], log["timestamp"]) + fields)
    return message + _field(99, 7) + b"".join(_field(pb.SPAN_FIELDS["tags"], tag(t)) for t in span["tags"])


def _hex_varint(n: Column, places: int = 10) -> Column:
    """``_varint`` as hexadecimal text; ``places`` is the most bytes it can have."""
    two = lambda byte: F.lpad(F.hex(byte), 2, "0")
    left = lambda place: F.shiftrightunsigned(n, 7 * place)
    byte = lambda place: left(place).bitwiseAND(F.lit(127)) + (F.when(left(place + 1) != 0, 128).otherwise(0) if place + 1 < places else 0)
    long = F.concat(two(byte(0)), *[F.when(left(place) != 0, two(byte(place))).otherwise("") for place in range(1, places)])
    return F.when((n >= 0) & (n < 128), two(n)).otherwise(long)


def _hex_number(number: int, value: Column) -> Column:
    return F.concat(F.lit(_varint(number << 3).hex()), _hex_varint(value))


def _hex_bytes(number: int, size: Column, value: Column) -> Column:
    return F.concat(F.lit(_varint(number << 3 | 2).hex()), _hex_varint(size.cast("long"), 5), value)


def _hex_text(number: int, value: Column) -> Column:
    return _hex_bytes(number, F.octet_length(value), F.hex(value))


def _hex_inner(number: int, messages: Column) -> Column:
    """The messages of an array as fields, one after the other."""
    return F.array_join(F.transform(messages, lambda m: _hex_bytes(number, F.length(m) / 2, m)), "")


def span_message_of() -> Column:
    """``span_message`` of a raw span's columns."""
    tag = lambda t: F.concat(_hex_text(pb.TAG_FIELDS["key"], t["key"]), _hex_text(pb.TAG_FIELDS["v_str"], t["v_str"]))
    log = lambda e: F.concat(
        _hex_number(pb.LOG_FIELDS["timestamp"], e["timestamp"]), _hex_inner(pb.LOG_FIELDS["fields"], F.transform(e["fields"], tag))
    )
    parts = []
    for name, number in pb.SPAN_FIELDS.items():
        if name not in ("logs", "tags"):
            is_text = SPAN[name].dataType.typeName() == "string"
            told, given = (F.col(name) != "", _hex_text(number, F.col(name))) if is_text else (F.col(name) != 0, _hex_number(number, F.col(name)))
            parts.append(F.when(told, given).otherwise(""))
    parts.append(_hex_inner(pb.SPAN_FIELDS["logs"], F.transform("logs", log)))
    parts.append(F.lit(_field(99, 7).hex()))
    parts.append(_hex_inner(pb.SPAN_FIELDS["tags"], F.transform("tags", tag)))
    return F.unhex(F.concat(*parts))


def span_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw spans as messages with their offset; every 50th is cut short in a copy that comes first."""
    whole = raw_spans(spark, sf_dir).select(F.col("arrival_seq").alias("offset"), span_message_of().alias("whole"))
    cut = F.expr("substring(whole, 1, octet_length(whole) - 1)")
    sent = F.when(F.col("offset") % 50 == 0, F.array(cut, F.col("whole"))).otherwise(F.array("whole"))
    return whole.select("offset", F.explode(sent).alias("value"))
