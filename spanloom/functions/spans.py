"""Column functions over one span. All of them stay inside generated JVM code."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

CLIENT, SERVER, OTHER = "CLIENT", "SERVER", "OTHER"
ERROR_TAG = "error"

# The four log events that mark a span's role, with one bit each.
EVENT_BITS = {"cs": 1, "cr": 2, "ss": 4, "sr": 8}
CLIENT_BITS = 1 | 2
SERVER_BITS = 4 | 8

# A character that Java counts as non-blank: the three no-break spaces are separators yet not blank.
_NOT_BLANK = r"[^\t-\r\x1C-\x1F\p{Z}]|[\x{00A0}\x{2007}\x{202F}]"


def integer_div(value: Column, divisor: int) -> Column:
    """Long division that truncates toward zero."""
    return F.call_function("div", value, F.lit(divisor))


def is_not_blank(text: Column) -> Column:
    # Most texts begin with a printable ASCII character, which needs no pattern.
    return F.coalesce(F.ascii(text).between(33, 126) | text.rlike(_NOT_BLANK), F.lit(False))


def is_accumulable(span_id: Column, service: Column, operation: Column, start_us: Column) -> Column:
    """A span can take part in pairing; its parent id may be empty."""
    return (
        is_not_blank(span_id) & is_not_blank(service) & is_not_blank(operation)
        & F.coalesce(start_us > 0, F.lit(False))
    )


def _is_event(field: Column) -> Column:
    return (F.lower(field["key"]) == "event") & (field["v_str"] != "")


def event_bits(logs: Column) -> Column:
    """The bits of all role events in a span's logs, or-ed together."""
    # One walk, one look-up a field: lambdas are interpreted, and walked again for every use of their result.
    bit_of = F.create_map(*[F.lit(x) for name, value in EVENT_BITS.items() for x in (f"event={name}", value)])
    named = lambda f: F.lower(F.concat(f["key"], F.lit("="), f["v_str"]))
    fields = F.coalesce(F.flatten(logs["fields"]), F.flatten(F.array_compact(logs["fields"])))
    bits = F.aggregate(fields, F.lit(0), lambda known, f: known.bitwiseOR(F.coalesce(F.try_element_at(bit_of, named(f)), F.lit(0))))
    return F.when(F.size(logs) > 0, bits).otherwise(0)


def _first_value(tags: Column, key: str) -> Column:
    return F.get(tags["v_str"], (F.array_position(tags["key"], key) - 1).cast("int"))


def _last_value(tags: Column, key: str) -> Column:
    keys, values = F.reverse(tags["key"]), F.reverse(tags["v_str"])
    return F.get(values, (F.array_position(keys, key) - 1).cast("int"))


def span_type(logs: Column, tags: Column) -> Column:
    """Role of a span: exactly the client or the server events, else the first ``span.kind`` tag."""
    by_bits = {CLIENT_BITS: CLIENT, SERVER_BITS: SERVER}
    all_bits = sum(EVENT_BITS.values())
    # Looked up rather than compared, so that the logs are walked once.
    told_by_events = F.get(F.array(*[F.lit(by_bits.get(b)).cast("string") for b in range(all_bits + 1)]), event_bits(logs))
    kind = F.lower(_first_value(tags, "span.kind"))
    told_by_tag = F.when(kind == "client", CLIENT).when(kind == "server", SERVER)
    return F.coalesce(told_by_events, told_by_tag, F.lit(OTHER))


def event_timestamp(logs: Column, event: str) -> Column:
    """Timestamp of the first log carrying the given event, null if there is none."""
    def carries(log: Column) -> Column:
        return F.coalesce(
            F.exists(log["fields"], lambda f: _is_event(f) & (F.lower(f["v_str"]) == event.lower())),
            F.lit(False),
        )

    return F.get(F.filter(logs, carries), F.lit(0))["timestamp"]


def collect_tags(tags: Column, keys: Sequence[str] = ()) -> Column:
    """Map of the configured tag keys, the last value of a repeated key winning.

    The error tag is always collected because edge statistics count it.
    """
    # No lambda: it would have all lookups interpreted and the tags turned round for each of them.
    none = F.array().cast("array<struct<key:string,value:string>>")
    entries = []
    for key in dict.fromkeys([*keys, ERROR_TAG]):
        value = _last_value(tags, key)
        entries.append(F.when(value.isNotNull(), F.array(F.struct(F.lit(key).alias("key"), value.alias("value")))).otherwise(none))
    return F.map_from_entries(F.concat(*entries))


def end_time_ms(time_ms: Column, duration_us: Column) -> Column:
    return time_ms + integer_div(duration_us, 1000)


def is_later_than(time_ms: Column, duration_us: Column, cutoff_ms: int | Column) -> Column:
    """The span ended strictly after the cutoff."""
    cutoff = cutoff_ms if isinstance(cutoff_ms, Column) else F.lit(cutoff_ms)
    return end_time_ms(time_ms, duration_us) > cutoff


def default_role(role: Column, default: str) -> Column:
    """Fill in an unknown role; a known one stays."""
    return F.when(role == OTHER, F.lit(default)).otherwise(role)
