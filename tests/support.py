"""Rows that several test modules build."""


def raw_span(span_id, parent, service, kind=None, start_ms=1_000_000, duration_us=100_000, seq=0, tags=(), trace="t"):
    """A raw span; ``kind`` is told by log events and the kind tag as tracing clients do."""
    events = {"CLIENT": ("cs", "cr"), "SERVER": ("sr", "ss")}.get(kind, ())
    logs = [(start_ms * 1000, [("event", e)]) for e in events]
    kind_tag = [("span.kind", kind.lower())] if kind else []
    return (trace, span_id, parent, service, "oper", start_ms * 1000, duration_us, logs, [*kind_tag, *tags], seq)
