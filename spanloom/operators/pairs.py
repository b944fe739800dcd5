"""Matching client and server spans.

A span finds its counterpart by two lookups:

* *shared* – the second holder of a span id looks up the first holder;
* *dual*   – a span looks up the first holder of its parent id.

Both hit the same unique table, the first holder of each span id, so pairing is
one equi-join that yields at most one row per lookup. No self-join can fan out,
and a very frequent span id or parent id is a big left side against a single
right row, which adaptive execution splits over tasks.

Arrival order decides who is first. The contract, with ``rank`` the position of
a span among the distinct holders of its id:

* a span of rank 2 makes one shared pair with rank 1 and nothing else;
* a span of rank 1 looks for its parent whether that came before or after it;
* a span of higher rank is only found by a parent that arrives after it.

Holders of one id that arrived together rank by start time, service and parent
id, ids compare case-sensitively, one pair is emitted per match, and
matches stay inside ``scope``: pass ``()`` where traces carry no trace id.

Where spans may be counted first (``dealt_by_trace``), traces short enough for
one task are shuffled once, by trace, and looked up there by windows
(``trace_lookups``); only the others take the joins.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from spanloom.functions import spans as fs
from spanloom.operators.spans import IDENTITY, TRACE_SCOPE, dedupe_spans
from spanloom.session import small_methods, written_once

ARRIVAL = ("arrival_seq",)
_TIES = ("time_ms", "service_name", "parent_span_id", "span_id")

_SALTS = 32

#: Spans that a task takes, about, where spans are dealt by trace; a trace of more is paired by joins, which spread it.
TRACE_SPANS = 100_000
#: Traces are counted by the bucket they hash to, of which there are few, and not one by one.
_BUCKETS = 4_096

PAIR_SIDE = {
    "span_id": "span_id",
    "parent_span_id": "parent_span_id",
    "service": "service_name",
    "operation": "operation_name",
    "time_ms": "time_ms",
    "duration_us": "duration_us",
    "tags": "tags",
}


def leading_holders(
    spans: DataFrame,
    scope: Sequence[str] = TRACE_SCOPE,
    arrival: Sequence[str] = ARRIVAL,
    holder_open: Column | None = None,
) -> DataFrame:
    """The first two distinct holders of each span id, with their ``rank``.

    The limit is applied per task ahead of the shuffle, so an id held by a third
    of all spans sends two rows per task. ``holder_open`` limits who counts.
    """
    # The role breaks no tie; ordered by, it is read by every use, and all uses share one shuffle.
    by_id = Window.partitionBy(*scope, "span_id").orderBy(*arrival, *_TIES, "span_type")
    holders = spans if holder_open is None else spans.filter(holder_open)
    narrow = list(dict.fromkeys([*scope, *IDENTITY, *arrival, "arrival_seq", "time_ms", "span_type"]))
    return holders.select(*narrow).withColumn("rank", F.row_number().over(by_id)).filter(F.col("rank") <= 2)


def rank_holders(spans: DataFrame, leaders: DataFrame, scope: Sequence[str] = TRACE_SCOPE) -> DataFrame:
    """Add ``holder_rank``: 1 and 2 for the leading holders of a span id, 3 for the rest.

    The join is on the full identity: that key is unique, so a frequent span id
    stays spread out, and it is the key ``dedupe_spans`` already partitioned by.
    """
    identity = [*scope, *IDENTITY]
    # Told by columns of both sides: a filter on the rank of one side would sink below the join and ask for a ranking of its own.
    holder_rank = F.least(F.coalesce("rank", F.lit(3)), F.length("span_id") + 3)
    return spans.join(leaders.select(*identity, "rank"), identity, "left").withColumn("holder_rank", holder_rank).drop("rank")


def span_pairs(
    spans: DataFrame,
    scope: Sequence[str] = TRACE_SCOPE,
    *,
    arrival: Sequence[str] = ARRIVAL,
    shared: bool = True,
    dual: bool = True,
) -> DataFrame:
    """Pairs of light spans with both roles filled, before the completeness check.

    ``shared`` and ``dual`` choose the lookups to run. ``emit_seq`` is the
    arrival of the later half, the moment the match becomes known.
    """
    distinct = dedupe_spans(spans, scope, arrival)
    ranked = rank_holders(distinct, leading_holders(distinct, scope, arrival), scope)
    return match_ranked(ranked, scope, arrival=arrival, shared=shared, dual=dual)


def match_ranked(
    ranked: DataFrame,
    scope: Sequence[str] = TRACE_SCOPE,
    *,
    arrival: Sequence[str] = ARRIVAL,
    shared: bool = True,
    dual: bool = True,
    complete: bool = False,
    child_open: Column | None = None,
    holder_open: Column | None = None,
    extra: Sequence[str] = (),
) -> DataFrame:
    """Run the lookups over spans that carry ``holder_rank``; ``complete`` keeps complete pairs only.

    A stream narrows them: ``holder_open`` says which spans can still be found
    by id, ``child_open`` which still wait for a parent; ``extra`` columns come
    back as ``left_*`` and ``right_*``.
    """
    is_child = F.col("parent_span_id") != ""
    if child_open is not None:
        is_child = is_child & child_open
    is_second = F.col("holder_rank") == 2
    is_first = F.col("holder_rank") == 1
    if holder_open is not None:
        is_second, is_first = is_second & holder_open, is_first & holder_open

    # Joined arrays and not a compacted one: that would be a lambda, interpreted for every span.
    lookups = []
    if dual:
        lookups.append((is_child, F.struct(F.col("parent_span_id").alias("id"), F.lit(False).alias("same_id"))))
    if shared:
        lookups.append((is_second, F.struct(F.col("span_id").alias("id"), F.lit(True).alias("same_id"))))
    none = F.array().cast("array<struct<id:string,same_id:boolean>>")

    carried = _carried(arrival, extra)
    left = (
        ranked.select(
            *scope,
            *[F.col(c).alias(f"left_{c}") for c in carried],
            is_first.alias("left_first"),
            F.explode(F.concat(*[F.when(asked, F.array(lookup)).otherwise(none) for asked, lookup in lookups])).alias("lookup"),
        )
        .withColumn("right_span_id", F.col("lookup.id"))
        .withColumn("same_id", F.col("lookup.same_id"))
        .drop("lookup")
    )
    right = ranked.filter(is_first).select(*scope, *[F.col(c).alias(f"right_{c}") for c in carried])
    matched = left.join(right, [*scope, "right_span_id"])
    if complete:
        matched = matched.filter(_complete())
    return assign_roles(matched, scope, arrival, extra)


def _carried(arrival: Sequence[str], extra: Sequence[str] = ()) -> list[str]:
    """What a look-up reads of either span."""
    return list(dict.fromkeys([*PAIR_SIDE.values(), "span_type", *arrival, "arrival_seq", *extra]))


def _complete() -> Column:
    # One condition over both sides: a filter on either alone would sink below the shared shuffle.
    ends = F.col("left_service_name"), F.col("right_service_name")
    return (ends[0] != ends[1]) & (F.least(*ends) != "")


def dealt_by_trace(spans: DataFrame, scope: Sequence[str] = TRACE_SCOPE) -> tuple[int, DataFrame | None, DataFrame | None]:
    """``spans`` cut into those of traces that one task can take, with the number of parts to deal them to, and the others; a frame is None if it has no span.

    Counts the spans, by their trace alone. All spans of a trace are in the same frame, whatever the counts say.
    """
    if not scope:
        return 0, None, spans
    bucket = F.pmod(F.xxhash64(*[F.coalesce(c, F.lit("")) for c in scope]), F.lit(_BUCKETS))
    found = spans.groupBy(bucket.alias("bucket")).count().collect()
    total = sum(r["count"] for r in found)
    long = [r["bucket"] for r in found if r["count"] > TRACE_SPANS + 2 * total // _BUCKETS]
    parts = total // TRACE_SPANS + 1
    if not long:
        return parts, spans, None
    return parts, spans.where(~bucket.isin(long)), spans.where(bucket.isin(long))


#: What a row of ``trace_lookups`` is: a span, or its look-up of its parent or of who shares its id.
SPAN, PARENT, PARTNER = 0, 1, 2


def trace_lookups(
    spans: DataFrame,
    parts: int,
    scope: Sequence[str] = TRACE_SCOPE,
    *,
    arrival: Sequence[str] = ARRIVAL,
    child_open: Column | None = None,
    holder_open: Column | None = None,
    extra: Sequence[str] = (),
    end: Column | None = None,
) -> DataFrame:
    """The distinct spans and their look-ups of short traces (``dealt_by_trace``), from one shuffle.

    A row per distinct span and one per look-up, told apart by ``kind``: the span's columns, ``left_first`` (it is the first holder of its id), ``met`` (the look-up
    found a holder) and that holder's columns as ``right_*``. With ``end`` rows have ``last_end`` too: the greatest of it among open holders of the span's id, or,
    in a row of a look-up, among open children of that parent.
    """
    identity = [*scope, *IDENTITY]
    order = [*arrival, *[c for c in ("time_ms", "duration_us", "operation_name", "span_type") if c in spans.columns]]
    dealt = spans.withColumns({c: F.coalesce(c, F.lit("")) for c in identity}).repartition(parts, *scope)
    copies = Window.partitionBy(*identity).orderBy(*order)
    distinct = dealt.withColumn("_copy", F.row_number().over(copies)).filter("_copy = 1").drop("_copy")

    is_open = F.lit(True) if holder_open is None else F.coalesce(holder_open, F.lit(False))
    holders = Window.partitionBy(*scope, "span_id", "_open")
    place = F.row_number().over(holders.orderBy(*arrival, *_TIES, "span_type"))
    ranked = distinct.withColumn("_open", is_open).withColumn("_rank", F.when(F.col("_open"), place).otherwise(3))
    if end is not None:
        ranked = ranked.withColumn("_held_end", F.max(end).over(holders)).withColumn("_held_end", F.when(F.col("_open"), F.col("_held_end")))
    ranked = ranked.withColumn("left_first", F.col("_rank") == 1)

    is_child = F.col("parent_span_id") != ""
    if child_open is not None:
        is_child = is_child & child_open
    entry = lambda kind, name: F.struct(F.lit(kind).alias("kind"), F.col(name).alias("id"))
    none = F.array().cast("array<struct<kind:int,id:string>>")
    asked = (F.lit(True), SPAN, "span_id"), (is_child, PARENT, "parent_span_id"), (F.col("_rank") == 2, PARTNER, "span_id")
    entries = ranked.withColumn("_entry", F.explode(F.concat(*[F.when(c, F.array(entry(kind, name))).otherwise(none) for c, kind, name in asked])))
    entries = entries.select("*", "_entry.kind", "_entry.id").withColumn("_found", (F.col("kind") == SPAN) & F.col("left_first"))

    # The first holder leads the rows of its id.
    carried = _carried(arrival, extra)
    of_id = Window.partitionBy(*scope, "id").orderBy(F.col("_found").desc(), "kind")
    holder = F.first(F.when(F.col("_found"), F.struct(*carried))).over(of_id.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    looked_up = entries.withColumn("_right", F.when(F.col("kind") != SPAN, holder))
    ends = []
    if end is not None:
        waited = F.max(F.when(F.col("kind") == PARENT, end)).over(of_id.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
        looked_up = looked_up.withColumn("_wait_end", waited)
        ends = [F.when(F.col("kind") == PARENT, F.col("_wait_end")).otherwise(F.col("_held_end")).alias("last_end")]
    right = [F.col("_right")[c].alias(f"right_{c}") for c in carried]
    return looked_up.select(*spans.columns, "kind", "left_first", F.col("_right").isNotNull().alias("met"), *right, *ends)


def _as_matched(lookups: DataFrame, arrival: Sequence[str], extra: Sequence[str], *others: str) -> DataFrame:
    carried = _carried(arrival, extra)
    left = [F.col(c).alias(f"left_{c}") for c in carried]
    return lookups.select(*others, *left, *[f"right_{c}" for c in carried], (F.col("kind") == PARTNER).alias("same_id"), "left_first")


def lookup_pairs(lookups: DataFrame, scope: Sequence[str] = TRACE_SCOPE, *, arrival: Sequence[str] = ARRIVAL) -> DataFrame:
    """The complete pairs of ``trace_lookups``."""
    return assign_roles(_as_matched(lookups.filter("met"), arrival, (), *scope).filter(_complete()), scope, arrival)


def spans_and_pairs(
    lookups: DataFrame, kept: Sequence[str], is_new: Column, scope: Sequence[str] = TRACE_SCOPE, *, arrival: Sequence[str] = ARRIVAL, extra: Sequence[str] = (),
) -> DataFrame:
    """``trace_lookups`` as rows to store: what is no pair has the columns ``kept`` and those of a pair null, what is one (``is_pair``) the other way round.

    Look-ups that led to nothing are left out, except those of a parent that was not met. ``is_new`` is a condition on ``left_*`` and ``right_*``.
    """
    names = [*dict.fromkeys([*scope, *kept]), "kind", "met"]
    rows = _as_matched(lookups, arrival, extra, *names)
    is_pair, left_is_client = _roles(arrival)
    rows = rows.withColumn("is_pair", F.coalesce(F.col("met") & is_new & _complete() & is_pair, F.lit(False))).withColumn("_left_is_client", left_is_client)
    pair = [F.when(F.col("is_pair"), column).alias(name) for name, column in _pair_columns(arrival).items()]
    own = [F.when(~F.col("is_pair"), F.col(c)).alias(c) for c in kept if c not in scope]
    return rows.filter((F.col("kind") == SPAN) | F.col("is_pair") | ((F.col("kind") == PARENT) & ~F.col("met"))).select(
        *scope, *own, "kind", "met", "is_pair", *pair
    )


def stored_pairs(rows: DataFrame, scope: Sequence[str] = TRACE_SCOPE, *, arrival: Sequence[str] = ARRIVAL) -> DataFrame:
    """The pairs of ``spans_and_pairs``."""
    return rows.filter("is_pair").select(*scope, *_pair_columns(arrival))


def pairs_by_trace(spans: DataFrame, scope: Sequence[str] = TRACE_SCOPE) -> DataFrame:
    """The complete pairs of ``spans``, which are read twice: counted, then matched."""
    parts, short, long = dealt_by_trace(spans, scope)
    pairs = None if short is None else lookup_pairs(trace_lookups(short, parts, scope), scope)
    if long is None:
        return pairs
    distinct = dedupe_spans(long, scope)
    matched = match_ranked(rank_holders(distinct, leading_holders(distinct, scope), scope), scope, complete=True)
    return matched if pairs is None else pairs.unionByName(matched)


def _arrived_before(arrival: Sequence[str]) -> Column:
    """The left span arrived ahead of the right one."""
    *front, last = arrival
    before = F.col(f"left_{last}") < F.col(f"right_{last}")
    for name in reversed(front):
        left, right = F.col(f"left_{name}"), F.col(f"right_{name}")
        before = (left < right) | ((left == right) & before)
    return before


def _roles(arrival: Sequence[str]) -> tuple[Column, Column]:
    """Of a look-up: whether its two spans are a client and a server, and whether the left one is the client."""
    left, right = (lambda c: F.col(f"left_{c}")), (lambda c: F.col(f"right_{c}"))
    same_id = F.col("same_id")
    left_came_first = _arrived_before(arrival)
    left_names_right = left("parent_span_id") == right("span_id")
    right_names_left = right("parent_span_id") == left("span_id")

    # Who calls whom when a role is unknown: the parent calls the child. When each
    # names the other, the one that waited for the other counts as the parent.
    left_calls = right_names_left & ((same_id & ~left_names_right) | (~same_id & left_came_first))
    right_calls = left_names_right & ~left_calls

    def plays(side: str, role: str, by_link: Column) -> Column:
        kind = F.col(f"{side}_span_type")
        return (kind == role) | ((kind == fs.OTHER) & by_link)

    left_is_client = plays("left", fs.CLIENT, left_calls) & plays("right", fs.SERVER, left_calls)
    right_is_client = plays("right", fs.CLIENT, right_calls) & plays("left", fs.SERVER, right_calls)
    return (same_id | F.col("left_first") | left_came_first) & (right_is_client | left_is_client), left_is_client


def _pair_columns(arrival: Sequence[str]) -> dict[str, Column]:
    """A pair, by its columns' names, of a look-up with ``_left_is_client``."""
    left, right = (lambda c: F.col(f"left_{c}")), (lambda c: F.col(f"right_{c}"))

    def pick(name: str, client: bool) -> Column:
        on_left, on_right = (left(name), right(name)) if client else (right(name), left(name))
        return F.when(F.col("_left_is_client"), on_left).otherwise(on_right)

    names_other = (left("parent_span_id") == right("span_id")), (right("parent_span_id") == left("span_id"))
    return {
        **{f"client_{name}": pick(c, True) for name, c in PAIR_SIDE.items()},
        **{f"server_{name}": pick(c, False) for name, c in PAIR_SIDE.items()},
        "shared": F.col("same_id") & ~names_other[0] & ~names_other[1],
        "emit_seq": F.when(_arrived_before(arrival), right("arrival_seq")).otherwise(left("arrival_seq")),
    }


def assign_roles(matched: DataFrame, scope: Sequence[str], arrival: Sequence[str], extra: Sequence[str] = ()) -> DataFrame:
    """Lookups (``left_*``, who looked up; ``right_*``, who was found; ``same_id``, ``left_first``) to pairs of a client and a server."""
    is_pair, left_is_client = _roles(arrival)
    return matched.filter(is_pair).withColumn("_left_is_client", left_is_client).select(
        *scope,
        *[column.alias(name) for name, column in _pair_columns(arrival).items()],
        *[F.col(f"{side}_{c}") for c in extra for side in ("left", "right")],
    )


def shared_span_pairs(spans: DataFrame, scope: Sequence[str] = TRACE_SCOPE) -> DataFrame:
    """Pairs of one client and one server span holding the same span id."""
    return span_pairs(spans, scope, dual=False)


def parent_child_pairs(spans: DataFrame, scope: Sequence[str] = TRACE_SCOPE) -> DataFrame:
    """Pairs of a span and the holder of its parent id, unknown roles filled in."""
    return span_pairs(spans, scope, shared=False)


def complete_filter(pairs: DataFrame) -> DataFrame:
    """Keep pairs between two different, named services."""
    client, server = F.col("client_service"), F.col("server_service")
    return pairs.filter((client != server) & (client != "") & (server != ""))


def within_interval(pairs: DataFrame, interval_ms: int) -> DataFrame:
    """Keep pairs whose halves ended at most ``interval_ms`` apart (the accumulation wait, in batch)."""
    client_end = fs.end_time_ms(F.col("client_time_ms"), F.col("client_duration_us"))
    server_end = fs.end_time_ms(F.col("server_time_ms"), F.col("server_duration_us"))
    return pairs.filter(F.abs(client_end - server_end) <= interval_ms)


def shared_registry(pairs: DataFrame) -> DataFrame:
    """Services seen as server of a shared pair, with the moment that was first known."""
    return (
        pairs.filter("shared")
        .groupBy(F.col("server_service").alias("service_name"))
        .agg(F.min("emit_seq").alias("first_shared_seq"))
        .select("service_name", F.lit(True).alias("use_shared_span"), "first_shared_seq")
    )


def registry_of_holders(leaders: DataFrame, scope: Sequence[str] = TRACE_SCOPE) -> DataFrame:
    """The registry straight from ``leading_holders``.

    A shared pair is the two leaders of one span id, so the registry needs no join.
    """
    # In the order of ``leading_holders``, so that nothing is sorted again; an aggregate of names would sort.
    by_id = Window.partitionBy(*scope, "span_id").orderBy(*ARRIVAL, *_TIES, "span_type")
    itself = F.col("parent_span_id") == F.col("span_id")
    two = leaders.select(
        "rank", F.col("arrival_seq").alias("emit_seq"),
        F.lag("span_type").over(by_id).alias("type_1"), F.col("span_type").alias("type_2"),
        F.lag("service_name").over(by_id).alias("service_1"), F.col("service_name").alias("service_2"),
        (itself | F.lag(itself).over(by_id)).alias("names_itself"),
    ).filter(F.col("rank") == 2)
    first_serves = (F.col("type_1") == fs.SERVER) & (F.col("type_2") == fs.CLIENT)
    second_serves = (F.col("type_1") == fs.CLIENT) & (F.col("type_2") == fs.SERVER)
    pairs = complete_filter(
        two.filter(~F.col("names_itself") & (first_serves | second_serves)).select(
            F.when(first_serves, F.col("service_1")).otherwise(F.col("service_2")).alias("server_service"),
            F.when(first_serves, F.col("service_2")).otherwise(F.col("service_1")).alias("client_service"),
            F.lit(True).alias("shared"),
            "emit_seq",
        )
    )
    return shared_registry(pairs)


def merge_style_filter(pairs: DataFrame, mode: str = "as_of", registry: DataFrame | None = None) -> DataFrame:
    """Refuse a non-shared pair whose server is known to use shared span ids.

    ``as_of`` refuses from the moment the service was registered, ``final`` for
    all time. Shared pairs always pass. A few services take most calls, so the
    join key is salted: where the registry turns out too large to broadcast, a
    busy service is spread over ``_SALTS`` tasks, and later aggregations are not
    tempted to reuse a partitioning by service.
    """
    if mode not in ("as_of", "final"):
        raise ValueError(f"mode must be 'as_of' or 'final', not {mode!r}")
    known = shared_registry(pairs) if registry is None else registry
    known = known.filter("use_shared_span").select(
        F.col("service_name").alias("server_service"),
        F.col("first_shared_seq").alias("_since"),
        F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1))).alias("_salt"),
    )
    salt = F.pmod(F.xxhash64("client_span_id", "server_span_id", "emit_seq"), F.lit(_SALTS)).cast("int")
    refused = F.col("_since").isNotNull()
    if mode == "as_of":
        refused = refused & (F.col("emit_seq") >= F.col("_since"))
    joined = pairs.withColumn("_salt", salt).join(known, ["server_service", "_salt"], "left")
    return joined.filter(F.col("shared") | ~refused).select(*pairs.columns)


def accepted_pairs(
    spans: DataFrame, scope: Sequence[str] = TRACE_SCOPE, *, mode: str = "as_of", registry: DataFrame | None = None, by_trace: bool = False,
) -> DataFrame:
    """Light spans to the pairs that become edges: match, complete, merge-style check.

    ``by_trace`` counts the spans and writes the complete pairs when called, for the least shuffled (``pairs_by_trace``); without, nothing runs yet.
    """
    if by_trace:
        with small_methods(spans.sparkSession):
            pairs = written_once(pairs_by_trace(spans, scope), "pairs")
        # Written, the registry is known to be small where it is, and no pair is shuffled to meet it.
        return merge_style_filter(pairs, mode, written_once(shared_registry(pairs), "registry") if registry is None else registry)
    distinct = dedupe_spans(spans, scope)
    leaders = leading_holders(distinct, scope)
    pairs = match_ranked(rank_holders(distinct, leaders, scope), scope, complete=True)
    return merge_style_filter(pairs, mode, registry_of_holders(leaders, scope) if registry is None else registry)
