"""Pairing in batch where span ids are used again: what a stream forgets is forgotten here too.

The holders of an id are cut into generations, as a stream would hold them: a holder that starts when all earlier holders ended ``interval`` or longer ago finds none of
them and begins a new generation. A generation can be found from its first start to its latest end plus the interval; a span that looks for a parent waits
until its own end plus the interval. Within a generation the contract of ``pairs`` holds: first and second holder, who came first.

* *Sessions by gaps.* An id is cut into time buckets. Each bucket works out its own running ends; a window over one row per bucket carries them on. No task needs all holders of an id.
* *Bucketed interval join.* A look-up and a generation meet on (id, bucket) for every bucket both reach into, and match in the first one only. The spells of
  the generations of an id do not overlap, so a look-up matches one at most.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from spanloom.functions import spans as fs
from spanloom.operators import pairs as pair_ops
from spanloom.operators.carry import carried
from spanloom.operators.spans import TRACE_SCOPE, dedupe_spans
from spanloom.session import written_once

WIDTH_MS = 60_000
_GENERATION = "generation"


def _end() -> Column:
    return F.coalesce(fs.end_time_ms(F.col("time_ms"), F.col("duration_us")), F.col("time_ms"))


def with_generations(spans: DataFrame, interval_ms: int, scope: Sequence[str] = TRACE_SCOPE, width_ms: int = WIDTH_MS) -> DataFrame:
    """Light spans with ``generation``, the first start of the generation of their id."""
    key = [*scope, "span_id"]
    rows = spans.withColumns({c: F.coalesce(c, F.lit("")) for c in key})
    rows = rows.withColumn("_bucket", F.floor(F.col("time_ms") / width_ms)).withColumn("_end", _end())
    inside = Window.partitionBy(*key, "_bucket").orderBy("time_ms", "arrival_seq")
    before = inside.rowsBetween(Window.unboundedPreceding, -1)
    reached = F.greatest(F.max("_end").over(before), F.col("_carried_end"))  # of all that started earlier
    rows = carried(rows, key, F.max("_end"), "_carried_end").withColumn(
        "_begins", F.when(F.coalesce(reached <= F.col("time_ms") - interval_ms, F.lit(True)), F.col("time_ms"))
    )
    rows = carried(rows, key, F.max("_begins"), "_carried_begin")
    begun = F.max("_begins").over(inside.rowsBetween(Window.unboundedPreceding, 0))
    return rows.withColumn(_GENERATION, F.coalesce(begun, F.col("_carried_begin"))).select(*spans.columns, _GENERATION)


def _spells(distinct: DataFrame, interval_ms: int, scope: Sequence[str]) -> DataFrame:
    """A row per generation: when it can be found (``from_ms``, ``until_ms``) and when the one before it was forgotten (``free_ms``)."""
    key = [*scope, "span_id"]
    spells = distinct.groupBy(*key, _GENERATION).agg(F.min("time_ms").alias("from_ms"), (F.max(_end()) + interval_ms).alias("until_ms"))
    return spells.withColumn("free_ms", F.lag("until_ms").over(Window.partitionBy(*key).orderBy(_GENERATION)))


def _sides(names: Sequence[str], side: str) -> list[Column]:
    return [F.col(c).alias(f"{side}_{c}") for c in names]


def window_pairs(
    spans: DataFrame, interval_ms: int, scope: Sequence[str] = TRACE_SCOPE, width_ms: int = WIDTH_MS, arrival: Sequence[str] = pair_ops.ARRIVAL,
) -> DataFrame:
    """Complete pairs of light spans, each within a generation of its id.

    A span delivered again in its generation counts once. Null ids are empty ones. Times decide what is held, arrival decides who came first.

    Calling this runs ``spans`` once: they and their distinct holders are written to the shared folder, as each is used several times.
    """
    held = with_generations(written_once(spans, "spans"), interval_ms, scope, width_ms)
    own_scope = [*scope, _GENERATION]
    distinct = written_once(dedupe_spans(held, own_scope, arrival), "held")
    ranked = pair_ops.rank_holders(distinct, pair_ops.leading_holders(distinct, own_scope, arrival), own_scope)
    names = list(dict.fromkeys([*pair_ops.PAIR_SIDE.values(), "span_type", *arrival, "arrival_seq"]))
    is_first = F.col("holder_rank") == 1
    first = ranked.where(is_first)

    seconds = ranked.where("holder_rank = 2").select(*own_scope, *_sides(names, "left"), F.col("span_id").alias("right_span_id"))
    shared = seconds.join(first.select(*own_scope, *_sides(names, "right")), [*own_scope, "right_span_id"]).withColumn("same_id", F.lit(True)).withColumn("left_first", F.lit(False))

    bucket = lambda at: F.floor(at / width_ms)
    looking = ranked.where("parent_span_id <> ''").select(
        *scope, *_sides(names, "left"), is_first.alias("left_first"), F.col("parent_span_id").alias("right_span_id"),
        F.col("time_ms").alias("_at"), (F.greatest(_end(), F.col("time_ms")) + interval_ms).alias("_waits_until"),
    ).withColumn("_bucket", F.explode(F.sequence(bucket(F.col("_at")), bucket(F.col("_waits_until")))))
    key = [*scope, "span_id", _GENERATION]
    found = first.join(_spells(distinct, interval_ms, scope), key).select(
        *scope, *_sides(names, "right"), "from_ms", "until_ms", "free_ms"
    ).withColumn("_bucket", F.explode(F.sequence(bucket(F.col("from_ms")), bucket(F.col("until_ms")))))
    is_held = (F.col("from_ms") <= F.col("_at")) & (F.col("_at") < F.col("until_ms"))
    waits = (F.col("_at") < F.col("from_ms")) & (F.col("from_ms") < F.col("_waits_until")) & F.coalesce(F.col("free_ms") <= F.col("_at"), F.lit(True))
    met = looking.join(found, [*scope, "right_span_id", "_bucket"]).where(
        (is_held | waits) & (F.col("_bucket") == F.greatest(bucket(F.col("_at")), bucket(F.col("from_ms"))))
    ).withColumn("same_id", F.lit(False))

    columns = [*scope, *[f"{side}_{c}" for side in ("left", "right") for c in names], "same_id", "left_first"]
    matched = shared.select(*columns).unionByName(met.select(*columns))
    return pair_ops.complete_filter(pair_ops.assign_roles(matched, scope, arrival))
