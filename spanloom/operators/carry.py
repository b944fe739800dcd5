"""Running values over keys of any size, without all rows of a key in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

BUCKET = "_bucket"


def carried(rows: DataFrame, key: Sequence[str], value: Column, name: str) -> DataFrame:
    """``rows``, cut into buckets (``_bucket``) of their key, with ``name``: the greatest ``value`` of the buckets before theirs.

    ``value`` is an aggregate of one bucket. Together with a window inside each bucket this is a running maximum; the only window over a whole key has one row per bucket.
    Keys may be null.
    """
    before = Window.partitionBy(*key).orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    per_bucket = rows.groupBy(*key, BUCKET).agg(value.alias("_value"))
    reached = per_bucket.select(*[F.col(c).alias(f"_of_{c}") for c in (*key, BUCKET)], F.max("_value").over(before).alias(name))
    same = F.lit(True)
    for c in (*key, BUCKET):
        same = same & F.col(c).eqNullSafe(F.col(f"_of_{c}"))
    return rows.join(reached, same).drop(*[f"_of_{c}" for c in (*key, BUCKET)])
