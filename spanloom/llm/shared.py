"""What several operators of this subpackage need: tables, cut lineage, blocks of pairs, components, byte hashes."""

from __future__ import annotations

import gc
from collections.abc import Iterator, Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from spanloom.session import scratch_path

U64 = np.uint64


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the input folder."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """The rows of ``df``, written once to the shared folder and read back.

    Later steps survive lost executors without doing the work again, and the
    shuffle files of the steps before can go.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    back = spark.read.schema(df.schema).parquet(path)
    gc.collect()
    spark.sparkContext._jvm.System.gc()  # lets Spark's cleaner drop shuffle files nobody refers to any more
    return back


def ascii_lower(text: Column) -> Column:
    """``text`` with A-Z in lower case and every other character as it is."""
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(
        F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    )


def block_pairs(df: DataFrame, group: Sequence[str], row_id: str, block: int) -> DataFrame:
    """Rows of every group of two or more, dealt to pairs of blocks.

    A group of n rows is cut into ceil(n / block) blocks by a hash of ``row_id``. Each row
    goes to all pairs (``block_a`` <= ``block_b``) its own block (``own_block``) is part of,
    so every two rows of a group meet in exactly one pair of blocks (in the pair of a block
    with itself if they share one), and no task needs more than two blocks at a time.
    """
    sizes = df.groupBy(*group).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    cut = df.join(sizes, list(group)).withColumn("_blocks", F.ceil(F.col("_n") / block).cast("int"))
    cut = cut.withColumn("own_block", F.pmod(F.xxhash64(row_id, F.lit("block")), F.col("_blocks")).cast("int"))
    others = F.sequence(F.lit(0), F.col("_blocks") - 1)
    cut = cut.withColumn("_other", F.explode(others))
    return cut.select(
        *df.columns, "own_block",
        F.least("own_block", "_other").alias("block_a"), F.greatest("own_block", "_other").alias("block_b"),
    )


def components(edges: DataFrame, label: str) -> DataFrame:
    """(``id``, ``component``): the smallest id reachable, for every id of ``edges`` (columns ``a``, ``b``).

    Alternates large-star and small-star steps until the edges stay the same. Each step is a
    minimum per node, combined before the shuffle, and a join that adaptive execution may
    split, so a node with very many links is never held by one task. Self links and repeated
    links change nothing; no edges give no rows.
    """
    # Fixed bound far above the logarithmic number of rounds; reaching it is an error, not a result.
    rounds = 100
    edges = stored(edges.select("a", "b").where("a <> b").distinct(), label)
    seen = None
    for _ in range(rounds):
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        down = large.where("a <> b").distinct().select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        low = down.groupBy("a").agg(F.min("b").alias("m"))
        small = down.join(low, "a").select(F.explode(F.array(
            F.struct(F.col("b").alias("a"), F.col("m").alias("b")), F.struct(F.col("a"), F.col("m").alias("b"))
        )).alias("e")).select("e.*").where("a <> b").distinct()
        edges = stored(small, label)
        state = edges.agg(
            F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.xxhash64("b", "a").cast("decimal(38,0)"))
        ).first()
        if state == seen:
            break
        seen = state
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    nodes = edges.select(F.col("a").alias("id"), F.col("b").alias("component"))
    return nodes.union(edges.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct())


def text_batches(texts: list[str | None], size: int) -> Iterator[list[str | None]]:
    """Consecutive texts of about ``size`` characters together; a longer one stands alone."""
    part, held = [], 0
    for text in texts:
        if part and held + len(text or "") > size:
            yield part
            part, held = [], 0
        part.append(text)
        held += len(text or "")
    if part:
        yield part


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit (the SplitMix64 finaliser)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


_BYTE_CODE = mix(np.arange(1, 257, dtype=U64) * U64(0x9E3779B97F4A7C15))


class ByteHashes:
    """Hashes of any slices of one byte array, each from two looked-up sums.

    A slice's hash is a polynomial in an odd base modulo 2**64 over random codes of its bytes.
    """

    _base = 0xD6E8FEB86659FD93
    _powers = np.ones(1, dtype=U64)
    _inverses = np.ones(1, dtype=U64)

    def __init__(self, data: np.ndarray) -> None:
        n = len(data) + 1
        cls = ByteHashes
        if len(cls._powers) < n:
            with np.errstate(over="ignore"):
                grown = np.full(max(n, 1 << 16), U64(cls._base), dtype=U64)
                grown[0] = 1
                cls._powers = np.multiply.accumulate(grown)
                grown[1:] = U64(pow(cls._base, -1, 1 << 64))
                cls._inverses = np.multiply.accumulate(grown)
        with np.errstate(over="ignore"):
            self._sums = np.zeros(n, dtype=U64)
            np.cumsum(_BYTE_CODE[data] * cls._powers[: n - 1], out=self._sums[1:])

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The mixed hash of each data[start:end]."""
        with np.errstate(over="ignore"):
            return mix((self._sums[ends] - self._sums[starts]) * ByteHashes._inverses[starts])

    def grams(self, n: int) -> np.ndarray:
        """The mixed hash of every n bytes in a row."""
        k = max(0, len(self._sums) - n)
        with np.errstate(over="ignore"):
            return mix((self._sums[n : n + k] - self._sums[:k]) * ByteHashes._inverses[:k])
