"""Tables a stream writes batch by batch.

Each micro-batch owns the folder ``batch_id=N``. It is written under a name that readers skip and
then renamed, so a reader, batch or stream, sees all of it or nothing. A repeated batch is executed again; its rows must be those that readers
may have seen already, else it fails: the stream began anew on an old table. Batch N starts after N-1 is done, so earlier folders are always whole.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from spanloom.sources import files

BATCH = "batch_id"
_INCOMING = "_incoming"


def _fingerprint(rows: DataFrame) -> tuple:
    """Count and sum of hashes of the rows, in any order."""
    code = F.xxhash64(F.to_json(F.struct(*sorted(rows.columns)))).cast("decimal(38,0)")
    return tuple(rows.agg(F.count(F.lit(1)), F.sum(code)).first())


def write_batch(rows: DataFrame, table: str, batch_id: int) -> None:
    spark = rows.sparkSession
    incoming, path = (f"{table}/{part}{BATCH}={batch_id}" for part in (f"{_INCOMING}/", ""))
    rows.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(incoming)
    if files.exists(spark, path):
        schema = spark.read.parquet(incoming).schema
        new, seen = (_fingerprint(spark.read.schema(schema).parquet(p)) for p in (incoming, path))
        files.remove(spark, incoming)
        if new != seen:
            raise ValueError(f"{path} holds other rows than this batch: a new checkpoint needs a new table")
    elif not files.rename(spark, incoming, path):
        raise OSError(f"cannot publish {path}")


def batches(spark: SparkSession, table: str) -> list[int]:
    return sorted(int(value) for value in files.partition_values(spark, table, BATCH))


def empty(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """No rows, which the optimizer knows: a join with them shuffles nothing."""
    return spark.range(1).where(F.lit(False)).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields])


def read_batch_before(spark: SparkSession, table: str, batch_id: int, schema: T.StructType) -> DataFrame:
    """The state the latest earlier batch left, empty ahead of the first."""
    earlier = [i for i in batches(spark, table) if i < batch_id]
    if not earlier:
        return empty(spark, schema)
    return spark.read.schema(schema).parquet(f"{table}/{BATCH}={earlier[-1]}")


def drop_batches_before(spark: SparkSession, table: str, batch_id: int) -> None:
    """Forget state no retry can ask for."""
    for i in batches(spark, table):
        if i < batch_id:
            files.drop_partition(spark, table, BATCH, str(i))


def read_table(spark: SparkSession, table: str, schema: T.StructType) -> DataFrame:
    """All batches of a table."""
    if not files.exists(spark, table):
        return spark.createDataFrame([], schema)
    stamped = T.StructType([*schema.fields, T.StructField(BATCH, T.LongType())])
    return spark.read.schema(stamped).parquet(table).drop(BATCH)


def stream_table(spark: SparkSession, table: str, schema: T.StructType, max_files: int | None = None) -> DataFrame:
    """The table as a stream of the rows that get appended to it."""
    stamped = T.StructType([*schema.fields, T.StructField(BATCH, T.LongType())])
    reader = spark.readStream.schema(stamped)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(table).drop(BATCH)
