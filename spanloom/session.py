"""Session settings and the shared scratch folder."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.maxMetadataStringLength": "1000",  # plans tell the filters of a scan in full
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the SQL settings the operators rely on; cluster sizing is left to the deployment."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


@contextmanager
def small_methods(spark: SparkSession) -> Iterator[None]:
    """For steps of many columns: no generated method is longer than what Java compiles, as longer ones are interpreted for every row."""
    name = "spark.sql.codegen.hugeMethodLimit"
    before = spark.conf.get(name)
    spark.conf.set(name, "8000")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local session without that setting gets a folder of its own; on a
    cluster a machine-local folder would be lost with its machine.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        named = tempfile.mkdtemp(prefix="spanloom-")
        spark.conf.set("spark.checkpoint.dir", named)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(named)
    return named


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def written_once(rows: DataFrame, label: str) -> DataFrame:
    """``rows``, written to the shared folder and read back, for steps that use them several times."""
    path = scratch_path(rows.sparkSession, label)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)
