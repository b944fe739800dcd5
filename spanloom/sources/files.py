"""Folder bookkeeping on any Hadoop file system: listing and removing table partitions."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    jvm = spark._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, hadoop_path = _at(spark, path)
    return fs.exists(hadoop_path)


def partition_values(spark: SparkSession, table: str, column: str) -> list[str]:
    """Values of a table's top-level partition folders, sorted. Only folder names are read."""
    fs, hadoop_path = _at(spark, table)
    if not fs.exists(hadoop_path):
        return []
    unescape = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName
    names = [status.getPath().getName() for status in fs.listStatus(hadoop_path)]
    prefix = f"{column}="
    return sorted(unescape(name[len(prefix):]) for name in names if name.startswith(prefix))


def partition_path(spark: SparkSession, table: str, column: str, value: str) -> str:
    """The folder of one partition; characters that folder names cannot have are escaped."""
    escape = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
    return f"{table}/{column}={escape(value)}"


def drop_partition(spark: SparkSession, table: str, column: str, value: str) -> bool:
    return remove(spark, partition_path(spark, table, column, value))


def remove(spark: SparkSession, path: str) -> bool:
    """Remove a folder with all it holds."""
    fs, hadoop_path = _at(spark, path)
    return fs.delete(hadoop_path, True)


def rename(spark: SparkSession, path: str, to: str) -> bool:
    """Give a folder its final name; one step on file systems whose renames are atomic."""
    fs, hadoop_path = _at(spark, path)
    target = spark._jvm.org.apache.hadoop.fs.Path(to)
    fs.mkdirs(target.getParent())
    return fs.rename(hadoop_path, target)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Replace a small file."""
    fs, hadoop_path = _at(spark, path)
    out = fs.create(hadoop_path, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small file, None if it is not there."""
    fs, hadoop_path = _at(spark, path)
    if not fs.exists(hadoop_path):
        return None
    stream = fs.open(hadoop_path)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()
