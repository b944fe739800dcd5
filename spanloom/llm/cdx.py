"""Capture indexes: sorted CDXJ lines (``url key``, 14-digit time, JSON), merged from many sorted runs to one globally ordered index.

A run is one or more files of sorted lines. Each pass merges groups of about ``FAN`` runs; a group is cut into ranges of lines, so that a task writes about ``ROWS``
lines, however long the group's runs are or often one URL was captured. A task merges its range of the group's runs through a loser tree, a line of each run at
a time. A pass leaves one run per group; the last one leaves the index, whose files are in global order. A file counts once the task that wrote it is
committed: files of lost tasks are named nowhere.
"""

from __future__ import annotations

import gzip
import json
import re
import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, functions as F

from spanloom.llm.shared import stored

FAN = 64
ROWS = 250_000
SAMPLES = 16  # lines of a file that ranges are cut by
_FILE = "run long, at int, file string, rows long, first string, last string, samples array<string>"
_FILE_ARROW = pa.schema([
    ("run", pa.int64()), ("at", pa.int32()), ("file", pa.string()), ("rows", pa.int64()), ("first", pa.string()), ("last", pa.string()), ("samples", pa.list_(pa.string())),
])


def file_system(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI, and the path in it; tasks write archives and lines through it."""
    path = re.sub("^file:/(?!/)", "file:///", path)
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


def url_key(url: Column) -> Column:
    """Sort-friendly form of a URL: host parts from the last one on, then the path and query; without scheme, ``www.``, user, port and fragment, in lower case.

    Characters that are no visible ASCII are percent-escaped, so a key holds no blank. Null and empty URLs have the key ``-``.
    """
    rest = F.regexp_replace(F.lower(F.regexp_replace(F.coalesce(url, F.lit("")), "#.*", "")), "^[a-z][a-z0-9+.-]*://", "")
    host = F.regexp_replace(F.regexp_replace(F.regexp_extract(rest, "^[^/?]*", 0), "^.*@", ""), r":\d*$|^www\.", "")
    path = F.regexp_extract(rest, "^[^/?]*(.*)", 1)
    key = F.concat(F.array_join(F.reverse(F.split(host, r"\.")), ","), F.lit(")"), F.when(path == "", "/").otherwise(path))
    escaped = F.regexp_replace(F.replace(F.replace(F.url_encode(key), F.lit("%2C"), F.lit(",")), F.lit("%29"), F.lit(")")), r"\+", "%20")
    return F.when(rest == "", "-").otherwise(F.when(key.rlike(r"^[\x21-\x7E]*\z"), key).otherwise(escaped))


def line(key: str, time: str, entry: dict) -> str:
    return f"{key} {time} {json.dumps(entry, sort_keys=True)}"


def merged(runs: list[Iterator[bytes]]) -> Iterator[bytes]:
    """The lines of sorted runs in order, by a loser tree: each inner node keeps the loser of its match, so a new head plays only on its way up."""
    heads = [next(run, None) for run in runs]
    losers = [-1] * max(1, len(runs))  # at 0 the winner of all

    def play(leaf: int) -> None:
        winner, node = leaf, (leaf + len(runs)) // 2
        while node:
            other = losers[node]
            if other < 0:
                losers[node] = winner
                return
            if heads[other] is not None and (heads[winner] is None or (heads[other], other) < (heads[winner], winner)):
                losers[node], winner = winner, other
            node //= 2
        losers[0] = winner

    for leaf in range(len(runs)):
        play(leaf)
    while runs and heads[losers[0]] is not None:
        first = losers[0]
        yield heads[first]
        heads[first] = next(runs[first], None)
        play(first)


def write_run(path: str, lines: Iterable[bytes], run: int, at: int) -> dict | None:
    """One file of sorted lines below ``path``, and its description; None if there are none."""
    system, base = file_system(path)
    name, rows, last, kept, step = f"{uuid.uuid4().hex}.cdxj.gz", 0, b"", [], 1
    with system.open_output_stream(f"{base}/{name}", compression=None) as raw, gzip.GzipFile(fileobj=raw, mode="wb", compresslevel=1) as out:
        for last in lines:
            if rows % step == 0:
                kept.append(last)
                if len(kept) > 2 * SAMPLES:
                    kept, step = kept[::2], 2 * step
            rows += 1
            out.write(last + b"\n")
    if not rows:
        system.delete_file(f"{base}/{name}")
        return None
    return {"run": run, "at": at, "file": f"{path}/{name}", "rows": rows, "first": kept[0].decode(), "last": last.decode(), "samples": [k.decode() for k in kept]}


def tasks(df: DataFrame) -> int:
    """The session's number of shuffle partitions. Given to ``repartition``, it keeps rows apart that are small but stand for much work, which Spark else joins by size."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def described(rows: list[dict]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, _FILE_ARROW)


def file_schema() -> str:
    return _FILE


def read_lines(files: list[str], low: bytes | None = None, high: bytes | None = None) -> Iterator[bytes]:
    """Lines of the files of one run from ``low`` on and before ``high``, read as a stream."""
    for file in files:
        system, base = file_system(file)
        with system.open_input_stream(base, compression=None) as raw, gzip.GzipFile(fileobj=raw) as lines:
            for text in lines:
                text = text[:-1]
                if high is not None and text >= high:
                    return
                if low is None or text >= low:
                    yield text


def _jobs(files: DataFrame, groups: int, turn: int) -> DataFrame:
    """A row per merge: group, number of the range, its bounds, and the files of each run that reach into it."""
    runs = files.groupBy("run").agg(
        F.array_sort(F.collect_list(F.struct("at", "file", "first", "last"))).alias("files"), F.sum("rows").alias("rows"), F.flatten(F.collect_list("samples")).alias("samples"),
    ).withColumn("group", F.pmod(F.xxhash64("run", F.lit(turn)), F.lit(groups)))
    found = runs.groupBy("group").agg(
        F.collect_list("files").alias("runs"), F.sum("rows").alias("rows"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("samples")))).alias("samples"),
    )
    found = found.withColumn("ranges", F.least(F.ceil(F.col("rows") / ROWS), F.size("samples")).cast("int"))
    found = found.withColumn("at", F.explode(F.sequence(F.lit(0), F.col("ranges") - 1)))
    bound = lambda i: F.get("samples", F.floor(i * F.size("samples") / F.col("ranges")).cast("int"))
    found = found.withColumn("low", F.when(F.col("at") > 0, bound(F.col("at")))).withColumn("high", F.when(F.col("at") + 1 < F.col("ranges"), bound(F.col("at") + 1)))
    reach = lambda f: (F.col("low").isNull() | (f["last"] >= F.col("low"))) & (F.col("high").isNull() | (f["first"] < F.col("high")))
    names = F.transform("runs", lambda run: F.transform(F.filter(run, reach), lambda f: f["file"]))
    return found.select("group", "at", "low", "high", F.filter(names, lambda n: F.size(n) > 0).alias("runs"))


def merge_runs(files: DataFrame, path: str) -> DataFrame:
    """The files of the one globally ordered run, ``at`` being their order, merged from the runs that ``files`` describes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for job in batch.to_pylist():
                low, high = (None if job[c] is None else job[c].encode() for c in ("low", "high"))
                made = write_run(path, merged([read_lines(names, low, high) for names in job["runs"]]), job["group"], job["at"])
                if made:
                    yield described([made])

    turn = 0
    while True:
        groups = max(1, -(-files.select("run").distinct().count() // FAN))
        jobs = _jobs(files, groups, turn).repartition(tasks(files), "group", "at")
        files = stored(jobs.mapInArrow(run, _FILE), f"merged-{turn}")
        if groups == 1:
            return files
        turn += 1
