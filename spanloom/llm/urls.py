"""URL filters: longest matching rule by host and path, and a list of single URLs.

Listed keys go into a blocked Bloom filter whose size is a parameter. Only keys it lets pass reach
the exact hash join, which removes its false positives, so the filter saves work and never decides.

Defined results: a null url or one without ``://`` has an empty host and path and fits no rule; repeated rows each get
their own result; an empty rule list leaves everything to the default; a rule listed with both
verdicts blocks; of rules of one length the longer host wins. Other columns are kept out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

BLOCK_WORDS = 4  # of 64 bits: one block is 32 bytes
FILTER_BLOCKS = 1 << 15  # at most 1 MB, whatever the length of the list


def host_of(url: Column) -> Column:
    """From the first ``://`` up to ``/ ? #`` or the end, A-Z lower-cased."""
    at = F.coalesce(F.locate("://", url), F.lit(0))
    rest = F.substring(url, at + 3, F.char_length(url))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    return F.when(at > 0, F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")).otherwise("")


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    at = F.coalesce(F.locate("://", url), F.lit(0))
    rest = F.substring(url, at + 3, F.char_length(url))
    return F.when(at > 0, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)).otherwise("")


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key, F.lit("block")), F.lit(blocks)).cast("int")


def _words(key: Column) -> list[Column]:
    """The masks of a key: one bit in each word of its block, told by six bits of a hash each."""
    spread = F.xxhash64(key, F.lit("bits"))
    one = F.expr("1L")
    return [F.call_function("shiftleft", one, F.shiftrightunsigned(spread, 6 * i).bitwiseAND(F.expr("63L")).cast("int")) for i in range(BLOCK_WORDS)]


def filled_blocks(keys: DataFrame, key: str = "key", blocks: int = FILTER_BLOCKS) -> DataFrame:
    """A row for each filled block of a filter over ``blocks`` blocks: ``block`` and its words ``w0`` to ``w3``."""
    masks = keys.select(_block(F.col(key), blocks).alias("block"), *(m.alias(f"w{i}") for i, m in enumerate(_words(F.col(key)))))
    return masks.groupBy("block").agg(*(F.bit_or(f"w{i}").alias(f"w{i}") for i in range(BLOCK_WORDS)))


def let_through(rows: DataFrame, key: str, filled: DataFrame, blocks: int = FILTER_BLOCKS) -> DataFrame:
    """The ``rows`` whose ``key`` may be in the filter, told by the row of its block; at most ``blocks`` rows are sent to every task, none gathered in one."""
    words = filled.select(F.col("block").alias("_block"), *(F.col(f"w{i}").alias(f"_w{i}") for i in range(BLOCK_WORDS)))
    met = rows.withColumn("_block", _block(F.col(key), blocks)).join(F.broadcast(words), "_block")
    for i, mask in enumerate(_words(F.col(key))):
        met = met.where(F.col(f"_w{i}").bitwiseAND(mask) == mask)
    return met.select(*rows.columns)


def blocked_bloom(keys: DataFrame, key: str = "key", blocks: int = FILTER_BLOCKS) -> DataFrame:
    """One row (``filter``): the words of every block, at its own place, so that a look-up is one array access."""
    none = keys.sparkSession.range(blocks).select(F.col("id").cast("int").alias("block"), *(F.lit(0).cast("long").alias(f"w{i}") for i in range(BLOCK_WORDS)))
    every = filled_blocks(keys, key, blocks).union(none).groupBy("block").agg(*(F.bit_or(f"w{i}").alias(f"w{i}") for i in range(BLOCK_WORDS)))
    listed = every.select(F.struct("block", F.array(*(f"w{i}" for i in range(BLOCK_WORDS))).alias("words")).alias("b"))
    return listed.agg(F.array_sort(F.collect_list("b")).alias("l")).select(F.col("l.words").alias("filter"))


def may_hold(filter_: Column, key: Column, blocks: int = FILTER_BLOCKS) -> Column:
    """False only for keys that are surely not in the filter."""
    words = F.get(filter_, _block(key, blocks))
    hit = F.lit(True)
    for i, mask in enumerate(_words(key)):
        hit = hit & (F.get(words, F.lit(i)).bitwiseAND(mask) == mask)
    return hit


def judge_urls(pages: DataFrame, rules: DataFrame, default: str = "allow", blocks: int = FILTER_BLOCKS) -> DataFrame:
    """``page_id``, ``host``, ``path``, ``rule``, ``verdict`` for each row of ``pages`` (``page_id``, ``url``).

    ``rules`` has ``host``, ``path`` and ``verdict``. A rule fits its host and all subdomains, if the page's path starts with the rule's; the longest
    wins. The keys a page may fit are its host's label suffixes with its path's prefixes of the lengths that rules have.
    """
    listed = rules.groupBy(F.concat("host", "path").alias("key"), "host", "path").agg(F.max("verdict").alias("verdict"))
    listed = listed.withColumn("key", F.concat_ws("\n", "host", "path"))
    words = blocked_bloom(listed.select("key"), blocks=blocks).scalar()
    # Lengths of paths: as many values as the longest rule has characters, at most.
    lengths = F.array(*(F.lit(r[0]) for r in listed.select(F.char_length("path")).distinct().orderBy(F.desc(F.char_length("path"))).collect()))
    url = F.col("url")
    seen = pages.select(
        F.monotonically_increasing_id().alias("row"), "page_id", host_of(url).alias("host"), path_of(url).alias("path")
    )
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    fitting = F.filter(lengths.cast("array<int>"), lambda n: n <= F.char_length("path"))
    keys = F.flatten(F.transform(suffixes, lambda h: F.transform(fitting, lambda n: F.concat_ws("\n", h, F.substring(F.col("path"), F.lit(1), n)))))
    keys = F.when(F.col("host") == "", F.array().cast("array<string>")).otherwise(keys)
    tried = seen.select("*", F.posexplode_outer(keys).alias("place", "key")).withColumn("passed", F.coalesce(may_hold(words, F.col("key"), blocks), F.lit(False)))
    # One row of each page stays whatever passed; keys that did not pass become values that no rule has, each its own.
    tried = tried.where(F.col("passed") | (F.coalesce("place", F.lit(0)) == 0))
    tried = tried.withColumn("key", F.when(F.col("passed"), F.col("key")).otherwise(F.concat(F.lit("\n\n"), F.col("row").cast("string"))))
    exact = tried.join(listed.select("key", F.concat("host", "path").alias("rule"), F.char_length("host").alias("host_length"), F.col("verdict").alias("ruled")), "key", "left")
    best = F.max_by(F.struct("rule", "ruled"), F.struct(F.char_length("rule"), "host_length"))
    won = exact.groupBy("row", "page_id", "host", "path").agg(best.alias("best"))
    return won.select("page_id", "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.ruled", F.lit(default)).alias("verdict"))
