"""Token files: documents as ids of a tokenizer, packed by a static range asymmetric numeral system.

Documents are dealt by ranges of ``doc_id`` and written in ascending order. A file is a list of segments. A segment
holds whole documents of about ``SEGMENT`` ids together: one frequency table all its blocks share, and blocks of up to ``BLOCK`` ids, each with
the states its lanes start from (its checkpoint), its place, and a checksum, so that any block is decoded and checked by itself.
Files are rows of segments in Parquet, written by Spark's committer: a task that runs twice leaves one file.

Segment layout, little-endian: 4s magic, u32 symbols, u32 blocks, u32 documents; symbols u32[], frequencies u32[]; block index: (u32 ids,
u32 words, u32 crc32 of the ids as u32) each; then per block u32[LANES] states and u16[words].

Defined results: null and empty texts have the end id only; rows with a null doc_id come first; equal ids keep the order of their texts (nulls first); an empty
table writes no segment. A document longer than a segment is a segment of its own.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Callable, Iterator
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import ArrayType, LongType
from tokenizers import Tokenizer
from tokenizers.pre_tokenizers import ByteLevel, Sequence, WhitespaceSplit

from spanloom.llm import rans
from spanloom.llm.shared import text_batches

MAGIC = b"STK1"
LANES = 2048
BLOCK = 1 << 18
SEGMENT = 1 << 21
REMEMBERED = 300_000  # words to a turn
BATCH = 2 << 20  # characters encoded at a time
TOGETHER = 1000  # parts of words handed to the model as one text


def _listed(strings: pa.Array) -> list[str]:
    return strings.to_numpy(zero_copy_only=False).tolist()  # several times as fast as to_pylist


class Known:
    """The ids of strings learned so far, one after another in one array; a string's number tells where its ids are."""

    def __init__(self) -> None:
        self.number: dict[str, int] = {}
        self._ids, self._begins = np.zeros(1 << 16, "<u4"), np.zeros(1 << 14, np.int64)
        self._counts, self._uses = np.zeros(1 << 14, np.int64), np.zeros(1 << 14, np.int64)
        self._held = 0

    def add(self, strings: list[str], ids: np.ndarray, counts: np.ndarray) -> None:
        """New strings, with all their ids in a row and how many each has."""
        n, held = len(self.number), self._held
        while n + len(strings) > len(self._begins):
            self._begins, self._counts, self._uses = (np.concatenate([a, np.zeros_like(a)]) for a in (self._begins, self._counts, self._uses))
        while held + len(ids) > len(self._ids):
            self._ids = np.concatenate([self._ids, np.zeros_like(self._ids)])
        self._ids[held : held + len(ids)] = ids
        self._counts[n : n + len(strings)] = counts
        self._begins[n : n + len(strings)] = held + np.cumsum(counts) - counts
        self._held += len(ids)
        self.number.update(zip(strings, range(n, n + len(strings))))

    def turn(self) -> None:
        """Once they are many, only strings that came in several calls stay."""
        if len(self.number) > REMEMBERED:
            strings, uses = list(self.number), self._uses
            stay = np.flatnonzero(uses[: len(strings)] > 1)[-REMEMBERED // 2 :]
            ids, counts = self.of(stay)
            self.__init__()
            self.add([strings[i] for i in stay.tolist()], ids, counts)

    def numbers(self, strings: list[str]) -> np.ndarray:
        """The number of each of some unlike strings, all known."""
        found = np.fromiter(map(self.number.__getitem__, strings), np.int64, len(strings))
        self._uses[found] += 1
        return found

    def of(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all these strings in a row, and how many each has."""
        counts = self._counts[numbers]
        ends = np.cumsum(counts)
        total = int(ends[-1]) if len(ends) else 0
        return self._ids[np.repeat(self._begins[numbers] - ends + counts, counts) + np.arange(total)], counts


class WordEncoder:
    """Encodes texts with a tokenizer of the ``tokenizers`` library, remembering what single words become.

    The vocabulary must be of the kind that cuts at white space and drops it, so that a text's ids are those of its words in a row, and that marks a word's
    last id. The unlike words of a call are looked up once each. Words of plain Latin letters, with or without other marks around them, are handed
    to the model in lower case, many in one text; all others to the whole tokenizer.
    """

    def __init__(self, definition: str) -> None:
        self.whole = Tokenizer.from_str(definition)
        self.model = Tokenizer(Tokenizer.from_str(definition).model)
        self.model.pre_tokenizer = Sequence([WhitespaceSplit(), ByteLevel(add_prefix_space=False, use_regex=False)])
        # The names of printable ASCII bytes are those characters, so such parts need no renaming.
        self.ascii = Tokenizer(Tokenizer.from_str(definition).model)
        self.ascii.pre_tokenizer = WhitespaceSplit()
        vocabulary = self.model.get_vocab(with_added_tokens=False)
        self._last = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self._last[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self._words, self._parts = Known(), Known()
        mark = r"[!-&(-/:-@\[-`{-~]*"
        self._plain = f"^(?P<left>{mark})(?P<middle>[A-Za-zÀ-ÖØ-öø-ÿ]+)(?P<right>{mark})$"
        self._special = [t.content for t in self.whole.get_added_tokens_decoder().values()]

    def _each(self, tokenizer: Tokenizer, strings: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids and numbers of ids of strings, encoded one by one."""
        ids = [e.ids for e in tokenizer.encode_batch_fast(strings, add_special_tokens=False)]
        counts = np.fromiter(map(len, ids), np.int64, len(ids))
        return np.fromiter(chain.from_iterable(ids), "<u4", int(counts.sum())), counts

    def _learn_parts(self, model: Tokenizer, parts: list[str]) -> None:
        """Parts are runs of letters or of marks, without white space, and not empty: each ends with the only one of its ids that is a last one."""
        for at in range(0, len(parts), TOGETHER):
            some = parts[at : at + TOGETHER]
            ids = np.array(model.encode_batch_fast([" ".join(some)], add_special_tokens=False)[0].ids, dtype="<u4")
            ends = np.flatnonzero(self._last[ids]) + 1
            if len(ends) == len(some) and ends[-1] == len(ids):
                self._parts.add(some, ids, np.diff(ends, prepend=0))
            else:
                self._parts.add(some, *self._each(model, some))

    def _learn(self, words: list[str]) -> None:
        listed = pa.array(words, pa.string())
        cut = pc.extract_regex(listed, self._plain)
        odd = pc.is_null(cut)
        for special in self._special:
            odd = pc.or_(odd, pc.match_substring(listed, special))
        plain = pc.invert(odd)
        other = _listed(listed.filter(odd))
        if other:
            self._words.add(other, *self._each(self.whole, other))
        cut = cut.filter(plain)
        if len(cut):
            n = len(cut)
            three = [cut.field(0), pc.utf8_lower(cut.field(1)), cut.field(2)]
            parts = pa.concat_arrays(three).dictionary_encode()
            unlike = _listed(parts.dictionary)
            self._parts.turn()
            known = self._parts.number
            if "" not in known:
                self._parts.add([""], np.zeros(0, "<u4"), np.zeros(1, np.int64))
            new = [p for p in unlike if p not in known]
            self._learn_parts(self.ascii, [p for p in new if p.isascii()])
            self._learn_parts(self.model, [p for p in new if not p.isascii()])
            # Left, middle and right of a word after one another.
            numbers = self._parts.numbers(unlike)[parts.indices.to_numpy()].reshape(3, n).T.ravel()
            ids, counts = self._parts.of(numbers)
            self._words.add(_listed(listed.filter(plain)), ids, counts.reshape(n, 3).sum(axis=1))

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each text as little-endian u32."""
        if not texts:
            return []
        self._words.turn()
        cut = pc.split_pattern(pc.replace_substring(pc.fill_null(pa.array(texts, pa.large_string()), ""), "\n", " "), " ")
        words = cut.flatten().dictionary_encode()
        unlike = _listed(words.dictionary)
        known = self._words.number
        self._learn([w for w in unlike if w not in known])
        ids, counts = self._words.of(self._words.numbers(unlike)[words.indices.to_numpy()])
        places = np.concatenate([[0], np.cumsum(counts)])[cut.offsets.to_numpy()].tolist()
        coded = ids.tobytes()
        return [coded[4 * a : 4 * b] for a, b in zip(places, places[1:])]


def pack_segment(ids: np.ndarray, documents: int) -> bytes:
    table = rans.Table.of(ids)
    index, bodies = [], []
    for at in range(0, len(ids), BLOCK):
        part = ids[at : at + BLOCK]
        states, words = rans.encode(part, table, LANES)
        index.append(struct.pack("<III", len(part), len(words), zlib.crc32(part.astype("<u4").tobytes())))
        bodies.append(states.tobytes() + words.tobytes())
    head = struct.pack("<4sIII", MAGIC, len(table.symbols), len(index), documents)
    return b"".join([head, table.symbols.astype("<u4").tobytes(), table.frequencies.astype("<u4").tobytes(), *index, *bodies])


def unpack_segment(data: bytes, blocks: range | None = None) -> np.ndarray:
    """The ids of a segment, or of some of its blocks; raises ValueError on damage."""
    magic, symbols, count, _ = struct.unpack_from("<4sIII", data)
    if magic != MAGIC:
        raise ValueError("not a token segment")
    at = 16
    table = rans.Table(np.frombuffer(data, "<u4", symbols, at), np.frombuffer(data, "<u4", symbols, at + 4 * symbols))
    at += 8 * symbols
    index = [struct.unpack_from("<III", data, at + 12 * i) for i in range(count)]
    at += 12 * count
    found = []
    for i, (ids, words, crc) in enumerate(index):
        if blocks is None or i in blocks:
            states = np.frombuffer(data, "<u4", LANES, at)
            part = rans.decode(ids, states, np.frombuffer(data, "<u2", words, at + 4 * LANES), table)
            if zlib.crc32(part.astype("<u4").tobytes()) != crc:
                raise ValueError(f"block {i} fails its checksum")
            found.append(part)
        at += 4 * LANES + 2 * words
    return np.concatenate(found) if found else np.zeros(0, np.uint32)


def _encoder(spark: SparkSession, definition: str) -> Callable[[], WordEncoder]:
    shared = spark.sparkContext.broadcast({"definition": definition})

    def get() -> WordEncoder:
        held = shared.value
        if "encoder" not in held:
            held["encoder"] = WordEncoder(held["definition"])
        return held["encoder"]

    return get


def write_tokens(documents: DataFrame, path: str, definition: str, end_id: int) -> None:
    """Write the ids of ``documents`` (``doc_id``, ``text``) below ``path``; ``definition`` is the tokenizer's JSON.

    A row is a segment: ``part`` (number of the file, in order of ids), ``segment``, ``payload``, ``n_ids``, and the documents in it:
    ``doc_ids`` and ``counts`` (ids of each).
    """
    encoder = _encoder(documents.sparkSession, definition)
    schema = documents.select(F.lit(0).cast("long").alias("segment"), F.array("doc_id").alias("doc_ids")).schema
    schema = schema.add("counts", ArrayType(LongType())).add("n_ids", "long").add("payload", "binary")
    end = np.array([end_id], dtype="<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coded, docs, counts, number, doc_type = bytearray(), [], [], 0, None

        def segment() -> pa.RecordBatch:
            ids = np.frombuffer(bytes(coded), dtype="<u4")
            return pa.RecordBatch.from_arrays([
                pa.array([number], pa.int64()), pa.array([docs], pa.list_(doc_type)), pa.array([counts], pa.list_(pa.int64())),
                pa.array([len(ids)], pa.int64()), pa.array([pack_segment(ids, len(docs))], pa.binary()),
            ], ["segment", "doc_ids", "counts", "n_ids", "payload"])

        for batch in batches:
            doc_type = batch.column("doc_id").type
            rows = iter(batch.column("doc_id").to_pylist())
            for part in text_batches(batch.column("text").to_pylist(), BATCH):
                for doc, ids in zip(list(islice(rows, len(part))), encoder().encode(part)):
                    docs.append(doc)
                    counts.append(len(ids) // 4 + 1)
                    coded += ids
                    coded += end
                    if len(coded) >= 4 * SEGMENT:
                        yield segment()
                        coded, docs, counts, number = bytearray(), [], [], number + 1
        if docs:
            yield segment()

    ordered = documents.select("doc_id", "text").repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    ordered.mapInArrow(run, schema).select(F.spark_partition_id().alias("part"), "*").write.parquet(path)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id``, ``start``, ``n_tokens``, ``ids_crc32`` of every document, decoded from the files below ``path``.

    ``start`` counts all ids before the document. The ids before a segment come from its head: a running total over one row per file, and one over the
    segments of each file.
    """
    stored = spark.read.parquet(path)
    sizes = stored.select("part", "segment", "n_ids")
    parts = sizes.groupBy("part").agg(F.sum("n_ids").alias("n"))
    before = parts.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("base"))
    inside = Window.partitionBy("part").orderBy("segment")
    offsets = sizes.select("part", "segment", (F.sum("n_ids").over(inside) - F.col("n_ids")).alias("offset"))
    places = offsets.join(before, "part").select("part", "segment", (F.col("base") + F.col("offset")).alias("first"))
    schema = stored.select("part", "segment", F.get("doc_ids", F.lit(0)).alias("doc_id")).schema
    schema = schema.add("inner", "long").add("n_tokens", "long").add("ids_crc32", "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                counts = np.array(batch.column("counts")[i].as_py(), dtype=np.int64)
                ends = np.cumsum(counts)
                raw = memoryview(unpack_segment(batch.column("payload")[i].as_py()).astype("<u4").tobytes())
                crcs = [zlib.crc32(raw[4 * (e - c) : 4 * e]) for c, e in zip(counts.tolist(), ends.tolist())]
                same = [pa.array([batch.column(c)[i].as_py()] * len(counts), batch.column(c).type) for c in ("part", "segment")]
                docs = batch.column("doc_ids")[i].values
                yield pa.RecordBatch.from_arrays(
                    [*same, docs, pa.array(ends - counts, pa.int64()), pa.array(counts, pa.int64()), pa.array(crcs, pa.int64())],
                    ["part", "segment", "doc_id", "inner", "n_tokens", "ids_crc32"],
                )

    found = stored.select("part", "segment", "doc_ids", "counts", "payload").mapInArrow(run, schema)
    return found.join(places, ["part", "segment"]).select("doc_id", (F.col("first") + F.col("inner")).alias("start"), "n_tokens", "ids_crc32")
