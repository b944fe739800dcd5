"""Byte-level BPE: a minimal perfect hash for whole pre-tokens of the vocabulary, a heap over linked bytes for the rest.

Texts are cut by the vocabulary's pattern. A pre-token is looked up in a minimal perfect hash of the vocabulary (two
arrays, no keys stored twice); one that is not in it starts as its bytes, linked left to right, and a heap yields the
pair of the lowest rank, leftmost first, until no pair has a rank. What a worker has encoded before it remembers, up to
``REMEMBERED`` pieces.

Defined results: null and empty texts have no ids and decode to no bytes; lone surrogates cannot occur in Spark strings;
no special tokens are read from texts; repeated rows each get their own result; other columns are ignored. The rank file must hold all 256 single bytes.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Callable, Iterator
from heapq import heapify, heappop, heappush
from itertools import chain, pairwise

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import ArrayType, IntegerType

from spanloom.llm.shared import text_batches

REMEMBERED = 350_000  # entries to a turn
PIECE_AT_MOST = 64  # longer pieces are encoded but not remembered
BATCH = 1 << 20  # characters whose ids are held at a time


class PerfectHash:
    """A minimal perfect hash: n keys to 0..n-1, by a displacement for each bucket of about two keys.

    Buckets are placed largest first. A bucket of several keys gets the first displacement that sends all of them to free
    slots; buckets of one key are told their slot outright (as -1 - slot).
    """

    def __init__(self, keys: list[bytes]) -> None:
        n = self.size = len(keys)
        self.buckets = max(1, n // 2)
        self.displacements = np.zeros(self.buckets, dtype=np.int64)
        self.order = np.zeros(n, dtype=np.int64)
        members: list[list[int]] = [[] for _ in range(self.buckets)]
        hashes = [xxhash.xxh3_128_intdigest(k) for k in keys]
        for i, h in enumerate(hashes):
            members[h % self.buckets].append(i)
        free = [True] * n
        singles = []
        for bucket in sorted(range(self.buckets), key=lambda b: -len(members[b])):
            inside = members[bucket]
            if len(inside) < 2:
                singles += [(bucket, i) for i in inside]
                continue
            tried = 0
            while True:
                tried += 1
                slots = [self._placed(hashes[i], tried) for i in inside]
                if all(free[s] for s in slots) and len(set(slots)) == len(inside):
                    break
                if tried > 1 << 24:
                    raise ValueError("keys repeat or cannot be placed")
            for slot in slots:
                free[slot] = False
            self.displacements[bucket] = tried
            self.order[slots] = inside
        for (bucket, i), slot in zip(singles, np.flatnonzero(free).tolist()):
            self.displacements[bucket] = -1 - slot
            self.order[slot] = i
        self._moves = self.displacements.tolist()

    def slot(self, key: bytes) -> int:
        """The key's own slot; for other keys, some slot."""
        h = xxhash.xxh3_128_intdigest(key)
        move = self._moves[h % self.buckets]
        if move < 0:
            return -1 - move
        return self._placed(h, move)

    def _placed(self, h: int, move: int) -> int:
        """Where a displacement sends a hash: bits of a product, so that displacements are unlike each other."""
        return ((((h >> 32) + move) * ((h >> 64) + 2 * move | 1)) >> 40) % self.size


class Vocabulary:
    """Ranks of byte strings, as ids; small enough to send to every task (one entry per token of a fixed file)."""

    def __init__(self, ranks: dict[bytes, int], pattern: str) -> None:
        keys = list(ranks)
        self.hash = PerfectHash(keys)
        order = self.hash.order.tolist()
        self.keys = [keys[i] for i in order]
        self.ids = [ranks[keys[i]] for i in order]
        self.pattern = pattern
        self.bytes_of = {i: k for k, i in ranks.items()}

    @classmethod
    def load(cls, spark: SparkSession, path: str, pattern: str) -> Vocabulary:
        """From a rank file (base64 token, rank), read as Spark reads text: the path may be local or shared.

        A path without scheme is a file of the installed tokenizers, read where the job is started.
        """
        if "://" in path:
            lines = [r[0] for r in spark.read.text(path).collect()]
        else:
            with open(path, encoding="ascii") as file:
                lines = file.read().splitlines()
        pairs = (line.split() for line in lines if line.strip())
        return cls({base64.b64decode(token): int(rank) for token, rank in pairs}, pattern)

    def id_of(self, token: bytes) -> int | None:
        slot = self.hash.slot(token)
        return self.ids[slot] if self.keys[slot] == token else None


def merges(vocabulary: Vocabulary) -> list[dict[int, int]]:
    """By the left one's id: what it and the id after it merge to, for all pairs that do. A bounded table, some entries per token."""
    ids = dict(zip(vocabulary.keys, vocabulary.ids))
    none: dict[int, int] = {}
    found = [none] * (max(vocabulary.ids) + 1)
    for token, both in ids.items():
        for cut in range(1, len(token)):
            left, right = ids.get(token[:cut]), ids.get(token[cut:])
            if left is not None and right is not None:
                if found[left] is none:
                    found[left] = {}
                found[left][right] = both
    return found


class Recent:
    """What was looked up since the last turn and in the turn before, so what is in use survives a turn."""

    def __init__(self) -> None:
        self.new: dict = {}
        self._old: dict = {}

    def turn(self) -> dict:
        """The entries to look in; a new turn begins when they are many."""
        if len(self.new) > REMEMBERED:
            self._old, self.new = self.new, {}
        return self.new

    def kept(self, key: str) -> tuple[int, ...] | None:
        return self._old.get(key)


class Encoder:
    """Encodes whole texts; one to a worker."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.vocabulary = vocabulary
        self._pattern = regex.compile(vocabulary.pattern)
        # The short cut for plain words needs a pattern that takes a blank with the letters after it.
        self._plain_words = self._pattern.findall(" ab.") == [" ab", "."]
        self._pieces, self._tokens = Recent(), Recent()
        self._merged = merges(vocabulary)
        self._byte_ids = [vocabulary.id_of(bytes([i])) for i in range(256)]
        # Between a character and a blank or line feed after it every token ends, so texts are cut there first.
        self._piece = re.compile(r"[ \n]*[^ \n]+|[ \n]+")
        self._other_space = re.compile("[^\\S \n]|[\x00\x1c-\x1f\x85\u180e\u200b\u2060\ufeff]")

    def merge(self, token: bytes) -> list[int]:
        """Ids of a pre-token that is not in the vocabulary: lowest rank first, leftmost of equals. Ids are ranks, so a merged pair's rank is its id."""
        merged, n = self._merged, len(token)
        ids = [self._byte_ids[b] for b in token]
        # The rank each place merges at with the one after it; what the heap says beyond that is out of date.
        ranks = [merged[left].get(right, -1) for left, right in pairwise(ids)]
        ranks.append(-1)
        # A rank and a place are one number, small for words: such numbers are compared fastest.
        shift = n.bit_length()
        places = (1 << shift) - 1
        heap = [rank << shift | i for i, rank in enumerate(ranks) if rank >= 0]
        if not heap:
            return ids
        heapify(heap)
        after = list(range(1, n + 1))
        before = list(range(-1, n - 1))
        while heap:
            top = heappop(heap)
            i = top & places
            both = ranks[i]  # the table's own number, so that what is remembered holds no copies of it
            if both != top >> shift:
                continue
            j = after[i]
            ids[i] = both
            ids[j] = ranks[j] = -1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                found = ranks[i] = merged[both].get(ids[k], -1)
                if found >= 0:
                    heappush(heap, found << shift | i)
            else:
                ranks[i] = -1
            h = before[i]
            if h >= 0:
                found = ranks[h] = merged[ids[h]].get(both, -1)
                if found >= 0:
                    heappush(heap, found << shift | h)
        return [i for i in ids if i >= 0]

    def _cut(self, piece: str) -> list[str]:
        """The piece's pre-tokens; plain words with a blank before and a stop or comma behind need no pattern."""
        if self._plain_words and piece.isascii():
            word = piece[1:] if piece[:1] == " " else piece
            if word.isalpha():
                return [piece]
            if word[-1:] in (".", ",") and word[:-1].isalpha():
                return [piece[:-1], word[-1]]
        return self._pattern.findall(piece)

    def _encode_piece(self, piece: str) -> tuple[int, ...]:
        known, found, matches = self._tokens.turn(), [], self._cut(piece)
        for match in matches:
            ids = known.get(match)
            if ids is None:
                ids = self._tokens.kept(match)
                if ids is None:
                    token = match.encode()
                    whole = self.vocabulary.id_of(token)
                    ids = tuple(self.merge(token)) if whole is None else (whole,)
                if len(match) <= PIECE_AT_MOST:
                    known[match] = ids
            found += ids
        return ids if len(matches) == 1 else tuple(found)

    def encode(self, text: str) -> list[int]:
        if self._other_space.search(text):
            return list(self._encode_piece(text))
        if "  " in text or "\n " in text or text[-1:] == " " or text[:1] == " ":
            pieces = self._piece.findall(text)
        else:  # every blank has a character on both sides; a blank goes with what follows, and is left out of all keys but the first
            pieces = text.split(" ")
            pieces[0] = "\0" + pieces[0]
            return self._look_up(pieces, lambda p: self._encode_piece(p[1:] if p[0] == "\0" else " " + p))
        return self._look_up(["\0" + p for p in pieces], lambda p: self._encode_piece(p[1:]))

    def _look_up(self, pieces: list[str], encode: Callable[[str], tuple[int, ...]]) -> list[int]:
        """The ids of pieces in a row; a piece that begins with a zero character stands for the rest of it."""
        known = self._pieces.turn()
        found = list(map(known.get, pieces))
        if None in found:
            strange: dict[str, tuple[int, ...]] = {}
            for i, ids in enumerate(found):
                if ids is None:
                    piece = pieces[i]
                    ids = known.get(piece) or strange.get(piece) or self._pieces.kept(piece) or encode(piece)
                    (known if len(piece) <= PIECE_AT_MOST else strange)[piece] = found[i] = ids
        return list(chain.from_iterable(found))

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.vocabulary.bytes_of.__getitem__, ids))


def with_encoder(spark: SparkSession, vocabulary: Vocabulary) -> Callable[[], Encoder]:
    """A function for tasks: the worker's own encoder. Workers are reused, and so is what they remember."""
    shared = spark.sparkContext.broadcast(vocabulary)

    def get() -> Encoder:
        held = shared.value
        if not hasattr(held, "_encoder"):
            held._encoder = Encoder(held)
        return held._encoder

    return get


def encode_documents(documents: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """``doc_id`` and ``ids`` (array of int) of every row; a text at a time, no shuffle."""
    encoder = with_encoder(documents.sparkSession, vocabulary)
    schema = documents.select("doc_id").schema.add("ids", ArrayType(IntegerType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for part in text_batches(batch.column("text").to_pylist(), BATCH):
                ids = pa.array([encoder().encode(t or "") for t in part], pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(at, len(part)), ids], ["doc_id", "ids"])
                at += len(part)

    return documents.select("doc_id", "text").mapInArrow(run, schema)


def decode_documents(encoded: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """``doc_id`` and ``text`` from ``ids``; bytes that are no UTF-8 become replacement characters."""
    encoder = with_encoder(encoded.sparkSession, vocabulary)
    schema = encoded.select("doc_id").schema.add("text", "string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [encoder().decode(i or []).decode("utf-8", "replace") for i in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, schema)


def digests(documents: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """``doc_id``, ``n_tokens``, ``ids_sha256``, ``decoded_sha256``: ids are encoded, then decoded again, in one pass."""
    encoder = with_encoder(documents.sparkSession, vocabulary)
    schema = documents.select("doc_id").schema.add("n_tokens", "long").add("ids_sha256", "string").add("decoded_sha256", "string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names: dict[int, str] = {i: str(i) for i in encoder().vocabulary.bytes_of}
        for batch in batches:
            counts, coded, decoded = [], [], []
            for text in batch.column("text").to_pylist():
                ids = encoder().encode(text or "")
                counts.append(len(ids))
                coded.append(hashlib.sha256(" ".join(map(names.__getitem__, ids)).encode()).hexdigest())
                decoded.append(hashlib.sha256(encoder().decode(ids)).hexdigest())
            columns = [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(coded, pa.string()), pa.array(decoded, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return documents.select("doc_id", "text").mapInArrow(run, schema)
