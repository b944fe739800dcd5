"""Conversation structure repair: faults of turns, and the cheapest edits that make the roles of a conversation alternate.

Turns are read in order of ``turn`` (nulls first). A turn's first fault counts: blank (no visible character), duplicate (role and text seen earlier in the
conversation), truncated (the last visible character is none of ``.!?``). Blank and duplicate turns go; the edits are those of ``alignment``.

Spark sorts turns by ranges of (conversation, turn), so a conversation of any length is spread over tasks. Each task cuts its part of a conversation into blocks of
``BLOCK`` turns at most and aligns each with the grammar from every state to every state. A second pass over the blocks' costs, a stream, picks the states
between the blocks, and each block then applies the audit that was picked.

Defined results: null roles and texts are one space; equal turns order by role, by the first 64 characters of the text and by digest; a null conv_id is a conversation of its own; other
columns are ignored; no rows give no conversations. The digests of one conversation (audit, hash of the repaired text) are one value each and so made by one
task, as a stream; ``repair`` itself has no such step.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from spanloom.llm.alignment import ENDINGS, PAIRS, STATES, align, repaired
from spanloom.llm.shared import stored

BLOCK = 64
_VISIBLE = r"[^\x20\x09-\x0D]"
_COUNTS = ("turns", "blank", "duplicate", "truncated", "illegal")
_NUMBERS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def _later(known: str, turn: str) -> Column:
    """Whether the row's turn comes after another one, nulls first."""
    return F.coalesce(F.col("turn") > F.col(turn), F.col("turn").isNotNull() & ~F.col(known))


def _ordered(turns: DataFrame) -> DataFrame:
    """Turns with their faults, sorted; equal turns of one number are told apart by who comes first in the sorted rows."""
    space = F.lit(" ")
    rows = turns.select("conv_id", F.col("turn").cast("long").alias("turn"), F.coalesce("role", space).alias("role"), F.coalesce("text", space).alias("text"))
    rows = rows.withColumn("said", F.sha2(F.concat(F.char_length("role").cast("string"), space, "role", "text"), 256))
    firsts = rows.groupBy("conv_id", "said").agg(
        F.count(F.lit(1)).alias("times"), F.min(F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn").alias("first"))).alias("f"),
    ).where("times > 1").select(F.col("conv_id").alias("conv"), F.col("said").alias("said_again"), "f.known", "f.first")
    rows = rows.join(firsts, F.col("conv_id").eqNullSafe(F.col("conv")) & (F.col("said") == F.col("said_again")), "left")
    rows = rows.select(
        "conv_id", "turn", "role", "text", "said", F.coalesce(F.col("said_again").isNotNull() & _later("known", "first"), F.lit(False)).alias("again"),
        (~F.col("text").rlike(_VISIBLE)).alias("blank"),
        F.col("text").rlike(rf"[^.!?\x20\x09-\x0D][\x20\x09-\x0D]*\z").alias("cut"),
    )
    order = ["conv_id", "turn", "role", F.substring("text", 1, 64), "said"]
    return rows.repartitionByRange(*order).sortWithinPartitions(*order)


class _Block:
    """The turns of one conversation that stand together, as they come."""

    def __init__(self, conv: object) -> None:
        self.conv, self.letters, self.turns, self.numbers = conv, [], [], []
        self.blank = self.duplicate = self.truncated = self.illegal = 0

    def add(self, turn: int | None, role: str, text: str, blank: bool, again: bool, cut: bool) -> None:
        initial = role[:1]
        if self.turns and self.turns[-1][0][:1] + initial not in ("su", "ua", "au"):
            self.illegal += 1
        letter = initial if initial in ("s", "u", "a") else "o"
        if blank:
            self.blank += 1
            letter = "x"
        elif again:
            self.duplicate += 1
            letter = "x"
        elif cut:
            self.truncated += 1
            letter = letter.upper()
        self.letters.append(letter)
        self.turns.append((role, text))
        if turn is not None and turn not in self.numbers[-1:]:
            self.numbers.append(turn)

    def row(self) -> dict:
        found = align("".join(self.letters))
        return {
            "conv_id": self.conv, "turns": len(self.numbers), "first_turn": self.numbers[0] if self.numbers else None, "last_turn": self.numbers[-1] if self.numbers else None,
            "blank": self.blank, "duplicate": self.duplicate, "truncated": self.truncated, "illegal": self.illegal,
            "first_role": self.turns[0][0][:1], "last_role": self.turns[-1][0][:1],
            "costs": [found.get(p, (None,))[0] for p in PAIRS], "audits": [found.get(p, (None, None))[1] for p in PAIRS],
            "roles": [r for r, _ in self.turns], "texts": [t for _, t in self.turns],
        }


_BLOCK_FIELDS = (
    "turns long, first_turn long, last_turn long, blank long, duplicate long, truncated long, illegal long, first_role string, last_role string, "
    "costs array<long>, audits array<string>, roles array<string>, texts array<string>"
)


def _batches(rows: Iterable[dict], schema: pa.Schema, size: int) -> Iterator[pa.RecordBatch]:
    held = []
    for row in rows:
        held.append(row)
        if len(held) >= size:
            yield pa.RecordBatch.from_pylist(held, schema)
            held = []
    if held:
        yield pa.RecordBatch.from_pylist(held, schema)


def _arrow(ddl: str, conv_type: pa.DataType) -> pa.Schema:
    kinds = {"long": pa.int64(), "string": pa.string(), "array<long>": pa.list_(pa.int64()), "array<string>": pa.list_(pa.string())}
    return pa.schema([("conv_id", conv_type), *((name, kinds[kind]) for name, kind in (f.split() for f in ddl.split(", ")))])


def _records(batches: Iterator[pa.RecordBatch], seen: dict) -> Iterator[dict]:
    for batch in batches:
        seen["conv"] = batch.column("conv_id").type
        for part in (batch.slice(at, 512) for at in range(0, batch.num_rows, 512)):
            yield from part.to_pylist()


def _cut_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen: dict = {}

    def rows() -> Iterator[dict]:
        block = before = None
        for r in _records(batches, seen):
            same = block is not None and r["conv_id"] == block.conv
            if block is not None and (not same or len(block.turns) == BLOCK):
                yield block.row()
                block = None
            block = block or _Block(r["conv_id"])
            # Rows alike in all but their number of copies stand together; the first one is no duplicate unless an earlier turn said the same.
            now = (r["conv_id"], r["said"])
            block.add(r["turn"], r["role"], r["text"], r["blank"], r["again"] or now == before, r["cut"])
            before = now
        if block is not None:
            yield block.row()

    made = rows()
    for first in made:
        schema = _arrow(_BLOCK_FIELDS, seen["conv"])
        yield pa.RecordBatch.from_pylist([first], schema)
        yield from _batches(made, schema, 64)


def _blocks(turns: DataFrame) -> DataFrame:
    """Stored blocks of turns in order of ``place``, each with its audits for all pairs of states."""
    kind = turns.select("conv_id").schema.simpleString()[len("struct<conv_id:") : -1]
    cut = _ordered(turns).mapInArrow(_cut_blocks, f"conv_id {kind}, {_BLOCK_FIELDS}")
    return stored(cut.withColumn("place", F.monotonically_increasing_id()), "turn-blocks")


class _Path:
    """The cheapest way through the blocks of one conversation, block by block: per state a cost, the rank of its audit, and where it came from."""

    def __init__(self, conv: object) -> None:
        self.conv, self.places, self.came = conv, [], []
        self.ways = {"-": (0, 0)}
        self.totals = dict.fromkeys(_COUNTS, 0)
        self.first = self.last = None
        self.role = ""

    def add(self, block: dict) -> None:
        for name in _COUNTS:
            self.totals[name] += block[name]
        if self.places and self.role + block["first_role"] not in ("su", "ua", "au"):
            self.totals["illegal"] += 1
        if block["first_turn"] is not None:
            self.totals["turns"] -= self.last == block["first_turn"]
            self.first = block["first_turn"] if self.first is None else self.first
            self.last = block["last_turn"]
        self.role = block["last_role"]
        best: dict = {}
        for pair, cost, audit in zip(PAIRS, block["costs"], block["audits"]):
            if cost is not None and pair[0] in self.ways:
                before, rank = self.ways[pair[0]]
                way = (before + cost, rank, audit, pair[0])
                if pair[1] not in best or way < best[pair[1]]:
                    best[pair[1]] = way
        ranks = {q: i for i, q in enumerate(sorted(best, key=lambda q: best[q][1:3]))}
        self.ways = {q: (way[0], ranks[q]) for q, way in best.items()}
        self.came.append("".join(best[q][3] if q in best else " " for q in STATES))
        self.places.append(block["place"])

    def rows(self) -> Iterator[dict]:
        """A row per block: the states it is entered and left in; the first one carries the conversation's numbers."""
        cost, _, end = min((c + ENDINGS[q][0], rank, q) for q, (c, rank) in self.ways.items())
        span = 0 if self.first is None else self.last - self.first + 1
        numbers = {"gaps": span - self.totals["turns"], "cost": cost, **{n: self.totals[n] for n in _NUMBERS if n in self.totals}}
        states = [end]
        for came in reversed(self.came):
            states.append(came[STATES.index(states[-1])])
        states.reverse()
        for i, place in enumerate(self.places):
            shown = numbers if i == 0 else dict.fromkeys(_NUMBERS)
            yield {"conv_id": self.conv, "at_place": place, "entered": states[i], "left_in": states[i + 1], "ends": int(i + 1 == len(self.places)), **shown}


_PATH_FIELDS = "at_place long, entered string, left_in string, ends long, " + ", ".join(f"{n} long" for n in _NUMBERS)


def _paths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen: dict = {}

    def rows() -> Iterator[dict]:
        path = None
        for block in _records(batches, seen):
            if path is not None and block["conv_id"] != path.conv:
                yield from path.rows()
                path = None
            path = path or _Path(block["conv_id"])
            path.add(block)
        if path is not None:
            yield from path.rows()

    made = rows()
    for first in made:
        schema = _arrow(_PATH_FIELDS, seen["conv"])
        yield pa.RecordBatch.from_pylist([first], schema)
        yield from _batches(made, schema, 1024)


def _aligned(turns: DataFrame) -> DataFrame:
    """Blocks with the audit that was picked for each, endings included."""
    blocks = _blocks(turns)
    kind = blocks.select("conv_id").schema.simpleString()[len("struct<conv_id:") : -1]
    narrow = blocks.select("conv_id", "place", "first_turn", "last_turn", *_COUNTS, "first_role", "last_role", "costs", "audits")
    sums = [n for n in _NUMBERS if n in _COUNTS]
    paths = narrow.repartition("conv_id").sortWithinPartitions("conv_id", "place").mapInArrow(_paths, f"conv_id {kind}, {_PATH_FIELDS}")
    found = blocks.drop(*sums, "turns").join(paths.drop("conv_id"), F.col("place") == F.col("at_place"))
    audit = F.element_at("audits", F.array_position(F.array(*map(F.lit, PAIRS)), F.concat("entered", "left_in")).cast("int"))
    ending = F.coalesce(*(F.when((F.col("ends") == 1) & (F.col("left_in") == q), F.lit(tail)) for q, (_, tail) in ENDINGS.items()), F.lit(""))
    return found.select("conv_id", "place", "entered", F.concat(audit, ending).alias("audit"), "roles", "texts", *_NUMBERS)


def repair(turns: DataFrame) -> DataFrame:
    """Every edit in order: ``conv_id``, ``place`` (of the block), ``step`` (in the block), ``edit`` (K, R, D, I), ``role``, ``text``.

    Rows whose edit is not D, in order of place and step, are the repaired conversation.
    """
    aligned = _aligned(turns)
    edits = F.udf(lambda roles, texts, audit, state: repaired(list(zip(roles, texts)), audit, state), "array<struct<edit:string,role:string,text:string>>", useArrow=True)
    found = aligned.select("conv_id", "place", F.posexplode(edits("roles", "texts", "audit", "entered")).alias("step", "e"))
    return found.select("conv_id", "place", "step", "e.*")


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen: dict = {}

    def rows() -> Iterator[dict]:
        held = None
        for block in _records(batches, seen):
            if held is None or block["conv_id"] != held["conv_id"]:
                if held is not None:
                    yield held | {"audit": "".join(audits), "repaired_sha256": digest.hexdigest()}
                held, audits, digest, begun = {n: block[n] for n in ("conv_id", *_NUMBERS)}, [], hashlib.sha256(), False
            audits.append(block["audit"])
            for edit, role, text in repaired(list(zip(block["roles"], block["texts"])), block["audit"], block["entered"]):
                if edit != "D":
                    digest.update(f"{chr(10) if begun else ''}{role}:{text}".encode())
                    begun = True
        if held is not None:
            yield held | {"audit": "".join(audits), "repaired_sha256": digest.hexdigest()}

    made = rows()
    for first in made:
        schema = _arrow(_DIGEST_FIELDS, seen["conv"])
        yield pa.RecordBatch.from_pylist([first], schema)
        yield from _batches(made, schema, 1024)


_DIGEST_FIELDS = ", ".join(f"{n} long" for n in _NUMBERS) + ", audit string, repaired_sha256 string"


def report(turns: DataFrame) -> DataFrame:
    """Per conversation: ``gaps`` (turn numbers between the least and the greatest that are missing), counts of faults and of illegal neighbours,
    ``cost``, ``audit`` and ``repaired_sha256`` (of ``role:text`` of the repaired turns, joined by newlines)."""
    aligned = _aligned(turns)
    kind = aligned.select("conv_id").schema.simpleString()[len("struct<conv_id:") : -1]
    ordered = aligned.repartition("conv_id").sortWithinPartitions("conv_id", "place")
    return ordered.mapInArrow(_digests, f"conv_id {kind}, {_DIGEST_FIELDS}")


def damage(turns: DataFrame) -> DataFrame:
    """Turns with known faults: ``crc32('conv_id:turn') % 20`` of 0 drops a row, 1 empties its text, 2 takes ``.!?`` out, 3 repeats it, 4 makes its role user."""
    space = F.lit(" ")
    shown = [F.coalesce(F.col(c).cast("string"), space) for c in ("conv_id", "turn")]
    text, role = F.coalesce("text", space), F.coalesce("role", space)
    hit = F.pmod(F.crc32(F.concat(shown[0], F.lit(":"), shown[1])), F.lit(20))
    rows = turns.withColumn("_hit", hit).where("_hit <> 0")
    rows = rows.select(
        "conv_id", "turn", F.when(F.col("_hit") == 4, "user").otherwise(role).alias("role"),
        F.when(F.col("_hit") == 1, "").when(F.col("_hit") == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.when(F.col("_hit") == 3, F.sequence(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))).alias("copies"),
    )
    return rows.withColumn("copy", F.explode("copies")).select("conv_id", "turn", "role", "text")
