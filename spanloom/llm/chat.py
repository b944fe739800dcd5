"""Chat formatting: typed content parts become one training text, a loss mask and attachment records.

Every content part is visited by its kind: text stays text (control strings in it escaped), an
image, audio or document part becomes a placeholder. Placeholders stay in order; each leaves a
record of its reference, its place in the text and the tokens it will expand to.

Defined results: null texts, roles and references count as empty, a null list of parts as none; unknown
kinds are text; turns tie-break on role and parts; repeated rows are repeated turns; rows of a
null conversation id form one conversation; no rows give no conversations. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

START, END, BREAK = "<|im_start|>", "<|im_end|>", "<|br|>"
KINDS = ("image", "audio", "document")
PATCH, AUDIO_TOKENS_PER_SECOND, PAGE_TOKENS = 14, 25, 256

#: One content part. Width and height of images in pixels, seconds of audio, pages of documents.
PART = "struct<kind:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>"


def text_part(text: Column) -> Column:
    """A list of one text part."""
    none = F.lit(None)
    return F.array(F.struct(
        F.lit("text").alias("kind"), text.alias("text"), none.cast("string").alias("ref"), none.cast("int").alias("width"),
        none.cast("int").alias("height"), none.cast("double").alias("seconds"), none.cast("int").alias("pages"),
    ))


def escape(text: Column) -> Column:
    r"""``<|`` becomes ``<\|``, ``<\|`` becomes ``<\\|`` and so on: no control string is left, and ``unescape`` undoes it."""
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def token_count(part: Column) -> Column:
    """Tokens a placeholder expands to; 0 for text."""
    zero = F.lit(0)
    patches = F.ceil(F.coalesce(part["width"], zero) / PATCH) * F.ceil(F.coalesce(part["height"], zero) / PATCH)
    return (
        F.when(part["kind"] == "image", patches)
        .when(part["kind"] == "audio", F.ceil(F.coalesce(part["seconds"], F.lit(0.0)) * AUDIO_TOKENS_PER_SECOND))
        .when(part["kind"] == "document", F.coalesce(part["pages"], zero) * PAGE_TOKENS)
        .otherwise(0).cast("long")
    )


def _is_attachment(part: Column) -> Column:
    return F.coalesce(part["kind"], F.lit("text")).isin(*KINDS)


def _visit(part: Column) -> Column:
    """A part's place in the text. The reference is escaped too, so a placeholder ends at its own ``|>``."""
    ref = F.replace(escape(F.coalesce(part["ref"], F.lit(""))), F.lit("|>"), F.lit("|<|>"))
    shown = F.concat(F.lit("<|"), part["kind"], F.lit(":"), ref, F.lit("|>"))
    return F.when(_is_attachment(part), shown).otherwise(escape(F.coalesce(part["text"], F.lit(""))))


def format_chat(turns: DataFrame) -> DataFrame:
    """One row per conversation of ``turns`` (``conv_id``, ``turn``, ``role``, ``parts`` of type ``PART``).

    Returns ``conv_id``, ``formatted``, ``loss`` (spans (start, length) of assistant content in code points) and
    ``attachments`` (kind, ref, at, n_tokens in order of their places). A conversation is one output row, so its turns meet in one row.
    """
    role = F.coalesce("role", F.lit(""))
    head = F.concat(F.lit(START), F.replace(escape(role), F.lit("\n"), F.lit(BREAK)), F.lit("\n"))
    parts = F.coalesce(F.col("parts"), F.array().cast(f"array<{PART}>"))
    rows = turns.select("conv_id", "turn", role.alias("role"), parts.alias("parts"), head.alias("head"))
    rows = rows.withColumn("shown", F.transform("parts", _visit)).withColumn("body", F.concat_ws("", "shown"))
    rows = rows.withColumn("size", F.char_length("head") + F.char_length("body") + len(END) + 1)
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "body", F.to_json("parts"))
    rows = rows.withColumn("number", F.row_number().over(order))
    before = F.coalesce(F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rows = rows.withColumn("at", (before + F.char_length("head")).cast("long"))
    # Where each part starts: the lengths of those before it, summed within the turn.
    starts = F.transform("shown", lambda _, i: F.aggregate(F.slice("shown", 1, i), F.col("at"), lambda s, x: s + F.char_length(x)))
    files = F.filter(
        F.transform(F.arrays_zip("parts", starts.alias("start")), lambda z: F.struct(
            z["parts"]["kind"].alias("kind"), F.coalesce(z["parts"]["ref"], F.lit("")).alias("ref"),
            z["start"].alias("at"), token_count(z["parts"]).alias("n_tokens"),
        )),
        lambda a: _is_attachment(a),
    )
    none = F.array().cast("array<struct<kind:string,ref:string,at:bigint,n_tokens:bigint>>")
    has_files = F.exists("parts", _is_attachment)
    return rows.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct(
        "number", F.concat("head", "body", F.lit(END + "\n")).alias("piece"),
        F.when(F.col("role") == "assistant", F.struct(F.col("at").alias("start"), F.char_length("body").cast("long").alias("length"))).alias("span"),
        F.when(has_files, files).otherwise(none).alias("files"),
    ))).alias("turns")).select(
        "conv_id",
        F.concat_ws("", "turns.piece").alias("formatted"),
        F.filter("turns.span", lambda s: s.isNotNull()).alias("loss"),
        F.flatten("turns.files").alias("attachments"),
    )


def parse_chat(formatted: Column) -> Column:
    """The turns (role, body) of a formatted text, texts unescaped; placeholders stay as they are."""
    pieces = F.split(formatted, r"<\|im_start\|>")
    pieces = F.slice(pieces, 2, F.size(pieces))

    def turn(piece: Column) -> Column:
        role = F.substring_index(piece, "\n", 1)
        body = F.substring(piece, F.char_length(role) + 2, F.char_length(piece) - F.char_length(role) - 2 - len(END))
        return F.struct(unescape(F.replace(role, F.lit(BREAK), F.lit("\n"))).alias("role"), unescape(body).alias("body"))

    return F.transform(pieces, turn)


def masked_text(formatted: Column, loss: Column) -> Column:
    """All text under the loss mask, unescaped span by span."""
    return F.concat_ws("", F.transform(
        loss, lambda s: unescape(F.substring(formatted, (s["start"] + 1).cast("int"), s["length"].cast("int")))
    ))


def read_back(chats: DataFrame) -> DataFrame:
    """Digests of formatted conversations, read from the formatted text itself."""
    found = chats.withColumn("turns", parse_chat(F.col("formatted"))).withColumn(
        "learned", masked_text(F.col("formatted"), F.col("loss"))
    )
    flat = F.concat_ws("", F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["body"], F.lit("\n"))))
    return found.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(flat, 256).alias("turns_sha256"),
        F.char_length("learned").cast("long").alias("loss_chars"), F.sha2("learned", 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )
