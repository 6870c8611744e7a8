"""Chat formatting over typed content parts, and reading the formatted text back.

A turn's content is a list of parts (:data:`PARTS`): text, image, audio, document, or any other kind, which counts as a file.  A
visitor goes through the parts in order.  Text is escaped; every other part leaves a placeholder with its
number in the turn (nulls are not counted), its reference goes to the turn's attachments, and it counts as many tokens as it expands to (text counts
its words).  A turn is ``<s>[INST]role[/INST]content</s>``, and a conversation is its turns one after the other.

Escaping.  A text that looks like a mark, with any number of backslashes after its first character, gets one backslash more, and
reading takes one away.  No mark inside a text is ever a mark of the template, and every text comes back as it was.

Loss mask.  A span per learned turn: the number of the turn, the first code point in the conversation's text and in the
turn's segment, and the number of code points.  Only content is in a span, no marks.

Large conversations.  All work on a turn is done before its conversation is brought together.  A conversation with more than ``HOT_ROWS``
turns that are more than ``HOT_SHARE`` of the table is formatted in stretches of ``STRETCH`` turn numbers, by
many tasks, which are then put one after the other; there are at most ``1 / HOT_SHARE`` of these.  The text of one conversation
is one value, so it ends where Spark's values end (2 GB).

Edge cases.  Turns are ordered by number, then role, then content; a null number comes first, and repeated rows are turns of
their own.  Null roles and texts are empty; rows with a null id are one conversation.  A null list of parts, or an empty one, is an
empty turn; a null part is skipped.  A null kind is a file.  An empty table has no conversations.  Further columns are ignored, whatever
their names.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from footfall.runtime import stored

PARTS = "array<struct<kind:string,text:string,ref:string,units:bigint>>"
TEXT = "text"
# The placeholder of each kind, and the tokens that one unit (tile, second, page) of it expands to.
EXPANSION: dict[str, tuple[str, int]] = {"image": ("IMAGE", 256), "audio": ("AUDIO", 25), "document": ("DOCUMENT", 600)}
FILE = ("FILE", 1)
OPEN, NAMED, CLOSE = "<s>[INST]", "[/INST]", "</s>"
NEXT = "[PART]"   # between two parts of text, so that no mark comes about where they meet
NAMES = "INST|PART|IMAGE|AUDIO|DOCUMENT|FILE"
MARK = rf"(/?s>|/?(?:{NAMES})\])"
LOOKS, ESCAPED = rf"([<\[])(\\*){MARK}", rf"([<\[])\\(\\*){MARK}"
PLACEHOLDER = r"\[(IMAGE|AUDIO|DOCUMENT|FILE)\][0-9]+\[/(IMAGE|AUDIO|DOCUMENT|FILE)\]"
WORD = r"[^\x20\x09-\x0D]+"
# An attachment named in plain text, and how its kind shows.
ATTACHED = r"!\[[^\]\n]*\]\([^()\s]+\)"
AUDIO_NAMES, DOCUMENT_NAMES = r"\.(mp3|wav|ogg|flac|m4a)\)$", r"\.(pdf|docx?|odt|rtf|html?)\)$"
HOT_ROWS, HOT_SHARE, STRETCH = 10_000, 0.005, 1024


def escape(text: Column) -> Column:
    return F.regexp_replace(text, LOOKS, r"$1\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, ESCAPED, "$1$2$3")


def _part(kind: Column, text: Column, ref: Column) -> Column:
    return F.struct(kind.alias("kind"), text.alias("text"), ref.alias("ref"), F.lit(None).cast("bigint").alias("units"))


def parts_of_text(text: str) -> Column:
    """The typed parts of a plain text: ``![caption](reference)`` is an attachment, what lies between is text."""
    whole = F.coalesce(F.col(text), F.lit(""))

    def pieces(between: Column, mark: Column) -> Column:
        kind = (F.when(F.lower(mark).rlike(AUDIO_NAMES), "audio").when(F.lower(mark).rlike(DOCUMENT_NAMES), "document")
                .otherwise("image"))
        words = _part(F.lit(TEXT), between, F.lit(None).cast("string"))
        return F.when(mark.isNull(), F.array(words)).otherwise(
            F.array(words, _part(kind, mark, F.regexp_extract(mark, r"\(([^()]*)\)$", 1))))

    return F.flatten(F.zip_with(F.split(whole, ATTACHED, -1), F.regexp_extract_all(whole, F.lit(ATTACHED), F.lit(0)), pieces))


def _by_kind(part: Column, what: int, kinds: Mapping[str, tuple[str, int]]) -> Column:
    out = F.lit(FILE[what])
    for kind, entry in kinds.items():
        out = F.when(part["kind"] == kind, entry[what]).otherwise(out)
    return out


def _is_text(part: Column) -> Column:
    return part["kind"].eqNullSafe(F.lit(TEXT))


def visit(part: Column, number: Column, before: Column, kinds: Mapping[str, tuple[str, int]] = EXPANSION) -> Column:
    """What a part leaves in the text after the part ``before``: itself, escaped, or a placeholder with its number."""
    name = _by_kind(part, 0, kinds)
    words = escape(F.coalesce(part["text"], F.lit("")))
    return (F.when(_is_text(part) & _is_text(before), F.concat(F.lit(NEXT), words)).when(_is_text(part), words)
            .otherwise(F.concat(F.lit("["), name, F.lit("]"), number.cast("string"), F.lit("[/"), name, F.lit("]"))))


def expanded_tokens(part: Column, kinds: Mapping[str, tuple[str, int]] = EXPANSION) -> Column:
    units = F.coalesce(part["units"], F.lit(1).cast("bigint"))
    return (F.when(_is_text(part), F.regexp_count(F.coalesce(part["text"], F.lit("")), F.lit(WORD)))
            .otherwise(units * _by_kind(part, 1, kinds))).cast("bigint")


def _turns(rows: DataFrame, conv_id: str, turn: str, role: str, parts: str,
           kinds: Mapping[str, tuple[str, int]]) -> DataFrame:
    """Each turn by itself: its head, its content, its attachments and its tokens."""
    role = F.coalesce(F.col(role), F.lit(""))
    content = F.filter(F.coalesce(F.col(parts).cast(PARTS), F.array().cast(PARTS)), lambda p: p.isNotNull())
    found = F.transform(content, lambda p, i: F.when(~_is_text(p), F.struct(
        i.alias("part"), p["kind"].alias("kind"), p["ref"].alias("ref"), p["text"].alias("source"),
        expanded_tokens(p, kinds).alias("tokens"))))
    return rows.select(
        F.col(conv_id).alias("conv"), F.col(turn).alias("turn"), role.alias("role"),
        F.concat(F.lit(OPEN), escape(role), F.lit(NAMED)).alias("head"),
        F.array_join(F.transform(content, lambda p, i: visit(p, i, F.get(content, i - 1), kinds)), "").alias("body"),
        F.filter(found, lambda a: a.isNotNull()).alias("files"),
        F.aggregate(content, F.lit(0).cast("bigint"), lambda n, p: n + expanded_tokens(p, kinds)).alias("tokens"))


def _stretches(turns: DataFrame, keys: Sequence[str], learned: Sequence[str]) -> DataFrame:
    """The turns of each of ``keys`` as one text, with spans that count from its start; one shuffle."""
    order = Window.partitionBy(*keys).orderBy("turn", "role", "body")
    size = F.char_length("head") + F.char_length("body") + len(CLOSE)
    placed = (turns.withColumn("number", F.row_number().over(order)).withColumn("size", size.cast("bigint"))
              .withColumn("end", F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))))
    span = F.struct(F.col("number").alias("turn"), (F.col("end") - F.col("size") + F.char_length("head")).alias("start"),
                    F.char_length("head").alias("at"), F.char_length("body").alias("chars"))
    in_order = F.sort_array(F.collect_list(F.struct("number", F.concat("head", "body", F.lit(CLOSE)).alias("piece"), "files")))
    return placed.groupBy(*keys).agg(
        in_order.alias("pieces"), F.count(F.lit(1)).cast("int").alias("n_turns"), F.sum("size").alias("chars"),
        F.sort_array(F.collect_list(F.when(F.col("role").isin(*learned), span))).alias("spans"),
        F.sum("tokens").alias("n_tokens")).select(
        *keys, F.array_join(F.transform("pieces", lambda p: p["piece"]), "").alias("formatted"), "n_turns", "chars", "spans",
        F.transform("pieces", lambda p: p["files"]).alias("attachments"), "n_tokens")


def _joined(stretches: DataFrame) -> DataFrame:
    """The stretches of each conversation one after the other."""
    before = Window.partitionBy("conv").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    rows = stretches.select(
        "*", *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"{c}_before") for c in ("n_turns", "chars")])
    moved = F.transform("spans", lambda s: F.struct(
        (s["turn"] + F.col("n_turns_before")).cast("int").alias("turn"), (s["start"] + F.col("chars_before")).alias("start"),
        s["at"].alias("at"), s["chars"].alias("chars")))
    parts = F.sort_array(F.collect_list(F.struct("n_turns_before", "stretch", "formatted", moved.alias("spans"), "attachments")))
    return rows.groupBy("conv").agg(
        parts.alias("parts"), F.sum("n_turns").cast("int").alias("n_turns"), F.sum("chars").alias("chars"),
        F.sum("n_tokens").alias("n_tokens")).select(
        "conv", F.array_join(F.transform("parts", lambda p: p["formatted"]), "").alias("formatted"), "n_turns", "chars",
        F.flatten(F.transform("parts", lambda p: p["spans"])).alias("spans"),
        F.flatten(F.transform("parts", lambda p: p["attachments"])).alias("attachments"), "n_tokens")


def formatted(rows: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", parts: str = "parts",
              learned: Sequence[str] = ("assistant",), kinds: Mapping[str, tuple[str, int]] = EXPANSION,
              hot_rows: int = HOT_ROWS, hot_share: float = HOT_SHARE, stretch: int = STRETCH) -> DataFrame:
    """A row per conversation: ``formatted``, ``n_turns``, ``chars``, the loss ``spans``, ``attachments`` (a list per turn) and ``n_tokens``.

    Attachments have the number of their part, kind, reference, source text and expanded tokens.
    """
    turns = _turns(rows, conv_id, turn, role, parts, kinds)
    counts = rows.groupBy(F.col(conv_id).alias("conv")).agg(F.count(F.lit(1)).alias("n"))
    least = F.greatest(F.lit(float(hot_rows)), F.lit(hot_share) * counts.agg(F.sum("n")).scalar())
    hot = stored(counts.where(F.col("n") > least).select("conv"), "conversations")   # at most 1 / hot_share rows
    columns = ["conv", "formatted", "n_turns", "chars", "spans", "attachments", "n_tokens"]
    if hot.isEmpty():
        return _stretches(turns, ["conv"], learned).select(*columns).withColumnRenamed("conv", conv_id)
    same = turns["conv"].eqNullSafe(hot["conv"])
    rest = _stretches(turns.join(F.broadcast(hot), same, "left_anti"), ["conv"], learned)
    large = turns.join(F.broadcast(hot), same, "left_semi").withColumn("stretch", F.floor(F.col("turn") / stretch))
    return (rest.select(*columns).unionByName(_joined(_stretches(large, ["conv", "stretch"], learned)).select(*columns))
            .withColumnRenamed("conv", conv_id))


def read_back(chats: DataFrame) -> DataFrame:
    """``chats`` with what its text says: ``turns`` (role and text, attachments as they stood) and ``loss_texts``, by the spans."""
    def restored(body: Column, files: Column) -> Column:
        between = F.split(body, PLACEHOLDER, -1)
        return F.array_join(F.zip_with(between, files, lambda t, a: F.concat(
            F.array_join(F.transform(F.split(t, r"\[PART\]", -1), unescape), ""), F.coalesce(a["source"], F.lit("")))), "")

    segments = F.split("formatted", CLOSE, -1)
    cut = chats.withColumn("segments", F.slice(segments, 1, F.size(segments) - 1))

    def turn(segment: Column, files: Column) -> Column:
        named = F.instr(segment, NAMED)
        rest = F.substring(segment, named + len(NAMED), F.char_length(segment))
        return F.struct(unescape(F.substring(segment, F.lit(len(OPEN) + 1), named - len(OPEN) - 1)).alias("role"),
                        restored(rest, files).alias("text"))

    def loss(span: Column) -> Column:
        body = F.substring(F.get("segments", span["turn"] - 1), span["at"] + 1, span["chars"])
        return restored(body, F.get("attachments", span["turn"] - 1))

    return cut.withColumn("turns", F.zip_with("segments", "attachments", turn)).withColumn(
        "loss_texts", F.transform("spans", loss)).drop("segments")


def digests(chats: DataFrame, conv_id: str = "conv_id") -> DataFrame:
    """What the formatted text of each conversation gives back, as digests and sizes."""
    back = read_back(chats)
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    learned = F.array_join("loss_texts", "")
    return back.select(
        conv_id, F.size("turns").cast("long").alias("n_turns"), F.sha2(said.cast("binary"), 256).alias("turns_sha256"),
        F.char_length(learned).cast("long").alias("loss_chars"), F.sha2(learned.cast("binary"), 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
        F.aggregate("attachments", F.lit(0).cast("bigint"), lambda n, a: n + F.size(a)).alias("n_attachments"), "n_tokens")
