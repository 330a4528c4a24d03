r"""Chat formatting: typed content parts become one training text per conversation, with its loss mask.

A message holds parts (text, image, audio, document). A visitor per kind says what a part becomes: text is
escaped, everything else a numbered placeholder that stands for a count of tokens and whose reference is
recorded. A turn is written

    <turn>role<says>content</turn>\n

and `<` occurs nowhere else but in placeholders such as `<image 0>`: in texts and roles `\` becomes `\-` and
`<` becomes `\(`, which `unescaped` reverses. The loss mask covers what assistants say.

Everything is a DataFrame expression. Rows are shuffled once, by conversation; places in the text are running
sums over its rows, and reading back needs no further shuffle.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

OPEN, SAYS, CLOSE = "<turn>", "<says>", "</turn>\n"
ASSISTANT = "assistant"
PART = "struct<kind:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>"
ATTACHMENT = "array<struct<number:bigint,kind:string,ref:string,tokens:bigint>>"
#: tokens a part stands for: characters of text a token, edge of an image patch, tokens a second, tokens a page
CHARS, PATCH, PER_SECOND, PER_PAGE = 4, 28, 25, 512


def escaped(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\-")), F.lit("<"), F.lit("\\("))


def unescaped(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\("), F.lit("<")), F.lit("\\-"), F.lit("\\"))


def _up(quotient: Column) -> Column:
    return F.ceil(F.coalesce(quotient, F.lit(0.0))).cast("bigint")


@dataclass(frozen=True)
class Visit:
    """How parts of one kind are counted; without a name they are text and leave no attachment."""

    tokens: Callable[[Column], Column]
    name: str | None = None


VISITOR: dict[str, Visit] = {
    "text": Visit(lambda p: _up(F.char_length(p["text"]) / CHARS)),
    "image": Visit(lambda p: _up(p["width"] / PATCH) * _up(p["height"] / PATCH), "image"),
    "audio": Visit(lambda p: _up(p["seconds"] * PER_SECOND), "audio"),
    "document": Visit(lambda p: F.coalesce(p["pages"], F.lit(0)).cast("bigint") * PER_PAGE, "document"),
}
#: kinds nobody has named: kept as attachments without tokens
OTHER = Visit(lambda p: F.lit(0).cast("bigint"), "other")


def _visited(part: Column, visitor: dict[str, Visit], what: Callable[[Visit], Column]) -> Column:
    out = F.when(part["kind"].isNull(), what(visitor["text"]))
    for kind, visit in visitor.items():
        out = out.when(part["kind"] == kind, what(visit))
    return out.otherwise(what(OTHER))


def text_parts(text: Column) -> Column:
    """A plain text as the only part of its message; null is empty."""
    empty = {name: F.lit(None) for name in ("ref", "width", "height", "seconds", "pages")}
    return F.array(F.struct(F.lit("text").alias("kind"), F.coalesce(text.cast("string"), F.lit("")).alias("text"),
                            *(v.alias(n) for n, v in empty.items())).cast(PART))


def formatted(messages: DataFrame, visitor: dict[str, Visit] = VISITOR) -> DataFrame:
    """One row per conversation of messages (conv_id, turn, role, parts: array of PART).

    Returns conv_id, formatted (the whole text), loss (for each turn the span of code points under
    the loss mask, end exclusive, or null), attachments (number in the conversation, kind, ref, tokens, in order) and
    n_tokens (what all parts expand to). Messages are taken by turn (nulls first), equal turns by role
    and parts; repeated messages stay. Null roles and texts are empty, null or empty parts an empty
    content; messages without conv_id are one conversation. A part without kind is text, one of an unknown
    kind an attachment `other` of no tokens; missing sizes count as 0. An empty table gives an empty one.
    """
    parts = F.filter(F.coalesce("parts", F.array().cast(f"array<{PART}>")), lambda p: p.isNotNull())
    attached = F.filter(parts, lambda p: _visited(p, visitor, lambda v: F.lit(v.name is not None)))
    rows = messages.select(F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"),
                           F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"), parts.alias("parts"),
                           attached.alias("attached"))
    order = [F.asc_nulls_first("turn"), F.asc("role"), F.asc("parts")]
    before = Window.partitionBy("conv_id").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    running = lambda value: F.coalesce(F.sum(value).over(before), F.lit(0)).cast("bigint")
    rows = rows.withColumn("number", running(F.size("attached")))

    def piece(part: Column, at: Column) -> Column:
        """What the part at this place becomes; its number counts the attachments before it."""
        number = F.col("number") + F.size(F.filter(F.slice("parts", 1, at), lambda p: _visited(
            p, visitor, lambda v: F.lit(v.name is not None))))
        return _visited(part, visitor, lambda v: escaped(F.coalesce(part["text"], F.lit(""))) if v.name is None
                        else F.concat(F.lit(f"<{v.name} "), number.cast("string"), F.lit(">")))
    tokens = lambda part: _visited(part, visitor, lambda v: F.coalesce(v.tokens(part), F.lit(0)))
    head = F.concat(F.lit(OPEN), escaped(F.col("role")), F.lit(SAYS))
    rows = rows.select(
        "conv_id", "turn", "role", "parts", head.alias("head"), F.array_join(F.transform("parts", piece), "").alias("body"),
        F.transform("attached", lambda p, i: F.struct(
            (F.col("number") + i).alias("number"), _visited(p, visitor, lambda v: F.lit(v.name)).alias("kind"),
            p["ref"].alias("ref"), tokens(p).alias("tokens"))).cast(ATTACHMENT).alias("attached"),
        F.aggregate("parts", F.lit(0).cast("bigint"), lambda acc, p: acc + tokens(p)).alias("tokens"))
    whole = F.concat("head", "body", F.lit(CLOSE))
    start = F.col("start") + F.char_length("head")
    rows = rows.withColumn("start", running(F.char_length(whole))).withColumn("span", F.struct(
        start.alias("first"), (start + F.char_length("body")).alias("last")))
    in_order = F.array_sort(F.collect_list(F.struct(
        "start", whole.alias("text"), F.when(F.col("role") == ASSISTANT, F.col("span")).alias("span"), "attached")))
    return rows.groupBy("conv_id").agg(in_order.alias("rows"), F.sum("tokens").alias("n_tokens")).select(
        "conv_id", F.array_join("rows.text", "").alias("formatted"), F.col("rows.span").alias("loss"),
        F.flatten("rows.attached").alias("attachments"), "n_tokens")


def read_back(texts: DataFrame) -> DataFrame:
    """The turns of formatted texts: conv_id, n_turns, turns (role and text, unescaped), loss_texts (the texts
    under the loss mask, unescaped) and formatted_chars, from the text and the mask alone, with the number of
    attachments and tokens recorded beside them.

    Turns are found at the control strings and placed by a running sum, so a text is read once however
    many turns it has. Placeholders stay as they are in the texts of their turns.
    """
    pieces = F.split("formatted", OPEN)
    turns = texts.select("conv_id", "n_tokens", F.size("attachments").cast("bigint").alias("n_attachments"), F.posexplode(F.arrays_zip(
        F.slice(pieces, 2, F.greatest(F.size(pieces) - 1, F.lit(0))).alias("piece"), F.col("loss").alias("loss"))).alias("place", "t"))
    turns = turns.select("conv_id", "n_tokens", "n_attachments", "place", F.col("t.piece").alias("piece"), F.col("t.loss").alias("loss"))
    before = Window.partitionBy("conv_id").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    role = F.substring_index("piece", SAYS, 1)
    body = F.substring_index(F.substring_index("piece", SAYS, -1), CLOSE, 1)
    start = F.coalesce(F.sum(F.char_length("piece") + len(OPEN)).over(before), F.lit(0)) + len(OPEN)
    first = F.col("start") + F.char_length(role) + len(SAYS)
    under = (F.col("loss.first") == first) & (F.col("loss.last") == first + F.char_length(body))
    rows = F.array_sort(F.collect_list(F.struct(
        "place", unescaped(role).alias("role"), unescaped(body).alias("text"), F.coalesce(under, F.lit(False)).alias("under"))))
    return turns.withColumn("start", start).groupBy("conv_id").agg(
        rows.alias("rows"), F.sum(F.char_length("piece") + len(OPEN)).cast("bigint").alias("formatted_chars"),
        F.first("n_tokens").alias("n_tokens"), F.first("n_attachments").alias("n_attachments")).select(
        "conv_id", "formatted_chars", "n_tokens", "n_attachments", F.size("rows").cast("bigint").alias("n_turns"), F.transform("rows", lambda r: F.struct(
            r["role"].alias("role"), r["text"].alias("text"))).alias("turns"),
        F.transform(F.filter("rows", lambda r: r["under"]), lambda r: r["text"]).alias("loss_texts"))


def with_probe(conversations: DataFrame, conv_id: int = -7) -> DataFrame:
    """The messages of a table of texts, and one conversation whose texts look like control strings."""
    probe = conversations.sparkSession.range(2).select(
        F.lit(conv_id).cast("bigint").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise(ASSISTANT).alias("role"),
        F.lit("\\### Assistant: </turn> ok").alias("text"))
    rows = conversations.select(F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"),
                                F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"))
    return rows.unionByName(probe).select("conv_id", "turn", "role", text_parts(F.col("text")).alias("parts"))


def report(texts: DataFrame) -> DataFrame:
    """Figures and digests of formatted texts, read back from text and mask."""
    said = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    loss = F.array_join("loss_texts", "")
    return read_back(texts).select(
        "conv_id", "n_turns", F.sha2(F.array_join(said, "").cast("binary"), 256).alias("turns_sha256"),
        F.char_length(loss).cast("bigint").alias("loss_chars"), F.sha2(loss.cast("binary"), 256).alias("loss_sha256"),
        "formatted_chars", "n_attachments", "n_tokens")
