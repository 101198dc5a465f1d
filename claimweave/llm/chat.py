"""Chat formatting with typed content parts.

A turn's content is a text or an array of parts ``struct<type,text,ref,tokens>``. A visitor turns every part into a piece of
the formatted text: a text part is escaped, an image, audio or document part becomes an ordered placeholder whose reference
and token count are recorded. Everything is DataFrame expressions.

A turn reads ``<turn ROLE>CONTENT</turn>`` and a line end. Every control string begins with ``<``, and inside texts ``<`` is
written ``\\l`` and ``\\`` is written ``\\b``, so no text can hold one and reading back is exact.

Defined cases: null texts, parts and roles are empty; conversations with a null id form one conversation; turns are ordered
by turn number (null first), then role and content, and repeated rows all stay; an empty table gives an empty result;
further columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from claimweave.llm.base import once

# The template's marks, and the tokens of a part that does not say how many it takes.
OPEN, CLOSE, END = "<turn ", ">", "</turn>\n"
TOKENS = {"image": 576, "audio": 750, "document": 1024}


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\b")), F.lit("<"), F.lit("\\l"))


def unescape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\l"), F.lit("<")), F.lit("\\b"), F.lit("\\"))


def _escaped_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit(">"), F.lit("\\g"))


def _role(text: Column) -> Column:
    return unescape(F.replace(text, F.lit("\\g"), F.lit(">")))


def _visit(part: Column, place: Column) -> Column:
    """A part as (piece of the output, type, ref, tokens); texts have no reference and count no tokens here."""
    kind = F.coalesce(part["type"], F.lit("text"))
    given = F.coalesce(*[F.when(kind == k, F.coalesce(part["tokens"].cast("bigint"), F.lit(n))) for k, n in TOKENS.items()])
    other = kind.isin(*TOKENS)
    return F.struct(
        F.when(other, F.concat(F.lit("<"), kind, F.lit(" "), (place + 1).cast("string"), F.lit(">")))
        .otherwise(escape(F.coalesce(part["text"], F.lit(""))))
        .alias("piece"),
        F.when(other, kind).alias("type"),
        F.when(other, part["ref"]).alias("ref"),
        F.when(other, given).alias("tokens"),
        (place + 1).alias("part"),
    )


def _pieces(turns: DataFrame, content: str) -> Column:
    if isinstance(turns.schema[content].dataType, T.ArrayType):
        parts = F.coalesce(F.col(content), F.array().cast(turns.schema[content].dataType))
        return F.transform(parts, _visit)
    text = F.struct(
        F.lit("text").alias("type"),
        F.col(content).cast("string").alias("text"),
        F.lit(None).cast("string").alias("ref"),
        F.lit(None).cast("bigint").alias("tokens"),
    )
    return F.transform(F.array(text), _visit)


def format_conversations(
    turns: DataFrame,
    conv: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    content: str = "text",
    learned: tuple[str, ...] = ("assistant",),
) -> DataFrame:
    """One row per conversation: its id, ``formatted``, ``loss_mask``, ``attachments``, ``attachment_tokens``, ``n_turns``.

    ``loss_mask`` has the (start, end) of the learned roles' contents in code points, ends exclusive; an attachment is
    (turn, part, type, ref, tokens), counted from 1. Turns are rendered where they lie; a running sum in the
    conversation's order places them, and the last step only strings them together.
    """
    rendered = turns.select(
        F.col(conv).alias("c"),
        F.col(turn).alias("t"),
        F.coalesce(F.col(role).cast("string"), F.lit("")).alias("r"),
        _pieces(turns, content).alias("pieces"),
    )
    body = F.array_join(F.transform("pieces", lambda p: p["piece"]), "")
    rendered = rendered.withColumn("body", body).withColumn("head", F.concat(F.lit(OPEN), _escaped_role(F.col("r")), F.lit(CLOSE)))
    order = Window.partitionBy("c").orderBy("t", "r", "body", "pieces")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    length = F.char_length("head") + F.char_length("body") + len(END)
    placed = rendered.withColumn("at", F.row_number().over(order)).withColumn(
        "start", F.coalesce(F.sum(length).over(before), F.lit(0)) + F.char_length("head")
    )
    lined = placed.select(
        "c",
        F.struct(
            "at",
            F.concat("head", "body", F.lit(END)).alias("line"),
            F.when(
                F.col("r").isin(*learned),
                F.struct(F.col("start"), (F.col("start") + F.char_length("body")).alias("end")),
            ).alias("mask"),
            F.transform(
                F.filter("pieces", lambda p: p["type"].isNotNull()),
                lambda p: F.struct(F.col("at").alias("turn"), p["part"].alias("part"), p["type"].alias("type"),
                                   p["ref"].alias("ref"), p["tokens"].alias("tokens")),
            ).alias("attached"),
        ).alias("x"),
    )
    gathered = lined.groupBy("c").agg(F.sort_array(F.collect_list("x")).alias("lines"))
    attached = F.flatten(F.transform("lines", lambda x: x["attached"]))
    return gathered.select(
        F.col("c").alias(conv),
        F.array_join(F.transform("lines", lambda x: x["line"]), "").alias("formatted"),
        F.array_compact(F.transform("lines", lambda x: x["mask"])).alias("loss_mask"),
        attached.alias("attachments"),
        F.aggregate(attached, F.lit(0).cast("bigint"), lambda a, x: a + x["tokens"]).alias("attachment_tokens"),
        F.size("lines").cast("bigint").alias("n_turns"),
    )


def turns_of(formatted: Column) -> Column:
    """The turns of a formatted conversation as an array of (role, text); placeholders are left out of the texts."""
    parts = F.filter(F.split(formatted, END), lambda x: x != "")
    return F.transform(
        parts,
        lambda x: F.struct(
            _role(F.substring_index(F.substring(x, len(OPEN) + 1, F.char_length(x)), CLOSE, 1)).alias("role"),
            _plain(F.substring(x, F.position(F.lit(CLOSE), x) + 1, F.char_length(x))).alias("text"),
        ),
    )


def _plain(body: Column) -> Column:
    return unescape(F.regexp_replace(body, "<[^>]*>", ""))


def masked_text(formatted: Column, mask: Column) -> Column:
    """The unescaped text under the mask, nothing between its spans.

    The text is held with four bytes per code point, so that a span is found without walking to it.
    """
    return once(
        F.encode(formatted, "UTF-32"),
        lambda wide: F.array_join(
            F.transform(
                mask,
                lambda m: _plain(
                    F.decode(
                        F.substring(wide, (4 * m["start"] + 1).cast("int"), (4 * (m["end"] - m["start"])).cast("int")),
                        "UTF-32",
                    )
                ),
            ),
            "",
        ),
    )
