"""Chat formatting of messages made of typed content parts.

A visitor with one rule per kind of part (text, image, audio, document) flattens
a message: text is escaped, every other part becomes its placeholder and leaves
a reference (kind, uri, place among the conversation's attachments) and the
number of tokens it expands to. Turns are joined in a template:

    <|turn|>role, line end, content, <|end|>, line end

Escaping: where a text has the first character of a control string, then any
number of backslashes, then the rest of the string, it gets one backslash more;
reading back takes one away. No other character changes, so every text returns
exactly. Neighbouring text parts are escaped as the one text that they make, so a
formatted text has no control string but the template's, and reading back tells a
placeholder from a text that spells one.

The loss mask covers the contents of assistant turns. Null texts, roles and part
lists are empty; a part of unknown kind counts as text. Turns that share a number
stand by role, then content; null turns come last. A conversation is one row.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TURN, END = "<|turn|>", "<|end|>\n"
PLACEHOLDERS = {"image": "<|image|>", "audio": "<|audio|>", "document": "<|document|>"}
#: Tokens for each patch of an image, second of audio, and page of a document.
EXPANSION = {"image": 1, "audio": 25, "document": 256}
#: What follows the first character of a control string; those of two other common templates are kept out as well.
TAILS = r"(?=\|(?:turn|end|image|audio|document)\|>|/?s>|/?INST\])"
PART = "struct<kind:string,text:string,uri:string,units:bigint>"
LOSS_ROLE = "assistant"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"([<\[])(\\*)" + TAILS, r"$1\\$2")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"([<\[])\\(\\*)" + TAILS, "$1$2")


def escape_role(role: Column) -> Column:
    """On one line."""
    return F.replace(F.replace(escape(role), F.lit("\\"), F.lit("\\b")), F.lit("\n"), F.lit("\\n"))


def unescape_role(role: Column) -> Column:
    return unescape(F.replace(F.replace(role, F.lit("\\n"), F.lit("\n")), F.lit("\\b"), F.lit("\\")))


def text_part(text: Column) -> Column:
    none = F.lit(None)
    return F.struct(
        F.lit("text").alias("kind"), text.alias("text"), none.cast("string").alias("uri"), none.cast("long").alias("units")
    )


def visit(part: Column) -> Column:
    """One part as struct(text, placeholder, kind, uri, tokens); the last but one and two are null for text."""
    text = F.coalesce(part["text"], F.lit(""))
    kind, mark = (F.lit(None).cast("string") for _ in range(2))
    tokens = F.regexp_count(text, F.lit(r"\S+")).cast("long")
    for name, placeholder in PLACEHOLDERS.items():
        here = part["kind"] == name
        mark = F.when(here, F.lit(placeholder)).otherwise(mark)
        kind = F.when(here, F.lit(name)).otherwise(kind)
        tokens = F.when(here, F.coalesce(part["units"], F.lit(0)) * EXPANSION[name]).otherwise(tokens)
    text = F.when(mark.isNull(), text)
    return F.struct(
        text.alias("text"), mark.alias("placeholder"), kind.alias("kind"), part["uri"].alias("uri"), tokens.alias("tokens")
    )


def flattened(visited: Column) -> Column:
    """The content of a message: each run of texts escaped as one, placeholders between them."""

    def piece(text: Column, placeholder: Column) -> Column:
        return F.array(F.struct(text.alias("text"), placeholder.alias("placeholder")))

    def joined(pieces: Column, part: Column) -> Column:
        last = F.try_element_at(pieces, F.lit(-1))
        longer = piece(F.concat(last["text"], part["text"]), F.lit(None).cast("string"))
        return F.when(
            last["text"].isNotNull() & part["text"].isNotNull(), F.concat(F.slice(pieces, F.lit(1), F.size(pieces) - 1), longer)
        ).otherwise(F.concat(pieces, piece(part["text"], part["placeholder"])))

    pieces = F.aggregate(visited, F.array().cast("array<struct<text:string,placeholder:string>>"), joined)
    return F.array_join(F.transform(pieces, lambda x: F.coalesce(x["placeholder"], escape(x["text"]))), "")


def format_conversations(messages: DataFrame) -> DataFrame:
    """Messages (conv_id, turn, role, parts: array of PART) to one row per conversation.

    conv_id, formatted, loss_spans (code points, end exclusive), attachments
    (kind, uri, tokens, in the order of their placeholders), n_turns, n_tokens."""
    visited = F.transform(F.coalesce("parts", F.array().cast(f"array<{PART}>")), visit)
    role = F.coalesce("role", F.lit(""))
    flat = messages.select("conv_id", "turn", role.alias("role"), visited.alias("visited")).select(
        "conv_id",
        "turn",
        "role",
        flattened(F.col("visited")).alias("content"),
        F.transform(
            F.filter("visited", lambda x: x["kind"].isNotNull()),
            lambda x: F.struct(x["kind"].alias("kind"), x["uri"].alias("uri"), x["tokens"].alias("tokens")),
        ).alias("attached"),
        F.aggregate("visited", F.lit(0).cast("long"), lambda n, x: n + x["tokens"]).alias("tokens"),
    )
    head = F.concat(F.lit(TURN), escape_role(F.col("role")), F.lit("\n"))
    turns = flat.withColumn("head", F.length(head)).withColumn("piece", F.concat(head, "content", F.lit(END)))
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_last(), "role", "content")
    placed = turns.withColumn("place", F.row_number().over(order)).withColumn(
        "start", F.sum(F.length("piece")).over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.length("piece") + F.col("head")
    )
    span = F.struct(F.col("start"), (F.col("start") + F.length("content")).alias("end"))
    loss = F.when(F.col("role") == LOSS_ROLE, span)
    listed = F.array_sort(F.collect_list(F.struct("place", "piece", loss.alias("loss"), "attached")))
    return placed.groupBy("conv_id").agg(listed.alias("turns"), F.sum("tokens").alias("n_tokens")).select(
        "conv_id",
        F.array_join(F.transform("turns", lambda x: x["piece"]), "").alias("formatted"),
        F.filter(F.transform("turns", lambda x: x["loss"]), lambda x: x.isNotNull()).alias("loss_spans"),
        F.flatten(F.transform("turns", lambda x: x["attached"])).alias("attachments"),
        F.size("turns").cast("long").alias("n_turns"),
        "n_tokens",
    )


def turns_of(formatted: Column, read: Callable[[Column], Column] = unescape) -> Column:
    """The turns read back: array of struct(role, text). ``read``: how a content is, with placeholders in the text as they
    stand, or as `parts_of`."""

    def turn(piece: Column) -> Column:
        role = F.substring_index(piece, "\n", 1)
        skip = F.length(role) + 1
        text = F.substring(piece, skip + 1, F.length(piece) - skip - len(END))
        return F.struct(unescape_role(role).alias("role"), read(text).alias("text"))

    pieces = F.split(formatted, TURN.replace("|", r"\|"))
    return F.transform(F.slice(pieces, F.lit(2), F.size(pieces)), turn)


def parts_of(content: Column) -> Column:
    """A content read back as array of struct(kind, text): texts, neighbours as one and empty ones left out, and the other
    parts in their places."""
    mark = r"<\|(" + "|".join(PLACEHOLDERS) + r")\|>"
    kinds = F.regexp_extract_all(content, F.lit(mark))

    def around(text: Column, place: Column) -> Column:
        none = F.lit(None).cast("string")
        return F.array(
            F.struct(F.try_element_at(kinds, F.when(place > 0, place)).alias("kind"), none.alias("text")),
            F.struct(F.when(F.length(text) > 0, F.lit("text")).alias("kind"), unescape(text).alias("text")),
        )

    return F.filter(F.flatten(F.transform(F.split(content, mark), around)), lambda x: x["kind"].isNotNull())


def loss_texts(formatted: Column, spans: Column) -> Column:
    """The texts under the loss mask, unescaped."""

    def read(span: Column) -> Column:
        start, length = (span["start"] + 1).cast("int"), (span["end"] - span["start"]).cast("int")
        return unescape(F.substring(formatted, start, length))

    return F.transform(spans, read)
