"""Chat formatting: typed content parts become one marked-up string with a loss mask.

A turn is `<turn ROLE>BODY</turn>\\n`. Only the template writes the character `<`: in texts and roles a
backslash becomes `\\b` and `<` becomes `\\l` (in roles `>` also becomes `\\g`), which two replacements undo.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import words

PART = "struct<kind:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>"
END = "</turn>\n"
#: Expanded tokens of a picture tile, a second of sound and a page.
TILE, PER_SECOND, PER_PAGE = 14, 25, 256


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\b")), F.lit("<"), F.lit("\\l"))


def unescape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\l"), F.lit("<")), F.lit("\\b"), F.lit("\\"))


def escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit(">"), F.lit("\\g"))


def unescape_role(role: Column) -> Column:
    return unescape(F.replace(role, F.lit("\\g"), F.lit(">")))


def _text(part: Column) -> tuple[Column, Column]:
    text = F.coalesce(part["text"], F.lit(""))
    return escape(text), F.size(words(text)).cast("long")


def _image(part: Column) -> tuple[Column, Column]:
    side = lambda n: F.ceil(F.greatest(F.coalesce(part[n], F.lit(0)), F.lit(0)) / TILE)
    return F.lit("<|image|>"), side("width") * side("height")


def _audio(part: Column) -> tuple[Column, Column]:
    return F.lit("<|audio|>"), F.ceil(F.greatest(F.coalesce(part["seconds"], F.lit(0.0)), F.lit(0.0)) * PER_SECOND)


def _document(part: Column) -> tuple[Column, Column]:
    return F.lit("<|document|>"), F.greatest(F.coalesce(part["pages"], F.lit(0)), F.lit(0)).cast("long") * PER_PAGE


#: The visitor: what each kind of part becomes, and how many tokens that stands for.
VISITOR: dict[str, Callable[[Column], tuple[Column, Column]]] = {"text": _text, "image": _image, "audio": _audio, "document": _document}


def visit(part: Column, visitor: dict = VISITOR) -> Column:
    """One part as struct<body, kind, ref, tokens>; a part of no known kind is an empty body of no tokens."""
    body, tokens = F.lit(""), F.lit(0).cast("long")
    for kind, f in visitor.items():
        made, n = f(part)
        body = F.when(part["kind"] == kind, made).otherwise(body)
        tokens = F.when(part["kind"] == kind, n.cast("long")).otherwise(tokens)
    return F.struct(body.alias("body"), part["kind"].alias("kind"), part["ref"].alias("ref"), tokens.alias("tokens"))


def text_part(text: Column) -> Column:
    """A lone text part."""
    none = {"ref": "string", "width": "int", "height": "int", "seconds": "double", "pages": "int"}
    return F.array(F.struct(F.lit("text").alias("kind"), F.coalesce(text, F.lit("")).alias("text"), *(F.lit(None).cast(t).alias(k) for k, t in none.items())))


def format_chat(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", parts: str = "parts", loss_role: str = "assistant") -> DataFrame:
    """One row a conversation: formatted, loss_spans, attachments, n_tokens.

    turns has a row a turn with an array of typed parts (PART). Rows stand by turn, then role, then body, nulls first.
    loss_spans are (start, length) in code points of formatted and cover the escaped bodies of loss_role.
    attachments lists (place, kind, ref, tokens) of all parts but text, in order. Null parts, texts and roles are
    empty ones; a null conversation id is a conversation of its own; an empty table gives no rows. Other columns
    are ignored, whatever their names. A conversation is one string, so its rows meet in one task by definition.
    """
    flat = turns.select(
        F.col(conv).alias("conv"), F.col(turn).alias("turn"), F.coalesce(F.col(role), F.lit("")).alias("role"),
        F.transform(F.coalesce(F.col(parts), F.expr(f"cast(array() as array<{PART}>)")), lambda p: visit(p)).alias("flat"),
    )
    flat = flat.select("conv", "turn", "role", "flat", F.array_join(F.transform("flat", lambda x: x["body"]), "").alias("body"))
    flat = flat.withColumn("head", F.concat(F.lit("<turn "), escape_role(F.col("role")), F.lit(">")))
    flat = flat.withColumn("piece", F.concat("head", "body", F.lit(END)))
    upto = Window.partitionBy("conv").orderBy("turn", "role", "body").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    flat = flat.withColumn("start", F.sum(F.char_length("piece")).over(upto) - F.char_length("piece"))
    row = F.struct(
        "start", "piece", (F.col("role") == loss_role).alias("loss"), (F.col("start") + F.char_length("head")).alias("at"),
        F.char_length("body").cast("long").alias("len"), "flat",
    )
    got = flat.groupBy("conv").agg(F.array_sort(F.collect_list(row)).alias("rows"))
    every = F.flatten(F.transform("rows", lambda r: r["flat"]))
    other = F.filter(every, lambda x: ~x["kind"].eqNullSafe("text"))
    return got.select(
        F.col("conv").alias(conv),
        F.array_join(F.transform("rows", lambda r: r["piece"]), "").alias("formatted"),
        F.transform(F.filter("rows", lambda r: r["loss"]), lambda r: F.struct(r["at"].alias("start"), r["len"].alias("length"))).alias("loss_spans"),
        F.transform(other, lambda x, i: F.struct(i.alias("place"), x["kind"].alias("kind"), x["ref"].alias("ref"), x["tokens"].alias("tokens"))).alias("attachments"),
        F.aggregate(every, F.lit(0).cast("long"), lambda n, x: n + x["tokens"]).alias("n_tokens"),
    )


def parse_turns(formatted: Column) -> Column:
    """The turns of a formatted conversation: array<struct<role, body>>, both unescaped."""
    pieces = F.split(formatted, END)
    pieces = F.slice(pieces, 1, F.greatest(F.size(pieces) - 1, F.lit(0)))
    head = lambda p: F.substring_index(p, ">", 1)
    return F.transform(pieces, lambda p: F.struct(
        unescape_role(F.substring(head(p), 7, 2147483647)).alias("role"),
        unescape(p.substr(F.char_length(head(p)) + 2, F.lit(2147483647))).alias("body"),
    ))


def masked_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped, nothing between. UTF-32 gives each span in constant time."""
    wide = F.array(F.encode(formatted, "UTF-32"))
    of = lambda e: F.transform(spans, lambda s: unescape(F.decode(e.substr((s["start"] * 4 + 1).cast("int"), (s["length"] * 4).cast("int")), "UTF-32")))
    return F.array_join(F.element_at(F.transform(wide, of), 1), "")
