"""Chat formatting by prefix-target expansion.

Every assistant turn becomes an example of its own: all turns before it are context, only its reply is trainable.
expand() makes one row for each: how long its context is, a prefix of the formatted conversation, and its target's text.
The examples of a conversation share their prefixes, so the conversation is stored once, with its first example; examples()
writes the prefixes out where they are wanted, which is quadratic in a conversation's turns.

A turn is "### Role: text</turn>\\n". In roles and texts "&", "<", "#" and ":" (roles only) are written as character
references, so no text holds a control string, and reading back undoes it exactly.

DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

START, MIDDLE, END = "### ", ": ", "</turn>\n"


def escape(text: Column) -> Column:
    return F.replace(F.replace(F.replace(text, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit("#"), F.lit("&#35;"))


def unescape(text: Column) -> Column:
    return F.replace(F.replace(F.replace(text, F.lit("&#35;"), F.lit("#")), F.lit("&lt;"), F.lit("<")), F.lit("&amp;"), F.lit("&"))


def _role(role: Column) -> Column:
    return F.replace(escape(role), F.lit(":"), F.lit("&#58;"))


def _unrole(role: Column) -> Column:
    return unescape(F.replace(role, F.lit("&#58;"), F.lit(":")))


def format_conversations(turns: DataFrame) -> DataFrame:
    """conv_id, formatted, targets: one struct (start, length) of code points for each trainable reply, in order.

    Turns are ordered by turn, then role, then text; null turns come first. Null text and null roles are empty. A
    conversation without an assistant has no targets. Null conv_ids make one conversation. Other columns are ignored.
    """
    turns = turns.select("conv_id", "turn", F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    head, body = F.concat(F.lit(START), _role(F.col("role")), F.lit(MIDDLE)), escape(F.col("text"))
    piece = turns.select("conv_id", "turn", "role", "text", F.concat(head, body, F.lit(END)).alias("piece"), F.char_length(head).alias("head"), F.char_length(body).alias("body"))
    # code points of all pieces before each one: running sums, so that long conversations cost what they hold
    before = W.partitionBy("conv_id").orderBy("turn", "role", "text").rowsBetween(W.unboundedPreceding, -1)
    placed = piece.select("conv_id", "role", "piece", "head", "body", F.coalesce(F.sum(F.char_length("piece")).over(before), F.lit(0)).cast("int").alias("at"))
    target = F.when(F.col("role") == "assistant", F.struct((F.col("at") + F.col("head")).alias("start"), F.col("body").alias("length")))
    whole = placed.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("at", "piece"))).alias("pieces"), F.array_sort(F.collect_list(target)).alias("targets"))
    return whole.select("conv_id", F.array_join(F.transform("pieces", lambda p: p["piece"]), "").alias("formatted"), "targets")


def expand(formatted: DataFrame) -> DataFrame:
    """One row for each assistant turn: conv_id, example, context_chars (the prefix of the formatted conversation that is
    its context), target (the only trainable text, unescaped), formatted (with the first example; null with the others).

    A conversation without an assistant has one row, without an example.
    """
    one = F.transform("targets", lambda t: F.struct(t["start"].alias("context_chars"), unescape(F.substring(F.col("formatted"), t["start"] + 1, t["length"])).alias("target")))
    rows = formatted.select("conv_id", "formatted", F.posexplode_outer(one).alias("example", "x"))
    return rows.select("conv_id", "example", "x.context_chars", "x.target", F.when(F.coalesce(F.col("example"), F.lit(0)) == 0, F.col("formatted")).alias("formatted"))


def examples(formatted: DataFrame) -> DataFrame:
    """One row for each assistant turn: conv_id, example, context (all turns before it), target."""
    rows = formatted.select("conv_id", "formatted", F.posexplode("targets").alias("example", "place"))
    start = F.col("place.start")
    return rows.select("conv_id", "example", F.substring("formatted", F.lit(1), start).alias("context"), F.substring("formatted", start + 1, F.col("place.length")).alias("target"))


def read_turns(formatted: Column) -> Column:
    """array<struct<role, text>> read back from a formatted conversation."""
    pieces = F.filter(F.split(formatted, END), lambda p: p != "")

    def one(piece: Column) -> Column:
        cut = F.instr(piece, MIDDLE)
        return F.struct(_unrole(F.substring(piece, F.lit(len(START) + 1), cut - len(START) - 1)).alias("role"), unescape(F.substring(piece, cut + len(MIDDLE), F.char_length(piece))).alias("text"))

    return F.transform(pieces, one)
