"""Chat formatting: typed content parts to one training string with a loss mask.

A conversation's turns are lists of parts ``struct<kind, text, ref, units>``; a visitor maps
each part to text: text parts are escaped, image, audio and document parts become ordered
placeholders, and each attachment records its reference, its placeholder number and the
tokens it expands to. Turns are rendered as

    <|turn|>role\\ncontent<|end|>\\n

Every ``<`` of a role or text is written ``<\\``, so no text can hold a marker, also not across
the border of two parts, and ``unescape`` restores it exactly; a line break in a role becomes
a marker of its own.

Edge cases: null text is empty; a null role is empty; a null or empty part list is an empty
turn; unknown kinds raise an error; turns of equal number keep a fixed order (role, content);
a null conversation id forms one conversation; repeated rows are turns of their own; other columns are dropped, whatever their
names; an empty table gives no rows. The work grows with a conversation's characters; its string is one value, so a conversation is
as long as a string may be (2 GB).
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

TURN, END, LINE, BREAK = "<|turn|>", "<|end|>", "<|line|>", "\n"
PART = "struct<kind:string,text:string,ref:string,units:bigint>"
#: Tokens for one unit of an attachment: image patches, audio frames, document pages.
TOKENS = {"image": 1, "audio": 25, "document": 600}


def escape(c: Column) -> Column:
    return F.replace(c, F.lit("<"), F.lit("<\\"))


def unescape(c: Column) -> Column:
    return F.replace(c, F.lit("<\\"), F.lit("<"))


def text_part(c: Column) -> Column:
    """A single text part from a plain text column."""
    return F.array(F.struct(F.lit("text").alias("kind"), F.coalesce(c, F.lit("")).alias("text"),
                            F.lit(None).cast("string").alias("ref"), F.lit(0).cast("long").alias("units")))


def visit(part: Column) -> Column:
    """One part as text."""
    out = F.when(part["kind"] == "text", escape(F.coalesce(part["text"], F.lit(""))))
    for kind in TOKENS:
        out = out.when(part["kind"] == kind, F.lit(f"<|{kind}|>"))
    return out.otherwise(F.raise_error(F.concat(F.lit("unknown part kind "), F.coalesce(part["kind"], F.lit("null")))))


def expanded(part: Column) -> Column:
    """Tokens an attachment takes."""
    out = F.lit(0).cast("long")
    for kind, each in TOKENS.items():
        out = F.when(part["kind"] == kind, F.coalesce(part["units"], F.lit(1)) * each).otherwise(out)
    return out


def format_chat(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
                parts: str = "parts", learn: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """One row per conversation: formatted, n_turns, spans (start, length in code points of every
    learnt content), attachments (number, kind, ref, n_tokens) and expanded_tokens."""
    p = F.coalesce(F.col(parts), F.array().cast(f"array<{PART}>"))
    files = F.filter(p, lambda x: x["kind"] != "text")
    rows = df.select(
        F.col(conv).alias("conv_id"), F.col(turn).alias("t"),
        F.coalesce(F.col(role), F.lit("")).alias("role"),
        F.array_join(F.transform(p, visit), "").alias("content"),
        F.transform(files, lambda x: F.struct(x["kind"].alias("kind"), x["ref"].alias("ref"),
                                              expanded(x).alias("n_tokens"))).alias("files"))
    rows = rows.withColumn("head", F.concat(F.lit(TURN), F.replace(escape(F.col("role")), F.lit(BREAK), F.lit(LINE)), F.lit(BREAK)))
    size = F.length("head") + F.length("content") + len(END + BREAK)
    # a turn's place is a running sum over the turns before it; turns are never empty, so places also give the order
    before = Window.partitionBy("conv_id").orderBy("t", "role", "content").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("at", F.sum(size).over(before) - size)
    one = F.struct("at", F.concat("head", "content", F.lit(END + BREAK)).alias("shown"), F.col("role").isin(*learn).alias("learnt"),
                   (F.col("at") + F.length("head")).alias("start"), F.length("content").cast("long").alias("length"), "files")
    turns = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list(one)).alias("turns"))
    spans = F.transform(F.filter("turns", lambda x: x["learnt"]), lambda x: F.struct(x["start"].alias("start"), x["length"].alias("length")))
    files = F.flatten(F.transform("turns", lambda x: x["files"]))
    return turns.select(
        "conv_id",
        F.array_join(F.transform("turns", lambda x: x["shown"]), "").alias("formatted"),
        F.size("turns").cast("long").alias("n_turns"),
        spans.alias("spans"),
        F.transform(files, lambda x, i: F.struct(i.alias("number"), x["kind"].alias("kind"), x["ref"].alias("ref"),
                                                 x["n_tokens"].alias("n_tokens"))).alias("attachments"),
        F.aggregate(files, F.lit(0).cast("long"), lambda a, x: a + x["n_tokens"]).alias("expanded_tokens"))


def parse(formatted: Column) -> Column:
    """The turns (role, text) read back from a formatted string; placeholders stay as text."""
    blocks = F.filter(F.split(formatted, r"<\|end\|>\n"), lambda b: b.startswith(TURN))
    return F.transform(blocks, lambda b: F.struct(
        unescape(F.replace(F.substring_index(F.substr(b, F.lit(len(TURN) + 1)), BREAK, 1),
                           F.lit(LINE), F.lit(BREAK))).alias("role"),
        unescape(F.regexp_replace(b, r"\A<\|turn\|>[^\n]*\n", "")).alias("text")))


@F.pandas_udf(T.StringType())
def masked(formatted: pd.Series, spans: pd.Series) -> pd.Series:
    """The learnt texts, in order, unescaped and joined without separator. Each is cut out by its place, so the work grows with
    the string (a substring expression would count its characters from the start for each span)."""
    return pd.Series(["".join(text[s["start"]:s["start"] + s["length"]].replace("<\\", "<") for s in own)
                      for text, own in zip(formatted, spans)], dtype=object)
