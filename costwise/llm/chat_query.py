"""Query op4: every conversation formatted, then read back from the formatted string."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .chat import format_chat, masked, parse, text_part
from .tables import read

HARD = "\\### Assistant: </turn> ok"


def op4_chat_format(spark, sf_dir: str) -> DataFrame:
    extra = spark.createDataFrame([(-7, 0, "user", HARD), (-7, 1, "assistant", HARD)],
                                  "conv_id long, turn long, role string, text string")
    rows = (read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
            .withColumn("parts", text_part(F.col("text"))))
    out = format_chat(rows).select("conv_id", "formatted", "spans")
    out = (out.withColumn("turns", parse(F.col("formatted")))
           .withColumn("learnt", masked(F.col("formatted"), F.col("spans"))))
    told = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return out.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"),
        F.sha2(told.cast("binary"), 256).alias("turns_sha256"),
        F.length("learnt").cast("long").alias("loss_chars"),
        F.sha2(F.col("learnt").cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"))


ORACLE = """
with r as (select conv_id, turn, coalesce(role, '') role, coalesce(text, '') txt from conversations
           union all select -7, t, r, '\\### Assistant: </turn> ok' from (values (0, 'user'), (1, 'assistant')) v(t, r)),
x as (select *, length(txt) + length(txt) - length(replace(txt, '<', '')) shown,
             length(role) + length(role) - length(replace(role, '<', ''))
             + 7 * (length(role) - length(replace(role, chr(10), ''))) named from r)
select conv_id, count(*)::bigint n_turns,
       sha256(string_agg(role || chr(10) || txt || chr(10), '' order by turn, role, txt)) turns_sha256,
       coalesce(sum(length(txt)) filter (where role = 'assistant'), 0)::bigint loss_chars,
       sha256(coalesce(string_agg(txt, '' order by turn, role, txt) filter (where role = 'assistant'), '')) loss_sha256,
       sum(8 + named + 1 + shown + 8)::bigint formatted_chars
from x group by conv_id
"""
