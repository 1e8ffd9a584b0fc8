"""Corpus pipeline over ``documents``: quality classifier, near-dedup, substring dedup, benchmark
decontamination, token round trip. Each stage's result is written and reread as the next one's input.

A stage gets (spark, docs, sf_dir) and returns the documents it keeps with the columns of ``documents``
(doc_id, text, lang, source, n_chars); the last one returns tokens instead.

Decisions are made for rows, not ids: a row is known by its id and two hashes of its text, so distinct texts
under one id or under null ids stand and fall on their own.

Edge cases hold as in the operators: null texts are kept by the classifier if their score is, are never duplicates and
lose nothing; an empty table passes through all stages; extra columns are dropped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from costwise.llm import bpe, decontam, near, pu, suffix
from costwise.llm.tables import documents, importable, materialize, read

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def named(docs: DataFrame) -> DataFrame:
    """``docs`` with the hashes that tell rows of one id apart."""
    return docs.select(*COLUMNS, F.xxhash64("text").alias("h1"), F.xxhash64(F.lit(1), F.col("text")).alias("h2"))


def matching(docs: DataFrame, rows: DataFrame, how: str) -> DataFrame:
    """Rows of ``docs`` with (left_semi) or without (left_anti) their id and hashes in ``rows``."""
    a, b = named(docs).alias("a"), rows.select("doc_id", "h1", "h2").distinct().alias("b")
    same = (F.col("a.h1") == F.col("b.h1")) & (F.col("a.h2") == F.col("b.h2")) & F.col("a.doc_id").eqNullSafe(F.col("b.doc_id"))
    return a.join(b, same, how).select(*COLUMNS)


def quality(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the positive-unlabelled classifier scores below one half go."""
    importable(spark)
    return matching(docs, pu.pu_quality(named(docs), read(spark, sf_dir, "labels"), ("h1", "h2")).filter("predicted = 1"), "left_semi")


def near_dedup(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates stays: the one with the least id. Null texts stay."""
    importable(spark)
    return near.one_of_class(docs.select(*COLUMNS))


def substring_dedup(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bytes of repeated 200-byte strings go; what is left of a character cut in two goes too
    (with any replacement characters of a text that loses bytes). A document of which
    nothing is left goes."""
    importable(spark)
    out = suffix.remove_repeats(docs.select(*COLUMNS))
    rest = F.replace(F.make_valid_utf8(F.col("kept").cast("string")), F.lit("\ufffd"), F.lit(""))
    text = F.when(F.col("n_removed") == 0, F.col("text")).otherwise(rest)
    return (out.withColumn("text", text).filter("n_removed = 0 or length(text) > 0")
            .withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS))


def decontaminate(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    importable(spark)
    items = decontam.split_items(read(spark, sf_dir, "benchmark")).select("item_id", "question", "answer")
    leaks = decontam.find_leaks(named(docs).select(F.struct("doc_id", "h1", "h2").alias("row"), "text"), items, key="row")
    return matching(docs, leaks.select("row.*"), "left_anti")


def tokenise(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, ids, n_tokens, round_trip): the ids decode to the text's bytes."""
    import public_tokenizers
    importable(spark)
    path, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    ids = bpe.encode(docs.select("doc_id", "text", F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("was")),
                     path, pattern)
    return bpe.decode(ids, path, pattern).select("doc_id", "ids", "n_tokens",
                                                 (F.sha2("decoded", 256) == F.col("was")).alias("round_trip"))


STAGES = [("quality", quality), ("near_dedup", near_dedup), ("substring_dedup", substring_dedup),
          ("decontaminate", decontaminate), ("tokenise", tokenise)]

#: Fitted models and alignments are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the last stage's rows."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
