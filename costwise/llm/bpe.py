"""Byte-level BPE encoding and decoding by overlapping chunks.

Texts longer than ``chunk`` characters are cut into overlapping chunks that separate tasks
pre-tokenise. A pre-token depends only on the text from its start to a few characters past its
end, so from any boundary that two neighbouring chunks agree on both give the same pre-tokens:
there the text is cut into pieces (only after a character that is not white space, so that a
piece's end cannot change how white space is matched). Pieces are encoded in parallel and
their ids joined in order. A document with a chunk that does not resynchronise within the
overlap (a run of letters longer than it) is encoded as one piece. Shorter texts are one
chunk and one piece. Decoding joins the raw bytes of the ids.

Edge cases: null and empty texts give an empty id list; repeated rows stay apart (chunks are
kept by an own row number, not by key); an empty table gives no rows; the columns ``ids`` and
``n_tokens`` are replaced if the input has them.
"""

from __future__ import annotations

import base64
import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .tables import materialize
from .textvec import pieces

CHUNK, OVERLAP = 32768, 512
#: Characters past a match's end that can decide it (contractions look two ahead).
AHEAD = 4


@functools.lru_cache(maxsize=4)
def tokenizer(path: str, pattern: str):
    """(encoder, bytes by id) for a rank file; kept for the life of a Python worker."""
    import tiktoken
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, filter(bytes.strip, f))}
    by_id = [b""] * (max(ranks.values()) + 1)
    for token, i in ranks.items():
        by_id[i] = token
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}), by_id


def boundaries(text: str, pattern: str) -> list[int]:
    """Ends of the pre-tokens of ``text`` that follow a character other than white space."""
    import regex
    return [m.end() for m in regex.finditer(pattern, text) if not text[m.end() - 1].isspace()]


def _list(rows: list[list[int]]) -> pa.ListArray:
    offsets = np.zeros(len(rows) + 1, dtype=np.int32)
    np.cumsum([len(r) for r in rows], out=offsets[1:])
    values = np.fromiter((i for r in rows for i in r), dtype=np.int32, count=int(offsets[-1]))
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))


def _encode(df: DataFrame, text: str, path: str, pattern: str) -> DataFrame:
    """Replaces ``text`` by ``ids`` (each row is one piece)."""
    keep = [f for f in df.schema.fields if f.name != text]
    schema = T.StructType([*keep, T.StructField("ids", T.ArrayType(T.IntegerType(), False))])

    def run(batches):
        encode = tokenizer(path, pattern)[0].encode_ordinary
        for whole in batches:
            for b in pieces(whole, text):
                ids = _list([encode(t or "") for t in b.column(text).to_pylist()])
                cols = [b.column(f.name) for f in keep]
                yield pa.RecordBatch.from_arrays([*cols, ids], names=[f.name for f in schema.fields])

    return df.mapInArrow(run, schema)


def _marks(df: DataFrame, pattern: str, chunk: int, overlap: int) -> DataFrame:
    """Adds to each chunk (no, start, more, piece) its boundaries near its start and near its end."""
    schema = T.StructType([*df.schema.fields, T.StructField("head", T.ArrayType(T.LongType())),
                           T.StructField("tail", T.ArrayType(T.LongType()))])

    def run(batches):
        for whole in batches:
            for b in pieces(whole, "piece"):
                heads, tails = [], []
                for start, more, text in zip(b.column("start").to_pylist(), b.column("more").to_pylist(),
                                             b.column("piece").to_pylist()):
                    ends = boundaries(text, pattern)
                    sure = len(text) - AHEAD if more else len(text)
                    heads.append([start + e for e in ends if e < overlap and e < sure])
                    tails.append([start + e for e in ends if chunk <= e < sure] if more else [])
                yield pa.RecordBatch.from_arrays(
                    [*b.columns, pa.array(heads, pa.list_(pa.int64())), pa.array(tails, pa.list_(pa.int64()))],
                    names=schema.names)

    return df.mapInArrow(run, schema)


def stitch(chunks: DataFrame) -> DataFrame:
    """Pieces (uid, no, rest, piece) of the chunks (uid, no, start, rest, piece, head, tail)."""
    w = Window.partitionBy("uid").orderBy("no")
    whole = Window.partitionBy("uid")
    cut = F.array_min(F.array_intersect("head", F.lag("tail").over(w)))
    c = (chunks.withColumn("cut", F.when(F.col("no") == 0, F.lit(0).cast("long")).otherwise(cut))
         .withColumn("lost", F.max(F.col("cut").isNull()).over(whole))
         .withColumn("until", F.lead("cut").over(w)))
    good = c.filter(~F.col("lost")).select("uid", "no", "rest", F.substr(
        "piece", (F.col("cut") - F.col("start") + 1).cast("int"),
        F.coalesce(F.col("until") - F.col("cut"), F.length("piece")).cast("int")).alias("piece"))
    bad = (c.filter("lost").withColumn("own", F.when(F.col("more"), F.substr("piece", F.lit(1), F.col("step").cast("int")))
                                       .otherwise(F.col("piece")))
           .groupBy("uid").agg(F.first("rest", ignorenulls=True).alias("rest"),
                               F.array_sort(F.collect_list(F.struct("no", "own"))).alias("x"))
           .select("uid", F.lit(0).alias("no"), "rest",
                   F.array_join(F.transform("x", lambda y: y["own"]), "").alias("piece")))
    return good.unionByName(bad)


def encode(df: DataFrame, path: str, pattern: str, text: str = "text", chunk: int = CHUNK,
           overlap: int = OVERLAP) -> DataFrame:
    """``df`` without ``text``, with ``ids`` (array of int) and ``n_tokens``."""
    df = df.drop("ids", "n_tokens")
    rest = [c for c in df.columns if c != text]
    packed = df.select(F.struct(*[F.col(c) for c in rest]).alias("rest") if rest else F.lit(True).alias("rest"),
                       F.col(text).alias("piece"))
    size = F.length(F.coalesce("piece", F.lit("")))
    short = _encode(packed.filter(size <= chunk), "piece", path, pattern)
    steps = F.sequence(F.lit(0), F.ceil(size / F.lit(chunk)).cast("int") - 1)
    cut = (packed.filter(size > chunk).withColumn("uid", F.monotonically_increasing_id())
           .select("uid", F.posexplode(steps).alias("no", "k"), "rest", "piece")
           .select("uid", "no", (F.col("k") * chunk).cast("long").alias("start"), F.lit(chunk).alias("step"),
                   ((F.col("k") + 1) * chunk < F.length("piece")).alias("more"),
                   F.when(F.col("no") == 0, F.col("rest")).alias("rest"),
                   F.substr("piece", F.col("k") * chunk + 1, F.lit(chunk + overlap)).alias("piece")))
    chunks = materialize(_marks(cut, pattern, chunk, overlap), "bpe-chunks")
    encoded = _encode(stitch(chunks), "piece", path, pattern)
    joined = (encoded.groupBy("uid").agg(F.first("rest", ignorenulls=True).alias("rest"),
                                         F.array_sort(F.collect_list(F.struct("no", "ids"))).alias("x"))
              .select("rest", F.flatten(F.transform("x", lambda y: y["ids"])).alias("ids")))
    out = short.unionByName(joined)
    cols = [F.col("rest").getField(c).alias(c) for c in rest]
    return out.select(*cols, "ids", F.size("ids").cast("long").alias("n_tokens"))


def decode(df: DataFrame, path: str, pattern: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """Adds the raw bytes of the ids; ids that the vocabulary lacks are an error."""
    schema = T.StructType([*[f for f in df.schema.fields if f.name != out], T.StructField(out, T.BinaryType())])

    def run(batches):
        by_id = tokenizer(path, pattern)[1]
        for b in batches:
            for at in range(0, b.num_rows, 256):
                part = b.slice(at, 256)
                raw = [b"".join(map(by_id.__getitem__, r or ())) for r in part.column(ids).to_pylist()]
                cols = [part.column(f.name) for f in schema.fields[:-1]]
                yield pa.RecordBatch.from_arrays([*cols, pa.array(raw, pa.binary())], names=schema.names)

    return df.mapInArrow(run, schema)


def op6_byte_bpe(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers
    from .tables import documents
    path, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    ids = encode(documents(spark, sf_dir).select("doc_id", "text"), path, pattern)
    done = decode(ids, path, pattern)
    return done.select(
        "doc_id", "n_tokens",
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " ").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))
