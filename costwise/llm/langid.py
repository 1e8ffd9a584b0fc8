"""Language identification by compression.

For every language a raw-content zstandard dictionary is made of sample texts. A text, in
lower case, is compressed in blocks once with each dictionary; the language with the smallest total size
wins. The margin to the runner-up gives the score, and narrow margins are marked as rejected
in the column ``accepted``.

The dictionaries come from a bounded sample: ``DOCS_PER_LANG`` different texts of each language (chosen
by a hash of the text, so copies count once), of each ``WINDOWS`` windows of ``WINDOW`` characters that a hash places anywhere in the whole
text (a shorter text goes in whole); ``DICT_BYTES`` holds them all. Their
total grows with the number of languages, not with the rows. Whole texts are classified.

Edge cases: null texts and texts without a letter are ``und`` with score 0; without learned
languages every text is ``und``; equal sizes go to the first language by name with score 0;
with a single learned language every text with letters gets it; repeated rows get equal
results; output columns replace input columns of the same names.
"""

from __future__ import annotations

import math

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .tables import documents, fold
from .textvec import pieces

DOCS_PER_LANG, WINDOWS, WINDOW, DICT_BYTES, BLOCK, LEVEL = 120, 4, 200, 98304, 2048, 6
#: Relative size margin that halves the doubt, and the least margin that is accepted.
SCALE, LEAST = 0.02, 0.01
NONE = "und"


def learn(df: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id") -> dict[str, bytes]:
    """Dictionary content by language from rows with a text with letters and a language."""
    lettered = (df.filter(F.col(lang).isNotNull() & F.col(text).rlike(r"\p{L}"))
                .select(F.col(lang).alias("_lang"), F.col(text).alias("_t"), F.xxhash64(text).alias("_h")))
    w = Window.partitionBy("_lang").orderBy("_h")
    chosen = (lettered.select("_lang", "_h").distinct().withColumn("_n", F.row_number().over(w))
              .filter(F.col("_n") <= DOCS_PER_LANG))
    size = F.length("_t")
    at = [F.pmod(F.xxhash64("_h", F.lit(i)), size - WINDOW + 1).cast("int") + 1 for i in range(WINDOWS)]
    part = F.when(size <= WINDOWS * WINDOW, F.col("_t")).otherwise(F.concat_ws("\n", *[F.substring("_t", x, F.lit(WINDOW)) for x in at]))
    rows = (lettered.join(chosen, ["_lang", "_h"]).groupBy("_lang", "_n").agg(F.min(part).alias("_t")).orderBy("_lang", "_n").collect())
    out: dict[str, bytes] = {}
    for name, _, t in rows:
        out[name] = out.get(name, b"") + t.lower().encode() + b"\n"
    # letters of up to three bytes and more do not fit: the cut is at a character
    return {name: x[:DICT_BYTES].decode("utf-8", "ignore").encode() for name, x in out.items()}


def classify(df: DataFrame, dictionaries: dict[str, bytes], text: str = "text") -> DataFrame:
    """Replaces ``text`` by lang_pred, score and accepted."""
    names = sorted(dictionaries)
    contents = [dictionaries[n] for n in names]
    own = ("lang_pred", "score", "accepted", "_lettered")
    df = df.drop(*own).withColumn("_lettered", F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False)))
    keep = [f for f in df.schema.fields if f.name not in (text, "_lettered")]
    schema = T.StructType([*keep, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()),
                           T.StructField("accepted", T.BooleanType())])

    def run(batches):
        import zstandard
        tools = []
        for c in contents:
            d = zstandard.ZstdCompressionDict(c, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(level=LEVEL)
            tools.append(zstandard.ZstdCompressor(level=LEVEL, dict_data=d, write_checksum=False,
                                                  write_content_size=False, write_dict_id=False).compress)
        for whole in batches:
            for b in pieces(whole, text):
                pred, score, sure = [], [], []
                for t, ok in zip(b.column(text).to_pylist(), b.column("_lettered").to_pylist()):
                    if not ok or not names:
                        pred.append(NONE), score.append(0.0), sure.append(False)
                        continue
                    raw = t.lower().encode()
                    blocks = [raw[i:i + BLOCK] for i in range(0, len(raw), BLOCK)]
                    sizes = sorted((sum(len(f(x)) for x in blocks), i) for i, f in enumerate(tools))
                    margin = 1.0 if len(sizes) == 1 else (sizes[1][0] - sizes[0][0]) / sizes[1][0]
                    pred.append(names[sizes[0][1]])
                    score.append(1 - math.exp(-margin / SCALE))
                    sure.append(margin >= LEAST)
                yield pa.RecordBatch.from_arrays(
                    [*[b.column(f.name) for f in keep], pa.array(pred, pa.string()), pa.array(score, pa.float64()),
                     pa.array(sure, pa.bool_())], names=schema.names)

    return df.mapInArrow(run, schema)


def op10_language_id(spark, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).withColumn("held_out", fold("doc_id", 4) == 2)
    known = learn(docs.filter(~F.col("held_out")).select("doc_id", "text", "lang"))
    return classify(docs.select("doc_id", "held_out", "text"), known)
