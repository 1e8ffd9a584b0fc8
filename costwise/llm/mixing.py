"""Mixing sources to target weights: a low-discrepancy schedule of slots joined to shuffled equal-token blocks.

The words of a source, its documents in a hashed order and once more in another order for the second epoch, form a
stream that is cut into blocks of ``BLOCK`` words. Slot i of the mix is the golden-ratio point
frac(i / phi) (32 bits, exact); the cumulative block counts of the sources map it to a source, and the k-th slot of a
source takes its k-th block. So every stretch of the mix holds the sources in their proportions, up to a few
blocks. A source that the points serve a few slots short gets these at the end, one served above its blocks leaves
them empty; every source gives its rounded target of words.

Scale: positions in a stream are running sums over hash ranges and inside them, ranks of slots over chunks and inside
them, so no window spans a source. Slots meet sources by cells of the unit interval, four and more a source: a cell holds
1.25 sources on average, so that join makes 1.25 rows a slot. The table of sources (one row each) is ranked in one window.

Edge cases: null text has no words; a null source is a source of its own, the last; null and repeated ids are told apart by
their text; equal rows are grouped with a count before they meet a window and stand in the stream one after the other; documents without
words are in no block and take nothing; an empty table gives no rows; other columns are not read, so no name
clashes; a long text spans as many blocks as it has words for.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .tables import documents, materialize

WORD = "[^\\x20\\x09-\\x0D]+"
WEIGHTS = (3, 1, 2)
#: Share of all words that the mix takes, and the most of a source (and a document) that it repeats.
SHARE, EPOCHS = 1.5, 2
#: Words of a block.
BLOCK = 256
#: The golden ratio as a 32-bit fraction.
GOLDEN, UNIT = 2654435769, 1 << 32
#: Slots of one chunk of ranks; distinct rows of one hash range, about.
CHUNK, RANGE_ROWS = 1 << 16, 4_000


def measured(docs: DataFrame) -> DataFrame:
    """(doc_id, source, key, size, copies): documents (doc_id, source, text) by id and text, with their words."""
    text = F.coalesce(F.col("text"), F.lit(""))
    key = F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.md5(text.cast("binary"))).cast("binary"))
    return (docs.select("doc_id", "source", key.alias("key"), F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"))
            .groupBy("doc_id", "source", "key", "size").agg(F.count(F.lit(1)).alias("copies")))


def targets(rows: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE, epochs: int = EPOCHS, block: int = BLOCK) -> DataFrame:
    """(source, s, source_size, target, wanted, need): for each source its number in code-point order, the words it has and
    is to give, and its blocks.

    With targets min(cap, weight * level) the level at which they sum to the share is the greatest of the levels that any
    set of capped sources would leave to the others, so it is a maximum over the sources by cap per weight."""
    per = rows.groupBy("source").agg(F.sum(F.col("size") * F.col("copies")).alias("source_size"))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("s") % len(weights) + 1).cast("int"))
    per = (per.withColumn("s", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
           .withColumn("weight", weight).withColumn("cap", F.col("source_size") * epochs))
    order = Window.orderBy(F.col("cap") / F.col("weight"), "s")
    everything = Window.partitionBy()
    capped = F.coalesce(F.sum("cap").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    others = F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing))
    per = per.withColumn("level", (F.sum("source_size").over(everything) * share - capped) / others)
    target = F.least(F.col("cap").cast("double"), F.max("level").over(everything) * F.col("weight"))
    return (per.select("source", "s", "source_size", target.alias("target"))
            .withColumn("wanted", F.least(F.floor(F.col("target") + 0.5), F.col("source_size") * epochs))
            .withColumn("need", F.ceil(F.col("wanted") / F.lit(block))))


def streamed(rows: DataFrame, sources: DataFrame, epochs: int = EPOCHS) -> DataFrame:
    """Adds each row's epochs and the place of its first word in the stream of its source."""
    wide = F.sequence(F.lit(0), F.least(F.greatest(F.ceil(F.col("wanted") / F.greatest(F.col("source_size"), F.lit(1))), F.lit(1)), F.lit(epochs)).cast("int") - 1)
    rows = (rows.join(sources.withColumnRenamed("source", "src"), F.col("source").eqNullSafe(F.col("src"))).drop("src")
            .withColumn("epoch", F.explode(F.coalesce(wide, F.array(F.lit(0)))))
            .withColumn("turn", F.md5(F.concat_ws(":", "key", "epoch").cast("binary"))))
    ranges = max(rows.count() // RANGE_ROWS, 1)
    digits = 0 if ranges == 1 else len(f"{ranges - 1:x}")
    rows = rows.withColumn("range", F.substring("turn", 1, digits) if digits else F.lit(""))
    words = F.col("size") * F.col("copies")
    starts = (rows.groupBy("s", "epoch", "range").agg(F.sum(words).alias("words"))
              .withColumn("before", F.sum("words").over(Window.partitionBy("s", "epoch").orderBy("range")) - F.col("words"))
              .select("s", "epoch", "range", "before"))
    inside = Window.partitionBy("s", "epoch", "range").orderBy("turn", "key", F.col("doc_id").asc_nulls_first(), "size")
    return (rows.withColumn("within", F.sum(words).over(inside.rowsBetween(Window.unboundedPreceding, 0)) - words)
            .join(starts, ["s", "epoch", "range"])
            .withColumn("first", F.col("epoch") * F.col("source_size") + F.col("before") + F.col("within")))


def blocks(stream: DataFrame, block: int = BLOCK) -> DataFrame:
    """(s, block, doc_id, key, copy, from_word, to_word): the pieces of documents that the blocks to be taken hold."""
    rows = (stream.filter("size > 0").withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)))
            .withColumn("first", F.col("first") + F.col("copy") * F.col("size"))
            .withColumn("end", F.least(F.col("first") + F.col("size"), F.col("wanted"))).filter("first < end"))
    at = F.sequence(F.floor(F.col("first") / block), F.floor((F.col("end") - 1) / block))
    return (rows.withColumn("block", F.explode(at)).select(
        "s", "block", "doc_id", "key", "copy",
        (F.greatest(F.col("first"), F.col("block") * block) - F.col("first")).alias("from_word"),
        (F.least(F.col("end"), (F.col("block") + 1) * block) - F.col("first")).alias("to_word")))


def points(n: int, spark) -> DataFrame:
    """(slot, u): the first n golden-ratio points as 32-bit fractions. The product is taken in two parts, so no step
    leaves 64 bits."""
    half = 1 << 31
    low, high = F.col("id") % half, F.floor(F.col("id") / half) % 2
    return spark.range(0, n, 1, max(1, n >> 22) if n >> 22 > 8 else None).select(
        F.col("id").alias("slot"), F.pmod(low * GOLDEN + high * half, F.lit(UNIT)).alias("u"))


def schedule(sources: DataFrame) -> DataFrame:
    """(slot, s, block): the slots in their order and the block of a source that each takes."""
    spark = sources.sparkSession
    n, kinds = sources.agg(F.coalesce(F.sum("need"), F.lit(0)), F.count(F.lit(1))).first()
    bits = max(12, (4 * kinds).bit_length())
    to = F.sum("need").over(Window.orderBy("s"))
    # the ends are whole numbers of 2**-32, the last one is 1
    end = lambda c: F.floor(c.cast("decimal(38,0)") * UNIT / max(n, 1)).cast("long")
    parts = (sources.select("s", "need", end(to - F.col("need")).alias("lo"), end(to).alias("hi")).filter("need > 0"))
    cell = UNIT >> bits
    cells = parts.withColumn("cell", F.explode(F.sequence(F.floor(F.col("lo") / cell), F.floor((F.col("hi") - 1) / cell)))).filter("hi > lo")
    served = (points(n, spark).withColumn("cell", F.floor(F.col("u") / cell)).join(cells, "cell")
              .filter("lo <= u and u < hi").select("slot", "s", "need", F.floor(F.col("slot") / CHUNK).alias("chunk")))
    served = materialize(served, "mix-slots")
    before = (served.groupBy("s", "chunk").agg(F.count(F.lit(1)).alias("slots"))
              .withColumn("before", F.sum("slots").over(Window.partitionBy("s").orderBy("chunk")) - F.col("slots")).drop("slots"))
    ranked = (served.withColumn("rank", F.row_number().over(Window.partitionBy("s", "chunk").orderBy("slot")))
              .join(before, ["s", "chunk"]).select("slot", "s", "need", (F.col("before") + F.col("rank") - 1).alias("block"))
              .filter("block < need").drop("need"))
    have = served.groupBy("s").agg(F.count(F.lit(1)).alias("have"))
    short = (parts.join(have, "s", "left").withColumn("have", F.coalesce("have", F.lit(0))).filter("have < need")
             .withColumn("before", F.sum(F.col("need") - F.col("have")).over(Window.orderBy("s")) - (F.col("need") - F.col("have")))
             .withColumn("block", F.explode(F.sequence(F.col("have"), F.col("need") - 1)))
             .select((F.lit(n) + F.col("before") + F.col("block") - F.col("have")).alias("slot"), "s", "block"))
    return ranked.unionByName(short)


def mixed(stream: DataFrame, sources: DataFrame, block: int = BLOCK) -> DataFrame:
    """(slot, s, block, doc_id, key, copy, from_word, to_word): the mix, its slots in order; a piece is the words
    [from_word, to_word) of a document."""
    return schedule(sources).join(blocks(stream, block), ["s", "block"])


def mix_sources(docs: DataFrame, block: int = BLOCK) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(rows, sources, mix) of documents (doc_id, source, text): the distinct rows with their copies, the targets, the pieces in slots."""
    rows = materialize(measured(docs), "mix-rows")
    sources = materialize(targets(rows, block=block), "mix-sources")
    return rows, sources, mixed(materialize(streamed(rows, sources), "mix-stream"), sources, block)


def op12_source_mix(spark, sf_dir: str) -> DataFrame:
    rows, sources, mix = mix_sources(documents(spark, sf_dir).select("doc_id", "source", "text"))
    numbered = sources.withColumnRenamed("source", "src")
    each = (rows.join(numbered, F.col("source").eqNullSafe(F.col("src")))
            .withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)))
            .select("doc_id", "key", "s", "copy", "size", "source_size", "target", F.lit(0).cast("long").alias("words")))
    taken = mix.select("doc_id", "key", "s", "copy", F.lit(None).cast("long").alias("size"),
                       F.lit(None).cast("long").alias("source_size"), F.lit(None).cast("double").alias("target"),
                       (F.col("to_word") - F.col("from_word")).alias("words"))
    return (each.unionByName(taken).groupBy("doc_id", "key", "s", "copy")
            .agg(F.max("size").alias("size"), F.max("source_size").alias("source_size"), F.max("target").alias("target"),
                 F.sum("words").alias("taken"))
            .select("doc_id", "size", "source_size", "target", "taken"))


#: The same law without slots and blocks: what a source gives is the start of its two-epoch stream.
ORACLE = f"""
with d as (select row_number() over () rid, doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::bigint size,
                  md5(coalesce(doc_id::varchar, '') || ':' || md5(coalesce(text, ''))) key from documents),
per as (select *, [3, 1, 2][((row_number() over (order by encode(source) nulls last) - 1) % 3) + 1] w
        from (select source, sum(size)::bigint source_size from d group by source)),
level as (select max((rest.total * {SHARE} - rest.capped) / rest.others) v from (
  select (select sum(source_size) from per) total,
         coalesce((select sum({EPOCHS} * source_size) from per q where q.source_size * p.w < p.source_size * q.w), 0) capped,
         (select sum(w) from per q where q.source_size * p.w >= p.source_size * q.w)::double others from per p) rest),
src as (select source, source_size, least(({EPOCHS} * source_size)::double, w * v) target from per, level),
sent as (select d.*, source_size, target, least(floor(target + 0.5), {EPOCHS} * source_size)::bigint wanted, e
         from d join src on d.source is not distinct from src.source, range(0, {EPOCHS}) t(e)),
placed as (select *, e * source_size + sum(size) over (partition by source, e order by md5(key || ':' || e), key, doc_id nulls first, rid
                                                       rows unbounded preceding) - size first from sent)
select doc_id, size, source_size, target, sum(greatest(0, least(first + size, wanted) - first))::bigint taken
from placed group by rid, doc_id, size, source_size, target
"""
