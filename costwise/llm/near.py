"""Near-duplicate classes by Order MinHash and banded alignment.

A text's k-mers are its windows of five words, labelled with their occurrence number (the second
"a b c d e" differs from the first). Each of ``BANDS`` hash functions takes the L least labelled
k-mers and puts them back in text order; the tuple is the bucket key, so texts meet when they
share those k-mers in the same order. Keys of L = 4, 7 and 11 k-mers nest: the longer ones
split large buckets. Equal texts are one node, carried by their least id.

Candidates come in rounds over groups of bands (``ROUNDS``); a round compares only texts that the rounds before left in
different classes, and no pair twice. In buckets of up to ``SMALL`` texts all such pairs; larger buckets link every text to the
bucket's leader (the text with the most copies, then the least id) and to a second one that a
hash picks, at each length, and the texts meet again in the finer buckets, where the same rule holds. What the leaders leave open is
compared in full: the texts of every large bucket of the shortest key that is still of several classes meet by a
prefix-filtered k-mer join. In the order by frequency, rarest first, texts of n >= m k-mers at 0.8 have at least 4 (n + m) / 9 k-mers
in common, so the first of these is within the first n - ceil(4 n / 5) + 1 of the longer one, the first m - ceil(8 m / 9) + 1 of the
shorter one, and has as many k-mers behind it on both sides (positional filter). Texts that share a passage but are more than a ninth
their own are apart by that already; pairs of one class are left aside, as they change no class.

Verification: banded alignment of the two k-mer sequences. The longest common subsequence c
inside the band gives c / (n + m - c), which must be at least 0.8; that value bounds the
unmatched k-mers by (n + m) / 9, so the band of that width loses nothing. Labelled k-mers are distinct within a text, so
the alignment visits the matches inside the band only, and keeps the lowest end of a common subsequence of each length:
(n + m) log n steps. Verified links are joined into classes by least-label
propagation over written tables.

Recall: a pair at similarity 0.8 shares a key of length 4 in one of 20 bands with probability
1 - (1 - 0.8**4)**20 > 0.9999; a bucket of any size then compares the pair or has it in one class already.

Edge cases: null texts are classes of their own; empty texts, and texts without words, are equal to
themselves only; texts of fewer than five words have one k-mer of all words; repeated rows and null
ids share their text's class (the class id is the least id in it, null last); an empty table gives
no rows; columns of the input named like outputs are replaced.
"""

from __future__ import annotations

from bisect import bisect_left

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .tables import documents, materialize
from .textvec import U, mix, occurrences, pieces, prefix, ranges, raw, shingles, words

K, BANDS, LENGTHS, SMALL, SIMILARITY = 5, 20, (4, 7, 11), 16, 0.8
#: First bands of the rounds.
ROUNDS = (0, 2, 7)
#: K-mers times bands that are ranked at once.
RANKED = 1 << 20
SALTS = mix(np.arange(1, BANDS + 1, dtype=U) * U(0x9E3779B97F4A7C15)) | U(1)


def kmers(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Labelled k-mer identifiers in text order, their offsets by text, and the text of each."""
    n = len(off) - 1
    doc, start, end = words(buf, off)
    grams, goff = shingles(ranges(prefix(buf), start, end), doc, n, K)
    owner = np.repeat(np.arange(n), np.diff(goff))
    return mix(grams + occurrences(grams, owner).astype(U) * U(0xD6E8FEB86659FD93)), goff, owner


def keys(ids: np.ndarray) -> np.ndarray:
    """Bucket keys (bands x lengths) of one text's k-mers; a long text's bands one after the other."""
    at_once = max(1, RANKED // max(len(ids), 1))
    return np.concatenate([_keys(ids, SALTS[i:i + at_once]) for i in range(0, BANDS, at_once)])


def _keys(ids: np.ndarray, salts: np.ndarray) -> np.ndarray:
    out = np.zeros((len(salts), len(LENGTHS)), dtype=U)
    most = min(max(LENGTHS), len(ids))
    ranked = ids[None, :] * salts[:, None]
    ranked ^= ranked >> U(32)
    ranked *= U(0xD6E8FEB86659FD93)
    if len(ids) > most:
        at = np.argpartition(ranked, most - 1, axis=1)[:, :most]
    else:
        at = np.broadcast_to(np.arange(len(ids)), (len(salts), len(ids)))
    rank = np.take_along_axis(ranked, at, axis=1)
    by_rank = np.take_along_axis(at, np.argsort(rank, axis=1, kind="stable"), axis=1)
    for j, length in enumerate(LENGTHS):
        chosen = ids[np.sort(by_rank[:, :length], axis=1)]
        key = salts + U(length)
        for c in range(chosen.shape[1]):
            key = mix(key * U(0xC2B2AE3D27D4EB4F) + chosen[:, c])
        out[:, j] = key
    return out


def aligned(a: list[int], b: list[int]) -> float:
    """Similarity of two sequences of distinct identifiers: matches / (n + m - matches) of their longest
    common subsequence within the band; 0 when it is certainly below SIMILARITY."""
    n, m = len(a), len(b)
    if not n or not m:
        return 0.0
    place = {x: i for i, x in enumerate(a)}
    shared = [(j, place[x]) for j, x in enumerate(b) if x in place]
    if len(shared) < SIMILARITY * (n + m - len(shared)):
        return 0.0
    band = (n + m) // 9 + 1
    ends: list[int] = []  # the least place in ``a`` at which a common subsequence of each length ends
    for j, i in shared:
        if abs(i - j) <= band:
            at = bisect_left(ends, i)
            if at == len(ends):
                ends.append(i)
            else:
                ends[at] = i
    c = len(ends)
    return c / (n + m - c)


def sketch(df: DataFrame) -> DataFrame:
    """(id, h1, h2, keys) of texts (id, h1, h2, _t): the keys of every band, shortest first; texts
    without words have none."""
    fields = [df.schema[c] for c in ("id", "h1", "h2")]
    schema = T.StructType([*fields, T.StructField("keys", T.ArrayType(T.LongType(), False))])
    wide = BANDS * len(LENGTHS)

    def run(batches):
        for whole in batches:
            for b in pieces(whole, "_t"):
                ids, off, _ = kmers(*raw(b.column("_t")))
                some = np.flatnonzero(np.diff(off))
                if not len(some):
                    continue
                key = np.stack([keys(ids[off[i]: off[i + 1]]) for i in some]).ravel().view(np.int64)
                at = pa.array(np.arange(len(some) + 1, dtype=np.int32) * wide)
                yield pa.RecordBatch.from_arrays([*[b.column(f.name).take(pa.array(some)) for f in fields],
                                                  pa.ListArray.from_arrays(at, pa.array(key))], names=schema.names)

    return df.mapInArrow(run, schema)


def verify(pairs: DataFrame) -> DataFrame:
    """The pairs (a, b, ta, tb) that align, as (a, b, similarity)."""
    def run(batches):
        for whole in batches:
            for p in pieces(whole, "ta", 1 << 19):
                seqs = []
                for c in ("ta", "tb"):
                    ids, off, _ = kmers(*raw(p.column(c)))
                    ids = ids.tolist()
                    seqs.append([ids[x:y] for x, y in zip(off[:-1].tolist(), off[1:].tolist())])
                sim = np.array([aligned(x, y) for x, y in zip(*seqs)])
                good = np.flatnonzero(sim >= SIMILARITY)
                yield pa.RecordBatch.from_arrays([p.column("a").take(pa.array(good)), p.column("b").take(pa.array(good)),
                                                  pa.array(sim[good])], names=["a", "b", "similarity"])

    return pairs.mapInArrow(run, "a long, b long, similarity double")


def candidates(buckets: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Distinct pairs (a < b) of nodes of different classes from the buckets (node, label, rank, k4, k7, k11), and the large
    buckets (k4, node) of which only some pairs are among them; ``rank`` orders the leaders. Buckets of one class are left aside."""
    out, large, parent = None, None, buckets
    for length in LENGTHS:
        key = f"k{length}"
        size = parent.groupBy(key).agg(
            F.count(F.lit(1)).alias("size"), F.min(F.struct("rank", "label")).alias("lead"), F.min("label").alias("_lo"),
            F.max("label").alias("_hi"), F.min(F.struct(F.xxhash64(F.col(key), F.col("node")), "node", "label")).alias("other"))
        met = materialize(parent.join(size.filter("_lo <> _hi").drop("_lo", "_hi"), key), f"near-{key}")
        small = met.filter(F.col("size") <= SMALL)
        pairs = (small.select(key, F.col("node").alias("a"), F.col("label").alias("la"))
                 .join(small.select(key, F.col("node").alias("b"), F.col("label").alias("lb")), key)
                 .filter("a < b and la <> lb").select("a", "b"))
        to = F.array(F.struct(F.col("lead.rank.node").alias("node"), F.col("lead.label").alias("label")), F.struct("other.node", "other.label"))
        star = (met.filter(F.col("size") > SMALL).select("node", "label", F.explode(to).alias("to")).filter("label <> to.label")
                .select(F.least("node", "to.node").alias("a"), F.greatest("node", "to.node").alias("b")))
        both = pairs.unionByName(star)
        out = both if out is None else out.unionByName(both)
        parent = met.filter(F.col("size") > SMALL).select(*parent.columns)
        large = parent.select("k4", "node") if large is None else large
    return out.distinct(), large


def spelled(texts: DataFrame) -> DataFrame:
    """(node, label, n, kmer) of texts (node, label, _t): every k-mer, with the text's number of k-mers."""
    def run(batches):
        for whole in batches:
            for b in pieces(whole, "_t"):
                ids, off, _ = kmers(*raw(b.column("_t")))
                yield pa.RecordBatch.from_arrays(
                    [b.column("node"), b.column("label"), pa.array(np.diff(off).astype(np.int64)),
                     pa.ListArray.from_arrays(pa.array(off.astype(np.int32)), pa.array(ids.view(np.int64)))],
                    names=["node", "label", "n", "kmers"])

    wide = texts.select("node", "label", "_t").mapInArrow(run, "node long, label long, n long, kmers array<long>")
    return wide.select("node", "label", "n", F.explode("kmers").alias("kmer"))


def remainder(texts: DataFrame, large: DataFrame, label: DataFrame) -> DataFrame | None:
    """Pairs (a < b) of different classes that can align, among the texts (node, _t) of the large buckets (k4,
    node) that hold several classes (id, label); None if there is no such bucket."""
    named = large.join(label.withColumnRenamed("id", "node"), "node", "left").select(
        "k4", "node", F.coalesce("label", "node").alias("label"))
    split = named.groupBy("k4").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).filter("lo <> hi").select("k4")
    left = materialize(named.join(split, "k4", "left_semi").select("node", "label").distinct(), "near-open")
    if not left.limit(1).count():
        return None
    grams = materialize(spelled(texts.join(left, "node")), "near-kmers")
    df = grams.groupBy("kmer").agg(F.count(F.lit(1)).alias("df")).filter("df > 1")
    own = Window.partitionBy("node")
    # k-mers of one text only come first in the order and meet nothing, so they just count
    first = materialize(grams.join(df, "kmer")
                        .withColumn("at", F.col("n") - F.count(F.lit(1)).over(own) + F.row_number().over(own.orderBy("df", "kmer")))
                        .filter("at <= n - (4 * n + 4) div 5 + 1").select("kmer", "node", "label", "n", "at"), "near-prefix")
    # k-mers of one class meet nothing
    mixed = first.groupBy("kmer").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).filter("lo <> hi").select("kmer")
    met = first.join(mixed, "kmer")
    side = lambda x: met.select("kmer", F.col("node").alias(x), F.col("label").alias(f"l{x}"), F.col("n").alias(f"n{x}"),
                                F.col("at").alias(f"i{x}"))
    # x is the longer text (by number where they are as long), y is found by its shorter prefix; the first k-mer in common has the rest behind it
    y = side("y").filter("iy <= ny - (8 * ny + 8) div 9 + 1")
    near = ("(nx > ny or (nx = ny and x > y)) and lx <> ly and 5 * ny >= 4 * nx"
            " and 9 * (1 + least(nx - ix, ny - iy)) >= 4 * (nx + ny)")
    return (side("x").join(y, "kmer").filter(near)
            .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct())


def components(links: DataFrame) -> DataFrame:
    """(id, label): every linked id with the least id it reaches. Rounds of least-neighbour labels with
    pointer jumping; each round is a written table, and the number of rounds follows the
    logarithm of the longest chain."""
    edges = materialize(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(),
                        "near-edges")
    label = materialize(edges.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("label"))
                        .select(F.col("a").alias("id"), "label"), "near-labels")
    while True:
        reach = (edges.join(label.withColumnRenamed("id", "b"), "b").groupBy("a").agg(F.min("label").alias("near"))
                 .join(label.withColumnRenamed("id", "a"), "a")
                 .select(F.col("a").alias("id"), F.least("near", "label").alias("to"), F.col("label").alias("was")))
        jump = label.select(F.col("id").alias("to"), F.col("label").alias("far"))
        step = materialize(reach.join(jump, "to", "left").select(
            "id", F.least("to", F.coalesce("far", "to")).alias("label"), "was"), "near-labels")
        changed = step.filter("label <> was").limit(1).count()
        label = step.select("id", "label")
        if not changed:
            return label


def near_links(df: DataFrame, key: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame, DataFrame]:
    """(nodes, links, labels): the distinct texts (node, h1, h2, least key, copies n), verified links (a, b,
    similarity) that join every class, and the class (id, label) of each linked node."""
    rows = df.filter(F.col(text).isNotNull()).select(
        F.col(key).alias("id"), F.col(text).alias("_t"), F.xxhash64(F.col(text)).alias("h1"),
        F.xxhash64(F.lit(1), F.col(text)).alias("h2"))
    nodes = materialize(rows.groupBy("h1", "h2").agg(F.min("id").alias("least"), F.count(F.lit(1)).alias("n"))
                        .withColumn("node", F.monotonically_increasing_id()), "near-nodes")

    def one_row(t: DataFrame) -> DataFrame:
        """The row of each node that carries its work (one of them if rows repeat entirely)."""
        n = nodes.withColumnRenamed("h1", "g1").withColumnRenamed("h2", "g2")
        return t.join(n, (F.col("h1") == F.col("g1")) & (F.col("h2") == F.col("g2"))
                      & F.col("id").eqNullSafe(F.col("least")))

    def of_length(j: int):
        # one parameter: transform hands a second one the position
        return F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda i: F.get("keys", i * len(LENGTHS) + j))

    bands = F.arrays_zip(F.sequence(F.lit(0), F.lit(BANDS - 1)).alias("band"),
                         *[of_length(j).alias(f"k{length}") for j, length in enumerate(LENGTHS)])
    lengths = [f"k{length}" for length in LENGTHS]
    buckets = materialize(
        one_row(sketch(rows))
        .select("node", F.struct((-F.col("n")).alias("copies"), "least", "node").alias("rank"), F.explode(bands).alias("x"))
        .select("node", "rank", "x.band", *[F.col("x").getField(k).alias(k) for k in lengths]).distinct(), "near-buckets")
    texts = one_row(rows).select("node", "_t")

    def aligning(pairs: DataFrame) -> DataFrame:
        a = texts.select(F.col("node").alias("a"), F.col("_t").alias("ta"))
        b = texts.select(F.col("node").alias("b"), F.col("_t").alias("tb"))
        return materialize(verify(pairs.join(a, "a").join(b, "b").select("a", "b", "ta", "tb")), "near-links")

    links, label, tested, large = None, None, None, None
    for i, low in enumerate(ROUNDS):
        high = (*ROUNDS, BANDS)[i + 1]
        now = buckets.filter((F.col("band") >= low) & (F.col("band") < high)).drop("band")
        named = now.withColumn("label", F.col("node")) if label is None else (
            now.join(label.withColumnRenamed("id", "node"), "node", "left").withColumn("label", F.coalesce("label", "node")))
        found, big = candidates(named)
        found = found if tested is None else found.join(tested, ["a", "b"], "left_anti")
        pairs = materialize(found, "near-pairs")
        more = aligning(pairs)
        label = components(more) if label is None else joined_classes(label, more)
        links = more if links is None else links.unionByName(more)
        tested = pairs if tested is None else tested.unionByName(pairs)
        large = big if large is None else large.unionByName(big)
    rest = remainder(texts, large.distinct(), label)
    if rest is None:
        return nodes, links, label
    more = aligning(materialize(rest.join(tested, ["a", "b"], "left_anti"), "near-rest"))
    return nodes, links.unionByName(more), joined_classes(label, more)


def joined_classes(label: DataFrame, more: DataFrame) -> DataFrame:
    """Classes (id, label) after links (a, b) between them: the same propagation over the classes' labels."""
    if more.isEmpty():
        return label
    was = label.select("id", F.col("label").alias("of"))
    ends = (more.join(was.withColumnRenamed("id", "a").withColumnRenamed("of", "la"), "a", "left")
            .join(was.withColumnRenamed("id", "b").withColumnRenamed("of", "lb"), "b", "left")
            .select("a", "b", F.coalesce("la", "a").alias("la"), F.coalesce("lb", "b").alias("lb")))
    joined = components(ends.select(F.col("la").alias("a"), F.col("lb").alias("b")).distinct())
    known = was.unionByName(ends.select(F.explode(F.array(F.struct(F.col("a").alias("id"), F.col("la").alias("of")),
                                                          F.struct(F.col("b").alias("id"), F.col("lb").alias("of")))).alias("x"))
                            .select("x.id", "x.of")).distinct()
    return materialize(known.join(joined.select(F.col("id").alias("of"), "label"), "of", "left").select(
        "id", F.coalesce("label", "of").alias("label")), "near-labels")


def near_classes(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``df`` with class_id: the least key of the row's class (its own key if the text is null)."""
    nodes, _, label = near_links(df, key, text)
    named = nodes.join(label.withColumnRenamed("id", "node"), "node", "left").withColumn("label", F.coalesce("label", "node"))
    least = named.groupBy("label").agg(F.min("least").alias("class_id"))
    classes = named.join(least, "label").select(F.col("h1").alias("_h1"), F.col("h2").alias("_h2"), "class_id")
    out = df.drop("class_id").withColumn("_h1", F.xxhash64(F.col(text))).withColumn("_h2", F.xxhash64(F.lit(1), F.col(text)))
    return (out.join(classes, ["_h1", "_h2"], "left").drop("_h1", "_h2")
            .withColumn("class_id", F.when(F.col(text).isNull(), F.col(key)).otherwise(F.col("class_id"))))


def one_of_class(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of ``df`` for each class: of the text with the least key (null last) one row with that key; and every
    row whose text is null. Classes are told apart by their texts, so null or repeated keys join nothing."""
    nodes, _, label = near_links(df, key, text)
    named = nodes.join(label.withColumnRenamed("id", "node"), "node", "left").withColumn("label", F.coalesce("label", "node"))
    first = (named.groupBy("label").agg(F.min(F.struct(F.col("least").isNull().alias("none"), "least", "h1", "h2")).alias("x"))
             .select(F.col("x.least").alias("_least"), F.col("x.h1").alias("_h1"), F.col("x.h2").alias("_h2")))
    rows = df.filter(F.col(text).isNotNull()).withColumn("_g1", F.xxhash64(F.col(text))).withColumn(
        "_g2", F.xxhash64(F.lit(1), F.col(text)))
    kept = rows.join(first, (F.col("_g1") == F.col("_h1")) & (F.col("_g2") == F.col("_h2"))
                     & F.col(key).eqNullSafe(F.col("_least"))).dropDuplicates(["_g1", "_g2"])
    return kept.select(*df.columns).unionByName(df.filter(F.col(text).isNull()))


def op1_near_duplicates(spark, sf_dir: str) -> DataFrame:
    return near_classes(documents(spark, sf_dir).select("doc_id", "text")).select("doc_id", "class_id")
