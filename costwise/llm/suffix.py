"""Exact removal of repeated long substrings by bucket-pointer refinement.

Every byte covered by a LENGTH-byte string that also starts elsewhere (same text or another;
matches never cross texts) is removed. Suffixes are compared to depth LENGTH only, in buckets:

1. Bucket identifiers of q-grams are built by doubling: the identifier at depth 2q is made of
   the identifiers at offsets s and s + q, each level reusing the ones before. Identifiers are
   64-bit and depend on the bytes alone, so tasks agree on them without exchanging ranks.
2. The initial buckets hold the q-grams (q = LENGTH / 2) at sampled offsets: of the q-grams in a
   LENGTH-byte string the one with the least identifier stands for it, leftmost on ties, which
   is the same for equal strings. Consecutive strings with the same sample form a run.
3. A bucket with one member holds no repeat. The others are refined by the identifier of the whole
   run; a class of two or more equal runs repeats in all its strings.
4. Buckets of several classes are refined string by string, with one run for each class (and
   the class size as its weight): by the identifier at depth LENGTH. All refinements are grouped
   counts (combined before the shuffle) joined back on the pair (initial bucket, refined
   identifier), that is on 128 bits.

Edge cases: null is empty; texts shorter than LENGTH lose nothing; repeated rows are repeats of each other;
an empty table gives no rows; texts are told apart by key and content, so keys may be null or
repeat (rows with equal key and text have equal results).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .tables import documents, materialize
from .textvec import U, mix, pieces, raw

LENGTH = 200
A, B = U(0x9E3779B97F4A7C15), U(0xC2B2AE3D27D4EB4F)
HIGH, LOW = U(0xFFFFFFFF00000000), U(0xFFFFFFFF)
PIECE = 1 << 18


def gram(length: int) -> int:
    """Depth q of the initial buckets."""
    return max(1, length // 2)


def deeper(ids: np.ndarray, step: int) -> np.ndarray:
    """Identifiers of the pairs (ids[s], ids[s + step])."""
    out = ids[:-step] * A
    out += ids[step:]
    out ^= out >> U(31)
    out *= B
    return out


def identifiers(buf: np.ndarray, depths: tuple[int, ...]) -> dict[int, np.ndarray]:
    """Bucket identifiers of all offsets at the given depths (ascending), by doubling."""
    ids, depth, out = mix(np.arange(1, 257, dtype=U))[buf], 1, {}
    for want in depths:
        while depth * 2 <= want and len(ids) > depth:
            ids, depth = deeper(ids, depth), depth * 2
        out[want] = ids if depth == want else deeper(ids, want - depth) if len(ids) > want - depth else ids[:0]
    return out


def leftmost_min(ids: np.ndarray, width: int) -> np.ndarray:
    """Position of the least identifier (by its high half, leftmost on ties) in every window."""
    n = len(ids) - width + 1
    v = np.full(len(ids) + -len(ids) % width, np.iinfo(np.uint64).max, dtype=U)
    v[: len(ids)] = (mix(ids) & HIGH) | np.arange(len(ids), dtype=U)
    v = v.reshape(-1, width)
    left = np.minimum.accumulate(v, axis=1).ravel()
    right = np.minimum.accumulate(v[:, ::-1], axis=1)[:, ::-1].ravel()
    return (np.minimum(right[:n], left[width - 1: width - 1 + n]) & LOW).astype(np.int64)


def runs(buf: np.ndarray, off: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, ...]:
    """(row, place, bucket, run identifier) of all runs of the texts; ``place`` packs the first start
    and the number of further starts."""
    q, none = gram(length), np.zeros(0, dtype=np.int64)
    if len(buf) < length:
        return none, none, none, none
    ids = identifiers(buf, (q, length))
    at = leftmost_min(ids[q], length - q + 1)
    row = np.repeat(np.arange(len(off) - 1), np.diff(off))[: len(at)]
    starts = np.flatnonzero(np.arange(len(at)) + length <= off[row + 1])
    at, row = at[starts], row[starts]
    if not len(at):
        return none, none, none, none
    new = np.ones(len(at), dtype=bool)
    new[1:] = (at[1:] != at[:-1]) | (row[1:] != row[:-1])
    first = np.flatnonzero(new)
    last = np.concatenate((first[1:], [len(at)])) - 1
    a, b, r, sample = starts[first], starts[last], row[first], at[first]
    span = b - a
    deep = ids[length]
    whole = mix((deep[a] * A + deep[b]) ^ ((span << 16) + sample - a).astype(U))
    place = ((a - off[r]) << 16) | span
    return r, place, ids[q][sample].view(np.int64), whole.view(np.int64)


def _map(df: DataFrame, keep: list[str], text: str, extra: dict[str, str], work) -> DataFrame:
    """mapInArrow over small pieces; ``work(batch)`` gives (row numbers, new columns)."""
    fields = [df.schema[c] for c in keep]
    schema = T.StructType([*fields, *T._parse_datatype_string(", ".join(f"{n} {t}" for n, t in extra.items())).fields])

    def go(batches):
        for outer in batches:
            for b in pieces(outer, text, PIECE):
                row, columns = work(b)
                taken = pa.array(row)
                yield pa.RecordBatch.from_arrays([*[b.column(c).take(taken) for c in keep], *map(pa.array, columns)],
                                                 names=schema.names)

    return df.mapInArrow(go, schema)


def _runs(df: DataFrame, length: int) -> DataFrame:
    def work(b):
        row, *cols = runs(*raw(b.column("_t")), length)
        return row, cols

    return _map(df.select("_k", "_h", "_t"), ["_k", "_h"], "_t", {"place": "long", "g": "long", "w": "long"}, work)


def _strings(df: DataFrame, length: int) -> DataFrame:
    """(_k, _h, s, g, w, m): the starts of each open run with their identifiers at full depth."""
    def work(b):
        buf, off = raw(b.column("_t"))
        deep = identifiers(buf, (length,))[length].view(np.int64)
        lists = b.column("open")
        todo = lists.flatten()
        count = np.diff(lists.offsets.to_numpy())
        lo, hi, g, m = (todo.field(i).to_numpy(zero_copy_only=False) for i in range(4))
        row = np.repeat(np.arange(b.num_rows), count)
        n = hi - lo + 1
        which = np.repeat(np.arange(len(n)), n)
        s = lo[which] + np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n)
        return row[which], [s, g[which], deep[off[row[which]] + s], m[which]]

    return _map(df.select("_k", "_h", "_t", "open"), ["_k", "_h"], "_t", {"s": "long", "g": "long", "w": "long", "m": "long"}, work)


def repeated_ranges(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """(_k, _h, spans): byte ranges [start, end) of repeats in texts (_k, _h, _t); they may overlap."""
    all_runs = _runs(docs, length)
    full = all_runs.groupBy("g").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("g")
    kept = materialize(all_runs.join(full, "g").groupBy("_k", "_h", "place", "g", "w")
                       .agg(F.count(F.lit(1)).alias("n")), "suffix-runs")
    start, span = F.shiftright("place", 16), F.col("place").bitwiseAND(F.lit(0xFFFF).cast("long"))
    classes = materialize(kept.groupBy("g", "w").agg(F.sum("n").alias("m"), F.min(F.struct("_k", "_h", "place")).alias("one")),
                          "suffix-classes")
    several = classes.groupBy("g").agg(F.count(F.lit(1)).alias("c")).filter("c > 1").select("g")
    todo = (classes.join(several, "g").select("one.*", "g", "m").groupBy("_k", "_h")
            .agg(F.collect_list(F.struct(start.alias("lo"), (start + span).alias("hi"), "g", "m")).alias("open")))
    strings = materialize(_strings(docs.join(todo, ["_k", "_h"]), length), "suffix-strings")
    twice = strings.groupBy("g", "w").agg(F.sum("m").alias("all")).filter("all > 1").select("g", "w")
    found = materialize(strings.filter("m = 1").join(twice, ["g", "w"])
                        .select("_k", "_h", F.col("s").alias("start"), (F.col("s") + length).alias("end")), "suffix-found")
    whole = (kept.join(classes.filter("m > 1").select("g", "w"), ["g", "w"])
             .select("_k", "_h", start.alias("start"), (start + span + length).alias("end")))
    return materialize(found.unionByName(whole).groupBy("_k", "_h")
                       .agg(F.collect_list(F.struct("start", "end")).alias("spans")), "suffix-ranges")


def merged(spans) -> list[tuple[int, int]]:
    """Disjoint maximal ranges."""
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def remove_repeats(df: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH) -> DataFrame:
    """``df`` with kept (binary: the text's remaining bytes), n_bytes, n_removed and removed (array of
    byte ranges)."""
    new = ("kept", "n_bytes", "n_removed", "removed", "_k", "_h", "_t", "spans")
    df = df.drop(*[c for c in new if c not in (key, text)])
    t = F.coalesce(F.col(text), F.lit("")).cast("binary")
    docs = df.withColumn("_t", t).withColumn("_h", F.xxhash64(t))
    docs = docs.withColumn("_k", F.xxhash64(F.lit(1), F.col(key)))
    slim = docs.select("_k", "_h", "_t").filter(F.length("_t") >= length)
    ranges = repeated_ranges(slim, length)
    joined = docs.join(ranges, ["_k", "_h"], "left").drop("_k", "_h")
    keep = [f for f in joined.schema.fields if f.name not in ("_t", "spans")]
    schema = T.StructType([*keep, *T._parse_datatype_string(
        "kept binary, n_bytes long, n_removed long, removed array<struct<start:long,end:long>>").fields])

    def cut(batches):
        for outer in batches:
            for b in pieces(outer, "_t"):
                kept, sizes, gone, spans = [], [], [], []
                for raw_text, found in zip(b.column("_t").to_pylist(), b.column("spans").to_pylist()):
                    ranges = merged((x["start"], x["end"]) for x in found or ())
                    ends = [0, *[e for _, e in ranges]]
                    kept.append(b"".join(raw_text[e:s] for e, s in zip(ends, [*[s for s, _ in ranges], len(raw_text)])))
                    sizes.append(len(raw_text))
                    gone.append(len(raw_text) - len(kept[-1]))
                    spans.append([{"start": s, "end": e} for s, e in ranges])
                yield pa.RecordBatch.from_arrays(
                    [*[b.column(f.name) for f in keep], pa.array(kept, pa.binary()), pa.array(sizes, pa.int64()),
                     pa.array(gone, pa.int64()),
                     pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))], names=schema.names)

    return joined.mapInArrow(cut, schema)


def op5_suffix_dedup(spark, sf_dir: str) -> DataFrame:
    return remove_repeats(documents(spark, sf_dir).select("doc_id", "text")).select(
        "doc_id", "n_bytes", "n_removed", F.size("removed").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"))
