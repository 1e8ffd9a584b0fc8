"""Reproducible shuffle into shards: Feistel permutation over global row numbers.

Row numbers 0..N-1 follow (key, text checksum, size); the permutation moves row ``r`` to
place ``y``; shard = y mod shards and slot = y div shards, so shard sizes differ by at
most one row and slots are gapless. Both directions are closed column expressions:
``permuted`` tells where a row goes, ``row_at`` which row sits in a shard and slot.

Edge cases: a null text counts as empty; a null key sorts first; rows equal in all
ordering columns are interchangeable; an empty table gives no rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .tables import materialize

PRIME = 2147483647
#: Fixed round parameters (multiplier, offset) of the Feistel network.
ROUNDS = ((48271, 11), (69621, 1009), (16807, 70001), (39373, 900007), (742938285, 31), (950706376, 4099))
INLINE_STEPS = 64


def sides(n: int) -> tuple[int, int]:
    """Factors (a, b) of the smallest near-square domain a*b >= n."""
    a = max(1, math.isqrt(max(n - 1, 0)) + 1)
    return a, max(1, -(-n // a))


def _mix(x: Column, mul: Column, add: Column, seed: int) -> Column:
    z = F.pmod(x + add + F.lit(seed % PRIME).cast("long"), F.lit(PRIME).cast("long"))
    return F.pmod(F.pmod(z * z, F.lit(PRIME).cast("long")) * mul + add, F.lit(PRIME).cast("long"))


def _rounds(x: Column, a: int, b: int, seed: int, sign: int) -> Column:
    """The network on the domain a*b, x = left * b + right; ``sign`` -1 runs it backwards.
    The rounds are a fold over the constants, so the expression stays small."""
    big_a, big_b = F.lit(a).cast("long"), F.lit(b).cast("long")
    order = list(enumerate(ROUNDS))[::sign]
    steps = F.array(*[F.struct(F.lit(i % 2 == 0).alias("even"), F.lit(m).cast("long").alias("m"),
                               F.lit(c).cast("long").alias("c")) for i, (m, c) in order])
    start = F.struct(((x - F.pmod(x, big_b)) / big_b).cast("long").alias("l"), F.pmod(x, big_b).alias("r"))

    def one(h, k):
        return F.when(k["even"], F.struct(
            F.pmod(h["l"] + sign * _mix(h["r"], k["m"], k["c"], seed), big_a).alias("l"), h["r"].alias("r"),
        )).otherwise(F.struct(
            h["l"].alias("l"), F.pmod(h["r"] + sign * _mix(h["l"], k["m"], k["c"], seed), big_b).alias("r")))

    return F.aggregate(steps, start, one, lambda h: h["l"] * big_b + h["r"])


def _walk(x: Column, step, n: int) -> Column:
    """Cycle walking: repeat until the value is below n. The domain exceeds n by less than its
    side, so a second step is already rare; the long walk is evaluated for those rows only and
    a walk that is still outside after it is an error, never a wrong place."""
    def more(v):
        on = F.aggregate(F.sequence(F.lit(1), F.lit(INLINE_STEPS)), v,
                         lambda acc, _: F.when(acc >= n, step(acc)).otherwise(acc),
                         lambda acc: F.when(acc >= n, F.raise_error(F.lit("cycle walk did not end")).cast("long"))
                         .otherwise(acc))
        return F.when(v >= n, on).otherwise(v)

    return F.element_at(F.transform(F.array(step(x)), more), 1)


def permuted(row: Column, n: int, seed: int) -> Column:
    a, b = sides(n)
    return _walk(row.cast("long"), lambda x: _rounds(x, a, b, seed, 1), n)


def row_at(place: Column, n: int, seed: int) -> Column:
    """The row number that ``permuted`` sends to ``place``."""
    a, b = sides(n)
    return _walk(place.cast("long"), lambda y: _rounds(y, a, b, seed, -1), n)


def number_rows(df: DataFrame, order: list[str], out: str = "row_no") -> tuple[DataFrame, int]:
    """Global row numbers in the given order without a single-task sort: rows are dealt by
    range and written once (a range sample may differ between runs, a table does not);
    each range then counts from the sum of the ranges before it. Returns (rows, count).
    Only one count per range reaches the offsets table, which is broadcast: one row for each
    shuffle partition."""
    taken = {c.lower() for c in df.columns}
    part = next(c for c in (f"_range{i}" for i in range(len(taken) + 1)) if c not in taken)
    dealt = materialize(df.repartitionByRange(*[F.col(c).asc_nulls_first() for c in order])
                        .withColumn(part, F.spark_partition_id()), "row-ranges")
    counts = dealt.groupBy(part).agg(F.count(F.lit(1)).alias("_n"))
    sizes = sorted((r[0], r[1]) for r in counts.collect())
    start, total, cases = {}, 0, []
    for p, k in sizes:
        start[p], total = total, total + k
        cases.append((p, start[p]))
    if not cases:
        return dealt.withColumn(out, F.lit(0).cast("long")).drop(part), 0
    offsets = df.sparkSession.createDataFrame(cases, f"{part} int, _start long")
    w = Window.partitionBy(part).orderBy(*[F.col(c).asc_nulls_first() for c in order])
    numbered = (dealt.withColumn("_k", F.row_number().over(w))
                .join(F.broadcast(offsets), part)
                .withColumn(out, F.col("_start") + F.col("_k") - 1)
                .drop(part, "_k", "_start"))
    return numbered, total


def assign_shards(df: DataFrame, order: list[str], shards: int, seed: int = 20240601) -> DataFrame:
    """Adds row_no, shard and slot to ``df`` (law ``rows``)."""
    numbered, n = number_rows(df, order)
    place = permuted(F.col("row_no"), max(n, 1), seed)
    return (numbered.withColumn("_place", place)
            .withColumn("shard", F.pmod(F.col("_place"), F.lit(shards).cast("long")).cast("int"))
            .withColumn("slot", F.floor(F.col("_place") / F.lit(shards)).cast("long"))
            .drop("_place"))
