"""Stock ageing: move non-positive month buckets into a neighbouring bucket until none is left.

Each round, per item: drop zero buckets; every bucket with quantity <= 0 moves to
the previous bucket (the next one if it is the first); buckets of the same month
are summed. Items are independent, and a converged item is a fixed point, so the
global loop (stop when no bucket <= 0 is left anywhere, at most ``months + 1``
rounds) equals running each item on its own.

One row per item holds its buckets as sorted arrays; an item has at most one
bucket per month of the period, so the arrays are bounded by the period length, not
by the data volume. All rounds run in one pass over batches of items: numpy rounds on
the batch's buckets laid end to end, in whole cents; an item that has no bucket <= 0
left takes no part in further rounds.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from . import stored


def _ager(max_rounds: int):
    """The rounds over batches (item_no, m, q, c): days, cents and cents of an item's buckets as arrays sorted by day; gives the final
    buckets, one a row. One closure, so that it travels to the tasks whole."""

    def one_round(g, m, q, c, known):
        """Buckets sorted by item ``g`` and day ``m``; ``known`` marks those with a cost (``c`` is 0 without one)."""
        kept = q != 0
        g, m, q, c, known = g[kept], m[kept], q[kept], c[kept], known[kept]
        if not len(g):
            return g, m, q, c, known
        same = g[1:] == g[:-1]
        after, before = np.append(False, same), np.append(same, False)  # has a previous, a next bucket
        moved, neg = m.copy(), q <= 0
        to = np.flatnonzero(neg & after)
        moved[to] = m[to - 1]
        to = np.flatnonzero(neg & ~after & before)
        moved[to] = m[to + 1]
        order = np.lexsort((moved, g))
        g, m, q, c, known = g[order], moved[order], q[order], c[order], known[order]
        at = np.flatnonzero(np.append(True, (g[1:] != g[:-1]) | (m[1:] != m[:-1])))
        return g[at], m[at], np.add.reduceat(q, at), np.add.reduceat(c, at), np.logical_or.reduceat(known, at)

    def all_rounds(items, buckets):
        done = []
        for _ in range(max_rounds):
            buckets = one_round(*buckets)
            open_items = np.zeros(items, dtype=bool)
            open_items[buckets[0][buckets[2] <= 0]] = True
            still = open_items[buckets[0]]
            done.append(tuple(x[~still] for x in buckets))  # converged items are fixed points
            buckets = tuple(x[still] for x in buckets)
            if not len(buckets[0]):
                break
        return tuple(np.concatenate(x) for x in zip(*done, buckets))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            item, m, q, c = batch.columns
            cost = c.flatten()
            g, m, q, c, known = all_rounds(len(item), (
                np.repeat(np.arange(len(item)), np.diff(m.offsets.to_numpy())), m.flatten().to_numpy(), q.flatten().to_numpy(),
                cost.fill_null(0).to_numpy(zero_copy_only=False), cost.is_valid().to_numpy(zero_copy_only=False)))
            yield pa.RecordBatch.from_arrays([item.take(pa.array(g)), pa.array(m), pa.array(q), pa.array(c, mask=~known)],
                                             names=["item_no", "m", "q", "c"])

    return run


def month_buckets(moves: DataFrame, start_date: str) -> DataFrame:
    """(item_no, month, quantity, cost): month of max(date, start), sums rounded to 2."""
    s = F.lit(start_date).cast("date")
    m = F.trunc(F.greatest(F.col("posting_date"), s), "month")
    return moves.groupBy("item_no", m.alias("month")).agg(
        F.round(F.sum("quantity"), 2).cast("decimal(18,2)").alias("quantity"),
        F.round(F.sum("cost"), 2).cast("decimal(18,2)").alias("cost"))


def entry_costs(ledger: DataFrame, values: DataFrame) -> DataFrame:
    """``ledger`` (entry_no, …) with ``cost``: the sum of its value entries (entry_no, cost), rounded to 2; null without any. Values are
    summed before the join, so an entry with many ships one row."""
    sums = values.groupBy("entry_no").agg(F.round(F.sum("cost"), 2).cast("decimal(18,2)").alias("cost"))
    return ledger.join(sums, "entry_no", "left")


def age_stock(buckets: DataFrame, max_rounds: int) -> DataFrame:
    """Run the ageing rounds on (item_no, month, quantity, cost) buckets; items with a
    non-positive total are dropped first. Returns the final buckets."""
    cents = lambda c: (F.col(c).cast("decimal(18,2)") * 100).cast("long")
    amount = lambda c: (F.col(c).cast("decimal(19,0)") * F.lit("0.01").cast("decimal(3,2)")).cast("decimal(18,2)")
    # buckets without a quantity only count for their item's total, as those of zero
    bucket = F.when(F.col("quantity").isNotNull(), F.struct(
        F.unix_date("month").cast("long").alias("m"), cents("quantity").alias("q"), cents("cost").alias("c")))
    arr = (buckets.filter(F.col("item_no").isNotNull()).groupBy("item_no")
           .agg(F.sum("quantity").alias("_t"), F.array_sort(F.collect_list(bucket)).alias("b")).filter(F.col("_t") > 0)
           .select("item_no", *[F.col(f"b.{x}").alias(x) for x in "mqc"]))
    item = buckets.schema["item_no"].dataType.simpleString()
    aged = arr.mapInArrow(_ager(max_rounds), f"item_no {item}, m long, q long, c long")
    return aged.select("item_no", F.date_from_unix_date(F.col("m").cast("int")).alias("month"), amount("q").alias("quantity"),
                       amount("c").alias("cost"))


def add_moves(moves: DataFrame, path: str, start_date: str, max_rounds: int, parts: int) -> None:
    """Takes further moves (item_no, posting_date, quantity, cost) into the ageing stored at ``path``.

    Two tables in ``parts`` by item: the month buckets before ageing, and the aged ones. New moves, of whatever month, are added to
    the first; items are independent and ageing starts from these buckets, so only items with new moves are aged again, late
    entries included, and the result is that of a run over all moves. Parts without such an item are not read or written.
    """
    spark = moves.sparkSession
    new = materialize(stored.in_parts(month_buckets(moves, start_date), ["item_no"], parts), "ageing-new")
    touched = sorted(str(r[0]) for r in new.select(stored.BUCKET).distinct().collect())
    if not touched:
        return
    raw_path, aged_path = f"{path}/raw", f"{path}/aged"
    raw, aged = new, None
    items = new.select("item_no").distinct()
    if stored.manifest(spark, raw_path)[0]:
        old = stored.read(spark, raw_path, stored.BUCKET, touched).select(*new.columns)
        raw = (new.unionByName(old).groupBy("item_no", "month", stored.BUCKET)
               .agg(F.sum("quantity").cast("decimal(18,2)").alias("quantity"), F.sum("cost").cast("decimal(18,2)").alias("cost"))
               .select(*new.columns))
        raw = materialize(raw, "ageing-raw")
        aged = stored.read(spark, aged_path, stored.BUCKET, touched).join(items, "item_no", "left_anti").select(*new.columns)
    again = stored.in_parts(age_stock(raw.join(items, "item_no", "left_semi").drop(stored.BUCKET), max_rounds), ["item_no"], parts)
    again = again.select(*new.columns)
    aged = materialize(again if aged is None else aged.unionByName(again), "ageing-aged")
    # aged first: a run that dies in between is repeated from the old buckets and gives the same
    stored.publish(aged, aged_path, stored.BUCKET, touched)
    stored.publish(raw, raw_path, stored.BUCKET, touched)
