"""Exact debit/credit pairing of groups in which an account stands on both sides or an entry has two sides.

Each entry, in order, takes the earliest open entry of another account whose amount mirrors its own. Open entries wait in
first-in queues by (side, amount, account); for each (side, amount) a heap holds the accounts by their earliest entry, so an entry
finds its partner at the top or, if that is its own account, next to it: a few heap steps an entry, whatever the group's size.
Rows arrive sorted by group and entry, so a task keeps the open entries of one group and nothing else.
"""

from __future__ import annotations

import heapq
from collections import deque
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DEBIT, CREDIT = 0, 1


class Open:
    """The open entries of one group, each as (place in the group's order, entry number)."""

    def __init__(self):
        self.heaps, self.queues, self.gone, self.next = {}, {}, set(), 0

    def _top(self, slot: tuple, account: str) -> tuple | None:
        """The earliest open entry of a (side, amount) that is not of ``account``."""
        heap, aside, found = self.heaps.get(slot), None, None
        while heap:
            place, who = heap[0]
            queue = self.queues[slot, who]
            while queue and queue[0][0] in self.gone:
                queue.popleft()
            if not queue:
                heapq.heappop(heap)
            elif queue[0][0] != place:
                heapq.heapreplace(heap, (queue[0][0], who))
            elif who != account:
                found = queue[0]
                break
            else:
                aside = heapq.heappop(heap)
        if aside:
            heapq.heappush(heap, aside)
        return found

    def meet(self, entry: int, account: str, debit: int, credit: int) -> int | None:
        """The partner of an entry, which is then no longer open; without one the entry is opened."""
        found = [self._top((DEBIT, credit), account) if credit else None, self._top((CREDIT, debit), account) if debit else None]
        best = min((x for x in found if x), default=None)
        if best:
            self.gone.add(best[0])
            return best[1]
        for side, amount in ((DEBIT, debit), (CREDIT, credit)):
            if amount:
                queue = self.queues.setdefault(((side, amount), account), deque())
                if not queue:
                    heapq.heappush(self.heaps.setdefault((side, amount), []), (self.next, account))
                queue.append((self.next, entry))
        self.next += 1
        return None


def exact_pairs(rows: DataFrame, keys: list[str], label: str) -> DataFrame:
    """(keys, e1, e2) of each group (keys, ``label``) of rows (keys, label, entry_no, account, debit, credit)."""
    types = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    cents = lambda c: (F.col(c) * 100).cast("long")
    dealt = (rows.select(*keys, F.to_json(F.struct(*keys, label)).alias("_group"), "entry_no", "account", cents("debit").alias("_d"),
                         cents("credit").alias("_c")).repartition("_group").sortWithinPartitions("_group", "entry_no"))

    def pair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, held = None, Open()
        for batch in batches:
            take, partners = [], []
            columns = [batch.column(c).to_pylist() for c in ("_group", "entry_no", "account", "_d", "_c")]
            for i, (g, entry, account, d, c) in enumerate(zip(*columns)):
                if g != group:
                    group, held = g, Open()
                partner = held.meet(entry, account, d, c)
                if partner is not None:
                    take.append(i)
                    partners.append(partner)
            part = batch.select([*keys, "entry_no"]).take(pa.array(take, pa.int64()))
            yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(partners, pa.int64()), part.columns[-1].cast(pa.int64())],
                                             names=[*keys, "e1", "e2"])

    return dealt.mapInArrow(pair, ", ".join([*(f"`{k}` {types[k]}" for k in keys), "e1 long", "e2 long"]))


def connected_amounts(two_sided: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, _amt, _part): the amounts that two-sided entries tie together within a group, by the least of them.

    Entries of amounts in different parts can never meet, so a part is paired by itself. Distinct pairs of amounts only, grouped
    and sorted; a task joins those of one group at a time.
    """
    types = {f.name: f.dataType.simpleString() for f in two_sided.schema.fields}
    cents = lambda c: (c * 100).cast("long")
    low, high = F.least("debit", "credit"), F.greatest("debit", "credit")
    dealt = (two_sided.select(*keys, F.to_json(F.struct(*keys)).alias("_group"), cents(low).alias("_lo"), cents(high).alias("_hi")).distinct()
             .repartition("_group").sortWithinPartitions("_group"))

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, at, parent = None, None, {}

        def root(x):
            while parent[x] != x:
                parent[x] = parent[parent[x]]
                x = parent[x]
            return x

        def out() -> pa.RecordBatch:
            amounts = list(parent)
            repeated = at.take(pa.array([0] * len(amounts), pa.int64()))
            return pa.RecordBatch.from_arrays([*repeated.columns, pa.array(amounts, pa.int64()), pa.array([root(x) for x in amounts], pa.int64())],
                                              names=[*keys, "_cents", "_part"])

        for batch in batches:
            for i, (g, lo, hi) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("_group", "_lo", "_hi")))):
                if g != group:
                    if parent:
                        yield out()
                    group, at, parent = g, batch.select(keys).slice(i, 1), {}
                for x in (lo, hi):
                    parent.setdefault(x, x)
                a, b = root(lo), root(hi)
                parent[max(a, b)] = min(a, b)
        if parent:
            yield out()

    joined = dealt.mapInArrow(join, ", ".join([*(f"`{k}` {types[k]}" for k in keys), "_cents long", "_part long"]))
    return joined.withColumn("_amt", (F.col("_cents").cast("decimal(20,2)") / 100).cast("decimal(18,2)")).drop("_cents")
