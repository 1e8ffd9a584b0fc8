"""Ranked lexical search by a dual tree: the k best documents for each item, exactly.

Documents become rows of term impacts, items rows of term weights; a score is the sum over an item's terms of weight
times impact. A hierarchy over the documents of a batch (``FANS``) and one over the items of a block (``ITEM_FAN``) hold the
greatest coordinate of what is below each node. The product of an item node's weights and a document node's impacts
bounds every score below the pair, so the pair goes, whole, when that bound is under the weakest k-th score of
its items; else it is opened. All products are whole numbers below 2**53, so float arithmetic is exact.

Work: texts are read once and become (doc_id, n, terms, tfs) of the terms that a bitmap of the items' terms lets through
(``BITS`` bits, whatever the items; false positives only cost space). Frequencies, counts and lengths are grouped sums
over all documents. Items go in blocks of at most ``BLOCK_ITEMS`` items and ``BLOCK_TERMS`` distinct terms (one item may have
more; batches then hold fewer documents); each block passes once over the vectors. Floors from a hashed part of the
documents (one in ``PROBE``) let the pass prune from its start; the k-th score of a part never exceeds that of all, so they cost
no result. A task returns at most k documents an item and a window picks k among those.

Scores hold for the whole table, ties go by ascending id (null ids last, equal rows by length). Edge cases: null and empty
texts have no term, count in neither N nor L and are found by no item; an item without a term finds nothing; repeated rows
are ranked one by one; an empty table of documents or of items gives no rows; other columns are not read, so no name clashes;
long texts are counted whole, and a term of any length is one term.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import textvec
from .sharding import number_rows
from .tables import documents, materialize, read

TERM = "[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
K = 50
#: Percent of length normalisation and the saturation of counts.
NORM, SATURATION = 50, 20
BITS = 1 << 23
BLOCK_ITEMS, BLOCK_TERMS = 1024, 8192
#: Children of document nodes from the root down, and items of an item node.
FANS, ITEM_FAN = (16, 8, 8), 8
#: Float cells of a batch of documents.
CELLS = 1 << 22
#: One document in so many gives the first floors.
PROBE = 32

_BREAK = np.ones(256, dtype=bool)
for _low, _high in ((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF)):
    _BREAK[_low:_high + 1] = False
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[0x41:0x5B] += 0x20


# --- term vectors ----------------------------------------------------------------------------------------------------

def _terms(column) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Folded bytes of a text column and (document, start, end) of its terms."""
    buf, off = textvec.raw(column)
    buf = _FOLD[buf]
    ink = np.concatenate(([False], ~_BREAK[buf], [False]))
    first = np.zeros(len(buf) + 1, dtype=bool)
    first[off] = True
    start = np.flatnonzero(ink[1:-1] & (~ink[:-2] | first[:-1]))
    end = np.flatnonzero(ink[1:-1] & (~ink[2:] | first[1:])) + 1
    return buf, np.searchsorted(off, start, side="right") - 1, start, end


def _hashes(buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    return textvec.ranges(textvec.prefix(buf), start, end)


def _strings(buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.Array:
    """The byte ranges as strings."""
    size = end - start
    to = np.concatenate(([0], np.cumsum(size))).astype(np.int64)
    take = np.arange(to[-1]) - np.repeat(to[:-1] - start, size)
    return pa.LargeStringArray.from_buffers(len(start), pa.py_buffer(to), pa.py_buffer(buf[take])).cast(pa.string())


def term_bitmap(items: DataFrame) -> np.ndarray:
    """``BITS`` bits in bytes, set for the terms of ``items`` (text). The parts that come to the driver are distinct
    bit numbers, at most ``BITS``."""
    def bits(batches):
        for batch in batches:
            for part in textvec.pieces(batch, "text"):
                buf, _, start, end = _terms(part.column("text"))
                at = np.unique(_hashes(buf, start, end) % np.uint64(BITS)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(at)], names=["bit"])

    rows = items.select("text").mapInArrow(bits, "bit long").distinct().toArrow()
    on = np.zeros(BITS, dtype=bool)
    on[rows.column("bit").to_numpy()] = True
    return np.packbits(on)


def vectors(docs: DataFrame, bitmap: np.ndarray | None = None) -> DataFrame:
    """(doc_id, n, terms, tfs) of ``docs`` (doc_id, text): all terms counted in n, those of ``bitmap`` listed."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def count(batches):
        on = None if bitmap is None else np.unpackbits(bitmap).view(bool)
        for batch in batches:
            for part in textvec.pieces(batch, "text"):
                buf, doc, start, end = _terms(part.column("text"))
                n = np.bincount(doc, minlength=part.num_rows)
                h = _hashes(buf, start, end)
                if on is not None:
                    keep = on[(h % np.uint64(BITS)).astype(np.int64)]
                    doc, start, end, h = doc[keep], start[keep], end[keep], h[keep]
                words = _strings(buf, start, end).dictionary_encode()  # exact: terms are told apart by their bytes
                code = words.indices.to_numpy(zero_copy_only=False).astype(np.int64)
                pair, tf = np.unique(doc * max(len(words.dictionary), 1) + code, return_counts=True)
                owner, code = np.divmod(pair, max(len(words.dictionary), 1))
                off = pa.array(np.searchsorted(owner, np.arange(part.num_rows + 1)).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(n.astype(np.int64)),
                     pa.ListArray.from_arrays(off, words.dictionary.take(pa.array(code))),
                     pa.ListArray.from_arrays(off, pa.array(tf.astype(np.int64)))], names=["doc_id", "n", "terms", "tfs"])

    return docs.select("doc_id", "text").mapInArrow(count, f"doc_id {kind}, n long, terms array<string>, tfs array<long>")


# --- trees -----------------------------------------------------------------------------------------------------------

def _order(matrix: np.ndarray) -> np.ndarray:
    """Rows ordered by their greatest coordinates, so that neighbours share them."""
    if not matrix.shape[1]:
        return np.arange(len(matrix))
    top = min(3, matrix.shape[1])
    part = np.argpartition(-matrix, top - 1, axis=1)[:, :top]
    rank = np.argsort(-np.take_along_axis(matrix, part, axis=1), axis=1, kind="stable")
    return np.lexsort(np.take_along_axis(part, rank, axis=1).T[::-1])


def _levels(leaves: np.ndarray, fans: tuple[int, ...]) -> list[np.ndarray]:
    """Coordinate maxima of a hierarchy over rows: the leaves last, each level before it by ``fans`` children."""
    out = [leaves]
    for fan in fans:
        below = out[0]
        out.insert(0, np.maximum.reduceat(below, np.arange(0, len(below), fan), axis=0) if len(below) else below)
    return out


class Block:
    """The item side: weights of a block's items over its terms, its nodes, floors and the best so far."""

    def __init__(self, vocabulary: list[str], rows: list[list[tuple[int, float]]], floors: np.ndarray, k: int):
        self.k, self.floors = k, floors.astype(np.float64)
        self.vocabulary = pa.array(vocabulary, pa.string())
        weights = np.zeros((len(rows), len(vocabulary)))
        for i, row in enumerate(rows):
            for term, weight in row:
                weights[i, term] = weight
        order = _order(weights)
        self.nodes = []
        for at in range(0, len(order), ITEM_FAN):
            members = order[at:at + ITEM_FAN]
            terms = np.flatnonzero(weights[members].max(axis=0) > 0)
            if len(terms):
                own = weights[np.ix_(members, terms)]
                self.nodes.append((members, terms, own, own.max(axis=0)))
        #: Upper item nodes over the same terms: whole groups of nodes fall to one bound.
        self.groups = []
        for at in range(0, len(self.nodes), ITEM_FAN):
            below = self.nodes[at:at + ITEM_FAN]
            top = np.zeros(len(vocabulary))
            for _, terms, _, most in below:
                top[terms] = np.maximum(top[terms], most)
            terms = np.flatnonzero(top)
            self.groups.append((below, terms, top[terms], np.concatenate([b[0] for b in below])))
        self.best = [[] for _ in rows]
        self.opened = self.scored = 0

    def _least(self, members: np.ndarray) -> float:
        """A pair below this score is of no use: a score must exceed 0 and reach some item's k-th one."""
        return max(self.floors[members].min(), 1.0)

    def meet(self, impacts: np.ndarray, keys: list) -> None:
        """Scores a batch: ``impacts`` by document and term; ``keys`` of the documents, least first among equal scores."""
        order = _order(impacts)
        impacts = impacts[order]
        levels = _levels(impacts, FANS[::-1])
        fans = (None, *FANS)
        for below, terms, top, members in self.groups:
            roots = np.flatnonzero(levels[0][:, terms] @ top >= self._least(members))
            if not len(roots):
                continue
            for node, own_terms, own, most in below:
                alive = roots
                for level, matrix in enumerate(levels):
                    if level:  # open the document nodes that are left
                        alive = (alive[:, None] * fans[level] + np.arange(fans[level])).ravel()
                        alive = alive[alive < len(matrix)]
                    if level < len(levels) - 1:
                        alive = alive[matrix[np.ix_(alive, own_terms)] @ most >= self._least(node)]
                        self.opened += len(alive)
                    if not len(alive):
                        break
                else:
                    scores = impacts[np.ix_(alive, own_terms)] @ own.T
                    self.scored += scores.size
                    for column, item in enumerate(node):
                        hit = np.flatnonzero(scores[:, column] >= max(self.floors[item], 1.0))
                        if len(hit):
                            self._add(item, scores[hit, column], [keys[order[alive[i]]] for i in hit])

    def _add(self, item: int, scores: np.ndarray, keys: list) -> None:
        """Joins found documents to an item's best; its k-th score becomes the floor."""
        best = sorted(self.best[item] + [(-int(s), key) for s, key in zip(scores, keys)])[:self.k]
        self.best[item] = best
        if len(best) == self.k:
            self.floors[item] = max(self.floors[item], float(-best[-1][0]))

    def impacts(self, terms, tfs, n: np.ndarray, total: int, length: int) -> np.ndarray:
        """Batch matrix from list columns: (10**9 tf) div (1000 tf + 20 m), m by the document's length."""
        owner = np.repeat(np.arange(len(n)), np.diff(terms.offsets.to_numpy()))
        code = pc.index_in(terms.flatten(), value_set=self.vocabulary)
        known = code.is_valid().to_numpy(zero_copy_only=False)
        code, tf = code.fill_null(0).to_numpy(zero_copy_only=False), tfs.flatten().to_numpy(zero_copy_only=False)
        m = np.array([100 - NORM + (NORM * int(x) * total) // length for x in n], dtype=np.int64)
        out = np.zeros((len(n), len(self.vocabulary)))
        owner, code, tf = owner[known], code[known], tf[known].astype(np.int64)
        out[owner, code] = (1_000_000_000 * tf) // (1000 * tf + SATURATION * m[owner])
        return out


def _search(vectors_df: DataFrame, vocabulary, rows, item_rows, floors, total: int, length: int, k: int) -> DataFrame:
    """(item, doc_id, n, score): each task's k best documents for the items of one block."""
    kind = vectors_df.schema["doc_id"].dataType
    batch_rows = max(64, CELLS // max(len(vocabulary), 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = Block(vocabulary, rows, floors, k)
        id_type = None
        for batch in batches:
            id_type = batch.schema.field("doc_id").type
            for at in range(0, batch.num_rows, batch_rows):
                part = batch.slice(at, batch_rows)
                n = part.column("n").to_numpy(zero_copy_only=False)
                ids = part.column("doc_id").to_pylist()
                keys = [(i is None, 0 if i is None else i, int(c)) for i, c in zip(ids, n)]
                block.meet(block.impacts(part.column("terms"), part.column("tfs"), n, total, length), keys)
        found = [(item_rows[i], None if key[0] else key[1], key[2], -s) for i, best in enumerate(block.best) for s, key in best]
        if found:
            item, ids, n, score = zip(*found)
            yield pa.RecordBatch.from_arrays([pa.array(item, pa.int64()), pa.array(ids, id_type), pa.array(n, pa.int64()),
                                              pa.array(score, pa.int64())], names=["item", "doc_id", "n", "score"])

    return (vectors_df.select("doc_id", "n", "terms", "tfs")
            .mapInArrow(run, f"item long, doc_id {kind.simpleString()}, n long, score long"))


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last(), "n")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


# --- items -----------------------------------------------------------------------------------------------------------

def _blocks(items: DataFrame, weights: DataFrame) -> DataFrame:
    """(block, item, item_id, terms, weights): numbered items by terms that some document holds, in blocks of at most
    ``BLOCK_ITEMS`` items and about ``BLOCK_TERMS`` terms."""
    rows = (items.select("item", "item_id", F.explode("terms").alias("term")).join(weights, "term")
            .groupBy("item", "item_id").agg(F.sort_array(F.collect_list(F.struct("term", "weight"))).alias("held")))
    # items are dealt to slices of BLOCK_ITEMS by number; a slice is cut where its terms pass a multiple of the bound
    rows = rows.withColumn("slice", F.floor(F.col("item") / BLOCK_ITEMS))
    before = F.sum(F.size("held")).over(Window.partitionBy("slice").orderBy("item").rowsBetween(Window.unboundedPreceding, -1))
    return rows.withColumn("part", F.floor(F.coalesce(before, F.lit(0)) / BLOCK_TERMS))


def top_documents(docs: DataFrame, items: DataFrame, k: int = K) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` best of ``docs`` (doc_id, text) for each row of ``items`` (item_id, text)."""
    spark = docs.sparkSession
    # equal rows of items stay apart by a number; the table is written so that a number stays with its row
    numbered, _ = number_rows(items.select("item_id", "text"), ["item_id", "text"], "item")
    numbered = materialize(numbered, "ranked-items")
    known = vectors(numbered.select(F.col("item").alias("doc_id"), "text")).select(F.col("doc_id").alias("item"), "terms")
    known = known.join(numbered.select("item", "item_id"), "item")
    table = materialize(vectors(docs, term_bitmap(numbered)), "ranked-vectors")
    total, length = table.agg(F.count(F.when(F.col("n") > 0, 1)), F.sum("n")).first()
    result = "item_id {}, rank int, doc_id {}, score long".format(
        items.schema["item_id"].dataType.simpleString(), docs.schema["doc_id"].dataType.simpleString())
    if not total:
        return spark.createDataFrame([], result)
    df = table.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    weight = F.floor(1000 * F.log(F.lit(2.0 * total + 2) / (2 * F.col("df") + 1)))
    rows = materialize(_blocks(known, df.select("term", weight.cast("long").alias("weight")).filter("weight > 0")), "ranked-blocks")
    parts = []
    for s, p in sorted((r[0], r[1]) for r in rows.select("slice", "part").distinct().collect()):
        held = rows.filter((F.col("slice") == s) & (F.col("part") == p)).select("item", "held").collect()
        vocabulary = sorted({t.term for r in held for t in r.held})
        number = {t: i for i, t in enumerate(vocabulary)}
        lists = [[(number[t.term], float(t.weight)) for t in r.held] for r in held]
        item_rows = [r.item for r in held]
        place = {item: i for i, item in enumerate(item_rows)}
        seen = table.filter("n > 0")
        probe = seen.filter(F.pmod(F.xxhash64("doc_id", "n"), F.lit(PROBE)) == 0)
        floors = np.zeros(len(held))
        weakest = _best(_search(probe, vocabulary, lists, item_rows, floors, total, length, k), k).filter(F.col("rank") == k)
        for r in weakest.select("item", "score").collect():
            floors[place[r.item]] = r.score
        parts.append(_best(_search(seen, vocabulary, lists, item_rows, floors, total, length, k), k))
    if not parts:
        return spark.createDataFrame([], result)
    out = parts[0]
    for more in parts[1:]:
        out = out.unionByName(more)
    return out.join(numbered.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")


def op13_ranked_search(spark, sf_dir: str) -> DataFrame:
    return top_documents(documents(spark, sf_dir).select("doc_id", "text"),
                         read(spark, sf_dir, "benchmark").select("item_id", "text"))


_SPLIT = "regexp_extract_all(translate(text, '{}', '{}'), '{}')".format(UPPER, LOWER, TERM)

#: The formula over joined terms, without bounds.
ORACLE = f"""
with d as (select row_number() over () row_no, doc_id, {_SPLIT} terms from documents where text is not null),
lens as (select row_no, doc_id, len(terms)::bigint n from d where len(terms) > 0),
whole as (select count(*)::bigint docs, sum(n)::bigint words from lens),
occurs as (select row_no, unnest(terms) term from d),
counted as (select row_no, term, count(*)::bigint tf from occurs group by row_no, term),
weighed as (select term, floor(1000 * ln((2 * docs + 2)::double / (2 * count(*) + 1)))::bigint w from counted, whole group by term, docs),
asked as (select distinct item_id, unnest({_SPLIT}) term from benchmark),
scored as (
  select item_id, doc_id, row_no,
         sum(w * ((1000000000 * tf) // (1000 * tf + {SATURATION} * (100 - {NORM} + ({NORM} * n * docs) // words))))::bigint score
  from asked join weighed using (term) join counted using (term) join lens using (row_no) cross join whole group by item_id, doc_id, row_no),
placed as (select item_id, doc_id, score, row_number() over (partition by item_id order by score desc, doc_id, row_no) rank from scored where score > 0)
select item_id, rank::int rank, doc_id, score from placed where rank <= {K}
"""
