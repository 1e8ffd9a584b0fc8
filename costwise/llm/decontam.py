"""Benchmark decontamination: BM25 over an inverted index of test items with block-max WAND.

Every text is cut into overlapping passages (twice the longest item, half overlapping, so that a copy of an
item lies wholly in one), and every passage is a query against the index of the items. An item's score
is its BM25 score divided by the score of a query that holds all its terms, so 1 is
a full match; all items at ``THRESHOLD`` or more are retrieved. Postings are in item order with the
largest impact for each block of items. A passage is skipped if for no group of blocks the
largest impacts of its terms add up to the threshold; otherwise block-max WAND runs over the
postings of its terms in the groups that are left. Neither step loses an item. A retrieved item counts if the
passage holds at least ``OVERLAP`` of the three-word sequences of its question and of its answer. Items of one
text have no answer and are compared whole.

Document frequencies, the number of items, their mean length and the longest one are grouped sums over all items. Shards of
``SHARD_ITEMS`` items split the postings only: scores and windows are the same for any number of shards. A shard's index
is sent to the tasks whole (its size does not depend on the documents); all texts run against every shard, one shard after the other, and
each one's rows are written before the next index is built.

Edge cases: null and empty texts have no passages; items without words are never found; equal items
are found each; an item with too few words for a sequence is compared by all its words; a null
question or answer counts as held; repeated rows give equal rows; empty tables give no rows.
"""

from __future__ import annotations

import string
from bisect import bisect_left
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .tables import documents, materialize, read
from .textvec import pieces

THRESHOLD, OVERLAP, GRAM, SHARD_ITEMS, BLOCK, GROUPS = 0.6, 0.5, 3, 20000, 8, 32
K1, B = 1.2, 0.75
#: Marks that are taken off the ends of words.
MARKS = string.punctuation + "\u00a1\u00bf\u00ab\u00bb\u2018\u2019\u201c\u201d\u2026\u2013\u2014"
MEMO = 500_000


def plain(word: str) -> str:
    """A word in lower case without marks at its ends (empty if it has nothing else)."""
    return word.lower().strip(MARKS)


def tokens(text: str | None) -> list[str]:
    return list(map(plain, (text or "").split()))


class Lookup(dict):
    """Term numbers by raw word, -1 for others; a memo of bounded size."""

    def __init__(self, vocab: dict[str, int]):
        self.vocab = vocab

    def __missing__(self, word: str) -> int:
        if len(self) > MEMO:
            self.clear()
        found = self[word] = self.vocab.get(plain(word), -1)
        return found


def grams(ids: list) -> set:
    n = min(GRAM, len(ids))
    return {tuple(ids[i:i + n]) for i in range(len(ids) - n + 1)} if n else set()


class Index:
    """Inverted index of items (item key, question tokens, answer tokens), with the statistics of all items (their number,
    mean and greatest length, items by term) or, without these, of its own."""

    def __init__(self, items: list[tuple], whole: tuple[int, float, int, dict[str, int]] | None = None):
        items = [x for x in items if any(x[1]) or any(x[2])]
        self.keys = [x[0] for x in items]
        self.question, self.answer = [x[1] for x in items], [x[2] for x in items]
        texts = [q + a for q, a in zip(self.question, self.answer)]
        self.window = 2 * (whole[2] if whole else max([len(t) for t in texts], default=1))
        self.vocab = {w: i for i, w in enumerate(sorted({w for t in texts for w in t} - {""}))}
        self.lookup = Lookup(self.vocab)
        n, v = len(texts), len(self.vocab)
        mean = whole[1] if whole else sum(map(len, texts)) / max(n, 1)
        rows = []
        for d, t in enumerate(texts):
            term, tf = np.unique([self.vocab[w] for w in t if w], return_counts=True)
            rows.append((np.full(len(term), d), term.astype(int), tf * (K1 + 1) / (tf + K1 * (1 - B + B * len(t) / mean))))
        item, term, weight = (np.concatenate([r[j] for r in rows]) if rows else np.zeros(0, dtype=int) for j in range(3))
        df = np.array([whole[3][w] for w in self.vocab], dtype=float) if whole else np.bincount(term, minlength=v)
        impact = weight * np.log1p(((whole[0] if whole else n) - df + 0.5) / (df + 0.5))[term]
        impact = impact / np.bincount(item, weights=impact, minlength=n)[item] if n else impact
        # the largest impact of each term in each block of items, and in each group of blocks
        blocks = max(1, -(-n // BLOCK))
        self.per_group = -(-blocks // GROUPS) * BLOCK
        groups = max(1, -(-n // self.per_group))
        self.group_max = np.zeros((v, groups), dtype=np.float32)
        np.maximum.at(self.group_max, (term, item // self.per_group), impact.astype(np.float32))
        self.block_max: dict[tuple[int, int], float] = {}
        lists: dict[tuple[int, int], tuple[list, list]] = {}
        for t, d, x in zip(term.tolist(), item.tolist(), impact.tolist()):  # in item order
            at = (t, d // BLOCK)
            self.block_max[at] = max(self.block_max.get(at, 0.0), x)
            own = lists.setdefault((t, d // self.per_group), ([], []))
            own[0].append(d)
            own[1].append(x)
        self.postings = {at: (i, x, max(x)) for at, (i, x) in lists.items()}
        self.q_grams, self.a_grams = [grams(q) for q in self.question], [grams(a) for a in self.answer]

    def wand(self, terms: list[int], group: int, threshold: float) -> list[tuple[int, float]]:
        """All items of a group of blocks with a score of at least ``threshold``, by block-max WAND."""
        cursors = []  # [current item, position, items, impacts, largest impact, term]
        for t in terms:
            have = self.postings.get((t, group))
            if have:
                cursors.append([have[0][0], 0, *have, t])
        out, slack = [], threshold - 1e-9
        cursors.sort(key=itemgetter(0))
        while cursors:
            total, pivot = 0.0, -1
            for i, c in enumerate(cursors):
                total += c[4]
                if total >= slack:
                    pivot = i
                    break
            if pivot < 0:
                break
            item = cursors[pivot][0]
            while pivot + 1 < len(cursors) and cursors[pivot + 1][0] == item:
                pivot += 1
            front, block = cursors[: pivot + 1], item // BLOCK
            bound = 0.0
            for c in front:
                bound += self.block_max.get((c[5], block), 0.0)
            if bound < slack:
                # nothing in this block before the next cursor can reach the threshold
                target = (block + 1) * BLOCK
                if pivot + 1 < len(cursors):
                    target = min(target, cursors[pivot + 1][0])
                target = max(target, item + 1)
            elif front[0][0] == item:
                score = sum(c[3][c[1]] for c in front)
                if score >= slack:
                    out.append((item, score))
                target = item + 1
            else:
                target = item
            for c in front:
                if c[0] < target:
                    c[1] = bisect_left(c[2], target, c[1])
                    c[0] = c[2][c[1]] if c[1] < len(c[2]) else -1
            cursors = [c for c in cursors if c[0] >= 0]
            cursors.sort(key=itemgetter(0))
        return out

    def search(self, text: str | None, threshold: float, overlap: float) -> dict[int, tuple[float, float, float, int]]:
        """Best (score, question overlap, answer overlap) and number of passages by item found in a text."""
        words = (text or "").split()
        ids = np.fromiter(map(self.lookup.__getitem__, words), dtype=np.int32, count=len(words))
        at = np.flatnonzero(ids >= 0)
        if not len(at):
            return {}
        half, v = self.window // 2, len(self.vocab)
        # a word in half-window h lies in the passages h - 1 and h; passage p spans half-windows p and p + 1
        h = at // half
        last = max(0, (len(words) - 1) // half - 1)
        small = np.int32 if (last + 2) * v < 2**31 else np.int64
        key = np.unique(np.concatenate((np.minimum(h, last), np.maximum(h - 1, 0))).astype(small) * small(v)
                        + np.tile(ids[at], 2).astype(small))
        passage, term = key // v, key % v
        begin = np.flatnonzero(np.concatenate(([True], passage[1:] != passage[:-1])))
        bound = np.add.reduceat(self.group_max[term], begin, axis=0)
        found: dict[int, tuple[float, float, float, int]] = {}
        end = np.append(begin[1:], len(key))
        hits = np.argwhere(bound >= threshold - 1e-4)
        for row, group in hits.tolist():
            p = int(passage[begin[row]])
            for item, score in self.wand(term[begin[row]: end[row]].tolist(), group, threshold):
                have = grams3(list(map(plain, words[p * half: p * half + self.window])))
                q, a = (1.0 if not g else sum(x in have[len(next(iter(g)))] for x in g) / len(g)
                        for g in (self.q_grams[item], self.a_grams[item]))
                if q >= overlap and a >= overlap:
                    best = found.get(item, (0.0, 0.0, 0.0, 0))
                    found[item] = max(best[:3], (score, q, a)) + (best[3] + 1,)
        return found


def grams3(words: list[str]) -> dict[int, set]:
    """All word sequences of a passage by length, up to GRAM words."""
    return {n: {tuple(words[i:i + n]) for i in range(len(words) - n + 1)} for n in range(1, GRAM + 1)}


def item_terms(items: DataFrame, question: str, answer: str) -> DataFrame:
    """(shard_key, length, terms) of items with words: their number of words and distinct ones."""
    def run(batches):
        for b in batches:
            rows = []
            for h, q, a in zip(b.column("h").to_pylist(), b.column("q").to_pylist(), b.column("a").to_pylist()):
                t = tokens(q) + tokens(a)
                if any(t):
                    rows.append((h, len(t), sorted(set(t) - {""})))
            h, n, terms = zip(*rows) if rows else ([], [], [])
            yield pa.RecordBatch.from_arrays([pa.array(h, pa.int64()), pa.array(n, pa.int64()), pa.array(terms, pa.list_(pa.string()))],
                                             names=["shard_key", "length", "terms"])

    return items.select(F.xxhash64(F.col(question), F.col(answer)).alias("h"), F.col(question).alias("q"), F.col(answer).alias("a")).mapInArrow(
        run, "shard_key long, length long, terms array<string>")


def find_leaks(df: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id",
               question: str = "question", answer: str = "answer", threshold: float = THRESHOLD,
               overlap: float = OVERLAP) -> DataFrame:
    """(key, item, score, question_overlap, answer_overlap, passages): one row for each text and item found in it."""
    key_type, item_type = df.schema[key].dataType, items.schema[item].dataType
    schema = T.StructType([T.StructField(key, key_type), T.StructField(item, item_type), *T._parse_datatype_string(
        "score double, question_overlap double, answer_overlap double, passages long").fields])
    spelled = materialize(item_terms(items, question, answer), "leak-terms")
    n, length, longest = spelled.agg(F.count(F.lit(1)), F.sum("length"), F.max("length")).first()
    if not n:
        return df.sparkSession.createDataFrame([], schema)
    held = spelled.select("shard_key", F.explode("terms").alias("term"))
    by_term = materialize(held.groupBy("term").agg(F.count(F.lit(1)).alias("n")), "leak-df")
    shards = max(1, -(-n // SHARD_ITEMS))
    shard = F.pmod(F.xxhash64(F.col(question), F.col(answer)), F.lit(shards))
    out = None
    for s in range(shards):
        rows = items.filter(shard == s).select(item, question, answer).orderBy(item, question, answer).collect()
        own = held.filter(F.pmod(F.col("shard_key"), F.lit(shards)) == s).select("term").distinct()
        counts = {r.term: r.n for r in by_term.join(own, "term", "left_semi").collect()}
        index = Index([(r[0], tokens(r[1]), tokens(r[2])) for r in rows], (n, length / n, longest, counts))

        def run(batches, index=index):
            for whole in batches:
                for b in pieces(whole, text):
                    rows = [(k, index.keys[i], *x) for k, t in zip(b.column(key).to_pylist(), b.column(text).to_pylist())
                            for i, x in sorted(index.search(t, threshold, overlap).items())]
                    cols = list(zip(*rows)) if rows else [[]] * len(schema)
                    yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(cols, types)], names=schema.names)

        from pyspark.sql.pandas.types import to_arrow_type
        types = [to_arrow_type(f.dataType) for f in schema.fields]
        part = df.select(key, text).mapInArrow(run, schema)
        part = part if shards == 1 else materialize(part, "leaks")
        out = part if out is None else out.unionByName(part)
    return out


def split_items(items: DataFrame, text: str = "text") -> DataFrame:
    """Question and answer of items: their own columns, or for items of one text the whole text as the question
    and no answer (a made-up split would ask for a share of a few words)."""
    if {"question", "answer"} <= set(items.columns):
        return items
    return items.withColumn("question", F.col(text)).withColumn("answer", F.lit(None).cast("string"))


def op7_decontamination(spark, sf_dir: str) -> DataFrame:
    items = split_items(read(spark, sf_dir, "benchmark")).select("item_id", "question", "answer")
    return find_leaks(documents(spark, sf_dir).select("doc_id", "text"), items)
