"""Dual-tree search against exhaustive scoring."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from costwise.llm import ranked, tables

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
FOLD = str.maketrans(ranked.UPPER, ranked.LOWER)


def split(text):
    return TERM.findall((text or "").translate(FOLD))


def brute(docs, items, k):
    bags = [(i, Counter(split(t))) for i, t in docs]
    lens = [sum(b.values()) for _, b in bags]
    total, length = sum(n > 0 for n in lens), sum(lens)
    df = Counter(t for _, b in bags for t in b)
    out = []
    for item, text in items:
        w = {t: math.floor(1000 * math.log((2.0 * total + 2) / (2 * df[t] + 1))) for t in set(split(text)) if df[t]}
        scores = []
        for (doc, bag), n in zip(bags, lens):
            if n:
                m = 50 + (50 * n * total) // length
                s = sum(v * ((10 ** 9 * bag[t]) // (1000 * bag[t] + 20 * m)) for t, v in w.items() if t in bag)
                if s > 0:
                    scores.append((-s, doc is None, doc or 0, n))
        out += [(item, r, None if null else doc, -s) for r, (s, null, doc, _) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=str)


def corpus(rng, n, words):
    pick = lambda: words[min(int(rng.expovariate(0.02)), len(words) - 1)]
    return [" ".join(pick() for _ in range(rng.randint(1, 60))) for _ in range(n)]


@pytest.fixture(scope="module")
def data(spark):
    tables.importable(spark)
    rng = random.Random(5)
    words = sorted({"".join(rng.choice("abcdeéFGñ1") for _ in range(rng.randint(1, 7))) for _ in range(600)})
    docs = list(enumerate(corpus(rng, 900, words))) + [(5000, None), (5001, ""), (5002, " .,;"), (None, words[3]), (None, words[4] + " " + words[3])]
    docs += [docs[10]] * 3 + [(7000 + i, docs[11][1]) for i in range(80)] + [(9000, " ".join(words) * 30)]
    items = list(enumerate(corpus(rng, 40, words))) + [(100, None), (101, "?!"), (102, "unknownterm"), (103, docs[11][1]), (104, words[3])]
    return docs, items


def search(spark, docs, items, k=50):
    d = spark.createDataFrame(docs, "doc_id long, text string").withColumn("n", F.lit("old")).withColumn("score", F.lit("old"))
    i = spark.createDataFrame(items, "item_id long, text string").withColumn("item", F.lit("old")).withColumn("rank", F.lit("old"))
    return sorted((tuple(r) for r in ranked.top_documents(d.repartition(5), i, k).collect()), key=str)


@pytest.mark.parametrize("k", [1, 7, 50])
def test_equals_exhaustive_scoring(spark, data, k):
    docs, items = data
    assert search(spark, docs, items, k) == brute(docs, items, k)


def test_blocks_of_items_change_nothing(spark, data, monkeypatch):
    docs, items = data
    want = brute(docs, items, 9)
    monkeypatch.setattr(ranked, "BLOCK_ITEMS", 16)
    monkeypatch.setattr(ranked, "BLOCK_TERMS", 150)
    monkeypatch.setattr(ranked, "CELLS", 20_000)
    assert search(spark, docs, items, 9) == want


def test_empty_tables(spark):
    tables.importable(spark)
    assert search(spark, [], [(1, "a b")]) == [] and search(spark, [(1, "a")], []) == [] and search(spark, [(1, None)], [(1, "a")]) == []


def test_bounds_hold_and_prune():
    rng = np.random.default_rng(3)
    terms = 300
    topic = rng.integers(0, 12, 2048)
    impacts = np.zeros((2048, terms))
    for row, t in enumerate(topic):  # documents of a topic share its terms
        at = rng.choice(np.arange(t * 25, t * 25 + 25), 12, replace=False)
        impacts[row, at] = rng.integers(1, 1000, 12)
    items = [[(int(t), float(rng.integers(1, 100))) for t in rng.choice(np.arange(g * 25, g * 25 + 25), 8, replace=False)] for g in range(12) for _ in range(4)]
    block = ranked.Block([str(i) for i in range(terms)], items, np.zeros(len(items)), 5)
    keys = [(False, i, 0) for i in range(len(impacts))]
    for at in range(0, len(impacts), 512):
        block.meet(impacts[at:at + 512], keys[at:at + 512])
    weights = np.zeros((len(items), terms))
    for i, row in enumerate(items):
        for t, w in row:
            weights[i, t] = w
    scores = impacts @ weights.T
    for i in range(len(items)):
        want = sorted((-int(s), keys[d]) for d, s in enumerate(scores[:, i]) if s > 0)[:5]
        assert block.best[i] == want
    assert block.scored < 0.25 * scores.size, "whole batches are pruned"
