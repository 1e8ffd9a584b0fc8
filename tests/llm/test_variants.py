"""Spelling variants: the composition against brute force, split windows, odd rows."""

import itertools
import random

import pyarrow as pa
from pyspark.sql import functions as F

from costwise.llm import tables, variants


def one_edit(a: str, b: str) -> bool:
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def words_of(rng, n, alphabet, low, high):
    return sorted({"".join(rng.choice(alphabet) for _ in range(rng.randint(low, high))) for _ in range(n)})


def brute(words):
    return {(a, b) for a, b in itertools.permutations(words, 2) if one_edit(a, b)}


def pairs(spark, words, **limits):
    df = spark.createDataFrame([(w, i + 5) for i, w in enumerate(words)], "word string, n long")
    rows = [(r.word, r.near, r.near_n) for r in variants.near_pairs(df, **limits).collect()]
    assert len(rows) == len(set(rows)), "a pair was found twice"
    number = {w: i + 5 for i, w in enumerate(words)}
    assert all(number[b] == n for _, b, n in rows)
    return {(a, b) for a, b, _ in rows}


def test_pairs_of_dense_words_are_those_of_brute_force(spark):
    tables.importable(spark)
    words = words_of(random.Random(1), 700, "abé", 6, 9) + ["aaaaaa", "aaaaaaa", "aaaaaaaa", "ababababab", "bababababa", "babababababa"]
    words = sorted(set(words))
    assert pairs(spark, words) == brute(words)


def test_states_split_down_to_single_places_lose_nothing(spark):
    tables.importable(spark)
    words = sorted({"shared" + w for w in words_of(random.Random(2), 400, "abc", 0, 5)} | {w + "endings" for w in words_of(random.Random(3), 200, "abc", 0, 4)})
    assert pairs(spark, words, group_words=3) == brute(words)
    states = variants.initial_states(spark.createDataFrame([(w, 5) for w in words], "word string, n long"), 3)
    large = states.groupBy("state", "lo", "hi").count().filter("count > 3 and hi - lo > 1")
    assert large.count() == 0


def test_long_words_are_not_a_matter_of_recursion(spark):
    tables.importable(spark)
    a, b = "a" * 30_000, "ab" * 15_000
    words = sorted([a, a + "a", b, b[:20_000] + "c" + b[20_000:], b[:-1] + "c", "x" + b])
    assert pairs(spark, words) == brute(words)


def test_acceptor_is_minimal_and_numbers_its_words():
    acceptor = variants.Acceptor()
    words = sorted(["tap", "taps", "top", "tops"])
    start = acceptor.add(words)
    assert acceptor.count[start] == 4 and len(acceptor.arcs) == 5
    assert acceptor.common(start, start) == [(i, i) for i in range(4)]


def test_chunks_of_states_across_batches():
    rows = [("s1", 3, 0, 4, w, 7) for w in ("abc", "abd", "abcd")] + [("s2", 3, 0, 4, "abx", 9)]
    columns = list(zip(*rows))
    whole = pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["state", "cls", "lo", "hi", "word", "n"])
    for cut in (1, 2, 3):
        out = [t for b in variants._enumerate(iter([whole.slice(0, cut), whole.slice(cut)])) for t in zip(*b.to_pydict().values())]
        assert sorted(out) == sorted(t for a, b in (("abc", "abd"), ("abc", "abcd"), ("abd", "abcd")) for t in ((a, b, 7), (b, a, 7)))


def test_odd_rows(spark):
    tables.importable(spark)
    docs = spark.createDataFrame(
        [(1, None), (2, ""), (None, "Straße straße STRASSE"), (None, "Straße straße STRASSE"), (4, "cooperate " * 40), (5, "cooperatte " * 6), (6, "123 !! \n")],
        "doc_id long, text string").withColumn("n", F.lit("old")).withColumn("word", F.lit("old")).withColumn("run", F.lit("old"))
    got = {r.word: r for r in variants.variants(docs).collect()}
    assert {"cooperate", "cooperatte"} <= set(got)
    near = got["cooperatte"]
    assert near.form == near.root == "cooperate" and near.n_near >= 1 and near.form_n == got["cooperate"].n
    assert got["cooperate"].form is None and got["cooperate"].root == "cooperate"
    assert variants.variants(docs.limit(0)).count() == 0


def test_forms_are_followed_to_the_last(spark):
    tables.importable(spark)
    # counts 5, 25, 125: each is the form of the one before; the ids are chosen by no checksum rule, so use many rows
    words = ["letterx", "lettersx", "lettersxy"]
    texts = [(i, w) for w, n in zip(words, (6, 40, 300)) for i in range(n)]
    got = {r.word: r for r in variants.variants(spark.createDataFrame(texts, "doc_id long, text string")).collect()}
    assert got["letterx"].root == got["lettersx"].root == "lettersxy" and got["letterx"].form == "lettersx"
