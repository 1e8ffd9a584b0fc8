"""Source mix: targets, exact shares, spread of the schedule, whole blocks, odd rows."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from costwise.llm import mixing, tables

DOCS = "doc_id long, text string, source string"


def text(n):
    return " ".join(["w"] * n)


@pytest.fixture(scope="module")
def docs(spark):
    tables.importable(spark)
    rows = [(i, text(1 + i * 7 % 90), "abc"[i % 3] if i % 10 else "big") for i in range(400)]
    rows += [(1000 + i, text(40), "big") for i in range(200)] + [(7, text(12), None)] * 5 + [(None, text(30 + i), "tiny") for i in range(3)]
    return spark.createDataFrame(rows, DOCS).withColumn("size", F.lit("old")).withColumn("slot", F.lit("old")).withColumn("s", F.lit("old"))


def fill(sizes, weights, total):
    """Targets by rounds: what is above a cap goes to the others by weight."""
    capped = {}
    while True:
        rest, w = total - sum(capped.values()), sum(weights[s] for s in sizes if s not in capped)
        share = {s: capped.get(s, rest * weights[s] / w if w else 0) for s in sizes}
        over = [s for s in sizes if s not in capped and share[s] > 2 * sizes[s]]
        if not over:
            return share
        capped |= {s: 2 * sizes[s] for s in over}


def test_targets_are_those_of_resharing_by_rounds(docs):
    rows = mixing.measured(docs)
    got = {r.source: r for r in mixing.targets(rows).collect()}
    sizes = {s: r.source_size for s, r in got.items()}
    order = sorted((s for s in sizes if s is not None)) + [None]
    weights = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    want = fill(sizes, weights, 1.5 * sum(sizes.values()))
    assert all(abs(got[s].target - want[s]) < 1e-6 * max(want[s], 1) for s in want)
    assert got["tiny"].target <= 2 * sizes["tiny"]


def test_each_source_gives_its_target_and_slots_spread_it(docs):
    rows, sources, mix = mixing.mix_sources(docs, block=16)
    pieces = mix.collect()
    taken = Counter()
    for p in pieces:
        assert 0 <= p.from_word < p.to_word and p.to_word - p.from_word <= 16
        taken[p.s] += p.to_word - p.from_word
    table = {r.s: r for r in sources.collect()}
    assert {s: r.wanted for s, r in table.items()} == dict(taken)
    # no prefix of the mix is far from the proportions
    slots = sorted({(p.slot, p.s) for p in pieces})
    total, seen = Counter(s for _, s in slots), Counter()
    for i, (_, s) in enumerate(slots, 1):
        seen[s] += 1
        assert all(abs(seen[k] - i * total[k] / len(slots)) < 8 for k in total)
    # a slot holds one block: its pieces are BLOCK words, but for a source's last
    size = Counter()
    for p in pieces:
        size[p.slot, p.s] += p.to_word - p.from_word
    assert sum(1 for n in size.values() if n != 16) <= len(table)


def test_no_word_is_given_more_than_twice_and_each_epoch_is_whole(docs):
    _, _, mix = mixing.mix_sources(docs, block=16)
    words = Counter()
    for p in mix.collect():
        for w in range(p.from_word, p.to_word):
            words[p.key, p.copy, w] += 1
    assert set(words.values()) <= {1, 2}


def test_points_are_exact_beyond_32_bits(spark):
    got = {r.slot: r.u for r in mixing.points(1000, spark).collect()}
    assert all(u == i * mixing.GOLDEN % 2 ** 32 for i, u in got.items())
    far = spark.range(1).select(F.lit((1 << 40) + 12345).cast("long").alias("id"))
    half = 1 << 31
    u = far.select(F.pmod(F.col("id") % half * mixing.GOLDEN + F.floor(F.col("id") / half) % 2 * half, F.lit(1 << 32))).first()[0]
    assert u == ((1 << 40) + 12345) * mixing.GOLDEN % 2 ** 32


def test_hash_ranges_do_not_change_the_stream(docs, monkeypatch):
    rows = tables.materialize(mixing.measured(docs), "test")
    sources = mixing.targets(rows)
    key = lambda df: sorted((str(r.doc_id), r.key, r.epoch, r.first) for r in df.select("doc_id", "key", "epoch", "first").collect())
    one = key(mixing.streamed(rows, sources))
    monkeypatch.setattr(mixing, "RANGE_ROWS", 9)
    assert key(mixing.streamed(rows, sources)) == one


def test_empty_tables_and_texts(spark):
    tables.importable(spark)
    for rows in ([], [(1, None, "a"), (2, "", None), (3, " \n", "b")]):
        df = spark.createDataFrame(rows, DOCS)
        _, sources, mix = mixing.mix_sources(df)
        assert mix.count() == 0 and sources.count() == len({r[2] for r in rows})
