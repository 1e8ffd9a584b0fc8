"""Training-data operators against SQL, brute force, exact round trips and held-out accuracy."""

import hashlib
import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from costwise.llm import bpe, chat, decontam, langid, near, pu, quality_rules, queries, sharding, suffix, tables, textvec, toxicity
from tools.oracle_check import duck, rows_of

SMALL, SF = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty, very long, tied and repeated rows, with columns whose names clash with outputs."""
    tables.importable(spark)
    long = " ".join(f"w{i % 977}x{i}" for i in range(40000))
    rows = [(1, None, None, None, None), (2, "", "en", "s", 0), (None, "some words of a text without id here", "en", "s", 5),
            (3, long, "en", "s", len(long)), (4, "same words in this text and nothing else at all", "de", "s", 9),
            (5, "same words in this text and nothing else at all", None, "s", 9),
            (5, "same words in this text and nothing else at all", None, "s", 9), (6, "   \n\t ", "en", "s", 5),
            (7, "!!! ??? 12345", "fr", "s", 3), (8, "one", "fr", "s", 3)]
    df = spark.createDataFrame(rows, DOCS)
    for c in ("ids", "score", "kept", "class_id", "removed", "shard", "accepted", "style"):
        df = df.withColumn(c, F.lit("old"))
    return df


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_matches_sql(spark, name):
    df = queries.QUERIES[name](spark, SMALL)
    rel = duck(SMALL).sql(queries.ORACLE_SQL[name])
    columns = rel.columns
    assert sorted(df.columns) == sorted(columns)
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(columns, rel.fetchall())


# --- op1 -------------------------------------------------------------------------------------------------------------

def test_near_duplicates_against_brute_force(spark):
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefg") for _ in range(5))
    texts = []
    for _ in range(12):
        base = [word() for _ in range(rng.randint(60, 200))]
        texts.append(" ".join(base))
        for edits in (1, 1, 2, 3, 8):
            w = list(base)
            for _ in range(edits):
                w[rng.randrange(len(w))] = word()
            texts.append(" ".join(w))
    texts += [texts[0], texts[0], " ".join(reversed(texts[0].split())), "", "", "one two"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    tables.importable(spark)
    got = {r.doc_id: r.class_id for r in near.near_classes(df).collect()}

    def grams(t):
        seen, out, w = {}, [], t.split()
        for i in range(max(1, len(w) - 4) if w else 0):
            g = tuple(w[i:i + 5])
            seen[g] = seen.get(g, -1) + 1
            out.append((g, seen[g]))
        return out

    def common(a, b):
        row = [0] * (len(b) + 1)
        for x in a:
            new = [0]
            for j, y in enumerate(b):
                new.append(row[j] + 1 if x == y else max(row[j + 1], new[-1]))
            row = new
        return row[-1]

    gs, label = [grams(t) for t in texts], list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            linked = texts[i] == texts[j]
            if not linked and gs[i] and gs[j] and len(set(gs[i]) & set(gs[j])) * 2 >= len(gs[i]):
                c = common(gs[i], gs[j])
                linked = c / (len(gs[i]) + len(gs[j]) - c) >= 0.8
            if linked and label[i] != label[j]:
                a, b = sorted((label[i], label[j]))
                label = [a if x == b else x for x in label]
    assert got == dict(enumerate(label))


def test_shards_of_items_change_no_score(spark, monkeypatch):
    docs = tables.read(spark, SMALL, "documents").select("doc_id", "text")
    items = decontam.split_items(tables.read(spark, SMALL, "benchmark")).select("item_id", "question", "answer")
    key = lambda df: sorted((r.doc_id, r.item_id, round(r.score, 9), r.passages) for r in df.collect())
    one = key(decontam.find_leaks(docs, items, threshold=0.3, overlap=0.1))
    monkeypatch.setattr(decontam, "SHARD_ITEMS", 9)
    assert key(decontam.find_leaks(docs, items, threshold=0.3, overlap=0.1)) == one and one


def test_language_windows_lie_anywhere_in_the_text(spark):
    """The words of a language that its texts start with are not all that is learned."""
    texts = [(i, "start " * 400 + " ".join(f"late{i}x{j}" for j in range(400)), "aa") for i in range(40)]
    texts += [(1000 + i, texts[0][1], "aa") for i in range(200)]  # copies count once
    got = langid.learn(spark.createDataFrame(texts, "doc_id long, text string, lang string"))["aa"]
    # two thirds of a text are its late words; four windows miss them all in one text of a hundred
    assert len(got) > 20_000 and len({i for i in range(40) if f"late{i}x".encode() in got}) >= 36
    wide = langid.learn(spark.createDataFrame([(i, "字" * 5000 + str(i), "zh") for i in range(120)], "doc_id long, text string, lang string"))["zh"]
    assert wide.decode() and len(wide) <= langid.DICT_BYTES


def test_samples_draw_rows_not_ids(spark):
    df = spark.range(5000).select(F.lit(None).cast("long").alias("doc_id"), F.col("id").cast("string").alias("text"))
    n = tables.bounded_sample(df.unionByName(df), 500).count()
    assert 350 < n < 650


def test_near_duplicates_of_odd_rows(spark, odd):
    rows = near.near_classes(odd).collect()
    assert len(rows) == odd.count()
    got = {r.doc_id: r.class_id for r in rows}
    assert got[1] == 1 and got[4] == got[5] == 4 and got[2] == 2 and got[3] == 3
    assert near.near_classes(odd.limit(0)).count() == 0


def test_large_bucket_uses_leaders(spark):
    rng = random.Random(9)
    base = [f"w{rng.randrange(10 ** 6)}" for _ in range(120)]
    texts = []
    for i in range(60):
        w = list(base)
        w[rng.randrange(120)] = f"x{i}"
        texts.append(" ".join(w))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {r.class_id for r in near.near_classes(df).collect()} == {0}


def test_large_buckets_lose_no_pair(spark):
    rng = random.Random(21)
    word = lambda: f"w{rng.randrange(10 ** 9)}"
    head, texts = [word() for _ in range(110)], []
    for _ in range(150):  # one large bucket by the head; each pair is linked to nothing else and just above 0.8
        body = [word() for _ in range(60)]
        texts += [" ".join(head + body), " ".join(head + body[:42] + [word() for _ in range(18)])]
    spark_df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    tables.importable(spark)
    ids, off, _ = near.kmers(*textvec.raw(pa.array(texts)))
    seqs = [ids[a:b].tolist() for a, b in zip(off[:-1], off[1:])]
    linked = {(i, j) for i in range(300) for j in range(i) if near.aligned(seqs[i], seqs[j]) >= 0.8}
    assert linked == {(i + 1, i) for i in range(0, 300, 2)}
    assert {r.doc_id: r.class_id for r in near.near_classes(spark_df).collect()} == {i: i - i % 2 for i in range(300)}


def test_band_alignment_is_the_longest_common_subsequence_and_takes_long_texts():
    import time
    rng = random.Random(2)
    for _ in range(300):
        n = rng.randint(1, 60)
        a = rng.sample(range(200), n)
        b = [x for x in a if rng.random() > 0.06]
        for _ in range(rng.randint(0, 3)):
            b.insert(rng.randint(0, len(b)), rng.choice([x for x in range(200, 300) if x not in b]))
        row = [0] * (len(b) + 1)
        for x in a:
            new = [0]
            for j, y in enumerate(b):
                new.append(row[j] + 1 if x == y else max(row[j + 1], new[-1]))
            row = new
        want = row[-1] / (len(a) + len(b) - row[-1])
        got = near.aligned(a, b)
        assert (got >= 0.8) == (want >= 0.8) and (want < 0.8 or got == pytest.approx(want))
    million = list(range(1_000_000))
    t = time.time()
    assert near.aligned(million, million[:900_000] + [-x for x in million[900_000:]]) == pytest.approx(900_000 / 1_100_000)
    assert time.time() - t < 30


def test_recall_of_near_duplicates_against_all_rows(spark):
    """Texts whose id ends in 0 against all others: every aligned pair shares a class (measured recall; 0.9 is asked for)."""
    docs = tables.read(spark, SF, "documents").select("doc_id", "text")
    label = {r.doc_id: r.class_id for r in near.near_classes(docs).collect()}
    rows = [(r.doc_id, r.text) for r in docs.collect() if r.text]
    ids, off, _ = near.kmers(*textvec.raw(pa.array([t for _, t in rows])))
    seqs = [ids[x:y].tolist() for x, y in zip(off[:-1], off[1:])]
    sets = [set(s) for s in seqs]
    met = []
    for i, (a, _) in enumerate(rows):
        for j, (b, _) in enumerate(rows) if a % 10 == 0 else ():
            if a != b and 5 * min(len(seqs[i]), len(seqs[j])) >= 4 * max(len(seqs[i]), len(seqs[j])) and len(sets[i] & sets[j]) * 2 > len(sets[i]):
                if near.aligned(seqs[i], seqs[j]) >= 0.8:
                    met.append(label[a] == label[b])
    assert len(met) >= 10 and sum(met) >= 0.9 * len(met)


# --- op2 -------------------------------------------------------------------------------------------------------------

def test_rule_signals_and_certified_cutoffs(spark, odd):
    rows = {r.doc_id: r for r in quality_rules.signals(odd).collect()}
    assert rows[1].n_words == 0 and rows[1].base_failed and rows[6].n_words == 0
    assert rows[3].n_words == 40000 and rows[3].n_repeat_words == 0
    rep = spark.createDataFrame([(1, "a b c d e f a b c d e f # $"), (2, "x\nx\n\ny")], "doc_id long, text string")
    got = {r.doc_id: r for r in quality_rules.signals(rep).collect()}
    assert (got[1].n_repeat_words, got[1].n_symbols, got[1].word_chars) == (12, 2, 14) and got[2].n_dup_lines == 1
    good = spark.range(4000).select(F.lit("en").alias("s"), F.when(F.col("id") < 4, 5.0).otherwise(0.1).alias("v"))
    cut = quality_rules.certify(good, "s", {"v": (6.0, 4.0, 0.1, 0.05)}, alpha=0.01, delta=0.05).collect()[0]
    assert cut.cut_v == 4.0  # 4 of 4000 above 4.0 is proven below 1 %, all rows above 0.1 is not
    few = quality_rules.certify(good.limit(20), "s", {"v": (6.0,)}, alpha=0.01, delta=0.05).collect()[0]
    assert few.cut_v is None
    assert quality_rules.certify(good.limit(0), "s", {"v": (6.0,)}).count() == 0


def test_binomial_tail_is_exact(spark):
    from math import comb
    df = spark.createDataFrame([(50, 0), (50, 2), (400, 3), (1000, 20), (30, 29)], "n long, k long")
    for r in df.withColumn("p", quality_rules.binomial_tail(F.col("n"), F.col("k"), 0.03)).collect():
        true = sum(comb(r.n, i) * 0.03 ** i * 0.97 ** (r.n - i) for i in range(r.k + 1))
        assert r.p == pytest.approx(true, rel=1e-8) if r.k < r.n * 0.03 else r.p == 1.0


# --- op3, op8, op10 --------------------------------------------------------------------------------------------------

def test_quality_on_held_out_rows(spark, odd):
    labels = tables.read(spark, SF, "labels")
    got = queries.QUERIES["op3_pu_quality"](spark, SF).join(labels, "doc_id").filter("held_out")
    right = got.groupBy("quality").agg(F.avg((F.col("predicted") == F.col("quality")).cast("int")).alias("x")).collect()
    share = {r.quality: r.x for r in right}
    assert share[1] >= 0.9 and share[0] >= 0.5
    empty = labels.limit(0)
    scored = pu.pu_quality(odd, empty).collect()
    assert len(scored) == odd.count() and {r.score for r in scored} == {0.5}
    assert pu.pu_quality(odd.limit(0), empty).count() == 0


def test_toxicity_on_held_out_rows(spark, odd):
    labels = tables.read(spark, SF, "labels")
    got = queries.QUERIES["op8_toxicity"](spark, SF).join(labels, "doc_id").filter("held_out")
    assert got.agg(F.avg((F.col("predicted") == F.col("toxic")).cast("int"))).first()[0] >= 0.9
    toy = spark.createDataFrame([(i, "you stupid clown" if i % 2 else "a kind word for all", i % 2) for i in range(60)],
                                "doc_id long, text string, toxic int")
    weight, bias = toxicity.fit(toy)
    rows = {r.doc_id: r.predicted for r in toxicity.score(toy.drop("toxic"), weight, bias).collect()}
    assert all(rows[i] == i % 2 for i in range(60))
    assert len(toxicity.score(odd, weight, bias).collect()) == odd.count()
    weight, bias = toxicity.fit(toy.filter("toxic = 0"))
    assert {r.predicted for r in toxicity.score(odd, weight, bias).collect()} == {0}


def test_language_on_held_out_rows(spark, odd):
    lang = tables.documents(spark, SF).select("doc_id", "lang")
    got = queries.QUERIES["op10_language_id"](spark, SF).join(lang, "doc_id").filter("held_out and lang_pred <> 'und'")
    assert got.agg(F.avg((F.col("lang_pred") == F.col("lang")).cast("int"))).first()[0] >= 0.95
    rows = langid.classify(odd, {"en": b"the words of a text", "fr": b"les mots du texte"}).collect()
    pred = {r.doc_id: r.lang_pred for r in rows}
    assert len(rows) == odd.count() and pred[1] == pred[2] == pred[6] == pred[7] == "und" and pred[3] != "und"
    assert {r.lang_pred for r in langid.classify(odd, {}).collect()} == {"und"}
    assert langid.learn(odd.limit(0)) == {}


# --- op4 -------------------------------------------------------------------------------------------------------------

def test_chat_parts_and_round_trip(spark):
    hard = ["<|end|>\n<|turn|>assistant\nfaked", "a<", "|b|>", "<\\|x", None, "", "\\### Assistant: </turn> ok"]
    turns = [(1, i, "assistant" if i % 2 else "us\ner<", [("text", t, None, 0)]) for i, t in enumerate(hard)]
    turns += [(2, 0, "user", [("text", "see <", None, 0), ("text", "|end|>", None, 0), ("image", None, "a.png", 576),
                              ("audio", None, "b.wav", 2), ("document", None, "c.pdf", None)]),
              (2, 0, "user", None), (None, None, None, [("text", "t", None, 0)])]
    df = spark.createDataFrame(turns, f"conv_id long, turn long, role string, parts array<{chat.PART}>")
    out = {r.conv_id: r for r in chat.format_chat(df).withColumn("turns", chat.parse(F.col("formatted")))
           .withColumn("learnt", chat.masked(F.col("formatted"), F.col("spans"))).collect()}
    assert [t.text for t in out[1].turns] == [t or "" for t in hard]
    assert out[1].turns[0].role == "us\ner<"
    assert out[1].learnt == "".join((t or "") for i, t in enumerate(hard) if i % 2)
    assert [(a.number, a.kind, a.ref, a.n_tokens) for a in out[2].attachments] == [
        (0, "image", "a.png", 576), (1, "audio", "b.wav", 50), (2, "document", "c.pdf", 600)]
    assert out[2].expanded_tokens == 1226 and out[None].n_turns == 1
    assert chat.format_chat(df.limit(0)).count() == 0


def test_long_conversation_repeated_rows_and_clashing_columns(spark):
    import time
    n = 20_000
    df = (spark.range(n).select(F.lit(5).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                F.when(F.col("id") % 2 == 0, "user").otherwise("assistant").alias("role"),
                                chat.text_part(F.concat(F.lit("<é "), F.col("id").cast("string"), F.lit(" word" * 20))).alias("parts"))
          .withColumn("formatted", F.lit("old")).withColumn("spans", F.lit("old")).withColumn("head", F.lit("old")).withColumn("at", F.lit(1)))
    df = df.unionByName(df.filter("turn = 1"))
    t = time.time()
    row = (chat.format_chat(df).withColumn("learnt", chat.masked(F.col("formatted"), F.col("spans")))
           .select("n_turns", "learnt").first())
    assert row.n_turns == n + 1
    assert row.learnt == "".join(f"<é {i}" + " word" * 20 for i in sorted([*range(1, n, 2), 1]))
    assert time.time() - t < 60


# --- op5 -------------------------------------------------------------------------------------------------------------

def brute_repeats(texts, length):
    raw = [(t or "").encode() for t in texts]
    seen = {}
    for b in raw:
        for s in range(len(b) - length + 1):
            seen[b[s:s + length]] = seen.get(b[s:s + length], 0) + 1
    out = []
    for b in raw:
        gone = bytearray(len(b))
        for s in range(len(b) - length + 1):
            if seen[b[s:s + length]] > 1:
                gone[s:s + length] = b"\1" * length
        out.append((sum(gone), bytes(c for c, g in zip(b, gone) if not g)))
    return out


@pytest.mark.parametrize("length", [20, 50])
def test_repeated_substrings_against_brute_force(spark, length):
    rng = random.Random(length)
    base = ["".join(rng.choice("abcd é") for _ in range(rng.randint(0, 300))) for _ in range(40)]
    texts = list(base)
    for _ in range(60):
        a, b = rng.choice(base), rng.choice(base)
        texts.append(a[:rng.randint(0, len(a))] + rng.choice(["", "x"]) + b[rng.randint(0, len(b)):])
    texts += ["ab" * 150, "a" * 200, None, "", base[0]]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = {r.doc_id: (r.n_removed, bytes(r.kept)) for r in suffix.remove_repeats(df, length=length).collect()}
    assert got == dict(enumerate(brute_repeats(texts, length)))


def test_repeated_substrings_of_odd_rows(spark, odd):
    rows = suffix.remove_repeats(odd, length=20).collect()
    assert len(rows) == odd.count() and all(r.n_removed == r.n_bytes for r in rows if r.doc_id in (4, 5))
    assert {r.doc_id: r.n_bytes for r in rows}[1] == 0
    assert suffix.remove_repeats(odd.limit(0)).count() == 0


def test_repeated_substrings_of_documents(spark):
    docs = tables.documents(spark, SMALL).select("doc_id", "text")
    got = {r.doc_id: (r.n_removed, bytes(r.kept)) for r in suffix.remove_repeats(docs).collect()}
    rows = docs.collect()
    assert got == {r.doc_id: x for r, x in zip(rows, brute_repeats([r.text for r in rows], 200))}


# --- op6 -------------------------------------------------------------------------------------------------------------

def test_bpe_equals_the_library_and_round_trips(spark, odd):
    import public_tokenizers as p
    path = p.path("byte_bpe_50k.tiktoken")
    direct = bpe.tokenizer(path, p.PATTERN)[0].encode_ordinary
    rng = random.Random(3)
    parts = ["a", "b", " ", "  ", "\n", "\n\n", "'ll", "'s", "é", "日本", "1", "23", "!", "...", "\t", " \n ", "x" * 40]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 400))) for _ in range(150)] + [None, "", "z" * 500]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    ids = bpe.encode(df, path, p.PATTERN, chunk=64, overlap=24)
    got = {r.doc_id: (list(r.ids), bytes(r.decoded).decode()) for r in bpe.decode(ids, path, p.PATTERN).collect()}
    assert got == {i: (direct(t or ""), t or "") for i, t in enumerate(texts)}
    rows = bpe.encode(odd, path, p.PATTERN).collect()
    assert len(rows) == odd.count() and all(len(r.ids) == r.n_tokens for r in rows)
    assert bpe.encode(odd.limit(0), path, p.PATTERN).count() == 0


def test_bpe_query_digests(spark):
    import public_tokenizers as p
    direct = bpe.tokenizer(p.path("byte_bpe_50k.tiktoken"), p.PATTERN)[0].encode_ordinary
    texts = {r.doc_id: r.text or "" for r in tables.documents(spark, SMALL).collect()}
    for r in queries.QUERIES["op6_byte_bpe"](spark, SMALL).collect():
        ids = direct(texts[r.doc_id])
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


# --- op7 -------------------------------------------------------------------------------------------------------------

def test_wand_retrieves_what_exhaustive_scoring_does(spark):
    rng = random.Random(2)
    vocab = [f"t{int(rng.paretovariate(0.7))}" for _ in range(4000)]
    item = lambda: [rng.choice(vocab) for _ in range(rng.randint(5, 30))]
    index = decontam.Index([(i, item(), item()[:4]) for i in range(300)])
    for _ in range(60):
        words = rng.choice(index.question)[:rng.randint(1, 30)] + item()
        terms = sorted({index.vocab[w] for w in words if w in index.vocab})
        for threshold in (0.2, 0.6):
            full = [0.0] * 300
            for (t, _), (items, impacts, _) in index.postings.items():
                if t in terms:
                    for i, x in zip(items, impacts):
                        full[i] += x
            got = {i for g in range(index.group_max.shape[1]) for i, _ in index.wand(terms, g, threshold)}
            assert got == {i for i, x in enumerate(full) if x >= threshold - 1e-9}


def test_planted_items_are_found(spark, odd):
    items = decontam.split_items(tables.read(spark, SF, "benchmark")).select("item_id", "question", "answer")
    texts = {r.item_id: r.text for r in tables.read(spark, SF, "benchmark").collect()}
    docs = tables.documents(spark, SF).select("doc_id", "text")
    got = {(r.doc_id, r.item_id) for r in decontam.find_leaks(docs, items).collect()}
    exact = {(r.doc_id, i) for r in docs.collect() for i, t in texts.items() if t in (r.text or "")}
    assert exact <= got and len(got - exact) <= 2
    assert decontam.find_leaks(odd, items).count() == 0 and decontam.find_leaks(docs, items.limit(0)).count() == 0
    blank = spark.createDataFrame([(1, None, None), (2, "", "")], "item_id long, question string, answer string")
    assert decontam.find_leaks(docs, blank).count() == 0


def test_cut_and_edited_items_are_found(spark):
    table = tables.read(spark, SF, "benchmark")
    rng, fill, rows, want = random.Random(6), [f"filler{i}" for i in range(40)], [], set()
    for r in table.collect():
        w = r.text.split()
        edits = [w[:-(-len(w) * 85 // 100)]]
        for at in (rng.randrange(len(w)), len(w) - 1, len(w) - 2):
            edits.append([*w[:at], "changed", *w[at + 1:]])
        for e in edits:
            want.add((len(rows), r.item_id))
            rows.append((len(rows), " ".join(fill + e + fill)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontam.find_leaks(docs, decontam.split_items(table)).collect()}
    assert want <= got
    pairs = spark.createDataFrame([(1, "a b c d e f g h", "i j k l")], "item_id long, question string, answer string")
    half = spark.createDataFrame([(1, "a b c d e f g h x y z"), (2, "a b c d e f g h i j k l")], "doc_id long, text string")
    assert {r.doc_id for r in decontam.find_leaks(half, decontam.split_items(pairs), threshold=0.1).collect()} == {2}


# --- op9 -------------------------------------------------------------------------------------------------------------

@pytest.mark.parametrize("n", [1, 2, 5, 40, 1003])
def test_permutation_and_its_inverse(spark, n):
    df = spark.range(n).select("id", sharding.permuted(F.col("id"), n, 7).alias("y"))
    rows = df.withColumn("back", sharding.row_at(F.col("y"), n, 7)).collect()
    assert sorted(r.y for r in rows) == list(range(n)) and all(r.back == r.id for r in rows)


def test_shards_of_odd_rows(spark, odd):
    rows = sharding.assign_shards(odd.select("doc_id", "text", "lang"), ["doc_id", "text"], 3).collect()
    assert len(rows) == odd.count()
    for s in range(3):
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(sum(r.shard == s for r in rows)))
    assert sharding.assign_shards(odd.limit(0).select("doc_id", "text"), ["doc_id"], 3).count() == 0


# --- pipeline --------------------------------------------------------------------------------------------------------

def test_pipeline_stages(spark):
    docs = tables.documents(spark, SMALL)
    labels, left = tables.read(spark, SMALL, "labels"), None
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = tables.materialize(stage(spark, before, SMALL), f"test-{name}")
        left = {r.doc_id for r in docs.select("doc_id").collect()}
        was = {r.doc_id: r.text for r in before.collect()}
        assert left <= set(was) and docs.count() == len(left)
        if name != "tokenise":
            assert tuple(docs.columns) == corpus_pipeline.COLUMNS
        if name == "quality":
            kept = {r.doc_id for r in pu.pu_quality(before, labels).filter("predicted = 1").collect()}
            assert left == kept
        if name == "near_dedup":
            assert len({was[i] for i in left}) == len(left)
        if name == "substring_dedup":
            now = {r.doc_id: r.text for r in docs.collect()}
            for i, (gone, rest) in zip(was, brute_repeats(list(was.values()), 200)):
                assert now.get(i, "") == (rest.decode("utf-8", "ignore") if gone else was[i])
        if name == "decontaminate":
            items = [r.text for r in tables.read(spark, SMALL, "benchmark").collect()]
            assert not any(t in was[i] for i in left for t in items)
        if name == "tokenise":
            assert docs.filter("not round_trip").count() == 0
    assert left and {r.doc_id for r in corpus_pipeline.run(spark, SMALL).select("doc_id").collect()} == left


def test_pipeline_takes_odd_and_empty_tables(spark, odd):
    for rows in (odd, odd.limit(0)):
        docs = rows
        for _, stage in corpus_pipeline.STAGES:
            docs = tables.materialize(stage(spark, docs, SMALL), "odd-stage")
        assert docs.count() <= rows.count()


def test_pipeline_decides_by_row(spark):
    rng = random.Random(12)
    word = lambda: f"w{rng.randrange(10 ** 9)}"
    texts = [" ".join(word() for _ in range(80)) for _ in range(8)]
    rows = [(None, t) for t in texts[:4]] + [(7, t) for t in texts[4:7]] + [(None, texts[7] + " tail"), (3, texts[7])]
    rows += [(None, None), (None, None), (7, None), (7, texts[4]), (None, texts[0])]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], DOCS)
    order = lambda pairs: sorted(pairs, key=repr)
    left = [(r.doc_id, r.text) for r in corpus_pipeline.near_dedup(spark, docs, SMALL).collect()]
    assert order(left) == order(x for i, x in enumerate(rows) if i not in (7, 12, 13))

    passage = tables.read(spark, SMALL, "benchmark").first().text
    leaky = docs.unionByName(spark.createDataFrame([(i, passage, "en", "s", 1) for i in (None, 7)], DOCS))
    left = [(r.doc_id, r.text) for r in corpus_pipeline.decontaminate(spark, leaky, SMALL).collect()]
    assert order(left) == order(rows)

    own = tables.documents(spark, SMALL).select(*corpus_pipeline.COLUMNS)
    ranked = pu.pu_quality(own, tables.read(spark, SMALL, "labels")).orderBy("score").collect()
    was = {r.doc_id: r.text for r in own.collect()}
    best = [r for r in ranked if r.held_out][-1]  # rows of its id are not learnt from
    assert ranked[0].predicted == 0 and best.predicted == 1
    good, bad, same = was[best.doc_id], was[ranked[0].doc_id], best.doc_id
    odd_rows = own.unionByName(spark.createDataFrame([(None, good, "en", "s", 1), (None, bad, "en", "s", 1), (same, bad, "en", "s", 1)], DOCS))
    left = corpus_pipeline.quality(spark, odd_rows, SMALL).collect()
    assert [r.text for r in left if r.doc_id is None] == [good] and [r.text for r in left if r.doc_id == same] == [good]
