"""Hand-made edge rows for the helpers and operators."""

import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from costwise.functions.exprs import change_key_part, text_op_after, unit_cost
from costwise.operators.reconcile import match_pairs
from costwise.operators.upsert import upsert_newer


def test_unit_cost_outcomes(spark):
    rows = [  # unit, standard, last direct, estimate, purchase, legacy -> type
        (1, 1, 1, 5, 0, 0, "Cifraj"),
        (3, 2, 3, None, 0, 0, "NAV Last Direct Cost"),
        (3, 3, 2, None, 0, 0, "NAV Unit Cost"),
        (2, 3, 1, None, 0, 0, "NAV Standard Cost"),
        (None, None, None, None, 7, 0, "NAV Last Purchase Price"),
        (0, 0, 0, 0, 0, 9, "Legacy Unit Cost"),
        (None, None, None, None, None, None, "No Unit Cost"),
    ]
    df = spark.createDataFrame(rows, "u int, s int, d int, e int, p int, g int, want string")
    got = df.select("want", unit_cost("u", "s", "d", "e", "p", "g").unit_cost_type.alias("t")).collect()
    assert all(r["want"] == r["t"] for r in got)


def test_text_operation_order(spark):
    df = spark.createDataFrame([("90", "110"), ("10", "9"), ("A1", "5")], "op string, cnt string")
    got = [r[0] for r in df.select(text_op_after("op", "cnt")).collect()]
    assert got == [True, False, True]
    got_num = [r[0] for r in df.select(text_op_after("op", "cnt", numeric=True)).collect()]
    assert got_num == [False, True, False]


def test_change_key_part(spark):
    df = spark.createDataFrame([("No.=CONST(A),Line=CONST(10000),X=CONST(5)",), ("Y=CONST()",)], "pk string")
    assert [r[0] for r in df.select(change_key_part("pk", 2)).collect()] == ["10000", None]


def test_upsert_newer_wins_and_idempotent(spark):
    t = spark.createDataFrame([(1, "a", 1), (2, "b", 5), (3, "c", 5)], "k int, v string, ts int")
    s = spark.createDataFrame([(1, "A", 2), (2, "B", 4), (3, "C", 5), (4, "D", 1)], "k int, v string, ts int")
    once = upsert_newer(t, s, ["k"], "ts")
    got = sorted(tuple(r) for r in once.collect())
    assert got == [(1, "A", 2), (2, "b", 5), (3, "C", 5), (4, "D", 1)]
    twice = sorted(tuple(r) for r in upsert_newer(once, s, ["k"], "ts").collect())
    assert twice == got


def _reference_loop(rows, cap):
    """Python model of the source's round loop: one pair per transaction and round."""
    live = sorted(rows)
    pairs = []
    while True:
        if cap and len(live) in (1, 3):
            break
        found = None
        for i, a in enumerate(live):
            for c in live[i + 1:]:
                if a[1] != c[1] and ((a[2] != 0 and c[3] == a[2]) or (a[3] != 0 and c[2] == a[3])):
                    found = (a, c)
                    break
            if found:
                break
        if not found:
            break
        pairs.append((found[0][0], found[1][0]))
        live = [r for r in live if r[0] not in (found[0][0], found[1][0])]
    return pairs


@pytest.mark.parametrize("cap", [True, False])
def test_match_pairs_against_loop(spark, cap):
    rnd = random.Random(7)
    rows, want = [], set()
    for txn in range(300):
        n = rnd.randint(1, 9)
        ents = []
        for e in range(n):
            amt = Decimal(rnd.choice([1, 2, 3]))
            kind = rnd.random()
            d, c = (amt, Decimal(0)) if kind < 0.45 else ((Decimal(0), amt) if kind < 0.9 else (amt, amt))
            ents.append((e + 1, rnd.choice(["A", "B", "C"]), d, c))
        rows += [(txn, *x) for x in ents]
        want |= {(txn, a, b) for a, b in _reference_loop(ents, cap)}
    df = spark.createDataFrame(rows, "txn int, entry_no bigint, account string, debit decimal(18,2), credit decimal(18,2)")
    got = {(r["txn"], r["e1"], r["e2"]) for r in match_pairs(df, ["txn"], cap).collect()}
    assert got == want


def test_closure_quantities_and_cycle(spark):
    from costwise.operators.explode import CycleError, closure
    seeds = spark.createDataFrame([("S", "B1")], "seed string, bom_no string")
    edges = spark.createDataFrame([("B1", "X", "B2", 2), ("B2", "Y", None, 3), ("B1", "Z", None, 5)],
                                  "bom_no string, item_no string, child_bom string, quantity_per int")
    got = sorted((r["item_no"], r["level"], float(r["qty"])) for r in closure(seeds, edges).collect())
    assert got == [("X", 1, 2.0), ("Y", 2, 6.0), ("Z", 1, 5.0)]
    cyc = spark.createDataFrame([("B1", "X", "B2", 1), ("B2", "Y", "B1", 1)],
                                "bom_no string, item_no string, child_bom string, quantity_per int")
    with pytest.raises(CycleError):
        closure(seeds, cyc)
    deep = spark.createDataFrame([(f"B{i}", f"X{i}", f"B{i + 1}", 1) for i in range(1, 71)],
                                 "bom_no string, item_no string, child_bom string, quantity_per int")
    assert closure(seeds, deep).agg(F.max("level")).first()[0] == 70


def test_closure_work_grows_with_edges_on_a_diamond(spark):
    """20 levels of two parts that both hold the same two parts: 2**20 paths, 4 edges a level."""
    from costwise.operators.explode import closure
    rows = [(f"{a}{i}", f"I{b}{i + 1}", f"{b}{i + 1}", q) for i in range(20) for a in "LR" for b, q in (("L", 1), ("R", 1))]
    edges = spark.createDataFrame(rows, "bom_no string, item_no string, child_bom string, quantity_per int")
    seeds = spark.createDataFrame([("S", "L0")], "seed string, bom_no string")
    got = {(r["item_no"], r["level"]): int(r["qty"]) for r in closure(seeds, edges).collect()}
    assert got == {(f"I{b}{level}", level): 2 ** (level - 1) for level in range(1, 21) for b in "LR"}


def test_closure_adds_up_all_paths_of_random_graphs(spark):
    from collections import Counter

    from costwise.operators.explode import closure
    rng = random.Random(11)
    lines = [(f"B{i}", f"I{j}", f"B{j}" if j < 14 else None, rng.randint(1, 3)) for i in range(12) for j in rng.sample(range(i + 1, 18), 3)]
    lines += [("B0", "I3", "B3", 1)]  # a line twice
    want = Counter()

    def walk(seed, bom, level, qty):
        for b, item, child, q in lines:
            if b == bom:
                want[seed, item, level] += qty * q
                if child:
                    walk(seed, child, level + 1, qty * q)

    seeds = [("S0", "B0"), ("S1", "B1"), ("S0", "B2"), ("S2", None)]
    for seed, bom in seeds:
        if bom:
            walk(seed, bom, 1, 1)
    out = closure(spark.createDataFrame(seeds, "seed string, bom_no string"),
                  spark.createDataFrame(lines, "bom_no string, item_no string, child_bom string, quantity_per int"))
    assert {(r["seed"], r["item_no"], r["level"]): int(r["qty"]) for r in out.collect()} == dict(want)


def test_closure_finds_a_cycle_below_other_boms_only_if_reached(spark, monkeypatch):
    from costwise.operators import explode
    monkeypatch.setattr(explode, "CHECK_LEVEL", 5)
    edges = spark.createDataFrame([("B1", "X", "B2", 1), ("B2", "Y", "B3", 1), ("B3", "Z", "B2", 1), ("C1", "X", "C2", 1)],
                                  "bom_no string, item_no string, child_bom string, quantity_per int")
    with pytest.raises(explode.CycleError):
        explode.closure(spark.createDataFrame([("S", "B1")], "seed string, bom_no string"), edges)
    assert explode.closure(spark.createDataFrame([("S", "C1")], "seed string, bom_no string"), edges).count() == 1


def test_uom_rate_and_duplicate_keys(spark):
    from costwise.operators.convert import assert_unique, with_uom_rate
    uom = spark.createDataFrame([("I1", "UN", 1), ("I1", "box", 12), ("I2", "UN", 0)],
                                "item_no string, code string, qty_per_uom int")
    req = spark.createDataFrame([("i1", "un", "BOX"), ("I1", "UN", "PAL"), ("I2", "UN", "UN")],
                                "item string, f string, t string")
    got = sorted((r["item"], r["t"], float(r["rate"])) for r in with_uom_rate(req, "item", "f", "t", uom).collect())
    assert got == [("I1", "PAL", -1.0), ("I2", "UN", -1.0), ("i1", "BOX", 12.0)]
    dup = spark.createDataFrame([("I1", "BOX", 1), ("i1", "box", 2)], "item_no string, code string, qty_per_uom int")
    with pytest.raises(ValueError):
        assert_unique(dup.select(F.upper("item_no").alias("i"), F.upper("code").alias("c")), ["i", "c"])


def test_ageing_rounds(spark):
    from costwise.operators.ageing import age_stock
    rows = [(1, "2021-01-01", 5, 5), (1, "2021-02-01", -3, -3), (1, "2021-03-01", -1, -1), (1, "2021-04-01", 4, 4),
            (2, "2021-01-01", -2, -2), (2, "2021-02-01", 3, 3),
            (3, "2021-01-01", -5, -5), (3, "2021-02-01", 1, 1)]
    b = spark.createDataFrame(rows, "item_no int, month string, quantity int, cost int").select(
        "item_no", F.col("month").cast("date").alias("month"), F.col("quantity").cast("decimal(18,2)").alias("quantity"),
        F.col("cost").cast("decimal(18,2)").alias("cost"))
    got = sorted((r["item_no"], str(r["month"]), float(r["quantity"])) for r in age_stock(b, 5).collect())
    # item 1: -3 and -1 move back (2021-03 to 2021-02, 2021-02 to 2021-01), then the merged -1 moves back again
    # item 2: first bucket moves forward; item 3 has a non-positive total and is dropped
    assert got == [(1, "2021-01-01", 1.0), (1, "2021-04-01", 4.0), (2, "2021-02-01", 1.0)]


def test_reconcile_month_gates_and_partitions(spark, tmp_path):
    import datetime as dt

    from costwise.operators import stored
    from costwise.operators.reconcile import UnbalancedError, month_range, reconcile_month
    assert month_range(2024, 2) == (dt.date(2024, 2, 1), dt.date(2024, 2, 29))
    for bad in ((2024, 13, 1, None), (2024, 2, 0, 5), (2024, 2, 5, 4), (2023, 2, 1, 29)):
        with pytest.raises(ValueError):
            month_range(*bad)
    day = dt.date(2024, 1, 2)
    # 150 entries in one transaction: 75 debits on shared accounts against 75 credits of the same amounts
    rows = [(day, 7, i, f"6{i % 3}", 0, "", float(i % 5 + 1) if i < 75 else 0.0, 0.0 if i < 75 else float(i % 5 + 1))
            for i in range(150)]
    schema = ("posting_date date, transaction_no long, entry_no long, account string, source_type int, source_no string, "
              "debit double, credit double")
    df = spark.createDataFrame(rows, schema).withColumn("debit", F.col("debit").cast("decimal(18,2)")).withColumn(
        "credit", F.col("credit").cast("decimal(18,2)"))
    none = spark.createDataFrame([], "gl_entry_no long, value_entry_no long")
    path = f"{tmp_path}/out"
    out = reconcile_month(df, none, 2024, 1, path=path)
    assert out.agg(F.sum("debit") - F.sum("credit")).first()[0] == 0
    assert stored.read(spark, path, "posting_date").count() == out.count() > 0
    assert {r["entry_no"] for r in out.select("entry_no").collect()} == set(range(150))
    with pytest.raises(UnbalancedError):
        reconcile_month(df.filter("entry_no <> 3"), none, 2024, 1)
