"""Hand-made rows for the item master, orders against BOMs, reports, incremental ageing and located closures."""

import datetime as dt
import random
import tempfile
import zlib
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from costwise.operators import ageing, compare, explode, items, reconcile, reports, stored


def day(text):
    return dt.date.fromisoformat(text)


PRICE = "item_no string, start_date date, price decimal(18,2), currency string, uom string, rowversion long, includes_vat boolean"


def test_last_price_takes_future_starts_and_skips_zero(spark):
    rows = [("A", day("2020-01-01"), D(5), "", "", 1, False), ("A", day("2999-01-01"), D(7), "EUR", "BOX", 2, True),
            ("A", day("2999-06-01"), D(0), "", "", 3, False), ("B", day("2020-01-01"), D(3), "XXX", "", 1, False)]
    p = spark.createDataFrame(rows, PRICE)
    fx = spark.createDataFrame([("EUR", D("4.5"))], "currency string, rate decimal(10,4)")
    got = {r.item_no: (float(r.value), r.uom, r.includes_vat) for r in items.last_prices(p, fx).collect()}
    assert got == {"A": (31.5, "BOX", True), "B": (3.0, "", False)}
    assert {r.item_no: float(r.value) for r in items.last_prices(p, fx, "2021-01-01").collect()} == {"A": 5.0, "B": 3.0}


def test_item_master_converts_or_tags(spark):
    text = ("item_no description range posting_group manufacture sav_manufacture production_location production_bom_no routing_no technical_family "
            "cod_abcd base_uom purch_uom sales_uom").split()
    base = dict.fromkeys(text, "") | {"base_uom": "pc", "manufacture": "M1", "sav_manufacture": "M2", "production_location": "F9"}
    rows = [base | {"item_no": "A"}, base | {"item_no": "B", "manufacture": "none"}, base | {"item_no": "C", "manufacture": "x", "sav_manufacture": "y"}]
    it = spark.createDataFrame([tuple(r[c] for c in text) for r in rows], ", ".join(f"{c} string" for c in text)).select(
        "*", *[F.lit(0).cast("decimal(18,2)").alias(c) for c in ("unit_cost", "standard_cost", "last_direct_cost")])
    m = spark.createDataFrame([("M1", "F1"), ("M2", "F2")], "manufacture string, factory string")
    est = spark.createDataFrame([("A", D(12), "BOX", day("2022-03-01")), ("B", D(7), "KG", day("2021-01-01")), ("C", D(9), "KG", day("2022-03-01"))],
                                "item_no string, cost decimal(18,2), uom string, estimated_on date")
    buy = spark.createDataFrame([("A", day("2020-01-01"), D(24), "", "box", 1, False), ("B", day("2020-01-01"), D(2), "", "KG", 1, False)], PRICE)
    sell = spark.createDataFrame([("C", day("2020-01-01"), D(2), "", "KG", 1, True)], PRICE)
    fx = spark.createDataFrame([], "currency string, rate decimal(10,4)")
    uom = spark.createDataFrame([("A", "PC", D(1)), ("A", "Box", D(12)), ("B", "PC", D(1)), ("C", "PC", D(0))], "item_no string, code string, qty_per_uom decimal(18,9)")
    dims = spark.createDataFrame([("A", "pc", D(500), D(0), D(10))], "item_no string, code string, length decimal(18,2), width decimal(18,2), height decimal(18,2)")
    got = {r.item_no: r for r in items.item_master(it, m, est, buy, sell, fx, uom, dims).collect()}
    a, b, c = got["A"], got["B"], got["C"]
    assert (float(a.estimate_cost), float(a.last_purchase_price), a.errors, a.unit_cost_type) == (pytest.approx(1, abs=1e-4), pytest.approx(2, abs=1e-4), "", "Cifraj")
    assert (b.estimate_cost, float(b.legacy_unit_cost), float(b.last_purchase_price), b.errors) == (None, 7.0, 2.0, "LECACY;PURCHASE;")
    assert (float(c.estimate_cost), float(c.last_sales_price), c.errors, c.price_includes_vat) == (9.0, 2.0, "CIFRAJ;SALES;", True)
    assert (a.factory, b.factory, c.factory) == ("F1", "F2", "F9") and (a.length, a.width) == (D("0.5"), None) and a.range is None
    twice = uom.unionByName(uom.filter("code = 'Box'"))
    with pytest.raises(Exception, match="DUPLICATED_MAP_KEY"):
        items.item_master(it, m, est, buy, sell, fx, twice, dims).collect()


def test_the_nearest_order_of_a_version(spark):
    packages = spark.createDataFrame([("P1", "B1", "one", "V2"), ("P2", "B2", "two", None), ("P3", "B3", "three", None)],
                                     "root_item string, bom_no string, bom_description string, bom_version string")
    lines = spark.createDataFrame(
        [("PO1", 10000, 3, "B1", "V1"), ("PO2", 10000, 3, "B1", "V2"), ("PO3", 10000, 4, "B1", "V2"), ("PO4", 10000, 2, "B2", ""), ("RO1", 10000, 2, "B2", ""),
         ("PO0", 20000, 2, "B2", ""), ("PO5", 10000, 1, "B3", ""), ("PO6", 10000, 2, "B3", "")],
        "order_no string, line_no int, status int, bom_no string, version_code string").withColumn("quantity", F.lit(2).cast("decimal(12,2)")).withColumn(
        "status_name", F.col("status").cast("string"))
    unusable = spark.createDataFrame([("PO6",)], "order_no string")
    got = {r.root_item: r.order_no for r in compare.match_orders(packages, lines, unusable).collect()}
    assert got == {"P1": "PO2", "P2": "PO4"}


def test_differences_of_a_bom_and_its_order(spark):
    rows = [("O1", "B1", s, "Component", i, "UN", D(q)) for s, i, q in (("NAV", "x", 2), ("BDD", "x", 2), ("NAV", "y", 1), ("BDD", "z", 4), ("NAV", "w", 5), ("BDD", "w", 3))]
    df = spark.createDataFrame(rows, "order_no string, bom_no string, source string, type string, item_no string, uom string, expect_qty decimal(38,5)")
    got = {r.item_no: (r.kind, float(r.difference)) for r in compare.differences(df).collect()}
    assert got == {"x": ("equal", 0.0), "y": ("only order", 1.0), "z": ("only BOM", -4.0), "w": ("differs", 2.0)}


def test_foreign_amounts_come_from_the_many_side(spark):
    schema = "posting_date date, transaction_no long, entry_no long, account string, source_type int, source_no string, debit decimal(18,2), credit decimal(18,2)"
    d0 = day("2022-03-01")
    e = spark.createDataFrame([(d0, 1, 1, "6", 0, "", D(9), D(0)), (d0, 1, 2, "7", 1, "c", D(0), D(4)), (d0, 1, 3, "8", 0, "", D(0), D(5))], schema)
    result = reconcile.reconcile(e, spark.createDataFrame([], "gl_entry_no long, value_entry_no long"), ("nonitem",))["result"]
    facts = e.select("entry_no", "transaction_no", (F.col("debit") * 2).cast("decimal(18,2)").alias("debit_fcy"), (F.col("credit") * 2).cast("decimal(18,2)").alias("credit_fcy"),
                     F.concat(F.lit("C"), F.col("entry_no").cast("string")).alias("currency"), F.lit(1).alias("document_type"), F.lit(9).alias("fa_entry_type"),
                     *[F.lit("x").alias(c) for c in ("bal_account_no", "document_date", "document_no", "external_document_no", "description", "dimension_1",
                                                     "dimension_2", "source_code", "dimension_set_id", "fa_entry_no")])
    dim = spark.createDataFrame([("6", "six"), ("1", "first"), ("c", "Customer c")], "code string, name string")
    got = {(r.tip, r.entry_no, r.offset_account): r for r in reports.reconciled_report(facts, result, dim, dim, dim, dim, dim, dim).collect()}
    one = got["1D - nC", 1, "8"]
    assert (float(one.debit), float(one.debit_fcy), float(one.credit_fcy), one.currency_code, one.account_name) == (5.0, 10.0, 0.0, "C3", "six")
    many = got["nC - 1D", 2, "6"]
    assert (float(many.credit), float(many.credit_fcy), float(many.debit_fcy), many.currency_code) == (4.0, 8.0, 0.0, "C2")
    assert many.source_name == "Customer c" and many.document_type_name == "first" and many.fa_entry_type_name is None


def test_months_added_to_an_ageing_equal_one_run(spark):
    rng = random.Random(4)
    rows = [(f"I{rng.randrange(40)}", dt.date(2021, 1, 1) + dt.timedelta(days=rng.randrange(500)), D(rng.randint(-5, 6)),
             None if rng.random() < 0.2 else D(rng.randint(1, 90))) for _ in range(900)]
    schema = "item_no string, posting_date date, quantity decimal(18,2), cost decimal(18,2)"
    path = tempfile.mkdtemp(prefix="costwise-age-", dir="/tmp") + "/a"
    cut = day("2021-12-01")
    first = [r for r in rows if r[1] < cut and zlib.crc32(r[0].encode()) % 7]
    late = [r for r in rows if r not in first]
    for part in (first, late, []):
        ageing.add_moves(spark.createDataFrame(part, schema), path, "2021-04-30", 20, 8)
    whole = ageing.age_stock(ageing.month_buckets(spark.createDataFrame(rows, schema), "2021-04-30"), 20)
    key = lambda df: sorted((r.item_no, r.month, r.quantity, r.cost) for r in df.select("item_no", "month", "quantity", "cost").collect())
    got = key(stored.table(spark, f"{path}/aged"))
    assert [x[:3] for x in got] == [x[:3] for x in key(whole)] and len(got) > 40
    assert str(got) == str(key(whole))
    # nothing new: nothing is written
    assert stored.manifest(spark, f"{path}/raw")[0] == 2


def test_ageing_runs_all_rounds_in_one_pass(spark, monkeypatch):
    rng = random.Random(9)
    cells = {(i, k): (None if rng.random() < 0.05 else D(rng.randint(-400, 450)) / 100, None if rng.random() < 0.2 else D(rng.randint(-9, 90)))
             for i in (*range(150), None) for k in rng.sample(range(24), rng.randint(1, 24))}
    month = lambda k: dt.date(2020 + k // 12, k % 12 + 1, 1)
    rows = spark.createDataFrame([(i, month(k), *v) for (i, k), v in cells.items()],
                                 "item_no int, month date, quantity decimal(18,2), cost decimal(18,2)")

    def plain(item, most):
        b = sorted((k, *v) for (i, k), v in cells.items() if i == item)
        if sum(q or 0 for _, q, _ in b) <= 0:
            return []
        for _ in range(most):
            b, out = [x for x in b if x[1]], {}
            for n, (k, q, c) in enumerate(b):
                to = k if q > 0 else b[n - 1][0] if n else b[1][0] if len(b) > 1 else k
                was_q, was_c = out.get(to, (0, None))
                out[to] = (was_q + q, c if was_c is None else was_c if c is None else was_c + c)
            b = sorted((k, *v) for k, v in out.items())
        return [(item, month(k), q, c) for k, q, c in b]

    # all rounds are one pass over the items: no round is written and read back
    monkeypatch.setattr(ageing, "materialize", lambda *a: (_ for _ in ()).throw(AssertionError("written")))
    for most in (1, 3, 40):
        got = sorted((r.item_no, r.month, r.quantity, r.cost) for r in ageing.age_stock(rows, most).collect())
        assert got == [x for i in range(150) for x in plain(i, most)] and len(got) > 300


def test_entry_costs_sum_the_value_entries(spark):
    ledger = spark.createDataFrame([(1,), (2,)], "entry_no long")
    values = spark.createDataFrame([(1, D("1.005")), (1, D("2")), (9, D(1))], "entry_no long, cost decimal(18,3)")
    assert {r.entry_no: r.cost for r in ageing.entry_costs(ledger, values).collect()} == {1: D("3.01"), 2: None}


def test_phantom_lines_are_followed_in_their_location(spark):
    lines = [("1", "", None, 1, "2", "a"), ("1", "V1", "L1", 1, "2", "a"), ("2", "", None, 2, "3", "b"), ("2", "V1", "L1", 2, "4", "c"), ("2", "V2", "L2", 2, "5", "d"),
             ("3", "", None, 2, "6", "e"), ("3", "", None, 2, "6", "e")]
    df = spark.createDataFrame(lines, "bom_no string, version_code string, location string, type int, no_ string, link_code string")
    got = sorted((r.version_code, r.no_, r.level, r.n) for r in explode.phantom_closure(df).collect())
    assert got == [("", "2", 1, 1), ("", "3", 2, 1), ("", "6", 3, 2), ("V1", "2", 1, 1), ("V1", "3", 2, 1), ("V1", "4", 2, 1), ("V1", "6", 3, 2)]


def test_path_quantities_keep_each_product(spark):
    edges = spark.createDataFrame([("B1", "X", "B2", 2, "u"), ("B1", "Y", "B2", 2, "u"), ("B1", "Z", "B2", 3, "u"), ("B2", "W", None, 5, "v")],
                                  "bom_no string, item_no string, child_bom string, quantity_per int, unit string")
    out = explode.path_quantities(spark.createDataFrame([("S", "B1")], "seed string, bom_no string"), edges, ("unit",))
    assert sorted((r.item_no, int(r.qty), r.n, r.unit) for r in out.filter("level = 2").collect()) == [("W", 10, 2, "v"), ("W", 15, 1, "v")]


def test_group_prices_reach_all_customers_in_slices(spark):
    from costwise.operators.prices import to_group_customers
    rows = spark.createDataFrame([(i, "G1", "EUR") for i in range(40)] + [(1, "G2", ""), (1, "G2", ""), (2, None, "")],
                                 "item_no int, sales_code string, currency string")
    cust = spark.createDataFrame([("a", "CF", "G1"), ("b", "CF", "G1"), ("c", "PJ", "G1"), ("d", "CF", "G2"), (None, "CF", "G2"), ("e", "CF", None)],
                                 "customer_no string, customer_type string, price_group string")
    out = to_group_customers(rows, cust)
    want = sorted([(i, c) for i in range(40) for c in "ab"] + [(1, "d"), (1, "d"), (1, ""), (1, "")])
    assert sorted((r.item_no, r.customer_no or "") for r in out.collect()) == want
    assert "BroadcastExchange" not in out._jdf.queryExecution().toString()  # rows that grow with items and customers stay spread


def hand_tables(spark):
    """Three parts (one is a kit of the others), three customers and an order over the components."""
    from costwise.sources.tables import Tables
    t = Tables(spark, tempfile.mkdtemp(prefix="costwise-hand-", dir="/tmp"))
    put = lambda name, rows, schema: spark.createDataFrame(rows, schema).write.parquet(f"{t.root}/{name}.parquet")
    put("part", [(k, f"p{k}", "B", "PROMO" if k == 1 else "SMALL", 1, 9.0) for k in (1, 2, 3)],
        "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double")
    put("customer", [(k, f"c{k}", 7, 0.0, "AUTO") for k in (50, 100, 101)],
        "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string")
    put("orders", [(1, 101, "O", 1.0, dt.datetime(1995, 1, 1), "1-URGENT")],
        "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string")
    put("lineitem", [(1, k, 1, k, 1.0, 10.0 * k, 0.0, 0.0, "N", "O", dt.datetime(1995, 2, 1)) for k in (2, 3)],
        "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, "
        "l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz")
    put("supplier", [(1, "s", 1, 0.0)], "s_suppkey long, s_name string, s_nationkey int, s_acctbal double")
    put("nation", [(k, f"n{k}", 0) for k in (1, 2)], "n_nationkey int, n_name string, n_regionkey int")
    for name in ("region", "events"):
        put(name, [(1,)], "k int")
    return t


def test_price_expansion_multiplies_group_prices_last(spark):
    """Picks, kits and divisions read the groups' prices; only their results meet the customers."""
    from costwise.plans.prices import kit_division_df, last_price_parts
    t = hand_tables(spark)
    parts = last_price_parts(t)
    assert (parts["direct"].count(), parts["group"].count()) == (0, 2)
    got = sorted((r.item_no, r.component_no, r.customer_code, float(r.price)) for r in kit_division_df(t).collect())
    assert got == [(1, 2, "100", 40.0), (1, 2, "50", 40.0), (1, 3, "100", 60.0), (1, 3, "50", 60.0)]


def test_kit_components_build_the_item_master_once(spark, monkeypatch):
    from costwise.plans import masters
    built, master = [], masters.master
    monkeypatch.setattr(masters, "master", lambda t: built.append(1) or master(t))
    rows = masters.kit_components_full(hand_tables(spark)).collect()
    assert sorted((r.kit_no, r.item_no) for r in rows) == [("1", "2"), ("1", "3")] and len(built) == 1


def test_explosion_sends_no_side_through_the_driver(spark):
    line = spark.createDataFrame([("B1", "2", "B2")], "bom_no string, item_no string, child_bom string").withColumn("quantity_per", F.lit(2).cast("decimal(18,9)"))
    side = explode._spread(line)
    joined = line.withColumnRenamed("bom_no", "b").join(side, F.col("b") == F.col("bom_no"))
    assert "Broadcast" not in joined._jdf.queryExecution().executedPlan().toString()


def test_explosion_lays_out_its_sides_once(spark, monkeypatch):
    """A level shuffles its own rows only: the sides that it joins are kept as the join needs them; the timelines are built once."""
    line = spark.createDataFrame([("B1", "_null", "2")], "_l_bom string, _l_vkey string, _l_item string")
    side = explode._laid(line, "_l_bom", "_l_vkey")
    at = spark.createDataFrame([("B1", "_null")], "bom_no string, v string")
    joined = at.join(explode._spread(side), (F.col("bom_no") == F.col("_l_bom")) & (F.col("v") == F.col("_l_vkey")))
    plan = joined._jdf.queryExecution().executedPlan()
    above = plan.toString().split("InMemoryRelation")[0]
    assert joined.count() == 1 and "InMemoryTableScan" in above and above.count("Exchange") == 1
    side.unpersist()

    from costwise.plans import dated
    t, built, timeline = hand_tables(spark), [], dated.version_timeline
    monkeypatch.setattr(dated, "version_timeline", lambda *a: built.append(1) or timeline(*a))
    monkeypatch.setattr(explode, "version_timeline", lambda *a: built.append(1) or timeline(*a))
    dated.dated_explosion(t, ["2000-01-01"])
    assert len(built) == 2


def test_ledger_queries_run_the_steps_they_read(spark, monkeypatch):
    """Item rows need no non-item pairing, and neither needs the gates; all steps together give what one reconciliation gives."""
    from costwise.plans import gl
    d, n = day("2020-01-01"), D(0)
    entries = spark.createDataFrame(
        [(d, 1, 1, "61", 1, "a", D(5), n), (d, 1, 2, "71", 0, "", n, D(5)), (d, 2, 3, "61", 1, "a", D(5), n), (d, 2, 4, "71", 0, "", n, D(4)),
         (d, 3, 5, "61", 1, "a", D(3), n), (d, 3, 6, "62", 1, "a", D(4), n)],
        "posting_date date, transaction_no long, entry_no long, account string, source_type int, source_no string, debit decimal(18,2), credit decimal(18,2)")
    relations = spark.createDataFrame([(3, 8), (4, 8)], "gl_entry_no long, value_entry_no long")
    monkeypatch.setattr(gl.D, "gl_entries", lambda t: entries)
    monkeypatch.setattr(gl.D, "gl_item_relations", lambda e: relations)

    class Steps(dict):
        def shared(self, name, build):
            group, _, member = name.partition("/")
            if group not in self:
                made = build()
                self[group] = made if isinstance(made, dict) else {"": made}
            return self[group][member]

    t = Steps()
    assert sorted(r.entry_no for r in gl.gl_item_errors(t).collect()) == [3, 4] and set(t) == {"gl-scope", "gl-item"}
    t = Steps()
    assert sorted(r.entry_no for r in gl.gl_errors(t).collect()) == [5, 6] and set(t) == {"gl-scope", "gl-nonitem"}
    whole = reconcile.reconcile(entries, relations)
    for what in ("result", "gates", "links"):
        assert sorted(map(str, gl.reconciled(t, what).collect())) == sorted(map(str, whole[what].collect()))


def test_shared_views_keep_what_is_written(spark):
    from costwise.session import materialize
    t = hand_tables(spark)
    kept = materialize(spark.range(3), "kept")
    assert t.shared("kept-test", lambda: kept).inputFiles() == kept.inputFiles()
    assert t.shared("made-test", lambda: kept.filter("id > 0")).inputFiles() != kept.inputFiles()


@pytest.fixture
def plans(monkeypatch):
    """The plan of each step that is written, as it stands before the step runs: with the joins chosen by the sizes of files."""
    from pyspark.sql.readwriter import DataFrameWriter
    seen, write = [], DataFrameWriter.parquet
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda self, path, *a, **k: (
        seen.append(self._df._jdf.queryExecution().executedPlan().toString()), write(self, path, *a, **k))[1])
    return seen


@pytest.mark.parametrize("name", ["bom_explode", "route_explode", "cost_actual_vs_standard", "bom_explode_dated", "bom_vs_order_diff",
                                  "kit_components_full", "ctl_zero_quantity_per"])
def test_no_growing_side_goes_through_the_driver(spark, plans, name):
    """Sides that grow with the tables are shuffled however small their files are; only the nations' views and one row may be broadcast."""
    from costwise.plans import all_queries
    t = hand_tables(spark)
    plans.clear()
    out = all_queries()[name].build(spark, t.root)
    bounded = ("manufacture", "currency", "_f1", "_f2", "_fc", "IdentityBroadcastMode")
    for plan in [*plans, out._jdf.queryExecution().executedPlan().toString()]:
        sent = [x for x in plan.split("\n") if "BroadcastHashJoin" in x or "BroadcastNestedLoopJoin" in x]
        assert not [x for x in sent if not any(b in x for b in bounded) and "NestedLoop" not in x], plan
    out.collect()


def test_a_job_reads_its_line_items_once(spark):
    """Item costs, routings and average orders are added up from one grouping; it gives what each gave by itself."""
    from costwise.plans.costs import _cost_inputs
    from costwise.sources import bom_world as W
    t = hand_tables(spark)
    more = spark.createDataFrame(
        [(o, p, 1, n, q, 1.0, d, x, "N", "O", dt.datetime(1995, 2, 1)) for o, p, n, q, d, x in (
            (1, 2, 1, 5.0, 0.1, 0.2), (2, 2, 1, 5.1, 0.3, 0.1), (3, 2, 4, 99.0, None, None), (4, None, 4, 7.0, 0.0, 0.0), (5, 3, None, None, 0.0, 0.0))],
        "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, "
        "l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz")
    t._cache["lineitem"] = t.lineitem.unionByName(more)
    rows = lambda df: sorted(map(str, df.collect()))
    assert rows(_cost_inputs(t)) == rows(_cost_inputs(t, W.part_lines(t)))
    assert rows(W.avg_quantity(t)) == rows(t.lineitem.filter("l_quantity * 10 > 50").groupBy(F.col("l_partkey").cast("string").alias("item_no")).agg(
        F.expr("(sum(cast(l_quantity * 10 as long)) + 50 * count(*)) div (100 * count(*)) * 100").alias("avg_calc")))
    items = W._item_facts(t, W.part_lines(t)).join(W.avg_quantity(t), "item_no").join(W.routing_lines(t), "routing_no", "left")
    assert items.inputFiles() and "lineitem.parquet" not in items._jdf.queryExecution().executedPlan().toString().split("InMemoryRelation")[0]


def test_explosion_sorts_its_sides_once(spark):
    """A side that levels merge is kept sorted, so that only the rows of a level are sorted."""
    line = spark.createDataFrame([("B1", "_null", "2"), ("B2", "x", "3")], "_l_bom string, _l_vkey string, _l_item string")
    side = explode._laid(line, "_l_bom", "_l_vkey")
    at = spark.createDataFrame([("B1", "_null")], "bom_no string, v string")
    joined = at.join(explode._spread(side), (F.col("bom_no") == F.col("_l_bom")) & (F.col("v") == F.col("_l_vkey")))
    assert len(joined.collect()) == 1
    above = joined._jdf.queryExecution().executedPlan().toString().split("InMemoryRelation")[0]  # as it ran
    assert "InMemoryTableScan" in above and above.count("Sort [") == 1, above
    side.unpersist()


def test_ledger_pairs_are_joined_once(spark):
    """Both rows of a pair come from one join of each side: two joins, not four."""
    d, n = day("2020-01-01"), D(0)
    rows = spark.createDataFrame(
        [(d, 1, 1, "61", 0, "", D(5), n), (d, 1, 2, "71", 2, "b", n, D(5)), (d, 1, 3, "62", 1, "c", D(7), n)],
        "posting_date date, transaction_no long, entry_no long, account string, source_type int, source_no string, debit decimal(18,2), credit decimal(18,2)")
    pairs = spark.createDataFrame([(d, 1, 1, 2)], "posting_date date, transaction_no long, e1 long, e2 long")
    out = reconcile._pair_rows(pairs, rows, reconcile.KEYS, reconcile.TIP_PAIR)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join Inner") == 2
    assert sorted((r.entry_no, r.account, r.bal_entry_no, r.source_type, r.source_no, int(r.debit), int(r.credit)) for r in out.collect()) == [
        (1, "61", 2, 2, "b", 5, 0), (2, "71", 1, 2, "b", 0, 5)]
    assert tuple(out.columns) == reconcile.OUT_COLS


def test_written_steps_leave_no_shuffle_files(spark, monkeypatch):
    """The shuffle files of a written step go with it; the session's own setting stays."""
    from pyspark.sql.readwriter import DataFrameWriter

    from costwise import session
    seen, write, key = [], DataFrameWriter.parquet, session.CLEANUP
    before = spark.conf.get(key, None)
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda self, *a, **k: (seen.append(spark.conf.get(key)), write(self, *a, **k))[1])
    assert session.materialize(spark.range(5).repartition(3, "id"), "cleanup").count() == 5
    assert seen == ["true"] and spark.conf.get(key, None) == before
