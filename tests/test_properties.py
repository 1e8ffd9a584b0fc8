"""Properties of the registered jobs on the smallest driver tables."""

import os

from pyspark.sql import functions as F

from costwise.plans import all_queries

SF = os.environ.get("COSTWISE_TEST_SF", "/root/testdata/sf0.001")


def test_pairs_disjoint_balanced_and_cross_account(spark):
    r = all_queries()["gl_pairs"].build(spark, SF).collect()
    entries = [x["entry_no"] for x in r]
    assert len(entries) == len(set(entries)), "an entry is in two pairs"
    by_entry = {x["entry_no"]: x for x in r}
    for x in r:
        y = by_entry[x["bal_entry_no"]]
        assert y["bal_entry_no"] == x["entry_no"]
        assert x["account"] != y["account"]
        assert (x["debit"], x["credit"]) == (y["credit"], y["debit"])


def test_distribution_sums_to_difference(spark):
    d = all_queries()["distribute_difference"].build(spark, SF)
    diff = spark.read.parquet(f"{SF}/part.parquet").filter(F.col("p_size") % 10 == 0).select(
        F.col("p_partkey").alias("item_no"),
        (F.col("p_retailprice").cast("decimal(18,2)") * F.lit(0.01).cast("decimal(18,2)")).cast("double").alias("diff"))
    sums = d.groupBy("item_no").agg(F.sum("distrib_qty").alias("s"), F.count("*").alias("n")).join(diff, "item_no")
    for r in sums.collect():
        assert abs(r["s"] + r["diff"]) <= r["n"] * 0.5e-5 + 1e-9


def test_ageing_keeps_item_totals(spark):
    from costwise.operators.ageing import age_stock, month_buckets
    from costwise.plans import ageing as A
    from costwise.sources.tables import Tables
    t = Tables(spark, SF)
    b = month_buckets(A.moves(t), A.START)
    out = age_stock(b, A.MONTHS + 1)
    before = {r["item_no"]: r["q"] for r in b.groupBy("item_no").agg(F.sum("quantity").alias("q")).collect()}
    after = {r["item_no"]: r["q"] for r in out.groupBy("item_no").agg(F.sum("quantity").alias("q")).collect()}
    for item, q in after.items():
        assert before[item] == q and q > 0


def test_explosion_quantity_is_product_along_path(spark):
    rows = all_queries()["bom_explode"].build(spark, SF).select(
        "root_item", "line_path", "level", "quantity", "quantity_per").collect()
    node = {(r["root_item"], r["line_path"]): r for r in rows}
    assert any(r["level"] >= 2 for r in rows)
    for r in rows:
        if r["level"] == 0:
            assert r["quantity"] == 1.0
            continue
        parent_path = r["line_path"][: r["line_path"][:-1].rfind("_") + 1]
        p = node[(r["root_item"], parent_path)]
        assert p["level"] == r["level"] - 1
        assert abs(r["quantity"] - p["quantity"] * r["quantity_per"]) < 1e-6
