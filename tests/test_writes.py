"""Stored tables: parts, manifest, merge, archive, gated publication (temporary folders)."""

import datetime as dt
import random
import tempfile
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from costwise.operators import reconcile, stored


@pytest.fixture
def root():
    return tempfile.mkdtemp(prefix="costwise-stored-", dir="/tmp")


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def test_publish_replaces_only_the_parts_it_has(spark, root):
    path = f"{root}/t"
    stored.publish(spark.createDataFrame([("2022-01-01", 1), ("2022-01-02", 2)], "d string, v int").withColumn("d", F.to_date("d")), path, "d")
    before = set(stored.read(spark, path, "d", ["2022-01-01"]).inputFiles())
    stored.publish(spark.createDataFrame([("2022-01-02", 20), ("2022-01-02", 21)], "d string, v int").withColumn("d", F.to_date("d")), path, "d")
    assert rows(stored.read(spark, path, "d").withColumn("d", F.col("d").cast("string")), "d", "v") == [
        ("2022-01-01", 1), ("2022-01-02", 20), ("2022-01-02", 21)]
    assert before & set(stored.read(spark, path, "d").inputFiles())
    stored.publish(spark.createDataFrame([], "d date, v int"), path, "d")  # no rows: no change
    assert stored.manifest(spark, path)[0] == 2
    with pytest.raises(ValueError):
        stored.publish(spark.createDataFrame([(None, 1)], "d date, v int"), path, "d")
    assert stored.manifest(spark, path)[0] == 2


def test_rows_without_a_manifest_are_not_the_table(spark, root):
    """A job that died after its rows and before its manifest."""
    path = f"{root}/t"
    stored.publish(spark.createDataFrame([(1, 1)], "p int, v int"), path, "p")
    spark.createDataFrame([(1, 99), (2, 99)], "p int, v int").write.partitionBy("p").parquet(f"{path}/runs/run=r2-dead")
    assert rows(stored.read(spark, path, "p"), "p", "v") == [(1, 1)]


def test_two_writers_of_one_version(spark, root, monkeypatch):
    path = f"{root}/t"
    stored.publish(spark.createDataFrame([(1, 1)], "p int, v int"), path, "p")
    seen = stored.manifest(spark, path)
    stored.publish(spark.createDataFrame([(1, 2)], "p int, v int"), path, "p")
    monkeypatch.setattr(stored, "manifest", lambda *_: seen)
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        stored.publish(spark.createDataFrame([(1, 3)], "p int, v int"), path, "p")
    monkeypatch.undo()
    assert rows(stored.read(spark, path, "p"), "p", "v") == [(1, 2)]


def test_merge_writes_touched_buckets_only(spark, root):
    path, n = f"{root}/t", 16
    stored.create(spark.range(400).select("id", F.lit("old").alias("v"), F.lit(5).alias("ts")), path, ["id"], n)
    files = set(stored.table(spark, path).inputFiles())
    change = spark.createDataFrame([(3, "new", 6), (4, "late", 4), (5, "even", 5), (1000, "added", 1)], "id long, v string, ts int")
    stored.merge(change, path, ["id"], "ts", n)
    got = {r.id: r.v for r in stored.table(spark, path).collect()}
    assert len(got) == 401 and (got[3], got[4], got[5], got[1000]) == ("new", "old", "even", "added")
    kept = files & set(stored.table(spark, path).inputFiles())
    touched = {int(r[0]) for r in change.select(F.pmod(F.xxhash64("id"), F.lit(n))).collect()}
    assert all(f"_bucket={b}/" not in f for f in kept for b in touched)
    assert {f.split("_bucket=")[1].split("/")[0] for f in kept} == {str(b) for b in range(n)} - {str(b) for b in touched}
    stored.merge(change, path, ["id"], "ts", n)
    assert {r.id: r.v for r in stored.table(spark, path).collect()} == got
    stored.merge(change.limit(0), path, ["id"], "ts", n)
    stored.merge(change, f"{root}/new", ["id"], "ts", n)
    assert stored.table(spark, f"{root}/new").count() == 4


def test_archive_refuses_null_and_repeat(spark, root):
    df = spark.createDataFrame([(1, "a")], "k int, v string")
    stored.archive({"t": df}, dt.date(2022, 1, 31), root)
    with pytest.raises(ValueError):
        stored.archive({"u": df, "t": df}, dt.date(2022, 1, 31), root)
    with pytest.raises(ValueError):
        stored.archive({"t": df}, None, root)
    assert stored.manifest(spark, f"{root}/u") == (0, {})
    stored.archive({"t": df}, dt.date(2022, 2, 28), root)
    assert stored.read(spark, f"{root}/t", "bom_date").count() == 2


ENTRIES = "posting_date date, transaction_no long, entry_no long, account string, source_type int, source_no string, debit decimal(18,2), credit decimal(18,2)"


def entries(spark, amounts):
    """(day, transaction, debit account, credit account, debit, credit) as two entries each."""
    out, n = [], 0
    for day, txn, d, c in amounts:
        for account, debit, credit in (("6", d, 0), ("7", 0, c)):
            n += 1
            out.append((dt.date(2022, 3, day), txn, n, account, 0, "", Decimal(debit), Decimal(credit)))
    return spark.createDataFrame(out, ENTRIES)


def test_month_is_published_only_if_all_gates_hold(spark, root):
    path = f"{root}/gl"
    relations = spark.createDataFrame([], "gl_entry_no long, value_entry_no long")
    good = entries(spark, [(1, 1, 5, 5), (2, 2, 7, 7)])
    reconcile.reconcile_month(good, relations, 2022, 3, path=path)
    table = lambda: rows(stored.read(spark, path, "posting_date"), "posting_date", "entry_no", "bal_entry_no")
    first = table()
    assert [r[1:] for r in first] == [(1, 2), (2, 1), (3, 4), (4, 3)]
    bad = entries(spark, [(1, 1, 5, 5), (2, 2, 7, 6)])
    with pytest.raises(reconcile.UnbalancedError):
        reconcile.reconcile_month(bad, relations, 2022, 3, path=path)
    assert table() == first
    # one good day of the broken month may go
    reconcile.reconcile_month(bad, relations, 2022, 3, 1, 1, path=path)
    reconcile.reconcile_month(good, relations, 2022, 3, path=path)
    assert table() == first


def test_gates_see_what_is_left(spark):
    """An entry without a link in a transaction with links is reported by two gates."""
    e = entries(spark, [(1, 1, 5, 5), (1, 1, 3, 3)])
    relations = spark.createDataFrame([(1, 9), (2, 9)], "gl_entry_no long, value_entry_no long")
    got = {(r.gate, float(r.debit), float(r.credit)) for r in reconcile.reconcile(e, relations)["gates"].collect()}
    assert got == {("entries without link", 3.0, 3.0), ("entries left", 3.0, 3.0)}


def test_hot_transaction_on_shared_accounts(spark):
    """100,000 entries of one transaction, three accounts on both sides, some entries with two sides."""
    import time

    from costwise.operators.reconcile import match_pairs
    rng = random.Random(3)
    rows_, want = [], []
    for e in range(100_000):
        amount = rng.randint(1, 400)
        kind = rng.random()
        d, c = (amount, 0) if kind < 0.495 else (0, amount) if kind < 0.99 else (amount, rng.randint(1, 400))
        rows_.append((1, e, rng.choice("ABC"), Decimal(d), Decimal(c)))
    df = spark.createDataFrame(rows_, "txn int, entry_no bigint, account string, debit decimal(18,2), credit decimal(18,2)").repartition(8)
    t0 = time.time()
    got = sorted((r.e1, r.e2) for r in match_pairs(df, ["txn"], False).collect())
    took = time.time() - t0
    # the rule entry by entry, over open entries by amount (a list scan)
    by = {}
    gone = set()
    for e, account, d, c in [(r[1], r[2], r[3], r[4]) for r in rows_]:
        best = None
        for k in (("D", c), ("C", d)):
            if k[1]:
                live = by[k] = [o for o in by.get(k, ()) if o[0] not in gone]
                hit = next((o for o in live if o[1] != account), None)
                if hit and (best is None or hit[0] < best[0]):
                    best = hit
        if best:
            gone.add(best[0])
            want.append((best[0], e))
        else:
            for k in (("D", d), ("C", c)):
                if k[1]:
                    by.setdefault(k, []).append((e, account))
    assert got == sorted(want)
    assert took < 60


def test_shared_views_follow_the_tables(spark, root):
    """A view is built once for one state of the tables, and again when a table's files change."""
    import shutil

    from costwise.sources.tables import DRIVER_TABLES, Tables
    for name in DRIVER_TABLES:
        shutil.copy(f"/root/testdata/sf0.001/{name}.parquet", f"{root}/{name}.parquet")
    built = []

    def build(t):
        built.append(1)
        return {"n": t.part.groupBy().count(), "names": t.part.select("p_name").distinct()}

    first, second = Tables(spark, root), Tables(spark, root)
    n = first.shared("parts/n", lambda: build(first)).first()[0]
    assert second.shared("parts/names", lambda: build(second)).count() and len(built) == 1
    part = spark.read.parquet(f"{root}/part.parquet").limit(7).toPandas()
    part.to_parquet(f"{root}/part.parquet")
    spark.catalog.clearCache()
    third = Tables(spark, root)
    assert third.shared("parts/n", lambda: build(third)).first()[0] == 7 != n and len(built) == 2
