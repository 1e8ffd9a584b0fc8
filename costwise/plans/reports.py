"""Ledger reports in full: reconciled G/L, value entries by day and without link; stock by unit; real cost of listed packages."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import reports as ops
from ..operators import reconcile as R
from ..operators import stock
from ..session import materialize
from ..sources import driver as D
from . import costing
from .gl import GL_SQL
from .ledger import VALUE_PERIOD
from .registry import register

MONTH = ("1996-05-01", "1996-05-31")

_s = lambda c: c.cast("string")


def _dims(t):
    """Dimensions (code, name): of five codes from ``region``, accounts of two classes, customers and vendors."""
    r = t.region.select(F.col("r_regionkey").alias("code"), F.concat(F.substring("r_name", 1, 1), F.lower(F.substring("r_name", 2, 99))).alias("name"))
    accounts = [r.select(F.concat(F.lit(k), _s(F.col("code"))).alias("code"), F.concat(F.lit(n), F.col("name")).alias("name"))
                for k, n in (("6", "Cost "), ("7", "Income "))]
    return {"region": r, "accounts": accounts[0].unionByName(accounts[1]),
            "customers": t.customer.select(_s(F.col("c_custkey")).alias("code"), F.col("c_name").alias("name")),
            "vendors": t.supplier.select(_s(F.col("s_suppkey")).alias("code"), F.col("s_name").alias("name"))}


def gl_facts(gl):
    """Further facts of the G/L entries, from their part, transaction and entry number."""
    part = F.col("part_no")
    rate = (part % 3).cast("decimal(4,0)")
    money = lambda c: (c * rate).cast("decimal(18,2)")
    return gl.select(
        "entry_no", "transaction_no", F.concat(F.lit("B"), _s(part % 5)).alias("bal_account_no"),
        F.date_sub("posting_date", (part % 5).cast("int")).alias("document_date"), (part % 6).cast("int").alias("document_type"),
        F.concat(F.lit("D"), _s(F.col("transaction_no"))).alias("document_no"), F.concat(F.lit("X"), _s(part)).alias("external_document_no"),
        F.concat(F.lit("part "), _s(part)).alias("description"), money(F.col("debit")).alias("debit_fcy"), money(F.col("credit")).alias("credit_fcy"),
        F.when(part % 3 == 1, "EUR").when(part % 3 == 2, "USD").otherwise("").alias("currency"), F.concat(F.lit("G"), _s(part % 7)).alias("dimension_1"),
        F.concat(F.lit("H"), _s(part % 11)).alias("dimension_2"), F.concat(F.lit("S"), _s(part % 2)).alias("source_code"),
        (part % 13).alias("dimension_set_id"), (part % 8).cast("int").alias("fa_entry_type"), F.when(part % 50 == 0, part).otherwise(0).alias("fa_entry_no"))


@register("gl_reconciled_full", GL_SQL + f""",
x AS (SELECT entry_no, part_no, posting_date AS d, part_no % 3 AS k, debit * (part_no % 3) AS fd, credit * (part_no % 3) AS fc FROM gl)
SELECT r.posting_date, r.transaction_no, r.entry_no, r.account,
  (SELECT CASE left(r.account, 1) WHEN '6' THEN 'Cost ' ELSE 'Income ' END || left(r_name, 1) || lower(substr(r_name, 2)) FROM region
   WHERE CAST(r_regionkey AS VARCHAR) = substr(r.account, 2)) AS account_name,
  'B' || CAST(e.part_no % 5 AS VARCHAR) AS bal_account_no, r.bal_account AS offset_account,
  (SELECT CASE left(r.bal_account, 1) WHEN '6' THEN 'Cost ' ELSE 'Income ' END || left(r_name, 1) || lower(substr(r_name, 2)) FROM region
   WHERE CAST(r_regionkey AS VARCHAR) = substr(r.bal_account, 2)) AS offset_account_name,
  e.d - CAST(e.part_no % 5 AS INTEGER) AS document_date, dt.name AS document_type_name, 'D' || CAST(r.transaction_no AS VARCHAR) AS document_no,
  'X' || CAST(e.part_no AS VARCHAR) AS external_document_no, 'part ' || CAST(e.part_no AS VARCHAR) AS description,
  CAST(r.debit - r.credit AS DOUBLE) AS amount, CAST(r.debit AS DOUBLE) AS debit, CAST(r.credit AS DOUBLE) AS credit,
  CAST(fcy.d - fcy.c AS DOUBLE) AS amount_fcy, CAST(fcy.d AS DOUBLE) AS debit_fcy, CAST(fcy.c AS DOUBLE) AS credit_fcy,
  CASE fcy.k WHEN 1 THEN 'EUR' WHEN 2 THEN 'USD' ELSE '' END AS currency_code, 'G' || CAST(e.part_no % 7 AS VARCHAR) AS dimension_1,
  'H' || CAST(e.part_no % 11 AS VARCHAR) AS dimension_2, 'S' || CAST(e.part_no % 2 AS VARCHAR) AS source_code, st.name AS source_type_name, r.source_no,
  coalesce(c.c_name, v.s_name) AS source_name, e.part_no % 13 AS dimension_set_id, fa.name AS fa_entry_type_name,
  CASE WHEN e.part_no % 50 = 0 THEN e.part_no ELSE 0 END AS fa_entry_no, r.tip
FROM result r JOIN x e ON e.entry_no = r.entry_no
LEFT JOIN (
  SELECT entry_no, bal_entry_no, tip, k, CASE tip WHEN '1D - nC' THEN fc WHEN '1C - nD' THEN 0 ELSE fd END AS d,
         CASE tip WHEN '1C - nD' THEN fd WHEN '1D - nC' THEN 0 ELSE fc END AS c
  FROM (SELECT q.entry_no, q.bal_entry_no, q.tip, x.k, x.fd, x.fc FROM result q JOIN x
        ON x.entry_no = CASE WHEN q.tip IN ('1D - nC', '1C - nD') THEN q.bal_entry_no ELSE q.entry_no END)) fcy
  ON fcy.entry_no = r.entry_no AND fcy.bal_entry_no IS NOT DISTINCT FROM r.bal_entry_no AND fcy.tip = r.tip
LEFT JOIN (SELECT r_regionkey AS code, left(r_name, 1) || lower(substr(r_name, 2)) AS name FROM region) dt ON dt.code = e.part_no % 6
LEFT JOIN (SELECT r_regionkey AS code, left(r_name, 1) || lower(substr(r_name, 2)) AS name FROM region) st ON st.code = r.source_type
LEFT JOIN (SELECT r_regionkey AS code, left(r_name, 1) || lower(substr(r_name, 2)) AS name FROM region) fa ON fa.code = e.part_no % 8
LEFT JOIN customer c ON r.source_type = 1 AND r.source_no = CAST(c.c_custkey AS VARCHAR)
LEFT JOIN supplier v ON r.source_type = 2 AND r.source_no = CAST(v.s_suppkey AS VARCHAR)
WHERE r.posting_date BETWEEN DATE '{MONTH[0]}' AND DATE '{MONTH[1]}'""")
def gl_reconciled_full(t):
    """Reconciled G/L entries of a month with accounts, documents, dimensions, sources, fixed assets and foreign-currency amounts."""
    gl = materialize(D.gl_entries(t, MONTH), "gl-entries")
    result = R.reconcile(gl, D.gl_item_relations(gl), ("nonitem", "item"))["result"]
    d = _dims(t)
    out = ops.reconciled_report(gl_facts(gl), result, d["accounts"], d["region"], d["region"], d["region"], d["customers"], d["vendors"])
    money = ("amount", "debit", "credit", "amount_fcy", "debit_fcy", "credit_fcy")
    return out.select(*[F.col(c).cast("double").alias(c) if c in money else c for c in out.columns])


# --- value entries -----------------------------------------------------------------------------------------------------

_CODES = ("ledger_type", "source_type", "document_type", "order_type", "entry_type")


def value_entries(t):
    """Three value entries an order, with the codes of five dimensions (some without a name)."""
    o = t.orders.select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority", "o_totalprice",
                        F.explode(F.array(F.lit(0), F.lit(1), F.lit(5))).alias("k"))
    d, key, cust, k = F.col("o_orderdate").cast("date"), F.col("o_orderkey"), F.col("o_custkey"), F.col("k")
    price = F.col("o_totalprice").cast("decimal(18,2)")
    return o.select(
        (key * 10 + k).alias("entry_no"), F.concat(F.lit("I"), _s(cust)).alias("item_no"), F.date_add(d, k).alias("posting_date"),
        ((key + k) % 7).cast("int").alias("ledger_type"), _s(cust).alias("source_no"), F.concat(F.lit("D"), _s(key)).alias("document_no"),
        F.concat(F.lit("order "), _s(key)).alias("description"), F.concat(F.lit("L"), _s(cust % 4)).alias("location_code"),
        F.concat(F.lit("P"), _s(cust % 3)).alias("inventory_posting_group"), F.concat(F.lit("Q"), _s(cust % 2)).alias("source_posting_group"),
        (key * 3).alias("item_ledger_entry_no"), (cust % 10 + k).cast("decimal(18,2)").alias("valued_quantity"),
        (cust % 10).cast("decimal(18,2)").alias("invoiced_quantity"), (price / 4).cast("decimal(18,2)").alias("cost_per_unit"),
        F.col("o_orderpriority").alias("user_id"), F.concat(F.lit("S"), _s(key % 3)).alias("source_code"), (cust % 6).cast("int").alias("source_type"),
        (price * k).cast("decimal(18,2)").alias("sales_actual"), price.alias("cost_actual"), F.date_sub(d, 2).alias("document_date"),
        F.concat(F.lit("X"), _s(cust)).alias("external_document_no"), (key % 5).cast("int").alias("document_type"),
        (k * 1000).alias("document_line_no"), (key % 8).cast("int").alias("order_type"), F.concat(F.lit("O"), _s(key)).alias("order_no"),
        (k + 1).alias("order_line_no"), k.alias("entry_type"), F.date_add(d, 3).alias("sync_date"))


_VALUES_SQL = """
ve AS (
  SELECT o_orderkey * 10 + k AS entry_no, 'I' || CAST(o_custkey AS VARCHAR) AS item_no, CAST(o_orderdate AS DATE) + k AS posting_date,
    CAST(o_custkey AS VARCHAR) AS source_no, 'D' || CAST(o_orderkey AS VARCHAR) AS document_no, 'order ' || CAST(o_orderkey AS VARCHAR) AS description,
    'L' || CAST(o_custkey % 4 AS VARCHAR) AS location_code, 'P' || CAST(o_custkey % 3 AS VARCHAR) AS inventory_posting_group,
    'Q' || CAST(o_custkey % 2 AS VARCHAR) AS source_posting_group, o_orderkey * 3 AS item_ledger_entry_no,
    CAST(o_custkey % 10 + k AS DOUBLE) AS valued_quantity, CAST(o_custkey % 10 AS DOUBLE) AS invoiced_quantity,
    CAST(CAST((CAST(CAST(o_totalprice AS DECIMAL(18,2)) * 100 AS BIGINT) + 2) // 4 AS DECIMAL(18,2)) / 100 AS DOUBLE) AS cost_per_unit,
    o_orderpriority AS user_id, 'S' || CAST(o_orderkey % 3 AS VARCHAR) AS source_code,
    CAST(CAST(o_totalprice AS DECIMAL(18,2)) * k AS DOUBLE) AS sales_actual, CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) AS cost_actual,
    CAST(o_orderdate AS DATE) - 2 AS document_date, 'X' || CAST(o_custkey AS VARCHAR) AS external_document_no, k * 1000 AS document_line_no,
    'O' || CAST(o_orderkey AS VARCHAR) AS order_no, k + 1 AS order_line_no, CAST(o_orderdate AS DATE) + 3 AS sync_date,
    dim((o_orderkey + k) % 7) AS ledger_type_name, dim(o_custkey % 6) AS source_type_name, dim(o_orderkey % 5) AS document_type_name,
    dim(o_orderkey % 8) AS order_type_name, dim(k) AS entry_type_name
  FROM orders CROSS JOIN (VALUES (0), (1), (5)) ks(k))"""


def _with_dim(sql: str) -> str:
    """dim(code) is the region of that number, in its spelling as a name."""
    out = sql
    while "dim(" in out:
        at = out.index("dim(")
        depth, end = 0, at + 3
        while True:
            depth += {"(": 1, ")": -1}.get(out[end], 0)
            end += 1
            if not depth:
                break
        code = out[at + 3:end]
        out = out[:at] + f"(SELECT left(r_name, 1) || lower(substr(r_name, 2)) FROM region WHERE r_regionkey = {code})" + out[end:]
    return out


_NAMES = tuple(f"{c}_name" for c in _CODES)
_VALUE_COLUMNS = ("entry_no", "item_no", "posting_date", "source_no", "document_no", "description", "location_code", "inventory_posting_group",
                  "source_posting_group", "item_ledger_entry_no", "user_id", "source_code", "document_date", "external_document_no",
                  "document_line_no", "order_no", "order_line_no", *_NAMES)
_VALUE_MONEY = ("valued_quantity", "invoiced_quantity", "cost_per_unit", "sales_actual", "cost_actual")
SYNC_DATE = "1997-03-02"


@register("values_by_sync_full", _with_dim("WITH " + _VALUES_SQL) + f"""
SELECT {', '.join(_VALUE_COLUMNS + _VALUE_MONEY)} FROM ve WHERE sync_date = DATE '{SYNC_DATE}'""")
def values_by_sync_full(t):
    """Value entries synchronised on one date with ledger, source, document, order and entry type names."""
    region = _dims(t)["region"]
    out = ops.values_synchronised(value_entries(t), SYNC_DATE, {c: region for c in _CODES})
    return out.select(*_VALUE_COLUMNS, *[F.col(c).cast("double").alias(c) for c in _VALUE_MONEY])


_OPEN = ("entry_no", "user_id", "posting_date", "location_code", "ledger_type_name", "entry_type_name", "inventory_posting_group", "item_no",
         "document_type_name", "description", "document_no")


@register("unlinked_values_full", _with_dim(GL_SQL + "," + _VALUES_SQL) + f""",
linked AS (
  SELECT r.value_entry_no FROM gl a JOIN rel r ON a.entry_no = r.gl_entry_no
  WHERE a.posting_date BETWEEN DATE '{VALUE_PERIOD[0]}' AND DATE '{VALUE_PERIOD[1]}')
SELECT {', '.join('v.' + c for c in _OPEN)}, v.valued_quantity, v.cost_per_unit, v.sales_actual, v.cost_actual, g.posting_date AS gl_posting_date
FROM ve v LEFT JOIN rel b ON v.entry_no = b.value_entry_no LEFT JOIN gl g ON b.gl_entry_no = g.entry_no
WHERE v.posting_date BETWEEN DATE '{VALUE_PERIOD[0]}' AND DATE '{VALUE_PERIOD[1]}' AND v.entry_no NOT IN (SELECT value_entry_no FROM linked)""")
def unlinked_values_full(t):
    """Value entries of a period without a G/L link in it, with their names and the G/L posting dates of other periods."""
    gl = D.gl_entries(t)
    region = _dims(t)["region"]
    out = ops.unlinked_values(value_entries(t).drop("sync_date", "source_type", "order_type"), D.gl_item_relations(gl), gl, *VALUE_PERIOD,
                              {c: region for c in ("ledger_type", "entry_type", "document_type")})
    return out.select(*_OPEN, *[F.col(c).cast("double").alias(c) for c in ("valued_quantity", "cost_per_unit", "sales_actual", "cost_actual")],
                      "gl_posting_date")


# --- stock by unit -----------------------------------------------------------------------------------------------------

@register("stock_per_bin_unit", """
SELECT * FROM (
  SELECT l_partkey AS item_no, p_name AS description, p_type AS posting_group, 'L' || CAST(l_suppkey % 4 AS VARCHAR) AS location_code,
    'B' || CAST(l_linenumber AS VARCHAR) AS bin_code, l_linestatus AS lot_no,
    CASE l_linenumber % 3 WHEN 0 THEN 'BOX' WHEN 1 THEN 'UN' ELSE 'PAL' END AS uom, CASE WHEN p_name IS NOT NULL THEN 'UN' END AS base_uom,
    CAST(CAST(p_retailprice AS DECIMAL(18,2)) AS DOUBLE) AS unit_cost,
    CAST(round(sum(CASE WHEN l_returnflag = 'R' THEN -1 ELSE 1 END * CAST(l_quantity AS DECIMAL(18,2))), 3) AS DOUBLE) AS quantity
  FROM lineitem LEFT JOIN part ON p_partkey = l_partkey GROUP BY ALL) WHERE quantity != 0""")
def stock_per_bin_unit(t):
    """Stock per item, location, bin, lot and unit of measure; units are never added up."""
    n = F.col("l_linenumber")
    entries = t.lineitem.select(
        F.col("l_partkey").alias("item_no"), F.concat(F.lit("L"), _s(F.col("l_suppkey") % 4)).alias("location_code"),
        F.concat(F.lit("B"), _s(n)).alias("bin_code"), F.col("l_linestatus").alias("lot_no"),
        F.when(n % 3 == 0, "BOX").when(n % 3 == 1, "UN").otherwise("PAL").alias("uom"),
        (F.when(F.col("l_returnflag") == "R", -1).otherwise(1) * F.col("l_quantity").cast("decimal(18,2)")).alias("quantity"))
    out = stock.stock_per_bin(entries, D.items(t), ("item_no", "location_code", "bin_code", "lot_no", "uom"))
    return out.select("item_no", "description", "posting_group", "location_code", "bin_code", "lot_no", "uom", "base_uom",
                      F.col("unit_cost").cast("double").alias("unit_cost"), F.col("quantity").cast("double").alias("quantity"))


# --- real cost of listed packages --------------------------------------------------------------------------------------

@register("real_cost_packages", "WITH " + costing.ACTUAL_SQL.replace(
    "made AS (SELECT * RENAME (item AS source_no) FROM packages WHERE first_lines > 0),",
    "made AS (SELECT * RENAME (item AS source_no) FROM packages WHERE first_lines > 0 AND item IN (SELECT p_partkey FROM part WHERE p_size <= 10)\n"
    "  AND ord % 100 != 3),") + "\nSELECT * FROM actual")
def real_cost_packages(t):
    """Real cost of the orders of listed packages (here the small ones), without excluded orders."""
    listed = t.part.filter("p_size <= 10").select(F.col("p_partkey").alias("item_no"))
    excluded = t.orders.filter("o_orderkey % 100 = 3").select(F.col("o_orderkey").alias("order_no"))
    a, _ = costing.actual(t, listed, excluded)
    return costing._out(a)
