"""Ledger reports: G/L for a fiscal year, reconciled G/L report, value entries without G/L
link, value entries by sync date."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..sources import driver as D
from .gl import GL_SQL, reconciled
from .registry import register

FISCAL = ("1996-05-01", "1997-04-30")
CLASSES = ("3", "6", "7")
VALUE_PERIOD = ("1997-02-01", "1997-02-28")
SYNC_DATE = "1997-03-02"
# G/L source-type and value-entry-type code lists.
SOURCE_TYPES = {0: " ", 1: "Customer", 2: "Vendor", 3: "Bank Account", 4: "Fixed Asset"}
VALUE_ENTRY_TYPES = {0: "Direct Cost", 1: "Revaluation", 2: "Rounding", 3: "Indirect Cost", 4: "Variance", 5: "Total"}


def _code(col, codes):
    out = None
    for k, v in codes.items():
        out = (F.when(col == k, F.lit(v)) if out is None else out.when(col == k, F.lit(v)))
    return out


def _code_sql(col, codes):
    return "CASE " + " ".join(f"WHEN {col} = {k} THEN '{v}'" for k, v in codes.items()) + " END"


def _names(t, gl):
    c = t.customer.select(F.col("c_custkey").cast("string").alias("_cn"), F.col("c_name").alias("_cname"))
    v = t.supplier.select(F.col("s_suppkey").cast("string").alias("_vn"), F.col("s_name").alias("_vname"))
    return (gl.join(c, (F.col("source_type") == 1) & (F.col("source_no") == F.col("_cn")), "left")
            .join(v, (F.col("source_type") == 2) & (F.col("source_no") == F.col("_vn")), "left")
            .withColumn("source_name", F.coalesce("_cname", "_vname")))


@register("gl_fiscal", GL_SQL + f"""
SELECT left(a.account, 1) AS class, a.entry_no, a.posting_date, 'D' || CAST(a.transaction_no AS VARCHAR) AS document_no,
  a.account, CAST(a.debit AS DOUBLE) AS debit, CAST(a.credit AS DOUBLE) AS credit,
  CAST(a.debit - a.credit AS DOUBLE) AS amount, {_code_sql('a.source_type', SOURCE_TYPES)} AS source_type,
  a.source_no, coalesce(c.c_name, v.s_name) AS source_name
FROM gl a
LEFT JOIN customer c ON a.source_type = 1 AND a.source_no = CAST(c.c_custkey AS VARCHAR)
LEFT JOIN supplier v ON a.source_type = 2 AND a.source_no = CAST(v.s_suppkey AS VARCHAR)
WHERE left(a.account, 1) IN ('3', '6', '7') AND a.posting_date BETWEEN DATE '{FISCAL[0]}' AND DATE '{FISCAL[1]}'""")
def gl_fiscal(t):
    """G/L entries of one fiscal year for account classes 3, 6 and 7 with source names."""
    gl = D.gl_entries(t, FISCAL).filter(F.substring("account", 1, 1).isin(list(CLASSES)))
    j = _names(t, gl)
    return j.select(F.substring("account", 1, 1).alias("class"), "entry_no", "posting_date",
                    F.concat(F.lit("D"), F.col("transaction_no").cast("string")).alias("document_no"), "account",
                    F.col("debit").cast("double").alias("debit"), F.col("credit").cast("double").alias("credit"),
                    (F.col("debit") - F.col("credit")).cast("double").alias("amount"),
                    _code(F.col("source_type"), SOURCE_TYPES).alias("source_type"), "source_no", "source_name")


@register("gl_reconciled", GL_SQL + f"""
SELECT r.posting_date, r.tip, r.transaction_no, r.entry_no, r.account, r.bal_entry_no, r.bal_account,
  'D' || CAST(r.transaction_no AS VARCHAR) AS document_no, {_code_sql('r.source_type', SOURCE_TYPES)} AS source_type,
  r.source_no, coalesce(c.c_name, v.s_name) AS source_name, CAST(r.debit AS DOUBLE) AS debit,
  CAST(r.credit AS DOUBLE) AS credit, r.item_link
FROM result r
LEFT JOIN customer c ON r.source_type = 1 AND r.source_no = CAST(c.c_custkey AS VARCHAR)
LEFT JOIN supplier v ON r.source_type = 2 AND r.source_no = CAST(v.s_suppkey AS VARCHAR)""")
def gl_reconciled(t):
    """Reconciliation rows with document number, source-type name and customer/vendor name."""
    j = _names(t, reconciled(t, "result"))
    return j.select("posting_date", "tip", "transaction_no", "entry_no", "account", "bal_entry_no", "bal_account",
                    F.concat(F.lit("D"), F.col("transaction_no").cast("string")).alias("document_no"),
                    _code(F.col("source_type"), SOURCE_TYPES).alias("source_type"), "source_no", "source_name",
                    F.col("debit").cast("double").alias("debit"), F.col("credit").cast("double").alias("credit"),
                    "item_link")


def value_entries(t):
    o = t.orders.select("o_orderkey", "o_orderdate", "o_orderpriority", "o_totalprice",
                        F.explode(F.array(F.lit(0), F.lit(1), F.lit(5))).alias("k"))
    d = F.col("o_orderdate").cast("date")
    return o.select(
        (F.col("o_orderkey") * 10 + F.col("k")).alias("entry_no"), F.date_add(d, F.col("k")).alias("posting_date"),
        F.col("k").alias("entry_type"), F.concat(F.lit("D"), F.col("o_orderkey").cast("string")).alias("document_no"),
        F.col("o_orderpriority").alias("user_id"), F.col("o_totalprice").cast("decimal(18,2)").alias("cost_amount"),
        F.date_add(d, 3).alias("sync_date"))


VALUE_SQL = """
ve AS (
  SELECT o_orderkey * 10 + k AS entry_no, CAST(o_orderdate AS DATE) + k AS posting_date, k AS entry_type,
    'D' || CAST(o_orderkey AS VARCHAR) AS document_no, o_orderpriority AS user_id,
    CAST(o_totalprice AS DECIMAL(18,2)) AS cost_amount, CAST(o_orderdate AS DATE) + 3 AS sync_date
  FROM orders CROSS JOIN (VALUES (0), (1), (5)) ks(k))"""


@register("unlinked_values", GL_SQL + "," + VALUE_SQL + f""",
linked AS (
  SELECT r.value_entry_no FROM gl a JOIN rel r ON a.entry_no = r.gl_entry_no
  WHERE a.posting_date BETWEEN DATE '{VALUE_PERIOD[0]}' AND DATE '{VALUE_PERIOD[1]}'),
nol AS (
  SELECT * FROM ve WHERE posting_date BETWEEN DATE '{VALUE_PERIOD[0]}' AND DATE '{VALUE_PERIOD[1]}'
    AND entry_no NOT IN (SELECT value_entry_no FROM linked))
SELECT y.entry_no, y.user_id, y.posting_date, {_code_sql('y.entry_type', VALUE_ENTRY_TYPES)} AS entry_type,
  y.document_no, CAST(y.cost_amount AS DOUBLE) AS cost_amount, c.posting_date AS gl_posting_date
FROM nol y LEFT JOIN rel b ON y.entry_no = b.value_entry_no LEFT JOIN gl c ON b.gl_entry_no = c.entry_no""")
def unlinked_values(t):
    """Value entries of a period with no G/L link in that period, with any later G/L posting date."""
    gl = D.gl_entries(t)
    rel = D.gl_item_relations(gl)
    ve = value_entries(t).filter(F.col("posting_date").between(*VALUE_PERIOD))
    linked = D.gl_item_relations(D.gl_entries(t, VALUE_PERIOD)).select(F.col("value_entry_no").alias("entry_no"))
    nol = ve.join(linked, "entry_no", "left_anti")
    g = gl.select(F.col("entry_no").alias("gl_entry_no"), F.col("posting_date").alias("gl_posting_date"))
    j = (nol.join(rel.withColumnRenamed("value_entry_no", "entry_no"), "entry_no", "left")
         .join(g, "gl_entry_no", "left"))
    return j.select("entry_no", "user_id", "posting_date", _code(F.col("entry_type"), VALUE_ENTRY_TYPES).alias("entry_type"),
                    "document_no", F.col("cost_amount").cast("double").alias("cost_amount"), "gl_posting_date")


@register("values_by_sync", "WITH " + VALUE_SQL + f"""
SELECT entry_no, posting_date, {_code_sql('entry_type', VALUE_ENTRY_TYPES)} AS entry_type, document_no, user_id,
  CAST(cost_amount AS DOUBLE) AS cost_amount
FROM ve WHERE sync_date = DATE '{SYNC_DATE}'""")
def values_by_sync(t):
    """Value entries synchronised on one date, with the entry-type name."""
    ve = value_entries(t).filter(F.col("sync_date") == F.lit(SYNC_DATE).cast("date"))
    return ve.select("entry_no", "posting_date", _code(F.col("entry_type"), VALUE_ENTRY_TYPES).alias("entry_type"),
                     "document_no", "user_id", F.col("cost_amount").cast("double").alias("cost_amount"))
