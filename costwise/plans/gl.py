"""G/L reconciliation of all posting days (pairs, one-to-many, errors, item links, gates)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import reconcile as R
from ..operators import stored
from ..session import materialize, scratch_path
from ..sources import driver as D
from .registry import register

DEC = "DECIMAL(18,2)"

GL_SQL = f"""WITH
gl AS (
  SELECT CAST(o_orderdate AS DATE) AS posting_date, l_orderkey AS transaction_no,
    l_orderkey * 1000000000 + row_number() OVER (PARTITION BY l_orderkey ORDER BY l_partkey, l_suppkey, l_linenumber, l_quantity,
      l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) AS entry_no,
    CASE WHEN ds THEN '6' ELSE '7' END || CAST(l_suppkey % 5 AS VARCHAR) AS account,
    CAST(l_linenumber % 3 AS INTEGER) AS source_type,
    CASE l_linenumber % 3 WHEN 1 THEN CAST(o_custkey AS VARCHAR) WHEN 2 THEN CAST(l_suppkey AS VARCHAR) ELSE '' END AS source_no,
    CASE WHEN l_discount = 0 THEN CAST(0 AS {DEC}) WHEN ds THEN CAST(l_quantity AS {DEC}) ELSE CAST(0 AS {DEC}) END AS debit,
    CASE WHEN l_discount = 0 THEN CAST(0 AS {DEC}) WHEN ds THEN CAST(0 AS {DEC}) ELSE CAST(l_quantity AS {DEC}) END AS credit,
    l_partkey AS part_no
  FROM (SELECT *, (l_returnflag = 'R' OR (l_returnflag = 'N' AND l_linestatus = 'O')) AS ds FROM lineitem) li
  JOIN orders ON l_orderkey = o_orderkey),
rel AS (
  SELECT entry_no AS gl_entry_no, transaction_no * 10 + part_no % 2 AS value_entry_no FROM gl WHERE part_no % 3 = 0
  UNION ALL
  SELECT entry_no, transaction_no * 10 + 5 FROM gl WHERE part_no % 12 = 0),
scope AS (SELECT * FROM gl WHERE debit != 0 OR credit != 0),
links AS (
  SELECT r.gl_entry_no AS entry_no,
         string_agg(CAST(r.value_entry_no AS VARCHAR), ',' ORDER BY r.value_entry_no) AS item_link
  FROM scope s JOIN rel r ON s.entry_no = r.gl_entry_no GROUP BY r.gl_entry_no),
s AS (SELECT scope.*, links.item_link FROM scope LEFT JOIN links USING (entry_no)),
itx AS (SELECT DISTINCT posting_date, transaction_no FROM s WHERE item_link IS NOT NULL),
ni AS (SELECT s.* FROM s ANTI JOIN itx USING (posting_date, transaction_no)),
item AS (SELECT s.* FROM s SEMI JOIN itx USING (posting_date, transaction_no)),
nd AS (SELECT *, row_number() OVER (PARTITION BY posting_date, transaction_no, debit ORDER BY entry_no) AS k FROM ni WHERE debit != 0),
nc AS (SELECT *, row_number() OVER (PARTITION BY posting_date, transaction_no, credit ORDER BY entry_no) AS k FROM ni WHERE credit != 0),
np AS (
  SELECT d.posting_date, d.transaction_no, least(d.entry_no, c.entry_no) AS e1, greatest(d.entry_no, c.entry_no) AS e2
  FROM nd d JOIN nc c ON d.posting_date = c.posting_date AND d.transaction_no = c.transaction_no
   AND d.debit = c.credit AND d.k = c.k),
nn AS (SELECT posting_date, transaction_no, count(*) AS n FROM ni GROUP BY ALL),
npr AS (
  SELECT np.*, nn.n, row_number() OVER (PARTITION BY np.posting_date, np.transaction_no ORDER BY e1) AS r
  FROM np JOIN nn USING (posting_date, transaction_no)),
pairs AS (
  SELECT posting_date, transaction_no, e1, e2 FROM npr
  WHERE r <= CASE WHEN n % 2 = 0 THEN n // 2 ELSE greatest(0, (n - 3) // 2) END),
pair_rows AS (
  SELECT p.posting_date, '1D - 1C' AS tip, p.transaction_no, a.entry_no, a.account, b.entry_no AS bal_entry_no,
    b.account AS bal_account, coalesce(nullif(a.source_type, 0), nullif(b.source_type, 0)) AS source_type,
    coalesce(nullif(a.source_no, ''), nullif(b.source_no, '')) AS source_no, a.debit, a.credit,
    CAST(NULL AS VARCHAR) AS item_link
  FROM pairs p JOIN ni a ON a.entry_no = p.e1 JOIN ni b ON b.entry_no = p.e2
  UNION ALL
  SELECT p.posting_date, '1D - 1C', p.transaction_no, b.entry_no, b.account, a.entry_no, a.account,
    coalesce(nullif(b.source_type, 0), nullif(a.source_type, 0)), coalesce(nullif(b.source_no, ''), nullif(a.source_no, '')),
    b.debit, b.credit, CAST(NULL AS VARCHAR)
  FROM pairs p JOIN ni a ON a.entry_no = p.e1 JOIN ni b ON b.entry_no = p.e2),
rest1 AS (SELECT * FROM ni WHERE entry_no NOT IN (SELECT e1 FROM pairs UNION ALL SELECT e2 FROM pairs)),
one_d AS (SELECT posting_date, transaction_no FROM rest1 GROUP BY ALL HAVING count(*) FILTER (WHERE debit != 0) = 1),
d_rows AS (
  SELECT a.posting_date, '1D - nC' AS tip, a.transaction_no, a.entry_no, a.account, b.entry_no AS bal_entry_no,
    b.account AS bal_account, coalesce(nullif(a.source_type, 0), b.source_type) AS source_type,
    coalesce(nullif(a.source_no, ''), b.source_no) AS source_no, b.credit AS debit, CAST(0 AS {DEC}) AS credit,
    CAST(NULL AS VARCHAR) AS item_link
  FROM rest1 a SEMI JOIN one_d USING (posting_date, transaction_no)
  JOIN rest1 b ON a.posting_date = b.posting_date AND a.transaction_no = b.transaction_no
  WHERE a.debit != 0 AND b.credit != 0
  UNION ALL
  SELECT b.posting_date, 'nC - 1D', b.transaction_no, b.entry_no, b.account, a.entry_no, a.account,
    coalesce(nullif(b.source_type, 0), a.source_type), coalesce(nullif(b.source_no, ''), a.source_no),
    CAST(0 AS {DEC}), b.credit, CAST(NULL AS VARCHAR)
  FROM rest1 a SEMI JOIN one_d USING (posting_date, transaction_no)
  JOIN rest1 b ON a.posting_date = b.posting_date AND a.transaction_no = b.transaction_no
  WHERE a.debit != 0 AND b.credit != 0),
rest2 AS (SELECT * FROM rest1 ANTI JOIN one_d USING (posting_date, transaction_no)),
one_c AS (SELECT posting_date, transaction_no FROM rest2 GROUP BY ALL HAVING count(*) FILTER (WHERE credit != 0) = 1),
c_rows AS (
  SELECT a.posting_date, '1C - nD' AS tip, a.transaction_no, a.entry_no, a.account, b.entry_no AS bal_entry_no,
    b.account AS bal_account, coalesce(nullif(a.source_type, 0), b.source_type) AS source_type,
    coalesce(nullif(a.source_no, ''), b.source_no) AS source_no, CAST(0 AS {DEC}) AS debit, b.debit AS credit,
    CAST(NULL AS VARCHAR) AS item_link
  FROM rest2 a SEMI JOIN one_c USING (posting_date, transaction_no)
  JOIN rest2 b ON a.posting_date = b.posting_date AND a.transaction_no = b.transaction_no
  WHERE a.credit != 0 AND b.debit != 0
  UNION ALL
  SELECT b.posting_date, 'nD - 1C', b.transaction_no, b.entry_no, b.account, a.entry_no, a.account,
    coalesce(nullif(b.source_type, 0), a.source_type), coalesce(nullif(b.source_no, ''), a.source_no),
    b.debit, CAST(0 AS {DEC}), CAST(NULL AS VARCHAR)
  FROM rest2 a SEMI JOIN one_c USING (posting_date, transaction_no)
  JOIN rest2 b ON a.posting_date = b.posting_date AND a.transaction_no = b.transaction_no
  WHERE a.credit != 0 AND b.debit != 0),
rest3 AS (SELECT * FROM rest2 ANTI JOIN one_c USING (posting_date, transaction_no)),
err_rows AS (
  SELECT posting_date, 'nonItem error' AS tip, transaction_no, entry_no, account, CAST(NULL AS BIGINT) AS bal_entry_no,
    CAST(NULL AS VARCHAR) AS bal_account, source_type, source_no, debit, credit, CAST(NULL AS VARCHAR) AS item_link
  FROM rest3),
lk AS (SELECT * FROM item WHERE item_link IS NOT NULL),
ld AS (SELECT *, row_number() OVER (PARTITION BY posting_date, transaction_no, item_link, debit ORDER BY entry_no) AS k FROM lk WHERE debit != 0),
lc AS (SELECT *, row_number() OVER (PARTITION BY posting_date, transaction_no, item_link, credit ORDER BY entry_no) AS k FROM lk WHERE credit != 0),
lp AS (
  SELECT d.posting_date, d.transaction_no, d.item_link, least(d.entry_no, c.entry_no) AS e1, greatest(d.entry_no, c.entry_no) AS e2
  FROM ld d JOIN lc c ON d.posting_date = c.posting_date AND d.transaction_no = c.transaction_no
   AND d.item_link = c.item_link AND d.debit = c.credit AND d.k = c.k),
link_rows AS (
  SELECT p.posting_date, 'item link' AS tip, p.transaction_no, a.entry_no, a.account, b.entry_no AS bal_entry_no,
    b.account AS bal_account, coalesce(nullif(a.source_type, 0), nullif(b.source_type, 0)) AS source_type,
    coalesce(nullif(a.source_no, ''), nullif(b.source_no, '')) AS source_no, a.debit, a.credit, p.item_link
  FROM lp p JOIN lk a ON a.entry_no = p.e1 JOIN lk b ON b.entry_no = p.e2
  UNION ALL
  SELECT p.posting_date, 'item link', p.transaction_no, b.entry_no, b.account, a.entry_no, a.account,
    coalesce(nullif(b.source_type, 0), nullif(a.source_type, 0)), coalesce(nullif(b.source_no, ''), nullif(a.source_no, '')),
    b.debit, b.credit, p.item_link
  FROM lp p JOIN lk a ON a.entry_no = p.e1 JOIN lk b ON b.entry_no = p.e2),
item_err AS (
  SELECT posting_date, 'Item error' AS tip, transaction_no, entry_no, account, CAST(NULL AS BIGINT) AS bal_entry_no,
    CAST(NULL AS VARCHAR) AS bal_account, source_type, source_no, debit, credit, item_link
  FROM lk WHERE entry_no NOT IN (SELECT e1 FROM lp UNION ALL SELECT e2 FROM lp)),
result AS (
  SELECT * FROM pair_rows UNION ALL SELECT * FROM d_rows UNION ALL SELECT * FROM c_rows
  UNION ALL SELECT * FROM err_rows UNION ALL SELECT * FROM link_rows UNION ALL SELECT * FROM item_err)
"""

_SEL = ("SELECT posting_date, tip, transaction_no, entry_no, account, bal_entry_no, bal_account, source_type, "
        "source_no, CAST(debit AS DOUBLE) AS debit, CAST(credit AS DOUBLE) AS credit, item_link FROM result ")


def reconciled(t, what: str):
    """``result``, ``gates`` or ``links`` of the reconciliation of all days, or its ``nonitem`` or ``item`` rows. Each step is run once for
    all queries that read it, and none that a query does not read."""
    def scoped():
        gl = materialize(D.gl_entries(t), "gl-entries")
        return R.scoped(gl, D.gl_item_relations(gl))

    if what == "links":
        return t.shared("gl-scope/links", scoped)
    scope = t.shared("gl-scope/scope", scoped)
    nonitem = lambda member: t.shared(f"gl-nonitem/{member}", lambda: R.nonitem_branch(scope))
    if what == "nonitem":
        return nonitem("rows")
    item = t.shared("gl-item", lambda: R.item_branch(scope))
    if what == "item":
        return item
    result = nonitem("rows").unionByName(item)
    return result if what == "result" else t.shared("gl-gates", lambda: R.balance_gates(scope, nonitem("rest"), result))


ITEM_TIPS = {R.TIP_ITEM_LINK, R.TIP_ITEM_ERROR}


def _result(t, tips):
    r = reconciled(t, "item" if ITEM_TIPS >= set(tips) else "nonitem").filter(F.col("tip").isin(list(tips)))
    return r.withColumn("debit", F.col("debit").cast("double")).withColumn("credit", F.col("credit").cast("double"))


def _reg(name, tips, doc):
    tips_sql = ", ".join(f"'{x}'" for x in tips)

    @register(name, GL_SQL + _SEL + f"WHERE tip IN ({tips_sql})")
    def q(t):
        return _result(t, tips)

    q.__doc__ = doc
    return q


gl_pairs = _reg("gl_pairs", [R.TIP_PAIR], "Greedy one-to-one debit/credit pairs with the 1-or-3 stop rule.")
gl_one_to_many = _reg("gl_one_to_many", [R.TIP_1D_NC, R.TIP_NC_1D], "One debit against n credits.")
gl_many_to_one = _reg("gl_many_to_one", [R.TIP_1C_ND, R.TIP_ND_1C], "One credit against n debits.")
gl_errors = _reg("gl_errors", [R.TIP_NONITEM_ERROR], "Unmatched entries of transactions without item links.")
gl_item_link = _reg("gl_item_link", [R.TIP_ITEM_LINK], "Pairs inside (transaction, value-entry link).")
gl_item_errors = _reg("gl_item_errors", [R.TIP_ITEM_ERROR], "Unmatched linked entries.")


@register("gl_link_key", GL_SQL + "SELECT entry_no, item_link FROM links")
def gl_link_key(t):
    """Ordered comma list of value-entry numbers per G/L entry."""
    return reconciled(t, "links")


@register("gl_gates", GL_SQL + f""",
g AS (
  SELECT 'non-item remainder unbalanced' AS gate, posting_date, transaction_no, sum(debit) AS debit, sum(credit) AS credit
  FROM rest1 GROUP BY ALL HAVING sum(debit) != sum(credit)
  UNION ALL
  SELECT 'non-item result unbalanced', posting_date, transaction_no, sum(debit), sum(credit)
  FROM result WHERE tip IN ('1D - 1C', '1D - nC', 'nC - 1D', '1C - nD', 'nD - 1C', 'nonItem error')
  GROUP BY ALL HAVING sum(debit) != sum(credit)
  UNION ALL
  SELECT 'item transactions unbalanced', posting_date, transaction_no, sum(debit), sum(credit)
  FROM item GROUP BY ALL HAVING sum(debit) != sum(credit)
  UNION ALL
  SELECT 'entries without link', posting_date, transaction_no, sum(debit), sum(credit)
  FROM item WHERE item_link IS NULL GROUP BY ALL
  UNION ALL
  SELECT 'item result unbalanced', posting_date, transaction_no, sum(debit), sum(credit)
  FROM result WHERE tip IN ('item link', 'Item error') GROUP BY ALL HAVING sum(debit) != sum(credit)
  UNION ALL
  SELECT 'non-item entries left', posting_date, transaction_no, sum(debit), sum(credit)
  FROM ni WHERE entry_no NOT IN (SELECT entry_no FROM result) GROUP BY ALL
  UNION ALL
  SELECT 'entries left', posting_date, transaction_no, sum(debit), sum(credit)
  FROM s WHERE entry_no NOT IN (SELECT entry_no FROM result) GROUP BY ALL)
SELECT gate, posting_date, transaction_no, CAST(debit AS DOUBLE) AS debit, CAST(credit AS DOUBLE) AS credit FROM g""")
def gl_gates(t):
    """Balance-gate violations (the source raises on the first; here every violation is a row)."""
    g = reconciled(t, "gates")
    return g.withColumn("debit", F.col("debit").cast("double")).withColumn("credit", F.col("credit").cast("double"))


MONTH = ("1996-03-01", "1996-03-31")


@register("gl_month", GL_SQL + _SEL + f"WHERE posting_date BETWEEN DATE '{MONTH[0]}' AND DATE '{MONTH[1]}'")
def gl_month(t):
    """Month driver: all reconciliation types for every day of one month, as one job (no day loop).
    The driver tables do not balance, so the gates do not stop it here."""
    gl = materialize(D.gl_entries(t, MONTH), "gl-entries")
    year, month, first = map(int, MONTH[0].split("-"))
    r = R.reconcile_month(gl, D.gl_item_relations(gl), year, month, first, int(MONTH[1][-2:]), strict=False)
    return r.withColumn("debit", F.col("debit").cast("double")).withColumn("credit", F.col("credit").cast("double"))


_BALANCED_SQL = GL_SQL.replace("WITH\ngl AS (", "WITH\ngl0 AS (", 1)
_BALANCED_SQL = _BALANCED_SQL[:_BALANCED_SQL.index("rel AS (")] + """gl AS (
  SELECT * FROM gl0
  UNION ALL
  SELECT posting_date, transaction_no, entry_no + 500000000, CASE account[1] WHEN '6' THEN '8' ELSE '9' END || account[2:], source_type, source_no,
         credit, debit, part_no FROM gl0),
rel AS (SELECT entry_no AS gl_entry_no, transaction_no * 10 + part_no % 2 AS value_entry_no FROM gl WHERE transaction_no % 3 = 0),
""" + _BALANCED_SQL[_BALANCED_SQL.index("scope AS ("):]


@register("gl_published", _BALANCED_SQL + _SEL + f"WHERE posting_date BETWEEN DATE '{MONTH[0]}' AND DATE '{MONTH[1]}'")
def gl_published(t):
    """A month of balanced entries reconciled, checked by all gates and published twice; a run over entries that do
    not balance is refused in between and changes nothing. The table as it then stands."""
    spark, path = t.spark, scratch_path(t.spark, "gl-published")
    year, month, first, last = *map(int, MONTH[0].split("-")), int(MONTH[1][-2:])
    broken = materialize(D.gl_entries(t, MONTH), "gl-entries")
    whole = materialize(D.gl_balanced(broken), "gl-entries")
    relations = D.gl_whole_relations(whole)
    R.reconcile_month(whole, relations, year, month, first, 15, path=path)
    try:
        R.reconcile_month(broken, D.gl_whole_relations(broken), year, month, first, last, path=path)
    except R.UnbalancedError:
        pass  # refused, as it must be; with nothing out of balance there is nothing to refuse
    R.reconcile_month(whole, relations, year, month, first, last, path=path)
    r = stored.read(spark, path, "posting_date")
    return r.withColumn("debit", F.col("debit").cast("double")).withColumn("credit", F.col("credit").cast("double")).select(*R.OUT_COLS)
