"""Cost selection, unit conversion and the unit-cost upsert."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.exprs import unit_cost
from ..operators.convert import assert_unique, with_uom_rate
from ..operators.picks import latest_row
from ..operators import stored
from ..operators.upsert import upsert_newer
from ..session import scratch_path, spread
from .registry import register

COST_CTES = """
agg AS (
  SELECT l_partkey, min(l_quantity) AS min_q, max(l_quantity) AS max_q, count(*) AS n
  FROM lineitem GROUP BY l_partkey),
c AS (
  SELECT p_partkey AS item_no,
    CASE WHEN p_size % 5 IN (1, 2) THEN CAST(p_retailprice AS DECIMAL(18,2)) END AS nav_unit,
    CASE WHEN p_size % 5 IN (2, 3) THEN CAST(p_retailprice AS DECIMAL(18,2)) END AS nav_standard,
    CASE WHEN p_size % 4 = 0 THEN CAST(a.max_q AS DECIMAL(18,2)) ELSE CAST(0 AS DECIMAL(18,2)) END AS nav_last,
    CASE WHEN p_size > 45 THEN CAST(p_retailprice AS DECIMAL(18,2)) END AS estimate,
    CASE WHEN p_size % 2 = 0 THEN CAST(a.min_q AS DECIMAL(18,2)) END AS purchase,
    CASE WHEN p_size % 3 = 0 THEN CAST(a.n AS DECIMAL(18,2)) END AS legacy
  FROM part LEFT JOIN agg a ON a.l_partkey = p_partkey)"""


def unit_cost_sql(e, d, u, s, p, g):
    """(type, cost) SQL CASE expressions of the unit-cost selection."""
    z = lambda x: f"coalesce({x}, 0)"
    conds = [
        (f"{z(e)} != 0", "Cifraj", e),
        (f"{z(d)} != 0 AND {z(d)} >= {z(u)} AND {z(d)} >= {z(s)}", "NAV Last Direct Cost", d),
        (f"{z(u)} != 0 AND {z(u)} >= {z(s)} AND {z(u)} > {z(d)}", "NAV Unit Cost", u),
        (f"{z(s)} != 0 AND {z(s)} > {z(u)} AND {z(s)} > {z(d)}", "NAV Standard Cost", s),
        (f"{z(p)} != 0", "NAV Last Purchase Price", p),
        (f"{z(g)} != 0", "Legacy Unit Cost", g),
    ]
    kind = "CASE " + " ".join(f"WHEN {c} THEN '{k}'" for c, k, _ in conds) + " ELSE 'No Unit Cost' END"
    cost = ("CAST(CASE " + " ".join(f"WHEN {c} THEN {v}" for c, _, v in conds)
            + " ELSE 0 END AS DECIMAL(15,5))")
    return kind, cost


_UC_TYPE, _UC_COST = unit_cost_sql("estimate", "nav_last", "nav_unit", "nav_standard", "purchase", "legacy")


def _cost_inputs(t, lines=None):
    """``lines``: line items added up by part and line number (min_q, max_q, n), if a job has them."""
    lines = t.lineitem.select("l_partkey", F.col("l_quantity").alias("min_q"), F.col("l_quantity").alias("max_q"), F.lit(1).alias("n")) \
        if lines is None else lines
    agg = lines.groupBy("l_partkey").agg(F.min("min_q").alias("min_q"), F.max("max_q").alias("max_q"), F.sum("n").alias("n"))
    p = t.part.join(spread(agg), F.col("l_partkey") == F.col("p_partkey"), "left")
    d = lambda c: c.cast("decimal(18,2)")
    size, price = F.col("p_size"), F.col("p_retailprice")
    return p.select(
        F.col("p_partkey").alias("item_no"),
        F.when((size % 5).isin(1, 2), d(price)).alias("nav_unit"),
        F.when((size % 5).isin(2, 3), d(price)).alias("nav_standard"),
        F.when(size % 4 == 0, d(F.col("max_q"))).otherwise(d(F.lit(0))).alias("nav_last"),
        F.when(size > 45, d(price)).alias("estimate"),
        F.when(size % 2 == 0, d(F.col("min_q"))).alias("purchase"),
        F.when(size % 3 == 0, d(F.col("n"))).alias("legacy"))


@register("unit_cost_type", "WITH " + COST_CTES + f"""
SELECT item_no, {_UC_TYPE} AS unit_cost_type, CAST({_UC_COST} AS DOUBLE) AS unit_cost FROM c""")
def unit_cost_type(t):
    """Unit-cost selection over six cost columns per part."""
    c = _cost_inputs(t)
    uc = unit_cost("nav_unit", "nav_standard", "nav_last", "estimate", "purchase", "legacy")
    return c.select("item_no", uc.unit_cost_type.alias("unit_cost_type"),
                    uc.unit_cost.cast("double").alias("unit_cost"))


ITEM_UOM_SQL = """
item_uom AS (
  SELECT CAST(p_partkey AS VARCHAR) AS item_no, 'UN' AS code, CAST(1 AS DECIMAL(18,9)) AS qty_per_uom FROM part
  UNION ALL
  SELECT CAST(p_partkey AS VARCHAR), CASE WHEN p_size % 6 = 0 THEN 'box' ELSE 'BOX' END, CAST(p_size AS DECIMAL(18,9)) FROM part
  UNION ALL
  SELECT CAST(p_partkey AS VARCHAR), 'PAL', CAST(p_size * 12 AS DECIMAL(18,9)) FROM part WHERE p_size % 4 != 0)"""


def item_uom(t):
    p = t.part
    key = F.col("p_partkey").cast("string").alias("item_no")
    un = p.select(key, F.lit("UN").alias("code"), F.lit(1).cast("decimal(18,9)").alias("qty_per_uom"))
    box = p.select(key, F.when(F.col("p_size") % 6 == 0, F.lit("box")).otherwise(F.lit("BOX")).alias("code"),
                   F.col("p_size").cast("decimal(18,9)").alias("qty_per_uom"))
    pal = p.filter(F.col("p_size") % 4 != 0).select(key, F.lit("PAL").alias("code"),
                                                    (F.col("p_size") * 12).cast("decimal(18,9)").alias("qty_per_uom"))
    return un.unionByName(box).unionByName(pal)


@register("uom_convert", "WITH " + ITEM_UOM_SQL + """,
req AS (
  SELECT DISTINCT CAST(l_partkey AS VARCHAR) AS item_no,
         CASE WHEN l_returnflag = 'R' THEN 'box' ELSE 'UN' END AS from_uom,
         CASE WHEN l_linestatus = 'O' THEN 'PAL' ELSE 'Box' END AS to_uom
  FROM lineitem)
SELECT r.item_no, r.from_uom, r.to_uom,
  round(CASE WHEN coalesce(s.qty_per_uom, 0) = 0 OR coalesce(g.qty_per_uom, 0) = 0 THEN -1
        ELSE CAST(g.qty_per_uom AS DOUBLE) / CAST(s.qty_per_uom AS DOUBLE) END, 9) AS rate
FROM req r
LEFT JOIN item_uom s ON upper(r.item_no) = upper(s.item_no) AND upper(r.from_uom) = upper(s.code)
LEFT JOIN item_uom g ON upper(r.item_no) = upper(g.item_no) AND upper(r.to_uom) = upper(g.code)""")
def uom_convert(t):
    """Conversion rate per requested (item, from, to); -1 when a side is missing or 0."""
    req = t.lineitem.select(
        F.col("l_partkey").cast("string").alias("item_no"),
        F.when(F.col("l_returnflag") == "R", F.lit("box")).otherwise(F.lit("UN")).alias("from_uom"),
        F.when(F.col("l_linestatus") == "O", F.lit("PAL")).otherwise(F.lit("Box")).alias("to_uom")).distinct()
    units = item_uom(t)
    # two rows for one lookup are an error, as in the source
    assert_unique(units.select(F.upper("item_no").alias("item"), F.upper("code").alias("code")), ["item", "code"], "unit of measure")
    out = with_uom_rate(req, "item_no", "from_uom", "to_uom", units)
    return out.select("item_no", "from_uom", "to_uom", F.round(F.col("rate").cast("double"), 9).alias("rate"))


_UPSERT_SQL = """
WITH tgt AS (
  SELECT item_no, descr, cost, mod_de FROM (
    SELECT o_custkey AS item_no, o_orderpriority AS descr, CAST(o_totalprice AS DECIMAL(18,2)) AS cost,
           o_orderdate AS mod_de,
           row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn
    FROM orders WHERE o_orderstatus = 'F') WHERE rn = 1),
stg AS (
  SELECT item_no, descr, cost, mod_de FROM (
    SELECT o_custkey AS item_no, o_orderpriority AS descr, CAST(o_totalprice AS DECIMAL(18,2)) AS cost,
           o_orderdate AS mod_de,
           row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) AS rn
    FROM orders WHERE o_orderstatus = 'O') WHERE rn = 1)
SELECT coalesce(s.item_no, t.item_no) AS item_no,
  CASE WHEN s.item_no IS NOT NULL AND (t.item_no IS NULL OR s.mod_de >= t.mod_de) THEN s.descr ELSE t.descr END AS descr,
  CAST(CASE WHEN s.item_no IS NOT NULL AND (t.item_no IS NULL OR s.mod_de >= t.mod_de) THEN s.cost ELSE t.cost END AS DOUBLE) AS cost,
  CASE WHEN s.item_no IS NOT NULL AND (t.item_no IS NULL OR s.mod_de >= t.mod_de) THEN s.mod_de ELSE t.mod_de END AS mod_de
FROM tgt t FULL OUTER JOIN stg s ON t.item_no = s.item_no"""


def _upsert_inputs(t):
    o = t.orders.select(F.col("o_custkey").alias("item_no"), F.col("o_orderpriority").alias("descr"),
                        F.col("o_totalprice").cast("decimal(18,2)").alias("cost"),
                        F.col("o_orderdate").alias("mod_de"), "o_orderkey", "o_orderstatus")
    target = latest_row(o.filter(F.col("o_orderstatus") == "F"), ["item_no"],
                        [F.col("mod_de").asc(), F.col("o_orderkey").asc()])
    staging = latest_row(o.filter(F.col("o_orderstatus") == "O"), ["item_no"], [F.col("o_orderkey").desc()])
    cols = ["item_no", "descr", "cost", "mod_de"]
    return target.select(*cols), staging.select(*cols)


@register("upsert_newer_wins", _UPSERT_SQL)
def upsert_newer_wins(t):
    """Staging rows replace target rows with the same key unless older; new keys are added."""
    target, staging = _upsert_inputs(t)
    out = upsert_newer(target, staging, ["item_no"], "mod_de")
    return out.withColumn("cost", F.col("cost").cast("double"))


@register("upsert_stored", _UPSERT_SQL)
def upsert_stored(t):
    """The same upsert into a stored table in 32 buckets: the target is written, staging is merged twice (the second time changes
    nothing), the table is read back."""
    target, staging = _upsert_inputs(t)
    path = scratch_path(t.spark, "unit-costs")
    stored.create(target, path, ["item_no"], 32)
    for _ in range(2):
        stored.merge(staging, path, ["item_no"], "mod_de", 32)
    return stored.table(t.spark, path).withColumn("cost", F.col("cost").cast("double"))


#: Dates of the archived snapshots.
SNAPSHOTS = ("1999-12-31", "2000-01-31")


@register("snapshot_archive", "WITH " + COST_CTES + "," + ITEM_UOM_SQL + f""",
dates(d) AS (VALUES {", ".join(f"(DATE '{d}')" for d in SNAPSHOTS)})
SELECT 'unit_cost' AS archived, d AS bom_date, CAST(item_no AS VARCHAR) AS key, CAST({_UC_COST} AS DOUBLE) AS value FROM c, dates
UNION ALL
SELECT 'item_uom', d, item_no || '/' || code, CAST(qty_per_uom AS DOUBLE) FROM item_uom, dates""")
def snapshot_archive(t):
    """Unit costs and unit conversions archived as of two dates and read back."""
    c = _cost_inputs(t)
    uc = unit_cost("nav_unit", "nav_standard", "nav_last", "estimate", "purchase", "legacy")
    tables = {"unit_cost": c.select(F.col("item_no").cast("string").alias("key"), uc.unit_cost.cast("double").alias("value")),
              "item_uom": item_uom(t).select(F.concat_ws("/", "item_no", "code").alias("key"), F.col("qty_per_uom").cast("double").alias("value"))}
    path = scratch_path(t.spark, "archive")
    for d in SNAPSHOTS:
        stored.archive(tables, d, path)
    parts = [stored.read(t.spark, f"{path}/{n}", "bom_date").select(F.lit(n).alias("archived"), "bom_date", "key", "value") for n in tables]
    return parts[0].unionByName(parts[1])
