"""Product reports: representative package per part, finished products without / with new movement."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.picks import anti_any, latest_row
from ..sources import bom_world as W
from ..sources import driver as D
from .bom import BOM_WORLD_SQL
from .registry import register

CUTOFF = "2001-06-01"


@register("package_of_part", """
WITH y AS (
  SELECT DISTINCT l_partkey AS item_no,
    first_value('PK' || CAST(o_custkey AS VARCHAR)) OVER (PARTITION BY l_partkey
      ORDER BY o_orderpriority DESC, CASE o_orderstatus WHEN 'O' THEN 3 WHEN 'F' THEN 4 ELSE 2 END ASC,
               'PK' || CAST(o_custkey AS VARCHAR) ASC
      ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS colet
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE o_orderstatus IN ('O', 'F'))
SELECT y.item_no, c_custkey AS colet, c_name AS colet_description, c_mktsegment AS range
FROM customer JOIN y ON 'PK' || CAST(c_custkey AS VARCHAR) = y.colet""")
def package_of_part(t):
    """Representative package per part: by order location desc, status asc (package code as the last
    tie-break, which the source leaves open)."""
    o = t.orders.select("o_orderkey", F.col("o_orderpriority").alias("location_code"),
                        F.when(F.col("o_orderstatus") == "O", 3).when(F.col("o_orderstatus") == "F", 4)
                        .otherwise(2).alias("status"),
                        F.concat(F.lit("PK"), F.col("o_custkey").cast("string")).alias("source_no"))
    comp = t.lineitem.select(F.col("l_partkey").alias("item_no"), "l_orderkey")
    j = comp.join(o.filter(F.col("status") >= 3), F.col("l_orderkey") == F.col("o_orderkey"))
    pick = latest_row(j, ["item_no"], [F.col("location_code").desc(), F.col("status").asc(), F.col("source_no").asc()])
    items = t.customer.select(F.col("c_custkey").alias("colet"), F.col("c_name").alias("colet_description"),
                              F.col("c_mktsegment").alias("range"),
                              F.concat(F.lit("PK"), F.col("c_custkey").cast("string")).alias("_bom"))
    return pick.join(items, F.col("source_no") == F.col("_bom")).select("item_no", "colet", "colet_description", "range")


def _products(t):
    """Kits whose component is a finished package, plus packages that are no kit component."""
    from .prices import kit_components
    items = W.item_facts(t)
    kc = kit_components(t)
    names = t.part.select(F.col("p_partkey").alias("parent"), F.col("p_name").alias("kit_description"),
                          F.col("p_brand").alias("range"))
    comp = items.select(F.col("item_no").cast("long").alias("item"), F.col("description").alias("item_description"),
                        "item_type")
    kits = (kc.join(names, "parent").join(comp, "item").filter(F.col("item_type") == "PF")
            .select(F.lit("KIT").alias("type"), F.col("parent").alias("kit_no"), "kit_description", "range",
                    F.col("item").alias("item_no"), "item_description"))
    bc, rl = W.bom_candidates(t), W.routing_lines(t)
    pk = W.packages(t, items, bc, W.route_candidates(t, rl)).select(
        F.col("root_item").cast("long").alias("item_no"), F.col("root_description").alias("description"),
        F.col("root_range").alias("range"))
    single = pk.join(kc.select(F.col("item").alias("item_no")), "item_no", "left_anti").select(
        F.lit("MONOCOLET").alias("type"), F.col("item_no").alias("kit_no"), F.col("description").alias("kit_description"),
        "range", "item_no", F.col("description").alias("item_description"))
    return kits.unionByName(single).distinct()


_PRODUCTS_SQL = BOM_WORLD_SQL + """,
kc AS (
  SELECT k.p_partkey AS parent, c.p_partkey AS item FROM part k JOIN part c ON c.p_partkey IN (k.p_partkey + 1, k.p_partkey + 2)
  WHERE k.p_type = 'PROMO'),
prod AS (
  SELECT 'KIT' AS type, kc.parent AS kit_no, k.p_name AS kit_description, k.p_brand AS range, kc.item AS item_no,
    i.description AS item_description
  FROM kc JOIN part k ON k.p_partkey = kc.parent JOIN items i ON i.item_no = CAST(kc.item AS VARCHAR)
  WHERE i.item_type = 'PF'
  UNION
  SELECT 'MONOCOLET', CAST(item_no AS BIGINT), description, family, CAST(item_no AS BIGINT), description FROM pkgs
  WHERE CAST(item_no AS BIGINT) NOT IN (SELECT item FROM kc)),
moves AS (SELECT l_partkey - l_partkey % 4 AS item_no, CAST(l_shipdate AS DATE) + CAST(l_partkey // 4 % 10 * 300 AS INTEGER) AS d FROM lineitem)
"""


@register("product_no_movement", _PRODUCTS_SQL + """
SELECT * FROM prod a WHERE NOT EXISTS (SELECT 1 FROM moves b WHERE b.item_no IN (a.kit_no, a.item_no))""")
def product_no_movement(t):
    """Finished products (kits and single packages) none of whose two item keys has a ledger entry."""
    led = D.family_ledger(t).select("item_no")
    return anti_any(_products(t), led, ["kit_no", "item_no"], "item_no")


@register("product_new", _PRODUCTS_SQL + f"""
SELECT * FROM prod a
WHERE EXISTS (SELECT 1 FROM moves m WHERE m.d >= DATE '{CUTOFF}' AND m.item_no IN (a.kit_no, a.item_no))
  AND NOT EXISTS (SELECT 1 FROM moves n WHERE n.d < DATE '{CUTOFF}' AND n.item_no IN (a.kit_no, a.item_no))""")
def product_new(t):
    """Finished products whose first ledger movement (on either key) is on or after the cut-off.

    One pass over the ledger: first and last movement date per item, then each of the
    two keys looked up with an equi join (no OR join)."""
    first = D.family_ledger(t).groupBy("item_no").agg(F.min("posting_date").alias("first_date"))
    p = _products(t)
    a = first.select(F.col("item_no").alias("kit_no"), F.col("first_date").alias("_fk"))
    b = first.select(F.col("item_no"), F.col("first_date").alias("_fi"))
    j = p.join(a, "kit_no", "left").join(b, "item_no", "left")
    fd = F.least("_fk", "_fi")
    return j.filter(fd.isNotNull() & (fd >= F.lit(CUTOFF).cast("date"))).select(*p.columns)
