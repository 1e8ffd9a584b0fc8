"""Item master and finished-package headers in full."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import items as ops
from ..operators.timeline import join_versions, placed, version_timeline
from ..session import materialize, spread
from ..sources import bom_world as W
from ..sources import driver as D
from ..sources import price_world as P
from ..sources import version_world as V
from .costs import COST_CTES, ITEM_UOM_SQL, item_uom, unit_cost_sql
from .dated import world_sql
from .registry import QUERIES, register

_Q = "DECIMAL(18,9)"
_TYPE, _COST = unit_cost_sql("estimate_cost", "nav_last_direct_cost", "nav_unit_cost", "nav_standard_cost", "last_purchase_price",
                             "legacy_unit_cost")

#: CTEs from ``c`` and ``item_uom`` up to ``master``, names prefixed m_.
MASTER_CTES = f"""
m_item AS (
  SELECT CAST(p_partkey AS VARCHAR) AS item_no, p_name AS description, CASE WHEN p_size % 9 != 0 THEN p_brand END AS range,
    CASE WHEN p_type = 'SMALL' THEN 'MAT_PRIMA' WHEN p_type IN ('ECONOMY', 'STANDARD') THEN CASE WHEN p_size % 6 = 1 THEN 'PF_KIT' ELSE 'PF' END
         ELSE 'SEMIFABR' END AS item_type,
    'M' || CAST(p_size % 30 AS VARCHAR) AS m1, 'M' || CAST(p_size % 4 + 22 AS VARCHAR) AS m2,
    CASE WHEN p_size % 2 != 0 THEN 'F' || CAST(p_size % 3 + 1 AS VARCHAR) END AS own,
    CASE WHEN EXISTS (SELECT 1 FROM part x WHERE x.p_partkey = 2 * part.p_partkey + 1) OR EXISTS (SELECT 1 FROM part x WHERE x.p_partkey = 2 * part.p_partkey + 2)
         THEN 'B' || CAST(p_partkey AS VARCHAR) END AS production_bom_no,
    CASE WHEN p_type != 'SMALL' THEN 'R' || CAST(p_partkey AS VARCHAR) END AS routing_no, p_brand AS technical_family, p_size AS size,
    CASE WHEN p_size % 5 != 0 THEN 'A' END AS cod_abcd, c.nav_unit AS nav_unit_cost, c.nav_standard AS nav_standard_cost,
    c.nav_last AS nav_last_direct_cost,
    CASE p_size % 5 WHEN 0 THEN 'PAL' WHEN 1 THEN NULL ELSE 'BOX' END AS purch_uom,
    CASE p_size % 4 WHEN 0 THEN 'PAL' WHEN 1 THEN NULL ELSE 'BOX' END AS sales_uom, p_retailprice
  FROM part JOIN c ON c.item_no = p_partkey),
m_fact AS (SELECT 'M' || CAST(n_nationkey AS VARCHAR) AS m, 'F' || CAST(n_nationkey % 3 + 1 AS VARCHAR) AS f FROM nation WHERE n_nationkey % 7 < 4),
m_fx AS (SELECT CASE n_nationkey WHEN 1 THEN 'EUR' ELSE 'USD' END AS cur, CAST(4 + n_nationkey * 0.1234 AS DECIMAL(10,4)) AS rate
         FROM nation WHERE n_nationkey IN (1, 2)),
m_rate AS (
  SELECT a.item_no, upper(a.code) AS code, CASE WHEN a.qty_per_uom = 0 THEN -1 ELSE CAST(1 / CAST(a.qty_per_uom AS DOUBLE) AS {_Q}) END AS rate FROM item_uom a),
m_buy AS (
  SELECT item_no, uom, value FROM (
    SELECT CAST(l_partkey AS VARCHAR) AS item_no, CASE l_suppkey % 4 WHEN 1 THEN 'BOX' WHEN 2 THEN 'UN' WHEN 3 THEN 'PAL' END AS uom,
      CAST(price * coalesce(rate, 1) AS {_Q}) AS value,
      row_number() OVER (PARTITION BY l_partkey ORDER BY CAST(l_shipdate AS DATE) DESC, l_orderkey * 10 + l_linenumber DESC, price DESC, k.cur,
                         coalesce(CASE l_suppkey % 4 WHEN 1 THEN 'BOX' WHEN 2 THEN 'UN' WHEN 3 THEN 'PAL' END, '')) AS rn
    FROM (SELECT *, CAST(CAST(l_discount AS DECIMAL(18,2)) * 100 AS DECIMAL(18,2)) AS price,
                 CASE l_linenumber % 3 WHEN 1 THEN 'EUR' WHEN 2 THEN 'USD' ELSE '' END AS cur FROM lineitem) k
    LEFT JOIN m_fx ON m_fx.cur = k.cur WHERE price != 0) WHERE rn = 1),
m_sell AS (
  SELECT item_no, uom, vat, value FROM (
    SELECT CAST(l_partkey AS VARCHAR) AS item_no, CASE WHEN l_linenumber = 5 THEN 'KG' WHEN l_linenumber % 2 = 0 THEN 'BOX' END AS uom,
      l_returnflag = 'R' AS vat, CAST(price * coalesce(rate, 1) AS {_Q}) AS value,
      row_number() OVER (PARTITION BY l_partkey ORDER BY CAST(l_shipdate AS DATE) DESC, l_orderkey * 10 + l_linenumber DESC, price DESC, k.cur,
        CASE WHEN l_linenumber = 5 THEN 'KG' WHEN l_linenumber % 2 = 0 THEN 'box' ELSE '' END, l_returnflag = 'R') AS rn
    FROM (SELECT *, CAST(l_quantity AS DECIMAL(18,2)) AS price, CASE WHEN l_suppkey % 3 = 0 THEN 'EUR' ELSE 'GBP' END AS cur FROM lineitem) k
    LEFT JOIN m_fx ON m_fx.cur = k.cur WHERE price != 0) WHERE rn = 1),
m_est AS (
  SELECT item_no, CASE size % 4 WHEN 0 THEN 'PAL' WHEN 1 THEN 'BOX' WHEN 3 THEN 'UN' END AS uom, CAST(p_retailprice AS {_Q}) AS cost,
    CASE WHEN size % 8 < 4 THEN DATE '2022-03-01' ELSE DATE '2021-06-01' END AS on_ FROM m_item WHERE size > 20),
m_raw AS (
  SELECT i.*, coalesce(f1.f, f2.f, i.own) AS factory,
    CAST(e.cost AS {_Q}) AS e_cost, e.on_ = (SELECT max(on_) FROM m_est) AS e_now,
    CASE WHEN e.item_no IS NULL OR e.uom IS NULL OR e.uom = 'UN' THEN 1 ELSE coalesce(re.rate, -1) END AS e_rate,
    b.value AS b_value, CASE WHEN coalesce(b.uom, i.purch_uom) IS NULL OR coalesce(b.uom, i.purch_uom) = 'UN' THEN 1 ELSE coalesce(rb.rate, -1) END AS b_rate,
    s.value AS s_value, s.vat, CASE WHEN coalesce(s.uom, i.sales_uom) IS NULL THEN 1 ELSE coalesce(rs.rate, -1) END AS s_rate
  FROM m_item i LEFT JOIN m_fact f1 ON f1.m = i.m1 LEFT JOIN m_fact f2 ON f2.m = i.m2
  LEFT JOIN m_est e ON e.item_no = i.item_no LEFT JOIN m_rate re ON re.item_no = i.item_no AND re.code = e.uom
  LEFT JOIN m_buy b ON b.item_no = i.item_no LEFT JOIN m_rate rb ON rb.item_no = i.item_no AND rb.code = coalesce(b.uom, i.purch_uom)
  LEFT JOIN m_sell s ON s.item_no = i.item_no LEFT JOIN m_rate rs ON rs.item_no = i.item_no AND rs.code = coalesce(s.uom, i.sales_uom)),
m_cost AS (
  SELECT *, CASE WHEN e_now THEN CAST(e_cost * abs(CAST(e_rate AS {_Q})) AS DECIMAL(15,5)) END AS estimate_cost,
    CASE WHEN NOT e_now THEN CAST(e_cost * abs(CAST(e_rate AS {_Q})) AS DECIMAL(15,5)) END AS legacy_unit_cost,
    CAST(b_value * abs(CAST(b_rate AS {_Q})) AS DECIMAL(15,5)) AS last_purchase_price,
    CAST(s_value * abs(CAST(s_rate AS {_Q})) AS DECIMAL(15,5)) AS last_sales_price FROM m_raw),
master AS (
  SELECT item_no, description, range, item_type, factory, production_bom_no, routing_no, technical_family,
    nullif(size * 10, 0) / 1000 AS length, nullif(size % 10 * 100, 0) / 1000 AS width, nullif(size % 3 * 50, 0) / 1000 AS height, cod_abcd,
    'UN' AS base_uom, nav_unit_cost, nav_standard_cost, nav_last_direct_cost, estimate_cost, last_purchase_price, legacy_unit_cost,
    {_TYPE} AS unit_cost_type, {_COST} AS selected_unit_cost, last_sales_price, vat AS price_includes_vat,
    CASE WHEN e_now AND e_rate = -1 THEN 'CIFRAJ;' ELSE '' END || CASE WHEN NOT e_now AND e_rate = -1 THEN 'LECACY;' ELSE '' END
    || CASE WHEN b_value IS NOT NULL AND b_rate = -1 THEN 'PURCHASE;' ELSE '' END
    || CASE WHEN s_value IS NOT NULL AND s_rate = -1 THEN 'SALES;' ELSE '' END AS errors
  FROM m_cost)"""

_TEXT = ("item_no", "description", "range", "item_type", "factory", "production_bom_no", "routing_no", "technical_family", "cod_abcd", "base_uom",
         "unit_cost_type", "price_includes_vat", "errors")
_NUMBER = ("length", "width", "height", "nav_unit_cost", "nav_standard_cost", "nav_last_direct_cost", "estimate_cost", "last_purchase_price",
           "legacy_unit_cost", "selected_unit_cost", "last_sales_price")


def _sql(text, number, table: str) -> str:
    return "\nSELECT " + ", ".join(text) + ", " + ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in number) + f" FROM {table}"


def master(t):
    return ops.item_master(P.items(t), P.manufactures(t), P.estimates(t), P.purchase_prices(t), P.sales_prices(t), P.fx_rates(t), item_uom(t),
                           P.dimensions(t))


def written_master(t):
    """The item master, built once for the jobs and steps that read it."""
    return t.shared("item-master", lambda: master(t))


@register("item_master_full", "WITH " + COST_CTES + "," + ITEM_UOM_SQL + "," + MASTER_CTES + _sql(_TEXT, _NUMBER, "master"))
def item_master_full(t):
    """Item master with factories, dimensions, converted estimate, legacy, purchase and sales prices in home currency, and error tags."""
    return master(t).select(*_TEXT, *[F.col(c).cast("double").alias(c) for c in _NUMBER])


_HEAD_TEXT = ("item_no", "description", "item_type", "factory", "production_bom_no", "bom_version", "bom_location", "routing_no", "route_version",
              "route_location", "avg_qty_type", "first_prod_date", "first_sale_date", "cod_abcd", "price_includes_vat")
_HEAD_NUMBER = ("avg_qty", "last_sales_price", "nav_unit_cost", "length")


@register("package_headers_full", world_sql([W.AS_OF]).replace("('F3')),", "('F3'), ('F9')),", 1).replace("tree AS (", MASTER_CTES.strip() + """,
h_avg AS (
  SELECT source_no, round(avg(q) / 100) * 100 AS a FROM (
    SELECT 'B' || CAST(l_partkey AS VARCHAR) AS source_no, l_quantity * 10 AS q FROM lineitem JOIN orders ON o_orderkey = l_orderkey
    WHERE o_orderstatus != 'P' AND l_quantity * 10 > 50) GROUP BY source_no),
h_date AS (
  SELECT CAST(l_partkey AS VARCHAR) AS item_no, min(CAST(l_shipdate AS DATE)) FILTER (l_returnflag NOT IN ('R', 'A') AND l_linestatus != 'O') AS made,
    min(CAST(l_shipdate AS DATE)) FILTER (l_returnflag = 'R') AS sold FROM lineitem GROUP BY ALL),
tree AS (""", 1) + """
SELECT m.item_no, m.description, m.item_type, m.factory, m.production_bom_no, b.version AS bom_version, b.location AS bom_location, m.routing_no,
  r.version AS route_version, r.location AS route_location, CASE WHEN coalesce(a.a, 0) < 50 THEN 'Default' ELSE 'Calculated' END AS avg_qty_type,
  d.made AS first_prod_date, d.sold AS first_sale_date, m.cod_abcd, m.price_includes_vat,
  CAST(CASE WHEN coalesce(a.a, 0) < 50 THEN 200 ELSE a.a END AS DOUBLE) AS avg_qty, CAST(m.last_sales_price AS DOUBLE) AS last_sales_price,
  CAST(m.nav_unit_cost AS DOUBLE) AS nav_unit_cost, CAST(m.length AS DOUBLE) AS length
FROM master m
LEFT JOIN bpick b ON b.key = m.production_bom_no AND b.loc = coalesce(m.factory, 'F9')
LEFT JOIN rpick r ON r.key = m.routing_no AND r.loc = coalesce(b.location, m.factory, 'F9')
LEFT JOIN h_avg a ON a.source_no = m.production_bom_no LEFT JOIN h_date d ON d.item_no = m.item_no
WHERE m.item_type LIKE 'PF%' AND m.production_bom_no IN (SELECT key FROM dcand)""")
def package_headers_full(t):
    out = headers(t)
    return out.select(*_HEAD_TEXT, *[F.col(c).cast("double").alias(c) for c in _HEAD_NUMBER])


def headers(t):
    """Finished packages (PF…) with a versioned BOM: versions of their factory, average order without simulated ones, first production and sale."""
    items = written_master(t)
    boms, routes = materialize(V.bom_candidates(t), "masters"), materialize(V.routing_candidates(t), "masters")
    days = F.array(F.lit(W.AS_OF).cast("date"))
    bt, rt = version_timeline(boms, [W.AS_OF]), version_timeline(routes, [W.AS_OF])
    own = (items.filter(F.col("item_type").startswith("PF"))
           .join(spread(boms.select(F.col("key").alias("production_bom_no")).distinct()), "production_bom_no", "left_semi")
           .withColumn("_days", days))
    own = join_versions(own, bt, placed(bt), F.col("production_bom_no"), F.col("factory"), "_days", "bom_version", "bom_location")
    own = join_versions(own, rt, placed(rt), F.col("routing_no"), F.coalesce("bom_location", "factory"), "_days", "route_version", "route_location")
    picked = own.select("item_no", "bom_version", "bom_location", "route_version", "route_location")
    ledger = D.item_ledger(t).select(F.col("item_no").cast("string").alias("item_no"), "posting_date", "entry_type")
    return ops.package_headers(items, picked, P.production_orders(t), ledger)


_KIT_TEXT = ("kit_no", "kit_description", "kit_range", "cod_abcd", "kit_first_prod_date", "kit_first_sale_date", "item_no", "item_description",
             "item_type", "factory", "item_family", "item_first_prod_date", "item_first_sale_date", "uom", "unit_cost_type", "convert_errors")
_KIT_NUMBER = ("quantity_per", "length", "width", "height", "unit_cost")
_HEADS_CTES, _HEADS_SELECT = QUERIES["package_headers_full"].sql.rsplit("\nSELECT m.item_no,", 1)


@register("kit_components_full", _HEADS_CTES + ",\npack AS (SELECT m.item_no," + _HEADS_SELECT + """),
kit AS (
  SELECT CAST(k.p_partkey AS VARCHAR) AS kit_no, CAST(i.p_partkey AS VARCHAR) AS item_no, CASE WHEN i.p_size % 5 = 0 THEN 'BOX' ELSE 'UN' END AS uom,
         1 + k.p_partkey % 3 AS quantity_per
  FROM part k JOIN part i ON i.p_partkey IN (k.p_partkey + 1, k.p_partkey + 2) WHERE k.p_type = 'PROMO'),
kit_date AS (
  SELECT CAST(l_partkey AS VARCHAR) AS kit_no, min(CAST(l_shipdate AS DATE)) FILTER (l_returnflag NOT IN ('R', 'A') AND l_linestatus != 'O') AS made,
    min(CAST(l_shipdate AS DATE)) FILTER (l_returnflag = 'R') AS sold FROM lineitem GROUP BY ALL)
SELECT kit.kit_no, k.description AS kit_description, k.range AS kit_range, k.cod_abcd, d.made AS kit_first_prod_date, d.sold AS kit_first_sale_date,
  kit.item_no, i.description AS item_description, i.item_type, k.factory, i.technical_family AS item_family,
  p.first_prod_date AS item_first_prod_date, p.first_sale_date AS item_first_sale_date, kit.uom,
  CASE WHEN p.item_no IS NULL THEN i.unit_cost_type ELSE 'BOM' END AS unit_cost_type,
  CASE WHEN p.item_no IS NULL THEN i.errors || CASE WHEN kit.uom != 'UN' AND coalesce(u.qty_per_uom, 0) = 0 THEN 'BOM' ELSE '' END END AS convert_errors,
  CAST(kit.quantity_per AS DOUBLE) AS quantity_per, CAST(i.length AS DOUBLE) AS length, CAST(i.width AS DOUBLE) AS width, CAST(i.height AS DOUBLE) AS height,
  CASE WHEN p.item_no IS NULL THEN CAST(CAST(CAST(i.selected_unit_cost AS DECIMAL(18,9)) *
    CASE WHEN kit.uom = 'UN' OR coalesce(u.qty_per_uom, 0) = 0 THEN CAST(1 AS DECIMAL(18,9)) ELSE u.qty_per_uom END AS DECIMAL(15,5)) AS DOUBLE) END AS unit_cost
FROM kit JOIN master k ON k.item_no = kit.kit_no LEFT JOIN master i ON i.item_no = kit.item_no LEFT JOIN pack p ON p.item_no = kit.item_no
LEFT JOIN kit_date d ON d.kit_no = kit.kit_no LEFT JOIN item_uom u ON u.item_no = kit.item_no AND upper(u.code) = kit.uom""")
def kit_components_full(t):
    """Kit components with first assembly and sale of the kit, dates of component packages and converted unit costs."""
    from .prices import kit_components
    text = lambda c: F.col(c).cast("string").alias(c)
    kits = kit_components(t).select(F.col("parent").cast("string").alias("kit_no"), F.col("item").cast("string").alias("item_no"), "quantity_per", "uom")
    # what a kit puts out is assembled
    assembled = t.part.filter("p_type = 'PROMO'").select(F.col("p_partkey").alias("item_no"), F.lit(True).alias("_kit"))
    ledger = D.item_ledger(t).join(spread(assembled), "item_no", "left").select(
        text("item_no"), "posting_date",
        F.when(F.col("_kit") & (F.col("entry_type") == D.ENTRY_OUTPUT), D.ENTRY_ASSEMBLY).otherwise(F.col("entry_type")).alias("entry_type"))
    out = ops.kit_components(kits, written_master(t), headers(t), ledger, item_uom(t))
    return out.select(*_KIT_TEXT, *[F.col(c).cast("double").alias(c) for c in _KIT_NUMBER])
