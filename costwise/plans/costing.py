"""Actual production cost of finished orders, and actual vs standard (BOM and routing) cost."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.explode import explode_routes, null_leaf_costs
from ..session import spread
from ..sources import driver as D
from .bom import BOM_WORLD_SQL, _components
from .registry import register

SINCE = "1996-01-01"
# Hourly labour rate and overhead factor; item entry-type names.
HOURLY_RATE, OVERHEAD = "9.33", "4.95"
ENTRY_TYPE_NAMES = {0: "Purchase", 1: "Sale", 2: "Positive Adjmt.", 3: "Negative Adjmt.", 4: "Transfer",
                    5: "Consumption", 6: "Output", 9: "Assembly Output"}
_ETN = "CASE " + " ".join(f"WHEN kind = {k} THEN '{v}'" for k, v in ENTRY_TYPE_NAMES.items()) + " END"


def _per(a, b):
    return F.round((F.col(a) / F.col(b)).cast("decimal(38,12)"), 2)


def _per_sql(a, b):
    # exact: a has 2 decimals and b is a whole number; round half away from zero in integers
    ia, ib = f"CAST({a} * 100 AS BIGINT)", f"CAST({b} AS BIGINT)"
    return (f"(CAST(sign({ia}) * sign({ib}) * ((2 * abs({ia}) + abs({ib})) // (2 * abs({ib}))) AS DECIMAL(38,2))"
            f" * CAST(0.01 AS DECIMAL(3,2)))")


ACTUAL_SQL = f"""
led AS (
  SELECT l_orderkey AS ord, l_linenumber AS ln, l_partkey AS item, CAST(l_shipdate AS DATE) AS day,
    CASE l_returnflag WHEN 'R' THEN 1 WHEN 'A' THEN 5 ELSE if(l_linestatus = 'O', 0, 6) END AS kind,
    if(l_returnflag IN ('R', 'A'), -1, 1) AS sgn, CAST(l_quantity AS DECIMAL(18,2)) AS qty,
    CAST(l_extendedprice AS DECIMAL(18,2)) AS val, 'WC' || CAST(l_suppkey % 4 AS VARCHAR) AS wc,
    'M' || CAST(l_suppkey % 10 AS VARCHAR) AS machine, CAST(CAST(l_discount AS DECIMAL(18,2)) * 10 AS DECIMAL(18,2)) AS hours
  FROM lineitem),
outputs AS (
  SELECT ord, item, max(day) >= DATE '{SINCE}' AS recent, count(*) FILTER (WHERE ln = 1) AS first_lines,
    round(sum(sgn * qty) FILTER (WHERE ln = 1), 0) AS output, max(day) FILTER (WHERE ln = 1) AS last_output
  FROM led WHERE kind = 6 GROUP BY ord, item),
packages AS (
  SELECT outputs.*, p_name AS source_name, p_brand AS range, 'L' || CAST(o_custkey % 4 AS VARCHAR) AS location_code
  FROM outputs JOIN part ON p_partkey = item JOIN orders ON o_orderkey = ord
  WHERE recent AND o_orderstatus = 'F' AND p_type IN ('ECONOMY', 'STANDARD')),
made AS (SELECT * RENAME (item AS source_no) FROM packages WHERE first_lines > 0),
used AS (
  SELECT made.*, led.item, kind, round(-sum(sgn * qty), 2) AS q, round(-sum(sgn * val), 2) AS c
  FROM made JOIN led USING (ord) WHERE led.item <> source_no GROUP BY ALL HAVING round(-sum(sgn * qty), 2) <> 0),
worked AS (
  SELECT made.*, wc, machine, round(sum(hours), 2) AS h,
    round(round(sum(hours), 2) * CAST({HOURLY_RATE} AS DECIMAL(4,2)) * CAST({OVERHEAD} AS DECIMAL(4,2)), 2) AS c
  FROM made JOIN led USING (ord) GROUP BY ALL HAVING round(sum(hours), 2) <> 0),
lines AS (
  SELECT ord, source_no, source_name, range, output, last_output, location_code, 'MAT_CONSUMPTION' AS value_type,
    CAST(NULL AS VARCHAR) AS work_center, CAST(item AS VARCHAR) AS item_no, p_name AS item_name, p_type AS posting_group, {_ETN} AS entry_type,
    q, 'UN' AS uom, c
  FROM used LEFT JOIN part ON p_partkey = item
  UNION ALL
  SELECT ord, source_no, source_name, range, output, last_output, location_code, 'WORK_HOURS', wc, machine,
    'machine ' || machine, NULL, NULL, h, 'H', c
  FROM worked),
actual AS (
  SELECT 'ACTUAL' AS data_version, 'Finished' AS status, CAST(ord AS VARCHAR) AS order_no, source_no, source_name, range,
    CAST(output AS DOUBLE) AS output, last_output, location_code, value_type, CAST(work_center AS VARCHAR) AS work_center,
    item_no, item_name, posting_group, entry_type, CAST(q AS DOUBLE) AS quantity, uom, CAST(c AS DOUBLE) AS cost,
    CAST({_per_sql('q', 'output')} AS DOUBLE) AS quantity_per, CAST({_per_sql('c', 'output')} AS DOUBLE) AS cost_per
  FROM lines)"""

OUT = ["data_version", "status", "order_no", "source_no", "source_name", "range", "output", "last_output",
       "location_code", "value_type", "work_center", "item_no", "item_name", "posting_group", "entry_type",
       "quantity", "uom", "cost", "quantity_per", "cost_per"]


def _etn(col):
    out = None
    for k, v in ENTRY_TYPE_NAMES.items():
        out = F.when(col == k, F.lit(v)) if out is None else out.when(col == k, F.lit(v))
    return out


def actual(t, listed=None, excluded=None):
    """Consumption and labour of finished package orders, and these orders' packages; ``listed`` (item_no) limits the packages and
    ``excluded`` (order_no) leaves out orders, both before the ledgers are joined."""
    il = D.item_ledger(t).select("order_no", "order_line_no", "item_no", "posting_date", "entry_type", "quantity",
                                 "cost_amount")
    part = t.part
    pf = part.filter(F.col("p_type").isin("ECONOMY", "STANDARD")).select(
        F.col("p_partkey").alias("item_no"), F.col("p_name").alias("item_name"), F.col("p_brand").alias("range"))
    closed = t.orders.filter(F.col("o_orderstatus") == "F").select(
        F.col("o_orderkey").alias("order_no"),
        F.concat(F.lit("L"), (F.col("o_custkey") % 4).cast("string")).alias("location_code"))
    pfs = (il.filter((F.col("entry_type") == D.ENTRY_OUTPUT) & (F.col("posting_date") >= F.lit(SINCE).cast("date")))
           .select("order_no", "item_no").join(spread(pf), "item_no").join(spread(closed), "order_no").distinct())
    pfs = pfs if listed is None else pfs.join(spread(listed), "item_no", "left_semi")
    pfs = pfs if excluded is None else pfs.join(spread(excluded), "order_no", "left_anti")
    ords = (il.filter((F.col("order_line_no") == 1) & (F.col("entry_type") == D.ENTRY_OUTPUT))
            .join(spread(pfs), ["order_no", "item_no"])
            .groupBy("order_no", F.col("item_no").alias("source_no"), F.col("item_name").alias("source_name"), "range",
                     "location_code")
            .agg(F.round(F.sum("quantity"), 0).alias("output"), F.max("posting_date").alias("last_output")))
    ords = spread(t.derived("finished_orders", lambda: ords))
    items = part.select(F.col("p_partkey").alias("item_no"), F.col("p_name").alias("item_name"),
                        F.col("p_type").alias("posting_group"))
    head = ["order_no", "source_no", "source_name", "range", "output", "last_output", "location_code"]
    cons = (il.join(ords, "order_no").filter(F.col("item_no") != F.col("source_no")).join(spread(items), "item_no", "left")
            .groupBy(*head, "item_no", "item_name", "posting_group", "entry_type")
            .agg(F.round(-1 * F.sum("quantity"), 2).alias("quantity"), F.round(F.sum(-1 * F.col("cost_amount")), 2)
                 .alias("cost")))
    cons = cons.filter(F.col("quantity") != 0).select(
        F.lit("ACTUAL").alias("data_version"), F.lit("Finished").alias("status"),
        F.col("order_no").cast("string").alias("order_no"), "source_no", "source_name", "range", "output",
        "last_output", "location_code", F.lit("MAT_CONSUMPTION").alias("value_type"),
        F.lit(None).cast("string").alias("work_center"), F.col("item_no").cast("string").alias("item_no"),
        "item_name", "posting_group", _etn(F.col("entry_type")).alias("entry_type"), "quantity",
        F.lit("UN").alias("uom"), "cost", _per("quantity", "output").alias("quantity_per"),
        _per("cost", "output").alias("cost_per"))
    cap = D.capacity_ledger(t)
    rate = F.lit(HOURLY_RATE).cast("decimal(4,2)") * F.lit(OVERHEAD).cast("decimal(4,2)")
    ore = (cap.join(ords, "order_no").groupBy(*head, "work_center", "machine_no")
           .agg(F.round(F.sum("workers_qty"), 2).alias("work_hours"))
           .filter(F.col("work_hours") != 0).withColumn("cost", F.round(F.col("work_hours") * rate, 2)))
    ore = ore.select(
        F.lit("ACTUAL").alias("data_version"), F.lit("Finished").alias("status"),
        F.col("order_no").cast("string").alias("order_no"), "source_no", "source_name", "range", "output",
        "last_output", "location_code", F.lit("WORK_HOURS").alias("value_type"), "work_center",
        F.col("machine_no").alias("item_no"), F.concat(F.lit("machine "), F.col("machine_no")).alias("item_name"),
        F.lit(None).cast("string").alias("posting_group"), F.lit(None).cast("string").alias("entry_type"),
        F.col("work_hours").alias("quantity"), F.lit("H").alias("uom"), "cost",
        _per("work_hours", "output").alias("quantity_per"), _per("cost", "output").alias("cost_per"))
    return cons.unionByName(ore), pfs


def _out(df):
    return df.select(*[F.col(c).cast("double").alias(c) if c in ("output", "quantity", "cost", "quantity_per", "cost_per")
                       else F.col(c) for c in OUT])


@register("real_cost", "WITH " + ACTUAL_SQL + "\nSELECT * FROM actual")
def real_cost(t):
    """Actual material consumption and labour of finished package orders, per unit of output."""
    a, _ = actual(t)
    return _out(a)


@register("cost_actual_vs_standard", BOM_WORLD_SQL + "," + ACTUAL_SQL + f""",
pf_items AS (SELECT DISTINCT CAST(item AS VARCHAR) AS item_no, range FROM packages),
bdd AS (
  SELECT 'BDD' AS data_version, CAST(NULL AS VARCHAR) AS status, 'BDD' AS order_no, CAST(a.root_item AS BIGINT) AS source_no,
    p.description AS source_name, p.family AS range, CAST(NULL AS DOUBLE) AS output, CAST(NULL AS DATE) AS last_output,
    a.factory AS location_code, 'MAT_CONSUMPTION' AS value_type, CAST(NULL AS VARCHAR) AS work_center, a.item_no,
    a.item_description AS item_name, a.item_type AS posting_group, CAST(NULL AS VARCHAR) AS entry_type,
    CAST(NULL AS DOUBLE) AS quantity, a.uom, CAST(NULL AS DOUBLE) AS cost,
    CAST(round(a.quantity_w_scrap, 2) AS DOUBLE) AS quantity_per,
    CAST(round(CAST(a.quantity_w_scrap AS DECIMAL(38,9)) * CAST(a.unit_cost AS DECIMAL(38,5)), 2) AS DOUBLE) AS cost_per
  FROM bom a JOIN pf_items b ON a.root_item = b.item_no JOIN items p ON p.item_no = a.root_item
  WHERE a.is_leaf AND a.quantity_w_scrap != 0
  UNION ALL
  SELECT 'BDD', NULL, 'BDD', CAST(b.root_item AS BIGINT), p.description, pf.range, NULL, NULL, b.factory, 'WORK_HOURS',
    r.work_center, r.operation_no, 'operation ' || r.operation_no, NULL, NULL, NULL, 'H', NULL,
    CAST(round(round((CAST(CAST(r.setup_time AS DOUBLE) / CAST(b.avg_qty AS DOUBLE) AS DECIMAL(38,12))
                      + r.run_time * b.quantity_w_scrap) * r.workers, 5), 2) AS DOUBLE),
    CAST(round(CAST(round((CAST(CAST(r.setup_time AS DOUBLE) / CAST(b.avg_qty AS DOUBLE) AS DECIMAL(38,12))
                      + r.run_time * b.quantity_w_scrap) * r.workers, 5) AS DECIMAL(38,5))
               * CAST({HOURLY_RATE} AS DECIMAL(4,2)) * CAST({OVERHEAD} AS DECIMAL(4,2)), 2) AS DOUBLE)
  FROM rlines r JOIN bom b ON r.routing_no = b.routing_no
    AND coalesce(nullif(r.version_code, ''), '_null') = coalesce(b.route_version, '_null')
  JOIN pf_items pf ON b.root_item = pf.item_no JOIN items p ON p.item_no = b.root_item
  WHERE NOT b.is_leaf
    AND round((CAST(CAST(r.setup_time AS DOUBLE) / CAST(b.avg_qty AS DOUBLE) AS DECIMAL(38,12)) + r.run_time * b.quantity_w_scrap) * r.workers, 5) != 0)
SELECT * REPLACE (CAST(source_no AS BIGINT) AS source_no) FROM actual
UNION ALL SELECT * FROM bdd""")
def cost_actual_vs_standard(t):
    """Actual consumption and hours of finished orders next to the BOM and routing standard of the package."""
    a, pfs = actual(t)
    pf_items = pfs.select(F.col("item_no").cast("string").alias("root_item"), "range").distinct()
    comp, rl = _components(t)
    pf_items = spread(pf_items)
    comp = comp.join(pf_items.select("root_item").distinct(), "root_item", "left_semi")
    leaf = null_leaf_costs(comp)
    names = spread(leaf.filter(F.col("level") == 0).select("root_item", F.col("item_description").alias("source_name"),
                                                           F.col("factory").alias("root_factory")))
    mat = (leaf.filter(F.col("is_leaf") & (F.col("quantity_w_scrap") != 0)).join(pf_items, "root_item")
           .join(names, "root_item"))
    mat = mat.select(
        F.lit("BDD").alias("data_version"), F.lit(None).cast("string").alias("status"), F.lit("BDD").alias("order_no"),
        F.col("root_item").cast("long").alias("source_no"), "source_name", F.col("root_range").alias("range"),
        F.lit(None).cast("double").alias("output"), F.lit(None).cast("date").alias("last_output"),
        F.col("factory").alias("location_code"), F.lit("MAT_CONSUMPTION").alias("value_type"),
        F.lit(None).cast("string").alias("work_center"), "item_no", F.col("item_description").alias("item_name"),
        F.col("item_type").alias("posting_group"), F.lit(None).cast("string").alias("entry_type"),
        F.lit(None).cast("double").alias("quantity"), "uom", F.lit(None).cast("double").alias("cost"),
        F.round("quantity_w_scrap", 2).alias("quantity_per"),
        F.round(F.col("quantity_w_scrap") * F.col("unit_cost"), 2).alias("cost_per"))
    routes = explode_routes(leaf, rl).filter(F.col("workers_time") != 0).join(pf_items, "root_item").join(
        names, "root_item")
    rate = F.lit(HOURLY_RATE).cast("decimal(4,2)") * F.lit(OVERHEAD).cast("decimal(4,2)")
    hrs = routes.select(
        F.lit("BDD").alias("data_version"), F.lit(None).cast("string").alias("status"), F.lit("BDD").alias("order_no"),
        F.col("root_item").cast("long").alias("source_no"), "source_name", "range",
        F.lit(None).cast("double").alias("output"), F.lit(None).cast("date").alias("last_output"),
        F.col("root_factory").alias("location_code"), F.lit("WORK_HOURS").alias("value_type"), "work_center",
        F.col("operation_no").alias("item_no"), F.concat(F.lit("operation "), F.col("operation_no")).alias("item_name"),
        F.lit(None).cast("string").alias("posting_group"), F.lit(None).cast("string").alias("entry_type"),
        F.lit(None).cast("double").alias("quantity"), F.lit("H").alias("uom"), F.lit(None).cast("double").alias("cost"),
        F.round("workers_time", 2).alias("quantity_per"), F.round(F.col("workers_time") * rate, 2).alias("cost_per"))
    return _out(a).unionByName(_out(mat)).unionByName(_out(hrs))
