"""BOM / routing version candidates and the as-of version pick.

Analogue: a customer is a BOM header, its orders are BOM versions (order status F
-> certified, O -> new, P -> excluded), its order lines are BOM lines; lines of
finished orders carry no version code, so those customers also get a fallback row.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.picks import pick_version, version_candidates
from .registry import register

_BOM_SRC_SQL = """
bom_vers AS (
  SELECT o_custkey AS bom_no, 'V' || CAST(o_orderkey AS VARCHAR) AS version_code, o_orderdate AS starting_date,
         o_orderdate + INTERVAL 7 DAY AS last_modified,
         CASE WHEN o_orderpriority = '5-LOW' THEN '' ELSE 'F' || substr(o_orderpriority, 1, 1) END AS location_code,
         CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 0 ELSE 2 END AS status, o_orderkey AS ts
  FROM orders),
bom_line AS (
  SELECT o_custkey AS bom_no, CASE WHEN l_linestatus = 'F' THEN '' ELSE 'V' || CAST(o_orderkey AS VARCHAR) END AS version_code,
         l_shipdate AS starting_date, l_orderkey * 1000000000 + l_linenumber AS ts
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
bom_header AS (
  SELECT c_custkey AS no_, c_nationkey % 3 AS status, CAST('2000-01-01' AS TIMESTAMP) + to_days(c_nationkey) AS last_modified
  FROM customer),
bom_cand AS (
  SELECT bom_no AS key, version_code AS version, CAST(starting_date AS DATE) AS start_date, last_modified AS modified,
         nullif(location_code, '') AS location, ts AS rowversion, 0 AS priority
  FROM bom_vers WHERE status IN (0, 1)
  UNION
  SELECT a.bom_no, NULL, max(CAST(a.starting_date AS DATE)), max(b.last_modified), NULL, max(a.ts), 1
  FROM bom_line a JOIN bom_header b ON a.bom_no = b.no_
  WHERE b.status IN (0, 1) AND (a.version_code IS NULL OR length(a.version_code) = 0)
  GROUP BY a.bom_no)"""


def bom_sources(t):
    o, l, c = t.orders, t.lineitem, t.customer
    vers = o.select(
        F.col("o_custkey").alias("bom_no"), F.concat(F.lit("V"), F.col("o_orderkey").cast("string")).alias("version_code"),
        F.col("o_orderdate").alias("starting_date"),
        (F.col("o_orderdate") + F.expr("INTERVAL 7 DAYS")).alias("last_modified"),
        F.when(F.col("o_orderpriority") == "5-LOW", F.lit(""))
        .otherwise(F.concat(F.lit("F"), F.substring("o_orderpriority", 1, 1))).alias("location_code"),
        F.when(F.col("o_orderstatus") == "F", 1).when(F.col("o_orderstatus") == "O", 0).otherwise(2).alias("status"),
        F.col("o_orderkey").alias("ts"))
    lines = l.join(o.select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("o_custkey").alias("bom_no"),
        F.when(F.col("l_linestatus") == "F", F.lit("")).otherwise(
            F.concat(F.lit("V"), F.col("o_orderkey").cast("string"))).alias("version_code"),
        F.col("l_shipdate").alias("starting_date"),
        (F.col("l_orderkey") * 1000000000 + F.col("l_linenumber")).alias("ts"))
    header = c.select(F.col("c_custkey").alias("no_"), (F.col("c_nationkey") % 3).alias("status"),
                      (F.lit("2000-01-01").cast("timestamp_ntz") + F.make_interval(
                          days=F.col("c_nationkey"))).alias("last_modified"))
    return vers, lines, header


def bom_candidates(t, fallback_start=None):
    vers, lines, header = bom_sources(t)
    return version_candidates(
        vers, lines, header, key="bom_no", version="version_code", start="starting_date",
        modified="last_modified", location="location_code", status="status", rowversion="ts",
        line_key="bom_no", line_version="version_code", line_start="starting_date", line_rowversion="ts",
        header_key="no_", header_status="status", header_modified="last_modified",
        fallback_start=fallback_start)


@register("bom_versions", "WITH " + _BOM_SRC_SQL + "\nSELECT * FROM bom_cand")
def bom_versions(t):
    """Version candidates: declared new/certified versions plus a fallback per header."""
    return bom_candidates(t)


@register("route_versions", "WITH " + _BOM_SRC_SQL.replace(
    "max(CAST(a.starting_date AS DATE))", "DATE '1753-01-01'") + "\nSELECT * FROM bom_cand")
def route_versions(t):
    """Routing version candidates: as BOM versions, the fallback starts on 1753-01-01."""
    return bom_candidates(t, fallback_start="1753-01-01")


@register("version_pick", "WITH " + _BOM_SRC_SQL + """,
req AS (SELECT DISTINCT c_custkey AS key, 'F' || CAST(c_nationkey % 5 + 1 AS VARCHAR) AS location FROM customer),
ranked AS (
  SELECT r.key, r.location, c.version, c.location AS version_location,
    row_number() OVER (PARTITION BY r.key, r.location ORDER BY
      CASE WHEN c.location = r.location THEN 2 ELSE c.priority END DESC,
      c.start_date DESC NULLS LAST, c.modified DESC NULLS LAST, c.rowversion DESC NULLS LAST,
      c.version ASC NULLS FIRST) AS rn
  FROM req r JOIN bom_cand c ON r.key = c.key
  WHERE c.start_date <= DATE '1998-01-01')
SELECT key, location, version, version_location FROM ranked WHERE rn = 1""")
def version_pick(t):
    """As-of (1998-01-01) version per BOM and factory location."""
    req = t.customer.select(F.col("c_custkey").alias("key"),
                            F.concat(F.lit("F"), (F.col("c_nationkey") % 5 + 1).cast("string")).alias("location"))
    return pick_version(req, bom_candidates(t), "1998-01-01")
