"""DuckDB CTE text for the driver-table views (the oracle side of ``sources.driver``)."""

ITEMS = """items AS (
  SELECT p_partkey AS item_no, p_name AS description, p_type AS posting_group, p_brand AS item_range,
         'UN' AS base_uom, CAST(p_retailprice AS DECIMAL(18,2)) AS unit_cost, p_size AS size
  FROM part)"""

ITEM_LEDGER = """item_ledger AS (
  SELECT l_orderkey AS order_no, l_linenumber AS order_line_no, l_partkey AS item_no,
         'L' || CAST(l_suppkey % 4 AS VARCHAR) AS location_code,
         'B' || CAST(l_linenumber AS VARCHAR) AS bin_code, l_linestatus AS lot_no,
         CAST(l_shipdate AS DATE) AS posting_date, et AS entry_type,
         CASE WHEN et IN (1, 5) THEN -CAST(l_quantity AS DECIMAL(18,2)) ELSE CAST(l_quantity AS DECIMAL(18,2)) END AS quantity,
         CASE WHEN et IN (1, 5) THEN -CAST(l_extendedprice AS DECIMAL(18,2)) ELSE CAST(l_extendedprice AS DECIMAL(18,2)) END AS cost_amount,
         CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_discount AS DECIMAL(18,2)) AS cost_expected,
         l_suppkey AS supplier_no
  FROM (SELECT *, CASE WHEN l_returnflag = 'R' THEN 1 WHEN l_returnflag = 'A' THEN 5
                       WHEN l_linestatus = 'O' THEN 0 ELSE 6 END AS et FROM lineitem))"""


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"
