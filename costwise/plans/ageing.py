"""Stock ageing by month buckets."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import stored
from ..operators.ageing import add_moves, age_stock, entry_costs, month_buckets
from ..session import materialize, scratch_path
from ..sources import driver as D
from .registry import register

START, AS_OF = "1996-06-30", "2001-12-31"
MONTHS = (2001 - 1996) * 12 + 12 - 6  # months between start and as-of: the source's round limit - 1
# Posting groups taken into the ageing (part types in the driver data).
GROUPS = ("ECONOMY", "LARGE", "MEDIUM", "SMALL", "STANDARD")
_G = ", ".join(f"'{g}'" for g in GROUPS)


def moves(t):
    l = t.lineitem.join(t.part.filter(F.col("p_type").isin(list(GROUPS))).select("p_partkey"),
                        F.col("l_partkey") == F.col("p_partkey"), "left_semi")
    sign = F.when(F.col("l_returnflag") == "R", F.lit(-1)).otherwise(F.lit(1))
    return l.select(F.col("l_partkey").alias("item_no"), F.col("l_shipdate").cast("date").alias("posting_date"),
                    (sign * F.col("l_quantity").cast("decimal(18,2)")).alias("quantity"),
                    (sign * F.col("l_extendedprice").cast("decimal(18,2)")).alias("cost"))


def _ageing_sql(cost: str) -> str:
    return f"""WITH RECURSIVE
mv AS (
  SELECT l_partkey AS item_no, CAST(l_shipdate AS DATE) AS d,
    CASE WHEN l_returnflag = 'R' THEN -1 ELSE 1 END * CAST(l_quantity AS DECIMAL(18,2)) AS q,
    {cost} AS c
  FROM lineitem WHERE l_partkey IN (SELECT p_partkey FROM part WHERE p_type IN ({_G}))),
b0 AS (
  SELECT item_no, CAST(date_trunc('month', greatest(d, DATE '{START}')) AS DATE) AS m,
         CAST(round(sum(q), 2) AS DECIMAL(18,2)) AS q, CAST(round(sum(c), 2) AS DECIMAL(18,2)) AS c
  FROM mv GROUP BY ALL),
b1 AS (SELECT * FROM b0 WHERE item_no IN (SELECT item_no FROM b0 GROUP BY item_no HAVING sum(q) > 0)),
rec AS (
  SELECT 0 AS r, item_no, m, q, c FROM b1
  UNION ALL
  SELECT r, item_no, m, CAST(sum(q) AS DECIMAL(18,2)), CAST(sum(c) AS DECIMAL(18,2)) FROM (
    SELECT r + 1 AS r, item_no,
      CASE WHEN q <= 0 AND pq IS NOT NULL THEN coalesce(pm, m) WHEN q <= 0 THEN coalesce(nm, m) ELSE m END AS m, q, c
    FROM (
      SELECT r, item_no, m, q, c, lag(m) OVER w AS pm, lead(m) OVER w AS nm, lag(q) OVER w AS pq
      FROM (SELECT * FROM (SELECT *, bool_or(q <= 0) OVER (PARTITION BY item_no) AS active FROM rec WHERE r <= {MONTHS})
            WHERE active AND q != 0)
      WINDOW w AS (PARTITION BY item_no ORDER BY m)))
  GROUP BY r, item_no, m)
SELECT item_no, m AS month, CAST(q AS DOUBLE) AS quantity, CAST(c AS DOUBLE) AS cost
FROM rec QUALIFY r = max(r) OVER (PARTITION BY item_no)"""


_PRICE = "CASE WHEN l_returnflag = 'R' THEN -1 ELSE 1 END * CAST(l_extendedprice AS DECIMAL(18,2))"


@register("stock_ageing", _ageing_sql(_PRICE))
def stock_ageing(t):
    """Month buckets per part after moving non-positive buckets (start 1996-06-30, as of 2001-12-31)."""
    out = age_stock(month_buckets(moves(t), START), MONTHS + 1)
    return out.select("item_no", "month", F.col("quantity").cast("double").alias("quantity"),
                      F.col("cost").cast("double").alias("cost"))


def valued_moves(t):
    """The moves with the cost of their value entries: none, one (the price) or two (the price and twice the price) an entry."""
    l = D.entry_numbered(t.lineitem.join(t.part.filter(F.col("p_type").isin(list(GROUPS))).select("p_partkey"),
                                         F.col("l_partkey") == F.col("p_partkey"), "left_semi"))
    sign = F.when(F.col("l_returnflag") == "R", F.lit(-1)).otherwise(F.lit(1))
    # ledger and value entries both read the numbered lines: numbered once
    l = materialize(l.select("entry_no", F.col("l_partkey").alias("item_no"), F.col("l_shipdate").cast("date").alias("posting_date"),
                             (sign * F.col("l_quantity").cast("decimal(18,2)")).alias("quantity"), "l_suppkey",
                             (sign * F.col("l_extendedprice").cast("decimal(18,2)")).alias("price")), "numbered-lines")
    ledger = l.drop("price")
    n = (F.col("l_suppkey") % 3).cast("int")
    values = l.filter(n > 0).select("entry_no", F.explode(F.sequence(F.lit(1), n)).alias("k"), "price")
    return entry_costs(ledger, values.select("entry_no", (F.col("price") * F.col("k")).alias("cost")))


@register("stock_ageing_incremental", _ageing_sql(f"CASE l_suppkey % 3 WHEN 1 THEN 1 WHEN 2 THEN 3 END * ({_PRICE})"))
def stock_ageing_incremental(t):
    """Ageing with costs from value entries, in two runs: all moves to the end of 1999 but some, then the later months with those, which
    are late entries of old months. Equals one run over all moves."""
    moves = materialize(valued_moves(t), "valued-moves")
    path = scratch_path(t.spark, "ageing")
    first = (F.col("posting_date") < F.lit("2000-01-01").cast("date")) & (F.col("l_suppkey") % 10 != 0)
    for part in (first, ~first):
        add_moves(moves.filter(part).select("item_no", "posting_date", "quantity", "cost"), path, START, MONTHS + 1, 32)
    return stored.table(t.spark, f"{path}/aged").select(
        "item_no", "month", F.col("quantity").cast("double").alias("quantity"), F.col("cost").cast("double").alias("cost"))
