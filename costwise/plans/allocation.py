"""Distribution of stock differences over production order components."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.allocate import share
from .registry import register

PERIOD = ("1997-01-01", "1997-12-31")


def _inputs(t):
    diff = t.part.select(
        F.col("p_partkey").alias("reper"), F.lit("UN").alias("umas"),
        (F.col("p_retailprice").cast("decimal(18,2)") * F.lit(0.01).cast("decimal(18,2)")).cast("decimal(10,5)").alias("diff"),
        F.concat(F.lit("A"), F.col("p_brand")).alias("alocat"))
    o = t.orders.select("o_orderkey", F.when(F.col("o_orderstatus") == "O", 3).when(F.col("o_orderstatus") == "F", 4)
                        .otherwise(2).alias("status"), F.col("o_orderdate").cast("date").alias("finished_date"))
    comp = t.lineitem.select(
        F.col("l_orderkey").alias("order_no"), F.col("l_linenumber").alias("line_no"),
        F.col("l_partkey").alias("item_no"), F.lit("UN").alias("uom"),
        (F.col("l_tax").cast("decimal(18,2)") * 100).cast("decimal(18,9)").alias("quantity_per"),
        F.col("l_quantity").cast("decimal(18,9)").alias("finished_qty"), "l_orderkey")
    vals = (comp.join(diff, (F.col("item_no") == F.col("reper")) & (F.col("uom") == F.col("umas")))
            .join(o, F.col("l_orderkey") == F.col("o_orderkey"))
            .filter(((F.col("status") == 3) | ((F.col("status") == 4) & F.col("finished_date").between(*PERIOD)))
                    & (F.col("finished_qty") > 0))
            .withColumn("distrib_qty", (F.col("finished_qty") * F.coalesce(
                F.when(F.col("quantity_per") != 0, F.col("quantity_per")), F.lit(0.1).cast("decimal(18,9)")))
                .cast("decimal(18,9)")))
    return vals


def _sql(capped: bool) -> str:
    val = ("CASE WHEN t >= diff THEN -1 * distrib_qty ELSE CAST(-1 * CAST(distrib_qty AS DOUBLE) / "
           "CAST(coalesce(nullif(t, 0), 1) AS DOUBLE) * CAST(diff AS DOUBLE) AS DECIMAL(38,12)) END" if capped else
           "CAST(-1 * CAST(distrib_qty AS DOUBLE) / CAST(coalesce(nullif(t, 0), 1) AS DOUBLE) * CAST(diff AS DOUBLE) "
           "AS DECIMAL(38,12))")
    return f"""WITH
diff AS (SELECT p_partkey AS reper, 'UN' AS umas,
  CAST(CAST(p_retailprice AS DECIMAL(18,2)) * CAST(0.01 AS DECIMAL(18,2)) AS DECIMAL(10,5)) AS diff,
  'A' || p_brand AS alocat FROM part),
vals AS (
  SELECT l_orderkey AS order_no, l_linenumber AS line_no, l_partkey AS item_no, 'UN' AS uom, d.diff, d.alocat,
    CASE WHEN o_orderstatus = 'O' THEN 3 WHEN o_orderstatus = 'F' THEN 4 ELSE 2 END AS status,
    CAST(o_orderdate AS DATE) AS finished_date,
    CAST(CAST(l_quantity AS DECIMAL(18,9)) * coalesce(nullif(CAST(CAST(l_tax AS DECIMAL(18,2)) * 100 AS DECIMAL(18,9)), 0),
         CAST(0.1 AS DECIMAL(18,9))) AS DECIMAL(18,9)) AS distrib_qty
  FROM lineitem JOIN diff d ON l_partkey = d.reper AND 'UN' = d.umas JOIN orders ON l_orderkey = o_orderkey
  WHERE (o_orderstatus = 'O' OR (o_orderstatus = 'F' AND CAST(o_orderdate AS DATE) BETWEEN DATE '{PERIOD[0]}' AND DATE '{PERIOD[1]}'))
    AND l_quantity > 0),
tot AS (SELECT item_no, sum(distrib_qty) AS t FROM vals GROUP BY item_no)
SELECT order_no, line_no, item_no, uom, CASE status WHEN 4 THEN 'Da' ELSE 'Nu' END AS finished_order,
  CASE WHEN status = 4 THEN finished_date END AS finished_date, alocat,
  CAST(round({val}, 5) AS DOUBLE) AS distrib_qty
FROM vals JOIN tot USING (item_no)"""


def _build(t, capped):
    v = _inputs(t)
    out = share(v, ["item_no"], "distrib_qty", F.col("diff"), 5, out="_share", cap=capped)
    return out.select("order_no", "line_no", "item_no", "uom",
                      F.when(F.col("status") == 4, F.lit("Da")).otherwise(F.lit("Nu")).alias("finished_order"),
                      F.when(F.col("status") == 4, F.col("finished_date")).alias("finished_date"), "alocat",
                      F.col("_share").cast("double").alias("distrib_qty"))


@register("distribute_difference", _sql(False))
def distribute_difference(t):
    """Pro-rata share of each part's stock difference over open / recently finished orders."""
    return _build(t, False)


@register("distribute_difference_capped", _sql(True))
def distribute_difference_capped(t):
    """Older variant: the full quantity when the part's total covers the difference."""
    return _build(t, True)
