"""A bill of material against a production order made from it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import spread
from .picks import latest_row

_AMOUNT, _ORDER_QTY = "decimal(38,9)", "decimal(12,2)"
ORDER_COLUMNS = ("order_no", "order_status", "order_bom_no", "order_bom_version", "order_qty", "bom_no", "bom_description", "bom_version")


def match_orders(packages: DataFrame, order_lines: DataFrame, unusable: DataFrame, *, prefix: str = "PO", line_no: int = 10000,
                 least_status: int = 2) -> DataFrame:
    """The order that each package is compared with: lowest status first, an order of the package's own BOM version before
    others, then order number (the source leaves ties open). Packages without an order drop out.

    packages: (root_item, bom_no, bom_description, bom_version); order_lines: (order_no, line_no, status, status_name, bom_no,
    version_code, quantity); unusable: (order_no) of orders with a component without quantity.
    The pick is a top-1 by BOM, so a BOM with many orders ships one row a map task.
    """
    code = F.when(F.col("version_code") != "", F.col("version_code"))
    lines = (order_lines.filter(F.col("order_no").startswith(prefix) & (F.col("line_no") == line_no) & (F.col("status") >= least_status))
             .join(spread(unusable.select("order_no").distinct()), "order_no", "left_anti"))
    p = packages.select("root_item", "bom_no", "bom_description", "bom_version")
    j = lines.join(spread(p), "bom_no")
    far = F.when(code.eqNullSafe(F.col("bom_version")), 0).otherwise(1)
    best = latest_row(j, ["root_item"], [F.col("status").asc(), far.asc(), F.col("order_no").asc(), F.col("quantity").desc(),
                                         F.col("version_code").asc_nulls_first()])
    return best.select("root_item", "order_no", F.col("status_name").alias("order_status"), F.col("bom_no").alias("order_bom_no"),
                       F.col("version_code").alias("order_bom_version"), F.col("quantity").cast(_ORDER_QTY).alias("order_qty"), "bom_no",
                       "bom_description", "bom_version")


def bom_vs_order(orders: DataFrame, parts: DataFrame, operations: DataFrame, order_lines: DataFrame, components: DataFrame,
                 routes: DataFrame, items: DataFrame) -> DataFrame:
    """Expected quantities by (order, source, type, item, unit): components and work of the order ('NAV') and of the exploded BOM for the order's
    quantity ('BDD').

    parts: (order_no, item_no, uom, expected_quantity); operations: (order_no, routing_ref, routing_no, workers_time);
    order_lines: (order_no, line_no, routing_no, item_no); components: explosion rows (root_item, level, item_no, uom,
    quantity_w_scrap); routes: exploded operations (root_item, item_no, setup_time, run_time, quantity_w_scrap, workers);
    items: (item_no, description, item_type, production_bom_no, estimate_cost, nav_unit_cost, nav_standard_cost, nav_last_direct_cost).
    """
    hours = F.lit("ORE")

    def rows(df: DataFrame, source: str, kind: str, item, uom, amount) -> DataFrame:
        # summed before the order's other columns are joined: the shuffle carries four columns
        return (df.groupBy("root_item", item.alias("item_no"), uom.alias("uom")).agg(F.sum(amount.cast(_AMOUNT)).alias("qty"))
                .select("root_item", F.lit(source).alias("source"), F.lit(kind).alias("type"), "item_no", "uom", "qty"))

    keys = spread(orders.select("root_item", "order_no", "order_qty"))
    work = operations.join(keys, "order_no").join(
        spread(order_lines.select("order_no", F.col("line_no").alias("routing_ref"), "routing_no", F.col("item_no").alias("_item"))),
        ["order_no", "routing_ref", "routing_no"], "left")
    made = components.filter("level != 0").join(keys, "root_item")
    time = (F.col("setup_time") + (F.col("run_time") * F.col("quantity_w_scrap")).cast("decimal(24,9)") * F.col("order_qty")).cast("decimal(30,9)")
    out = (rows(parts.join(keys, "order_no"), "NAV", "Component", F.col("item_no"), F.col("uom"), F.col("expected_quantity"))
           .unionByName(rows(made, "BDD", "Component", F.col("item_no"), F.col("uom"), F.col("quantity_w_scrap") * F.col("order_qty")))
           .unionByName(rows(work, "NAV", "Routing", F.col("_item"), hours, F.col("workers_time")))
           .unionByName(rows(routes.join(keys, "root_item"), "BDD", "Routing", F.col("item_no"), hours, time * F.col("workers").cast("decimal(4,0)"))))
    bought = (F.col("item_type") == "MAT_PRIMA") | (F.coalesce(F.length("production_bom_no"), F.lit(0)) == 0)
    cost = F.coalesce(F.col("estimate_cost"), F.greatest("nav_unit_cost", "nav_standard_cost", "nav_last_direct_cost"))
    facts = items.select("item_no", "description", "item_type", F.when(bought, cost).alias("_cost"))
    return (out.join(spread(orders), "root_item").join(spread(facts), "item_no", "left")
            .select(*ORDER_COLUMNS, "source", "type", "item_no", "description", "item_type", "uom", F.round("qty", 5).alias("expect_qty"),
                    F.when(F.col("type") == "Component", F.col("_cost")).alias("unit_cost")))


def differences(compared: DataFrame) -> DataFrame:
    """One row by (order, type, item, unit): both quantities, their difference and what it is. One grouped pass
    over the comparison instead of a full join of its halves."""
    by = lambda s: F.sum(F.when(F.col("source") == s, F.col("expect_qty")))
    zero = F.lit(0).cast(_AMOUNT)
    out = (compared.groupBy("order_no", "bom_no", "type", "item_no", "uom").agg(by("NAV").alias("order_qty"), by("BDD").alias("bom_qty")))
    gap = F.coalesce("order_qty", zero) - F.coalesce("bom_qty", zero)
    kind = (F.when(F.col("bom_qty").isNull(), "only order").when(F.col("order_qty").isNull(), "only BOM")
            .when(gap == 0, "equal").otherwise("differs"))
    return out.withColumn("difference", gap).withColumn("kind", kind)
