"""Items, manufactures, estimates, prices and currencies derived from ``part``, ``lineitem``, ``orders`` and ``nation``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import QTY
from ..session import spread
from . import bom_world as W
from .tables import Tables

_s = W._s


def items(t: Tables) -> DataFrame:
    """One row a part; blanks where a part has no value. Costs as in the cost selection."""
    from ..plans.costs import _cost_inputs
    size = F.col("p_size")
    parents = W.edges(t).select(F.col("parent").alias("_par")).distinct()
    p = t.part.join(spread(parents), F.col("p_partkey") == F.col("_par"), "left").join(
        spread(_cost_inputs(t).select("item_no", "nav_unit", "nav_standard", "nav_last")), F.col("p_partkey") == F.col("item_no")).drop("item_no")
    kind = W.item_type(F.col("p_type"))
    return p.select(
        _s(F.col("p_partkey")).alias("item_no"), F.col("p_name").alias("description"),
        F.when(size % 9 == 0, F.lit("")).otherwise(F.col("p_brand")).alias("range"),
        F.when((kind == "PF") & (size % 6 == 1), F.lit("PF_KIT")).otherwise(kind).alias("posting_group"),
        F.concat(F.lit("M"), _s(size % 30)).alias("manufacture"), F.concat(F.lit("M"), _s(size % 4 + 22)).alias("sav_manufacture"),
        F.when(size % 2 == 0, F.lit("")).otherwise(F.concat(F.lit("F"), _s(size % 3 + 1))).alias("production_location"),
        F.when(F.col("_par").isNotNull(), F.concat(F.lit("B"), _s(F.col("p_partkey")))).otherwise(F.lit("")).alias("production_bom_no"),
        F.when(kind != "MAT_PRIMA", F.concat(F.lit("R"), _s(F.col("p_partkey")))).otherwise(F.lit("")).alias("routing_no"),
        F.col("p_brand").alias("technical_family"), F.when(size % 5 == 0, F.lit("")).otherwise(F.substring(F.lit("ABCD"), 1, 1)).alias("cod_abcd"),
        F.lit("UN").alias("base_uom"), F.col("nav_unit").alias("unit_cost"), F.col("nav_standard").alias("standard_cost"),
        F.col("nav_last").alias("last_direct_cost"),
        F.when(size % 5 == 0, F.lit("PAL")).when(size % 5 == 1, F.lit("")).otherwise(F.lit("BOX")).alias("purch_uom"),
        F.when(size % 4 == 0, F.lit("PAL")).when(size % 4 == 1, F.lit("")).otherwise(F.lit("box")).alias("sales_uom"))


def manufactures(t: Tables) -> DataFrame:
    return t.nation.filter(F.col("n_nationkey") % 7 < 4).select(
        F.concat(F.lit("M"), _s(F.col("n_nationkey"))).alias("manufacture"),
        F.concat(F.lit("F"), _s(F.col("n_nationkey") % 3 + 1)).alias("factory"))


def estimates(t: Tables) -> DataFrame:
    """Estimated costs of the larger parts: of the latest round, or older ones; some in a unit that the item lacks."""
    size = F.col("p_size")
    return t.part.filter(size > 20).select(
        _s(F.col("p_partkey")).alias("item_no"), F.col("p_retailprice").cast("decimal(18,2)").alias("cost"),
        F.when(size % 4 == 0, F.lit("PAL")).when(size % 4 == 1, F.lit("Box")).when(size % 4 == 2, F.lit("")).otherwise(F.lit("un")).alias("uom"),
        F.when(size % 8 < 4, F.lit("2022-03-01")).otherwise(F.lit("2021-06-01")).cast("date").alias("estimated_on"))


def _prices(t: Tables, price, currency, uom, vat) -> DataFrame:
    return t.lineitem.select(
        _s(F.col("l_partkey")).alias("item_no"), F.col("l_shipdate").cast("date").alias("start_date"), price.alias("price"),
        currency.alias("currency"), uom.alias("uom"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("rowversion"), vat.alias("includes_vat"))


def purchase_prices(t: Tables) -> DataFrame:
    n, s = F.col("l_linenumber"), F.col("l_suppkey")
    return _prices(t, (F.col("l_discount").cast("decimal(18,2)") * 100).cast("decimal(18,2)"),
                   F.when(n % 3 == 1, F.lit("EUR")).when(n % 3 == 2, F.lit("USD")).otherwise(F.lit("")),
                   F.when(s % 4 == 1, F.lit("BOX")).when(s % 4 == 2, F.lit("UN")).when(s % 4 == 3, F.lit("PAL")).otherwise(F.lit("")),
                   F.lit(False))


def sales_prices(t: Tables) -> DataFrame:
    n, s = F.col("l_linenumber"), F.col("l_suppkey")
    return _prices(t, F.col("l_quantity").cast("decimal(18,2)"), F.when(s % 3 == 0, F.lit("EUR")).otherwise(F.lit("GBP")),
                   F.when(n == 5, F.lit("KG")).when(n % 2 == 0, F.lit("box")).otherwise(F.lit("")), F.col("l_returnflag") == "R")


def fx_rates(t: Tables) -> DataFrame:
    """Two currencies with a rate; others count as 1."""
    k = F.col("n_nationkey")
    return t.nation.filter(k.isin(1, 2)).select(F.when(k == 1, F.lit("EUR")).otherwise(F.lit("USD")).alias("currency"),
                                               (F.lit(4) + k * F.lit(0.1234).cast("decimal(10,4)")).cast("decimal(10,4)").alias("rate"))


def dimensions(t: Tables) -> DataFrame:
    size = F.col("p_size")
    return t.part.select(_s(F.col("p_partkey")).alias("item_no"), F.lit("UN").alias("code"), (size * 10).cast("decimal(18,2)").alias("length"),
                         (size % 10 * 100).cast("decimal(18,2)").alias("width"), (size % 3 * 50).cast("decimal(18,2)").alias("height"))


def production_orders(t: Tables) -> DataFrame:
    """Production orders of BOMs with their quantity; planned ones are simulated (status 0)."""
    return t.lineitem.join(spread(t.orders.select("o_orderkey", "o_orderstatus")), F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.concat(F.lit("B"), _s(F.col("l_partkey"))).alias("source_no"),
        F.when(F.col("o_orderstatus") == "P", 0).when(F.col("o_orderstatus") == "O", 3).otherwise(4).alias("status"),
        (F.col("l_quantity") * 10).cast(QTY).alias("quantity"))
