"""Item master with converted costs and prices, and finished-package headers with their dates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import COST, QTY, blank_to_null, unit_cost
from ..session import spread
from .picks import latest_row

# Tags of costs whose unit could not be converted (spelled as in the source).
TAGS = {"estimate": "CIFRAJ;", "legacy": "LECACY;", "purchase": "PURCHASE;", "sales": "SALES;"}


def unit_maps(item_uom: DataFrame) -> DataFrame:
    """(_unit_item, units): per item a map from its upper-cased unit codes to quantities, so that any number of conversions
    of an item is one join. A code twice is an error, as two matches of a lookup are in the source (map keys repeat)."""
    return item_uom.groupBy(F.upper(F.col("item_no")).alias("_unit_item")).agg(
        F.map_from_entries(F.collect_list(F.struct(F.upper(F.col("code")), F.col("qty_per_uom").cast(QTY)))).alias("units"))


def rate_to(units: Column, source: Column, target: Column) -> Column:
    """Target quantity by source quantity from an item's unit map; 1 for no or the same unit, -1 if either is missing or 0."""
    zero, one = F.lit(0).cast(QTY), F.lit(1).cast(QTY)
    at = lambda u: F.coalesce(F.try_element_at(units, F.upper(u)), zero)
    s, t = at(source), at(target)
    return (F.when(source.isNull() | (F.upper(source) == F.upper(target)), one)
            .when((s == 0) | (t == 0), F.lit(-1).cast(QTY)).otherwise((t / F.when(s != 0, s)).cast(QTY)))


def _converted(value: Column, rate: Column) -> Column:
    return (value.cast(QTY) * F.abs(rate)).cast(COST)


def last_prices(prices: DataFrame, fx: DataFrame, until=None) -> DataFrame:
    """The last price other than 0 of each item in home currency (a currency without a rate counts as 1): latest start, then row-version,
    then all other columns. ``until`` leaves out later starts; without it future prices count, as in the source's item master."""
    p = prices.filter(F.col("price") != 0)
    p = p if until is None else p.filter(F.col("start_date") <= F.lit(until).cast("date"))
    p = latest_row(p, ["item_no"], [F.col("start_date").desc_nulls_last(), F.col("rowversion").desc(), F.col("price").desc(),
                                    F.col("currency").asc_nulls_first(), F.col("uom").asc_nulls_first(), F.col("includes_vat").asc()])
    # picked before the currencies are joined: one row an item
    return (p.join(fx.select(F.col("currency").alias("_fc"), "rate"), F.col("currency") == F.col("_fc"), "left")
            .select("item_no", (F.col("price") * F.coalesce(F.col("rate"), F.lit(1).cast("decimal(10,4)"))).cast(QTY).alias("value"), "uom",
                    "includes_vat"))


def item_master(items: DataFrame, manufactures: DataFrame, estimates: DataFrame, purchases: DataFrame, sales: DataFrame, fx: DataFrame,
                item_uom: DataFrame, dimensions: DataFrame) -> DataFrame:
    """One row an item: factory, dimensions in metres, all costs in the base unit, the selected unit cost, tags of failed conversions.

    items: (item_no, description, range, posting_group, manufacture, sav_manufacture, production_location, production_bom_no, routing_no,
    technical_family, cod_abcd, base_uom, unit_cost, standard_cost, last_direct_cost, purch_uom, sales_uom); estimates: (item_no, cost,
    uom, estimated_on), one row an item: those of the latest date are estimates, older ones legacy costs; purchases, sales:
    (item_no, start_date, price, currency, uom, rowversion, includes_vat); fx: (currency, rate); dimensions: (item_no, code, length, width,
    height). A failed conversion leaves the amount as it is and adds a tag.
    """
    latest = estimates.agg(F.max("estimated_on").alias("_latest"))
    est = estimates.join(F.broadcast(latest)).select(  # one row
        "item_no", F.col("cost").alias("e_cost"), F.col("uom").alias("e_uom"), (F.col("estimated_on") == F.col("_latest")).alias("e_now"))
    buy, sell = (last_prices(p, fx).select("item_no", F.col("value").alias(f"{n}_value"), F.col("uom").alias(f"{n}_uom"),
                                           F.col("includes_vat").alias(f"{n}_vat")) for n, p in (("b", purchases), ("s", sales)))
    m = manufactures.select("manufacture", "factory")
    dims = dimensions.select("item_no", F.col("code").alias("base_uom"), *[
        F.when(F.col(c) != 0, (F.col(c) / 1000).cast("decimal(18,6)")).alias(c) for c in ("length", "width", "height")])
    units = unit_maps(item_uom)
    j = (items.join(m.select("manufacture", F.col("factory").alias("_f1")), "manufacture", "left")
         .join(m.select(F.col("manufacture").alias("sav_manufacture"), F.col("factory").alias("_f2")), "sav_manufacture", "left")
         .join(spread(est), "item_no", "left").join(spread(buy), "item_no", "left").join(spread(sell), "item_no", "left")
         .join(spread(dims), ["item_no", "base_uom"], "left").join(spread(units), F.upper(F.col("item_no")) == F.col("_unit_item"), "left"))
    base = F.col("base_uom")
    unit = {"e": blank_to_null("e_uom"), "b": F.coalesce(blank_to_null("b_uom"), blank_to_null("purch_uom")),
            "s": F.coalesce(blank_to_null("s_uom"), blank_to_null("sales_uom"))}
    j = j.select("*", *[rate_to(F.col("units"), u, base).alias(f"_r{n}") for n, u in unit.items()])
    now, old = F.col("e_now"), ~F.col("e_now")
    j = (j.withColumn("estimate_cost", F.when(now, _converted(F.col("e_cost"), F.col("_re"))))
         .withColumn("legacy_unit_cost", F.when(old, _converted(F.col("e_cost"), F.col("_re"))))
         .withColumn("last_purchase_price", _converted(F.col("b_value"), F.col("_rb")))
         .withColumn("last_sales_price", _converted(F.col("s_value"), F.col("_rs"))))
    failed = {"estimate": now & (F.col("_re") == -1), "legacy": old & (F.col("_re") == -1),
              "purchase": F.col("b_value").isNotNull() & (F.col("_rb") == -1), "sales": F.col("s_value").isNotNull() & (F.col("_rs") == -1)}
    uc = unit_cost("unit_cost", "standard_cost", "last_direct_cost", "estimate_cost", "last_purchase_price", "legacy_unit_cost")
    return j.select(
        "item_no", "description", blank_to_null("range").alias("range"), blank_to_null("posting_group").alias("item_type"),
        F.coalesce("_f1", "_f2", blank_to_null("production_location")).alias("factory"),
        blank_to_null("production_bom_no").alias("production_bom_no"), blank_to_null("routing_no").alias("routing_no"),
        blank_to_null("technical_family").alias("technical_family"), "length", "width", "height", blank_to_null("cod_abcd").alias("cod_abcd"),
        "base_uom", F.col("unit_cost").alias("nav_unit_cost"), F.col("standard_cost").alias("nav_standard_cost"),
        F.col("last_direct_cost").alias("nav_last_direct_cost"), "estimate_cost", "last_purchase_price", "legacy_unit_cost",
        uc.unit_cost_type.alias("unit_cost_type"), uc.unit_cost.alias("selected_unit_cost"), "last_sales_price",
        F.col("s_vat").alias("price_includes_vat"),
        F.concat(*[F.when(failed[k], F.lit(tag)).otherwise(F.lit("")) for k, tag in TAGS.items()]).alias("errors"))


def average_orders(orders: DataFrame) -> DataFrame:
    """(source_no, avg_calc): average quantity of orders above 50 that are not simulated (status 0), rounded to hundreds."""
    kept = orders.filter((F.col("status") != 0) & (F.col("quantity") > 50))
    return (kept.groupBy("source_no").agg(F.sum("quantity").alias("_s"), F.count(F.lit(1)).alias("_n"))
            .select("source_no", (F.round((F.col("_s") / F.col("_n") / 100).cast("decimal(28,10)"), 0) * 100).cast(QTY).alias("avg_calc")))


def package_headers(items: DataFrame, picked: DataFrame, orders: DataFrame, ledger: DataFrame) -> DataFrame:
    """Items of type PF… with a versioned BOM: versions, average order (200 below 50), first production and first sale.

    picked: (item_no, bom_version, bom_location, route_version, route_location) of the items with a BOM that has a version;
    ledger: (item_no, posting_date, entry_type). Both first dates come from one pass over the ledger.
    """
    first = lambda kind: F.min(F.when(F.col("entry_type") == kind, F.col("posting_date")))
    dates = (ledger.filter(F.col("entry_type").isin(1, 6)).groupBy("item_no")
             .agg(first(6).alias("first_prod_date"), first(1).alias("first_sale_date")))
    low = F.coalesce(F.col("avg_calc"), F.lit(0)) < 50
    return (items.filter(F.col("item_type").startswith("PF")).join(spread(picked), "item_no").join(spread(dates), "item_no", "left")
            .join(spread(average_orders(orders).withColumnRenamed("source_no", "production_bom_no")), "production_bom_no", "left")
            .withColumn("avg_qty_type", F.when(low, F.lit("Default")).otherwise(F.lit("Calculated")))
            .withColumn("avg_qty", F.when(low, F.lit(200).cast(QTY)).otherwise(F.col("avg_calc"))))


def kit_components(components: DataFrame, items: DataFrame, packages: DataFrame, ledger: DataFrame, item_uom: DataFrame) -> DataFrame:
    """Kit components with the first assembly and first sale of the kit, those of the component if it is a package, and its unit cost in the
    component's unit: a package costs what its BOM does (type ``BOM``, no cost), everything else its selected cost.

    components: (kit_no, item_no, quantity_per, uom); items: ``item_master`` rows; packages: ``package_headers`` rows; ledger: (item_no,
    posting_date, entry_type). The kit's two dates come from one pass over the ledger.
    """
    first = lambda kind: F.min(F.when(F.col("entry_type") == kind, F.col("posting_date")))
    dates = (ledger.filter(F.col("entry_type").isin(1, 9)).groupBy(F.col("item_no").alias("kit_no"))
             .agg(first(9).alias("kit_first_prod_date"), first(1).alias("kit_first_sale_date")))
    kit = items.select(F.col("item_no").alias("kit_no"), F.col("description").alias("kit_description"), F.col("range").alias("kit_range"), "cod_abcd",
                       "factory")
    part = items.select("item_no", F.col("description").alias("item_description"), "item_type", F.col("technical_family").alias("item_family"), "length",
                        "width", "height", "base_uom", F.col("unit_cost_type").alias("_type"), F.col("selected_unit_cost").alias("_cost"),
                        F.col("errors").alias("_errors"))
    pack = packages.select("item_no", F.col("first_prod_date").alias("item_first_prod_date"), F.col("first_sale_date").alias("item_first_sale_date"),
                           F.lit(True).alias("_pack"))
    j = (components.join(spread(kit), "kit_no").join(spread(part), "item_no", "left").join(spread(pack), "item_no", "left")
         .join(spread(dates), "kit_no", "left").join(spread(unit_maps(item_uom)), F.upper(F.col("item_no")) == F.col("_unit_item"), "left"))
    j = j.withColumn("_rate", rate_to(F.col("units"), F.col("base_uom"), F.col("uom")))
    own = F.col("_pack").isNull()
    return j.select(
        "kit_no", "kit_description", "kit_range", "cod_abcd", "kit_first_prod_date", "kit_first_sale_date", "item_no", "item_description", "item_type",
        "factory", "item_family", "item_first_prod_date", "item_first_sale_date", "quantity_per", "uom", "length", "width", "height",
        F.when(own, F.col("_type")).otherwise(F.lit("BOM")).alias("unit_cost_type"),
        F.when(own, _converted(F.col("_cost"), F.col("_rate"))).alias("unit_cost"),
        F.when(own, F.concat(F.col("_errors"), F.when(F.col("_rate") == -1, F.lit("BOM")).otherwise(F.lit("")))).alias("convert_errors"))
