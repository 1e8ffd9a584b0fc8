"""Production BOM, routing and item master derived from ``part`` and ``lineitem``.

* BOM ``B<p>`` of part p has lines to parts 2p+1 (line 10000) and 2p+2 (line 20000)
  when they exist; a PROMO child is a phantom line (type 2, the line names the BOM).
* Item types: SMALL -> MAT_PRIMA (raw material, always a leaf), ECONOMY/STANDARD ->
  PF (finished package, explosion root), others SEMIFABR.
* Routing ``R<p>`` has one operation per line number of p's line items; operation
  numbers are text (15, 30, ..., 105: text order differs from numeric order).
* Lines and routing lines carry no version code, so every header gets the fallback
  version; BOM headers whose part size is a multiple of 11 are closed (no version).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import QTY, unit_cost
from ..operators.picks import latest_row, version_candidates
from ..session import spread
from .tables import Tables

AS_OF = "2000-01-01"


def _s(c):
    return c.cast("string")


def item_type(p_type):
    return (F.when(p_type == "SMALL", F.lit("MAT_PRIMA"))
            .when(p_type.isin("ECONOMY", "STANDARD"), F.lit("PF")).otherwise(F.lit("SEMIFABR")))


def edges(t: Tables) -> DataFrame:
    return t.derived("edges", lambda: _edges(t))


def _edges(t: Tables) -> DataFrame:
    p = t.part.select(F.col("p_partkey").alias("parent"), F.posexplode(
        F.array(F.col("p_partkey") * 2 + 1, F.col("p_partkey") * 2 + 2)).alias("k", "child"))
    c = t.part.select(F.col("p_partkey").alias("child"), F.col("p_size").alias("c_size"),
                      F.col("p_type").alias("c_type"))
    return p.join(spread(c), "child")


def bom_lines(t: Tables) -> DataFrame:
    return t.derived("bom_lines", lambda: _bom_lines(t))


def _bom_lines(t: Tables) -> DataFrame:
    e = edges(t)
    size = F.col("c_size")
    line_type = F.when(F.col("c_type") == "PROMO", F.lit(2)).otherwise(F.lit(1))
    return e.select(
        F.concat(F.lit("B"), _s(F.col("parent"))).alias("bom_no"), F.lit("").alias("version_code"),
        ((F.col("k") + 1) * 10000).cast("int").alias("line_no"), line_type.alias("line_type"),
        F.when(line_type == 2, F.concat(F.lit("B"), _s(F.col("child")))).otherwise(_s(F.col("child"))).alias("no_"),
        F.concat(F.lit("line "), _s(F.col("child"))).alias("line_description"),
        (1 + size % 3).cast(QTY).alias("quantity_per"), (size % 5).cast(QTY).alias("scrap_pct"),
        F.when(size % 7 == 0, F.when(size % 4 == 0, F.lit("PAL")).otherwise(F.lit("BOX"))).otherwise(F.lit("UN")).alias("uom"),
        F.when(size % 3 == 0, F.lit("")).otherwise(F.concat(F.lit("RL"), _s(size % 3))).alias("link_code"),
        F.lit("1990-01-01").cast("date").alias("starting_date"),
        F.when(size == 1, F.lit("1995-01-01")).otherwise(F.lit("1753-01-01")).cast("date").alias("ending_date"),
        (F.col("parent") * 10 + F.col("k")).alias("ts"))


def bom_header(t: Tables) -> DataFrame:
    return t.derived("bom_header", lambda: _bom_header(t))


def _bom_header(t: Tables) -> DataFrame:
    parents = edges(t).select("parent").distinct()
    p = t.part.join(spread(parents), F.col("p_partkey") == F.col("parent"))
    return p.select(F.concat(F.lit("B"), _s(F.col("p_partkey"))).alias("no_"),
                    F.when(F.col("p_size") % 11 == 0, F.lit(3)).otherwise(F.lit(1)).alias("status"),
                    F.lit("2000-01-01 00:00:00").cast("timestamp_ntz").alias("last_modified"))


def part_lines(t: Tables) -> DataFrame:
    """The line items by part and line number. Routings, average orders and (if handed to them) item costs are added up from these, so a
    job that needs them all reads the line items once."""
    return t.derived("part_lines", lambda: _part_lines(t))


def _part_lines(t: Tables) -> DataFrame:
    tenths = F.col("l_quantity") * 10
    return t.lineitem.groupBy("l_partkey", "l_linenumber").agg(
        F.min("l_quantity").alias("min_q"), F.max("l_quantity").alias("max_q"), F.count("*").alias("n"), F.max("l_tax").alias("max_tax"),
        F.max("l_discount").alias("max_discount"), F.sum(F.when(tenths > 50, tenths.cast("long"))).alias("order_tenths"),
        F.count(F.when(tenths > 50, 1)).alias("orders"))


def routing_lines(t: Tables) -> DataFrame:
    return t.derived("routing_lines", lambda: _routing_lines(t))


def _routing_lines(t: Tables) -> DataFrame:
    l = part_lines(t).select("l_partkey", "l_linenumber", F.col("min_q").alias("setup"), F.col("max_tax").alias("run"),
                             F.col("max_discount").alias("disc"))
    n = F.col("l_linenumber")
    return l.select(
        F.concat(F.lit("R"), _s(F.col("l_partkey"))).alias("routing_no"), F.lit("").alias("version_code"),
        _s(n * 15).alias("operation_no"),
        F.when(n % 3 == 0, F.lit("")).otherwise(F.concat(F.lit("RL"), _s(n % 3))).alias("link_code"),
        F.concat(F.lit("WC"), _s(n % 4)).alias("work_center"),
        F.col("setup").cast(QTY).alias("setup_time"), F.col("run").cast("decimal(18,2)").cast(QTY).alias("run_time"),
        F.lit(0).cast(QTY).alias("fixed_scrap"),
        (F.col("disc").cast("decimal(18,2)") * 100).cast(QTY).alias("scrap_factor"),
        F.when(n == 3, F.lit(1)).otherwise(F.lit(0)).cast(QTY).alias("fixed_scrap_accum"),
        (n % 2).cast(QTY).alias("scrap_factor_accum"), (n % 3 + 1).alias("workers"),
        (F.col("l_partkey") * 10 + n).alias("ts"))


def route_scrap(rl: DataFrame) -> DataFrame:
    """First operation (text order) per routing, version and link code."""
    r = rl.withColumn("version_key", F.coalesce(F.when(F.col("version_code") != "", F.col("version_code")),
                                                F.lit("_null")))
    return latest_row(r, ["routing_no", "version_key", "link_code"], [F.col("operation_no").asc()]).select(
        "routing_no", "version_key", "link_code", "fixed_scrap", "scrap_factor", "fixed_scrap_accum",
        "scrap_factor_accum")


def _no_versions(header: DataFrame) -> DataFrame:
    return header.filter(F.lit(False)).select(
        F.col("no_").alias("key"), F.lit(None).cast("string").alias("version"),
        F.lit(None).cast("date").alias("start"), F.col("last_modified").alias("modified"),
        F.lit(None).cast("string").alias("location"), F.lit(0).alias("status"), F.lit(0).cast("long").alias("ts"))


def bom_candidates(t: Tables) -> DataFrame:
    return t.derived("bom_candidates", lambda: _bom_candidates(t))


def _bom_candidates(t: Tables) -> DataFrame:
    h = bom_header(t)
    return version_candidates(
        _no_versions(h), bom_lines(t), h, key="key", version="version", start="start", modified="modified",
        location="location", status="status", rowversion="ts", line_key="bom_no", line_version="version_code",
        line_start="starting_date", line_rowversion="ts", header_key="no_", header_status="status",
        header_modified="last_modified")


def route_candidates(t: Tables, rl: DataFrame | None = None) -> DataFrame:
    rl = rl if rl is not None else routing_lines(t)
    h = t.part.filter(F.col("p_type") != "SMALL").select(
        F.concat(F.lit("R"), _s(F.col("p_partkey"))).alias("no_"), F.lit(1).alias("status"),
        F.lit("2000-01-01 00:00:00").cast("timestamp_ntz").alias("last_modified"))
    return version_candidates(
        _no_versions(h), rl, h, key="key", version="version", start="start", modified="modified",
        location="location", status="status", rowversion="ts", line_key="routing_no", line_version="version_code",
        line_start=None, line_rowversion="ts", header_key="no_", header_status="status",
        header_modified="last_modified", fallback_start="1753-01-01")


def valid_lines(t: Tables, cand: DataFrame, as_of: str = AS_OF) -> DataFrame:
    """Lines valid on ``as_of`` joined to their version candidate (null-safe version key)."""
    a = F.lit(as_of).cast("date")
    ln = bom_lines(t).filter((F.col("starting_date") <= a) & (F.coalesce(
        F.when(F.col("ending_date") != F.lit("1753-01-01").cast("date"), F.col("ending_date")),
        F.date_add(a, 1)) > a))
    c = cand.select(F.col("key").alias("_ck"), F.coalesce(F.col("version"), F.lit("_null")).alias("_cv"),
                    F.col("location").alias("version_location"))
    vk = F.coalesce(F.when(F.col("version_code") != "", F.col("version_code")), F.lit("_null"))
    return ln.join(spread(c), (F.col("bom_no") == F.col("_ck")) & (vk == F.col("_cv"))).drop("_ck", "_cv")


def item_facts(t: Tables) -> DataFrame:
    return t.derived("item_facts", lambda: _item_facts(t))


def _item_facts(t: Tables, lines: DataFrame | None = None) -> DataFrame:
    """``lines``: ``part_lines``, for a job that reads them anyhow."""
    from ..plans.costs import _cost_inputs
    parents = edges(t).select(F.col("parent").alias("_par")).distinct()
    c = _cost_inputs(t, lines)
    p = t.part.join(spread(parents), F.col("p_partkey") == F.col("_par"), "left").join(
        spread(c), F.col("p_partkey") == F.col("item_no"))
    ity = item_type(F.col("p_type"))
    uc = unit_cost("nav_unit", "nav_standard", "nav_last", "estimate", "purchase", "legacy")
    return p.select(
        _s(F.col("p_partkey")).alias("item_no"), F.col("p_name").alias("description"), ity.alias("item_type"),
        F.when(F.col("_par").isNotNull(), F.concat(F.lit("B"), _s(F.col("p_partkey")))).alias("production_bom_no"),
        F.when(ity != "MAT_PRIMA", F.concat(F.lit("R"), _s(F.col("p_partkey")))).alias("routing_no"),
        F.col("p_brand").alias("family"), F.lit("UN").alias("base_uom"), F.col("p_size").alias("size"),
        F.col("nav_unit").alias("nav_unit_cost"), F.col("nav_standard").alias("nav_standard_cost"),
        F.col("nav_last").alias("nav_last_direct_cost"), F.col("estimate").alias("estimate_cost"),
        F.col("purchase").alias("last_purchase_price"), F.col("legacy").alias("legacy_unit_cost"),
        uc.unit_cost_type.alias("unit_cost_type"), uc.unit_cost.alias("unit_cost"), F.lit("").alias("errors"))


def uom_rates(t: Tables) -> DataFrame:
    return t.derived("uom_rates", lambda: _uom_rates(t))


def _uom_rates(t: Tables) -> DataFrame:
    from ..plans.costs import item_uom
    u = item_uom(t)
    base = u.filter(F.upper("code") == "UN").select(F.col("item_no").alias("_b"), F.col("qty_per_uom").alias("_bq"))
    j = u.join(spread(base), F.col("item_no") == F.col("_b"), "left")
    rate = F.when((F.coalesce(F.col("_bq"), F.lit(0)) == 0) | (F.col("qty_per_uom") == 0), F.lit(-1)).otherwise(
        F.col("qty_per_uom") / F.col("_bq"))
    return j.select("item_no", F.col("code").alias("uom"), rate.cast("decimal(38,20)").alias("rate"))


def avg_quantity(t: Tables) -> DataFrame:
    """Average order quantity per package rounded to hundreds (exact integer arithmetic)."""
    return (part_lines(t).filter("orders > 0").groupBy(_s(F.col("l_partkey")).alias("item_no"))
            .agg(F.sum("order_tenths").alias("_s"), F.sum("orders").alias("_n"))
            .select("item_no", (F.expr("(_s + 50 * _n) div (100 * _n)") * 100).alias("avg_calc")))


def packages(t: Tables, items: DataFrame, bcand: DataFrame, rcand: DataFrame, as_of: str = AS_OF) -> DataFrame:
    """Finished-package headers: PF items with a BOM that has a version; best BOM and
    routing versions for the item's factory; average order quantity (200 below 50)."""
    from ..operators.picks import pick_version
    pk = (items.filter((F.col("item_type") == "PF") & F.col("production_bom_no").isNotNull())
          .withColumn("factory", F.concat(F.lit("F"), _s(F.col("size") % 3 + 1))))
    has_version = bcand.select(F.col("key").alias("production_bom_no")).distinct()
    pk = pk.join(spread(has_version), "production_bom_no", "left_semi")
    bp = pick_version(pk.select(F.col("production_bom_no").alias("key"), F.col("factory").alias("location")),
                      bcand, as_of)
    pk = pk.join(spread(bp.select(F.col("key").alias("production_bom_no"), F.col("location").alias("factory"),
                                  F.col("version").alias("bom_version"), F.col("version_location").alias("bom_location"))),
                 ["production_bom_no", "factory"], "left")
    pk = pk.withColumn("_rloc", F.coalesce(F.col("bom_location"), F.col("factory")))
    rp = pick_version(pk.select(F.col("routing_no").alias("key"), F.col("_rloc").alias("location")), rcand, as_of)
    pk = pk.join(spread(rp.select(F.col("key").alias("routing_no"), F.col("location").alias("_rloc"),
                                  F.col("version").alias("route_version"), F.col("version_location").alias("route_location"))),
                 ["routing_no", "_rloc"], "left")
    pk = pk.join(spread(avg_quantity(t)), "item_no", "left")
    low = F.coalesce(F.col("avg_calc"), F.lit(0)) < 50
    return pk.select(
        F.col("item_no").alias("root_item"), F.col("description").alias("root_description"),
        F.col("family").alias("root_range"),
        F.when(low, F.lit("Default")).otherwise(F.lit("Calculated")).alias("avg_qty_type"),
        F.when(low, F.lit(200)).otherwise(F.col("avg_calc")).cast(QTY).alias("avg_qty"),
        "item_no", "description", "item_type", "factory", F.col("production_bom_no").alias("bom_no"),
        "bom_version", "bom_location", "routing_no", "route_version", "route_location")
