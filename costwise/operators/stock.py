"""Stock balances and movements."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def stock_per_bin(entries: DataFrame, items: DataFrame,
                  keys: Sequence[str] = ("item_no", "location_code", "bin_code", "lot_no")) -> DataFrame:
    """Sum quantities per item/location/bin/lot, keep non-zero (after rounding to 3) balances.

    Aggregates first (map-side partial sums), then attaches item attributes, so
    the join sees one row per balance instead of one per entry.
    """
    bal = (entries.groupBy(*keys).agg(F.round(F.sum("quantity"), 3).alias("quantity"))
           .filter(F.col("quantity") != 0))
    attrs = items.select("item_no", "description", "posting_group", "base_uom", "unit_cost")
    return bal.join(attrs, "item_no", "left")


def purchased_by_month(values: DataFrame, items: DataFrame, start, end, produced_groups: Sequence[str],
                       entry_type: int = 0) -> DataFrame:
    """Purchases by year/month/location/item between ``start`` and ``end``.

    Entries in a produced posting group count only when the item was ever
    purchased in such a group (semi join on a distinct item list). The entry
    type is a parameter; 0 (purchase) is the default.
    """
    groups = list(produced_groups)
    bought = (values.filter((F.col("entry_type") == 0) & F.col("entry_group").isin(groups))
              .select("item_no").distinct().withColumn("_bought", F.lit(True)))
    scoped = (values.filter((F.col("entry_type") == entry_type)
                            & F.col("posting_date").between(F.lit(start).cast("date"), F.lit(end).cast("date")))
              .join(bought, "item_no", "left")
              .filter(F.when(~F.col("entry_group").isin(groups), F.lit(True))
                      .otherwise(F.col("_bought").isNotNull())))
    agg = (scoped.groupBy(F.year("posting_date").alias("year"), F.month("posting_date").alias("month"),
                          "location_code", "item_no", F.col("entry_group").alias("posting_group"))
           .agg(F.sum("quantity").alias("quantity"), F.sum("cost_amount").alias("cost_actual"),
                F.sum("cost_expected").alias("cost_expected")))
    attrs = items.select("item_no", F.col("description").alias("item_name"),
                         F.col("item_range").alias("technical_family"), "base_uom", "unit_cost")
    return agg.join(attrs, "item_no", "left")
