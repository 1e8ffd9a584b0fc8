"""Unit-of-measure conversion rates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import QTY


def assert_unique(df: DataFrame, keys, what: str = "lookup") -> None:
    """Raise if ``keys`` repeat (a scalar lookup with two matches is an error)."""
    dup = df.groupBy(*keys).count().filter(F.col("count") > 1).limit(5).collect()
    if dup:
        raise ValueError(f"duplicate {what} keys: {[tuple(r) for r in dup]}")


def with_uom_rate(df: DataFrame, item: str, from_uom: str, to_uom: str, item_uom: DataFrame,
                  out: str = "rate", *, uom_item: str = "item_no", uom_code: str = "code",
                  uom_qty: str = "qty_per_uom") -> DataFrame:
    """Add ``out`` = target qty-per-unit / source qty-per-unit, or -1 when either is
    missing or 0. Keys compare upper-cased on both sides.

    The item-UoM table is joined twice as a regular equi join (it grows with the item
    master, so no unconditional broadcast; AQE broadcasts it when it is small).
    """
    u = item_uom.select(F.upper(F.col(uom_item).cast("string")).alias("_ui"),
                        F.upper(F.col(uom_code)).alias("_uc"), F.col(uom_qty).cast(QTY).alias("_uq"))
    src = u.select(F.col("_ui").alias("_si"), F.col("_uc").alias("_sc"), F.col("_uq").alias("_sq"))
    tgt = u.select(F.col("_ui").alias("_ti"), F.col("_uc").alias("_tc"), F.col("_uq").alias("_tq"))
    key = F.upper(F.col(item).cast("string"))
    j = (df.join(src, (key == F.col("_si")) & (F.upper(F.col(from_uom)) == F.col("_sc")), "left")
         .join(tgt, (key == F.col("_ti")) & (F.upper(F.col(to_uom)) == F.col("_tc")), "left"))
    s, t = F.coalesce(F.col("_sq"), F.lit(0)), F.coalesce(F.col("_tq"), F.lit(0))
    rate = F.when((s == 0) | (t == 0), F.lit(-1).cast("decimal(38,20)")).otherwise(
        (t / s).cast("decimal(38,20)"))
    return j.withColumn(out, rate).drop("_si", "_sc", "_sq", "_ti", "_tc", "_tq")
