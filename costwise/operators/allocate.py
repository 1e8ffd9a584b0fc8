"""Pro-rata allocation of a difference and component cost shares."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def share(df: DataFrame, part_keys: Sequence[str], weight: str, total: Column, digits: int,
          out: str = "share", cap: bool = False) -> DataFrame:
    """``round(-1 * weight / coalesce(nullif(sum(weight) over part, 0), 1) * total, digits)``.

    The per-key total is a grouped sum joined back: the aggregation combines map-side,
    so a key holding a large share of the rows does not end up as one window partition
    in one task, and AQE can split that key on the join. With ``cap=True`` (the older
    variant) the whole weight is taken when the key's total weight covers the amount.
    """
    totals = df.groupBy(*part_keys).agg(F.sum(weight).alias("_tot"))
    df = df.join(totals, list(part_keys))
    tot = F.col("_tot")
    denom = F.coalesce(F.when(tot != 0, tot), F.lit(1))
    prorata = (-1 * F.col(weight) / denom * total).cast("decimal(38,12)")
    val = F.when(tot >= total, -1 * F.col(weight)).otherwise(prorata) if cap else prorata
    return df.withColumn(out, F.round(val.cast("decimal(38,12)"), digits)).drop("_tot")
