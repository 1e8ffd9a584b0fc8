"""Keyed upsert (newer wins); ``stored`` writes it to tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def upsert_newer(target: DataFrame, staging: DataFrame, keys: Sequence[str], ts: str) -> DataFrame:
    """``insert … on conflict do update … where excluded.ts >= t.ts``.

    Full outer join on the key: the staging row wins when the key is new or its
    ``ts`` is not older than the target's (equal wins); otherwise the target row
    stays. Staging must be unique on ``keys``. Idempotent: applying the same staging
    twice gives the same table.
    """
    cols = target.columns
    t = target.select(*[F.col(c).alias(f"_t_{c}") for c in cols], F.lit(True).alias("_t_present"))
    s = staging.select(*[F.col(c).alias(f"_s_{c}") for c in cols], F.lit(True).alias("_s_present"))
    cond = None
    for k in keys:
        c = F.col(f"_t_{k}") == F.col(f"_s_{k}")
        cond = c if cond is None else cond & c
    j = t.join(s, cond, "full_outer")
    take_s = F.col("_s_present").isNotNull() & (
        F.col("_t_present").isNull() | (F.col(f"_s_{ts}") >= F.col(f"_t_{ts}")))
    return j.select(*[F.when(take_s, F.col(f"_s_{c}")).otherwise(F.col(f"_t_{c}")).alias(c) for c in cols])
