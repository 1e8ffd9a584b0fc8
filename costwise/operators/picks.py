"""Top-1 picks, as-of version choice and multi-key anti/semi joins.

``latest_row`` is ``row_number() = 1`` over an explicit total order. Spark plans
this as a partial ``WindowGroupLimit`` before the shuffle, so a hot key sends one
row per map task, not all of its rows, to the final window.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import spread


def latest_row(df: DataFrame, keys: Sequence[str], order: Sequence[Column], rn: str = "_rn") -> DataFrame:
    """One row per ``keys``: the first by ``order`` (give a total order; add the key columns last)."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rn, F.row_number().over(w)).filter(F.col(rn) == 1).drop(rn)


def version_candidates(versions: DataFrame, lines: DataFrame, header: DataFrame, *, key: str,
                       version: str, start: str, modified: str, location: str, status: str,
                       rowversion: str, line_key: str, line_version: str, line_start: str | None,
                       line_rowversion: str, header_key: str, header_status: str,
                       header_modified: str, statuses: Sequence[int] = (0, 1),
                       fallback_start: str | None = None) -> DataFrame:
    """Versions that may be picked: declared versions with an allowed status (priority 0)
    plus one fallback row per header whose lines carry no version code (priority 1).

    The fallback row takes max start date (or ``fallback_start`` when given), max
    header modified date and max line row-version; version and location are null.
    Output columns: key, version, start_date, modified, location, rowversion, priority.
    """
    declared = versions.filter(F.col(status).isin(list(statuses))).select(
        F.col(key).alias("key"),
        F.col(version).alias("version"),
        F.col(start).cast("date").alias("start_date"),
        F.col(modified).alias("modified"),
        F.when(F.col(location) != "", F.col(location)).alias("location"),
        F.col(rowversion).alias("rowversion"),
        F.lit(0).alias("priority"),
    )
    lines_nv = lines.filter(F.col(line_version).isNull() | (F.length(line_version) == 0))
    hdr = header.filter(F.col(header_status).isin(list(statuses))).select(
        F.col(header_key).alias("_hk"), F.col(header_modified).alias("_hm"))
    if fallback_start is None and line_start is None:
        raise ValueError("give line_start or fallback_start")
    start_col = (F.lit(fallback_start).cast("date") if fallback_start
                 else F.max(F.col(line_start).cast("date")))
    fallback = (lines_nv.join(spread(hdr), F.col(line_key) == F.col("_hk"))
                .groupBy(F.col(line_key).alias("key"))
                .agg(F.lit(None).cast("string").alias("version"),
                     start_col.alias("start_date"),
                     F.max("_hm").alias("modified"),
                     F.lit(None).cast("string").alias("location"),
                     F.max(F.col(line_rowversion)).alias("rowversion"),
                     F.lit(1).alias("priority")))
    return declared.unionByName(fallback).distinct()


def pick_version(requests: DataFrame, candidates: DataFrame, as_of, *, key: str = "key",
                 location: str = "location") -> DataFrame:
    """As-of version choice for each distinct (key, location) request.

    Among candidates with ``start_date <= as_of``: a candidate in the requested
    location ranks 2, else its priority (fallback 1, other 0); then latest start,
    latest modified, highest row-version (null first, as in the source), then version code so the
    pick is total. Returns (key, location, version, version_location).
    """
    req = requests.select(F.col(key).alias("_rk"), F.col(location).alias("_rl")).distinct()
    cand = candidates.filter(F.col("start_date") <= F.lit(as_of).cast("date"))
    joined = req.join(spread(cand), F.col("_rk") == F.col("key"))
    rank = F.when(F.col("location") == F.col("_rl"), F.lit(2)).otherwise(F.col("priority"))
    picked = latest_row(joined, ["_rk", "_rl"], [
        rank.desc(), F.col("start_date").desc_nulls_last(), F.col("modified").desc_nulls_last(),
        F.col("rowversion").desc_nulls_first(), F.col("version").asc_nulls_first()])
    return picked.select(F.col("_rk").alias(key), F.col("_rl").alias(location),
                         F.col("version"), F.col("location").alias("version_location"))


def anti_any(left: DataFrame, right: DataFrame, left_keys: Sequence[str], right_key: str) -> DataFrame:
    """Rows of ``left`` none of whose ``left_keys`` occur in ``right[right_key]``.

    ``not exists (... where r.key in (l.a, l.b))`` as a chain of equi anti joins
    (an OR condition would plan as a nested-loop join).
    """
    keys = right.select(F.col(right_key).alias("_ak")).distinct()
    out = left
    for k in left_keys:
        out = out.join(keys, out[k] == keys["_ak"], "left_anti")
    return out

