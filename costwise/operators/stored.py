"""Stored tables that change in one step: part files of a run, and a manifest that says which run holds each part.

Layout under a table's path::

    runs/run=<id>/<column>=<value>/...   rows, written once, never changed
    manifest/version=<n>/...             (part, run) of every part; the highest version is the table

A change writes the parts that it touches as a new run and then one small manifest file. Until that file is there readers see
the old parts; a job that dies leaves rows that no manifest names. Two writers of one version meet at the manifest folder, and the
second fails. Parts that are not touched keep their run, so their files keep their names.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .upsert import upsert_newer

BUCKET = "_bucket"


def manifest(spark: SparkSession, path: str) -> tuple[int, dict[str, str]]:
    """The table's version (0: none yet) and its parts' runs. One row a part: days or buckets, not rows."""
    try:
        rows = spark.read.parquet(f"{path}/manifest")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return 0, {}
    version = rows.agg(F.max("version")).first()[0]
    return version, {r.part: r.run for r in rows.filter((F.col("version") == version) & F.col("part").isNotNull()).collect()}


def _commit(spark: SparkSession, path: str, version: int, runs: dict[str, str]) -> None:
    # an empty table is one row without a part, as an empty folder would be no table
    rows = spark.createDataFrame(sorted(runs.items()) or [(None, None)], "part string, run string").coalesce(1)
    rows.write.mode("errorifexists").parquet(f"{path}/manifest/version={version}")


def publish(df: DataFrame, path: str, column: str, replaced: Sequence[str] = ()) -> None:
    """Replaces the parts of ``column`` that ``df`` has rows of, and empties those of ``replaced`` that it has none of; all others stay."""
    spark = df.sparkSession
    version, runs = manifest(spark, path)
    run = f"r{version + 1}-{uuid.uuid4().hex}"
    df.write.mode("errorifexists").partitionBy(column).parquet(f"{path}/runs/run={run}")
    parts = [] if df.isEmpty() else (spark.read.parquet(f"{path}/runs/run={run}").select(F.col(column).cast("string").alias("p")).distinct()
                                     .collect())
    if any(r.p is None for r in parts):
        raise ValueError(f"rows without {column}")
    if parts or replaced:
        kept = {p: r for p, r in runs.items() if p not in set(replaced)}
        _commit(spark, path, version + 1, {**kept, **{r.p: run for r in parts}})


def read(spark: SparkSession, path: str, column: str, parts: Sequence[str] | None = None) -> DataFrame:
    """The table as of its manifest, or some of its parts. Only the runs and parts it names are read."""
    version, runs = manifest(spark, path)
    wanted = {p: r for p, r in runs.items() if parts is None or p in set(parts)}
    if not version:
        raise ValueError(f"no table at {path}")
    if not runs:
        return spark.read.parquet(f"{path}/runs").drop("run").filter(F.lit(False))
    rows = spark.read.option("basePath", f"{path}/runs").parquet(*[f"{path}/runs/run={r}" for r in sorted(set(runs.values()))])
    by_run: dict[str, list[str]] = {}
    for p, r in wanted.items():
        by_run.setdefault(r, []).append(p)
    keep = F.lit(False)
    for r, ps in by_run.items():
        keep = keep | ((F.col("run") == r) & F.col(column).cast("string").isin(ps))
    return rows.filter(keep).drop("run")


def in_parts(df: DataFrame, keys: Sequence[str], buckets: int) -> DataFrame:
    """With the part of each row by a hash of its key."""
    return df.withColumn(BUCKET, F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int"))


def create(df: DataFrame, path: str, keys: Sequence[str], buckets: int) -> None:
    """A keyed table in ``buckets`` parts by a hash of its key."""
    publish(in_parts(df, keys, buckets), path, BUCKET)


def merge(staging: DataFrame, path: str, keys: Sequence[str], ts: str, buckets: int) -> None:
    """Newer-wins upsert of ``staging`` into a keyed table: only the buckets that it has keys of are read and written anew."""
    spark = staging.sparkSession
    staging = in_parts(staging, keys, buckets)
    touched = sorted(str(r[0]) for r in staging.select(BUCKET).distinct().collect())
    if not touched:
        return
    _, runs = manifest(spark, path)
    if not runs:
        publish(staging, path, BUCKET)
        return
    old = read(spark, path, BUCKET, touched)
    publish(upsert_newer(old.select(*staging.columns), staging, [BUCKET, *keys], ts), path, BUCKET)


def table(spark: SparkSession, path: str) -> DataFrame:
    """A keyed table without its bucket column."""
    return read(spark, path, BUCKET).drop(BUCKET)


def archive(tables: dict[str, DataFrame], date, path: str, column: str = "bom_date") -> None:
    """Adds each table under ``{path}/{name}`` as of ``date``; a null date, or one that any of them holds already, is an error
    and nothing is written."""
    if date is None:
        raise ValueError("snapshot date must not be null")
    spark = next(iter(tables.values())).sparkSession
    for name in tables:
        if str(date) in manifest(spark, f"{path}/{name}")[1]:
            raise ValueError(f"{name} already archived for {date}")
    for name, df in tables.items():
        publish(df.withColumn(column, F.lit(str(date)).cast("date")), f"{path}/{name}", column)
