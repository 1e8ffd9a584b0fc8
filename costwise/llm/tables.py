"""Reading the driver tables and keeping intermediate results for the llm operators."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from costwise import session

__all__ = ["read", "documents", "materialize", "fold"]


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Writes ``df`` under the shared checkpoint folder and reads it back; the shuffle files of the
    job that wrote it are removed with it, as nothing reads them again."""
    conf = df.sparkSession.conf
    before = conf.get(CLEANUP, None)
    conf.set(CLEANUP, "true")
    try:
        return session.materialize(df, label)
    finally:
        if before is None:
            conf.unset(CLEANUP)
        else:
            conf.set(CLEANUP, before)


ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def importable(spark: SparkSession) -> None:
    """Lets Python workers of a local session import this package from its source folder; on a
    cluster it is installed or shipped with the job, and the extra search path finds nothing."""
    env = spark.sparkContext.environment
    have = env.get("PYTHONPATH", "")
    if ROOT not in have.split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, [have, ROOT]))


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    importable(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "documents")


def fold(doc_id, modulus: int):
    """crc32 of the id written as text, modulo ``modulus`` (a null id falls in fold 0)."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(0)) % modulus


OWN = "_own"


def with_own(df: DataFrame) -> DataFrame:
    """With a hash of each row. Taken before a join it lets ``bounded_sample`` count without the other columns, and its filter reaches
    the side that the hash comes from, so that only chosen rows are joined whole."""
    return df.withColumn(OWN, F.xxhash64(*df.columns, F.lit(17)))


def bounded_sample(df: DataFrame, bound: int) -> DataFrame:
    """About ``bound`` different rows chosen by a hash of their columns (all if there are fewer), so a null or repeated id is
    drawn row by row and a row that repeats counts once. Rows are counted and chosen by their hashes (column ``OWN`` if there); only
    chosen ones are shuffled. Used to fit models only; scores and counts run over all rows."""
    columns = [c for c in df.columns if c != OWN]
    df = df if OWN in df.columns else with_own(df)
    n = df.agg(F.approx_count_distinct(OWN, 0.02)).first()[0]
    if n > bound:
        parts = 1 << 30
        df = df.filter(F.pmod(F.col(OWN), F.lit(parts)) < int(parts * bound / n))
    return df.dropDuplicates(columns).select(*columns)
