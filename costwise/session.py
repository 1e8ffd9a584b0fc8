"""Session helpers: a tuned local session for tests/bench and the checkpoint folder."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def local_session(cpus: int | str = "*", shuffle_partitions: int | None = None,
                  app: str = "costwise") -> SparkSession:
    """Session used by tests and bench; a cluster job gets its session from the launcher."""
    parts = shuffle_partitions or (int(cpus) if str(cpus).isdigit() else os.cpu_count() or 8)
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the cluster.

    ``spark.checkpoint.dir`` is read from the session. Only a local-mode session
    (tests, bench) without one gets a fresh folder under /tmp; a cluster session
    without one is an error, because a machine-local folder does not survive the
    loss of an executor.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if conf:
        sc.setCheckpointDir(conf)
        return sc.getCheckpointDir() or conf
    if sc.master.startswith("local"):
        folder = tempfile.mkdtemp(prefix="costwise-ckpt-", dir="/tmp")
        sc.setCheckpointDir(folder)
        return sc.getCheckpointDir() or folder
    raise RuntimeError("spark.checkpoint.dir is not set; point it at a shared folder (HDFS/S3/ABFS)")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path under the shared checkpoint folder."""
    import uuid

    return f"{checkpoint_dir(spark).rstrip('/')}/costwise-{label}-{uuid.uuid4().hex}"


def spread(df):
    """A side of a join that grows with the tables, shuffled and merged. A planner goes by the size of files, and the files of keys and
    of written steps are small for their rows: it would send such a side whole through the driver."""
    return df.hint("merge")


#: Spark's own switch: the shuffle files of an execution go when it ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def materialize(df, label: str = "stage"):
    """Write ``df`` as parquet under the shared checkpoint folder and read it back.

    Cuts the lineage *and* the logical plan (a checkpointed Dataset keeps its origin
    plan, which nests level after level in iterative jobs). A lost executor re-reads
    the files instead of recomputing earlier iterations. The shuffle files of the
    write are removed with it: what follows reads the written rows.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.mode("errorifexists").parquet(path)
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)
    out = spark.read.schema(df.schema).parquet(path)  # known: no job to read footers
    out.written = True  # as it stands; what is derived from it is not
    return out
