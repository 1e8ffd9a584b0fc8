"""Parquet table loader.

Every table is read lazily with ``spark.read.parquet``; Catalyst prunes columns and
pushes filters into the scan, so callers select only what they use.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize

DRIVER_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


#: Views of this process's sessions by (application, root, group): state of the tables and the written members.
SHARED: dict[tuple, tuple] = {}


class Tables:
    """Attribute access to ``{root}/{name}.parquet``; each DataFrame is created once per instance."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self._cache: dict[str, DataFrame] = {}

    def derived(self, name: str, build) -> DataFrame:
        """A view derived from the tables, built once per instance and kept persisted
        (memory, spilling to disk) because one job reads it several times."""
        key = f"derived:{name}"
        if key not in self._cache:
            from pyspark import StorageLevel
            self._cache[key] = build().persist(StorageLevel.MEMORY_AND_DISK)
        return self._cache[key]

    def shared(self, name: str, build) -> DataFrame:
        """A view that several jobs of a session read: written once under the checkpoint folder and read by all that follow.

        ``build`` gives a DataFrame, or several by name (then ``name`` is ``group/member`` and all members are written at once). A view holds
        for one state of the tables, told by the files' paths, sizes and times, so jobs over changed tables build it anew."""
        group, _, member = name.partition("/")
        key = (self.spark.sparkContext.applicationId, self.root, group)
        state = self.state()
        have = SHARED.get(key)
        if have is None or have[0] != state:
            made = build()
            made = made if isinstance(made, dict) else {"": made}
            have = SHARED[key] = (state, {m: df if getattr(df, "written", False) else materialize(df, f"shared-{group}-{m}")
                                              for m, df in made.items()})
        return have[1][member]

    def state(self) -> tuple:
        """What the driver tables' files are: per table their number, bytes, last change and a hash of their paths (one row; no
        column is read)."""
        if "state" not in self._cache:
            parts = []
            for name in DRIVER_TABLES:
                files = self.spark.read.parquet(f"{self.root}/{name}.parquet").groupBy("_metadata.file_path", "_metadata.file_size",
                                                                                        "_metadata.file_modification_time").count()
                parts.append(files.agg(F.lit(name), F.count("*"), F.sum("file_size"), F.max("file_modification_time"),
                                       F.bit_xor(F.xxhash64("file_path"))))
            rows = parts[0]
            for more in parts[1:]:
                rows = rows.union(more)
            self._cache["state"] = tuple(sorted(tuple(r) for r in rows.collect()))
        return self._cache["state"]

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or name in ("spark", "root"):
            raise AttributeError(name)
        if name not in self._cache:
            self._cache[name] = self.spark.read.parquet(f"{self.root}/{name}.parquet")
        return self._cache[name]
