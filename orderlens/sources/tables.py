"""Plain parquet tables with two ways to write: replace by version, append by batch.

Both rely on nothing but folders and a marker file written last (Spark's own, or one
written after the checks), so they work on any shared file system, and a reader
never sees half a write.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


_PUBLISHED = "_PUBLISHED"


class TableStore:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    # -- folders ---------------------------------------------------------------
    def _path(self, path: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(path)

    def _fs(self, path: str):
        return self._path(path).getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _children(self, path: str) -> list[str]:
        fs = self._fs(path)
        if not fs.exists(self._path(path)):
            return []
        return [status.getPath().getName() for status in fs.listStatus(self._path(path))]

    def _exists(self, path: str) -> bool:
        return self._fs(path).exists(self._path(path))

    # -- replaced tables ---------------------------------------------------------
    def versions(self, name: str) -> list[int]:
        """Finished versions, oldest first."""
        base = f"{self.root}/{name}"
        found = [int(c[1:]) for c in self._children(base) if c.startswith("v") and c[1:].isdigit()]
        return sorted(v for v in found if self._exists(f"{base}/v{v}/{_PUBLISHED}"))

    def publish(
        self, name: str, df: DataFrame, check: Callable[[DataFrame], None] | None = None, keep: int = 2
    ) -> int:
        """Write a new version next to the old one; who reads the old one is not disturbed.

        `check` sees the written rows and raises to keep them from being published.
        """
        base = f"{self.root}/{name}"
        taken = [int(c[1:]) for c in self._children(base) if c.startswith("v") and c[1:].isdigit()]
        version = max(taken, default=0) + 1
        df.write.mode("overwrite").parquet(f"{base}/v{version}")
        if check is not None:
            check(self.spark.read.parquet(f"{base}/v{version}"))
        self._fs(base).create(self._path(f"{base}/v{version}/{_PUBLISHED}")).close()
        for old in self.versions(name)[:-keep]:
            self._fs(base).delete(self._path(f"{base}/v{old}"), True)
        return version

    def current(self, name: str) -> DataFrame:
        versions = self.versions(name)
        if not versions:
            raise FileNotFoundError(f"no finished version of {name} under {self.root}")
        return self.spark.read.parquet(f"{self.root}/{name}/v{versions[-1]}")

    # -- tables appended batch by batch ------------------------------------------
    def put_batch(self, name: str, df: DataFrame, batch_id: int) -> None:
        """Write one batch's rows. Doing it again replaces them, so a retry adds nothing."""
        df.write.mode("overwrite").parquet(f"{self.root}/{name}/batch_id={batch_id}")

    def batches(self, name: str) -> list[int]:
        """Ids of the finished batches."""
        base = f"{self.root}/{name}"
        ids = [int(c.split("=")[1]) for c in self._children(base) if c.startswith("batch_id=")]
        return sorted(i for i in ids if self._exists(f"{base}/batch_id={i}/_SUCCESS"))

    def read_batches(self, name: str, schema: T.StructType, only: list[int] | None = None) -> DataFrame:
        """All finished batches, or those in `only`; an empty table before the first one."""
        finished = self.batches(name)
        wanted = finished if only is None else [i for i in finished if i in set(only)]
        if not wanted:
            return self.spark.createDataFrame([], schema)
        stored = T.StructType([f for f in schema.fields if f.name != "batch_id"])
        base = f"{self.root}/{name}"
        df = (
            self.spark.read.schema(T.StructType([*stored.fields, T.StructField("batch_id", T.LongType())]))
            .option("basePath", base)
            .parquet(*[f"{base}/batch_id={i}" for i in wanted])
        )
        return df.select(*[F.col(f.name) for f in schema.fields])

    def clear(self, name: str) -> None:
        """Empty one table of this store."""
        path = f"{self.root}/{name}"
        self._fs(path).delete(self._path(path), True)
