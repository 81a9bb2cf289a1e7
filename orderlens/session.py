"""Session settings and the shared folder used to cut lineage."""

from __future__ import annotations

import contextvars
import gc
import os
import tempfile
import uuid
from collections.abc import Callable, Iterator, Mapping
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Only settings that help at any size. Partition counts come from the cluster.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Parquet files unpack to several times their size; a side is broadcast by that.
    "spark.sql.sources.fileCompressionFactor": "4.0",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cpus: int | str = "*", app: str = "orderlens") -> SparkSession:
    """A session for tests and the bench; a cluster brings its own."""
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    spark = (
        builder.config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("ORDERLENS_DRIVER_MEMORY", "12g"))
        .config("spark.sql.shuffle.partitions", "8")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as `spark.checkpoint.dir` names it."""
    sc = spark.sparkContext
    configured = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if configured is None:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        configured = tempfile.mkdtemp(prefix="orderlens-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(configured)
    return configured


#: The tables that `cut_lineage` has written inside `passing_tables`.
_passing: contextvars.ContextVar[list[str] | None] = contextvars.ContextVar("passing", default=None)


def release(spark: SparkSession) -> None:
    """Let Spark delete shuffle files of jobs that are over: it does so when the driver has
    collected the plans of these jobs as garbage, and else keeps them on all disks."""
    gc.collect()
    spark._jvm.System.gc()


@contextmanager
def passing_tables(spark: SparkSession) -> Iterator[None]:
    """Tables that `cut_lineage` writes meanwhile are deleted at the end, also those of `at_once`,
    and shuffle files are released.

    For work whose results are all written elsewhere before it ends.
    """
    paths: list[str] = []
    token = _passing.set(paths)
    try:
        yield
    finally:
        _passing.reset(token)
        for path in paths:
            folder = spark._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
        release(spark)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write `df` as a table in the shared folder and read it from there.

    What follows no longer depends on how the rows were computed, so losing an
    executor cannot renumber or reorder them; and being parquet, later steps read
    only the columns they use.
    """
    path = f"{shared_dir(df.sparkSession).rstrip('/')}/cut-{uuid.uuid4().hex}"
    passing = _passing.get()
    if passing is not None:
        passing.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Jobs that are planned and run side by side; the driver holds the plans of all of them.
_SIDE_BY_SIDE = 4


def at_once(actions: Mapping[str, Callable]) -> dict:
    """Run independent Spark jobs side by side, a few at a time, so that small ones do not queue up."""
    with ThreadPoolExecutor(min(len(actions), _SIDE_BY_SIDE)) as pool:
        running = {name: pool.submit(contextvars.copy_context().run, action) for name, action in actions.items()}
        return {name: job.result() for name, job in running.items()}
