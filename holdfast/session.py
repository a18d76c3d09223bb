"""Session helpers: a local session for tests and the shared folder for intermediate tables."""

from __future__ import annotations

import contextlib
import re
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int = 8, memory: str = "8g", name: str = "holdfast") -> SparkSession:
    """A single-JVM session for tests and benchmarks; on a cluster the caller brings its own."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The cluster's shared folder (``spark.checkpoint.dir``).

    Only where the setting is absent in a session of one machine, as in tests, a local folder is made
    once. On a cluster executors would write there to disks of their own, so that is refused.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if root is None:
        if not re.fullmatch(r"local(\[[^\]]*\])?", context.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="holdfast-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(root)
    return root


def fresh_path(spark: SparkSession, label: str) -> str:
    """A new folder name under the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def materialise(df: DataFrame) -> DataFrame:
    """Cut lineage with a reliable checkpoint, so later jobs see one fixed set of rows."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


_SCRATCH: list[list[str]] = []


@contextlib.contextmanager
def scratch(spark: SparkSession) -> Iterator[list[str]]:
    """Remove the tables that ``stage`` writes to names of its own inside, once their results are written
    elsewhere; the list holds their paths, and what is taken from it stays."""
    _SCRATCH.append([])
    try:
        yield _SCRATCH[-1]
    finally:
        for path in _SCRATCH.pop():
            place = spark._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


@contextlib.contextmanager
def brief_shuffles(spark: SparkSession) -> Iterator[None]:
    """Inside, the shuffle files of a query go when it ends, not when the driver happens to collect its garbage.
    Only for steps whose results are written: nothing may run on those shuffles again."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def stage(df: DataFrame, label: str, folder: str | None = None) -> DataFrame:
    """Write a frame as Parquet and read it back: later jobs scan only the columns they need, and a
    lost executor costs a re-read, not the whole lineage."""
    path = f"{folder.rstrip('/')}/{label}.parquet" if folder else fresh_path(df.sparkSession, label)
    if _SCRATCH and not folder:
        _SCRATCH[-1].append(path)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
