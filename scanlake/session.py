"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import re
import tempfile
import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession


def local_session(cores: int | str = "*", partitions: int = 8) -> SparkSession:
    """A session for tests and benches; on a cluster use the one you are given."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("scanlake")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )


def shared_folder(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``; a temporary one only in local mode."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        folder = spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="scanlake-")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(folder)
    # With its scheme, so that Spark and the Python workers mean the same place.
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs.makeQualified(path).toString().rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder; nothing is created yet."""
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    for folders in _scratch[-1:]:
        folders.append((spark, path))
    return path


#: Of each open ``scratch`` block the folders named inside it.
_scratch: list[list[tuple[SparkSession, str]]] = []


@contextmanager
def scratch() -> Iterator[None]:
    """Delete the intermediate folders of the block when it ends, also by an error.

    What is to be kept must be written elsewhere by then; nothing lazy may outlive the block.
    """
    _scratch.append([])
    try:
        yield
    finally:
        for spark, path in _scratch.pop():
            delete(spark, path)


def delete(spark: SparkSession, path: str) -> None:
    """Delete a folder with all it holds; none there is no error."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def make_folder(spark: SparkSession, path: str) -> None:
    """Create a folder that is not there yet."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(folder)


def folders_with_age(spark: SparkSession, parent: str) -> list[tuple[str, float]]:
    """Names of the folders in ``parent`` and the seconds since each was changed."""
    path = spark._jvm.org.apache.hadoop.fs.Path(parent)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return []
    now = time.time()
    found = [s for s in fs.listStatus(path) if s.isDirectory()]
    return [(s.getPath().getName(), now - s.getModificationTime() / 1000) for s in found]


def sweep_scratch(spark: SparkSession, older_than: float) -> list[str]:
    """Delete intermediate folders that were last changed over ``older_than`` seconds ago; their names.

    For folders that drivers left behind when they were lost. The age must exceed the longest job that still runs.
    """
    root = shared_folder(spark)
    old = [n for n, age in folders_with_age(spark, root) if age >= older_than and re.search("-[0-9a-f]{32}$", n)]
    for name in old:
        delete(spark, f"{root}/{name}")
    return sorted(old)


def written(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back: cuts lineage, survives executors."""
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df: DataFrame, *keys: Column | str) -> DataFrame:
    """Deal the rows of a scan with fewer splits than cores over all cores, by key if given.

    A large table has splits enough and is left alone.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, *keys) if df.rdd.getNumPartitions() < cores else df
