"""Ledger and result tables as numbered Parquet folders.

A ledger version v=N is a whole ledger, or the rows that changed together with the names of the older folders it
builds on: ``commit_changes`` writes in proportion to the change, and merges small parts into larger ones, so that
each part is over twice as large as the next and their number is logarithmic. The newest version counts.
Results are large and only grow: each folder holds the rows of one run, and all of them count.

A folder is written aside and gets its number by one rename that fails if the number is taken, so of two
drivers only one has it. ``commit`` publishes a ledger and the results that belong to it by the same rename:
the ledger's folder names the result folders that count.
"""

from __future__ import annotations

import uuid
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scanlake.schemas import LEDGER, RESULTS
from scanlake.session import delete, folders_with_age


def _versions(spark: SparkSession, root: str) -> list[int]:
    """Versions under ``root`` that were written to the end."""
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(path) if s.isDirectory()]
    as_path = spark._jvm.org.apache.hadoop.fs.Path
    return sorted(
        int(n[2:]) for n in names if n.startswith("v=") and fs.exists(as_path(f"{root}/{n}/_SUCCESS"))
    )


class VersionTaken(RuntimeError):
    """Another driver published the version first."""


def newest(spark: SparkSession, root: str) -> int:
    """The newest complete version, 0 if there is none."""
    return max(_versions(spark, root), default=0)


def _claim(spark: SparkSession, aside: str, target: str) -> bool:
    """Give a finished folder its name; False if another folder with content has it."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    path = hadoop.Path(target)
    context = hadoop.FileContext.getFileContext(
        path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toUri(),
        spark._jsc.hadoopConfiguration(),
    )
    rename = getattr(hadoop, "Options$Rename")
    # An empty folder of that name may be replaced; one with content makes the rename fail.
    how = spark.sparkContext._gateway.new_array(rename, 1)
    how[0] = rename.OVERWRITE
    try:
        context.rename(context.makeQualified(hadoop.Path(aside)), context.makeQualified(path), how)
    except Py4JJavaError:
        if context.util().exists(context.makeQualified(path)):
            return False
        raise
    return True


def write_snapshot(df: DataFrame, root: str, version: int | None = None, notes: str | None = None) -> int:
    """Write the next folder beside the older ones; readers never see a half-written one.

    With ``version`` that number or none: ``VersionTaken`` if another driver has it. ``notes`` become a
    file of the folder, published with it.
    """
    return _publish(df.sparkSession, _write_aside(df, root), root, version, notes)


def _write_aside(df: DataFrame, root: str) -> str:
    aside = f"{root}/_aside-{uuid.uuid4().hex}"
    df.write.parquet(aside)
    return aside


def _publish(spark: SparkSession, aside: str, root: str, version: int | None, notes: str | None) -> int:
    as_path = spark._jvm.org.apache.hadoop.fs.Path
    fs = as_path(root).getFileSystem(spark._jsc.hadoopConfiguration())
    if notes is not None:
        out = fs.create(as_path(f"{aside}/_notes"))
        out.write(notes.encode())
        out.close()
    number = version or newest(spark, root) + 1
    while not _claim(spark, aside, f"{root}/v={number}"):
        if version:
            fs.delete(as_path(aside), True)
            raise VersionTaken(f"{root}/v={version}")
        number += 1
    return number


def _notes(spark: SparkSession, root: str, version: int) -> str:
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/v={version}/_notes")
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return ""
    stream = fs.open(path)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def _runs(spark: SparkSession, root: str, version: int) -> list[str]:
    """The result folders a ledger version names."""
    words = _notes(spark, f"{root}/ledger", version).split() if version else []
    return [w for w in words if w.startswith("run-")]


def _parts(spark: SparkSession, root: str, version: int) -> list[str]:
    """The folders that make up a ledger version, oldest first."""
    words = _notes(spark, f"{root}/ledger", version).split() if version else []
    return [w for w in words if w.startswith("v=")] + [f"v={version}"] * bool(version)


def _bytes(spark: SparkSession, folder: str) -> int:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(path).getLength()


def _merged(spark: SparkSession, folders: list[str]) -> DataFrame:
    """Of every id the row in the latest of the folders, which are given oldest first.

    Only changed rows are grouped. The oldest folder is read once and loses the changed ids, which Spark
    broadcasts where their files are small.
    """
    base, *later = (spark.read.schema(LEDGER).parquet(folder) for folder in folders)
    if not later:
        return base
    changed = later[0]
    if len(later) > 1:
        tagged = reduce(DataFrame.unionByName, [part.withColumn("part", F.lit(n)) for n, part in enumerate(later)])
        row = F.max_by(F.struct(*LEDGER.names), "part").alias("row")
        changed = tagged.groupBy("id").agg(row).select("row.*")
    kept = base.join(reduce(DataFrame.unionByName, [part.select("id") for part in later]), "id", "left_anti")
    return kept.select(LEDGER.names).unionByName(changed)


def read_results(spark: SparkSession, root: str) -> DataFrame:
    """All result rows that count: of the runs that the newest ledger names, and of numbered folders."""
    version = newest(spark, f"{root}/ledger")
    folders = [f"{root}/results/{run}" for run in _runs(spark, root, version)]
    folders += [f"{root}/results/v={number}" for number in _versions(spark, f"{root}/results")]
    return spark.read.schema(RESULTS).parquet(*folders) if folders else spark.createDataFrame([], RESULTS)


def commit(ledger: DataFrame, results: DataFrame | None, root: str, after: int) -> int:
    """Publish a ledger made from version ``after``, and result rows with it; the new version.

    Results of a commit that did not come about are never read. ``VersionTaken`` if somebody else published
    since ``after``.
    """
    runs = _runs_with(results, ledger.sparkSession, root, after)
    return write_snapshot(ledger, f"{root}/ledger", after + 1, "\n".join(runs))


def _runs_with(results: DataFrame | None, spark: SparkSession, root: str, after: int) -> list[str]:
    """Write result rows aside; the result folders of the version to come."""
    runs = _runs(spark, root, after)
    if results is not None:
        runs.append(f"run-{uuid.uuid4().hex}")
        results.write.parquet(f"{root}/results/{runs[-1]}")
    return runs


def commit_changes(changes: DataFrame, results: DataFrame | None, root: str, after: int) -> int:
    """Like ``commit``, from the rows alone that changed or came since version ``after``; one row an id.

    Written are the changes and, with them, the trailing parts that are not over twice as large; if that takes
    in all of them, the version is a whole ledger again. Over many commits a row is rewritten about as often
    as there are parts, a logarithm. Rows are never removed; use ``commit`` for that.
    """
    spark, ledger = changes.sparkSession, f"{root}/ledger"
    runs = _runs_with(results, spark, root, after)
    parts = _parts(spark, root, after)
    aside = _write_aside(changes, ledger)
    size, taken = _bytes(spark, aside), []
    while parts and _bytes(spark, f"{ledger}/{parts[-1]}") <= 2 * size:
        taken.insert(0, parts.pop())
        size += _bytes(spark, f"{ledger}/{taken[0]}")
    if taken:
        alone, aside = aside, _write_aside(_merged(spark, [*(f"{ledger}/{part}" for part in taken), aside]), ledger)
        delete(spark, alone)
    return _publish(spark, aside, ledger, after + 1, "\n".join(parts + runs))


def sweep(spark: SparkSession, root: str, keep: int = 2, older_than: float = 86_400.0) -> list[str]:
    """Delete what no reader needs below ``root``; the paths that went, relative to it.

    Kept are the newest ``keep`` ledgers, all ledger and result folders that one of them names, and every
    numbered result folder. Result folders are listed before the ledgers are read, so one published in between is kept. Folders that no ledger names yet, and
    unfinished ones, stay until ``older_than`` seconds have passed since their last change: a running commit
    must take less. A stop within the sweep leaves folders over, which the next one deletes.
    """
    if keep < 1:
        raise ValueError("at least the newest ledger is kept")
    results = folders_with_age(spark, f"{root}/results")
    ledgers = folders_with_age(spark, f"{root}/ledger")
    versions = _versions(spark, f"{root}/ledger")
    kept = versions[-keep:]
    named = {run for version in kept for run in _runs(spark, root, version)}
    parts = {part for version in kept for part in _parts(spark, root, version)}
    gone = [f"ledger/v={version}" for version in versions if f"v={version}" not in parts]
    gone += [f"ledger/{n}" for n, age in ledgers if n.startswith("_aside-") and age >= older_than]
    gone += [
        f"results/{n}" for n, age in results
        if n not in named and n.startswith(("run-", "_aside-")) and age >= older_than
    ]
    for name in gone:
        delete(spark, f"{root}/{name}")
    return sorted(gone)


def read_snapshot(spark: SparkSession, root: str, schema: T.StructType) -> DataFrame:
    """The newest complete version; an empty table if there is none."""
    versions = _versions(spark, root)
    if not versions:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{root}/v={versions[-1]}")


def read_all(spark: SparkSession, root: str, schema: T.StructType) -> DataFrame:
    """All complete versions together."""
    folders = [f"{root}/v={version}" for version in _versions(spark, root)]
    return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)


def read_ledger(spark: SparkSession, root: str) -> DataFrame:
    """The newest version, put together from its parts; an empty table if there is none."""
    parts = _parts(spark, root, newest(spark, f"{root}/ledger"))
    return _merged(spark, [f"{root}/ledger/{part}" for part in parts]) if parts else spark.createDataFrame([], LEDGER)


def init_tables(spark: SparkSession, root: str) -> None:
    """Create the empty tables that do not exist yet; safe to repeat."""
    for name, schema in (("ledger", LEDGER), ("results", RESULTS)):
        if not _versions(spark, f"{root}/{name}"):
            write_snapshot(spark.createDataFrame([], schema), f"{root}/{name}")
