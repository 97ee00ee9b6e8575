"""Written tables: staging, size checks and partitioned sinks."""

from __future__ import annotations

import gc
import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, Observation, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by spark.checkpoint.dir.

    Without that setting it is a folder of the warehouse, which the executors share too.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    named = named or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    return spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_shared"


def staged_dir(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/staged/{spark.sparkContext.applicationId}"


# Folder of the innermost scope of staged tables, per thread.
_scope: ContextVar[str] = ContextVar("scope", default="")


@contextmanager
def staging(spark: SparkSession) -> Iterator[None]:
    """What is staged inside is removed at the end, so a job that has written its results leaves nothing.

    Tables that are still needed later must be written elsewhere, or staged outside.
    """
    name = f"{_scope.get()}/scope-{uuid.uuid4().hex}"
    token = _scope.set(name)
    try:
        yield
    finally:
        _scope.reset(token)
        remove(spark, staged_dir(spark) + name)


def stage(df: DataFrame) -> DataFrame:
    """Write a table to the shared folder and read it back.

    The result has no lineage to recompute, is pruned by column, and has an exact row count in
    its footers. Values that are not a function of the input, such as row ids, are fixed by it.
    """
    spark = df.sparkSession
    path = f"{staged_dir(spark)}{_scope.get()}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def stage_counted(df: DataFrame, **facts: Column) -> tuple[DataFrame, dict]:
    """stage, and aggregates over the rows, taken while they are written: no job of their own."""
    seen = Observation()
    table = stage(df.observe(seen, *[value.alias(name) for name, value in facts.items()]))
    return table, seen.get


def _place(spark: SparkSession, path: str) -> tuple:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def remove(spark: SparkSession, path: str) -> None:
    """Remove a folder on whatever file system it names, if it is there."""
    fs, where = _place(spark, path)
    fs.delete(where, True)


def replace_folder(spark: SparkSession, source: str, target: str) -> None:
    """Give a finished folder its final name; what had the name before goes."""
    fs, to = _place(spark, target)
    old = spark._jvm.org.apache.hadoop.fs.Path(f"{to.getParent().toString()}/.old-{uuid.uuid4().hex}")
    fs.mkdirs(to.getParent())
    replaced = fs.exists(to) and fs.rename(to, old)
    if not fs.rename(spark._jvm.org.apache.hadoop.fs.Path(source), to):
        if replaced:
            fs.rename(old, to)
        raise OSError(f"cannot publish {target}")
    if replaced:
        fs.delete(old, True)


def drop_staged(spark: SparkSession) -> None:
    """Remove what stage wrote in this application, once no result of it is needed any more."""
    remove(spark, staged_dir(spark))


# When an application last let go of its shuffles.
_freed: dict[str, float] = {}


def free_shuffles(spark: SparkSession, every_s: float = 0.0, wait_s: float = 1.5) -> None:
    """Let Spark remove the shuffle files of jobs whose results nothing refers to any more.

    It does so when the driver's JVM collects the plans, which one with memory to spare does late. What Python
    has just let go of is known there a second later, so wait_s is waited for it. With every_s set, a call
    within as many seconds of the last one does nothing.
    """
    app, now = spark.sparkContext.applicationId, time.monotonic()
    if now - _freed.get(app, -every_s) < every_s:
        return
    # What the first round frees may have held on to more.
    for _ in range(2):
        gc.collect()
        time.sleep(wait_s)
        spark._jvm.java.lang.System.gc()
    _freed[app] = time.monotonic()


def source_bytes(df: DataFrame) -> int:
    """Total size of what a plan reads, after pruning, as Spark knows it; no job is run.

    Nothing here multiplies rows, so unlike Spark's estimate for a chain of joins this does not
    grow by products.
    """
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    return sum(int(leaves.apply(i).stats().sizeInBytes()) for i in range(leaves.size()))


def matching_paths(spark: SparkSession, pattern: str) -> list[str]:
    """What matches a path or glob on whatever file system it names."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    fs = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
    return [str(s.getPath().toString()) for s in fs.globStatus(hadoop_path) or []]


def fingerprint(spark: SparkSession, path: str) -> tuple:
    """Names, sizes and times of a table's files: another tuple once the table has changed."""
    fs, where = _place(spark, path)
    files = [where] if fs.getFileStatus(where).isFile() else [s.getPath() for s in fs.listStatus(where)]
    found = [fs.getFileStatus(f) for f in files]
    return tuple(sorted((s.getPath().getName(), s.getLen(), s.getModificationTime()) for s in found))


def path_exists(spark: SparkSession, pattern: str) -> bool:
    return bool(matching_paths(spark, pattern))


def write_partitioned(df: DataFrame, path: str, by: list[str], mode: str = "overwrite") -> None:
    """Partitioned Parquet with balanced files: AQE merges small partitions, splits big ones.

    With overwrite only the partitions present in df are replaced.
    """
    (
        df.hint("rebalance", *by)
        .write.mode(mode)
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*by)
        .parquet(path)
    )


def write_table(df: DataFrame, path: str, by: list[str] | None = None) -> None:
    """Replace a whole table; an empty one still holds its schema for readers."""
    if not by:
        df.write.mode("overwrite").parquet(path)
        return
    (
        df.hint("rebalance", *by)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "static")
        .partitionBy(*by)
        .parquet(path)
    )
    spark = df.sparkSession
    if not path_exists(spark, f"{path}/{by[0]}=*"):
        # No partition means no file, so nothing would tell the columns.
        spark.createDataFrame([], df.schema).write.mode("overwrite").parquet(path)
