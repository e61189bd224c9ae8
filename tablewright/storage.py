"""Intermediate tables on shared storage, used where lineage is cut."""

from __future__ import annotations

import tempfile
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from typing import Any
from uuid import uuid4

from py4j.protocol import Py4JJavaError
from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

_own_root: str | None = None


def scratch_root(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a temporary one only for a local session without it."""
    global _own_root
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    if _own_root is None:
        _own_root = tempfile.mkdtemp(prefix="tablewright-")
    return _own_root


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path not used before, below the scratch root."""
    return f"{scratch_root(spark)}/tablewright/{label}-{uuid4().hex}"


def stash(df: DataFrame, label: str, path: str | None = None) -> DataFrame:
    """Write ``df`` to Parquet and return the written table.

    Same purpose as ``DataFrame.checkpoint``: the result outlives lost executors and is computed once.
    Parquet instead of a row dump lets later steps read single columns. It is compressed with zstd whatever
    the session's codec, which takes fewer bytes than Spark's default.
    """
    spark = df.sparkSession
    path = path or scratch_path(spark, label)
    df.write.mode("overwrite").parquet(path, compression="zstd")
    return spark.read.schema(df.schema).parquet(path)


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a folder on whatever file system it lives on."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def _files(spark: SparkSession, path: str) -> tuple[Any, Any]:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    files, target = _files(spark, path)
    return files.exists(target)


def list_folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in a folder; none if there is no such folder."""
    files, target = _files(spark, path)
    return [s.getPath().getName() for s in files.listStatus(target) if s.isDirectory()] if files.exists(target) else []


def list_files(spark: SparkSession, path: str) -> list[str]:
    """Paths below a folder of all its files at any depth, without hidden ones and marks of success; none if there is no such folder."""
    files, target = _files(spark, path)
    if not files.exists(target):
        return []
    found, root = files.listFiles(target, True), files.resolvePath(target).toString().rstrip("/")
    names = []
    while found.hasNext():
        names.append(found.next().getPath().toString()[len(root) + 1 :])
    return [n for n in names if not n.rsplit("/", 1)[-1].startswith((".", "_"))]


def rename_path(spark: SparkSession, new: str, old: str) -> None:
    """Rename ``new`` to ``old``, whose folder is made if need be."""
    files, source = _files(spark, new)
    _, target = _files(spark, old)
    files.mkdirs(target.getParent())
    if not files.rename(source, target):
        raise OSError(f"cannot move {new} to {old}")


def write_small(spark: SparkSession, path: str, text: str) -> None:
    """Write a small text file; readers see the whole file or none."""
    files, target = _files(spark, f"{path}.{uuid4().hex}.tmp")
    stream = files.create(target)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    _, final = _files(spark, path)
    files.delete(final, False)
    if not files.rename(target, final):
        raise OSError(f"cannot write {path}")


def create_small(spark: SparkSession, path: str, text: str) -> bool:
    """Create a small file that readers see whole or not at all; False, and no change, if there is one already."""
    files, target = _files(spark, f"{path}.{uuid4().hex}.tmp")
    _, final = _files(spark, path)
    stream = files.create(target)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    # a file context fails to rename to a name that is taken, also where the file system itself would replace the file
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(files.getUri(), spark._jsc.hadoopConfiguration())
    none = spark.sparkContext._gateway.new_array(getattr(spark._jvm, "org.apache.hadoop.fs.Options$Rename"), 0)
    try:
        context.rename(files.makeQualified(target), files.makeQualified(final), none)
    except Py4JJavaError:
        files.delete(target, False)
        if files.exists(final):
            return False
        raise
    return True


def read_small(spark: SparkSession, path: str) -> str:
    files, target = _files(spark, path)
    stream = files.open(target)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def replace_path(spark: SparkSession, new: str, old: str) -> None:
    """Put the complete folder ``new`` in the place of ``old``, which is deleted only then. Both must be on one file system."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    files = path(new).getFileSystem(spark._jsc.hadoopConfiguration())
    aside = path(f"{old}-replaced-{uuid4().hex}")
    files.mkdirs(path(old).getParent())
    had = files.exists(path(old))
    if had and not files.rename(path(old), aside):
        raise OSError(f"cannot move {old}")
    if not files.rename(path(new), path(old)):
        if had:
            files.rename(aside, path(old))
        raise OSError(f"cannot move {new} to {old}")
    if had:
        files.delete(aside, True)


def run_together(spark: SparkSession, jobs: Sequence[Callable[[], Any]]) -> list[Any]:
    """Submit independent jobs at once, so that one's last tasks do not leave the cluster idle."""
    with ThreadPoolExecutor(max_workers=max(1, len(jobs))) as pool:
        running = [pool.submit(inheritable_thread_target(spark)(job)) for job in jobs]
        return [job.result() for job in running]
