"""Files and folders, as the file system of their path knows them."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    context = spark.sparkContext
    target = context._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(context._jsc.hadoopConfiguration()), target


def path_exists(spark: SparkSession, path: str) -> bool:
    """Asks the file system of the path; a failed read would tell as much, but leaves an
    error in the log for every table not yet written."""
    files, target = _at(spark, path)
    return files.exists(target)


def matching(spark: SparkSession, pattern: str) -> list[str]:
    """Files and folders that a pattern names, as the file system lists them."""
    files, target = _at(spark, pattern)
    return [status.getPath().toString() for status in files.globStatus(target) or ()]


def move(spark: SparkSession, old: str, new: str) -> None:
    files, source = _at(spark, old)
    _, target = _at(spark, new)
    files.mkdirs(target.getParent())
    if not files.rename(source, target):
        raise OSError(f"can't move {old} to {new}")


def remove(spark: SparkSession, path: str) -> None:
    files, target = _at(spark, path)
    files.delete(target, True)
