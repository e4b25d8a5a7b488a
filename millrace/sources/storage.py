"""Folders on whatever file system holds them."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _at(spark: SparkSession, folder: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, folder: str) -> bool:
    path, files = _at(spark, folder)
    return files.exists(path)


def remove(spark: SparkSession, folder: str) -> None:
    """Remove a folder with all it holds; one that is not there is no error."""
    path, files = _at(spark, folder)
    files.delete(path, True)


def empty(spark: SparkSession, folder: str) -> None:
    """Remove what a folder holds and keep the folder: one that is being listed may lose files, but must not vanish.
    A folder that is not there is no error."""
    path, files = _at(spark, folder)
    if files.exists(path):
        for status in files.listStatus(path):
            files.delete(status.getPath(), True)


def make(spark: SparkSession, folder: str) -> None:
    path, files = _at(spark, folder)
    files.mkdirs(path)


def move(spark: SparkSession, folder: str, to: str) -> None:
    """Rename a folder, in one step where the file system can; one that is not there is no error."""
    path, files = _at(spark, folder)
    if files.exists(path) and not files.rename(path, _at(spark, to)[0]):
        raise OSError(f"could not rename {folder} to {to}")
