"""Folders and markers in whatever store the session's paths name."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _located(spark: SparkSession, path: str):
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop, hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def delete(spark: SparkSession, path: str) -> bool:
    """Remove a folder or file with all it holds; false if it is not there."""
    hadoop, store = _located(spark, path)
    return store.delete(hadoop, True)


def mark(spark: SparkSession, path: str) -> bool:
    """Create an empty file; false if it is there already."""
    hadoop, store = _located(spark, path)
    return store.createNewFile(hadoop)


def files(spark: SparkSession, path: str) -> list[str]:
    """Names of the files right below a folder; none if it is not there."""
    hadoop, store = _located(spark, path)
    if not store.exists(hadoop):
        return []
    return sorted(s.getPath().getName() for s in store.listStatus(hadoop) if s.isFile())


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders right below a folder, hidden ones left out; none if it is not there."""
    hadoop, store = _located(spark, path)
    if not store.exists(hadoop):
        return []
    names = [s.getPath().getName() for s in store.listStatus(hadoop) if s.isDirectory()]
    return sorted(n for n in names if not n.startswith(("_", ".")))
