"""Small files and folders of the shared store, reached by the driver as Spark reaches them."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark._jsc.hadoopConfiguration())


def qualified(spark: SparkSession, path: str) -> str:
    """The path with its scheme, so that tasks open it in the store that Spark would."""
    where, store = _at(spark, path)
    return store.makeQualified(where).toString()


def names(spark: SparkSession, path: str) -> list[str]:
    """The names right below a folder; none if there is no such folder."""
    where, store = _at(spark, path)
    return [s.getPath().getName() for s in store.listStatus(where)] if store.exists(where) else []


def exists(spark: SparkSession, path: str) -> bool:
    where, store = _at(spark, path)
    return store.exists(where)


def create(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file that must not exist yet."""
    where, store = _at(spark, path)
    out = store.create(where, False)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def read(spark: SparkSession, path: str) -> str:
    where, store = _at(spark, path)
    source = store.open(where)
    try:
        return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(source)).decode()
    finally:
        source.close()


def remove(spark: SparkSession, path: str) -> None:
    where, store = _at(spark, path)
    store.delete(where, True)
